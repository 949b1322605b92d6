"""Cutting texts into words by byte tables, a bounded piece at a time."""

from __future__ import annotations

from collections.abc import Iterator

PIECE = 1 << 20  # bytes of a text that are cut at a time
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def byte_table(is_word, lower: bool = True) -> bytes:
    """A translation table: bytes outside words become blanks, A-Z becomes a-z if asked."""
    return bytes((LOWER.get(b, b) if lower else b) if is_word(b) else 32 for b in range(256))


#: UTF-8: ASCII letters and digits, and every byte of a character beyond ASCII.
TERMS = byte_table(lambda b: b >= 0x80 or chr(b).isalnum())
#: Latin-1: the letters A-Z and a-z and the code points from U+00C0 to U+00FF.
LETTERS = byte_table(lambda b: b >= 0xC0 or (b < 0x80 and chr(b).isalpha()))
#: UTF-8: everything but space and tab to carriage return, case kept.
PLAIN = byte_table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D, lower=False)


def pieces(data: bytes, table: bytes) -> Iterator[list[bytes]]:
    """The words of a text, in order, in lists that cover about ``PIECE`` bytes each."""
    data, at = data.translate(table), 0
    while at < len(data):
        end = data.find(b" ", at + PIECE) if len(data) - at > PIECE else -1
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end
