"""Token ids of whole texts by the vocabulary files of public tokenizers."""

from __future__ import annotations

import functools
import hashlib
import json

import numpy as np


def version(path: str) -> str:
    """A digest of the vocabulary file and of the library that reads it."""
    if path.endswith(".model"):
        import sentencepiece as library
    else:
        import tokenizers as library
    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + f"|{library.__version__}".encode()).hexdigest()


@functools.lru_cache(maxsize=2)
def encoder(path: str):
    """A function from a list of texts to a list of id arrays; loaded once per worker.

    Byte-level BPE files go through tiktoken, which applies the same merges several times
    as fast; tests hold its ids against those of the file's own library.
    """
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [np.asarray(x, np.uint32) for x in model.encode(texts, num_threads=1)]
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    if _plain_byte_bpe(spec):
        return _tiktoken(spec)
    import tokenizers

    own = tokenizers.Tokenizer.from_str(json.dumps(spec))
    return lambda texts: [
        np.asarray(e.ids, np.uint32) for e in own.encode_batch(texts, add_special_tokens=False)
    ]


def _byte_letters() -> dict[str, int]:
    """The printable letter that byte-level vocabularies write for each byte."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in kept]
    return {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(others)}


def _plain_byte_bpe(spec: dict) -> bool:
    """Byte-level BPE whose merges rank as their ids do, with nothing before or after it."""
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    if model.get("type") != "BPE" or spec.get("normalizer") or pre.get("type") != "ByteLevel":
        return False
    if pre.get("add_prefix_space") or not pre.get("use_regex", True) or model.get("ignore_merges"):
        return False
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]):
        return False
    made = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    ids = [model["vocab"][m] for m in made]
    return all(a < b for a, b in zip(ids, ids[1:]))


def _tiktoken(spec: dict):
    import public_tokenizers
    import tiktoken

    letters = _byte_letters()
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {
        bytes(letters[c] for c in word): i
        for word, i in spec["model"]["vocab"].items()
        if word not in special
    }
    bpe = tiktoken.Encoding(
        "file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special
    )
    return lambda texts: [bpe.encode_to_numpy(t, allowed_special="all") for t in texts]
