"""Spelling variants by range searches in k-d trees over letter counts (operator 12)."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattfold.llm.common import stash
from wattfold.llm.kd import Tree, thermometer
from wattfold.llm.words import LETTERS, pieces

LEAST_LENGTH, LEAST_COUNT = 7, 2
TIMES = 10  # a form occurs so many times as often as its variant
SPOIL = 31  # runs whose checksum this divides lose a letter
FLUSH = 200_000  # distinct words that a task counts before it hands them on
CELL = 4096  # words of a cell, about; a bounded sample decides where cells are cut
SAMPLE = 1 << 18  # words the cuts are drawn from, about
POINTS, QUERIES = 16384, 65536  # words of a cell that are searched, and that search, in one task
LEAF = 48  # distinct letter counts in a leaf of a task's tree
PAIRS = 1 << 19  # word pairs that are verified at a time

# The letters words are made of, as latin-1 bytes, each one dimension.
ALPHABET = np.array([b for b in range(256) if LETTERS[b] == b and b != 32], np.uint8)


def spoiled(run: bytes, prefix: int) -> bytes:
    """A lower-case run (latin-1) with the letter deleted that its checksum names, if any.

    ``prefix`` is the CRC of ``<doc_id>:``; the run follows in UTF-8.
    """
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), prefix)
    if h % SPOIL:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def count_words(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``w`` (latin-1 bytes) and ``n`` of the words of enough letters and occurrences."""
    given = docs.select(
        F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"), F.col(f"`{text_col}`").alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = Counter()
        for batch in batches:
            for doc, text in zip(batch.column("id"), batch.column("text")):
                # What latin-1 lacks becomes a question mark, which no run holds.
                data, found = (text.as_py() or "").encode("latin-1", "replace"), Counter()
                for words in pieces(data, LETTERS):
                    found.update(w for w in words if len(w) >= LEAST_LENGTH)
                prefix = zlib.crc32(f"{doc.as_py()}:".encode())
                for word, n in found.items():
                    total[spoiled(word, prefix)] += n
                if len(total) >= FLUSH:
                    yield _counts(total)
                    total.clear()
        yield _counts(total)

    counted = given.mapInArrow(run, "w binary, n bigint")
    return counted.groupBy("w").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _counts(total: Counter) -> pa.RecordBatch:
    kept = {w: n for w, n in total.items() if len(w) >= LEAST_LENGTH}
    return pa.RecordBatch.from_arrays(
        [pa.array(kept.keys(), pa.binary()), pa.array(kept.values(), pa.int64())], names=["w", "n"]
    )


def codes_of(words: list[bytes]) -> np.ndarray:
    """Words of one length as a matrix of code points."""
    return np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)


def letter_counts(codes: np.ndarray, letters: np.ndarray = ALPHABET) -> np.ndarray:
    """How often each of the letters occurs in each word."""
    place = np.zeros(256, np.int64)
    place[letters] = np.arange(len(letters))
    out = np.zeros((len(codes), len(letters)), np.uint8)
    rows = np.arange(len(codes))
    for j in range(codes.shape[1]):
        out[rows, place[codes[:, j]]] += 1
    return out


def _by_length(words: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, rows and letter counts of the words of each length."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        yield int(length), rows, letter_counts(codes_of(list(words[rows])))


class Cells:
    """A k-d tree per word length whose leaves are the cells words are dealt to."""

    def __init__(self, sample: list[bytes], total: int):
        self.trees, self.first, next_cell = {}, {}, 0
        most = CELL * len(sample) / max(total, 1)
        for length, _, counts in _by_length(np.array(sample, object)):
            # A length or letter the sample lacks still finds a cell: cuts only compare counts.
            tree = Tree(counts, max(most, 1))
            tree.members = []  # the sample is done with
            self.trees[length], self.first[length] = tree, next_cell
            next_cell += tree.leaves

    def tree(self, length: int) -> tuple[Tree, int]:
        if length in self.trees:
            return self.trees[length], self.first[length]
        return Tree(np.zeros((1, len(ALPHABET)), np.uint8), 1), -length  # one cell of its own

    def fitted(self, boxes: dict[int, tuple[np.ndarray, np.ndarray]]) -> Cells:
        for length in {*self.trees, *(-c for c in boxes if c < 0)}:
            tree, first = self.tree(length)
            found = {at: boxes[first + at] for at in range(tree.leaves) if first + at in boxes}
            tree.fit_boxes({k: b[0] for k, b in found.items()}, {k: b[1] for k, b in found.items()})
            self.trees[length], self.first[length] = tree, first
        return self


def _homes(cells: Cells):
    """Per batch and cell: least and largest count of every letter in use, and a row for letter -1."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for length, rows, counts in _by_length(batch["w"].to_numpy()):
                tree, first = cells.tree(length)
                home = tree.homes(counts)
                order = np.argsort(home, kind="stable")
                here, starts = np.unique(home[order], return_index=True)
                lo, hi = (f.reduceat(counts[order], starts, axis=0) for f in (np.minimum, np.maximum))
                used, letter = np.nonzero(hi)
                yield pd.DataFrame(
                    {"cell": first + here[used], "letter": letter, "lo": lo[used, letter], "hi": hi[used, letter]}
                )
                yield pd.DataFrame({"cell": first + here, "letter": -1, "lo": 0, "hi": 0})

    return run


def _visits(cells: Cells):
    """Each word as a point of its own cell, and as a query in every cell it can have neighbours in.

    Words of one length meet once: the one of the earlier cell visits the later one. Shorter
    words visit the cells of words one letter longer.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            w, n = batch["w"].to_numpy(), batch["n"].to_numpy()

            def as_(role: str, rows: np.ndarray, cell, w=w, n=n) -> pd.DataFrame:
                return pd.DataFrame({"cell": np.broadcast_to(cell, len(rows)), "role": role, "w": w[rows], "n": n[rows]})

            for length, rows, counts in _by_length(w):
                tree, first = cells.tree(length)
                home = tree.homes(counts)
                yield as_("point", rows, first + home)
                yield as_("own", rows, first + home)
                for leaf, some in tree.reach(counts, 2):
                    yield as_("guest", rows[some[home[some] < leaf]], first + leaf)
                if length + 1 in cells.trees:
                    longer, start = cells.tree(length + 1)
                    for leaf, some in longer.reach(counts, 1):
                        yield as_("guest", rows[some], start + leaf)

    return run


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of ``a`` become the rows of ``b`` (as long, or a letter longer) by one edit."""
    short = a.shape[1]
    if b.shape[1] == short:
        return (a != b).sum(axis=1) == 1
    # The longer word is the shorter one up to the first difference, and from it on one place later.
    ahead = a != b[:, :short]
    behind = a != b[:, 1:]
    first = np.where(ahead.any(axis=1), ahead.argmax(axis=1), short)
    last = np.where(behind.any(axis=1), short - 1 - behind[:, ::-1].argmax(axis=1), -1)
    return last < first


class _Kind:
    """Words of one length with their distinct letter counts; words with equal counts lie together."""

    def __init__(self, words: np.ndarray, letters: np.ndarray):
        codes = codes_of(list(words))
        counts = letter_counts(codes, letters)
        # A hash tells equal counts; were two kinds to share one, they are compared in full.
        weights = np.random.default_rng(len(letters)).integers(1, 2**63, len(letters), np.uint64)
        _, first, of = np.unique(counts @ weights, return_index=True, return_inverse=True)
        if (counts != counts[first[of]]).any():
            _, first, of = np.unique(counts, axis=0, return_index=True, return_inverse=True)
        of = of.reshape(-1)
        self.vectors = counts[first]
        self.rows = np.argsort(of, kind="stable")
        self.size = np.bincount(of, minlength=len(first))
        self.start = np.cumsum(self.size) - self.size
        self.codes = codes[self.rows]


def _near(queries: _Kind, points: _Kind, tree: Tree) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of queries and points that are one edit apart, in portions."""
    q_len, p_len = queries.codes.shape[1], points.codes.shape[1]
    distance = 2 if q_len == p_len else 1
    tops = np.minimum(points.vectors.max(axis=0), queries.vectors.max(axis=0))
    bits = thermometer(points.vectors, tops)
    for leaf, some in tree.reach(queries.vectors, distance):
        members = tree.members[leaf]
        # Sum of minima s gives the L1 distance q_len + p_len - 2 s.
        for a in range(0, len(some), 1 << 15):
            part = some[a : a + (1 << 15)]
            shared = thermometer(queries.vectors[part], tops) @ bits[members].T
            x, y = np.nonzero(q_len + p_len - 2 * shared == distance)
            yield from _verified(queries, part[x], points, members[y])


def _verified(queries: _Kind, x: np.ndarray, points: _Kind, y: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Letter order: all words of paired vectors are compared, so many at a time."""
    many = queries.size[x] * points.size[y]
    ends = np.cumsum(many)
    total = int(ends[-1]) if len(ends) else 0
    for a in range(0, total, PAIRS):
        flat = np.arange(a, min(a + PAIRS, total))
        pair = np.searchsorted(ends, flat, "right")
        i, j = np.divmod(flat - (ends - many)[pair], points.size[y][pair])
        i, j = i + queries.start[x[pair]], j + points.start[y[pair]]
        right = one_edit(queries.codes[i], points.codes[j])
        yield queries.rows[i[right]], points.rows[j[right]]


def _search(group: pd.DataFrame) -> pd.DataFrame:
    """A cell's points against its queries: per word, the near words met here and the best of them."""
    w, n, role = (group[c].to_numpy() for c in ("w", "n", "role"))
    at, asking = np.flatnonzero(role == "point"), np.flatnonzero(role != "point")
    letters = np.unique(np.frombuffer(b"".join(w), np.uint8))
    left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    if len(at):
        points = _Kind(w[at], letters)
        tree = Tree(points.vectors, LEAF)
        lengths = np.fromiter(map(len, w[asking]), np.int64, len(asking))
        for length in np.unique(lengths):
            rows = asking[lengths == length]
            for i, j in _near(_Kind(w[rows], letters), points, tree):
                i, j = rows[i], at[j]
                # The cell's own words meet from both sides; one of them is enough.
                once = (role[i] == "guest") | (w[i] < w[j])
                left.append(i[once])
                right.append(j[once])
    left, right = np.concatenate(left), np.concatenate(right)
    me, other = np.concatenate([left, right]), np.concatenate([right, left])
    # A word may be here twice, as point and as own query: its rows are summed up by the caller.
    spelled = np.empty(len(w), np.int64)
    spelled[np.argsort(w, kind="stable")] = np.arange(len(w))
    order = np.lexsort((spelled[other], -n[other], me))
    me, other = me[order], other[order]
    words, firsts, seen = np.unique(me, return_index=True, return_counts=True)
    best = other[firsts]
    return pd.DataFrame({"w": w[words], "n": n[words], "seen": seen.astype(np.int64), "best": w[best], "best_n": n[best]})


def near_words(words: DataFrame) -> DataFrame:
    """``w, n_near, best, best_n``: words with near ones, how many, and the commonest of those.

    Words are dealt to cells, the leaves of one k-d tree per length. The trees are cut by a
    sample of about ``SAMPLE`` words; which cells a word visits follows from the boxes round
    their real contents, so the sample decides sizes only. Cells with many points or
    queries are searched block by block, each block of points against each of queries.
    """
    total = words.count()
    every = max(1, -(-total // SAMPLE))
    sample = words.where(F.pmod(F.xxhash64("w"), F.lit(every)) == 0).select("w").orderBy("w").collect()
    cells = Cells([bytes(r[0]) for r in sample], total)
    # A row per cell and letter comes to the driver; the sample bounds the cells.
    limits = words.mapInPandas(_homes(cells), "cell int, letter int, lo int, hi int").groupBy("cell", "letter")
    limits = limits.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.count("*").alias("parts")).collect()
    parts = {r["cell"]: r["parts"] for r in limits if r["letter"] < 0}
    boxes = {cell: np.zeros((2, len(ALPHABET)), np.int16) for cell in parts}
    for r in limits:
        if r["letter"] >= 0:
            # Where a part of the cell lacks the letter, its least count is 0.
            boxes[r["cell"]][:, r["letter"]] = r["lo"] if r["parts"] == parts[r["cell"]] else 0, r["hi"]
    visits = words.mapInPandas(_visits(cells.fitted(boxes)), "cell int, role string, w binary, n bigint")
    visits = stash(visits, "visits")
    is_point = F.col("role") == "point"
    held = visits.groupBy("cell").agg(F.sum(is_point.cast("int")).alias("p"), F.count("*").alias("q"))
    blocks = held.select("cell", F.ceil(F.col("p") / POINTS).alias("ps"), F.ceil((F.col("q") - F.col("p")) / QUERIES).alias("qs"))
    own = lambda of: F.pmod(F.xxhash64("w"), of)
    all_of = lambda of: F.sequence(F.lit(0).cast("bigint"), of - 1)
    dealt = visits.join(blocks, "cell")
    dealt = dealt.withColumn("i", F.explode(F.when(is_point, F.array(own(F.col("ps")))).otherwise(all_of(F.col("ps")))))
    dealt = dealt.withColumn("j", F.explode(F.when(is_point, all_of(F.col("qs"))).otherwise(F.array(own(F.col("qs"))))))
    found = dealt.select("cell", "i", "j", "role", "w", "n").groupBy("cell", "i", "j").applyInPandas(
        _search, "w binary, n bigint, seen bigint, best binary, best_n bigint"
    )
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("w")))
    return found.groupBy("w").agg(F.sum("seen").alias("n_near"), best.alias("best")).select(
        "w", "n_near", F.col("best.w").alias("best"), (-F.col("best.n")).alias("best_n")
    )


def roots_of(forms: DataFrame) -> DataFrame:
    """``w, root`` of words with a ``form``, following forms to the last by doubling.

    Every step multiplies the count by ``TIMES`` at least, so there are no circles and a
    handful of rounds suffices.
    """
    ups = stash(forms.select("w", F.col("form").alias("root")), "ups")
    while True:
        onward = ups.select(F.col("w").alias("root"), F.col("root").alias("onward"))
        if ups.join(onward, "root", "left_semi").isEmpty():
            return ups
        ups = stash(ups.join(onward, "root", "left").select("w", F.coalesce("onward", "root").alias("root")), "ups")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the corpus.

    Words are runs of letters up to U+00FF, A-Z in lower case, some with a letter lost (see
    ``spoiled``), of at least 7 letters and 2 occurrences. Near words are one edit apart;
    the commonest near word is the form of a word it outnumbers ten times.

    Near words differ by at most 2 in the L1 distance of their letter counts, so each
    pair of lengths is searched in k-d trees over those counts, boxes too far off are pruned, and
    what is left is compared letter by letter.

    Null texts have no runs; a null id counts as an empty one in the checksum. Repeated rows
    count again. No words give an empty table. Other columns are ignored.
    """
    words = stash(count_words(docs, id_col, text_col), "words")
    near = stash(near_words(words), "near")
    known = words.join(near, "w", "left").withColumn("form", F.when(F.col("best_n") >= TIMES * F.col("n"), F.col("best")))
    known = stash(known, "forms")
    roots = roots_of(known.where(F.col("form").isNotNull()))
    spelled = lambda c: F.decode(c, "ISO-8859-1")
    return known.join(roots, "w", "left").select(
        spelled(F.col("w")).alias("word"),
        spelled(F.col("form")).alias("form"),
        spelled(F.coalesce("root", "w")).alias("root"),
        "n",
        F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(F.col("form").isNotNull(), F.col("best_n")).alias("form_n"),
    )
