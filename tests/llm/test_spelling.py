import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from wattfold.llm import registry, spelling
from wattfold.llm.kd import Tree


def brute_words(docs):
    found = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def edits(word, letters):
    for i in range(len(word)):
        yield word[:i] + word[i + 1 :]
        for c in letters:
            if c != word[i]:
                yield word[:i] + c + word[i + 1 :]
    for i in range(len(word) + 1):
        for c in letters:
            yield word[:i] + c + word[i:]


def brute(docs):
    words = brute_words(docs)
    letters = sorted({c for w in words for c in w})
    rows = {}
    for w, n in words.items():
        near = {e for e in edits(w, letters) if e in words}
        best = min(near, key=lambda e: (-words[e], e), default=None)
        form = best if best is not None and words[best] >= 10 * n else None
        rows[w] = (form, n, len(near))
    out = []
    for w, (form, n, near) in rows.items():
        root = w
        while rows[root][0] is not None:
            root = rows[root][0]
        out.append((w, form, root, n, near, None if form is None else words[form]))
    return sorted(out, key=str)


def answers(df):
    return sorted((tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)


def chain():
    """Words of rising counts, each one edit from the next, with an anagram and a tie beside them."""
    rows = [(1000 + i, "Straßenbahn " * 300) for i in range(4)]
    rows += [(1, "strassenbahn " * 2), (2, "Straßenbahm " * 30), (3, "Straßenbah " * 3), (4, "ahnbStraßen " * 2)]
    rows += [(5, "abcdefgh " * 20 + "abcdefgi " * 20 + "abcdefgj " * 2), (None, "ŒuvreétéŒ élève été,Élèveees " * 3)]
    return rows + [(6, None), (7, ""), (8, "short x yy"), (9, "×÷ÿþðñòóô " * 2), (9, "×÷ÿþðñòóô " * 2)]


def test_equals_brute_force_on_edge_cases(spark):
    docs = spark.createDataFrame([(d, t, 0) for d, t in chain()], "doc_id int, text string, n int")
    assert answers(spelling.variants(docs)) == brute(chain())


@pytest.fixture
def crowded():
    rng = np.random.default_rng(3)
    return [(i, " ".join("".join(rng.choice(list("abcé"), rng.integers(7, 10))) for _ in range(300))) for i in range(40)]


def test_small_cells_and_blocks_change_nothing(spark, monkeypatch, crowded):
    for name, value in {"CELL": 50, "POINTS": 16, "QUERIES": 64, "SAMPLE": 400, "LEAF": 4, "PAIRS": 999, "FLUSH": 100}.items():
        monkeypatch.setattr(spelling, name, value)
    docs = spark.createDataFrame(crowded, "doc_id int, text string")
    assert answers(spelling.variants(docs)) == brute(crowded)


def test_no_words(spark):
    assert spelling.variants(spark.createDataFrame([], "doc_id int, text string")).count() == 0
    assert spelling.variants(spark.createDataFrame([(1, "too rare here")], "doc_id int, text string")).count() == 0


def test_query_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    found = registry.op12_kd_spelling_variants(spark, SMALL)
    kinds = {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"}
    assert dict(found.dtypes) == kinds
    assert answers(found) == brute(docs)
    assert found.where(F.col("form").isNotNull()).count() > 0


def test_tree_reaches_every_near_point():
    rng = np.random.default_rng(5)
    points, queries = rng.integers(0, 4, (500, 6)).astype(np.uint8), rng.integers(0, 5, (80, 6)).astype(np.uint8)
    tree = Tree(points, 9)
    reached = set()
    for leaf, rows in tree.reach(queries, 2):
        reached |= {(q, p) for q in rows for p in tree.members[leaf]}
    apart = np.abs(queries[:, None].astype(int) - points[None]).sum(axis=2)
    assert set(zip(*np.nonzero(apart <= 2))) <= reached
    assert len(reached) < 0.9 * apart.size
    assert all((tree.homes(points[m]) == leaf).all() for leaf, m in enumerate(tree.members))
