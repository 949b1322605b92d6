import math
import re
from collections import Counter

import pytest
from checks.compare import connect, differences
from conftest import SMALL

from wattfold.llm import registry, term_stages

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    bags = [(doc, Counter(terms_of(text))) for doc, text in docs]
    bags = [(doc, bag) for doc, bag in bags if bag]
    n_docs, n_terms = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, bag in bags for t in bag)
    out = []
    for item, text in items:
        scored = []
        for doc, bag in bags:
            m = 25 + 75 * sum(bag.values()) * n_docs // n_terms
            score = 0
            for t in terms_of(text):
                if bag[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * (10**9 * bag[t] // (1000 * bag[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc is None, doc))
        for rank, (score, _, doc) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1):
            out.append((item, rank, doc, -score))
    return sorted(out, key=str)


def answers(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


DOCS = [
    (1, "Alpha beta_gamma 42, beta!"),
    (2, "alpha ALPHA été ÉTÉ naïve"),
    (2, "alpha ALPHA été ÉTÉ naïve"),
    (3, None),
    (4, "  \t .. "),
    (None, "gamma gamma delta"),
    (5, "beta " * 5000 + "omega"),
    *[(100 + i, f"alpha word{i % 7} beta filler{i}") for i in range(40)],
]
ITEMS = [(1, "alpha beta"), (2, "beta gamma gamma omega"), (2, "été É"), (None, "word3 word3"), (4, None), (5, "nothing of this"), (6, "")]


@pytest.mark.parametrize("blocks, bundle", [(2048, 256), (8, 2)])
def test_equals_brute_force(spark, monkeypatch, blocks, bundle):
    monkeypatch.setattr(term_stages, "BLOCK", blocks)
    monkeypatch.setattr(term_stages, "BUNDLE", bundle)
    docs = spark.createDataFrame([(d, t, "x") for d, t in DOCS], "doc_id int, text string, score string")
    items = spark.createDataFrame([(i, t, 0) for i, t in ITEMS], "item_id int, text string, rank int")
    assert answers(term_stages.top_documents(docs, items, k=3)) == brute(DOCS, ITEMS, 3)


def test_text_ids(spark):
    docs = spark.createDataFrame([("b", "one two"), ("a", "one two"), ("c", "three")], "doc_id string, text string")
    items = spark.createDataFrame([("q", "one")], "item_id string, text string")
    assert [r["doc_id"] for r in term_stages.top_documents(docs, items).orderBy("rank").collect()] == ["a", "b"]


@pytest.mark.parametrize("docs, items", [([], ITEMS), (DOCS, []), ([(1, None)], ITEMS), (DOCS, [(1, "unheard")])])
def test_nothing_to_find(spark, docs, items):
    docs = spark.createDataFrame(docs, "doc_id int, text string")
    items = spark.createDataFrame(items, "item_id int, text string")
    found = term_stages.top_documents(docs, items)
    assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.count() == 0


def test_query_equals_sql(spark):
    found = registry.op11_term_stage_ranking(spark, SMALL)
    assert dict(found.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    assert differences(found.toPandas(), connect(SMALL).execute(term_stages.SQL).df()) == ""
