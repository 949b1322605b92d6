import math
import re
from collections import Counter

import numpy as np
from checks.compare import connect, differences
from conftest import SMALL
from pyspark.sql import functions as F

from wattfold.llm import quality, registry

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen = Counter(windows)
    repeated = {i + j for i, w in enumerate(windows) if seen[w] > 1 for j in range(8)}
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated), len(lines)


TEXTS = [
    None,
    "",
    " \t\r\n\x0b\x0c ",
    "one",
    "a b c d e f g h " * 3,
    "a b c d e f g h a b c d e f g h",
    "x " * 40,
    "été 漢字 #*$%&|<>     é 😀",
    "line\nline\n\n \nline \nline",
    "a b c d e f g",
    " ".join(str(i) for i in range(5000)) + " 7 8 9 10 11 12 13 14 tail",
]


def test_measures_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(quality, "AT_ONCE", 20)
    docs = spark.createDataFrame([(i, t, -1) for i, t in enumerate(TEXTS)], "doc_id int, text string, n_words int")
    found = {r["doc_id"]: tuple(r)[1:] for r in quality.measure(docs).collect()}
    assert found == {i: brute(t) for i, t in enumerate(TEXTS)}


def test_binomial_tail_is_exact():
    for n, k, p in [(1, 0, 0.1), (50, 3, 0.2), (400, 2, 0.0125), (30000, 300, 0.0125), (10, 10, 0.5)]:
        exact = math.fsum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)) if n < 1000 else None
        if k >= n * p:
            assert quality.binomial_tail(k, n, p) == 1.0
        elif exact is not None:
            assert math.isclose(quality.binomial_tail(k, n, p), exact, rel_tol=1e-9)
    logs = [math.lgamma(30001) - math.lgamma(i + 1) - math.lgamma(30001 - i) + i * math.log(0.0125) + (30000 - i) * math.log1p(-0.0125) for i in range(301)]
    assert math.isclose(quality.binomial_tail(300, 30000, 0.0125), math.fsum(map(math.exp, logs)), rel_tol=1e-8)


def text_of(rng, symbols):
    words = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(60)]
    return " ".join(words[:-symbols] + ["#|"] * symbols if symbols else words)


def test_cutoffs_follow_the_holdout_of_each_stratum(spark):
    """Rules bite where enough good documents vouch for them, and spare a stratum whose good ones use symbols."""
    rng = np.random.default_rng(2)
    docs, labels = [], []
    for i in range(2400):
        lang, good = ("plain", "code", "rare")[i % 3 if i < 2250 else 0], i % 10 != 0
        if lang == "rare" and i % 40:
            continue
        docs.append((i, text_of(rng, 0 if good and lang != "code" else 12), lang, "kept"))
        labels.append((i, int(good)))
    docs.append((5000, text_of(rng, 12), None, "no stratum"))
    docs.append((5001, "too short", "plain", ""))
    docs = spark.createDataFrame(docs, "doc_id int, text string, lang string, kept string")
    judged = quality.judge(docs, spark.createDataFrame(labels, "doc_id int, quality int"))
    assert judged.columns == ["doc_id", "lang", *quality.MEASURES, "base_failed", "kept"]
    shares = {
        (r["lang"], r["bad"]): r["kept"]
        for r in judged.where("not base_failed").groupBy("lang", (F.col("n_symbols") > 0).alias("bad"))
        .agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    }
    assert shares[("plain", True)] == 0 and shares[("plain", False)] == 1
    assert shares[("code", True)] == 1 and shares[("rare", True)] == 1 and shares[(None, True)] == 1
    assert not judged.where("doc_id = 5001").first()["kept"]


def test_lost_share_of_good_documents_is_bounded(spark):
    """On fresh documents of the same kind, not more than the risk goes."""
    rng = np.random.default_rng(4)
    rows = [(i, text_of(rng, int(rng.geometric(0.45)) - 1), "s") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    labels = spark.range(3000).select(F.col("id").cast("int").alias("doc_id"), F.lit(1).alias("quality"))
    fresh = quality.judge(docs, labels).where("doc_id >= 3000")
    lost = fresh.agg(F.avg((~F.col("kept")).cast("int"))).first()[0]
    assert 0 < lost <= quality.RISK


def test_contradicting_null_and_missing_labels(spark):
    docs = spark.createDataFrame([(1, "w " * 30, None), (1, "v " * 30, "a"), (None, "u", "a")], "doc_id int, text string, lang string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (1, None)], "doc_id int, quality int")
    assert quality.judge(docs, labels).count() == 3
    assert quality.judge(docs, labels.limit(0)).where("kept").count() == 0
    assert quality.judge(docs.limit(0), labels).count() == 0


def test_query_equals_sql(spark):
    found = registry.op13_certified_quality_rules(spark, SMALL)
    kinds = dict.fromkeys(["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"], "bigint")
    assert dict(found.dtypes) == kinds | {"base_failed": "boolean", "kept": "boolean"}
    assert differences(found.toPandas(), connect(SMALL).execute(quality.sql()).df()) == ""
