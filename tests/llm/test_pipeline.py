"""The stages one after the other, each judged on the input it got."""

from test_near_copies import Sets, shingles, similar

import corpus_pipeline
from wattfold.llm import lines, toxicity
from wattfold.llm.common import stash, table

SMALL = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SMALL, "documents")
    columns, before = docs.columns, {r.doc_id: r for r in docs.collect()}
    after = {}
    for name, stage in corpus_pipeline.STAGES:
        given = docs
        docs = stash(stage(spark, docs, SMALL), "test-stage")
        if name != "pack":
            assert docs.columns == columns
            after[name] = {r.doc_id: r for r in docs.collect()}
        if name == "toxicity":
            model = toxicity.train(given, table(spark, SMALL, "labels"))
            score = {r.doc_id: r.score for r in toxicity.score(given, model).collect()}
            assert after[name] == {i: r for i, r in before.items() if score[i] < 0.5}
        elif name == "line dedup":
            left = after["toxicity"]
            assert set(after[name]) == set(left)
            removed = {r.doc_id: r.n_removed for r in lines.dedup_lines(given).collect()}
            for i, r in after[name].items():
                assert r.n_chars == len(r.text)
                assert (r.text == left[i].text) == (removed[i] == 0)
        elif name == "n-gram join":
            left = sorted(after["line dedup"])
            sets, groups = [shingles(after["line dedup"][i].text) for i in left], Sets(len(left))
            for a in range(len(left)):
                for b in range(a):
                    if similar(sets[a], sets[b]):
                        groups.join(a, b)
            assert set(after[name]) == {left[i] for i in range(len(left)) if groups.find(i) == i}
        elif name == "mix":
            assert after[name].items() <= after["n-gram join"].items() and after[name]
        else:
            assert {r.doc_id for r in docs.collect()} == set(after["mix"])


def test_run(spark):
    assert corpus_pipeline.run(spark, SMALL).count() > 0
