"""Toxicity model, page text and source mixing."""

import os
import random
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.compare import connect, differences
from wattfold.llm import host_paths, mixing, registry, toxicity

SMALL = "/root/testdata/sf0.001"


def labelled(n, seed):
    draw = random.Random(seed)
    words = ["".join(draw.choice("aeioklmnrst") for _ in range(draw.randrange(2, 8))) for _ in range(300)]
    texts, labels = [], []
    for i in range(n):
        text = [draw.choice(words) for _ in range(draw.randrange(1, 400))]
        bad = i % 4 == 0
        for _ in range(3 if bad else 0):
            text.insert(draw.randrange(len(text) + 1), draw.choice(["vilescum", "crudfool", "rotswine"]))
        texts.append(" ".join(text))
        labels.append(int(bad))
    return texts, np.array(labels)


def test_model_learns_and_reads_whole_texts():
    texts, labels = labelled(700, 1)
    model = toxicity.fit(texts[:500], labels[:500])
    score = toxicity._scores(model, texts[500:])
    assert ((score >= 0.5) == labels[500:]).mean() > 0.95
    clean = [t for t, y in zip(texts, labels) if not y][:40]
    late = " ".join(clean * 5) + " vilescum crudfool vilescum"
    assert toxicity._scores(model, [late])[0] >= 0.5
    assert np.isfinite(toxicity._scores(model, ["", " \n", "x" * 200000])).all()


def test_gradient_is_that_of_the_loss():
    texts, labels = labelled(12, 2)
    model, batch = toxicity.Model(np.random.default_rng(0)), toxicity.Batch(texts)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    which = np.arange(len(batch.text))[::3]
    y = labels[batch.text[which]].astype(float)

    def loss():
        logit = model.run(model.gates(model.embed(batch.inputs)), *batch.ids(which))
        return np.mean(np.logaddexp(0, logit) - y * logit)

    grad = model.gradient(batch, which, y)
    for name in ("out", "att", "Uf", "Wb", "cf", "bias", "word", "gram"):
        at = np.unravel_index(np.abs(grad[name]).argmax(), grad[name].shape)
        model.p[name][at] += 1e-2
        up = loss()
        model.p[name][at] -= 2e-2
        down = loss()
        model.p[name][at] += 1e-2
        assert grad[name][at] == pytest.approx((up - down) / 2e-2, rel=0.05, abs=1e-6), name


def test_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, None, "s"), (None, "", "s")], "doc_id bigint, text string, score string")
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    model = toxicity.train(docs, none)
    got = toxicity.score(docs, model).collect()
    assert [(r.doc_id, r.text) for r in got] == [(1, None), (None, "")]
    assert all(0 <= r.score < 0.5 for r in got)
    assert toxicity.score(docs.where("false"), model).count() == 0


def test_training_is_left_to_a_task(spark, monkeypatch):
    """Neither the texts nor the work on them are the driver's."""
    monkeypatch.setattr(toxicity, "fit", lambda texts, labels: SimpleNamespace(p=(os.getpid(), texts, labels.tolist())))
    docs = spark.createDataFrame([(4, "b"), (1, "c"), (1, "a"), (2, None), (9, "x")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 0), (4, None), (7, 1)], "doc_id bigint, toxic int")
    pid, texts, marks = toxicity.train(docs, labels.unionAll(labels)).p
    trained = [r.doc_id for r in docs.where(~toxicity.held_out(F.col("doc_id")) & F.col("doc_id").isin(1, 2)).select("doc_id").distinct().orderBy("doc_id").collect()]
    assert pid != os.getpid() and trained
    assert list(zip(texts, marks)) == [{1: ("a", 1.0), 2: ("", 0.0)}[i] for i in trained]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    known = docs.join(labels.where("toxic is not null").select("doc_id", "toxic"), "doc_id")
    held = known.where(toxicity.held_out(F.col("doc_id")))
    got = toxicity.score(held, toxicity.train(docs, labels)).select("toxic", "score").toPandas()
    hit = (got.score >= 0.5) == (got.toxic == 1)
    assert hit.mean() > 0.97
    assert hit[got.toxic == 1].mean() > 0.85


PAGE = """<!DOCTYPE html><html><head><title>Site: T</title><style>p{{}}</style><script>var t="</p>";</script></head>
<body><header><h2>The Site</h2></header><nav><ul><li><a href=x>Home</a><li>More</ul></nav>
<div class="cookie-notice">We use cookies</div><div class="col-{n}"><div class="post post-{n}">
<h1>Title &amp; more</h1><p>First   para<b>graph</b>&nbsp;here.<p>Second<br>line &lt;kept&gt; <a href=y>link</a>
<div class="ad">Buy</div><ul><li>one<li>two</ul><form>Mail<input></form></div>
<section class="comments"><p>A reader says a lot of things that go on and on and on and on.</section></div>
<aside>Also</aside><footer>&copy; 2020</footer></body></html>"""
TEXT = "Title & more\nFirst paragraph here.\nSecond line <kept> link\none\ntwo"


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, text string").repartition(3)


def test_pages(spark):
    rows = [(i, f"https://www.a.com/{i}", PAGE.format(n=i), "old") for i in range(20)]
    # Its notice is longer than its article; the host's path wins.
    odd = PAGE.format(n=99).replace("</body>", "<div class='x'>" + "<p>Long legal text of the house. " * 20 + "</div></body>")
    rows += [(50, "https://www.a.com/odd", odd, ""), (51, None, None, ""), (52, "http://b.org", "", ""), (53, "http://b.org", "plain & simple", "")]
    rows += [(54, "c", "<p>a<p>b<!-- <p>no", ""), (55, "c", "<div>" * 3000 + "deep", ""), (56, "d", "<a '" * 500 + "<p>x", "")]
    got = {r.page_id: r for r in host_paths.extract(pages(spark, rows)).collect()}
    assert len(got) == len(rows)
    for i in [*range(20), 50]:
        assert got[i].text == TEXT and got[i].n_chars == len(TEXT)
    assert got[51].text == "" and got[52].text == "" and got[53].text == "plain & simple"
    assert got[54].text == "a\nb" and got[55].text == "deep"
    assert host_paths.extract(pages(spark, rows).where("false")).count() == 0


def test_heading_of_an_article_stays():
    page = host_paths.read_page("<body><article><header><h1>T</h1><p>by me</p></header><p>Body</p></article></body>")
    assert host_paths.page_text(page, host_paths.main_container(page, host_paths.weights(page))) == "T\nBody"


def test_text_round_the_main_container_stays(spark):
    body, side = "<p>" + "Much of the story is told here. " * 12 + "</p>", "<div><p>Popular</p><a href=x>One linked piece</a> <a href=y>Another linked piece</a></div>"
    told = " ".join(["Much of the story is told here."] * 12)
    pages_of = {
        "http://a.org/": f"<body><div class=page><h1><a href=t>Title</a></h1><p>An intro of its own.</p><ul><li><a href=z>Far away</a></ul><div class=entry>{body}</div></div>{side}</body>",
        "http://b.org/": f"<body><article><h1>Title</h1><section><p>An intro of its own.</p></section><section>{body}</section></article>{side}</body>",
        "http://c.org/": f"<body><main><h1>Title</h1><p>An intro of its own.</p><article><div>{body}</div></article></main>{side}</body>",
        "http://d.org/": f"<body><h1>Title</h1><p>An intro of its own.</p><article>{body}</article></body>",
    }
    rows = [(i, f"{url}{i}", html, "") for url, html in pages_of.items() for i in range(3)]
    # Most pages of this host have no intro; one has, and one has two containers on the path.
    plain = f"<body><div class=page><div class=entry>{body}</div></div></body>"
    rows += [(10 + i, "http://e.org/", plain, "") for i in range(3)]
    rows += [(20, "http://e.org/", f"<body><div class=page><h1>Title</h1><p>An intro of its own.</p><div class=entry>{body}</div></div></body>", "")]
    rows += [(21, "http://e.org/", f"<body><div class=page><h1>Title</h1></div><div class=page><p>An intro of its own.</p></div><div class=page><div class=entry>{body}</div></div></body>", "")]
    for r in host_paths.extract(pages(spark, rows)).collect():
        assert r.text == (told if 10 <= r.page_id < 20 else f"Title\nAn intro of its own.\n{told}"), r.url


def test_names_alone_do_not_drop_an_article(spark):
    said = " ".join(["Much of the story is told here."] * 12)
    story, talk, more = (f"<p>{t}</p>" for t in (said, "A reader says this. " * 40, "And a share of it is told here."))
    rows = [
        (i, f"http://{i}.org/", f"<body>{html}<div class='sidebar'><p>Read this too.</p></div></body>", "")
        for i, html in enumerate([
            f"<div class='post-body no-sidebar'>{story}</div>",
            f"<div class='content has-sidebar'>{story}</div>",
            f"<div class=widget><div class=search>{story}</div></div>",
            f"<article><div>{story}</div></article>",
        ])
    ]
    rows += [(4, "http://4.org/", f"<body><article>{story}<section id='search-engines'>{more}</section></article></body>", "")]
    # One page has more comments than text; the other pages of the host settle it.
    page = "<body><div class=text>{}</div><section class=comments>{}</section></body>"
    rows += [(10 + i, "http://host.org/", page.format(story, talk if i == 0 else more), "") for i in range(4)]
    # Nothing but comments is still the text of its page.
    rows += [(20, "http://host.org/", page.format("", more), "")]
    got = {r.page_id: r.text for r in host_paths.extract(pages(spark, rows)).collect()}
    alone = "And a share of it is told here."
    assert got == {i: said for i in [0, 1, 2, 3, 10, 11, 12, 13]} | {4: f"{said}\n{alone}", 20: alone}


def test_given_pages(spark):
    rows = registry.op8_host_paths(spark, SMALL).collect()
    assert len(rows) == spark.read.parquet(f"{SMALL}/pages.parquet").count()
    assert all(r.text and "var t=" not in r.text and r.n_chars == len(r.text) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_sql(spark, name):
    got = registry.queries()[name](spark, SMALL).toPandas()
    assert len(got) and differences(got, connect(SMALL).execute(registry.oracle_sql()[name]).df()) == ""


def test_raking_reaches_all_marginals(spark):
    draw = random.Random(3)
    rows = [(i, f"s{draw.choice('aab')}", draw.choice(["en", "de", None]), "w " * draw.randrange(1, 90) + draw.choice(["", "1" * 99])) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, text string")
    got = mixing.mix(docs, power=0.5).toPandas()
    assert len(got) == len(rows) and got.probability.max() == pytest.approx(1) and got.probability.min() > 0
    weight = got.tokens * got.probability
    for by in (got.source, got.lang.fillna("none"), got.topic):
        share = got.tokens.groupby(by).sum() / got.tokens.sum()
        want = share**0.5 / (share**0.5).sum()
        assert np.allclose(weight.groupby(by).sum() / weight.sum(), want, atol=1e-4)
    kept = got[got.kept]
    assert abs(kept.tokens.sum() / weight.sum() - 1) < 0.1


def test_mixing_of_nothing_and_nulls(spark):
    schema = "doc_id bigint, source string, lang string, text string, kept int"
    assert mixing.mix(spark.createDataFrame([], schema)).count() == 0
    got = mixing.mix(spark.createDataFrame([(None, None, None, None, 1), (1, "a", "b", "", 1)], schema)).collect()
    assert [(r.tokens, r.topic, r.probability) for r in got] == [(0, "empty", 1.0)] * 2 and all(r.kept for r in got)


def test_raking_few_cells_needs_no_exchange(spark, monkeypatch):
    """Every exchange holds a thread of the driver for a minute; the wider way gives the same weights."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plans, stash = [], mixing.stash

    def noted(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stash(df, label)

    monkeypatch.setattr(mixing, "stash", noted)
    rate = lambda: {r.doc_id: (r.topic, r.tokens, r.kept, round(r.probability, 9)) for r in mixing.mix(docs).collect()}
    few = rate()
    assert sum(plan.count("Exchange") for plan in plans) < 5  # however many passes
    plans.clear()
    monkeypatch.setattr(mixing, "FEW", 0)
    assert rate() == few and sum(plan.count("Exchange") for plan in plans) > 30


def test_given_shares_are_reached(spark):
    """Targets can be given; they need not be near the shares the documents have."""
    draw = random.Random(3)
    rows = [
        (i, draw.choice(["web"] * 6 + ["news", "code", None]), draw.choice(["en", "en", "de"]), "word " * draw.randrange(1, 40))
        for i in range(3000)
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, text string")
    wanted = {"web": 1.0, "news": 2.0, None: 1.0}
    shares = {
        "source": spark.createDataFrame([*wanted.items(), ("unseen", 5.0)], "source string, share double"),
        "lang": spark.createDataFrame([("en", 1.0), ("de", 3.0)], "lang string, share double"),
    }
    got = mixing.mix(docs, shares=shares).toPandas()
    assert len(got) == len(rows) and not got[got.source == "code"].kept.any()
    expected = got.tokens * got.probability
    by = lambda column: (expected.groupby(column.fillna("none")).sum() / expected.sum()).to_dict()
    assert by(got.source) == pytest.approx({"web": 0.25, "news": 0.5, "none": 0.25, "code": 0.0}, abs=1e-5)
    assert by(got.lang) == pytest.approx({"en": 0.25, "de": 0.75}, abs=1e-5)
    assert got.probability.max() == pytest.approx(1)


def test_given_shares_that_contradict_each_other_are_told(spark):
    docs = spark.createDataFrame(
        [(1, "a", "x", "one two"), (2, "b", "y", "one two")], "doc_id bigint, source string, lang string, text string"
    )
    share = lambda column, **x: spark.createDataFrame(list(x.items()), f"{column} string, share double")
    with pytest.warns(UserWarning, match="off by"):
        mixing.mix(docs, rounds=1, shares={"source": share("source", a=0.9, b=0.1), "lang": share("lang", x=0.1, y=0.9)})
    with pytest.raises(ValueError, match="source"):
        mixing.mix(docs, shares={"source": share("source", c=1.0)})
    with pytest.raises(ValueError, match="author"):
        mixing.mix(docs, shares={"author": share("author", c=1.0)})
