"""The n-gram join, line dedup and components against brute force."""

import random
import re
from itertools import combinations

import pytest

from wattfold.llm import jaccard, lines
from wattfold.llm.components import components


class Sets:
    """Union-find on a list."""

    def __init__(self, n):
        self.up = list(range(n))

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


def shingles(text):
    lowered = (text or "").translate({i: i + 32 for i in range(65, 91)})
    words = [w for w in re.split("[\x20\x09-\x0d]+", lowered) if w]
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def similar(a, b):
    return bool(a) and bool(b) and 100 * len(a & b) >= 80 * len(a | b)


def test_components(spark):
    draw = random.Random(1)
    links = [(draw.randrange(300), draw.randrange(300)) for _ in range(200)] + [(0, i) for i in range(400, 700)] + [(5, 5)]
    links += [(i, i + 1) for i in range(800, 900)]
    want = Sets(1000)
    for a, b in links:
        want.join(a, b)
    got = dict(components(spark.createDataFrame(links, "a bigint, b bigint")).collect())
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: want.find(x) for x in nodes}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def corpus(seed):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    text = lambda n: [draw.choice(words) for _ in range(n)]
    out, passage = [], text(60)
    for _ in range(30):
        base = text(draw.randrange(3, 200))
        out.append(" ".join(base))
        for _ in range(draw.randrange(4)):
            copy = list(base)
            for _ in range(draw.randrange(1, 6)):
                copy[draw.randrange(len(copy))] = draw.choice(words)
            out.append(" ".join(copy))
    base = text(120)
    for _ in range(60):  # a large group of near copies
        copy = list(base)
        for _ in range(draw.randrange(0, 4)):
            copy[draw.randrange(len(copy))] = draw.choice(words)
        out.append(" ".join(copy))
    for _ in range(60):  # texts that share a passage, more or less of them
        out.append(" ".join(passage + text(draw.randrange(0, 60))))
    return out + [out[0].upper(), out[0], out[0], "one", "One\n", "", None, " \t", "a b c d e", "a b c d e f"]


@pytest.mark.parametrize(("seed", "common"), [(1, 32), (2, 3), (3, 8)])
def test_join_matches_brute_force(spark, monkeypatch, seed, common):
    monkeypatch.setattr(jaccard, "COMMON", common)
    texts = corpus(seed)
    rows = [(i + 10, t, "shadow", i) for i, t in enumerate(texts)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, s1 string, n int").repartition(4)
    sets, want = [shingles(t) for t in texts], Sets(len(texts))
    for i in range(len(sets)):
        for j in range(i):
            if similar(sets[i], sets[j]):
                want.join(i, j)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join_components(table.select("doc_id", "text")).collect()}
    assert got == {i + 10: (len(s), want.find(i) + 10) for i, s in enumerate(sets)}
    if common == 8:
        kept = {r.doc_id - 10 for r in jaccard.keep_one(table).collect()}
        assert kept == {i for i in range(len(texts)) if want.find(i) == i}


def test_join_rules_out_pairs_of_texts_made_of_shared_passages(spark, monkeypatch):
    """Texts that share some of their passages meet in many columns, yet few pairs go on, and no link is lost."""
    draw, tried = random.Random(6), []
    passages = [" ".join(f"p{i}w{j}" for j in range(12)) for i in range(9)]
    texts = [" ".join(chosen) for chosen in combinations(passages, 5)]
    texts += [t + " more" for t in draw.sample(texts, 10)]
    monkeypatch.setattr(jaccard, "COMMON", 3)
    stash = jaccard.stash

    def noted(df, label):
        out = stash(df, label)
        if label == "more-pairs":
            tried.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "stash", noted)
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in jaccard.join_components(table).collect()}
    sets, want = [shingles(t) for t in texts], Sets(len(texts))
    for i in range(len(sets)):
        for j in range(i):
            if similar(sets[i], sets[j]):
                want.join(i, j)
    assert got == {i: want.find(i) for i in range(len(texts))}
    assert tried[-1] < len(texts), tried


def test_join_of_nothing_null_ids_and_repeats(spark):
    schema = "doc_id bigint, text string"
    assert jaccard.join_components(spark.createDataFrame([], schema)).count() == 0
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(None, text), (None, text), (5, text + " more"), (5, text + " more"), (None, "alone")]
    got = jaccard.join_components(spark.createDataFrame(rows, schema)).collect()
    assert sorted(r.component_id or -1 for r in got) == [-1, 5, 5, 5, 5]
    assert jaccard.keep_one(spark.createDataFrame(rows, schema)).count() == 2


def clean(line):
    return re.sub(r"\s+", " ", line.lower()).strip()


def test_line_dedup(spark):
    draw = random.Random(4)
    line = lambda n: " ".join(draw.choice("alpha beta gamma delta epsilon zeta eta theta".split()) + str(draw.randrange(99)) for _ in range(n))
    pool = [line(draw.randrange(1, 30)) for _ in range(40)]
    texts = []
    for _ in range(80):
        chosen = []
        for _ in range(draw.randrange(0, 6)):
            x = draw.choice(pool) if draw.random() < 0.5 else line(12)
            if draw.random() < 0.4:  # one word in many changed, or case and spacing only
                x = x.replace("alpha", "omega", 1) if draw.random() < 0.5 else "  " + x.upper().replace(" ", "  ")
            chosen.append(x)
        texts.append("\n".join(chosen))
    texts += [None, "", "\n\n", " \n\t", pool[0] + "\n" + pool[0], "x" * 40000, "x" * 39990 + "\ny"]
    rows = [(i, t, "shadow") for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string, n_lines string").repartition(3)).collect()}
    all_lines = [(i, j, x) for i, t in enumerate(texts) if t is not None for j, x in enumerate(t.split("\n")) if x.strip()]
    sets = [frozenset(c[k : k + 10] for k in range(max(1, len(c) - 9))) for c in (clean(x) for *_, x in all_lines)]
    groups = Sets(len(all_lines))
    for i in range(len(sets)):
        for j in range(i):
            if similar(sets[i], sets[j]):
                groups.join(i, j)
    gone = {(i, j) for k, (i, j, _) in enumerate(all_lines) if groups.find(k) != k}
    wrong = 0
    for i, t in enumerate(texts):
        kept = None if t is None else "\n".join(x for j, x in enumerate(t.split("\n")) if (i, j) not in gone)
        wrong += got[i].text != kept
    assert len(got) == len(texts) and wrong <= 1  # banding finds nearly every link at the bound
    assert got[len(texts) - 7].text is None and got[len(texts) - 3].n_removed >= 1


def test_line_dedup_of_nothing_and_repeats(spark):
    schema = "doc_id bigint, text string"
    assert lines.dedup_lines(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, "some line"), (1, "Some  line"), (1, "Some  line"), (2, "other")]
    got = lines.dedup_lines(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == [(0, ""), (1, "Some  line"), (1, "Some  line"), (2, "other")]


def test_line_dedup_with_text_ids_and_clashing_columns(spark):
    names = "doc_id string, text string, doc int, text_hash string, __text string, cid int, band string, n int"
    rows = [("b", "some line\nanother", 1, "x", "y", 2, "z", 3), ("a", "Some  line", 4, None, "y", 5, "z", 6)]
    got = lines.dedup_lines(spark.createDataFrame(rows, names)).orderBy("doc_id").collect()
    assert [(r.doc_id, r.text, r.doc, r.text_hash, r["__text"], r.cid, r.n) for r in got] == [
        ("a", "Some  line", 4, None, "y", 5, 6), ("b", "another", 1, "x", "y", 2, 3)
    ]


def test_line_maps_lose_no_link(spark):
    """Whatever the maps rule out is no link, also for lines that repeat shingles or are very long."""
    draw = random.Random(9)
    texts = []
    for size in [12, 40, 90, 200, 400, 900, 5000] * 4:
        base = "".join(draw.choice("abcde ") for _ in range(size))
        texts.append(base)
        for edits in (1, 2, 4, 8):
            cut = list(base)
            for _ in range(edits):
                cut[draw.randrange(size)] = draw.choice("xyz")
            texts.append("".join(cut))
    texts += ["ab" * 300, "ab" * 200, "q"]
    maps = lines._maps(spark.createDataFrame(list(enumerate(texts)), "cid bigint, clean string")).cache()
    pairs = [(i, j) for i in range(len(texts)) for j in range(max(0, i - 4), i)]
    passed = {(r.a, r.b) for r in lines._alike(spark.createDataFrame(pairs, "a bigint, b bigint"), maps).collect()}
    sets = [frozenset(t[k : k + 10] for k in range(max(1, len(t) - 9))) for t in texts]
    links = {(i, j) for i, j in pairs if similar(sets[i], sets[j])}
    assert links and links <= passed and len(passed) < len(pairs)


def test_line_pairs_are_compared_in_generated_code(spark, monkeypatch):
    """A function called shingle by shingle would leave generated code."""
    draw, plans, stash = random.Random(3), [], lines.stash
    texts = ["".join(draw.choice("abcde ") for _ in range(n)) for n in (5, 12, 60, 300)]
    texts += [t[:-1] + "x" for t in texts] + [t + "yz" for t in texts] + [t[::-1] for t in texts]

    def noted(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stash(df, label)

    monkeypatch.setattr(lines, "stash", noted)
    monkeypatch.setattr(lines, "PAIRS", 20)
    pairs = [(i, j) for i in range(len(texts)) for j in range(i)]
    found = lines._verified(
        spark.createDataFrame(pairs, "a bigint, b bigint"), spark.createDataFrame(list(enumerate(texts)), "cid bigint, clean string")
    )
    sets = [frozenset(t[k : k + 10] for k in range(max(1, len(t) - 9))) for t in texts]
    assert {(r.a, r.b) for r in found.collect()} == {(i, j) for i, j in pairs if similar(sets[i], sets[j])}
    assert plans and not any("lambda" in plan for plan in plans)


def test_lines_use_no_python(spark):
    docs = spark.createDataFrame([(1, "a line"), (2, "a line")], "doc_id bigint, text string")
    plan = lines.dedup_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_line_variants_are_compared_once_a_turn(spark, monkeypatch):
    """However many buckets a line meets others in, a turn or round compares one pair of it; no link is lost."""
    draw, compared, verified = random.Random(8), [], lines._verified
    base = [draw.choice("abcdefgh ") for _ in range(140)]
    texts = []
    for _ in range(70):
        cut = list(base)
        for _ in range(draw.randrange(1, 4)):
            cut[draw.randrange(1, 139)] = draw.choice("xyz")
        texts.append("".join(cut))
    monkeypatch.setattr(lines, "PLENTY", 1, raising=False)

    def noted(pairs, texts):
        compared.append(pairs.count())
        return verified(pairs, texts)

    monkeypatch.setattr(lines, "_verified", noted)
    docs = spark.createDataFrame([(0, "\n".join(texts))], "doc_id bigint, text string")
    got = lines.dedup_lines(docs).first().text.split("\n")
    sets = [frozenset(c[k : k + 10] for k in range(max(1, len(c) - 9))) for c in map(clean, texts)]
    groups = Sets(len(texts))
    for i in range(len(sets)):
        for j in range(i):
            if similar(sets[i], sets[j]):
                groups.join(i, j)
    assert got == [x for i, x in enumerate(texts) if groups.find(i) == i]
    assert max(compared) <= len(texts), compared


def test_a_line_in_many_buckets_has_one_pair_a_turn(spark):
    """Each bucket has another leader; comparing a line with all of them cost a pair a bucket."""
    rows = [(100 * b + i * (b + 1) % 8, i, i) for i in range(60) for b in range(7)]
    pairs = lines._starred(spark.createDataFrame(rows, "band bigint, cid bigint, root bigint"), 0).collect()
    buckets = {i: {band for band, cid, _ in rows if cid == i} for i in range(60)}
    assert 30 <= len(pairs) <= 60 and all(r.a > r.b and buckets[r.a] & buckets[r.b] for r in pairs)


def test_few_open_pairs_need_one_turn(spark, monkeypatch):
    """Turns of leaders are for buckets too large to pair; going on for the last links cost a dozen jobs each."""
    draw, turns, starred = random.Random(12), [], lines._starred
    base = [draw.choice("abcdefgh ") for _ in range(140)]
    texts = []
    for _ in range(60):
        cut = list(base)
        for _ in range(draw.randrange(1, 4)):
            cut[draw.randrange(1, 139)] = draw.choice("xyz")
        texts.append("".join(cut))

    def noted(placed, turn):
        turns.append(turn)
        return starred(placed, turn)

    monkeypatch.setattr(lines, "_starred", noted)
    docs = spark.createDataFrame([(0, "\n".join(texts))], "doc_id bigint, text string")
    got = lines.dedup_lines(docs).first().text.split("\n")
    sets = [frozenset(c[k : k + 10] for k in range(max(1, len(c) - 9))) for c in map(clean, texts)]
    groups = Sets(len(texts))
    for i in range(len(sets)):
        for j in range(i):
            if similar(sets[i], sets[j]):
                groups.join(i, j)
    assert got == [x for i, x in enumerate(texts) if groups.find(i) == i]
    assert turns == [0]


@pytest.mark.parametrize("long", [200000, 10])
def test_line_pairs_of_any_length_and_character(spark, monkeypatch, long):
    """Shingles are of UTF-16 units, whether a pair is compared as arrays or, if too long, as rows."""
    draw = random.Random(6)
    texts = ["".join(draw.choice(a) for _ in range(n)) for n in (3, 10, 60, 250) for a in ("ab ", "aé日", "a😀b", "😀😁")]
    texts += [t[:-1] + "x" for t in texts] + [t + t for t in texts]
    monkeypatch.setattr(lines, "LONG", long)
    units = [t.encode("utf-16-be") for t in texts]
    sets = [frozenset(u[2 * k : 2 * k + 20] for k in range(max(1, len(u) // 2 - 9))) for u in units]
    pairs = [(i, j) for i in range(len(texts)) for j in range(i)]
    found = lines._verified(
        spark.createDataFrame(pairs, "a bigint, b bigint"), spark.createDataFrame(list(enumerate(texts)), "cid bigint, clean string")
    )
    assert {(r.a, r.b) for r in found.collect()} == {(i, j) for i, j in pairs if similar(sets[i], sets[j])}


def test_repeated_shingles_make_no_room_for_a_link(spark):
    """Lines that repeat one passage have few distinct shingles, however long they are; their pairs are ruled out."""
    draw = random.Random(7)
    word = lambda n: "".join(draw.choice("abcdefgh") for _ in range(n))
    passage = word(120)
    texts = [passage * 12 + word(150) for _ in range(6)]
    texts += [texts[0] + "xy"]
    bands = [[i * 7 + b for b in range(6)] + [-1] for i in range(len(texts))]
    rows = spark.createDataFrame([(i, t, b) for i, (t, b) in enumerate(zip(texts, bands))], "cid bigint, clean string, bands array<bigint>")
    placed = spark.createDataFrame([(-1, i, i) for i in range(len(texts))], "band bigint, cid bigint, root bigint")
    left = lines._across(placed, lines._maps(rows), rows).collect()
    assert [(r.a, r.b) for r in left] == [(6, 0)]


def test_components_in_one_partition_or_many(spark, monkeypatch):
    from wattfold.llm import components as module

    draw = random.Random(5)
    links = spark.createDataFrame([(draw.randrange(200), draw.randrange(200)) for _ in range(150)], "a bigint, b bigint")
    one = {(r.node, r.root) for r in components(links).collect()}
    monkeypatch.setattr(module, "FEW", 0)
    assert one == {(r.node, r.root) for r in components(links).collect()}
