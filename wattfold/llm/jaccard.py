"""Exact n-gram Jaccard join as a blocked sparse product (operator 10)."""

from __future__ import annotations

import string

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattfold.llm.common import stash
from wattfold.llm.components import components, merged

SHINGLE = 5
PERCENT = 80  # two sets link when 100 * intersection >= PERCENT * union
COMMON = 32  # an n-gram in more windows than this is left to the second product
LEADERS = 2  # rounds in which a column's rows are compared with one of them
MAP_WORDS = 16  # 64-bit words of a row's map of columns
FILTER_WORDS = 1 << 17  # 64-bit words of the broadcast filter: 1 MB at most


def shingle_sets(docs: DataFrame, text_col: str = "text", width: int = SHINGLE) -> DataFrame:
    """``docs`` (text dropped) with ``grams``, the sorted set of hashed word n-grams.

    Words are runs of characters other than space and tab to carriage return, with A-Z in lower
    case. A text of fewer words is one n-gram; a null text or one without words has none.
    """
    upper = string.ascii_uppercase
    text = F.translate(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), upper, upper.lower())
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    words = docs.withColumn("__words", F.transform(words, lambda w: F.xxhash64(w)))
    # Items beyond the end are null and leave a hash as it is.
    grams = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size("__words") - width, F.lit(0))),
        lambda i: F.xxhash64(*[F.get("__words", i + j) for j in range(width)]),
    )
    made = words.withColumn("__grams", F.when(F.size("__words") > 0, grams).otherwise(F.expr("array()")))
    return made.withColumn("grams", F.sort_array(F.array_distinct("__grams"))).drop(
        "__words", "__grams", text_col
    )


def _keyed(sets: DataFrame) -> DataFrame:
    """With ``n`` and two hashes that stand for the set."""
    return sets.select(
        "*",
        F.size("grams").alias("n"),
        F.xxhash64("grams").alias("s1"),
        F.xxhash64(F.lit("second"), "grams").alias("s2"),
    )


def _prefix(n) -> F.Column:
    """How many of a set's n-grams, in any order all sets share, a similar set must hit at least once."""
    return n - F.ceil(n * PERCENT / 100) + 1


def _similar(overlap) -> F.Column:
    """Whether this overlap, of sets of ``n_a`` and ``n_b``, suffices."""
    return 100 * overlap >= PERCENT * (F.col("n_a") + F.col("n_b") - overlap)


def _sizes_fit() -> F.Column:
    return 100 * F.least("n_a", "n_b") >= PERCENT * F.greatest("n_a", "n_b")


def _maps(sets: DataFrame) -> DataFrame:
    """``cid, w0, w1, ...``: the bits that a row's columns set."""
    rows = sets.select("cid", F.explode("grams").alias("gram"))
    word, bit = F.expr(f"pmod(shiftright(gram, 6), {MAP_WORDS})"), F.expr("shiftleft(1L, cast(gram & 63 as int))")
    bits = [F.bit_or(F.when(word == i, bit).otherwise(F.lit(0).cast("bigint"))).alias(f"w{i}") for i in range(MAP_WORDS)]
    return rows.groupBy("cid").agg(*bits)


def _may_link() -> F.Column:
    """Whether two rows' maps leave room for a link, also if one has none; no link is lost by it.

    Similar rows differ in at most a share of their sizes' sum, and maps that differ in more
    bits prove that the rows differ in more columns.
    """
    apart = sum(F.bit_count(F.col(f"w{i}_a").bitwiseXOR(F.col(f"w{i}_b"))) for i in range(MAP_WORDS))
    return F.coalesce(apart * (100 + PERCENT) <= (F.col("n_a") + F.col("n_b")) * (100 - PERCENT), F.lit(True))


def _side(rows: DataFrame, side: str) -> DataFrame:
    return rows.select(*[F.col(c).alias(c if c == "gram" else f"{c}_{side}") for c in rows.columns])


def _sets_of(docs: DataFrame, wanted: DataFrame, text_col: str) -> DataFrame:
    """``cid, n, grams`` (whole sets) of the wanted classes.

    The texts are scanned again; a filter of bits over text hashes, of fixed size, lets
    only texts of wanted classes through (and, once it fills up, some more), so neither
    text nor other sets are shuffled. One set per class and task leaves a task.
    """
    spot = F.pmod(F.col("probe"), F.lit(FILTER_WORDS * 64))
    bits = wanted.select(
        F.floor(spot / 64).cast("int").alias("__word"), F.expr(f"shiftleft(1L, cast(pmod(probe, {FILTER_WORDS * 64}) % 64 as int))").alias("bit")
    ).groupBy("__word").agg(F.bit_or("bit").alias("__bits"))
    probe = F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    texts = docs.select(F.col(f"`{text_col}`").alias("text"), probe.alias("probe")).withColumn(
        "__word", F.floor(spot / 64).cast("int")
    )
    passed = texts.join(F.broadcast(bits), "__word").where(
        F.expr(f"getbit(__bits, cast(pmod(probe, {FILTER_WORDS * 64}) % 64 as int)) = 1")
    )
    found = _keyed(shingle_sets(passed.select("text"), "text"))
    found = found.groupBy("s1", "s2").agg(F.first("n").alias("n"), F.first("grams").alias("grams"))
    return found.join(wanted.select("s1", "s2", "cid"), ["s1", "s2"]).select("cid", "n", "grams")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The candidate pairs whose whole sets overlap enough: the product under a mask."""
    arrays = sets.select("cid", "grams")
    both = pairs.join(_side(arrays, "a"), F.col("a") == F.col("cid_a")).join(
        _side(arrays, "b"), F.col("b") == F.col("cid_b")
    )
    overlap = F.size(F.array_intersect("grams_a", "grams_b"))
    return both.where(_similar(overlap)).select("a", "b")


def link_classes(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Classes of documents with equal sets (``s1, s2, n, cid``), and the roots of linked ones.

    The matrix has a row per distinct set and a column per n-gram. Column order is by hash,
    common columns last. Each row contributes its window: a tenth more than the first columns
    that a similar row must hit. A first product runs over window columns with up to
    ``COMMON`` entries: overlaps are summed per pair, and a pair goes on only if, with
    everything outside the window of the row whose window ends first, the sum could still
    reach the size-derived bound. Pairs left are checked on their whole rows.

    Rows with too few such columns (members of large groups of near copies, texts made of
    passages that many share) are expanded in full and take the first columns of the common
    order. A second product pairs them column by column with one leader each, joins what
    is similar, and then tests all pairs whose components still differ, unless bit maps of their
    columns prove that they are no link. So a large group costs about its size, while no
    link between components is lost.
    """
    window = lambda n: _prefix(n) + F.ceil(n * 0.05) + 2
    sets = _keyed(shingle_sets(docs.select(F.col(f"`{text_col}`").alias("text"), F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("probe")), "text"))
    windows = sets.select(
        "s1", "s2", "n", "probe", F.slice("grams", F.lit(1), window(F.col("n")).cast("int")).alias("grams")
    )
    classes = windows.groupBy("s1", "s2").agg(
        F.first("n").alias("n"), F.first("probe").alias("probe"), F.first("grams").alias("grams")
    )
    # Only what is stored is filtered: a filter pushed below would work sets out once more.
    classes = stash(classes.withColumn("cid", F.monotonically_increasing_id()), "classes").where("n > 0")
    # One exchange by column gives its number of entries; columns of one row are done with.
    entries = classes.select(F.explode("grams").alias("gram"), "cid", "n")
    counted = entries.withColumn("rows", F.expr("count(*) over (partition by gram)"))
    shared = stash(counted.where(F.col("rows") > 1), "columns")
    common = shared.where(F.col("rows") > COMMON)
    light_rows = shared.where(F.col("rows") <= COMMON)

    heavy = common.groupBy("cid").agg(F.count("*").alias("heavy"))
    info = classes.select("cid", "s1", "s2", "n", "probe", F.size("grams").alias("held"), F.element_at("grams", -1).alias("last"))
    info = info.join(heavy, "cid", "left").withColumn("light", F.col("held") - F.coalesce("heavy", F.lit(0)))
    info = stash(info.withColumn("full", F.col("light") < _prefix(F.col("n"))), "rows")

    sums = (
        _side(light_rows.drop("rows"), "a")
        .join(_side(light_rows.drop("rows"), "b"), "gram")
        .where((F.col("cid_a") < F.col("cid_b")) & _sizes_fit())
        .groupBy("cid_a", "cid_b", "n_a", "n_b")
        .agg(F.count("*").alias("k"))
    )
    ends = info.select("cid", "last", "light")
    bounded = sums.join(_side(ends, "a"), "cid_a").join(_side(ends, "b"), "cid_b")
    rest = F.when(F.col("last_a") <= F.col("last_b"), F.col("n_a") - F.col("light_a")).otherwise(
        F.col("n_b") - F.col("light_b")
    )
    first_pairs = bounded.where(_similar(F.col("k") + rest)).select(
        F.col("cid_a").alias("a"), F.col("cid_b").alias("b"), "n_a", "n_b"
    )
    first_pairs = stash(first_pairs, "pairs")
    in_pairs = first_pairs.select("a").union(first_pairs.select("b")).distinct()
    wanted = info.join(in_pairs, info["cid"] == in_pairs["a"], "left_semi").union(info.where("full")).distinct()
    whole = stash(_sets_of(docs, wanted, text_col), "whole-rows")
    roots = stash(components(_verified(first_pairs, whole)), "roots")

    full = info.where("full").select("cid")
    if full.isEmpty():
        return info, roots
    return info, _second_product(docs, text_col, info, entries, common, first_pairs, whole, roots)


def _second_product(docs, text_col, info, entries, common, first_pairs, whole, roots) -> DataFrame:
    """``roots`` after the links that full rows take part in."""
    full = info.where("full").select("cid")
    # How common a column is, now counting full rows whole; ``frozen`` orders all rows alike.
    expanded = whole.join(full, "cid", "left_semi").select("cid", "n", F.explode("grams").alias("gram"))
    frequency = (
        expanded.groupBy("gram").agg(F.count("*").alias("f"))
        .union(common.select("gram", F.col("rows").alias("f")).distinct())
        .groupBy("gram").agg(F.sum("f").alias("f")).where(F.col("f") > COMMON)
    )
    frozen = stash(frequency, "common-columns")
    others = entries.join(full, "cid", "left_anti").join(frozen, "gram", "left_anti").select("gram", "cid", "n")
    enough = others.groupBy("cid").agg(F.count("*").alias("left"))
    late = info.where("not full").join(enough, "cid", "left").where(
        F.coalesce("left", F.lit(0)) < _prefix(F.col("n"))
    )
    late = stash(late.select(*info.columns), "late-rows")
    if not late.isEmpty():
        fresh = late.join(whole, "cid", "left_anti")
        whole = stash(whole.union(_sets_of(docs, fresh, text_col)), "whole-rows")
    full = stash(full.union(late.select("cid")), "full-rows")
    expanded = whole.join(full, "cid", "left_semi").select("cid", "n", F.explode("grams").alias("gram"))
    place = F.sort_array(F.collect_list(F.struct(F.coalesce("f", F.lit(0)).alias("f"), "gram")))
    ordered = expanded.join(frozen, "gram", "left").groupBy("cid", "n").agg(place.alias("all"))
    firsts = ordered.select(
        F.posexplode(F.slice("all", F.lit(1), _prefix(F.col("n")).cast("int"))).alias("place", "x"), "cid", "n"
    ).select(F.col("x.gram").alias("gram"), "cid", "n", F.lit(True).alias("full"), "place")
    # Other rows take part where their windows hold uncommon columns of full ones.
    others = others.join(full, "cid", "left_anti").join(firsts.select("gram").distinct(), "gram", "left_semi")
    columns = firsts.unionByName(others.withColumns({"full": F.lit(False), "place": F.lit(0)}))
    columns = stash(columns.withColumn("met", F.expr("count(*) over (partition by gram)")).where("met > 1").drop("met"), "full-columns")

    def tested(pairs: DataFrame, done: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Similar ones of the pairs not yet tested, and all pairs tested by now."""
        fresh = pairs.where((F.col("a") != F.col("b")) & _sizes_fit()).select(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "n_a", "n_b"
        )
        fresh = stash(fresh.distinct().join(done, ["a", "b"], "left_anti"), "more-pairs")
        missing = fresh.select("a").union(fresh.select("b")).distinct()
        missing = stash(missing.join(whole, missing["a"] == whole["cid"], "left_anti"), "missing")
        sets = whole
        if not missing.isEmpty():
            more = info.join(missing, info["cid"] == missing["a"], "left_semi")
            sets = whole.union(stash(_sets_of(docs, more, text_col), "whole-rows"))
        return _verified(fresh, sets), done.union(fresh.select("a", "b"))

    done = first_pairs.select("a", "b")
    placed = columns.withColumn("root", F.col("cid"))
    for turn in range(LEADERS + 1):
        placed = columns.join(roots, columns["cid"] == roots["node"], "left").select(
            "gram", "cid", "n", "full", "place", F.coalesce("root", "cid").alias("root")
        )
        mixed = placed.groupBy("gram").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi")
        placed = stash(placed.join(mixed, "gram", "left_semi"), "mixed-columns")
        if turn == LEADERS or placed.isEmpty():
            break
        first = F.struct(~F.col("full"), F.xxhash64("cid", F.lit(turn)))
        leaders = placed.groupBy("gram").agg(F.min_by(F.struct("cid", "n", "root"), first).alias("lead"))
        star = placed.join(leaders, "gram").where(F.col("root") != F.col("lead.root")).select(
            F.col("cid").alias("a"), F.col("lead.cid").alias("b"), F.col("n").alias("n_a"), F.col("lead.n").alias("n_b")
        )
        found, done = tested(star, done)
        found = stash(found, "links")
        if found.isEmpty():
            break
        roots = merged(roots, found)
    # Similar rows meet in the first column they share, and before it neither has one of the other's.
    most = F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b"))
    # Maps are compared inside the join, so only pairs worth a look at their whole rows leave it.
    mapped = placed.join(_maps(whole.join(full, "cid", "left_semi")), "cid", "left")
    mapped = stash(mapped, "mapped-columns")
    cross = (
        _side(mapped.where("full"), "a")
        .join(_side(mapped, "b"), "gram")
        .where((F.col("root_a") != F.col("root_b")) & _sizes_fit() & _similar(most) & _may_link())
        .select(F.col("cid_a").alias("a"), F.col("cid_b").alias("b"), "n_a", "n_b")
    )
    found = stash(tested(cross, done)[0], "links")
    return roots if found.isEmpty() else merged(roots, found)


def join_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` (text dropped) with ``n_shingles`` and ``component_id``.

    ``component_id`` is the least id that links reach, counting documents with equal sets as linked.
    Documents without words are linked with nothing and keep their own id. Null ids are
    never least; a component of nothing else has a null id. Repeated rows are kept, other
    columns pass.
    """
    keep = [c for c in docs.columns if c not in (text_col, "n_shingles", "component_id")]
    rows, named = _named(docs, id_col, text_col, keep)
    out = rows.join(named, ["s1", "s2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col(f"__k{keep.index(id_col)}"))
    return out.select(
        *[F.col(f"__k{i}").alias(c) for i, c in enumerate(keep)],
        F.col("n_shingles").cast("bigint").alias("n_shingles"),
        component.alias("component_id"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without links, those without words, and of each component the one with the least id.

    Of rows with that same id one stays; a component whose ids are all null keeps one row.
    """
    marked = stash(docs.withColumn("__row", F.monotonically_increasing_id()), "rows")
    rows, named = _named(marked, id_col, text_col, [id_col, "__row"])
    ranked = rows.where("n_shingles > 0").join(named, ["s1", "s2"])
    first = F.struct(F.col("__k0").isNull().alias("none"), F.col("__k0").alias("id"), F.col("__k1").alias("__row"))
    kept = ranked.groupBy("root").agg(F.min(first).alias("first")).select(F.col("first.__row").alias("__row"))
    kept = stash(kept.union(rows.where("n_shingles = 0").select(F.col("__k1").alias("__row"))), "kept-rows")
    return marked.join(kept, "__row", "left_semi").drop("__row")


def _named(docs: DataFrame, id_col: str, text_col: str, keep: list[str]) -> tuple[DataFrame, DataFrame]:
    """Each row's set (``keep`` as __k0, __k1, ...), and each set's component with its least id."""
    kept = [F.col(f"`{c}`").alias(f"__k{i}") for i, c in enumerate(keep)]
    sets = _keyed(shingle_sets(docs.select(*kept, F.col(f"`{text_col}`").alias("__text")), "__text"))
    names = [f"__k{i}" for i in range(len(keep))]
    rows = stash(sets.select(*names, F.col("n").alias("n_shingles"), "s1", "s2"), "documents")
    info, roots = link_classes(docs, text_col)
    own = F.col(f"__k{keep.index(id_col)}")
    least = rows.where("n_shingles > 0").groupBy("s1", "s2").agg(F.min(own).alias("own"))
    named = least.join(info.select("s1", "s2", "cid"), ["s1", "s2"])
    named = named.join(roots, named["cid"] == roots["node"], "left").withColumn("root", F.coalesce("root", "cid"))
    ids = named.groupBy("root").agg(F.min("own").alias("least"))
    return rows, named.join(ids, "root").select("s1", "s2", "root", "least")
