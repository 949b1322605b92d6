"""Mixing sources to target weights by iterative proportional fitting (operator 1)."""

from __future__ import annotations

import warnings
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattfold.llm.common import stash

ROUNDS = 10  # passes over all marginals
POWER = 0.95  # a category's target share is its token share to this power, normalised
GAP, MOST = 1e-6, 20  # given shares are raked until no sum is further off, at most so many times ROUNDS passes
SALT = "mix-1"
FEW = 20000  # a table of up to so many cells is raked in one partition, without an exchange


def register(text: F.Column) -> F.Column:
    """A topic for texts that carry none: what kind of text it is, by counts over all of it."""
    count = lambda pattern: F.regexp_count(text, F.lit(pattern))
    n = F.char_length(text)
    return (
        F.when(F.coalesce(n, F.lit(0)) == 0, "empty")
        .when(count("[0-9]") * 20 >= n, "figures")
        .when(count("[#$%&*|!]") * 12 >= n, "symbols")
        .when(count("\n") * 80 >= n, "lists")
        .otherwise("prose")
    )


def word_count(text: F.Column) -> F.Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def tempered(cells: DataFrame, by: str, weight: str, power: float = POWER) -> DataFrame:
    """``by, target``: every category's share of the weight to a power, summing to 1."""
    sums = cells.groupBy(by).agg(F.sum(weight).alias("w")).where("w > 0")
    total = sums.agg(F.sum("w")).first()[0]
    powered = sums.withColumn("p", F.pow(F.col("w") / F.lit(float(total or 1)), F.lit(power)))
    norm = powered.agg(F.sum("p")).first()[0]
    return stash(powered.select(by, (F.col("p") / F.lit(float(norm or 1))).alias("target")), "targets")


def given(cells: DataFrame, by: str, weight: str, shares: DataFrame) -> DataFrame:
    """``by, target``: the given ``share`` of every category that has weight, summing to 1.

    A category that is not named, or whose share is null or negative, gets none.
    """
    held = cells.groupBy(by).agg(F.sum(weight).alias("w")).where("w > 0").select(by)
    named = shares.groupBy(by).agg(F.sum(F.greatest(F.col("share").cast("double"), F.lit(0.0))).alias("share"))
    wanted = held.join(named, by, "left").select(by, F.coalesce("share", F.lit(0.0)).alias("share"))
    total, categories = wanted.agg(F.sum("share"), F.count("*")).first()
    if categories and not total > 0:
        raise ValueError(f"no category of {by.strip('_')} that has tokens is given a share")
    return stash(wanted.select(by, (F.col("share") / F.lit(float(total or 1))).alias("target")), "targets")


def largest_gap(fitted: DataFrame, targets: dict[str, DataFrame]) -> float:
    """How far the sum of a category is from its target at most, over all dimensions."""
    gaps = []
    for by, target in targets.items():
        sums = fitted.groupBy(by).agg(F.sum("fitted").alias("__sum"))
        off = target.join(sums, by, "left").agg(F.max(F.abs(F.col("target") - F.coalesce("__sum", F.lit(0.0)))))
        gaps.append(off.first()[0] or 0.0)
    return max(gaps, default=0.0)


def _raked(cells: DataFrame, targets: dict[str, DataFrame], weight: str, rounds: int) -> DataFrame:
    """``rake`` until the targets are reached; it warns with the gap that is left where they contradict each other."""
    fitted = rake(cells, targets, weight, rounds)
    for _ in range(MOST - 1):
        if largest_gap(fitted, targets) <= GAP:
            break
        fitted = rake(fitted.withColumnRenamed("fitted", "__start"), targets, "__start", rounds).drop("__start")
    if (gap := largest_gap(fitted, targets)) > GAP:
        warnings.warn(f"the given shares cannot all be reached; a sum is off by {gap:.3g}", stacklevel=2)
    return fitted


def _together(cells: DataFrame) -> DataFrame:
    """A small table of cells as one partition, so that sums by any dimension need no exchange."""
    return cells.coalesce(1)


def rake(cells: DataFrame, targets: dict[str, DataFrame], weight: str, rounds: int = ROUNDS) -> DataFrame:
    """``cells`` with ``fitted``: weights of the cells whose sums by every dimension reach the targets.

    In each pass the weights of every category are scaled to its target, one dimension
    after the other. Cells are a table however many categories there are: sums are combined
    map-side, scaled by a join, and each pass is written, so no plan grows with the passes.
    Each exchange costs the driver a thread and each broadcast a few MB for a minute or so; a
    table of up to ``FEW`` cells is therefore raked in one partition, by windows.
    """
    few = cells.count() <= FEW
    total = cells.agg(F.sum(weight)).first()[0]
    fitted = stash(cells.withColumn("fitted", F.col(weight) / F.lit(float(total or 1))), "cells")
    if few:
        goals = {by: f"__target{i}" for i, by in enumerate(targets)}
        for by, goal in goals.items():
            wanted = _together(targets[by]).select(by, F.col("target").alias(goal))
            fitted = _together(fitted).join(wanted.hint("merge"), by, "left")
        for _ in range(rounds):
            for by, goal in goals.items():
                share = F.sum("fitted").over(Window.partitionBy(by))
                factor = F.when(share > 0, F.col(goal) / share)
                fitted = _together(fitted).withColumn("fitted", F.col("fitted") * F.coalesce(factor, F.lit(1.0)))
            fitted = stash(fitted, "cells")
        return fitted.drop(*goals.values())
    for _ in range(rounds):
        for by, target in targets.items():
            sums = fitted.groupBy(by).agg(F.sum("fitted").alias("__sum"))
            factor = sums.join(target, by).where("__sum > 0").select(by, (F.col("target") / F.col("__sum")).alias("__factor"))
            fitted = fitted.join(factor, by, "left").withColumn(
                "fitted", F.col("fitted") * F.coalesce("__factor", F.lit(1.0))
            ).drop("__factor")
        fitted = stash(fitted, "cells")
    return fitted


def sampling_rates(
    docs: DataFrame,
    dims: dict[str, F.Column],
    tokens: F.Column,
    power: float = POWER,
    rounds: int = ROUNDS,
    shares: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """A table of cells, keyed by ``dims``, with the probability that a document of the cell is kept.

    Probabilities are the fitted weight over the actual one, scaled so that the most
    wanted cell is kept whole; the expected tokens of the sample then have the target
    shares in every dimension. Categories without tokens keep probability 1. Targets are the
    given ``shares`` (a dimension, ``share``) and, for dimensions without, tempered shares.
    """
    rows = docs.select(*[c.alias(k) for k, c in dims.items()], tokens.alias("tokens"))
    cells = stash(rows.groupBy(*dims).agg(F.sum("tokens").alias("tokens")), "cells")
    cells = _together(cells) if cells.count() <= FEW else cells
    shares = shares or {}
    targets = {
        k: given(cells, k, "tokens", shares[k]) if k in shares else tempered(cells, k, "tokens", power) for k in dims
    }
    fitted = (_raked if shares else rake)(cells, targets, "tokens", rounds)
    fitted = _together(fitted) if fitted.count() <= FEW else fitted
    ratio = fitted.withColumn("ratio", F.when(F.col("tokens") > 0, F.col("fitted") / F.col("tokens")))
    most = ratio.agg(F.max("ratio")).first()[0]
    share = F.col("ratio") / F.lit(float(most or 1))
    return stash(ratio.select(*dims, F.coalesce(share, F.lit(1.0)).alias("probability")), "rates")


def draw(key: F.Column, salt: str = SALT) -> F.Column:
    """A number in [0, 1) that depends on the key alone, so a repeated task draws it again."""
    digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f"/{salt}")).cast("binary"))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(2**48))


def _category(column: str) -> F.Column:
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit("none"))


def dimensions(docs: DataFrame) -> dict[str, F.Column]:
    """Source, language and topic as categories; null is one of its own."""
    return {"__source": _category("source"), "__lang": _category("lang"), "__topic": register(F.col("text"))}


def mix(
    docs: DataFrame,
    power: float = POWER,
    rounds: int = ROUNDS,
    id_col: str = "doc_id",
    shares: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """``docs`` with ``topic``, ``tokens``, ``probability`` and ``kept``.

    Token weights (words of the whole text) are raked to tempered shares of source, language and
    topic, and each document is kept or not by its cell's probability and a draw from its
    id. Rates are a table of cells; Spark broadcasts it if its files are small enough
    and otherwise splits hot cells of the join. No row is lost; select ``kept`` for the
    sample. Null categories are a category; null and empty texts have no tokens. Repeated
    ids share one draw. Columns of the new names are replaced.

    ``shares`` gives the token shares to reach: for ``source``, ``lang`` or ``topic`` a table with that
    column and ``share``. They need not sum to 1; documents of categories not named are not kept.
    """
    dims = dimensions(docs)
    if unknown := set(shares or {}) - {"source", "lang", "topic"}:
        raise ValueError(f"no such dimension: {', '.join(sorted(unknown))}")
    keyed = {
        f"__{k}": t.select((F.col(k) if k == "topic" else _category(k)).alias(f"__{k}"), "share")
        for k, t in (shares or {}).items()
    }
    rates = sampling_rates(docs, dims, word_count(F.col("text")), power, rounds, keyed)
    made = ("topic", "tokens", "probability", "kept")
    rows = docs.select(
        *[F.col(f"`{c}`") for c in docs.columns if c not in made],
        *[c.alias(k) for k, c in dims.items()],
        word_count(F.col("text")).alias("tokens"),
    )
    rated = rows.join(rates, list(dims), "left").withColumnRenamed("__topic", "topic")
    return rated.withColumn("kept", draw(F.col(f"`{id_col}`")) < F.col("probability")).drop("__source", "__lang")


def mix_sql(power: float = POWER, rounds: int = ROUNDS) -> str:
    """The same in DuckDB SQL, pass by pass."""
    dims = ("source_", "lang_", "topic")
    steps = [
        """d AS (
  SELECT doc_id, coalesce('=' || source, 'none') AS source_, coalesce('=' || lang, 'none') AS lang_,
    CASE WHEN coalesce(length(text), 0) = 0 THEN 'empty'
         WHEN len(regexp_extract_all(text, '[0-9]')) * 20 >= length(text) THEN 'figures'
         WHEN len(regexp_extract_all(text, '[#$%&*|!]')) * 12 >= length(text) THEN 'symbols'
         WHEN len(regexp_extract_all(text, '\\n')) * 80 >= length(text) THEN 'lists'
         ELSE 'prose' END AS topic,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS tokens
  FROM documents
)""",
        "c0 AS (SELECT source_, lang_, topic, sum(tokens)::DOUBLE AS tokens, "
        "sum(tokens)::DOUBLE / (SELECT sum(tokens) FROM d) AS fitted FROM d GROUP BY ALL)",
    ]
    for by in dims:
        steps.append(
            f"s_{by} AS (SELECT {by}, power(sum(tokens) / (SELECT sum(tokens) FROM c0), {power}) AS p "
            f"FROM c0 GROUP BY {by} HAVING sum(tokens) > 0)"
        )
        steps.append(f"t_{by} AS (SELECT {by}, p / (SELECT sum(p) FROM s_{by}) AS target FROM s_{by})")
    step = 0
    for _ in range(rounds):
        for by in dims:
            steps.append(
                f"c{step + 1} AS (SELECT source_, lang_, topic, tokens, fitted * coalesce(target / "
                f"nullif(sum(fitted) OVER (PARTITION BY {by}), 0), 1) AS fitted "
                f"FROM c{step} LEFT JOIN t_{by} USING ({by}))"
            )
            step += 1
    return (
        "WITH "
        + ",\n".join(f"{s.split(' AS ', 1)[0]} AS MATERIALIZED {s.split(' AS ', 1)[1]}" for s in steps)
        + f""", r AS (
  SELECT *, fitted / nullif(tokens, 0) / (SELECT max(fitted / nullif(tokens, 0)) FROM c{step}) AS ratio FROM c{step}
)
SELECT doc_id, topic, d.tokens::BIGINT AS tokens, round(coalesce(ratio, 1), 6) AS probability,
  ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '/{SALT}'), 1, 12))::BIGINT / 2.0 ** 48
    < coalesce(ratio, 1) AS kept
FROM d JOIN r USING (source_, lang_, topic)"""
    )
