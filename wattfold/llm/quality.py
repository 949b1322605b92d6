"""Quality rules whose cutoffs are certified on labelled documents (operator 13)."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattfold.llm.common import stash
from wattfold.llm.words import PLAIN, pieces

SPAN = 8  # words of a window that must not come back
FEWEST_WORDS, MOST_REPEATED = 20, 30  # base rule: at least so many words, at most that percentage in repeated windows
SYMBOLS = b"#*$%&|<>"
RISK = 0.05  # share of a stratum's good documents that the rules together may reject
DOUBT = 0.05  # chance that the risk is exceeded in any stratum at all
AT_ONCE = 1 << 20  # words whose windows are compared at a time, unless one text has more

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")

# Each rule's value is an integer; a document is rejected above the cutoff. The cutoffs to
# be tested are fixed beforehand, from lenient to strict.
RULES = {
    # symbols a thousand words
    "symbols": ("(1000 * n_symbols) div nullif(n_words, 0)", (2000, 1000, 500, 300, 200, 100, 50, 20, 10, 5)),
    # code points a hundred words
    "word_length": ("(100 * word_chars) div nullif(n_words, 0)", (1500, 1200, 1000, 900, 850, 800, 750, 700, 675, 650)),
    # lines seen before, of a thousand
    "dup_lines": ("(1000 * n_dup_lines) div nullif(n_lines, 0)", (700, 600, 500, 450, 400, 350, 300, 250, 200, 150)),
    # words in repeated windows, of a thousand
    "repeats": ("(1000 * n_repeat_words) div nullif(n_words, 0)", (300, 275, 250, 225, 200, 175, 150, 125, 100, 75)),
}


def _words_in_repeats(ids: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Which words of texts laid end to end lie in a window that its text holds twice or more."""
    inside = np.zeros(len(ids) + 1, np.int64)
    if len(ids) >= SPAN:
        starts = np.flatnonzero(text[: len(ids) - SPAN + 1] == text[SPAN - 1 :])
        mixed = text[starts].astype(np.uint64) + np.uint64(1)
        for j in range(SPAN):
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + ids[starts + j].astype(np.uint64)
        mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
        ordered = np.sort(mixed)
        again = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        maybe = starts[again[np.minimum(np.searchsorted(again, mixed), len(again) - 1)] == mixed] if len(again) else starts[:0]
        # The hash only proposes; the windows themselves decide.
        whole = np.column_stack([text[maybe], *[ids[maybe + j] for j in range(SPAN)]])
        _, of, seen = np.unique(whole, axis=0, return_inverse=True, return_counts=True)
        found = maybe[seen[of.reshape(-1)] > 1]
        np.add.at(inside, found, 1)
        np.add.at(inside, found + SPAN, -1)
    return np.cumsum(inside[:-1]) > 0


def _measured(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The measures of some texts (UTF-8)."""
    known: dict[bytes, int] = {}
    ids, n_words, chars, symbols, dups, lines = [], [], [], [], [], []
    for text in texts:
        before = len(ids)
        for words in pieces(text, PLAIN):
            ids += [known.setdefault(w, len(known)) for w in words]
        n_words.append(len(ids) - before)
        chars.append(len(text.translate(None, _NO_CHARS)))
        symbols.append(len(text) - len(text.translate(None, SYMBOLS)))
        worded = [line for line in text.split(b"\n") if line.strip()]
        lines.append(len(worded))
        dups.append(len(worded) - len(set(worded)))
    text_of = np.repeat(np.arange(len(texts)), n_words)
    repeats = np.bincount(text_of, weights=_words_in_repeats(np.array(ids, np.int64), text_of), minlength=len(texts))
    return dict(zip(MEASURES, (n_words, chars, symbols, dups, repeats.astype(np.int64), lines)))


# Bytes that begin no code point of a word: white space, and what follows a first byte in UTF-8.
_NO_CHARS = bytes([0x20, *range(0x09, 0x0E), *range(0x80, 0xC0)])


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` (text dropped) with ``MEASURES`` of every whole text, as longs.

    Words are runs of characters other than space and tab to carriage return; a null text has none.
    Lines count if they hold a word. Columns called like a measure are replaced.
    """
    keep = [c for c in docs.columns if c not in (text_col, *MEASURES)]
    schema = T.StructType([docs.schema[c] for c in keep])
    for name in MEASURES:
        schema = schema.add(name, T.LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, a, size = batch.column(len(keep)), 0, 0
            for i, text in enumerate(column):
                size += len(text.as_py() or b"")
                if size < AT_ONCE * 6 and i + 1 < len(column):
                    continue
                part = batch.slice(a, i + 1 - a)
                found = _measured([t or b"" for t in part.column(len(keep)).to_pylist()])
                arrays = [*part.columns[:-1], *[pa.array(found[m], pa.int64()) for m in MEASURES]]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)
                a, size = i + 1, 0

    return docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").cast("binary").alias("__text")).mapInArrow(
        run, schema
    )


def base_failed() -> Column:
    return (F.col("n_words") < FEWEST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) of n draws with chance p: what a true risk above p makes of k rejections or fewer, at most."""
    if k >= n:
        return 1.0
    if k >= n * p:
        return 1.0  # a bound; only small tails matter
    i = np.arange(k, max(-1, k - 40 - int(20 * math.sqrt(n * p))), -1)
    # From k downwards terms shrink; those left out weigh nothing.
    first = math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    ratios = i[:-1] / (n - i[:-1] + 1) * ((1 - p) / p)
    return float(min(1.0, math.exp(first) * (1 + np.cumprod(ratios).sum())))


def _certified(strata: int, risk: float, doubt: float):
    """Per stratum: each rule's strictest cutoff that its own and all more lenient tests support."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = {"stratum": batch["stratum"], "n_good": batch["n_good"]}
            for rule, (_, grid) in RULES.items():
                chosen = []
                for row in batch.itertuples():
                    cut = None
                    for at, cutoff in enumerate(grid):
                        lost = getattr(row, f"{rule}_{at}")
                        if binomial_tail(lost, row.n_good, risk / len(RULES)) > doubt / (strata * len(RULES)):
                            break
                        cut = cutoff
                    chosen.append(cut)
                out[rule] = pd.array(chosen, "Int64")
            yield pd.DataFrame(out)

    return run


def cutoffs(
    measured: DataFrame, labels: DataFrame, id_col: str = "doc_id", stratum_col: str = "lang",
    risk: float = RISK, doubt: float = DOUBT,
) -> DataFrame:
    """``stratum, n_good`` and a cutoff per rule, null where none is certified.

    The holdout is every document labelled good (``quality`` 1 in all its labels) that
    passes the base rule. For a cutoff that would reject k of a stratum's n holdout
    documents, the exact binomial tail P(X <= k) at the allowed risk is the p-value of
    "the false rejection rate is higher". Within a rule cutoffs are tested from lenient to
    strict until one fails, which needs no correction; over rules and strata the doubt is
    divided by their number (Bonferroni). Each rule gets an equal part of the risk, so
    together they reject at most ``risk`` of any stratum's good documents, with a
    confidence of 1 - ``doubt``.
    """
    known = labels.where(F.col("quality").isNotNull() & F.col(id_col).isNotNull())
    good = known.groupBy(F.col(id_col).alias("__id")).agg(F.min("quality").alias("q")).where("q = 1")
    held = measured.where(~base_failed()).join(good, F.col(f"`{id_col}`") == F.col("__id"), "left_semi")
    losses = [
        F.sum((F.expr(value) > cutoff).cast("int")).alias(f"{rule}_{at}")
        for rule, (value, grid) in RULES.items()
        for at, cutoff in enumerate(grid)
    ]
    counted = stash(held.groupBy(F.col(f"`{stratum_col}`").alias("stratum")).agg(F.count("*").alias("n_good"), *losses), "losses")
    schema = T.StructType([counted.schema["stratum"], counted.schema["n_good"]])
    for rule in RULES:
        schema = schema.add(rule, T.LongType())
    return counted.mapInPandas(_certified(max(1, counted.count()), risk, doubt), schema)


def judge(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang"
) -> DataFrame:
    """``docs`` (text dropped) with the measures, ``base_failed`` and ``kept``.

    A document goes if it fails the base rule or exceeds a cutoff certified for its stratum;
    in strata without enough labelled documents no rule is certified and none applies. A
    null stratum is one of its own. Null and empty texts fail the base rule. Rows of an id are judged each by
    its own text; all of them count as labelled. Without documents or labels nothing but the
    base rule applies. Columns called like an output are replaced.
    """
    outputs = [c for c in (*MEASURES, "base_failed", "kept") if c in docs.columns]
    measured = stash(measure(docs.drop(*outputs), text_col), "measured")
    chosen = cutoffs(measured, labels, id_col, stratum_col).select(
        F.col("stratum").alias("__stratum"), *[F.col(r).alias(f"__{r}") for r in RULES]
    )
    rejected = F.lit(False)
    for rule, (value, _) in RULES.items():
        rejected = rejected | F.coalesce(F.expr(f"{value} > __{rule}"), F.lit(False))
    marked = measured.join(chosen, F.col(f"`{stratum_col}`").eqNullSafe(F.col("__stratum")), "left")
    return marked.select(
        *[F.col(f"`{c}`") for c in measured.columns],
        base_failed().alias("base_failed"),
        (~(base_failed() | rejected)).alias("kept"),
    )


def sql() -> str:
    """The same for DuckDB: windows as lists of words, tails summed term by term."""
    risk, doubt = RISK / len(RULES), DOUBT / len(RULES)
    grid = " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, {at} AS step, {cut} AS cutoff" for rule, (_, cuts) in RULES.items() for at, cut in enumerate(cuts)
    )
    values = " UNION ALL ".join(
        f"SELECT doc_id, lang, '{rule}' AS rule, {value.replace('div', '//')} AS v FROM base WHERE NOT base_failed"
        for rule, (value, _) in RULES.items()
    )
    word = r"[^\x20\x09-\x0D]+"
    return f"""
WITH texts AS (
  SELECT doc_id, lang, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{word}') AS w FROM documents
), windows AS (
  SELECT doc_id, i, list_slice(w, i, i + {SPAN - 1}) AS g FROM (
    SELECT doc_id, w, unnest(range(1, len(w) - {SPAN - 2})) AS i FROM texts WHERE len(w) >= {SPAN})
), doubled AS (
  SELECT doc_id, unnest(spots) AS i FROM (
    SELECT doc_id, list(i) AS spots FROM windows GROUP BY doc_id, g HAVING count(*) > 1)
), repeats AS (
  SELECT doc_id, count(DISTINCT i + j) AS n FROM doubled, range(0, {SPAN}) AS r(j) GROUP BY doc_id
), lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS dups FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM texts)
  WHERE regexp_matches(line, '{word}') GROUP BY doc_id
), base AS (
  SELECT doc_id, lang, len(w)::BIGINT AS n_words, coalesce(length(array_to_string(w, '')), 0)::BIGINT AS word_chars,
         (length(text) - length(translate(text, '{SYMBOLS.decode()}', '')))::BIGINT AS n_symbols,
         coalesce(dups, 0)::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
         coalesce(n_lines, 0)::BIGINT AS n_lines,
         len(w) < {FEWEST_WORDS} OR 100 * coalesce(n, 0) > {MOST_REPEATED} * len(w) AS base_failed
  FROM texts LEFT JOIN repeats USING (doc_id) LEFT JOIN lines USING (doc_id)
), rules AS ({grid}
), scores AS ({values}
), good AS (
  SELECT doc_id FROM labels WHERE quality IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1
), losses AS (
  SELECT lang, rule, step, cutoff, count(*) AS n, count(*) FILTER (v > cutoff) AS k
  FROM scores JOIN good USING (doc_id) JOIN rules USING (rule) GROUP BY ALL
), tests AS (
  SELECT *, k < n * {risk} AND list_sum(list_transform(range(0, k + 1), lambda i: exp(
      lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)
      + i * ln({risk}) + (n - i) * ln(1 - {risk}))))
    <= {doubt} / (SELECT count(DISTINCT lang) FROM losses) AS fine
  FROM losses
), chosen AS (
  SELECT lang, rule, min(cutoff) AS cutoff FROM (
    SELECT *, bool_and(fine) OVER (PARTITION BY lang, rule ORDER BY step) AS so_far FROM tests)
  WHERE so_far GROUP BY lang, rule
), rejected AS (
  SELECT DISTINCT doc_id FROM scores JOIN chosen USING (lang, rule) WHERE v > cutoff
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND rejected.doc_id IS NULL AS kept
FROM base LEFT JOIN rejected USING (doc_id)
"""
