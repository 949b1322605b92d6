"""Token counts behind a cache keyed by content digest and tokenizer version (operator 9)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattfold.llm import tokens
from wattfold.llm.common import TOKENIZER, text_digest

CACHE = "digest binary, tokenizer string, n_tokens bigint"


def read_cache(spark, path: str) -> DataFrame:
    """The stored counts; an unused folder is an empty cache."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not files.exists(folder):
        return spark.createDataFrame([], CACHE)
    return spark.read.schema(CACHE).parquet(path)


def count_tokens(
    docs: DataFrame, cache: str, tokenizer: str = TOKENIZER, text_col: str = "text"
) -> DataFrame:
    """``docs`` (text column dropped) with ``n_bytes`` and ``n_tokens``; fills the cache at ``cache``.

    Every row gets a digest of its content, normalised as far as the tokenizer itself does
    it (these vocabularies: not at all; null counts as empty). Digests unknown to the cache
    under this tokenizer version are encoded once each, over the whole text, and appended.
    All rows then join their counts by digest, so copies cost one encoding however many
    there are: map-side aggregation keeps one text per digest and task before the shuffle.

    Nulls: a null text has 0 bytes and 0 tokens. Repeated rows are kept. Other columns pass.
    """
    spark, made = docs.sparkSession, tokens.version(tokenizer)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    misses = (
        docs.select(text.alias("text"), text_digest(text).alias("digest"))
        .groupBy("digest")
        .agg(F.first("text").alias("text"))
        .join(read_cache(spark, cache).where(F.col("tokenizer") == made), "digest", "left_anti")
    )

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoded = tokens.encoder(tokenizer)
        for pdf in batches:
            counts = [len(ids) for ids in encoded(pdf["text"].tolist())]
            yield pd.DataFrame({"digest": pdf["digest"], "tokenizer": made, "n_tokens": counts})

    misses.mapInPandas(encode, CACHE).write.mode("append").parquet(cache)
    known = (
        read_cache(spark, cache)
        .where(F.col("tokenizer") == made)
        .groupBy(F.col("digest").alias("__digest"))  # two jobs may have appended the same text
        .agg(F.first("n_tokens").alias("n_tokens"))
    )
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in (text_col, "n_bytes", "n_tokens")]
    keyed = docs.select(
        *rest, F.octet_length(text).cast("bigint").alias("n_bytes"), text_digest(text).alias("__text")
    )
    return keyed.join(known, keyed["__text"] == known["__digest"], "left").drop("__text", "__digest")
