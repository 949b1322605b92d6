"""Small helpers the operators share."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattfold.session import scratch_dir

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stash(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts lineage so that an executor lost later costs a read, and fixes generated ids.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark, label)}/data"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_digest(text) -> F.Column:
    """32 bytes that stand for a text; a null text counts as the empty one."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def dense_order(df: DataFrame, group: list[str], order: list, out: str, rows: int = 20000) -> DataFrame:
    """Number the rows of each group 0, 1, 2, ... without one task holding a group.

    A group is dealt into cells of about ``rows`` rows by a hash of the ordering columns;
    a row's number is its place in its cell plus the sizes of the cells before it. Which
    row gets which number is arbitrary; the numbers are not. ``df`` must be cheap to read
    twice and give the same rows each time (see ``stash``).
    """
    from pyspark.sql import Window

    cells = max(1, -(-df.count() // rows))
    celled = df.withColumn("__cell", F.pmod(F.xxhash64(*order), F.lit(cells)))
    keys = [*group, "__cell"]
    before = Window.partitionBy(*group).orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = celled.groupBy(*keys).count().select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
        F.coalesce(F.sum("count").over(before.partitionBy(*group)), F.lit(0)).alias("__start"),
    )
    match = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    placed = celled.withColumn(
        "__row", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    )
    return placed.join(starts, match, "left").select(
        *[F.col(f"`{c}`") for c in df.columns], (F.col("__start") + F.col("__row")).alias(out)
    )
