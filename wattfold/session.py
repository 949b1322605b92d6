"""Session settings the engine relies on, and its shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "wattfold", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Keeps every core busy on small inputs; large ones never come near it.
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64kb",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return utc(builder.getOrCreate())


def utc(spark: SparkSession) -> SparkSession:
    """Slices are UTC; text and date conversions must not depend on the host's zone."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder that driver and executors share, removed when the application ends.

    It lies below ``spark.checkpoint.dir``; where the session names none, below the
    warehouse, which is shared as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or (
        f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    )
    path = f"{root.rstrip('/')}/wattfold/{label}-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    return path


def written(df, label: str):
    """``df`` written to a scratch folder and read back: computed once, however often it is used."""
    path = f"{scratch_dir(df.sparkSession, label)}/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
