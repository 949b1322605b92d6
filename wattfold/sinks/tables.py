"""Keyed parquet tables: create, read, upsert, purge.

Tables are plain partitioned parquet under one root. An upsert merges its rows with what the
partitions they fall into hold, and overwrites just those partitions, by Spark's dynamic
partition overwrite: a job that fails has changed nothing. One job at a time writes a table.
Repeating an upsert leaves the same rows.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from wattfold import schemas
from wattfold.config import LEVELS
from wattfold.session import scratch_dir, utc

_SPOOL = "_spool"
_LOOKUPS = 40  # days that are looked up one by one; beyond, folders are listed


def _dated(part: str, first, last) -> bool:
    """Whether a partition folder's slice date lies between two dates."""
    if first is None and last is None:
        return True
    day = part.rsplit("slice_date=", 1)[1]
    return (first is None or day >= str(first)) and (last is None or day <= str(last))


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = utc(spark)
        self.root = root.rstrip("/")

    # -- folders ---------------------------------------------------------------------

    def path(self, name: str) -> str:
        return f"{self.root}/{schemas.TABLES[name].name}"

    def _fs(self, path: str):
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop, hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _exists(self, path: str) -> bool:
        target, fs = self._fs(path)
        return fs.exists(target)

    def _delete(self, path: str) -> None:
        target, fs = self._fs(path)
        fs.delete(target, True)

    def _mkdirs(self, path: str) -> None:
        target, fs = self._fs(path)
        fs.mkdirs(target)

    def _children(self, path: str) -> list[str]:
        target, fs = self._fs(path)
        if not fs.exists(target):
            return []
        return sorted(s.getPath().toString() for s in fs.listStatus(target) if s.isDirectory())

    def _partitions(self, table, path: str, first=None, last=None) -> list[str]:
        """The partition folders below a table's folder; one per gap and day at most.

        Between two dates not far apart each day's folder is looked up, which beats listing a long history.
        """
        near = first is not None and last is not None and (last - first).days < _LOOKUPS
        found = [""]
        for column in table.partitions:
            if column == "slice_date" and near:
                days = [str(first + timedelta(days=n)) for n in range((last - first).days + 1)]
                named = [f"{at}/{column}={day}".lstrip("/") for at in found for day in days]
                found = [part for part in named if self._exists(f"{path}/{part}")]
                continue
            found = [
                f"{at}/{child.rsplit('/', 1)[1]}".lstrip("/")
                for at in found
                for child in self._children(f"{path}/{at}".rstrip("/"))
                if child.rsplit("/", 1)[1].startswith(f"{column}=")
            ]
        return [p for p in found if _dated(p, first, last)]

    # -- reading ---------------------------------------------------------------------

    def read(self, name: str, first=None, last=None) -> DataFrame:
        """The table as stored; a table nobody wrote yet is empty.

        With ``first`` or ``last``, only the folders of slice dates in that range are
        looked into, so a flush does not pay for a long history.
        """
        table = schemas.TABLES[name]
        if first is not None or last is not None:
            return self._folders(table, self._partitions(table, self.path(name), first, last))
        if not self._children(self.path(name)):
            return self.spark.createDataFrame([], table.schema)
        return self.spark.read.schema(table.schema).parquet(self.path(name))

    def newest_date(self, name: str):
        """The last slice date a table holds, none if it is empty."""
        parts = self._partitions(schemas.TABLES[name], self.path(name))
        days = [part.rsplit("slice_date=", 1)[1] for part in parts]
        return date.fromisoformat(max(days)) if days else None

    def _folders(self, table, parts: list[str]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], table.schema)
        root = self.path(table.name)
        reader = self.spark.read.schema(table.schema).option("basePath", root)
        return reader.parquet(*[f"{root}/{part}" for part in parts])

    def register_views(self) -> None:
        """Make every table available to SQL under its own name."""
        for name in schemas.TABLES:
            self.read(name).createOrReplaceTempView(name)

    # -- writing ---------------------------------------------------------------------

    def spool(self, rows: DataFrame, label: str = "batch") -> DataFrame:
        """Write one batch's rows down and read them back, cutting their lineage."""
        path = f"{self.root}/{_SPOOL}/{label}"
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def upsert(self, name: str, rows: DataFrame) -> None:
        """Insert rows, replacing stored ones of the same key."""
        key = schemas.TABLES[name].key
        self._merge(name, rows, lambda old, new: old.join(new.select(*key), key, "left_anti"))

    def replace(
        self, name: str, rows: DataFrame, first=None, last=None, owners: DataFrame | None = None
    ) -> None:
        """Drop the stored rows of a range of slice dates and insert ``rows``.

        With ``owners``, only rows of those entities (its columns name the key) go.
        """
        doomed = F.lit(True)
        if first is not None:
            doomed = doomed & (F.col("slice_date") >= F.lit(first))
        if last is not None:
            doomed = doomed & (F.col("slice_date") <= F.lit(last))

        def keep(old, new):
            rest = old.where(~doomed)
            if owners is None:
                return rest
            return rest.unionByName(old.where(doomed).join(owners, owners.columns, "left_anti"))

        table = schemas.TABLES[name]
        self._merge(name, rows, keep, self._partitions(table, self.path(name), first, last))

    def _merge(self, name, rows, keep, also=()) -> None:
        """Overwrite the partitions ``rows`` fall into, and ``also`` those, with what ``keep`` leaves of them and the rows."""
        table = schemas.TABLES[name]
        # Written down first, the rows are computed once, and the folders made tell which partitions they touch.
        typed = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema])
        if not self._children(self.path(name)):
            # Nothing to merge with: the rows are the table.
            self._write(table, typed, self.path(name))
            return
        incoming = f"{scratch_dir(self.spark, name)}/rows"
        self._write(table, typed, incoming)
        touched = sorted({*self._partitions(table, incoming), *also})
        overlap = [part for part in touched if self._exists(f"{self.path(name)}/{part}")]
        new = self.spark.read.schema(table.schema).parquet(incoming)
        if not overlap:
            if touched:
                self._write(table, new, self.path(name))
            return
        old = self._folders(table, overlap)
        merged = keep(old, new).select(*table.columns).unionByName(new)
        emptied = []
        if also:
            # Dynamic overwrite leaves a partition alone that gets no rows at all.
            left = {tuple(map(str, r)) for r in merged.select(*table.partitions).distinct().collect()}
            emptied = [p for p in overlap if tuple(x.split("=", 1)[1] for x in p.split("/")) not in left]
        self._write(table, merged, self.path(name))
        for part in emptied:
            self._delete(f"{self.path(name)}/{part}")
        self._delete(incoming)

    def _write(self, table, rows: DataFrame, path: str) -> None:
        # Rebalancing splits a large partition over several files and joins small ones;
        # sorted files let a reader skip to the slices of one time of day.
        order = [c for c in ("slice_index", "slice_start") if c in table.columns]
        (
            rows.hint("rebalance", *[F.col(c) for c in table.partitions])
            .sortWithinPartitions(*table.partitions, *order)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*table.partitions)
            .parquet(path)
        )

    # -- maintenance -----------------------------------------------------------------

    def init_tables(self, purge: bool = False) -> None:
        """Create every table that is missing; with ``purge``, start over empty."""
        if purge:
            self._delete(self.root)
        for name in schemas.TABLES:
            self._mkdirs(self.path(name))

    def _version_path(self, level: str, version: str) -> str:
        return f"{self.path(f'{level}_data_forecast')}/version={version}"

    def forecast_versions(self, level: str) -> list[str]:
        parts = self._children(self.path(f"{level}_data_forecast"))
        return [p.rsplit("version=", 1)[1] for p in parts if "version=" in p]

    def init_forecast_version(self, version: str) -> None:
        """Make room for a version's forecasts at every level."""
        for level in LEVELS:
            self._mkdirs(self._version_path(level, version))

    def purge_forecast_version(self, version: str, confirm: bool = False) -> None:
        """Drop a version's forecasts at every level and leave it empty."""
        if not confirm:
            raise ValueError("purging drops stored forecasts; pass confirm=True")
        for level in LEVELS:
            self._delete(self._version_path(level, version))
        self.init_forecast_version(version)


def load_baselines(store: TableStore, level: str) -> DataFrame:
    """Stored baselines, one row per entity and gap."""
    return store.read(f"{level}_prop")


def write_messages(messages: DataFrame, path: str) -> None:
    """Publish ``(topic, value)`` rows to a folder per topic."""
    messages.write.mode("overwrite").partitionBy("topic").text(path)


def publish_messages(messages: DataFrame, servers: str) -> None:
    """Publish ``(topic, value)`` rows to Kafka; needs the connector on the class path."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).save()
