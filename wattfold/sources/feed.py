"""A feed of messages as a streaming source: append-only segments per topic, read by offsets.

A feed is a folder with a folder per topic, and in it segments, text files that only grow and
whose names sort in the order they were begun. An offset names, per topic, a segment and how
many of its bytes are taken. Spark keeps offsets in its checkpoint, so a job that restarts in
the middle of a feed, or repeats a batch, reads the same bytes again.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from wattfold.session import utc

# Spark plans the feed in a process of its own, which need not find this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "topic string, value string, segment string, position bigint"
_READ = 1 << 20  # bytes that are looked at at a time
_SPLIT = 32 << 20  # bytes of a segment that a task reads, about


class Slice(InputPartition):
    """The messages that begin in some bytes of a segment."""

    def __init__(self, topic: str, segment: str, first: int, last: int):
        self.topic, self.segment, self.first, self.last = topic, segment, first, last


def segments(store, root: str) -> dict[str, list[tuple[str, int]]]:
    """Per topic its segments in order, and how many bytes of whole messages each holds."""
    out: dict[str, list[tuple[str, int]]] = {}
    for topic in store.get_file_info(fs.FileSelector(root, allow_not_found=True)):
        if topic.type != fs.FileType.Directory or topic.base_name[0] in "_.":
            continue
        files = store.get_file_info(fs.FileSelector(topic.path))
        found = [(f.base_name, f.size) for f in files if f.type == fs.FileType.File and f.base_name[0] not in "_."]
        found = sorted(found)
        if found:
            # Only the last segment can still be written to; its last message may be half there.
            name, size = found[-1]
            found[-1] = (name, _whole(store, f"{topic.path}/{name}", size))
            out[topic.base_name] = found
    return out


def _whole(store, path: str, size: int) -> int:
    """Bytes up to the end of the last complete line."""
    with store.open_input_file(path) as file:
        end = size
        while end > 0:
            start = max(0, end - _READ)
            at = file.read_at(end - start, start).rfind(b"\n")
            if at >= 0:
                return start + at + 1
            end = start
    return 0


def between(held: dict[str, list[tuple[str, int]]], start: dict, end: dict) -> Iterator[Slice]:
    """The slices from one offset to another."""
    for topic, (last, upto) in end.items():
        first, done = start.get(topic, ("", 0))
        for name, size in held.get(topic, []):
            if name < first or name > last:
                continue
            a, b = (done if name == first else 0), (upto if name == last else size)
            for at in range(a, b, _SPLIT):
                yield Slice(topic, name, at, min(at + _SPLIT, b))


class FeedReader(DataSourceStreamReader):
    def __init__(self, path: str):
        self.path = path

    def _store(self):
        return fs.FileSystem.from_uri(self.path)

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return {topic: list(found[-1]) for topic, found in segments(*self._store()).items()}

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        return list(between(segments(*self._store()), start, end))

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        store, root = self._store()
        with store.open_input_file(f"{root}/{partition.topic}/{partition.segment}") as file:
            at, rest = partition.first, b""
            if at and file.read_at(1, at - 1) != b"\n":
                # The message this falls into belongs to the slice before.
                while (data := file.read_at(_READ, at)) and b"\n" not in data:
                    at += len(data)
                at += data.index(b"\n") + 1 if data else 0
            while at < partition.last and (data := file.read_at(_READ, at + len(rest))):
                rest += data
                *lines, rest = rest.split(b"\n")
                values, places = [], []
                for line in lines:
                    if at < partition.last:
                        values.append(line.decode("utf-8", "replace"))
                        places.append(at)
                    at += len(line) + 1
                if values:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([partition.topic] * len(values), pa.string()),
                            pa.array(values, pa.string()),
                            pa.array([partition.segment] * len(values), pa.string()),
                            pa.array(places, pa.int64()),
                        ],
                        names=["topic", "value", "segment", "position"],
                    )

    def commit(self, end: dict) -> None:
        pass


class MessageFeed(DataSource):
    @classmethod
    def name(cls) -> str:
        return "wattfold_feed"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> FeedReader:
        return FeedReader(self.options["path"])


def stream_feed(spark: SparkSession, path: str) -> DataFrame:
    """The feed below a folder or URI as a stream of messages with their topic and place."""
    spark.dataSource.register(MessageFeed)
    where = path if "://" in path else "file://" + path.removeprefix("file:")
    return utc(spark).readStream.format(MessageFeed.name()).option("path", where).load()


def publish_segments(spark: SparkSession, source: str, feed: str) -> None:
    """Move the text files of a folder partitioned by topic into a feed, as its newest segments."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    store = hadoop.Path(source).getFileSystem(spark._jsc.hadoopConfiguration())
    for folder in store.listStatus(hadoop.Path(source)):
        name = folder.getPath().getName()
        if not name.startswith("topic="):
            continue
        target = hadoop.Path(f"{feed}/{name.removeprefix('topic=')}")
        store.mkdirs(target)
        have = len(store.listStatus(target))
        files = sorted(f.getPath().toString() for f in store.listStatus(folder.getPath()))
        for i, file in enumerate(f for f in files if "/part-" in f):
            store.rename(hadoop.Path(file), hadoop.Path(target, f"{have + i:010d}"))


def backlog(path: str, query) -> dict[str, int]:
    """Bytes of whole messages per topic that the query has not taken yet."""
    where = path if "://" in path else "file://" + path.removeprefix("file:")
    held = segments(*fs.FileSystem.from_uri(where))
    taken = json.loads(query.lastProgress.json)["sources"][0]["endOffset"] if query.lastProgress else {}
    taken = json.loads(taken) if isinstance(taken, str) else taken or {}
    end = {topic: found[-1] for topic, found in held.items()}
    out = dict.fromkeys(end, 0)
    for part in between(held, {t: tuple(x) for t, x in taken.items()}, end):
        out[part.topic] += part.last - part.first
    return out
