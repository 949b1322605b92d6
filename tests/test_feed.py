
from wattfold.sources import feed as M


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "a", encoding="utf-8", newline="") as file:
        file.write(text)


def take(spark, path, tmp_path):
    query = (
        M.stream_feed(spark, str(path)).writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True).start(str(tmp_path / "table"))
    )
    assert query.awaitTermination(150)
    return query


def stored(spark, tmp_path):
    rows = spark.read.parquet(str(tmp_path / "table")).select("topic", "value").collect()
    return sorted((r.topic, r.value) for r in rows)


def test_a_feed_goes_on_where_it_was_left(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(M, "_SPLIT", 7)
    root = tmp_path / "feed"
    put(root / "a" / "seg-1", "one\ntwo\nhalf")
    put(root / "b" / "seg-1", "é\n\n")
    query = take(spark, root, tmp_path)
    assert stored(spark, tmp_path) == [("a", "one"), ("a", "two"), ("b", ""), ("b", "é")]
    put(root / "a" / "seg-1", " done\nthree\n")
    put(root / "a" / "seg-2", "four is a long message\n")
    put(root / "c" / "seg-1", "new\n")
    assert M.backlog(str(root), query) == {"a": len("half done\nthree\nfour is a long message\n"), "b": 0, "c": 4}
    query = take(spark, root, tmp_path)
    late = [("a", "four is a long message"), ("a", "half done"), ("a", "three"), ("c", "new")]
    assert stored(spark, tmp_path) == sorted([("a", "one"), ("a", "two"), ("b", ""), ("b", "é"), *late])
    assert set(M.backlog(str(root), query).values()) == {0}


def test_slices_hold_every_message_once(tmp_path, monkeypatch):
    import random

    rng = random.Random(2)
    lines = ["x" * rng.choice([0, 1, 5, 40]) + str(i) for i in range(300)]
    put(tmp_path / "t" / "s", "\n".join(lines) + "\n")
    for split, read in [(1, 3), (13, 8), (50, 1000), (10**6, 64)]:
        monkeypatch.setattr(M, "_SPLIT", split)
        monkeypatch.setattr(M, "_READ", read)
        reader = M.FeedReader(f"file://{tmp_path}")
        parts = reader.partitions({}, reader.latestOffset())
        got = [(p, v) for part in parts for batch in reader.read(part) for p, v in zip(batch["position"].to_pylist(), batch["value"].to_pylist())]
        assert [v for _, v in sorted(got)] == lines


def test_feed_and_decoding_together(spark, tmp_path):
    from wattfold.sources.readings import decode_readings

    put(tmp_path / "feed" / "iot-data" / "0", "1,1704070800,5,1,0,0,0\nbroken\n")
    rows = decode_readings(M.stream_feed(spark, str(tmp_path / "feed")))
    assert rows.isStreaming and {"topic", "segment", "position", "timestamp"} <= set(rows.columns)
