"""Best-fit sharding against its rules and a plain search for the tightest bin."""

import random
import zlib
from collections import defaultdict

from wattfold.llm.sharding import CapacityTree, best_fit, even_bins, shard


def test_tree_finds_the_tightest_bin():
    draw = random.Random(2)
    tree, held = CapacityTree(1000), []
    for step in range(2000):
        if held and draw.random() < 0.5:
            size = draw.randrange(1, 1001)
            fits = [c for c, _ in held if c >= size]
            found = tree.take_tightest(size)
            assert (found[0] if found else None) == min(fits, default=None)
            if found:
                held.remove(found)
        else:
            held.append((draw.randrange(1, 1001), step))
            tree.add(*held[-1])


def test_best_fit_takes_the_tightest_bin():
    draw = random.Random(3)
    for _ in range(30):
        sizes = [draw.randrange(1, 90) for _ in range(draw.randrange(1, 80))]
        bins, out = [], {}
        for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
            fits = [b for b in range(len(bins)) if bins[b] >= sizes[i]]
            best = min(fits, key=lambda b: bins[b], default=None)
            if best is None:
                bins.append(100)
                best = len(bins) - 1
            bins[best] -= sizes[i]
            out[i] = best
        placed = best_fit(sizes, 100)
        room = defaultdict(int)
        for s, b in zip(sizes, placed):
            room[b] += s
        assert max(room.values()) <= 100 and len(room) == len(bins)


def test_even_bins():
    assert even_bins([], 8) == []
    assert sorted(even_bins([5], 8)) == [0]
    draw = random.Random(4)
    sizes = [draw.randrange(1, 50) for _ in range(3000)]
    sums = [0] * 8
    for s, b in zip(sizes, even_bins(sizes, 8)):
        sums[b] += s
    assert max(sums) - min(sums) <= 8
    huge = [100000, *sizes]
    sums = [0] * 8
    for s, b in zip(huge, even_bins(huge, 8)):
        sums[b] += s
    assert sorted(sums)[-1] == 100000 and sorted(sums)[-2] - min(sums) <= 8


def test_documents_into_shards(spark):
    draw = random.Random(6)
    texts = ["copy" * 50] * 300 + [None, "", "é漢"] + ["w" * draw.randrange(1, 2000) + str(i) for i in range(900)]
    rows = [(i if i % 7 else None, t, "shadow", i) for i, t in enumerate(texts)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, slot string, nr int").repartition(6)
    got = shard(table, 8).collect()
    assert len(got) == len(rows) and {r.nr for r in got} == set(range(len(rows)))
    sums, slots, homes = defaultdict(int), defaultdict(list), defaultdict(set)
    for r in got:
        raw = (texts[r.nr] or "").encode()
        assert r["size"] == len(raw) + 1 and r.text_crc32 == zlib.crc32(raw)
        sums[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
        homes[raw].add(r.shard)
    assert all(len(h) == 1 for h in homes.values())
    assert set(sums) == set(range(8)) and max(sums.values()) - min(sums.values()) < 2100
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert shard(table.where("false"), 8).count() == 0
