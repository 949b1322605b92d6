"""Both vector searches against brute force."""

import numpy as np
import pytest

from wattfold.llm import collision, maxscore, registry

NAN = float("nan")


def table(spark, ids, matrix, odd=()):
    rows = [(int(i), [float(x) for x in v], "kept out") for i, v in zip(ids, matrix)] + list(odd)
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, score string").repartition(3)


ODD = [(None, [1.0, 2.0], ""), (900, None, ""), (901, [1.0, None], ""), (902, [NAN, 1.0], ""), (903, [float("inf"), 1.0], "")]


def brute(ids, matrix, asked, k, score, largest):
    out = []
    for q in asked:
        s = score(matrix, matrix[list(ids).index(q)])
        order = np.lexsort((ids, -s if largest else s))
        order = [i for i in order if ids[i] != q][:k]
        out += [(q, rank + 1, int(ids[i]), s[i]) for rank, i in enumerate(order)]
    return out


def test_top_products_are_exact(spark, monkeypatch):
    monkeypatch.setattr(maxscore, "FIRST", 40)
    draw = np.random.default_rng(0)
    ids = draw.permutation(400)
    matrix = draw.integers(-20, 20, (400, 9)).astype(float)
    matrix[::5] = matrix[0]  # ties
    matrix[3], matrix[7, :8] = 0, 0
    rows = table(spark, ids, matrix, ODD)
    got = maxscore.top_products(rows, rows.where("vec_id % 9 = 0"), 5, vec_col="embedding").collect()
    want = brute(ids, matrix, [i for i in ids if i % 9 == 0], 5, lambda m, q: m @ q, True)
    assert sorted(map(tuple, got)) == sorted(want)


def test_query_leaves_out_odd_vectors(spark, tmp_path):
    draw = np.random.default_rng(2)
    matrix = draw.standard_normal((120, 2))
    # Two are queries themselves.
    odd = [*ODD, (950, [NAN, 1.0], ""), (904, [float("-inf"), 1.0], ""), (1000, [float("inf"), 1.0], "")]
    table(spark, range(120), matrix, odd).select("vec_id", "embedding").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = registry.op7_maxscore_topk(spark, str(tmp_path)).collect()
    want = brute(range(120), np.floor(256 * matrix), [0, 50, 100], 5, lambda m, q: m @ q, True)
    assert sorted(map(tuple, got)) == sorted(want)


def test_few_rows_and_none(spark):
    rows = table(spark, [0, 50], [[1, 2], [3, 4]], ODD)
    got = maxscore.top_products(rows, rows, 5, vec_col="embedding").collect()
    assert sorted(map(tuple, got)) == [(0, 1, 50, 11), (50, 1, 0, 11)]
    near = collision.nearest(rows, rows, 10).collect()
    assert [(r.query_id, r.vec_id) for r in sorted(near)] == [(0, 50), (50, 0)]
    assert near[0].score == pytest.approx(8**0.5)
    for f in (lambda: maxscore.top_products(rows.where("false"), rows, 5, vec_col="embedding"), lambda: collision.nearest(rows.where("false"), rows, 5)):
        assert f().count() == 0


def test_neighbours_recall_and_distances(spark):
    draw = np.random.default_rng(1)
    ids = np.arange(3000)
    matrix = draw.standard_normal((3000, 32))
    matrix[100:140] = matrix[100]  # many copies: ties go to smaller ids
    matrix[7] = 0
    rows = table(spark, ids, matrix, ODD)
    got = collision.nearest(rows, rows.where("vec_id % 100 = 0"), 10).collect()
    usable = np.delete(ids, 7)
    want = brute(usable, matrix[usable], [i for i in ids if i % 100 == 0], 10, lambda m, q: np.sqrt(((m - q) ** 2).sum(1)), False)
    pairs = {(q, v): s for q, _, v, s in want}
    hits = [(r.query_id, r.vec_id) for r in got if (r.query_id, r.vec_id) in pairs]
    assert len(got) == 300 and len(hits) >= 0.9 * 300
    assert all(r.score == pytest.approx(pairs[r.query_id, r.vec_id]) for r in got if (r.query_id, r.vec_id) in pairs)
    assert [r.vec_id for r in sorted(got) if r.query_id == 100] == list(range(101, 111))


def recall(ids, matrix, asked, k=10):
    index, hits = collision.SortedProjections(ids, matrix), 0
    for q in asked:
        dist = np.sqrt(((matrix - matrix[list(ids).index(q)]) ** 2).sum(axis=1))
        dist[ids == q] = np.inf
        found, score = index.ask(q, matrix[list(ids).index(q)], k, None)
        hits += len({*ids[np.lexsort((ids, dist))[:k]]} & {*found[np.lexsort((found, score))[:k]]})
    return hits / (k * len(asked))


@pytest.mark.parametrize("dimensions", [64, 256, 768])
def test_recall_in_any_dimension(dimensions):
    ids = np.arange(3000)
    assert recall(ids, np.random.default_rng(2).standard_normal((3000, dimensions)), range(0, 3000, 200)) >= 0.9


def test_recall_of_the_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, matrix = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    want = brute(ids, matrix, [i for i in ids if i % 100 == 0], 10, lambda m, q: np.sqrt(((m - q) ** 2).sum(1)), False)
    found = registry.op5_collision_neighbours(spark, folder)
    assert dict(found.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"}
    got = {(r["query_id"], r["vec_id"]) for r in found.collect()}
    assert len(got) == len(want) and len(got & {(q, v) for q, _, v, _ in want}) >= 0.9 * len(want)
