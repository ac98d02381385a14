"""Top-k search against all inner products."""

import math
import random

from skylag.llm import topk
from skylag.llm.common import on_workers


def _rows(n, wide, scale=1.0):
    rng = random.Random(6)
    rows = [(i, [rng.choice([0.0, rng.gauss(0, scale)]) for _ in range(wide)]) for i in range(n)]
    rows += [(n, None), (n + 1, []), (n + 2, [None] * wide), (n + 3, [float("nan")] * wide), (n + 4, [float("-inf")] + [1.0] * (wide - 1))]
    return rows + [(n + 5, [1.0]), (3, rows[3][1]), (7, rows[9][1])]


def test_best_of_every_query(spark, monkeypatch):
    on_workers(spark)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 50)
    monkeypatch.setattr(topk, "QUERY_ROWS", 7)
    for scale in (1.0, 1e6):
        rows = _rows(200, 12, scale)
        table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS score", "2 AS rank")
        vectors = topk.integer_rows(table)
        got = {}
        for r in topk.top_k(vectors.where("vec_id % 20 = 0"), vectors, 5).collect():
            got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
        whole = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
        for query_id, q in whole:
            if query_id % 20 == 0:
                scored = sorted((-sum(a * b for a, b in zip(q, c, strict=False)), i) for i, c in whole if i != query_id)[:5]
                assert sorted(got.pop(query_id)) == [(n, i, -s) for n, (s, i) in enumerate(scored, 1)]
        assert not got


def test_few_and_no_rows(spark):
    on_workers(spark)
    vectors = topk.integer_rows(spark.createDataFrame([(0, [0.5]), (1, [0.5]), (2, [0.5])], "vec_id long, embedding array<float>"))
    got = [tuple(r) for r in topk.top_k(vectors.where("vec_id = 0"), vectors).orderBy("rank").collect()]
    assert got == [(0, 1, 1, 1024), (0, 2, 2, 1024)]
    assert topk.top_k(vectors.limit(0), vectors).count() == topk.top_k(vectors, vectors.limit(0)).count() == 0


def test_no_block_goes_through_the_driver(spark, monkeypatch):
    on_workers(spark)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 8)
    monkeypatch.setattr(topk, "QUERY_ROWS", 4)
    vectors = topk.integer_rows(spark.createDataFrame(_rows(60, 4), "vec_id long, embedding array<double>"))
    plan = topk.top_k(vectors.where("vec_id % 20 = 0"), vectors, 5)._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "CartesianProduct" not in plan


def test_copies_of_blocks_do_not_grow_with_the_blocks():
    def copies(times):
        asked, held = 30 * times, 75 * times
        rows, columns = topk._grid((asked, 1024 * asked, 131_072 * asked, 131_072), (held, 8192 * held, 1_048_576 * held, 1_048_576), 20, 48)
        assert 48 <= rows * columns <= 64
        return rows, columns

    assert copies(1) == copies(4) == copies(10)
    # A row's queries fit a cell; few candidates leave the cells to the queries.
    many, one = 10_000, (1, 100, 12_800, 12_800)
    rows, _ = topk._grid((many, 1024 * many, 131_072 * many, 131_072), one, 20, 48)
    assert many * (131_072 + 1024 * 20 * topk.FOUND_BYTES) / rows <= topk.TILE_BYTES
    assert topk._grid((8, 8192, 8 * 131_072, 131_072), one, 20, 48) == (8, 1)
    assert topk._grid((0, 0, 0, 0), (0, 0, 0, 0), 20, 48) == (1, 1)
