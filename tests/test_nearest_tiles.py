"""Exact neighbours by matrix products, against plain loops."""

import math

import numpy as np
from pyspark.sql import functions as F

from sparkloom.operators import nearest as n


def plain(vectors, queries, k):
    """Ties by id; NaN after numbers, no distance last."""
    out = []
    for query, q in queries:
        scored = []
        for id_, v in vectors:
            if v is None or q is None or len(v) != len(q) or None in v or None in q:
                scored.append((2, 0.0, id_, None))
                continue
            d = math.sqrt(sum((np.float32(a).astype(float) - np.float32(b).astype(float)) ** 2 for a, b in zip(v, q, strict=True)))
            d = d if math.isnan(d) or math.isinf(d) else math.floor(d * 1e6 + 0.5) / 1e6
            scored.append((math.isnan(d), 0.0 if math.isnan(d) else d, id_, d))
        out += [(query, id_, str(d)) for *_, id_, d in sorted(scored)[:k]]
    return sorted(out)


def found(spark, vectors, queries, k, **sizes):
    frame = lambda rows: spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    return sorted((r[0], r[1], str(r[2])) for r in n.nearest(frame(vectors), frame(queries), k, **sizes).collect())


def test_pairs_are_not_joined(spark):
    """A row for each pair of a query and a vector is never made."""
    v = spark.range(2000).select(F.col("id").alias("vec_id"), F.array(*[F.rand(i).cast("float") for i in range(8)]).alias("embedding"))
    plan = n.nearest(v, v.where("vec_id % 10 = 0"), 5)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_few_pairs_are_compared(monkeypatch):
    rng, compared, exact = np.random.default_rng(0), [], n._exact
    monkeypatch.setattr(n, "_exact", lambda q, w, x, y: compared.append(len(x)) or exact(q, w, x, y))
    v = rng.normal(size=(16_384, 16))
    i, j, d = n._closest(v, v[::16], 10)
    assert len(i) == 10_240 and (j[::10] == np.arange(0, 16_384, 16)).all() and not d[::10].any()
    assert sum(compared) < 0.005 * 1024 * 16_384


def test_copies_ties_and_tiles(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in (np.zeros(3) if i % 3 else rng.integers(0, 4, 3))]) for i in range(600)]
    want = plain(rows, rows[::20], 7)
    for sizes in ({}, {"tile": 50, "limit": 8}, {"tile": 5000}):
        assert found(spark, rows, rows[::20], 7, **sizes) == want


def test_far_from_the_origin(spark):
    """Products lose the digits that tell these apart."""
    rng = np.random.default_rng(2)
    rows = [(i, [float(np.float32(x)) for x in 1e6 + rng.integers(0, 40, 4) / 8]) for i in range(700)]
    assert found(spark, rows, rows[::50], 9) == plain(rows, rows[::50], 9)


def test_without_distance(spark):
    """NULL and unlike vectors come last, by id; what isn't a number after the numbers."""
    inf, nan = math.inf, math.nan
    rows = [(0, None), (1, [1.0, 2.0]), (2, [1.0]), (3, [1.0, None]), (4, []), (5, [nan, 1.0]), (6, [inf, 0.0]), (7, [1.0, 2.0]), (8, [3e38, 3e38]), (9, [0.0, 0.0])]
    for k in (1, 3, 20):
        assert found(spark, rows, rows, k) == plain(rows, rows, k)
    assert found(spark, rows, [], 3) == found(spark, [], [], 3) == found(spark, [], rows, 3) == []
