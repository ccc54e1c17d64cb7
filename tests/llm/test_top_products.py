"""Exact top-k against all products."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from dimkeeper.llm import top_products as tp

SCHEMA = "vec_id long, embedding array<double>, rank int, score string"


def plain(rows, k=10, scale=1024):
    whole = []
    for i, v in rows:
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole.append((i, [math.floor(scale * x) for x in v]))
    out = []
    for a, (i, q) in enumerate(whole):
        if i is None or i % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(q, v, strict=True)), j is None, j or 0, j) for b, (j, v) in enumerate(whole) if b != a and len(v) == len(q)]
        out += [(i, r, j, -s) for r, (s, _, _, j) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return out


def found(spark, rows, **options):
    frame = spark.createDataFrame([(i, v, None, "own") for i, v in rows], SCHEMA).repartition(3)
    return [tuple(r) for r in tp.top_products(frame, F.col("vec_id") % 100 == 0, **options).collect()]


def table(seed, n, spread):
    """Groups of like direction, lengths that differ by ``spread``, a third of all rows one vector."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, 12))
    rows = []
    for i in range(n):
        v = centres[i % 5] + 0.1 * rng.normal(size=12)
        v *= math.exp(spread * rng.normal()) / np.linalg.norm(v)
        rows.append((i, (centres[0] if i % 3 == 0 else v).tolist()))
    return rows


@pytest.mark.parametrize("spread", [0.0, 1.5])
def test_equals_all_products(spark, spread, monkeypatch):
    monkeypatch.setattr(tp, "BUCKET_BYTES", 4096)  # many buckets
    monkeypatch.setattr(tp, "LEAST_ROWS", 100)  # several groups
    monkeypatch.setattr(tp, "BLOCK_ROWS", 3)
    monkeypatch.setattr(tp, "SLAB_ROWS", 4)  # several slabs of queries
    rows = table(3, 1200, spread)
    assert sorted(found(spark, rows)) == sorted(plain(rows))
    assert sorted(found(spark, rows, k=3, scale=7)) == sorted(plain(rows, 3, 7))


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, None), (2, [None, 1.0]), (3, [nan, 1.0]), (4, [inf, 0.0]), (5, []), (100, []), (6, [3.0]), (7, [-1.0, -2.0]), (8, [0.0, 0.0])]
    rows += [(200, [0.0, 0.0]), (None, [1.0, 2.0]), (9, [1.0, 2.0]), (9, [1.0, 2.0]), (0, [1.0, 2.0]), (300, [-0.0001, 5.0]), (400, None)]
    got = found(spark, rows)
    assert sorted(got, key=str) == sorted(plain(rows), key=str)
    assert {r[0] for r in got} == {0, 100, 200, 300}  # the empty vector meets the other empty one
    assert found(spark, [(0, [1.0])]) == [] and found(spark, []) == []


def test_products_stay_exact_beyond_doubles_and_fail_beyond_64_bits(spark):
    rows = [(0, [2.0**19, 3.0, 1.0]), (1, [2.0**19, 3.0, 1.0]), (2, [2.0**19, 3.0, 1.001]), (3, [2.0**19, 3.0, 1.002])]
    assert sorted(found(spark, rows)) == sorted(plain(rows))
    with pytest.raises(Exception, match="64 bits"):
        found(spark, [(0, [2.0**22]), (1, [2.0**22])])
    with pytest.raises(Exception, match="64 bits"):
        found(spark, [(0, [2.0**60]), (1, [1.0])])


def test_windows_lose_nothing():
    rng = np.random.default_rng(7)
    for _ in range(200):
        matrix = rng.normal(size=(200, 6)) + 2 * rng.normal(size=6)
        unit = np.ascontiguousarray((matrix / np.linalg.norm(matrix, axis=1)[:, None]).T)
        query, cosine = unit[:, 0], rng.uniform(0.5, 1)
        assert set(np.flatnonzero(query @ unit >= cosine)) <= set(tp._in_windows(unit, query, cosine).tolist())
