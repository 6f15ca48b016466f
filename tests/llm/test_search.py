"""Exact top-k search."""

import math
import random

import brute
import numpy as np
import pytest
from plazaframe.llm import topk
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<float>, label int, score double"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 0.0) for i, v in rows], SCHEMA).repartition(3)


def whole(vector):
    return [math.floor(256 * float(np.float32(x))) for x in vector]


@pytest.mark.parametrize("block", [4096, 16])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "QUERIES", 5)
    draw = random.Random(block)
    rows = [(i, [draw.gauss(0, 1) * draw.choice([0.01, 1, 20]) for _ in range(12)]) for i in range(150)]
    rows += [(200 + i, rows[3][1]) for i in range(40)]  # a very common vector
    rows += [(300, [0.0] * 12), (301, [-0.001] * 12)]
    asked = [r for r in rows if r[0] % 7 == 0]
    got = topk.exact_topk(frame(spark, rows), frame(spark, asked), 5)
    wanted = brute.top([(i, whole(v)) for i, v in rows], [(i, whole(v)) for i, v in asked], 5)
    assert sorted(tuple(r) for r in got.collect()) == wanted


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, None), (2, [nan, 1.0]), (3, [1.0, inf]), (4, [1.0, None]), (None, [1.0, 1.0]), (5, [2.0, 2.0]), (5, [2.0, 2.0]), (6, [1.0])]
    got = topk.exact_topk(frame(spark, rows), frame(spark, rows), 5)
    ids = [(0, [256, 512]), (5, [512, 512])]
    assert sorted(tuple(r) for r in got.collect()) == brute.top(ids, ids, 5)
    assert topk.exact_topk(frame(spark, rows).where("false"), frame(spark, rows), 5).collect() == []
    assert topk.exact_topk(frame(spark, rows), frame(spark, rows).where("false"), 5).collect() == []


def test_huge_components_saturate(spark):
    rows = [(0, [1e30, 1.0]), (1, [1e30, -1.0]), (2, [1.0, 1.0])]
    got = {(r.query_id, r.id): r.score for r in topk.exact_topk(frame(spark, rows), frame(spark, rows), 2).collect()}
    assert got[(0, 1)] == 2**63 - 1 and len(got) == 6


def test_segments_are_the_block_by_falling_impact():
    rows = np.random.default_rng(1).integers(-900, 900, (50, 8))
    parts = topk.segments(rows)
    assert (sum(parts) == rows).all()
    least = [np.abs(p[p != 0]).min() for p in parts]
    most = [np.abs(p).max() for p in parts]
    assert all(a > b for a, b in zip(least, most[1:], strict=False))


def test_a_query_stops_early_and_stays_exact(monkeypatch):
    draw = np.random.default_rng(2)
    rows = draw.integers(-4, 4, (2000, 16))
    rows[:8] = draw.integers(800, 1000, (8, 16))
    seen = []
    parts = topk.segments(rows)

    class Counted(list):
        def __iter__(self):
            for p in parts:
                seen.append(1)
                yield p

    monkeypatch.setattr(topk, "segments", lambda _: Counted())
    found = topk._best(topk.search_block(rows[:2], np.array([0, 1]), rows, np.arange(2000), 5), 5)
    wanted = brute.top(list(enumerate(rows.tolist())), [(0, rows[0].tolist()), (1, rows[1].tolist())], 5)
    assert [(q, v, s) for q, _, v, s in wanted] == sorted(found, key=lambda x: (x[0], -x[2], x[1]))
    assert len(seen) < len(parts)


def test_numbers_without_fraction(spark):
    vectors = spark.range(20).select(F.col("id").alias("vec_id"), F.array(F.col("id"), F.lit(1)).alias("embedding"))
    got = topk.exact_topk(vectors, vectors.where("vec_id = 3"), 2, scale=1).collect()
    assert [(r.id, r.score) for r in sorted(got, key=lambda r: r.rank)] == [(19, 58), (18, 55)]
