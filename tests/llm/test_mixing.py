"""Pivotal rounding: exact targets, kept words, kept probabilities, a plain fold, awkward rows."""

import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

from plazaframe.llm import mixing, queries, registered  # noqa: F401
from pyspark.sql import functions as F

SLOW_NODES = ["EvalPython", "InPandas", "InArrow", "CartesianProduct", "BroadcastNestedLoopJoin"]


def plain_targets(sizes, weights=(5, 2, 1), percent=150, limit=2):
    named = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(named)}
    full, left = {}, Fraction(percent * sum(sizes.values()), 100)
    while True:
        still = [s for s in named if s not in full]
        share = {s: (left - sum(full.values())) * weight[s] / sum(weight[t] for t in still) for s in still}
        above = [s for s in still if share[s] > limit * sizes[s]]
        if not above:
            return {s: float(x) for s, x in {**full, **share}.items()}
        full |= {s: Fraction(limit * sizes[s]) for s in above}


def check(rows, sizes_of):
    """Targets, bounds and sums of mixed ``rows``; ``sizes_of``: (source, size) of every document."""
    sizes = defaultdict(int)
    for source, size in sizes_of:
        sizes[source] += size
    wanted, taken, largest = plain_targets(sizes), Counter(), Counter()
    assert Counter((r["source"], r["size"]) for r in rows) == Counter(sizes_of)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - wanted[r["source"]]) < 1e-6 * max(1, r["target"])
        assert r["taken"] == r["times"] * r["size"] and 0 <= r["taken"] <= 2 * r["size"]
        rate = r["target"] / r["source_size"] if r["size"] else 0
        assert int(rate) <= r["times"] <= -(-rate // 1) or not r["size"]
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for source, target in wanted.items():
        assert abs(taken[source] - target) <= largest[source] / 2 + 1e-6


def lopsided(n, seed=1):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        source = draw.choice([None, "a", "b", "b", "b", "c", "ß", "日", "z"])
        rows.append((i if draw.random() < 0.8 else None, " ".join("w" * draw.randint(1, 3) for _ in range(draw.choice([1, 5, 20, 300]))), source))
    return rows + [(7, "same row here", "c")] * 50 + [(None, "x y", "b")] * 70


def mixed(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return mixing.mix(df, **options).collect()


def test_targets_bounds_and_sums(spark):
    rows = lopsided(1500)
    sizes = [(s, len(re.findall(r"[^\x20\x09-\x0D]+", t))) for _, t, s in rows]
    found = mixed(spark, rows)
    check(found, sizes)
    check(mixed(spark, rows, fan=3), sizes)
    again = mixing.mix(spark.createDataFrame(rows[::-1], "doc_id long, text string, source string").repartition(5)).collect()
    assert Counter(map(tuple, found)) == Counter(map(tuple, again))
    assert Counter(map(tuple, found)) != Counter(map(tuple, mixed(spark, rows, seed=1)))


def test_large_sets_of_interchangeable_rows(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK", 7)
    rows = [(None, "one two three", "a")] * 100 + [(1, "one", "b")] * 33 + [(2, "x " * 40, "c")]
    check(mixed(spark, rows), [("a", 3)] * 100 + [("b", 1)] * 33 + [("c", 40)])


def test_probabilities_are_kept_on_average(spark):
    units = [(1, 0.3), (5, 0.9), (30, 0.5), (7, 0.05), (2, 0.6)]
    listed = F.array(
        *(
            F.struct(
                F.lit(size).cast("long").alias("size"), F.xxhash64("id", F.lit(i)).alias("draw"), F.lit(i).cast("long").alias("id"),
                *(F.lit(0).cast("long").alias(c) for c in ("copies", "base", "whole")), F.lit(p).alias("p"),
            )
            for i, (size, p) in enumerate(units)
        )
    )
    done = spark.range(20_000).select(mixing.pivot(listed).alias("d"))
    decided = done.select(F.explode("d.decided").alias("u")).select("u.id", F.col("u.won").cast("double").alias("x"))
    left = done.select("d.rest.id", "d.rest.p")
    means = dict(decided.union(left).groupBy("id").agg(F.avg("x")).collect())
    assert all(abs(means[i] - p) < 0.02 for i, (_, p) in enumerate(units))


def test_pairs_equal_a_plain_fold(spark):
    draw = random.Random(4)
    units = [(draw.randint(1, 50), draw.getrandbits(40), i, 1, 0, 0, draw.random()) for i in range(40)]
    fields = "size long, draw long, id long, copies long, base long, whole long, p double"
    df = spark.createDataFrame(units, fields)
    draws = df.select(F.col("draw").alias("a")).crossJoin(df.select(F.col("draw").alias("b")))
    uniform = {(r[0], r[1]): r[2] for r in draws.select("a", "b", mixing._uniform(F.xxhash64("a", "b"))).collect()}
    out = df.groupBy().agg(F.sort_array(F.collect_list(F.struct(*mixing._UNIT)), asc=False).alias("u")).select(mixing.pivot(F.col("u")).alias("o")).first()["o"]
    ordered = sorted(units, reverse=True)
    held, won = list(ordered[0]), {}
    for unit in ordered[1:]:
        unit = list(unit)
        a, p, b, q = held[0], held[6], unit[0], unit[6]
        gain, loss = min((1 - p) * a, q * b), min(p * a, (1 - q) * b)
        if uniform[held[1], unit[1]] * (gain + loss) < loss:
            held[6], unit[6] = p + gain / a, q - gain / b
            first = (1 - p) * a <= q * b
        else:
            held[6], unit[6] = p - loss / a, q + loss / b
            first = p * a <= (1 - q) * b
        gone, held = (held, unit) if first else (unit, held)
        assert min(gone[6], 1 - gone[6]) < 1e-9
        won[gone[2]] = round(gone[6])
    assert {u["id"]: u["won"] for u in out["decided"]} == won
    assert out["rest"]["id"] == held[2] and abs(out["rest"]["p"] - held[6]) < 1e-9


def test_awkward_rows(spark, docs):
    found = mixing.mix(docs.withColumn("open", F.lit(1)).withColumn("copies", F.lit(2))).collect()
    check(found, [(r["source"], len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))) for r in docs.collect()])
    assert mixing.mix(docs.where("doc_id < 0")).collect() == []
    empty = mixed(spark, [(1, None, "a"), (2, "", None)])
    assert sorted((r["id"], r["size"], r["target"], r["taken"]) for r in empty) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]


def test_registered_query(spark, sample_folder):
    found = queries.QUERIES["op12_mixing"](spark, sample_folder)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in SLOW_NODES if node in plan]
    assert found.dtypes == [("doc_id", "bigint"), ("size", "bigint"), ("source", "string"), ("source_size", "bigint"), ("target", "double"), ("taken", "bigint")]
    texts = spark.read.parquet(f"{sample_folder}/documents.parquet").select("source", "text").collect()
    rows = found.selectExpr("*", "coalesce(taken div nullif(size, 0), 0) AS times").collect()
    check(rows, [(r[0], len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))) for r in texts])
