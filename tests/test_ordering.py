"""Windows that survive a hot key: the split form must give the plain window's rows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from plazaframe.operators import aggregate, cleaning, ranking, sequence, skew


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def visits(spark):
    """A key with most of the rows, 300 identical rows in it, nulls as keys, dates and values."""
    rng = random.Random(7)
    data = [("hot", f"2020-01-{rng.randint(1, 28):02d}", rng.choice(["a", "b", None])) for _ in range(900)]
    data += [("hot", "2020-01-15", "same")] * 300
    data += [("hot", None, "x"), ("hot", None, "y")]
    data += [(f"k{rng.randint(0, 40)}", f"2020-02-{rng.randint(1, 28):02d}", "z") for _ in range(400)]
    data += [(None, f"2020-03-{d:02d}", rng.choice(["p", None])) for d in range(1, 20)]
    return spark.createDataFrame(data, "who string, day string, what string").repartition(5).cache()


def test_hot_keys_are_those_above_the_bar(visits):
    assert skew.hot_keys(visits, ["who"]) is None
    assert skew.hot_keys(visits, ["who"], hot_rows=5000, slices=4) is None
    listed, slices = skew.hot_keys(visits, ["who"], hot_rows=100, slices=4)
    assert rows(listed) == [("hot",)] and slices == 4
    assert skew.slice_count(visits, 10) == 32
    assert skew.slice_count(visits, 10**9) == 500
    assert skew.slice_count(visits, 10**12) == 500_000
    assert skew.hot_keys(visits.filter("false"), ["who"], hot_rows=1) is None


@pytest.mark.parametrize("chunk", [1_000_000, 7])
def test_running_count_of_a_split_key(visits, monkeypatch, chunk):
    monkeypatch.setattr(sequence, "_CHUNK", chunk)
    order = sequence.full_order(visits, ["who"], ["day"])
    frame = Window.partitionBy("who").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    wanted = rows(visits.withColumn("n", F.count("what").over(frame)))
    plain = sequence.running_count(visits, ["who"], ["day"], "what", "n")
    split = sequence.running_count(visits, ["who"], ["day"], "what", "n", hot_rows=10, slices=6)
    assert rows(plain) == wanted
    assert rows(split) == wanted


@pytest.mark.parametrize("value", ["day", "what"])
def test_previous_value_of_a_split_key(visits, value):
    order = sequence.full_order(visits, ["who"], ["day"])
    wanted = rows(visits.withColumn("p", F.lag(value).over(Window.partitionBy("who").orderBy(*order))))
    plain = sequence.previous_value(visits, ["who"], ["day"], value, "p")
    split = sequence.previous_value(visits, ["who"], ["day"], value, "p", hot_rows=10, slices=6)
    assert rows(plain) == wanted
    assert rows(split) == wanted


def test_split_plan_gathers_no_key(visits, capsys):
    split = sequence.running_count(visits, ["who"], ["day"], "what", "n", hot_rows=10, slices=6)
    split.explain()
    plan = capsys.readouterr().out
    assert "SinglePartition" not in plan
    assert "_slice" in plan


@pytest.mark.parametrize("slices, tree", [(1, 256), (5, 256), (40, 256), (40, 3)])
def test_percent_rank_equals_the_one_task_window(spark, monkeypatch, slices, tree):
    monkeypatch.setattr(ranking, "TREE", tree)
    rng = random.Random(3)
    data = [(i, rng.choice([None, 1.0, 2.0, float(rng.randint(3, 900))])) for i in range(3000)]
    df = spark.createDataFrame(data, "id int, v double")
    wanted = df.withColumn("p", F.percent_rank().over(Window.orderBy(F.col("v").desc())))
    got = ranking.percent_rank_over_all(df, "v", "p", slices=slices)
    assert rows(got) == rows(wanted)


def test_percent_rank_with_one_value_in_many_slices(spark):
    data = [(i, 7.0 if i % 3 else float(i % 5)) for i in range(2000)]
    df = spark.createDataFrame(data, "id int, v double")
    wanted = df.withColumn("p", F.percent_rank().over(Window.orderBy(F.col("v").desc())))
    assert rows(ranking.percent_rank_over_all(df, "v", "p", slices=12)) == rows(wanted)


def test_inputs_that_vary_are_read_once(spark):
    drawn = spark.range(2000).select((F.col("id") % 3).alias("g"), F.floor(F.rand() * 50).alias("v"), F.rand().alias("x"))
    assert cleaning.deduplicate(drawn, ["g", "v"]).groupBy("g", "v").count().filter("count > 1").count() == 0
    ranked = ranking.top_ranked(drawn, ["g"], "v", 1, "r")
    assert ranked.select("g").distinct().count() == 3


def test_percent_rank_of_one_and_no_rows(spark):
    one = spark.createDataFrame([(1, 5.0)], "id int, v double")
    assert rows(ranking.percent_rank_over_all(one, "v", "p")) == [(1, 5.0, 0.0)]
    assert rows(ranking.percent_rank_over_all(one.filter("id > 1"), "v", "p")) == []
    assert rows(ranking.percent_rank_head(one, "v", 3, "p", ties=["id"], columns=["id"])) == [(1, 0.0)]


def test_percent_rank_head_equals_the_head_of_all(spark):
    data = [(i, float(i % 40)) for i in range(400)]
    df = spark.createDataFrame(data, "id int, v double")
    full = df.withColumn("p", F.percent_rank().over(Window.orderBy(F.col("v").desc())))
    wanted = full.orderBy(F.col("v").desc(), "id").limit(25).select("id", "p")
    assert rows(ranking.percent_rank_head(df, "v", 25, "p", ties=["id"], columns=["id"])) == rows(wanted)


def test_top_ranked_keeps_all_ties(spark):
    data = [("a", v, i) for i, v in enumerate([9, 9, 8, 7, 7, 7, 1])] + [("b", 3, 10), ("b", None, 11), (None, 4, 12)]
    df = spark.createDataFrame(data, "g string, v int, id int")
    window = Window.partitionBy("g").orderBy(F.desc("v"))
    for k in (1, 2, 4, 10):
        wanted = df.withColumn("r", F.rank().over(window)).filter(f"r <= {k}")
        assert rows(ranking.top_ranked(df, ["g"], "v", k, "r")) == rows(wanted)
        assert rows(ranking.top_ranked(df, ["g"], "v", k, "r", hot_rows=2)) == rows(wanted)


def test_top_ranked_limits_each_task_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 as g", "id as v")
    plan = plan_of(ranking.top_ranked(df, ["g"], "v", 2, "r"))
    assert "rank(v" in plan and "2, Partial" in plan


def test_top_ranked_computes_a_dear_input_once(spark):
    left = spark.range(300).selectExpr("id % 7 as g", "id as v")
    joined = left.join(spark.range(7).selectExpr("id as g", "id * 2 as w"), "g")
    ranked = ranking.top_ranked(joined, ["g"], "v", 2, "r")
    assert "Join" not in plan_of(ranked) and ranked.count() == 14


def test_latest_per_key_is_the_same_every_time(spark):
    data = [("a", "2020-01-02", "r2"), ("a", "2020-01-02", "r1"), ("a", "2019-01-01", "r0"), ("b", None, "r9")]
    df = spark.createDataFrame(data, "who string, day string, id string")
    got = ranking.latest_per_key(df, ["who"], "day", ["id"])
    assert rows(got) == [("a", "2020-01-02", "r1"), ("b", None, "r9")]


def test_one_per_key_plan_drops_rows_early(spark, capsys):
    df = spark.range(100).selectExpr("id % 3 as g", "id as v")
    ranking.one_per_key(df, ["g"], [F.col("v").desc()]).explain()
    assert capsys.readouterr().out.count("WindowGroupLimit") == 2


def test_first_rows_uses_a_bounded_sort(spark, capsys):
    df = spark.range(100).selectExpr("id", "id % 5 as v")
    got = ranking.first_rows(df, 3, [F.desc("v")], ties=["id"], columns=["v", "id"])
    assert [tuple(r) for r in got.collect()] == [(4, 4), (4, 9), (4, 14)]
    got.explain()
    assert "TakeOrderedAndProject" in capsys.readouterr().out


def test_group_mean_equals_the_window(spark):
    data = [("a", 1.0), ("a", 2.0), ("a", None), ("b", None), (None, 4.0), (None, 6.0)]
    df = spark.createDataFrame(data, "g string, v double")
    wanted = df.withColumn("m", F.avg("v").over(Window.partitionBy("g")))
    assert rows(aggregate.with_group_mean(df, ["g"], "v", "m")) == rows(wanted)


def test_stats_by_attribute_equals_join_then_group(spark):
    fact = spark.createDataFrame(
        [("x", 1.0, "r1"), ("x", 3.0, None), ("y", None, "r3"), ("z", 8.0, "r4"), (None, 9.0, "r5")],
        "k string, v double, id string",
    )
    dim = spark.createDataFrame([("x", "s1"), ("y", "s1"), ("y", "s2"), ("y", "s2"), ("w", "s3"), (None, "s4")], "k string, s string")
    joined = fact.join(dim, "k").groupBy("s").agg(F.count("id").alias("n"), F.avg("v").alias("m"))
    got = aggregate.stats_by_attribute(fact, dim, "k", ["s"], counts={"n": "id"}, means={"m": "v"})
    assert rows(got) == rows(joined)
    both = fact.join(dim, "k").groupBy("k", "s").agg(F.count("id").alias("n"), F.avg("v").alias("m"))
    keyed = aggregate.stats_by_attribute(fact, dim, "k", ["k", "s"], counts={"n": "id"}, means={"m": "v"})
    assert rows(keyed) == rows(both)


def test_adaptive_execution_splits_a_hot_key_in_a_lookup(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        hot = F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 1000).cast("string"))
        df = spark.range(0, 300_000, 1, 8).select(hot.alias("k"), F.xxhash64("id").alias("v"))
        found = skew.attach(df, df.groupBy("k").agg(F.count("v").alias("n")), ["k"])
        assert found.filter("v <> 0").groupBy("k").agg((F.count("v") == F.max("n")).alias("same")).filter("not same").count() == 0
        narrow = found.filter("v <> 0")
        narrow.collect()
        assert "SortMergeJoin(skew=true)" in narrow._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)
