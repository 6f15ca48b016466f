"""Reports over tables, distributions, sources and sinks."""

import random

import places
import pytest
from pyspark.sql import functions as F

from plazaframe.operators import cleaning, distribution, durable, profiling, scaling
from plazaframe.schemas import KEYS, SCHEMAS
from plazaframe.sinks.files import bounded_sample, write_csv, write_tables
from plazaframe.sources.tables import Source, counted, held, observed, open_table, open_tables


@pytest.fixture(scope="module")
def t(spark):
    return places.frames(spark)


def rows(df, *columns):
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]


def test_overview(t):
    got = profiling.overview({"tip": t["tip"], "photo": t["photo"].filter("false")})
    assert rows(got) == [("tip", 9, 5), ("photo", 0, 4)]


def test_null_report(t):
    got = profiling.null_report(t["tip"], "tip")
    assert got.columns == ["column", "n_rows", "null_count", "null_fraction", "table"]
    assert rows(got) == [
        ("compliment_count", 9, 1, 0.111111, "tip"),
        ("date", 9, 1, 0.111111, "tip"),
        ("text", 9, 1, 0.111111, "tip"),
        ("business_id", 9, 0, 0.0, "tip"),
        ("user_id", 9, 0, 0.0, "tip"),
    ]
    keyed = profiling.null_report(t["tip"], "tip", keys=KEYS["tip"], keys_only=True)
    assert [r[0] for r in rows(keyed)] == ["date", "business_id", "user_id"]
    keyless = profiling.null_report(t["tip"], "tip", keys=["other"], keys_only=True)
    assert keyless.count() == 5
    assert rows(profiling.null_report(t["tip"].filter("false"), "tip")) == []
    assert profiling.null_report(t["tip"], "tip", sample_fraction=0.5).columns == got.columns


def test_duplicate_report(t):
    doubled = t["tip"].unionByName(t["tip"])
    got = profiling.duplicate_reports({"tip": doubled, "photo": t["photo"], "other": t["photo"]}, KEYS)
    assert rows(got) == [
        ("tip", 18, 9, 9, "user_id,business_id,date"),
        ("photo", 5, 5, 0, "photo_id"),
        ("other", 5, 5, 0, None),
    ]
    assert rows(profiling.duplicate_report(t["tip"].filter("false"), "tip", KEYS["tip"]))[0][1:4] == (0, 0, 0)


def test_numbers(t):
    got = {r[0]: r[1:] for r in rows(profiling.numeric_stats(t["review"]))}
    assert got["stars"] == (1.0, 5.0, 4.0, 1.3229)
    assert got["useful"] == (1.0, 30.0, 7.3333, 8.9303)
    described = profiling.describe_numbers(t["review"].withColumn("d_year", F.lit(1)), not_ending=["_year"])
    assert described.columns == ["summary", "stars", "useful", "funny", "cool"]
    assert [r[0] for r in rows(described)] == ["count", "mean", "stddev", "min", "25%", "50%", "75%", "max"]
    assert profiling.describe_numbers(t["photo"]) is None


def test_string_distinct_counts_null_as_a_value(t):
    exact = dict(rows(profiling.string_distinct(t["photo"])))
    assert exact == {"photo_id": 5, "business_id": 4, "caption": 3, "label": 3}
    assert dict(rows(profiling.string_distinct(t["photo"], exact=False))) == exact
    empty = t["photo"].filter("false")
    assert dict(rows(profiling.string_distinct(empty, exact=False))) == dict.fromkeys(exact, 0)


def test_validation_report(t, spark):
    found = profiling.validation_dict(profiling.validation_report(t["tip"], "tip"))
    assert found["rows"] == "9" and found["column_count"] == "5"
    assert found["columns"]["compliment_count"] == {
        "type": "int",
        "null_count": "1",
        "null_percentage": "11.11",
        "min": "0",
        "max": "9",
        "mean": "4.125",
        "stddev": "2.8504",
    }
    assert found["columns"]["text"] == {"type": "string", "null_count": "1", "null_percentage": "11.11", "distinct_count": "9"}
    empty = profiling.validation_dict(profiling.validation_report(t["tip"].filter("false"), "tip"))
    assert empty["rows"] == "0" and empty["columns"]["text"]["null_percentage"] == "0.0"
    nothing = profiling.validation_report(spark.range(1).select(), "none")
    assert rows(nothing, "metric", "value") == [("error", "no columns")]
    mapped = profiling.validation_dict(profiling.validation_report(t["business"], "business", exact=False))
    assert mapped["columns"]["attributes"]["null_count"] == "7"


def test_validate_tables_goes_on_after_a_failure(t, spark):
    def fails():
        raise RuntimeError("no such disk")

    reports, status = profiling.validate_tables(spark, {"bad": fails, "photo": lambda: t["photo"]})
    assert list(reports) == ["photo"]
    assert rows(status) == [("bad", False, "no such disk"), ("photo", True, None)]


def test_impact(t):
    after = {"tip": t["tip"].filter("compliment_count > 2").drop("text").withColumn("x", F.lit(1))}
    got = profiling.impact(t, after)
    assert rows(got, "table", "raw_rows", "proc_rows", "delta_rows", "raw_cols", "proc_cols", "delta_cols", "added_cols", "removed_cols") == [
        ("tip", 9, 6, -3, 5, 5, 0, 1, 1)
    ]


def test_quartiles(spark):
    df = spark.createDataFrame([(float(i), i) for i in range(1, 101)] + [(None, 0), (float("nan"), 0)], "a double, b int")
    assert rows(distribution.quartiles(df, ["a", "b"])) == [("a", 25.0, 50.0, 75.0), ("b", 24.0, 49.0, 75.0)]


def test_distribution_counts_few_levels(spark):
    df = spark.createDataFrame([(v,) for v in [3, 1, 3, None]], "v int")
    assert rows(distribution.distribution(df, "v"), "value", "count") == [("1", 1), ("3", 2)]
    many = spark.createDataFrame([(f"w{i}",) for i in range(50)], "v string")
    assert distribution.distribution(many, "v").count() == 50


def test_distribution_bins_many_levels(spark):
    rng = random.Random(4)
    values = [rng.uniform(-5, 5) for _ in range(900)] + [float("nan"), None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = rows(distribution.distribution(df, "v"), "bin", "low", "high", "count")
    assert len(got) == 30 and sum(r[3] for r in got) == 900
    known = [v for v in values if v is not None and v == v]
    low, width = min(known), (max(known) - min(known)) / 30
    wanted = [0] * 30
    for v in known:
        wanted[min(29, int((v - low) / width))] += 1
    assert [r[3] for r in got] == wanted
    assert got[0][1] == low and got[-1][2] == pytest.approx(max(known))
    # 31 levels are one too many to list.
    assert distribution.distribution(spark.range(31).select(F.col("id").alias("v")), "v").filter("value is not null").count() == 0
    assert distribution.distribution(spark.range(30).select(F.col("id").alias("v")), "v").filter("value is not null").count() == 30


def test_degenerate(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, float("nan")), (3.0, None)], "a double, b double")
    assert not distribution.degenerate(df, "a")
    assert distribution.degenerate(df, "b")
    assert distribution.degenerate(df.filter("false"), "a")


# ---- sources and sinks


def test_open_tables_skips_what_is_missing(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "here"))
    sources = {"here": Source(str(tmp_path / "here")), "gone": Source(str(tmp_path / "gone"), "json", SCHEMAS["tip"])}
    with pytest.warns(UserWarning, match="'gone' skipped"):
        found = open_tables(spark, sources)
    assert list(found) == ["here"]


def test_rows_are_counted_in_passing(spark):
    watched, seen = observed(spark.range(7))
    watched.write.format("noop").mode("overwrite").save()
    assert counted(seen) == 7


def test_held_keeps_only_the_columns_asked_for(spark, t):
    with held({"review": t["review"]}, {"review": ["review_id", "stars", "nowhere"]}) as kept:
        assert kept["review"].columns == ["review_id", "stars"]
        assert kept["review"].is_cached
    assert not kept["review"].is_cached


def test_write_csv(spark, tmp_path):
    df = spark.range(100, numPartitions=4).orderBy(F.desc("id"))
    write_csv(df, str(tmp_path / "one"), single_file=True)
    files = list((tmp_path / "one").glob("*.csv"))
    assert len(files) == 1
    assert files[0].read_text().splitlines()[:3] == ["id", "99", "98"]
    write_csv(df.limit(5), str(tmp_path / "one"))
    assert len(list((tmp_path / "one").glob("*.csv"))) == 1
    assert files[0].exists() is False


def test_write_tables(spark, t, tmp_path):
    out = str(tmp_path / "out")
    assert write_tables({"photo": t["photo"], "tip": t["tip"].filter("false")}, out, num_partitions=2) == {"photo": 5, "tip": 0}
    assert write_tables({"photo": t["photo"]}, out, partition_by=["label", "nowhere"]) == {"photo": 5}
    assert {p.name for p in (tmp_path / "out" / "photo").glob("label=*")} == {"label=food", "label=menu", "label=x"}
    assert write_tables({"none": spark.createDataFrame([], "a int")}, out) == {"none": 0}


def test_bounded_sample(t):
    assert bounded_sample(t["review"], 1.0, max_rows=4, columns=["stars", "nowhere"]).columns == ["stars"]
    assert bounded_sample(t["review"], 1.0, max_rows=4).count() == 4
    with pytest.raises(ValueError):
        bounded_sample(t["review"], columns=["nowhere"])


def test_bounded_sample_draws_from_every_part(spark):
    drawn = bounded_sample(spark.range(0, 160_000, 1, 16), 0.5, max_rows=1600)
    found = drawn.groupBy(F.floor(F.col("id") / 10_000).alias("part")).count().collect()
    assert sum(r["count"] for r in found) == 1600
    assert len(found) == 16 and min(r["count"] for r in found) > 50


def test_reports_on_awkward_tables(spark):
    none = spark.createDataFrame([], "a string, n int")
    assert rows(profiling.string_distinct(none)) == [("a", 0)]
    texts, numbers = none.select("a"), none.select("n")
    assert rows(profiling.numeric_stats(texts)) == [] and rows(profiling.string_distinct(numbers)) == []
    assert rows(distribution.quartiles(numbers, [])) == [] and rows(distribution.quartiles(numbers, [], 0.01)) == []
    assert {(r["column"], r["metric"], r["value"]) for r in profiling.validation_report(none, "t").collect()} >= {("a", "distinct_count", "0")}
    long = spark.createDataFrame([("x" * 500,), ("x" * 500,), ("y" * 500,), (None,)], "a string")
    assert rows(profiling.string_distinct(long)) == [("a", 3)]


def test_histogram_leaves_infinite_values_out(spark):
    df = spark.createDataFrame([(float(i),) for i in range(100)] + [(float("inf"),), (float("-inf"),), (float("nan"),)], "v double")
    assert sum(r["count"] for r in distribution.distribution(df, "v").collect()) == 100


def test_scratch_deletes_what_it_held(spark, tmp_path):
    with durable.scratch(spark, str(tmp_path)):
        assert durable.materialise(spark.range(5)).count() == 5
        assert list(tmp_path.iterdir())
    assert not list(tmp_path.glob("*/*"))


def test_without_a_folder_nothing_is_written(spark, monkeypatch):
    monkeypatch.setattr(durable, "named_folder", lambda _: None)
    with pytest.raises(RuntimeError):
        durable.new_folder(spark)


def test_partitioned_tables_get_few_files(spark, tmp_path):
    df = spark.range(0, 4000, 1, 8).select("id", (F.col("id") % 5).alias("k"))
    assert write_tables({"t": df}, str(tmp_path), partition_by=["k", "nowhere"]) == {"t": 4000}
    assert len(list(tmp_path.glob("t/k=*/*.parquet"))) <= 10


def test_materialised_tables_can_be_dropped(spark):
    df = durable.materialise(spark.range(5))
    assert df.count() == 5
    assert durable.scratch_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
    durable.drop_materialised(spark)
    with pytest.raises(Exception):
        open_table(spark, Source(durable.scratch_folder(spark))).count()


def test_observed_columns_are_still_pruned(spark, tmp_path, capsys):
    spark.range(5).selectExpr("id as a", "id as b", "id as c").write.parquet(str(tmp_path / "p"))
    watched, _ = observed(open_table(spark, Source(str(tmp_path / "p"))))
    watched.select("b").explain()
    assert "ReadSchema: struct<b:bigint>" in capsys.readouterr().out


def test_odd_column_names(spark):
    names = ["it's", "a`b", "c.d", "e\\f"]
    df = spark.createDataFrame([("x", 1, None, 2.0), ("x", 3, 4, 5.0)], "a string, b int, c int, d double").toDF(*names)
    assert {r[0] for r in rows(profiling.null_report(df, "it's", keys=[]))} == set(names)
    found = profiling.validation_dict(profiling.validation_report(df, "t"))["columns"]
    assert found["c.d"]["null_count"] == "1" and found["e\\f"]["max"] == "5.0" and found["it's"]["distinct_count"] == "1"
    assert rows(distribution.quartiles(df, ["a`b"])) == [("a`b", 1.0, 1.0, 3.0)]
    assert scaling.constant_columns(df) == ["c.d", "it's"]
    assert cleaning.fill_values(df, ["a`b", "c.d"], "mean") == ({"a`b": 2.0, "c.d": 4.0}, 2)


def test_the_most_frequent_texts_only(spark):
    df = spark.createDataFrame([(x,) for x in "aabbbccdd"] + [(None,)], "t string")
    assert [(r["value"], r["count"]) for r in distribution.distribution(df, "t", top=2).collect()] == [("a", 2), ("b", 3)]
    assert [r["value"] for r in distribution.distribution(df, "t").collect()] == ["a", "b", "c", "d"]
