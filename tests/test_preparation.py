"""Cleaning, flattening, screening, scaling, and the stages put together."""

import datetime
import decimal
import math
import random

import places
import pytest
from pyspark.sql import functions as F

from plazaframe.functions import dates, text
from plazaframe.operators import cleaning, flattening, quantiles, reducing, scaling
from plazaframe.operators.quantiles import exact_quantiles
from plazaframe.plans import preparation
from plazaframe.plans.preparation import Settings
from plazaframe.schemas import KEYS
from plazaframe.sinks.files import write_tables
from plazaframe.sources.tables import json_sources, open_tables, parquet_sources


@pytest.fixture(scope="module")
def t(spark):
    return places.frames(spark)


def rows(df, *columns):
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]


# ---- expressions


def test_list_counts(spark):
    data = [(1, None), (2, ""), (3, "None"), (4, "Unknown"), (5, " a ,, b,"), (6, "a,b,c"), (7, " ")]
    df = spark.createDataFrame(data, "id int, v string")
    assert rows(df.select(text.token_count("v"))) == [(0,), (0,), (0,), (0,), (2,), (3,), (0,)]
    assert rows(df.select(text.entry_count("v"))) == [(0,), (0,), (1,), (1,), (4,), (3,), (0,)]
    assert rows(df.select(text.filled("v"))) == [(False,), (False,), (True,), (True,), (True,), (True,), (True,)]


def test_entry_count_equals_the_size_of_the_split(spark):
    rng = random.Random(5)
    data = [("".join(rng.choice("ab ,é") for _ in range(rng.randint(1, 12))),) for _ in range(300)]
    df = spark.createDataFrame(data, "v string").filter("trim(v) <> ''")
    split = F.size(F.split(F.trim("v"), r"\s*,\s*"))
    assert df.filter(text.entry_count("v") != split).count() == 0


def test_dates_of_every_kind(spark):
    data = [("2020-02-03 04:05:06",), ("2020-02-03",), (" 2020-02 ",), ("junk",), (None,), ("2020-02-03 01:00:00, 2021-01-01 00:00:00",), ("2020-13-40",)]
    df = spark.createDataFrame(data, "date string")
    got = dates.with_date_parts(df)
    assert got.columns == ["date", "date_parsed", "date_year", "date_month", "date_day_of_week"]
    monday = (datetime.date(2020, 2, 3), 2020, 2, 2)
    nothing = (None, None, None, None)
    wanted = [monday, monday, (datetime.date(2020, 2, 1), 2020, 2, 7), nothing, nothing, monday, nothing]
    assert rows(got.drop("date")) == wanted
    assert dates.with_date_parts(df.select(F.lit(1).alias("x"))).columns == ["x"]


# ---- cleaning


def gaps(spark):
    data = [
        ("a", 1, 1.0, None, decimal.Decimal("1.50")),
        ("b", None, float("nan"), "x", None),
        ("c", 2, 3.0, "y", decimal.Decimal("2.50")),
        ("d", 4, None, "", decimal.Decimal("9.00")),
        (None, 100, 100.0, "z", decimal.Decimal("100.00")),
    ]
    return spark.createDataFrame(data, "k string, n int, d double, s string, m decimal(10,2)")


def test_impute_median(spark):
    got = cleaning.impute(gaps(spark), ["k"])
    assert sorted(rows(got)) == [
        ("a", 1, 1.0, "Unknown", decimal.Decimal("1.50")),
        ("b", 2, 1.0, "x", decimal.Decimal("2.50")),
        ("c", 2, 3.0, "y", decimal.Decimal("2.50")),
        ("d", 4, 1.0, "", decimal.Decimal("9.00")),
    ]
    assert dict(got.dtypes) == dict(gaps(spark).dtypes)


def test_impute_mean_cuts_fractions_of_whole_numbers(spark):
    got = cleaning.impute(gaps(spark), ["k"], "mean", text="?", leave=["m"])
    assert sorted(rows(got)) == [
        ("a", 1, 1.0, "?", decimal.Decimal("1.50")),
        ("b", 2, 2.0, "x", None),
        ("c", 2, 3.0, "y", decimal.Decimal("2.50")),
        ("d", 4, 2.0, "", decimal.Decimal("9.00")),
    ]


def test_impute_all_null_column_with_zero(spark):
    df = spark.createDataFrame([("a", None), ("b", None)], "k string, n int")
    assert sorted(rows(cleaning.impute(df, ["k"]))) == [("a", 0), ("b", 0)]
    assert rows(cleaning.impute(df.filter("false"), ["k"])) == []
    with pytest.raises(ValueError):
        cleaning.impute(df, ["k"], "mode")


def test_median_is_exact_or_within_the_error(spark):
    df = spark.range(10001).select(F.col("id").alias("v"))
    assert cleaning.fill_values(df, ["v"])[0]["v"] == 5000
    assert abs(cleaning.fill_values(df, ["v"], relative_error=0.01)[0]["v"] - 5000) <= 100


def test_quantiles_of_three_million_values_are_exact(spark):
    df = spark.range(3_000_000).select((F.xxhash64("id") / 2**40).alias("v"), F.when(F.col("id") % 2 == 0, F.col("id")).alias("w"))
    got = exact_quantiles(df, ["v", "w"], [0.25, 0.5, 0.75])
    for c in ("v", "w"):
        wanted = df.selectExpr(*(f"percentile_disc({p}) WITHIN GROUP (ORDER BY {c})" for p in (0.25, 0.5, 0.75))).first()
        assert got[c] == [float(x) for x in wanted]


def test_quantiles_of_awkward_doubles(spark):
    draw = random.Random(6)
    inf = float("inf")
    near = [math.nextafter(1e9, inf)]
    while len(near) < 3000:
        near.append(math.nextafter(near[-1], inf))
    columns = [
        [draw.choice([inf, -inf, 0.0, -0.0, 5e-324, -5e-324, 1.7e308, -1.7e308, 1.0, -1.0]) for _ in range(3000)],
        [draw.uniform(-1, 1) * 10.0 ** draw.randint(-300, 300) for _ in range(3000)],
        draw.sample(near, 3000),  # neighbours
        [float(draw.randint(-3, 3)) for _ in range(3000)],
        [7.5] * 3000,
        [1e300] * 2999 + [-1e-300],
    ]
    names = [f"c {i}" for i in range(len(columns))]
    df = spark.createDataFrame(list(zip(*columns)), ", ".join(f"`{n}` double" for n in names)).repartition(5)
    parts = [0.0, 0.01, 0.25, 0.5, 0.999, 1.0]
    got = exact_quantiles(df, names, parts)
    for name, values in zip(names, columns):
        ordered = sorted(values)
        assert got[name] == [ordered[max(math.ceil(round(p * 3000, 6)), 1) - 1] for p in parts]


def test_quantiles_send_counts_only(spark, monkeypatch):
    df = spark.range(200_000).select(F.sqrt("id").alias("v"))
    sent = []
    inner = quantiles._counts

    def watched(*args, **options):
        found = inner(*args, **options)
        sent.append(sum(map(len, found.values())))
        return found

    monkeypatch.setattr(quantiles, "_counts", watched)
    assert exact_quantiles(df, ["v"], [0.5]) == {"v": [99_999**0.5]}
    assert len(sent) <= 2 and sum(sent) <= 2 * quantiles.BUCKETS
    monkeypatch.setattr(quantiles, "_guesses", lambda *_: [[(-5.0, -4.0)]])  # a sample that misleads
    assert exact_quantiles(df, ["v"], [0.5]) == {"v": [99_999**0.5]}


def test_quantiles_without_values(spark):
    df = spark.createDataFrame([(None, float("nan"))], "a double, b double")
    assert exact_quantiles(df, ["a", "b"], [0.5]) == {"a": [None], "b": [None]}
    assert exact_quantiles(df, [], [0.5]) == {}


def test_complete_rows(spark):
    assert [r[0] for r in rows(cleaning.complete_rows(gaps(spark)))] == ["c"]


def test_deduplicate_keeps_the_smallest(spark):
    data = [("a", 2, {"x": "1"}), ("a", 1, {"y": "2"}), ("a", 1, {"x": "3"}), ("b", None, None), ("b", 5, None), (None, 1, None), (None, 2, None)]
    df = spark.createDataFrame(data, "k string, n int, m map<string,string>").repartition(3)
    got = cleaning.deduplicate(df, ["k"])
    assert sorted(rows(got), key=str) == sorted([("a", 1, {"x": "3"}), ("b", None, None), (None, 1, None)], key=str)
    latest = cleaning.deduplicate(df, ["k"], [F.col("n").desc()])
    assert sorted(rows(latest, "k", "n"), key=str) == sorted([("a", 2), ("b", 5), (None, 2)], key=str)


def test_deduplicate_without_duplicates_shuffles_nothing(spark, capsys):
    df = spark.range(20).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    cleaning.deduplicate(df, ["k"]).explain()
    assert "Exchange" not in capsys.readouterr().out
    assert cleaning.deduplicate(df, ["other"]) is df
    assert cleaning.deduplicate(df, []) is df
    only_key = df.select("k").unionByName(df.select("k"))
    assert cleaning.deduplicate(only_key, ["k"]).count() == 20


# ---- flattening


def test_flatten_places(t):
    got = flattening.flatten(t["business"], "business").orderBy("business_id")
    extra = [c for c in got.columns if c not in t["business"].columns]
    assert len(flattening.ATTRIBUTES) == 33
    assert extra[:2] == ["attr_GoodForKids", "attr_RestaurantsPriceRange2"]
    assert extra[33:] == ["open_days_count", "hours_mon", "hours_tue", "hours_wed", "hours_thu", "hours_fri", "hours_sat", "hours_sun", "category_count"]
    wanted = ["attr_WiFi", "attr_HasTV", "attr_Music", "open_days_count", "hours_mon", "hours_sun", "category_count"]
    assert rows(got, *wanted)[:3] == [
        ("free", "True", None, 2, "9:0-17:0", None, 2),
        (None, None, None, 0, None, None, 2),
        (None, None, None, 0, None, None, 2),
    ]
    assert [r[0] for r in rows(got, "category_count")] == [2, 2, 2, 1, 2, 0, 0, 2, 0]


def test_flatten_users_and_checkins(t):
    got = flattening.flatten(t["user"], "user").orderBy("user_id")
    assert rows(got, "friend_count", "elite_count", "is_elite") == [
        (2, 2, 1),
        (0, 1, 1),
        (1, 0, 0),
        (0, 0, 0),
        (2, 1, 1),
        (0, 3, 1),
    ]
    checkins = flattening.flatten(t["checkin"], "checkin")
    assert sorted(rows(checkins, "business_id", "checkin_count")) == [("b1", 1), ("b1", 3), ("b2", 0), ("b4", 0), ("b4", 2), ("b99", 1)]
    assert flattening.flatten(t["tip"], "tip") is t["tip"]


def test_key_columns_are_safe_and_lose_no_key():
    assert flattening.key_columns(["a.b c-d", "x" * 60], "attr_") == {"a.b c-d": "attr_a_b_c_d", "x" * 60: "attr_" + "x" * 60}
    assert flattening.key_columns(["a.b", "a b", "a-b", "a.b"], "p_") == {"a.b": "p_a_b", "a b": "p_a_b_2", "a-b": "p_a_b_3"}
    long = ["y" * 60 + "1", "y" * 60 + "2"]
    assert len(set(flattening.key_columns(long, "p_").values())) == 2


# ---- screening and scaling


def mixed(spark):
    data = [
        ("i1", 1.0, "a", None, 7, 0.0, float("nan"), {"k": "v"}, {"k": "v"}),
        ("i2", 2.0, "a", None, None, -0.0, float("nan"), {"k": "v"}, {"k": "w"}),
        ("i3", None, None, None, 7, 0.0, float("nan"), None, None),
    ]
    return spark.createDataFrame(
        data,
        "user_id string, v double, s string, e string, c int, z double, n double, m map<string,string>, w map<string,string>",
    )


def test_screen_equals_distinct_counts(spark):
    df = mixed(spark)
    plain = [c for c in df.columns if c not in ("m", "w", "user_id")]
    counts = df.agg(*(F.count_distinct(c).alias(c) for c in plain)).first().asDict()
    found = scaling.constant_columns(df)
    assert [c for c in found if c in plain] == sorted(c for c in plain if counts[c] <= 1)
    assert found == ["c", "e", "m", "n", "s", "z"]
    assert "c" not in scaling.constant_columns(df, keep=["c"])


def test_screen_needs_two_rows(spark):
    assert scaling.constant_columns(mixed(spark).limit(1)) == []
    assert scaling.constant_columns(mixed(spark).filter("false")) == []


def test_minmax(spark):
    data = [("p", 1, 10.0, 3, None, 2020, 1), ("q", 3, None, 3, None, 2021, 0), ("r", 2, 30.0, 3, None, 2022, 1)]
    df = spark.createDataFrame(data, "user_id string, a int, b double, same int, empty double, d_year int, is_open int")
    got = scaling.scale(df)
    assert got.columns == df.columns
    assert rows(got) == [
        ("p", 0.0, 0.0, 0.0, None, 2020, 1),
        ("q", 1.0, None, 0.0, None, 2021, 0),
        ("r", 0.5, 1.0, 0.0, None, 2022, 1),
    ]
    assert scaling.scale(df, "none") is df
    assert rows(scaling.scale(df, exclude=["a"]), "a") == [(1,), (3,), (2,)]


def test_standard(spark):
    df = spark.createDataFrame([(1.0, 5, None), (2.0, 5, 1.0), (6.0, 5, None)], "a double, same int, once double")
    got = rows(scaling.scale(df, "standard"))
    sd = math.sqrt(7.0)
    assert [r[0] for r in got] == pytest.approx([-2 / sd, -1 / sd, 3 / sd])
    assert [r[1] for r in got] == [0.0, 0.0, 0.0]
    assert [r[2] for r in got] == [None, 1.0, None]  # one value has no deviation: left alone
    with pytest.raises(ValueError):
        scaling.scale(df, "robust")


def test_scaled_values_lie_between_0_and_1(spark):
    rng = random.Random(1)
    df = spark.createDataFrame([(rng.uniform(-1e6, 1e6), rng.randint(-(2**31), 2**31 - 1)) for _ in range(200)], "a double, b int")
    outside = scaling.scale(df).filter(~(F.col("a").between(0, 1) & F.col("b").between(0, 1)))
    assert outside.count() == 0


def test_bins(spark):
    df = spark.createDataFrame([(v,) for v in [-1.0, 0.0, 4.9, 5.0, 10.0, 10.1, None]], "v double")
    assert [r[1] for r in rows(scaling.with_bins(df, {"v": [10, 0, 5]}))] == [None, 0, 0, 1, 1, None, None]


# ---- reducing


def test_samples(spark):
    df = spark.range(2000)
    assert reducing.sample_rows(df, None) is df
    assert reducing.sample_rows(df, 1.0) is df
    assert 0 < reducing.sample_rows(df, 0.1).count() < 500
    one, other = (set(rows(reducing.sample_by_key(df.repartition(n), "id", 0.2))) for n in (1, 7))
    assert one == other and 300 < len(one) < 500


def test_principal_components(spark):
    rng = random.Random(2)
    base = [(rng.gauss(0, 10), rng.gauss(0, 1)) for _ in range(200)]
    data = [(x + y, x - y, 2 * y, [x + y, x - y, 2 * y]) for x, y in base]
    df = spark.createDataFrame(data, "a double, b double, c double, v array<double>")
    by_columns = rows(reducing.principal_components(df, ["a", "b", "c"], 2), "components")
    by_array = rows(reducing.principal_components(df, ["v"], 2), "components")
    assert by_columns == by_array

    def variance(values):
        mean = sum(values) / len(values)
        return sum((v - mean) ** 2 for v in values)

    kept = sum(variance([r[0][i] for r in by_columns]) for i in range(2))
    assert kept == pytest.approx(sum(variance([d[i] for d in data]) for i in range(3)))


# ---- the stages together


def twice_and_gappy(t):
    users = t["user"]
    return users.unionByName(users.filter("user_id = 'u1'").withColumn("fans", F.lit(1))).unionByName(
        users.limit(1).withColumn("user_id", F.lit(None).cast("string"))
    )


@pytest.mark.parametrize("write_cleaned", [True, False])
def test_prepare_users(t, write_cleaned):
    done = preparation.prepare(twice_and_gappy(t), "user", write_cleaned=write_cleaned)
    got = done.frame.orderBy("user_id")
    assert [r[0] for r in rows(got, "user_id")] == ["u1", "u2", "u3", "u4", "u5", "u6"]
    assert rows(got, "fans")[0] == (0.0,)  # of the two rows of u1 the one with fewer fans stays
    assert rows(got, "friend_count", "is_elite") == [(1.0, 1), (0.0, 1), (0.5, 0), (0.0, 0), (1.0, 1), (0.0, 1)]
    assert "friends" not in got.columns and "elite" not in got.columns and "yelping_since" in got.columns
    assert rows(got, "yelping_since_year") == [(2010,), (2010,), (2010,), (2011,), (2011,), (None,)]
    assert done.dropped_constant == ["cool", "funny"]
    by_stage = {s.stage: s for s in done.steps}
    assert by_stage["load"].rows == 8 and by_stage["clean"].rows == 6 and by_stage["reduce"].rows == 6
    assert by_stage["flatten"].record()[5] == ["friend_count", "elite_count", "is_elite"]
    assert by_stage["prune"].record()[6] == ["friends", "elite"]


def test_prepare_equals_the_stages_one_by_one(t):
    frames = {**t, "user": twice_and_gappy(t)}
    for stage in preparation.STAGES:
        frames = preparation.run_stage(stage, frames)
    for name, df in t.items():
        given = twice_and_gappy(t) if name == "user" else df
        whole = preparation.prepare(given, name).frame
        assert whole.columns == frames[name].columns
        assert sorted(rows(whole), key=str) == sorted(rows(frames[name]), key=str)


def test_prepare_drops_rows_with_nulls(t):
    settings = Settings(keys=["review_id"], nulls="drop", scaling="standard", drop=["date"], sample_fraction=0.99)
    done = preparation.prepare(t["review"], "review", settings)
    assert done.frame.count() <= 7
    assert done.steps[0].rows is None and done.steps[1].rows == 7 and done.steps[-1].rows is None


def test_prepare_with_bins_and_components(t):
    settings = Settings(keys=["business_id"], prune=["attributes", "hours", "categories"], bins={"stars": [0, 3, 5]}, components=2)
    got = preparation.prepare(t["business"], "business", settings).frame.orderBy("business_id")
    assert rows(got, "stars_bin")[:2] == [(1,), (1,)] and rows(got, "stars_bin")[8] == (0,)
    assert all(len(r[0]) == 2 for r in rows(got, "components"))


def test_prepare_empty_and_single(t, spark):
    for rows_wanted, df in [(0, t["photo"].filter("false")), (1, t["photo"].limit(1)), (0, spark.createDataFrame([], t["photo"].schema))]:
        done = preparation.prepare(df, "photo")
        assert done.frame.columns == t["photo"].columns  # nothing is screened out below two rows
        assert done.frame.count() == rows_wanted
        assert done.steps[0].rows == rows_wanted


def test_prepare_all_write_and_audit(spark, t, tmp_path):
    for name in ("tip", "photo", "checkin"):
        t[name].write.json(str(tmp_path / "raw" / name))
    sources = json_sources({name: str(tmp_path / "raw" / name) for name in KEYS})
    with pytest.warns(UserWarning):
        prepared = preparation.prepare_all(spark, sources)
    assert sorted(prepared) == ["checkin", "photo", "tip"]
    out = str(tmp_path / "out")
    written = write_tables({n: p.frame for n, p in prepared.items()}, out)
    assert written == {"tip": 9 - 1, "photo": 5, "checkin": 5}
    back = open_tables(spark, parquet_sources(out, prepared))
    assert {n: df.count() for n, df in back.items()} == written
    preparation.write_audit(spark, preparation.with_final_counts(prepared, written), f"{out}/audit")
    audit = preparation.read_audit(spark, f"{out}/audit")
    assert audit.count() == 3 * 7
    assert rows(audit.filter("table = 'checkin' and stage = 'load'"), "rows") == [(6,)]
    assert rows(audit.filter("table = 'checkin' and stage = 'clean'"), "rows") == [(5,)]
    with pytest.warns(UserWarning):
        assert preparation.read_audit(spark, f"{out}/none") is None


def test_default_settings_cover_the_six_tables():
    found = preparation.default_settings()
    assert list(found) == list(KEYS)
    assert found["tip"].keys == ["user_id", "business_id", "date"] and found["tip"].drop == ["date"]
