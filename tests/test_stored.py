"""Stored layouts, stored profiles, keyed comparison and quarantine."""

import math
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from plazaframe.operators import comparison, sequence, stored_profiles
from plazaframe.plans import preparation, resuming
from plazaframe.sinks import replacing
from plazaframe.sinks.copartitioned import join_in_place, open_copartitioned, write_copartitioned
from plazaframe.sources.quarantine import bad_share, open_separated, separate
from plazaframe.sources.tables import Source, json_sources


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def visits(spark):
    draw = random.Random(5)
    data = [(draw.choice([None, 1, 2, 3, 4, 50, 60]), i, f"d{draw.randint(1, 30):02}") for i in range(600)]
    return spark.createDataFrame(data, "`the key` long, id long, day string")


def test_joins_and_windows_inside_the_buckets(spark, visits, tmp_path):
    places = spark.createDataFrame([(k, f"p{k}") for k in (1, 2, 3, 9)], "place long, name string")
    notes = spark.createDataFrame([(k, k * 1.5) for k in (1, 1, 3, 50)], "about long, note double")
    keys = {"visits": "the key", "places": "place", "notes": "about"}
    frames = {"visits": visits, "places": places, "notes": notes}
    told = write_copartitioned(frames, str(tmp_path), keys, 4, order={"visits": ["day", "id"]})
    assert {r["name"]: r["largest"] for r in told.collect()}["places"] == 1
    stored = open_copartitioned(spark, str(tmp_path))
    assert {n: rows(df) for n, df in stored.items()} == {n: rows(df) for n, df in frames.items()}
    counts = stored["visits"].groupBy("the key").agg(F.count("id").alias("n"))
    joined = join_in_place(join_in_place(stored["places"], counts, "place", "the key"), stored["notes"], "place", "about")
    assert "Exchange" not in plan_of(joined) and "SortMergeJoin" in plan_of(joined)
    plain = places.join(visits.groupBy("the key").agg(F.count("id").alias("n")), places["place"] == F.col("the key")).join(notes, F.col("place") == F.col("about"))
    assert rows(joined) == rows(plain)
    counted = sequence.running_count(stored["visits"], ["the key"], ["day", "id"], "id", "n")
    assert "Exchange" not in plan_of(counted)
    assert rows(counted) == rows(sequence.running_count(visits, ["the key"], ["day", "id"], "id", "n"))
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("plazaframe_")]


def test_a_hot_key_is_opened_without_buckets(spark, visits, tmp_path):
    folder = str(tmp_path)
    write_copartitioned({"visits": visits}, folder, {"visits": "the key"}, 4)
    write_copartitioned({"more": visits.limit(10)}, folder, {"more": "id"}, 2)
    hot = open_copartitioned(spark, folder, ["visits"], hot_rows=20)["visits"]
    assert "Exchange" in plan_of(hot.groupBy("the key").count())
    assert rows(hot) == rows(visits)
    write_copartitioned({"visits": visits.limit(3)}, folder, {"visits": "the key"}, 4)  # replaced
    again = open_copartitioned(spark, folder)
    assert again["visits"].count() == 3 and again["more"].count() == 10
    with pytest.raises(ValueError):
        open_copartitioned(spark, folder, ["absent"])


def test_empty_tables_are_stored(spark, visits, tmp_path):
    write_copartitioned({"none": visits.where("id < 0")}, str(tmp_path), {"none": "id"}, 3)
    assert open_copartitioned(spark, str(tmp_path))["none"].count() == 0
    assert open_copartitioned(spark, str(tmp_path / "nothing")) == {}


def test_merged_profiles_equal_the_whole(spark, tmp_path):
    draw = random.Random(8)
    data = [(i, draw.choice([None, math.nan, draw.gauss(5, 2)]), draw.choice(["a", "b", None, f"x{i}"])) for i in range(6000)]
    df = spark.createDataFrame(data, "`row id` long, v double, t string").withColumns({"m": F.create_map(F.lit("k"), F.lit(1)), "d": F.lit("2020-01-02").cast("date")})
    for load in range(4):
        stored_profiles.profile(df.where(F.col("row id") % 4 == load), f"load {load}").write.mode("append").parquet(str(tmp_path))
    stored_profiles.profile(df.where("`row id` < 0"), "empty").write.mode("append").parquet(str(tmp_path))
    stored = spark.read.schema(stored_profiles.PROFILE).parquet(str(tmp_path))
    told = {r["column"]: r for r in stored_profiles.report(stored_profiles.merged(stored.union(stored))).collect()}
    whole = {r["column"]: r for r in stored_profiles.report(stored_profiles.profile(df, "all")).collect()}
    for c in df.columns:
        for field in ("rows", "missing", "low", "high", "least", "most"):
            assert told[c][field] == whole[c][field]
    known = sorted(v for _, v, _ in data if v is not None and not math.isnan(v))
    assert told["v"]["missing"] == 6000 - len(known) and (told["v"]["least"], told["v"]["most"]) == (known[0], known[-1])
    mean = sum(known) / len(known)
    assert told["v"]["mean"] == pytest.approx(mean) and told["v"]["stddev"] == pytest.approx(math.sqrt(sum((x - mean) ** 2 for x in known) / (len(known) - 1)))
    for p, q in zip((0.25, 0.5, 0.75), told["v"]["quantiles"]):
        assert abs(sum(x <= q for x in known) / len(known) - p) < 0.015
    distinct = len({t for _, _, t in data if t})
    assert abs(told["t"]["distinct"] - distinct) < 0.04 * distinct and (told["t"]["low"], told["t"]["quantiles"]) == ("a", None)
    assert (told["d"]["low"], told["d"]["distinct"], told["m"]["missing"]) == ("2020-01-02", 1, 0)


def test_profiles_of_nothing(spark):
    none = spark.createDataFrame([], "a int, b string")
    told = {r["column"]: r for r in stored_profiles.report(stored_profiles.merged(stored_profiles.profile(none, "x"))).collect()}
    assert (told["a"]["rows"], told["a"]["distinct"], told["a"]["quantiles"], told["a"]["mean"]) == (0, 0, None, None)
    assert stored_profiles.profile(none, "x", []).collect() == []


def test_changes_by_key(spark):
    schema = "k int, `a.b` string, v double, m map<string,int>, old int"
    before = spark.createDataFrame([(1, "x", 1.0, {"p": 1, "q": 2}, 1), (2, None, 2.0, None, 1), (3, "z", None, {}, 1), (None, "n", 1.0, {}, 1), (5, "r", 1.0, {}, 1), (5, "s", 2.0, {}, 1)], schema)
    after = spark.createDataFrame(
        [(1, "x", 1.0, {"q": 2, "p": 1}), (2, "", 2.0, None), (4, "new", 0.0, {}), (None, "n", 9.0, {"x": 1}), (5, "s", 2.0, {}), (5, "r", 1.0, {}), (3, "z", None, {}), (3, "z", None, {})],
        "k int, `a.b` string, v double, m map<string,int>",
    )
    found = {r["k"]: (r["state"], r["rows_before"], r["rows_after"], r["columns"]) for r in comparison.changed_keys(before, after, ["k"]).collect()}
    assert found == {
        2: ("changed", 1, 1, ["a.b"]),
        4: ("added", 0, 1, None),
        None: ("changed", 1, 1, ["v", "m"]),
        3: ("changed", 1, 2, ["a.b", "v", "m"]),
    }
    told = {(r["state"], r["column"]): (r["keys"], r["rows_before"], r["rows_after"]) for r in comparison.change_report(before, after, ["k"]).collect()}
    assert told[("changed", None)] == (3, 3, 4) and told[("changed", "v")] == (2, 2, 3) and ("removed", None) not in told
    assert comparison.change_report(before, before, ["k"]).collect() == []
    assert comparison.change_report(before.where("k < 0"), after.where("k < 0"), ["k"]).collect() == []
    retyped = before.withColumn("k2", F.lit(1)).withColumn("v", F.col("v").cast("int"))
    assert {c for r in comparison.changed_keys(before, retyped, ["k"]).collect() for c in r["columns"]} == {"v"}
    with pytest.raises(ValueError):
        comparison.changed_keys(before, after, ["absent"])


def test_bad_lines_are_set_aside(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "one.json").write_text('{"id": 1, "v": 2.5}\n{"id": 2, "v":\nnot json\n{"id": 3, "v": null, "more": 1}\n')
    (raw / "two.json").write_text('{"id": "five", "v": 1}\n{"id": 4, "v": 4}\n')
    source = Source(str(raw), "json", "id long, v double")
    parted = separate(spark, source, bad_folder=str(tmp_path / "bad"))
    assert rows(parted.good) == [(1, 2.5), (3, None), (4, 4.0)]
    assert sorted(r["line"] for r in parted.bad.collect()) == ['not json', '{"id": "five", "v": 1}', '{"id": 2, "v":']
    assert {(r["file"].rsplit("/", 1)[1], r["rows"], r["bad"]) for r in parted.files.collect()} == {("one.json", 2, 2), ("two.json", 1, 1)}
    spark.range(3).write.parquet(str(tmp_path / "plain"))
    sources = {"t": source, "p": Source(str(tmp_path / "plain")), "gone": Source(str(tmp_path / "gone"), "json", "a int")}
    with pytest.warns(UserWarning):
        frames, report = open_separated(spark, sources, str(tmp_path / "set aside"))
    assert set(frames) == {"t", "p"} and frames["t"].count() == 3 and frames["p"].count() == 3
    (line,) = bad_share(report).collect()
    assert tuple(line) == ("t", 3, 3, 2, 2, 0.5)
    with pytest.raises(ValueError):
        separate(spark, Source(str(raw), "json"))


def files_of(folder):
    return {str(f): f.stat().st_mtime_ns for f in folder.rglob("*.parquet")}


def test_a_failing_rewrite_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    assert replacing.replace_table(spark.range(5), path) == 5
    old = replacing.open_replaced(spark, path)
    failing = spark.range(1000).select(F.when(F.col("id") > 900, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="no"):
        replacing.replace_table(failing, path)
    assert replacing.open_replaced(spark, path).count() == 5
    assert replacing.replace_table(old.union(old), path) == 10  # reads what it replaces
    assert old.count() == 5 and replacing.open_replaced(spark, path).count() == 10
    assert replacing.replace_table(spark.range(0), path) == 0
    assert replacing.open_replaced(spark, path).count() == 0 and len(list((tmp_path / "t" / "versions").iterdir())) == 3
    with pytest.raises(FileNotFoundError):
        replacing.open_replaced(spark, str(tmp_path / "nothing"))


def test_a_slower_writer_gives_way(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    replacing.replace_table(spark.range(1), path)
    known = replacing._manifests(replacing.Folder(spark, path))
    replacing.replace_table(spark.range(2), path)
    with monkeypatch.context() as patch:
        patch.setattr(replacing, "_manifests", lambda folder: known)  # as it was when the slower one began
        with pytest.raises(RuntimeError):
            replacing.replace_table(spark.range(3), path)
    assert replacing.open_replaced(spark, path).count() == 2


def test_untouched_partitions_keep_their_files(spark, tmp_path):
    folder = tmp_path / "p"
    df = spark.range(100).selectExpr("id", "id % 4 AS part")
    replacing.replace_partitions(df, str(folder), ["part"])
    before = files_of(folder)
    with pytest.raises(Exception, match="no"):
        broken = df.withColumn("id", F.when(F.col("id") == 97, F.raise_error(F.lit("no"))).otherwise(F.col("id")))
        replacing.replace_partitions(broken, str(folder), ["part"])
    assert files_of(folder) == before
    replacing.replace_partitions(df.where("part = 2").withColumn("id", F.col("id") + 1000), str(folder), ["part"])
    after = files_of(folder)
    assert {f: t for f, t in before.items() if "part=2" not in f} == {f: t for f, t in after.items() if "part=2" not in f}
    assert spark.read.parquet(str(folder)).where("id >= 1000").count() == 25 and spark.read.parquet(str(folder)).count() == 100


def test_preparation_goes_on_behind_the_last_finished_stage(spark, tmp_path, monkeypatch):
    raw, folder = str(tmp_path / "raw"), str(tmp_path / "kept")
    data = [(i % 40, float(i % 7) if i % 5 else None, "2020-01-02", "same") for i in range(50)]
    spark.createDataFrame(data, "review_id int, stars double, date string, dull string").write.parquet(raw)
    sources = {"review": Source(raw)}
    settings = {"review": preparation.Settings(keys=["review_id"], drop=["date"], scale_exclude=["review_id"])}
    runs = []
    clean, transform = preparation.clean, preparation.transform
    monkeypatch.setattr(preparation, "clean", lambda *a: runs.append("clean") or clean(*a))

    def killed(*_):
        raise RuntimeError("killed")

    monkeypatch.setattr(preparation, "transform", killed)
    with pytest.raises(RuntimeError, match="killed"):
        resuming.prepare_resumable(spark, sources, folder, settings)
    assert runs == ["clean"]
    monkeypatch.setattr(preparation, "transform", transform)
    resumed = resuming.prepare_resumable(spark, sources, folder, settings)["review"]
    assert runs == ["clean"]
    whole = preparation.prepare_all(spark, sources, settings)["review"].frame
    assert resumed.columns == whole.columns and rows(resumed) == rows(whole)
    del runs[:]
    resuming.prepare_resumable(spark, sources, folder, settings)  # nothing left to do
    assert runs == []
    resuming.prepare_resumable(spark, sources, folder, {"review": replace(settings["review"], fill_numbers="mean")})
    assert runs == ["clean"]
    spark.createDataFrame(data[:3], "review_id int, stars double, date string, dull string").write.mode("append").parquet(raw)
    again = resuming.prepare_resumable(spark, sources, folder, settings)["review"]
    assert runs == ["clean", "clean"] and again.count() == 40


def test_bulk_paths_set_bad_lines_aside(spark, tmp_path):
    raw = tmp_path / "tip.json"
    raw.write_text('{"user_id": "u", "business_id": "b", "text": "t", "date": "2020-01-02", "compliment_count": 1}\nbroken\n')
    sources = json_sources({"tip": str(raw)})
    prepared = preparation.prepare_all(spark, sources, bad_folder=str(tmp_path / "bad"))
    assert prepared["tip"].frame.count() == 1
    assert [r["line"] for r in spark.read.json(str(tmp_path / "bad" / "tip")).collect()] == ["broken"]
    assert [(r["table"], r["rows"], r["bad"]) for r in spark.read.parquet(str(tmp_path / "bad" / "report")).collect()] == [("tip", 1, 1)]


def test_same_rows_counts_copies(spark):
    from plazaframe.plans.registered.storing import same_rows

    one, two = spark.createDataFrame([(1, None), (1, None), (2, "a")], "x long, y string"), spark.createDataFrame([("1", ""), ("2", "a"), ("1", None)], "x string, y string")
    assert same_rows(one, two) and same_rows(one.where("false"), two.where("false"))
    assert not same_rows(one, two.where("y IS NOT NULL")) and not same_rows(one.where("x = 2"), two) and not same_rows(one, two.where("x = 2"))


def test_run_everything_parses_no_lines_for_single_answers(spark, monkeypatch):
    import __spark_entry__ as entry_points
    from plazaframe.plans import catalogue

    read, plain = {}, catalogue.answers

    def asked(topic, frames, **how):
        read[topic] = {file.rsplit(".", 1)[-1] for df in frames.values() for file in df.inputFiles()}  # the last call is that of the comparison
        return plain(topic, frames, **how)

    monkeypatch.setattr(catalogue, "answers", asked)
    found = entry_points.queries()["run_everything"](spark, entry_points.SMALL).collect()
    assert all((r.answered, r.equal) == (6, 6) for r in found)
    assert read == {topic: {"parquet"} for topic in catalogue.TOPICS}
