"""The 24 questions on small tables, with answers worked out by hand."""

import json

import places
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from plazaframe.plans import business, catalogue, engagement, review, user
from plazaframe.sources.tables import Source, json_sources


@pytest.fixture(scope="module")
def t(spark):
    return places.frames(spark)


def rows(df, *columns):
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]


# ---- places


def test_cities_by_open_places(t):
    got = business.cities_by_open_places(t["business"])
    assert got.columns == ["city", "open_business_count"]
    assert rows(got) == [("Reno", 3), ("Philadelphia", 2), (None, 1), ("Tampa", 1)]
    assert rows(business.cities_by_open_places(t["business"], n=1)) == [("Reno", 3)]


def test_most_reviewed_per_state(t):
    got = business.most_reviewed_per_state(t["business"], k=2)
    assert sorted(got.columns) == sorted(["state", "name", "city", "stars", "review_count", "rank_in_state"])
    assert rows(got, "state", "name", "rank_in_state") == [
        (None, "Gil's", 1),
        ("FL", "Hal's", 1),
        ("NV", "Fay's", 1),
        ("NV", "Dan's", 2),
        ("PA", "Ann's", 1),
        ("PA", "Bob's", 2),
    ]


def test_most_reviewed_per_state_keeps_ties(t):
    everything_open = t["business"].na.fill(1, ["is_open"]).replace(0, 1, ["is_open"])
    got = business.most_reviewed_per_state(everything_open, k=2)
    assert rows(got.filter("state = 'PA'"), "name", "rank_in_state") == [("Ann's", 1), ("Bob's", 2), ("Cat's", 2)]


def test_stars_per_state(t):
    got = business.stars_per_state(t["business"], t["review"])
    assert got.columns == ["state", "avg_review_stars", "total_reviews"]
    assert rows(got) == [("PA", 24 / 6, 6), ("NV", 5.0, 1)]


def test_most_reviewed_in_state(t):
    got = business.most_reviewed_in_state(t["business"], t["review"], at_least=2)
    assert got.columns == ["business_id", "name", "city", "total_reviews", "avg_stars"]
    assert rows(got) == [("b1", "Ann's", "Philadelphia", 3, 10 / 3), ("b3", "Cat's", "Philadelphia", 2, 4.5)]
    assert rows(business.most_reviewed_in_state(t["business"], t["review"])) == []


def test_stars_against_city(t):
    got = business.stars_against_city(t["business"], n=3)
    assert got.columns == ["name", "city", "state", "stars", "city_avg_stars", "diff_from_city_avg"]
    assert [r[0] for r in rows(got)] == ["Fay's", "Cat's", "Dan's"]
    assert rows(got)[0] == ("Fay's", "Reno", "NV", 5.0, 4.0, 1.0)
    everyone = {r[0]: r[-1] for r in rows(business.stars_against_city(t["business"]))}
    assert everyone["Gil's"] == 0.0 and everyone["Hal's"] is None and everyone["Ida's"] == 0.0


def test_top_open_restaurants(t):
    got = business.top_open_restaurants(t["business"])
    assert rows(got) == [("Ann's", "Philadelphia", "PA", 4.5, 200), ("Dan's", "Reno", "NV", 4.5, 100)]
    food = {"min_stars": 0, "min_reviews": 0, "category": "Food"}
    assert [r[0] for r in rows(business.top_open_restaurants(t["business"], **food))] == ["Bob's", "Eve's"]
    assert [r[0] for r in rows(business.top_open_restaurants(t["business"], **food, whole_category=True))] == ["Eve's"]


# ---- users


def test_top_elite_users(t):
    got = user.top_elite_users(t["user"])
    assert rows(got) == [("Kim", 900, 300, 4.0, 50), ("Pat", 800, 300, 4.0, 10), ("Lou", 600, 100, 3.0, 50)]


def test_stats_by_join_year(t):
    got = user.stats_by_join_year(t["user"])
    assert got.columns == ["join_year", "user_count", "avg_reviews", "avg_fans", "avg_rating_given", "avg_useful_votes"]
    assert rows(got) == [
        (None, 1, 800.0, 300.0, 4.0, 10.0),
        (2010, 3, 2200 / 3, 300.0, 3.0, 140 / 3),
        (2011, 2, 499.5, 350.0, 4.5, 30.0),
    ]


def test_most_useful_per_join_year(t):
    got = user.most_useful_per_join_year(t["user"], k=1)
    assert rows(got, "name", "join_year", "useful", "rank_in_cohort") == [
        ("Pat", None, 10, 1),
        ("Kim", 2010, 50, 1),
        ("Lou", 2010, 50, 1),
        ("Ned", 2011, 30, 1),
        ("Oda", 2011, 30, 1),
    ]


def test_top_tip_writers(t):
    got = user.top_tip_writers(t["user"], t["tip"])
    assert got.columns == ["user_id", "tip_count", "total_compliments_on_tips", "name", "review_count", "fans"]
    assert rows(got, "user_id", "tip_count", "total_compliments_on_tips") == [
        ("u1", 3, 12),
        ("u2", 2, 11),
        ("u3", 2, 10),
        ("u4", 1, 0),
    ]


def test_useful_reviews_by_elite_users(t):
    got = user.useful_reviews_by_elite_users(t["user"], t["review"])
    assert got.columns == ["name", "business_id", "stars", "useful", "funny", "cool", "date"]
    assert rows(got, "name", "business_id", "useful") == [
        ("Kim", "b1", 9),
        ("Kim", "b5", 7),
        ("Lou", "b3", 6),
        ("Lou", "b1", 5),
        ("Kim", "b2", 5),
    ]


def test_compliment_percentiles(t):
    got = user.compliment_percentiles(t["user"])
    assert got.columns == ["name", "fans", "review_count", "total_compliments", "percentile_rank"]
    # A null counter makes the total null, so Ned is not among the complimented.
    assert rows(got, "name", "total_compliments", "percentile_rank") == [
        ("Kim", 50, 0.0),
        ("Lou", 20, 1 / 3),
        ("Max", 20, 1 / 3),
        ("Pat", 10, 1.0),
    ]


# ---- reviews


def test_highly_voted_reviews(t):
    got = review.highly_voted_reviews(t["review"])
    assert got.columns == ["review_id", "business_id", "user_id", "stars", "useful", "funny", "cool", "date"]
    assert [r[0] for r in rows(got)] == ["r1", "r7", "r4"]


def test_reviews_by_month(t):
    assert rows(review.reviews_by_month(t["review"])) == [
        (None, 2, 3.5),
        ("2019-01", 2, 4.5),
        ("2019-02", 2, 3.0),
        ("2020-03", 3, 14 / 3),
    ]


def test_latest_review_per_place(t):
    got = review.latest_review_per_place(t["review"])
    assert rows(got, "business_id", "review_id", "recency_rank") == [
        (None, "r9", 1),
        ("b1", "r3", 1),
        ("b2", "r4", 1),
        ("b3", "r6", 1),
        ("b5", "r5", 1),
        ("b99", "r8", 1),
    ]


def test_most_reviewed_places(t):
    got = review.most_reviewed_places(t["business"], t["review"], at_least=2)
    assert got.columns == ["business_id", "total_reviews", "avg_review_stars", "name", "city", "state", "stars"]
    assert rows(got, "business_id", "total_reviews", "avg_review_stars", "stars") == [("b1", 3, 10 / 3, 4.5), ("b3", 2, 4.5, 5.0)]


def test_five_star_food_reviews(t):
    got = review.five_star_food_reviews(t["business"], t["review"])
    assert got.columns == ["name", "city", "state", "stars", "useful", "funny", "cool", "date"]
    assert rows(got, "name", "useful") == [("Eve's", 7), ("Bob's", 5), ("Cat's", 2)]
    exact = review.five_star_food_reviews(t["business"], t["review"], whole_category=True)
    assert rows(exact, "name") == [("Eve's",), ("Cat's",)]


def test_cumulative_reviews(t):
    got = review.cumulative_reviews(t["review"], n=6)
    assert rows(got, "business_id", "review_id", "cumulative_reviews") == [
        (None, "r9", 1),
        ("b1", "r1", 1),
        ("b1", "r2", 2),
        ("b1", "r3", 3),
        ("b2", "r4", 1),
        ("b3", "r6", 1),
    ]


# ---- engagement


def test_recent_popular_tips(t):
    got = engagement.recent_popular_tips(t["tip"])
    assert got.columns == ["user_id", "business_id", "compliment_count", "date", "text"]
    assert rows(got, "text", "compliment_count") == [("nice", 5), ("ok", 4), ("try it", 3), ("fine", 3)]


def test_most_visited_places(t):
    got = engagement.most_visited_places(t["checkin"], t["business"])
    assert got.columns == ["business_id", "total_checkins", "name", "city", "state", "is_open"]
    assert rows(got, "business_id", "total_checkins") == [("b1", 4), ("b4", 2), ("b2", 0)]


def test_most_tipped_per_city(t):
    got = engagement.most_tipped_per_city(t["tip"], t["business"], k=1)
    assert got.columns == ["city", "state", "name", "tip_count", "rank_in_city"]
    assert rows(got) == [
        ("Philadelphia", "PA", "Ann's", 2, 1),
        ("Philadelphia", "PA", "Bob's", 2, 1),
        ("Reno", "NV", "Dan's", 2, 1),
    ]


def test_places_with_tips_and_photos(t):
    got = engagement.places_with_tips_and_photos(t["tip"], t["photo"], t["business"])
    assert got.columns == ["business_id", "tip_count", "photo_count", "name", "city", "state", "stars"]
    assert rows(got, "business_id", "tip_count", "photo_count") == [("b1", 2, 2), ("b4", 2, 1)]


def test_good_places_with_tips(t):
    got = engagement.good_places_with_tips(t["tip"], t["business"], min_tips=2)
    assert got.columns == ["name", "city", "state", "stars", "review_count", "tip_count"]
    assert rows(got) == [("Ann's", "Philadelphia", "PA", 4.5, 200, 2), ("Dan's", "Reno", "NV", 4.5, 100, 2)]


@pytest.mark.parametrize("hot_rows", [1, 10**6])
def test_tip_gaps(t, hot_rows):
    got = engagement.tip_gaps(t["tip"], hot_rows=hot_rows)
    assert got.columns == ["user_id", "business_id", "date", "prev_tip_date", "days_since_prev_tip"]
    # The undated tip of u3 comes first and is no predecessor.
    assert rows(got, "user_id", "business_id", "days_since_prev_tip") == [
        ("u1", "b1", 10),
        ("u1", "b2", 60),
        ("u2", "b4", 367),
    ]
    assert rows(engagement.tip_gaps(t["tip"], n=1, hot_rows=hot_rows), "business_id") == [("b1",)]


@pytest.mark.parametrize("n", [1, 3, 30, 200])
def test_tip_gaps_from_the_head_equal_those_of_the_whole(spark, n):
    # The first users have one tip each, so that the head alone is not enough for a small n.
    singles = spark.range(50).selectExpr("concat('a', id) as user_id", "'b1' as business_id", "'2020-01-01' as date")
    many = spark.range(400).selectExpr(
        "concat('c', id % 7) as user_id", "concat('b', id) as business_id", "cast(date_add(date'2020-01-01', cast(id % 90 as int)) as string) as date"
    )
    tips = singles.unionByName(many).withColumn("text", F.lit("x"))
    in_turn = Window.partitionBy("user_id").orderBy("date", "business_id")
    whole = tips.withColumn("prev", F.lag("date").over(in_turn)).filter("prev is not null").orderBy("user_id", "date", "business_id").limit(n)
    wanted = rows(whole.selectExpr("user_id", "business_id", "date", "prev", "datediff(date, prev)"))
    assert rows(engagement.tip_gaps(tips, n=n)) == wanted


# ---- running them


def test_every_question_is_in_the_catalogue():
    assert {topic: len(asked) for topic, asked in catalogue.TOPICS.items()} == {
        "business": 6,
        "user": 6,
        "review": 6,
        "engagement": 6,
    }


def test_run_questions_from_json_to_csv(spark, tmp_path):
    for name, df in places.frames(spark).items():
        df.write.json(str(tmp_path / "raw" / name))
    sources = json_sources({name: str(tmp_path / "raw" / name) for name in places.ROWS})
    before = set(spark.sparkContext._jsc.getPersistentRDDs())
    written = catalogue.run_questions(spark, sources, str(tmp_path / "results"))
    assert len(written) == 24
    back = spark.read.csv(str(tmp_path / "results" / "business" / "cities_by_open_places"), header=True)
    assert rows(back) == [("Reno", "3"), ("Philadelphia", "2"), (None, "1"), ("Tampa", "1")]
    assert len(list((tmp_path / "results/business/cities_by_open_places").glob("*.csv"))) == 1
    assert set(spark.sparkContext._jsc.getPersistentRDDs()) == before


def test_questions_without_their_tables_are_left_out(spark, t, tmp_path):
    sources = {"business": Source(str(tmp_path / "b")), "review": Source(str(tmp_path / "nowhere"))}
    t["business"].write.parquet(str(tmp_path / "b"))
    with pytest.warns(UserWarning, match="'review' skipped"):
        written = catalogue.run_questions(spark, sources, str(tmp_path / "out"), cache=False)
    assert len(written) == 4


def test_a_star_written_as_an_integer_or_a_fraction_reads_the_same(spark, tmp_path):
    lines = [{"review_id": "a", "stars": 4}, {"review_id": "b", "stars": 4.0}]
    (tmp_path / "r.json").write_text("\n".join(map(json.dumps, lines)) + "\n{broken\n")
    source = json_sources({"review": str(tmp_path / "r.json")})["review"]
    from plazaframe.sources.tables import open_table

    kept = open_table(spark, source, bad_lines="bad").select("review_id", "stars", "bad").cache()
    assert rows(kept) == [("a", 4.0, None), ("b", 4.0, None), (None, None, "{broken")]
    kept.unpersist()
    assert rows(open_table(spark, source), "review_id") == [("a",), ("b",), (None,)]
