"""All review questions from one reading."""

import random

import pytest
from pyspark.sql import functions as F

from plazaframe.plans import catalogue, review, shared


@pytest.fixture(scope="module")
def frames(spark, tmp_path_factory):
    draw = random.Random(12)
    day = lambda: draw.choice([None, "bad", f"20{draw.randint(10, 12)}-0{draw.randint(1, 3)}-1{draw.randint(0, 9)}", "2011-01-01 10:00:00"])
    reviews = [
        (f"r{draw.randint(0, 900)}", f"u{draw.randint(0, 30)}", draw.choice([None, "p1", "p2", "p2", "p2", f"p{draw.randint(3, 60)}"]), draw.choice([None, 1.0, 4.0, 5.0]))
        + tuple(draw.choice([None, 0, 1, 5, draw.randint(0, 40)]) for _ in range(3))
        + (day(),)
        for _ in range(3000)
    ]
    folder = str(tmp_path_factory.mktemp("reviews") / "facts")
    schema = "review_id string, user_id string, business_id string, stars double, useful int, funny int, cool int, date string"
    spark.createDataFrame(reviews + reviews[:5], schema).repartition(6).withColumn("text", F.lit("long")).write.parquet(folder)
    places = [(f"p{i}", f"name {i}", draw.choice("ab"), "NV", 3.5, draw.choice(["Food, Bars", "Bars", None])) for i in range(1, 50)]
    business = spark.createDataFrame(places + [places[0]], "business_id string, name string, city string, state string, stars double, categories string")
    return {"business": business, "review": spark.read.parquet(folder)}


def rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


def test_contents_equal_the_single_questions(frames):
    business, facts = frames["business"], frames["review"]
    wanted = {
        "highly_voted_reviews": review.highly_voted_reviews(facts),
        "reviews_by_month": review.reviews_by_month(facts),
        "latest_review_per_place": review.latest_review_per_place(facts),
        "most_reviewed_places": review.most_reviewed_places(business, facts),
        "five_star_food_reviews": review.five_star_food_reviews(business, facts),
        "cumulative_reviews": review.cumulative_reviews(facts),
    }
    found = catalogue.answers("review", frames, read_once=True)
    assert list(found) == list(wanted)
    for name, answer in wanted.items():
        assert found[name].columns == answer.columns and rows(found[name]) == rows(answer), name
    assert len(rows(found["five_star_food_reviews"])) == 30


def test_the_reviews_are_read_once_and_without_their_text(frames, monkeypatch):
    plans = []
    inner = shared.materialise
    monkeypatch.setattr(shared, "materialise", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or inner(df))
    shared.review_answers(**frames)
    (plan,) = plans
    assert plan.count("FileScan") == 1 and "text:string" not in plan


def test_no_reviews(spark, frames):
    found = shared.review_answers(frames["business"], frames["review"].where("stars > 9"))
    assert all(not answer.collect() for answer in found.values())


def test_falling_texts(spark):
    texts = ["", "a", "ab", "abc", "b", "ß", "日", "2020-01-02", "2020-01-02 10:00:00", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.orderBy(shared.falling(F.col("t"))).collect()] == [r[0] for r in df.orderBy(F.col("t").desc()).collect()]
