"""Questions about reviews."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plazaframe.functions.dates import calendar_month
from plazaframe.functions.measures import row_total
from plazaframe.functions.text import lists_token, mentions
from plazaframe.operators.aggregate import group_stats
from plazaframe.operators.ranking import first_rows, latest_per_key, ordered

VOTES = ["useful", "funny", "cool"]


def highly_voted_reviews(review: DataFrame, more_than: int = 10, min_stars: float = 4, n: int = 20) -> DataFrame:
    """Good reviews with many votes of all kinds, most useful first."""
    voted = review.filter((row_total(VOTES) > more_than) & (F.col("stars") >= min_stars))
    columns = ["review_id", "business_id", "user_id", "stars", *VOTES, "date"]
    return first_rows(voted, n, [F.desc("useful")], ties=["review_id"], columns=columns)


def reviews_by_month(review: DataFrame) -> DataFrame:
    """R2: number and mean stars of reviews per calendar month."""
    dated = review.withColumn("year_month", calendar_month("date"))
    per_month = group_stats(dated, ["year_month"], counts={"review_count": "review_id"}, means={"avg_stars": "stars"})
    return ordered(per_month, ["year_month"])


def latest_review_per_place(review: DataFrame, n: int = 30) -> DataFrame:
    """Each place's newest review; shown are the places silent for longest."""
    columns = ["business_id", "review_id", "user_id", "stars", "date"]
    newest = latest_per_key(review.select(*columns), ["business_id"], "date", ["review_id"])
    ranked = newest.withColumn("recency_rank", F.lit(1))
    return first_rows(ranked, n, ["date"], ties=["business_id"], columns=[*columns, "recency_rank"])


def most_reviewed_places(business: DataFrame, review: DataFrame, at_least: int = 50, n: int = 20) -> DataFrame:
    """The places with the most reviews and what those say on average."""
    per_place = group_stats(
        review, ["business_id"], counts={"total_reviews": "review_id"}, means={"avg_review_stars": "stars"}
    )
    known = per_place.filter(F.col("total_reviews") >= at_least).join(
        business.select("business_id", "name", "city", "state", "stars"), "business_id"
    )
    return first_rows(known, n, [F.desc("total_reviews")], ties=["business_id"], columns=known.columns)


def five_star_food_reviews(
    business: DataFrame,
    review: DataFrame,
    category: str = "Food",
    stars: float = 5,
    n: int = 30,
    *,
    whole_category: bool = False,
) -> DataFrame:
    """The most useful top reviews of places whose categories mention a word."""
    about = lists_token("categories", category) if whole_category else mentions("categories", category)
    places = business.filter(about).select("business_id", "name", "city", "state")
    top = review.filter(F.col("stars") == stars).select("review_id", "business_id", "stars", *VOTES, "date")
    columns = ["name", "city", "state", "stars", *VOTES, "date"]
    return first_rows(top.join(places, "business_id"), n, [F.desc("useful")], ties=["review_id"], columns=columns)


def cumulative_reviews(review: DataFrame, n: int = 30) -> DataFrame:
    """Reviews per place up to each date, for the first ``n`` rows by place and date.

    Everything that comes before one of those rows is among them, so they are cut first and
    counted afterwards.  (``sequence.running_count`` counts a whole table.)
    """
    columns = ["business_id", "review_id", "date", "stars"]
    head = first_rows(review, n, ["business_id", "date"], ties=["review_id"], columns=columns)
    in_turn = Window.partitionBy("business_id").orderBy("date", "review_id", "stars")
    so_far = F.count("review_id").over(in_turn.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return head.withColumn("cumulative_reviews", so_far).orderBy("business_id", "date", "review_id")
