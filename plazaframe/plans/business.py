"""Questions about places."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plazaframe.functions.text import lists_token, mentions
from plazaframe.operators.aggregate import group_stats, stats_by_attribute, with_group_mean
from plazaframe.operators.ranking import first_rows, ordered, top_ranked


def open_places(business: DataFrame) -> DataFrame:
    return business.filter(F.col("is_open") == 1)


def cities_by_open_places(business: DataFrame, n: int = 10) -> DataFrame:
    """B1: the cities with the most open places."""
    per_city = group_stats(open_places(business), ["city"], counts={"open_business_count": "business_id"})
    order = [F.desc("open_business_count")]
    return first_rows(per_city, n, order, ties=["city"], columns=["city", "open_business_count"])


def most_reviewed_per_state(business: DataFrame, k: int = 5) -> DataFrame:
    """B2: the k most reviewed open places of each state, with everything tied at the last rank."""
    columns = ["state", "name", "city", "stars", "review_count"]
    ranked = top_ranked(open_places(business).select(*columns), ["state"], "review_count", k, "rank_in_state")
    return ordered(ranked, ["state", "rank_in_state"], ties=["name", "city", "stars"])


def stars_per_state(business: DataFrame, review: DataFrame) -> DataFrame:
    """Mean stars and number of the reviews of each state's places."""
    per_state = stats_by_attribute(
        review, business, "business_id", ["state"], means={"avg_review_stars": "stars"}, counts={"total_reviews": "review_id"}
    )
    return ordered(per_state.select("state", "avg_review_stars", "total_reviews"), [F.desc("total_reviews")], ties=["state"])


def most_reviewed_in_state(
    business: DataFrame, review: DataFrame, state: str = "PA", at_least: int = 100, n: int = 20
) -> DataFrame:
    """The places of one state with enough reviews, most reviewed first."""
    per_place = stats_by_attribute(
        review,
        business.filter(F.col("state") == state),
        "business_id",
        ["business_id", "name", "city"],
        counts={"total_reviews": "review_id"},
        means={"avg_stars": "stars"},
        selective=True,
    ).filter(F.col("total_reviews") >= at_least)
    columns = ["business_id", "name", "city", "total_reviews", "avg_stars"]
    return first_rows(per_place, n, [F.desc("total_reviews")], ties=["business_id"], columns=columns)


def stars_against_city(business: DataFrame, n: int = 30) -> DataFrame:
    """The places furthest above the mean stars of their city."""
    columns = ["business_id", "name", "city", "state", "stars"]
    compared = with_group_mean(business.select(*columns), ["city"], "stars", "city_avg_stars").withColumn(
        "diff_from_city_avg", F.col("stars") - F.col("city_avg_stars")
    )
    shown = [*columns[1:], "city_avg_stars", "diff_from_city_avg"]
    return first_rows(compared, n, [F.desc("diff_from_city_avg")], ties=["business_id"], columns=shown)


def top_open_restaurants(
    business: DataFrame,
    min_stars: float = 4.5,
    min_reviews: int = 100,
    category: str = "Restaurants",
    *,
    whole_category: bool = False,
) -> DataFrame:
    """Well rated, much reviewed open places whose categories mention a word.

    ``whole_category`` asks for a category of exactly that name.
    """
    about = lists_token("categories", category) if whole_category else mentions("categories", category)
    good = open_places(business).filter(
        (F.col("stars") >= min_stars) & (F.col("review_count") >= min_reviews) & about
    )
    columns = ["name", "city", "state", "stars", "review_count"]
    return ordered(good.select(*columns), [F.desc("review_count")], ties=columns[:-1])
