"""Questions about users (U1q-U6q)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plazaframe.functions.dates import calendar_year
from plazaframe.functions.measures import row_total
from plazaframe.functions.text import filled
from plazaframe.operators.aggregate import group_stats
from plazaframe.operators.ranking import first_rows, ordered, percent_rank_head, top_ranked
from plazaframe.schemas import COMPLIMENTS


def elite_users(user: DataFrame) -> DataFrame:
    return user.filter(filled("elite"))


def top_elite_users(user: DataFrame, min_fans: int = 100, min_reviews: int = 500, n: int = 20) -> DataFrame:
    """U1q: elite users with many fans and reviews, most fans first."""
    leading = elite_users(user).filter((F.col("fans") >= min_fans) & (F.col("review_count") >= min_reviews))
    columns = ["name", "review_count", "fans", "average_stars", "useful"]
    return first_rows(leading, n, [F.desc("fans")], ties=["user_id"], columns=columns)


def stats_by_join_year(user: DataFrame) -> DataFrame:
    """U2q: number of users and mean activity per year of joining."""
    dated = user.withColumn("join_year", calendar_year("yelping_since"))
    means = {
        "avg_reviews": "review_count",
        "avg_fans": "fans",
        "avg_rating_given": "average_stars",
        "avg_useful_votes": "useful",
    }
    return ordered(group_stats(dated, ["join_year"], counts={"user_count": "user_id"}, means=means), ["join_year"])


def most_useful_per_join_year(user: DataFrame, k: int = 5) -> DataFrame:
    """U3q: the k users with the most useful votes of each joining year, ties included."""
    dated = user.select("name", calendar_year("yelping_since").alias("join_year"), "useful", "review_count", "fans")
    ranked = top_ranked(dated, ["join_year"], "useful", k, "rank_in_cohort")
    return ordered(ranked, ["join_year", "rank_in_cohort"], ties=["name", "review_count", "fans"])


def top_tip_writers(user: DataFrame, tip: DataFrame, n: int = 20) -> DataFrame:
    """U4q: the users with the most tips, and the compliments those tips got."""
    per_user = group_stats(
        tip, ["user_id"], counts={"tip_count": "text"}, sums={"total_compliments_on_tips": "compliment_count"}
    )
    known = per_user.join(user.select("user_id", "name", "review_count", "fans"), "user_id")
    return first_rows(known, n, [F.desc("tip_count")], ties=["user_id"], columns=known.columns)


def useful_reviews_by_elite_users(
    user: DataFrame, review: DataFrame, min_stars: float = 4, min_useful: int = 5, n: int = 20
) -> DataFrame:
    """U5q: the most useful good reviews by elite users."""
    good = review.filter((F.col("stars") >= min_stars) & (F.col("useful") >= min_useful))
    columns = ["name", "business_id", "stars", "useful", "funny", "cool", "date"]
    wanted = ["review_id", "user_id", *columns[1:]]
    found = good.select(*wanted).join(elite_users(user).select("user_id", "name"), "user_id")
    return first_rows(found, n, [F.desc("useful")], ties=["review_id"], columns=columns)


def compliment_percentiles(user: DataFrame, compliments: Sequence[str] = COMPLIMENTS, n: int = 30) -> DataFrame:
    """U6q: the most complimented users and their percent rank among all complimented ones."""
    totals = user.select("user_id", "name", "fans", "review_count", row_total(compliments).alias("total_compliments"))
    return percent_rank_head(
        totals.filter(F.col("total_compliments") > 0),
        "total_compliments",
        n,
        "percentile_rank",
        ties=["user_id"],
        columns=["name", "fans", "review_count", "total_compliments"],
    )
