"""Questions about tips, check-ins and photos."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plazaframe.functions.dates import days_between
from plazaframe.functions.text import entry_count
from plazaframe.operators.aggregate import group_stats
from plazaframe.operators.durable import materialise
from plazaframe.operators.ranking import first_rows, top_ranked
from plazaframe.operators.sequence import previous_value
from plazaframe.operators.skew import HOT_ROWS
from plazaframe.plans.business import open_places


def tips_per_place(tip: DataFrame) -> DataFrame:
    return group_stats(tip, ["business_id"], counts={"tip_count": "text"})


def recent_popular_tips(tip: DataFrame, min_compliments: int = 3, since: str = "2020-01-01", n: int = 20) -> DataFrame:
    """Complimented tips since a day, most compliments first."""
    popular = tip.filter((F.col("compliment_count") >= min_compliments) & (F.col("date") >= F.lit(since)))
    columns = ["user_id", "business_id", "compliment_count", "date", "text"]
    ties = ["user_id", "business_id", "date"]
    return first_rows(popular, n, [F.desc("compliment_count")], ties=ties, columns=columns)


def most_visited_places(checkin: DataFrame, business: DataFrame, n: int = 20) -> DataFrame:
    """The places with the most check-ins, which are listed as comma-separated times."""
    listed = checkin.select("business_id", entry_count("date").alias("visits"))
    per_place = group_stats(listed, ["business_id"], sums={"total_checkins": "visits"})
    known = per_place.join(business.select("business_id", "name", "city", "state", "is_open"), "business_id")
    return first_rows(known, n, [F.desc("total_checkins")], ties=["business_id"], columns=known.columns)


def most_tipped_per_city(tip: DataFrame, business: DataFrame, k: int = 3, n: int = 60) -> DataFrame:
    """The k places of each city with the most tips, ties included; the first ``n`` by city."""
    known = tips_per_place(tip).join(business.select("business_id", "name", "city", "state"), "business_id")
    # One row per place, read twice by the ranking.
    ranked = top_ranked(materialise(known), ["city"], "tip_count", k, "rank_in_city")
    columns = ["city", "state", "name", "tip_count", "rank_in_city"]
    return first_rows(ranked, n, ["city", "rank_in_city"], ties=["business_id"], columns=columns)


def places_with_tips_and_photos(tip: DataFrame, photo: DataFrame, business: DataFrame, n: int = 20) -> DataFrame:
    """Places that have both tips and photos, with the number of each."""
    photos = group_stats(photo, ["business_id"], counts={"photo_count": "photo_id"})
    details = business.select("business_id", "name", "city", "state", "stars")
    known = tips_per_place(tip).join(photos, "business_id").join(details, "business_id")
    return first_rows(known, n, [F.desc("tip_count")], ties=["business_id"], columns=known.columns)


def good_places_with_tips(
    tip: DataFrame, business: DataFrame, min_stars: float = 4.0, min_tips: int = 10, n: int = 20
) -> DataFrame:
    """E5: open, well rated places with enough tips."""
    good = open_places(business).filter(F.col("stars") >= min_stars)
    tipped = tips_per_place(tip).filter(F.col("tip_count") >= min_tips)
    columns = ["name", "city", "state", "stars", "review_count", "tip_count"]
    known = good.select("business_id", *columns[:-1]).join(tipped, "business_id")
    return first_rows(known, n, [F.desc("tip_count")], ties=["business_id"], columns=columns)


def tip_gaps(tip: DataFrame, n: int = 30, *, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Days between each tip and the same user's tip before; the first ``n`` by user and date."""
    own = previous_value(tip.select("user_id", "business_id", "date"), ["user_id"], ["date"], "date", "prev_tip_date", hot_rows=hot_rows)
    found = own.filter(F.col("prev_tip_date").isNotNull()).withColumn("days_since_prev_tip", days_between("prev_tip_date", "date"))
    return first_rows(found, n, ["user_id", "date"], ties=["business_id", "prev_tip_date"], columns=found.columns)
