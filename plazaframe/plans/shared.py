"""All questions about reviews from one reading of the reviews (RA, RB, R1-R6).

One pass reduces the reviews to a small table. Grouped questions give one row per month and per place, as a GROUPING SETS query would. Of a
question for the first n rows each task marks its own first n, in the order of the question; whatever is among the first n of the whole
table is among those of its task. The marked rows travel through the same grouping, each as a group of its own, and so does the newest review of each
place. The questions are then asked of the rows that are left, by the same functions as ever.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plazaframe.functions.dates import calendar_month
from plazaframe.functions.measures import mean_from, row_total, safe_sum
from plazaframe.functions.text import mentions
from plazaframe.operators.durable import materialise
from plazaframe.operators.ranking import first_rows, ordered
from plazaframe.plans import review as questions
from plazaframe.plans.review import VOTES

COLUMNS = ["review_id", "user_id", "business_id", "stars", *VOTES, "date"]


def falling(text: Column) -> Column:
    """A text whose order is the reverse of that of ``text``, null last."""
    turned = F.translate(F.hex(text.cast("string")), "0123456789ABCDEF", "FEDCBA9876543210")
    return F.coalesce(F.concat(turned, F.lit("G")), F.lit("H"))


def mark_first(df: DataFrame, flag: str, n: int, of_use: Column, order: Sequence[Column | str]) -> DataFrame:
    """Add ``flag``: whether a row is of use and among the first ``n`` such rows of its task, in ``order``."""
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # the rows before it in its task
    wanted = F.coalesce(of_use, F.lit(False))
    placed = df.withColumn("_of_use", wanted).sortWithinPartitions(F.desc("_of_use"), *order).withColumn("_place", place)
    return placed.withColumn(flag, F.col("_of_use") & (F.col("_place") < n)).drop("_of_use", "_place")


def reduced_reviews(business: DataFrame, review: DataFrame, *, n_voted: int, n_food: int, n_cumulative: int, voted: Column, food: Column, about: Column) -> DataFrame:
    """What the questions need of the reviews: kind (month, place or row), the groups' counts and sums, the newest review and the marked rows."""
    places = business.filter(about).select("business_id").distinct().withColumn("about", F.lit(True))
    facts = review.select(*COLUMNS).join(places, "business_id", "left")
    facts = mark_first(facts, "is_voted", n_voted, voted, [F.desc("useful"), "review_id", "business_id", "user_id", "stars", *VOTES, "date"])
    facts = mark_first(facts, "is_food", n_food, food & F.col("about"), [F.desc("useful"), "review_id"])
    facts = mark_first(facts, "is_early", n_cumulative, F.lit(True), ["business_id", "date", "review_id", "stars"])
    marked = F.col("is_voted") | F.col("is_food") | F.col("is_early")
    row = F.struct(*COLUMNS)
    nothing = F.lit(None).cast(review.schema["business_id"].dataType)
    no_row = F.lit(None).cast("long")
    kinds = F.array(
        F.struct(F.lit("month").alias("kind"), calendar_month("date").alias("month"), nothing.alias("place"), no_row.alias("tag")),
        F.struct(F.lit("place").alias("kind"), F.lit(None).cast("string").alias("month"), F.col("business_id").alias("place"), no_row.alias("tag")),
        F.when(marked, F.struct(F.lit("row").alias("kind"), F.lit(None).cast("string").alias("month"), nothing.alias("place"), F.monotonically_increasing_id().alias("tag"))),
    )
    newest = F.struct(falling(F.col("date")).alias("age"), "review_id", "user_id", "stars", "date")
    grouped = facts.withColumn("g", F.explode(F.array_compact(kinds))).withColumns({c: F.col(f"g.{c}") for c in ("kind", "month", "place", "tag")})
    out = grouped.groupBy("kind", "month", "place", "tag").agg(
        F.count("review_id").alias("n"),
        safe_sum(review, "stars").alias("total"),
        F.count("stars").alias("known"),
        F.min(F.when(F.col("kind") == "place", newest)).alias("newest"),
        F.min(F.when(F.col("kind") == "row", row)).alias("row"),
        *(F.bool_or(f).alias(f) for f in ("is_voted", "is_food", "is_early")),
    )
    return materialise(out)


def review_answers(
    business: DataFrame,
    review: DataFrame,
    *,
    more_than: int = 10,
    min_stars: float = 4,
    category: str = "Food",
    top_stars: float = 5,
    at_least: int = 50,
) -> dict[str, DataFrame]:
    """The six answers about reviews under the names of their functions; the reviews are read once.

    The contents are those of the single functions with the same parameters. Three sorts inside each task and one grouping
    take the place of six readings, which pays where reading is dear: JSON, wide rows, far storage.
    """
    parts = reduced_reviews(
        business,
        review,
        n_voted=20,
        n_food=30,
        n_cumulative=30,
        voted=(row_total(VOTES) > more_than) & (F.col("stars") >= min_stars),
        food=F.col("stars") == top_stars,
        about=mentions("categories", category),
    )
    rows_of = lambda flag: parts.where(F.col("kind") == "row").where(flag).select("row.*")
    mean = mean_from(F.col("total"), F.col("known"))
    months = parts.where("kind = 'month'").select(F.col("month").alias("year_month"), F.col("n").alias("review_count"), mean.alias("avg_stars"))
    places = parts.where("kind = 'place'")
    newest = places.select(F.col("place").alias("business_id"), "newest.review_id", "newest.user_id", "newest.stars", "newest.date")
    counted = places.select(F.col("place").alias("business_id"), F.col("n").alias("total_reviews"), mean.alias("avg_review_stars"))
    known = counted.filter(F.col("total_reviews") >= at_least).join(business.select("business_id", "name", "city", "state", "stars"), "business_id")
    return {
        "highly_voted_reviews": questions.highly_voted_reviews(rows_of("is_voted"), more_than, min_stars),
        "reviews_by_month": ordered(months, ["year_month"]),
        "latest_review_per_place": questions.latest_review_per_place(newest),
        "most_reviewed_places": first_rows(known, 20, [F.desc("total_reviews")], ties=["business_id"], columns=known.columns),
        "five_star_food_reviews": questions.five_star_food_reviews(business, rows_of("is_food"), category, top_stars),
        "cumulative_reviews": questions.cumulative_reviews(rows_of("is_early")),
    }
