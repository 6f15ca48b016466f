"""All 24 questions by topic, and running them to CSV (RA, RB)."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from plazaframe.plans import business, engagement, review, user
from plazaframe.plans.shared import review_answers
from plazaframe.schemas import COMPLIMENTS
from plazaframe.sinks.files import write_csv
from plazaframe.sources.quarantine import open_available
from plazaframe.sources.tables import Source, held


@dataclass(frozen=True)
class Question:
    """A question and the tables it takes, in the order of its arguments."""

    ask: Callable[..., DataFrame]
    tables: tuple[str, ...]

    def answer(self, frames: Mapping[str, DataFrame]) -> DataFrame:
        return self.ask(*(frames[t] for t in self.tables))


TOPICS: dict[str, list[Question]] = {
    "business": [
        Question(business.cities_by_open_places, ("business",)),
        Question(business.most_reviewed_per_state, ("business",)),
        Question(business.stars_per_state, ("business", "review")),
        Question(business.most_reviewed_in_state, ("business", "review")),
        Question(business.stars_against_city, ("business",)),
        Question(business.top_open_restaurants, ("business",)),
    ],
    "user": [
        Question(user.top_elite_users, ("user",)),
        Question(user.stats_by_join_year, ("user",)),
        Question(user.most_useful_per_join_year, ("user",)),
        Question(user.top_tip_writers, ("user", "tip")),
        Question(user.useful_reviews_by_elite_users, ("user", "review")),
        Question(user.compliment_percentiles, ("user",)),
    ],
    "review": [
        Question(review.highly_voted_reviews, ("review",)),
        Question(review.reviews_by_month, ("review",)),
        Question(review.latest_review_per_place, ("review",)),
        Question(review.most_reviewed_places, ("business", "review")),
        Question(review.five_star_food_reviews, ("business", "review")),
        Question(review.cumulative_reviews, ("review",)),
    ],
    "engagement": [
        Question(engagement.recent_popular_tips, ("tip",)),
        Question(engagement.most_visited_places, ("checkin", "business")),
        Question(engagement.most_tipped_per_city, ("tip", "business")),
        Question(engagement.places_with_tips_and_photos, ("tip", "photo", "business")),
        Question(engagement.good_places_with_tips, ("tip", "business")),
        Question(engagement.tip_gaps, ("tip",)),
    ],
}

# The columns the questions read; review texts, maps and friend lists stay out of a cache.
ASKED = {
    "business": ["business_id", "name", "city", "state", "stars", "review_count", "is_open", "categories"],
    "review": ["review_id", "user_id", "business_id", "stars", "date", "useful", "funny", "cool"],
    "user": ["user_id", "name", "review_count", "fans", "average_stars", "useful", "yelping_since", "elite", *COMPLIMENTS],
    "tip": ["user_id", "business_id", "date", "compliment_count", "text"],
    "checkin": ["business_id", "date"],
    "photo": ["photo_id", "business_id"],
}


def answers(topic: str, frames: Mapping[str, DataFrame], *, read_once: bool = False) -> dict[str, DataFrame]:
    """Question name -> answer, for the questions of a topic whose tables are there.

    ``read_once`` answers those about reviews from a single reading of the reviews.
    """
    if read_once and topic == "review" and {"business", "review"} <= set(frames):
        return review_answers(frames["business"], frames["review"])
    asked = [q for q in TOPICS[topic] if all(t in frames for t in q.tables)]
    return {q.ask.__name__: q.answer(frames) for q in asked}


def write_answers(topic: str, frames: Mapping[str, DataFrame], folder: str, *, single_file: bool = False, read_once: bool = False) -> list[str]:
    """Answer a topic's questions and write each to ``<folder>/<topic>/<question>``."""
    found = answers(topic, frames, read_once=read_once)
    return [write_csv(df, f"{folder}/{topic}/{name}", single_file=single_file) for name, df in found.items()]


def run_questions(
    spark: SparkSession,
    sources: Mapping[str, Source],
    folder: str,
    *,
    cache: bool | None = None,
    single_file: bool = False,
    bad_folder: str | None = None,
    read_once: bool = False,
) -> list[str]:
    """Answer everything the available tables allow; returns the folders written.

    ``cache`` keeps the columns the questions read; by default those of tables that are not Parquet, since
    Parquet is read column by column anyway. With ``bad_folder`` bad lines of declared tables are set aside there, and
    the answers come from the others.
    """
    frames = open_available(spark, sources, bad_folder)
    dear = {name: df for name, df in frames.items() if (sources[name].format != "parquet" if cache is None else cache)}
    with held(dear, ASKED) as kept:
        ready = {**frames, **kept}
        return [path for topic in TOPICS for path in write_answers(topic, ready, folder, single_file=single_file, read_once=read_once)]
