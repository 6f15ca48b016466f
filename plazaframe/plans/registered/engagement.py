"""Questions about tips, check-ins and photos, and previous values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plazaframe.operators import sequence
from plazaframe.plans import engagement
from plazaframe.plans.registered.registry import query
from plazaframe.plans.sample_tables import Tables, customer_places, day_text, event_tips, roles, supplier_places


@query(
    "recent_threshold_top",
    """SELECT user_id, user_id AS business_id, value AS compliment_count,
              strftime(ts, '%Y-%m-%d %H:%M:%S') AS date, props AS text
       FROM events WHERE value >= 3 AND ts >= TIMESTAMP '2024-01-15'
       ORDER BY value DESC, user_id, date, text LIMIT 20""",
)
def _(t: Tables) -> DataFrame:
    found = engagement.recent_popular_tips(event_tips(t), since="2024-01-15")
    return found.withColumn("compliment_count", F.col("compliment_count").cast("double"))


@query(
    "list_cardinality_sum",
    """SELECT doc_id AS business_id, sum(CASE WHEN trim(d.text) <> ''
                THEN length(d.text) - length(replace(d.text, ',', '')) + 1 ELSE 0 END)::BIGINT AS total_checkins,
              any_value(d.source) AS name, any_value(d.lang) AS city, any_value(CAST(toxic AS VARCHAR)) AS state,
              any_value(quality) AS is_open
       FROM documents d JOIN labels USING (doc_id) GROUP BY doc_id ORDER BY total_checkins DESC, doc_id LIMIT 20""",
)
def _(t: Tables) -> DataFrame:
    """Documents as lists: their commas separate the entries, whole texts are read."""
    places = roles(
        t.documents.drop("text").join(t.labels, "doc_id"),
        business_id="doc_id",
        name="source",
        city="lang",
        state=F.col("toxic").cast("string"),
        is_open="quality",
    )
    return engagement.most_visited_places(roles(t.documents, business_id="doc_id", date="text"), places)


@query(
    "agg_join_topk_group",
    """SELECT city, state, name, tip_count, CAST(rank_in_city AS INTEGER) AS rank_in_city FROM (
         SELECT n_name AS city, r_name AS state, s_name AS name, s_suppkey, tip_count,
                rank() OVER (PARTITION BY n_name ORDER BY tip_count DESC) AS rank_in_city
         FROM (SELECT l_suppkey, count(l_returnflag) AS tip_count FROM lineitem GROUP BY l_suppkey)
              JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
              JOIN region ON n_regionkey = r_regionkey)
       WHERE rank_in_city <= 3 ORDER BY city, rank_in_city, s_suppkey LIMIT 60""",
)
def _(t: Tables) -> DataFrame:
    tips = roles(t.lineitem, business_id="l_suppkey", text="l_returnflag")
    return engagement.most_tipped_per_city(tips, supplier_places(t))


@query(
    "three_way_counts",
    """SELECT c_custkey AS business_id, tip_count, photo_count, c_name AS name, n_name AS city, c_mktsegment AS state,
              c_acctbal AS stars
       FROM (SELECT user_id, count(props) AS tip_count FROM events GROUP BY user_id)
            JOIN (SELECT o_custkey, count(o_orderkey) AS photo_count FROM orders GROUP BY o_custkey) ON user_id = o_custkey
            JOIN customer ON c_custkey = user_id JOIN nation ON c_nationkey = n_nationkey
       ORDER BY tip_count DESC, business_id LIMIT 20""",
)
def _(t: Tables) -> DataFrame:
    photos = roles(t.orders, photo_id="o_orderkey", business_id="o_custkey")
    return engagement.places_with_tips_and_photos(event_tips(t), photos, customer_places(t))


@query(
    "quality_join_having",
    """SELECT c_name AS name, n_name AS city, c_mktsegment AS state, c_acctbal AS stars, c_nationkey AS review_count, tip_count
       FROM (SELECT user_id, count(props) AS tip_count FROM events GROUP BY user_id)
            JOIN customer ON c_custkey = user_id JOIN nation ON c_nationkey = n_nationkey
       WHERE c_mktsegment <> 'BUILDING' AND c_acctbal >= 1000 AND tip_count >= 5
       ORDER BY tip_count DESC, c_custkey LIMIT 20""",
)
def _(t: Tables) -> DataFrame:
    return engagement.good_places_with_tips(event_tips(t), customer_places(t), min_stars=1000, min_tips=5)


@query(
    "gap_days",
    """SELECT user_id, event_id AS business_id, CAST(d AS VARCHAR) AS date, CAST(p AS VARCHAR) AS prev_tip_date,
              CAST(date_diff('day', p, d) AS INTEGER) AS days_since_prev_tip
       FROM (SELECT *, lag(d) OVER (PARTITION BY user_id ORDER BY d, event_id) AS p
             FROM (SELECT user_id, event_id, CAST(ts AS DATE) AS d FROM events))
       WHERE p IS NOT NULL ORDER BY user_id, d, event_id LIMIT 30""",
)
def _(t: Tables) -> DataFrame:
    return engagement.tip_gaps(roles(t.events, user_id="user_id", business_id="event_id", date=day_text("ts")))


@query(
    "previous_value_all",
    """SELECT event_id, user_id, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous FROM events""",
)
def _(t: Tables) -> DataFrame:
    visits = t.events.select("event_id", "user_id", "ts", "value")
    found = sequence.previous_value(visits, ["user_id"], ["ts", "event_id"], "value", "previous")
    return found.select("event_id", "user_id", "previous")


@query(
    "previous_value_hot_key",
    """SELECT event_id, event_type, lag(value) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS previous FROM events""",
)
def _(t: Tables) -> DataFrame:
    visits = t.events.select("event_id", "event_type", "ts", "value")
    found = sequence.previous_value(
        visits, ["event_type"], ["ts", "event_id"], "value", "previous", hot_rows=10, slices=16
    )
    return found.select("event_id", "event_type", "previous")
