"""Questions about users, and percent ranks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plazaframe.operators import ranking
from plazaframe.plans import user
from plazaframe.plans.registered.registry import query
from plazaframe.plans.sample_tables import Tables, event_tips, line_reviews, order_users, roles


@query(
    "nonempty_threshold_top",
    """SELECT source AS name, quality AS review_count, n_chars AS fans, toxic AS average_stars, quality AS useful
       FROM documents JOIN labels USING (doc_id)
       WHERE lang IS NOT NULL AND lang <> '' AND n_chars >= 100 AND quality >= 1
       ORDER BY n_chars DESC, doc_id LIMIT 20""",
)
def _(t: Tables) -> DataFrame:
    users = roles(
        t.documents.join(t.labels, "doc_id"),
        user_id="doc_id",
        name="source",
        elite="lang",
        fans="n_chars",
        review_count="quality",
        average_stars="toxic",
        useful="quality",
    )
    return user.top_elite_users(users, min_fans=100, min_reviews=1)


@query(
    "cohort_stats_by_year",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS join_year, count(o_orderkey) AS user_count,
              CAST(sum(o_custkey) AS DOUBLE) / count(o_custkey) AS avg_reviews,
              CAST(sum(o_orderkey) AS DOUBLE) / count(o_orderkey) AS avg_fans,
              CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(o_totalprice) AS avg_rating_given,
              CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(o_totalprice) AS avg_useful_votes
       FROM orders GROUP BY year(o_orderdate)""",
)
def _(t: Tables) -> DataFrame:
    return user.stats_by_join_year(order_users(t))


@query(
    "cohort_topk",
    """SELECT name, CAST(join_year AS INTEGER) AS join_year, useful, review_count, fans,
              CAST(rank_in_cohort AS INTEGER) AS rank_in_cohort FROM (
         SELECT o_orderpriority AS name, year(o_orderdate) AS join_year, o_totalprice AS useful, o_custkey AS review_count,
                o_orderkey AS fans, rank() OVER (PARTITION BY year(o_orderdate) ORDER BY o_totalprice DESC) AS rank_in_cohort
         FROM orders) WHERE rank_in_cohort <= 5""",
)
def _(t: Tables) -> DataFrame:
    found = user.most_useful_per_join_year(order_users(t))
    return found.withColumn("useful", F.col("useful").cast("double"))


@query(
    "activity_rollup_join",
    """SELECT user_id, tip_count, total_compliments_on_tips, c_name AS name, c_nationkey AS review_count, c_acctbal AS fans
       FROM (SELECT user_id, count(props) AS tip_count,
                    CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_compliments_on_tips
             FROM events GROUP BY user_id) JOIN customer ON user_id = c_custkey
       ORDER BY tip_count DESC, user_id LIMIT 20""",
)
def _(t: Tables) -> DataFrame:
    users = roles(t.customer, user_id="c_custkey", name="c_name", review_count="c_nationkey", fans="c_acctbal")
    found = user.top_tip_writers(users, event_tips(t))
    return found.withColumn("total_compliments_on_tips", F.col("total_compliments_on_tips").cast("double"))


@query(
    "filtered_fact_join_dim",
    """SELECT p_name AS name, l_suppkey AS business_id, l_quantity AS stars, l_extendedprice AS useful, l_discount AS funny,
              l_tax AS cool, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS date
       FROM lineitem JOIN part ON l_partkey = p_partkey
       WHERE l_quantity >= 20 AND l_extendedprice >= 5000 AND p_type <> ''
       ORDER BY useful DESC, l_orderkey, name, business_id, stars, funny, cool, date LIMIT 20""",
)
def _(t: Tables) -> DataFrame:
    users = roles(t.part, user_id="p_partkey", name="p_name", elite="p_type")
    found = user.useful_reviews_by_elite_users(users, line_reviews(t), min_stars=20, min_useful=5000)
    return found.withColumn("stars", F.col("stars").cast("double"))


@query(
    "percent_rank_global",
    """SELECT o_orderkey, o_totalprice, percent_rank() OVER (ORDER BY o_totalprice DESC) AS percentile_rank FROM orders""",
)
def _(t: Tables) -> DataFrame:
    return ranking.percent_rank_over_all(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", "percentile_rank")


@query(
    "percent_rank_sliced",
    """SELECT o_orderkey, o_custkey, percent_rank() OVER (ORDER BY o_custkey DESC) AS percentile_rank FROM orders""",
)
def _(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_custkey")
    return ranking.percent_rank_over_all(orders, "o_custkey", "percentile_rank", slices=16)


@query(
    "percent_rank_ties",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_quantity, percent_rank() OVER (ORDER BY l_quantity DESC) AS percentile_rank
       FROM lineitem""",
)
def _(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")
    return ranking.percent_rank_over_all(lines, "l_quantity", "percentile_rank")


@query(
    "percent_rank_top",
    """SELECT l_returnflag AS name, l_partkey AS fans, l_suppkey AS review_count,
              l_quantity + l_linenumber AS total_compliments,
              percent_rank() OVER (ORDER BY l_quantity + l_linenumber DESC) AS percentile_rank
       FROM lineitem WHERE l_quantity + l_linenumber > 0
       ORDER BY total_compliments DESC, l_orderkey, name, fans, review_count LIMIT 30""",
)
def _(t: Tables) -> DataFrame:
    users = roles(
        t.lineitem,
        user_id="l_orderkey",
        name="l_returnflag",
        fans="l_partkey",
        review_count="l_suppkey",
        likes="l_quantity",
        notes="l_linenumber",
    )
    return user.compliment_percentiles(users, compliments=["likes", "notes"])
