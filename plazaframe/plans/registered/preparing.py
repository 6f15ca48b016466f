"""Cleaning, flattening, screening, scaling, sampling and the stages together."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plazaframe.functions import dates, text
from plazaframe.operators import cleaning, durable, flattening, reducing, scaling
from plazaframe.plans import preparation
from plazaframe.plans.registered.registry import query
from plazaframe.plans.sample_tables import GAPPY_LINES, GAPPY_PARTS, Tables, day_text, gappy_lines, gappy_parts, line_reviews, roles
from plazaframe.sinks.files import bounded_sample, write_tables


@query(
    "impute_median",
    f"""SELECT p_partkey, coalesce(p_size, (SELECT quantile_disc(p_size, 0.5) FROM {GAPPY_PARTS})) AS p_size,
               coalesce(p_type, 'Unknown') AS p_type, p_retailprice FROM {GAPPY_PARTS}""",
)
def _(t: Tables) -> DataFrame:
    return cleaning.impute(gappy_parts(t), ["p_partkey"])


@query(
    "impute_mean",
    f"""SELECT p_partkey, coalesce(p_size, (SELECT CAST(trunc(avg(p_size)) AS INTEGER) FROM {GAPPY_PARTS})) AS p_size,
               coalesce(p_type, 'Unknown') AS p_type, p_retailprice FROM {GAPPY_PARTS}""",
)
def _(t: Tables) -> DataFrame:
    return cleaning.impute(gappy_parts(t), ["p_partkey"], "mean")


@query(
    "drop_null_keys",
    f"SELECT l_orderkey, l_linenumber, l_suppkey FROM {GAPPY_LINES} WHERE l_suppkey IS NOT NULL",
)
def _(t: Tables) -> DataFrame:
    lines = gappy_lines(t).select("l_orderkey", "l_linenumber", "l_suppkey")
    return cleaning.without_null_keys(lines, ["l_orderkey", "l_suppkey"])


@query(
    "dropna_any",
    f"""SELECT * FROM {GAPPY_LINES} WHERE l_quantity IS NOT NULL AND l_returnflag IS NOT NULL AND l_suppkey IS NOT NULL""",
)
def _(t: Tables) -> DataFrame:
    return cleaning.complete_rows(gappy_lines(t))


@query(
    "dedup_by_key",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
              CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate
       FROM lineitem
       QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
         ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) = 1""",
)
def _(t: Tables) -> DataFrame:
    kept = cleaning.deduplicate(t.lineitem, ["l_orderkey", "l_linenumber"])
    return kept.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", day_text("l_shipdate").alias("l_shipdate")
    )


@query(
    "map_flatten",
    """SELECT event_id, json_extract_string(props, '$.k') AS prop_k, json_extract_string(props, '$.absent') AS prop_absent,
              CAST(len(json_keys(props)) AS INTEGER) AS prop_count FROM events""",
)
def _(t: Tables) -> DataFrame:
    mapped = t.events.select("event_id", F.from_json("props", T.MapType(T.StringType(), T.StringType())).alias("m"))
    wide = flattening.map_to_columns(mapped, "m", flattening.key_columns(["k", "absent"], "prop_"))
    return wide.withColumn("prop_count", text.map_size("m")).drop("m")


@query(
    "token_count_flag",
    """SELECT doc_id, friend_count, elite_count, CASE WHEN elite_count > 0 THEN 1 ELSE 0 END AS is_elite FROM (
         SELECT doc_id, CAST(len(list_filter(string_split(replace(text, '.', ','), ','),
                  lambda x: trim(x) <> '' AND lower(trim(x)) NOT IN ('none', 'unknown'))) AS INTEGER) AS friend_count,
                CASE WHEN lang IN ('en', 'unknown') THEN 0 ELSE 2 END AS elite_count
         FROM documents)""",
)
def _(t: Tables) -> DataFrame:
    """Sentences as friends, so that blank entries occur; no year, a placeholder or two as elite years."""
    listed = t.documents.select(
        "doc_id",
        F.replace(F.col("text"), F.lit("."), F.lit(",")).alias("friends"),
        F.when(F.col("lang") == "en", " ,, Unknown").otherwise(F.concat("lang", F.lit(", , x"))).alias("elite"),
    )
    return flattening.flatten_users(listed).drop("friends", "elite")


@query(
    "list_lengths",
    """SELECT doc_id, CAST(CASE WHEN trim(text) <> '' THEN len(string_split(text, ',')) ELSE 0 END AS INTEGER) AS checkin_count
       FROM documents""",
)
def _(t: Tables) -> DataFrame:
    return flattening.flatten_checkins(roles(t.documents, doc_id="doc_id", date="text")).drop("date")


@query(
    "flatten_places",
    """SELECT p_partkey AS business_id, p_type AS "attr_WiFi", CASE WHEN p_size > 10 THEN p_brand END AS "attr_HasTV",
              CAST(NULL AS VARCHAR) AS "attr_Music", CASE WHEN p_size > 5 THEN 2 ELSE 0 END AS open_days_count,
              CASE WHEN p_size > 5 THEN p_brand END AS hours_mon, CASE WHEN p_size > 5 THEN p_type END AS hours_sun,
              CAST(len(string_split(p_name, ' ')) AS INTEGER) AS category_count
       FROM part""",
)
def _(t: Tables) -> DataFrame:
    """Attributes and hours built from the columns of a part, its name's words as categories."""
    with_tv = F.create_map(F.lit("WiFi"), "p_type", F.lit("HasTV"), "p_brand")
    places = roles(
        t.part,
        business_id="p_partkey",
        attributes=F.when(F.col("p_size") > 10, with_tv).otherwise(F.create_map(F.lit("WiFi"), "p_type")),
        hours=F.when(F.col("p_size") > 5, F.create_map(F.lit("Monday"), "p_brand", F.lit("Sunday"), "p_type")),
        categories=F.replace(F.col("p_name"), F.lit(" "), F.lit(", ")),
    )
    wanted = ["attr_WiFi", "attr_HasTV", "attr_Music", "open_days_count", "hours_mon", "hours_sun", "category_count"]
    return flattening.flatten_places(places).select("business_id", *wanted)


@query(
    "screen_constants",
    """SELECT c AS "column" FROM (
         SELECT 'fixed' AS c UNION ALL SELECT 'empty' UNION ALL
         SELECT 'p_size' FROM part HAVING count(DISTINCT p_size) <= 1 UNION ALL
         SELECT 'p_brand' FROM part HAVING count(DISTINCT p_brand) <= 1 UNION ALL
         SELECT 'promo' FROM part HAVING count(DISTINCT CASE WHEN p_type = 'PROMO' THEN 'yes' END) <= 1)""",
)
def _(t: Tables) -> DataFrame:
    parts = t.part.select(
        "p_partkey",
        "p_size",
        "p_brand",
        F.lit("x").alias("fixed"),
        F.lit(None).cast("double").alias("empty"),
        F.when(F.col("p_type") == "PROMO", "yes").alias("promo"),
    )
    dull = scaling.constant_columns(parts)
    return t.spark.createDataFrame([(c,) for c in dull], "column string")


@query(
    "minmax_scale",
    """SELECT p_partkey, p_type, round((p_size - lo) / (hi - lo)::DOUBLE, 8) AS p_size,
              round((p_retailprice - plo) / (phi - plo), 8) AS p_retailprice, 0.0::DOUBLE AS same
       FROM part, (SELECT min(p_size) AS lo, max(p_size) AS hi, min(p_retailprice) AS plo, max(p_retailprice) AS phi FROM part)""",
)
def _(t: Tables) -> DataFrame:
    parts = t.part.select("p_partkey", "p_type", "p_size", "p_retailprice", F.lit(5).alias("same"))
    scaled = scaling.scale(parts, "minmax", exclude=["p_partkey"])
    return scaled.withColumns({c: F.round(c, 8) for c in ("p_size", "p_retailprice")})


@query(
    "standard_scale",
    """SELECT o_orderkey, round((o_totalprice - m) / s, 6) AS o_totalprice, round((o_custkey - cm) / cs, 6) AS o_custkey
       FROM orders, (SELECT avg(o_totalprice) AS m, stddev_samp(o_totalprice) AS s, avg(o_custkey) AS cm,
                            stddev_samp(o_custkey) AS cs FROM orders)""",
)
def _(t: Tables) -> DataFrame:
    scaled = scaling.scale(t.orders.select("o_orderkey", "o_totalprice", "o_custkey"), "standard", exclude=["o_orderkey"])
    return scaled.withColumns({c: F.round(c, 6) for c in ("o_totalprice", "o_custkey")})


@query(
    "parse_dates",
    """SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date_parsed, year(o_orderdate)::INTEGER AS date_year,
              month(o_orderdate)::INTEGER AS date_month, (dayofweek(o_orderdate) + 1)::INTEGER AS date_day_of_week FROM orders""",
)
def _(t: Tables) -> DataFrame:
    texts = t.orders.select("o_orderkey", F.col("o_orderdate").cast("string").alias("date"))
    return dates.with_date_parts(texts).drop("date").withColumn("date_parsed", F.col("date_parsed").cast("string"))


@query(
    "bucketize",
    """SELECT o_orderkey, CASE WHEN o_totalprice < 1000 OR o_totalprice > 400000 THEN -1
                               WHEN o_totalprice < 100000 THEN 0 WHEN o_totalprice < 250000 THEN 1 ELSE 2 END AS o_totalprice_bin
       FROM orders""",
)
def _(t: Tables) -> DataFrame:
    binned = scaling.with_bins(t.orders.select("o_orderkey", "o_totalprice"), {"o_totalprice": [1000, 100000, 250000, 400000]})
    return binned.drop("o_totalprice").fillna(-1)


def order_settings() -> preparation.Settings:
    return preparation.Settings(
        keys=["o_orderkey"],
        dates=["o_orderdate"],
        drop=["o_orderdate"],
        prune=["o_orderpriority"],
        scale_exclude=["o_orderkey"],
    )


def raw_orders(t: Tables) -> DataFrame:
    """Orders listed twice over, without some prices and customers, and with a column that never varies."""
    orders = t.orders.withColumns(
        {
            "o_totalprice": F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice")),
            "o_orderstatus": F.nullif("o_orderstatus", F.lit("P")),
            "fixed": F.lit("x"),
        }
    )
    return orders.unionByName(orders)


@query(
    "prepare_orders",
    """WITH filled AS (
         SELECT o_orderkey, o_custkey, coalesce(nullif(o_orderstatus, 'P'), 'Unknown') AS o_orderstatus,
                CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice
                     ELSE (SELECT quantile_disc(o_totalprice, 0.5) FROM orders WHERE o_orderpriority <> '5-LOW') END AS price,
                CAST(o_orderdate AS DATE) AS d FROM orders),
       ends AS (SELECT min(price) AS pl, max(price) AS ph, min(o_custkey) AS cl, max(o_custkey) AS ch FROM filled)
       SELECT o_orderkey, round((o_custkey - cl) / (ch - cl)::DOUBLE, 8) AS o_custkey, o_orderstatus,
              round((price - pl) / (ph - pl), 8) AS o_totalprice, CAST(d AS VARCHAR) AS o_orderdate_parsed,
              year(d)::INTEGER AS o_orderdate_year, month(d)::INTEGER AS o_orderdate_month,
              (dayofweek(d) + 1)::INTEGER AS o_orderdate_day_of_week
       FROM filled, ends""",
)
def _(t: Tables) -> DataFrame:
    done = preparation.prepare(raw_orders(t), "orders", order_settings()).frame
    return done.withColumns(
        {
            "o_custkey": F.round("o_custkey", 8),
            "o_totalprice": F.round("o_totalprice", 8),
            "o_orderdate_parsed": F.col("o_orderdate_parsed").cast("string"),
        }
    )


@query(
    "prepare_reviews",
    """WITH kept AS (
         SELECT *, CAST(l_shipdate AS DATE) AS d FROM lineitem
         QUALIFY row_number() OVER (PARTITION BY l_orderkey
           ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, CAST(l_shipdate AS DATE)) = 1),
       m AS (SELECT avg(l_quantity) AS qm, stddev_samp(l_quantity) AS qs, avg(l_extendedprice) AS pm,
                    stddev_samp(l_extendedprice) AS ps FROM kept)
       SELECT l_orderkey AS review_id, l_partkey AS user_id, l_suppkey AS business_id, round((l_quantity - qm) / qs, 6) AS stars,
              round((l_extendedprice - pm) / ps, 6) AS useful, CAST(d AS VARCHAR) AS date_parsed, year(d)::INTEGER AS date_year,
              month(d)::INTEGER AS date_month, (dayofweek(d) + 1)::INTEGER AS date_day_of_week
       FROM kept, m""",
)
def _(t: Tables) -> DataFrame:
    """Order lines as reviews with many duplicate ids, standardised, through the stages one by one."""
    frames = {"review": line_reviews(t).withColumn("stars", F.col("stars").cast("double"))}
    settings = {"review": replace(preparation.default_settings()["review"], scaling="standard", prune=["funny", "cool"])}
    *_, (_, frames) = preparation.staged(frames, settings)
    done = frames["review"].withColumn("date_parsed", F.col("date_parsed").cast("string"))
    return done.withColumns({c: F.round(c, 6) for c in ("stars", "useful")})


@query(
    "stage_audit",
    """SELECT 'orders' AS "table", stage, position, CASE WHEN position = 0 THEN 2 * n ELSE n END AS rows, columns, added, dropped
       FROM (SELECT count(*) AS n FROM orders), (VALUES
         ('load', 0, 7, '', ''), ('clean', 1, 7, '', ''), ('flatten', 2, 7, '', ''), ('prune', 3, 6, '', 'o_orderpriority'),
         ('screen', 4, 5, '', 'fixed'),
         ('transform', 5, 8, 'o_orderdate_parsed,o_orderdate_year,o_orderdate_month,o_orderdate_day_of_week', 'o_orderdate'),
         ('reduce', 6, 8, '', '')) AS s(stage, position, columns, added, dropped)""",
)
def _(t: Tables) -> DataFrame:
    """The audit after a round trip through the Parquet sink, whose own count closes it."""
    prepared = {"orders": preparation.prepare(raw_orders(t), "orders", order_settings())}
    folder = durable.new_folder(t.spark)
    written = write_tables({n: p.frame for n, p in prepared.items()}, folder)
    preparation.write_audit(t.spark, preparation.with_final_counts(prepared, written), f"{folder}/audit")
    audit = preparation.read_audit(t.spark, f"{folder}/audit")
    return audit.withColumns({c: F.array_join(c, ",") for c in ("added", "dropped")})


@query(
    "hash_sample",
    """SELECT o_orderkey, o_totalprice FROM orders
       WHERE ('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8))::BIGINT < CAST(floor(0.3 * 4294967296) AS BIGINT)""",
)
def _(t: Tables) -> DataFrame:
    return reducing.sample_by_key(t.orders.select("o_orderkey", "o_totalprice"), "o_orderkey", 0.3)


@query("random_sample")
def _(t: Tables) -> DataFrame:
    return bounded_sample(t.orders, 0.3, columns=["o_orderkey", "o_totalprice"])


@query("pca")
def _(t: Tables) -> DataFrame:
    found = reducing.principal_components(t.embeddings, ["embedding"], 3)
    return found.select("vec_id", *(F.round(F.col("components")[i], 6).alias(f"c{i}") for i in range(3)))


@query(
    "pca_norms",
    """SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))), 4) AS norm
       FROM embeddings""",
)
def _(t: Tables) -> DataFrame:
    """All components together only turn the vectors, so the lengths stay."""
    width = t.embeddings.agg(F.max(F.size("embedding"))).first()[0]
    turned = reducing.principal_components(t.embeddings, ["embedding"], width)
    squares = F.aggregate("components", F.lit(0.0), lambda total, x: total + x * x)
    return turned.select("vec_id", F.round(squares, 4).alias("norm"))
