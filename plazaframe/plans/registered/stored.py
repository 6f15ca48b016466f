"""Stored layouts and profiles, comparisons, and bad lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plazaframe.functions.measures import rows
from plazaframe.operators import comparison, durable, sequence, stored_profiles
from plazaframe.plans import preparation
from plazaframe.plans.registered.preparing import order_settings, raw_orders
from plazaframe.plans.registered.registry import query
from plazaframe.plans.sample_tables import Tables, money
from plazaframe.sinks.copartitioned import join_in_place, open_copartitioned, write_copartitioned
from plazaframe.sinks.replacing import open_replaced, replace_partitions, replace_table
from plazaframe.sources.quarantine import bad_share, open_separated
from plazaframe.sources.tables import Source

#: Buckets of the sample tables.
BUCKETS = 8


def customers_by_key(t: Tables) -> dict[str, DataFrame]:
    """Customers, orders and events stored by customer."""
    folder = durable.new_folder(t.spark)
    frames = {"customer": t.customer, "orders": t.orders, "events": t.events.select("event_id", "user_id", "value")}
    keys = {"customer": "c_custkey", "orders": "o_custkey", "events": "user_id"}
    write_copartitioned(frames, folder, keys, BUCKETS, order={"orders": ["o_orderdate", "o_orderkey"]})
    return open_copartitioned(t.spark, folder)


@query(
    "copartitioned_join",
    """SELECT c_custkey, c_name, orders, spent, events FROM customer
       JOIN (SELECT o_custkey, count(*) AS orders, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS spent FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey
       JOIN (SELECT user_id, count(*) AS events FROM events GROUP BY user_id) ON c_custkey = user_id""",
)
def _(t: Tables) -> DataFrame:
    """Three tables stored by customer are grouped and joined without moving a row."""
    stored = customers_by_key(t)
    orders = stored["orders"].groupBy("o_custkey").agg(rows().alias("orders"), F.sum(money("o_totalprice")).alias("spent"))
    events = stored["events"].groupBy("user_id").agg(rows().alias("events"))
    joined = join_in_place(join_in_place(stored["customer"], orders, "c_custkey", "o_custkey"), events, "c_custkey", "user_id")
    return joined.select("c_custkey", "c_name", "orders", "spent", "events")


@query(
    "copartitioned_running_count",
    """SELECT o_custkey, o_orderkey, count(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS so_far FROM orders""",
)
def _(t: Tables) -> DataFrame:
    """Orders so far of each customer, counted inside the buckets."""
    orders = customers_by_key(t)["orders"].select("o_custkey", "o_orderkey", "o_orderdate")
    counted = sequence.running_count(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_orderkey", "so_far")
    return counted.select("o_custkey", "o_orderkey", "so_far")


_PARTS = "l_orderkey, l_quantity, l_extendedprice, l_discount, l_returnflag"


@query(
    "merged_profiles",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS rows, count(*) - count({c}) AS missing, count(DISTINCT {c}) AS distinct_values,
                   TRUE AS distinct_near, min({c})::DOUBLE AS least, max({c})::DOUBLE AS most, round(avg({c}), 3) AS mean,
                   round(stddev_samp({c}), 3) AS stddev, TRUE AS quartiles_near FROM lineitem"""
        for c in ("l_orderkey", "l_quantity", "l_extendedprice", "l_discount")
    )
    + """ UNION ALL SELECT 'l_returnflag', count(*), count(*) - count(l_returnflag), count(DISTINCT l_returnflag), TRUE, NULL, NULL, NULL, NULL, NULL FROM lineitem""",
)
def _(t: Tables) -> DataFrame:
    """Profiles of two halves of the lines, stored and merged; estimates are held against the lines' own counts."""
    folder = durable.new_folder(t.spark)
    names = _PARTS.split(", ")
    for load, part in (("odd", t.lineitem.where("l_orderkey % 2 = 1")), ("even", t.lineitem.where("l_orderkey % 2 = 0"))):
        stored_profiles.profile(part, load, names).write.mode("append").parquet(folder)
    stored = t.spark.read.schema(stored_profiles.PROFILE).parquet(folder)
    told = stored_profiles.report(stored_profiles.merged(stored))
    numbers = [n for n in names if n != "l_returnflag"]
    # how many values lie below and up to each estimated quartile, in one pass
    estimates = {r["column"]: r["quantiles"] for r in told.select("column", "quantiles").collect() if r["quantiles"]}
    ranks = [F.struct(F.count_if(F.col(c) < q), F.count_if(F.col(c) <= q)).alias(f"{c}{i}") for c in numbers for i, q in enumerate(estimates.get(c, []))]
    exact = [F.count_distinct(c).alias(f"d_{c}") for c in names]
    seen = t.lineitem.agg(rows().alias("n"), *exact, *ranks).first()
    slack = 0.015 * seen["n"] + 1

    def near(column: str) -> bool | None:
        if column not in numbers:
            return None
        return all(seen[f"{column}{i}"][0] <= p * seen["n"] + slack and seen[f"{column}{i}"][1] >= p * seen["n"] - slack for i, p in enumerate((0.25, 0.5, 0.75)))

    facts = t.spark.createDataFrame([(c, seen[f"d_{c}"], near(c)) for c in names], "column string, distinct_values long, quartiles_near boolean")
    joined = told.join(facts, "column")
    close = F.abs(F.col("distinct") - F.col("distinct_values")) <= 0.04 * F.col("distinct_values") + 1
    return joined.select(
        "column", "rows", "missing", "distinct_values", close.alias("distinct_near"), "least", "most",
        F.round("mean", 3).alias("mean"), F.round("stddev", 3).alias("stddev"), "quartiles_near",
    )


@query(
    "changes_after_cleaning",
    """WITH middle AS (SELECT quantile_disc(o_totalprice, 0.5) AS m FROM orders WHERE o_orderpriority <> '5-LOW'),
       old AS (SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS status,
                      CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END AS price FROM orders),
       pairs AS (SELECT o_orderkey, status IS NULL AS s, price IS NULL AS p, o_orderkey % 10 = 0 AS gone FROM old),
       changed AS (SELECT * FROM pairs WHERE NOT gone AND (s OR p))
       SELECT 'removed' AS state, NULL AS "column", count(*) AS keys, count(*)::BIGINT AS rows_before, 0::BIGINT AS rows_after FROM pairs WHERE gone
         HAVING count(*) > 0
       UNION ALL SELECT 'added', NULL, count(*), 0, count(*) FROM customer HAVING count(*) > 0
       UNION ALL SELECT 'changed', NULL, count(*), count(*), count(*) FROM changed HAVING count(*) > 0
       UNION ALL SELECT 'changed', 'o_orderstatus', count(*), count(*), count(*) FROM changed WHERE s HAVING count(*) > 0
       UNION ALL SELECT 'changed', 'o_totalprice', count(*), count(*), count(*) FROM changed WHERE p HAVING count(*) > 0""",
)
def _(t: Tables) -> DataFrame:
    """Orders against their cleaned form, from which a tenth has gone and to which one order per customer has come."""
    before = raw_orders(t).distinct()
    cleaned, _ = preparation.clean(before, order_settings())
    new = t.customer.select((-1 - F.col("c_custkey")).alias("o_orderkey"), F.col("c_custkey").alias("o_custkey"))
    after = cleaned.where("o_orderkey % 10 <> 0").unionByName(new, allowMissingColumns=True)
    return comparison.change_report(before, after, ["o_orderkey"])


@query(
    "bad_lines",
    """SELECT event_type AS kind, count(*) FILTER (event_id % 97 <> 0) AS good, count(*) FILTER (event_id % 97 = 0) AS bad,
              count(*) FILTER (event_id % 97 = 0) AS bad_kept, sum(CASE WHEN event_id % 97 <> 0 THEN CAST(value AS DECIMAL(18,2)) ELSE 0 END) AS value,
              round(count(*) FILTER (event_id % 97 = 0) / count(*), 9) AS bad_share
       FROM events GROUP BY event_type""",
)
def _(t: Tables) -> DataFrame:
    """Events as JSON lines, one folder per type, every 97th line broken off; good rows, bad lines and counts per file."""
    folder = durable.new_folder(t.spark)
    line = F.to_json(F.struct("event_id", "event_type", "value"))
    broken = F.when(F.col("event_id") % 97 == 0, F.expr("substring(line, 1, length(line) - 4)")).otherwise(F.col("line"))
    lines = t.events.withColumn("line", line).select(broken.alias("value"), F.col("event_type").alias("kind"))
    lines.write.partitionBy("kind").text(f"{folder}/raw")
    kinds = [r[0] for r in t.events.select("event_type").distinct().collect()]
    declared = "event_id bigint, event_type string, value double"
    sources = {k: Source(f"{folder}/raw/kind={k}", "json", declared) for k in kinds}
    frames, report = open_separated(t.spark, sources, f"{folder}/bad")
    good = frames[kinds[0]]
    for k in kinds[1:]:
        good = good.unionByName(frames[k])
    sums = good.groupBy(F.col("event_type").alias("kind")).agg(rows().alias("good"), F.sum(money("value")).alias("value"))
    bad = t.spark.read.schema("file string, line string").option("basePath", f"{folder}/bad").json(f"{folder}/bad/*")
    kept = bad.groupBy(F.regexp_extract("file", "kind=([^/]+)/", 1).alias("kind")).agg(rows().alias("bad_kept"))
    share = bad_share(report).select(F.col("table").alias("kind"), "bad", F.round("bad_share", 9).alias("bad_share"))
    return sums.join(share, "kind").join(kept, "kind").select("kind", "good", "bad", "bad_kept", "value", "bad_share")


@query(
    "replaced_partitions",
    """SELECT o_orderpriority, count(*) AS orders, sum(CAST(o_totalprice AS DECIMAL(18,2))) * CASE o_orderpriority WHEN '1-URGENT' THEN 2 ELSE 1 END AS spent,
              o_orderpriority <> '1-URGENT' AS untouched FROM orders GROUP BY o_orderpriority""",
)
def _(t: Tables) -> DataFrame:
    """Orders by priority, of which one partition is written anew; a rewrite that fails on the way changes nothing."""
    path = f"{durable.new_folder(t.spark)}/orders"
    stored = t.orders.select("o_orderkey", "o_totalprice", "o_orderpriority")
    replace_partitions(stored, path, ["o_orderpriority"])
    opened = lambda: t.spark.read.schema(stored.schema).parquet(path)
    before = durable.materialise(opened().select(F.input_file_name().alias("file")).distinct())
    failing = stored.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 2 == 0, F.raise_error(F.lit("stopped"))).otherwise(F.col("o_totalprice")))
    try:
        replace_partitions(failing, path, ["o_orderpriority"])
    except Exception as stopped:
        if "stopped" not in str(stopped):
            raise
    urgent = stored.where("o_orderpriority = '1-URGENT'").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    replace_partitions(urgent, path, ["o_orderpriority"])
    files = opened().select("o_orderpriority", "o_totalprice", F.input_file_name().alias("file")).join(before.withColumn("old", F.lit(True)), "file", "left")
    return files.groupBy("o_orderpriority").agg(rows().alias("orders"), F.sum(money("o_totalprice")).alias("spent"), F.bool_and(F.coalesce("old", F.lit(False))).alias("untouched"))


@query(
    "replaced_table",
    """SELECT o_orderstatus, count(*) AS orders, 2 * count(*) AS lines FROM orders GROUP BY o_orderstatus""",
)
def _(t: Tables) -> DataFrame:
    """A table that is replaced by one computed from it, twice over, while a reader of the first version goes on."""
    path = durable.new_folder(t.spark)
    replace_table(t.orders.select("o_orderkey", "o_orderstatus"), path)
    first = open_replaced(t.spark, path)
    replace_table(first.union(first), path)
    lines = open_replaced(t.spark, path).groupBy("o_orderstatus").agg(rows().alias("lines"))
    return first.groupBy("o_orderstatus").agg(rows().alias("orders")).join(lines, "o_orderstatus")
