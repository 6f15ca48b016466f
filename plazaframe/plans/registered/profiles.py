"""Reports and distributions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plazaframe.operators import distribution, profiling
from plazaframe.plans.registered.registry import query
from plazaframe.plans.sample_tables import GAPPY_LINES, Tables, gappy_lines


@query(
    "null_report",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS n_rows, count(*) - count({c}) AS null_count,
                   round((count(*) - count({c})) / count(*), 6) AS null_fraction, 'lineitem' AS "table" FROM {GAPPY_LINES}"""
        for c in ["l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_suppkey"]
    ),
)
def _(t: Tables) -> DataFrame:
    return profiling.null_report(gappy_lines(t), "lineitem")


@query(
    "numeric_stats",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", min({c})::DOUBLE AS min, max({c})::DOUBLE AS max, round(avg({c}), 4) AS mean,
                   round(stddev_samp({c}), 4) AS stddev FROM {GAPPY_LINES}"""
        for c in ["l_orderkey", "l_linenumber", "l_quantity", "l_suppkey"]
    ),
)
def _(t: Tables) -> DataFrame:
    return profiling.numeric_stats(gappy_lines(t))


@query(
    "string_distinct",
    """SELECT 'text' AS "column", count(*) AS distinct_count FROM (SELECT DISTINCT text FROM documents)
       UNION ALL SELECT 'lang', count(*) FROM (SELECT DISTINCT nullif(lang, 'de') FROM documents)
       UNION ALL SELECT 'source', count(*) FROM (SELECT DISTINCT source FROM documents)""",
)
def _(t: Tables) -> DataFrame:
    return profiling.string_distinct(t.documents.withColumn("lang", F.nullif("lang", F.lit("de"))))


@query(
    "string_distinct_sketch",
    """SELECT 'o_orderstatus' AS "column", count(*) AS distinct_count FROM (SELECT DISTINCT nullif(o_orderstatus, 'P') FROM orders)
       UNION ALL SELECT 'o_orderpriority', count(*) FROM (SELECT DISTINCT o_orderpriority FROM orders)""",
)
def _(t: Tables) -> DataFrame:
    """The sketch, on columns with so few values that it cannot be off."""
    gappy = t.orders.withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("P")))
    return profiling.string_distinct(gappy, exact=False)


@query(
    "duplicate_report",
    """SELECT 'lineitem' AS "table", count(*) AS total_rows,
              count(DISTINCT (l_orderkey, l_linenumber)) AS distinct_key_rows,
              count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS duplicate_rows, 'l_orderkey,l_linenumber' AS keys
       FROM lineitem
       UNION ALL SELECT 'orders', count(*), count(DISTINCT o_orderkey), count(*) - count(DISTINCT o_orderkey), 'o_orderkey'
       FROM orders
       UNION ALL SELECT 'region', count(*), count(*), 0, NULL FROM region""",
)
def _(t: Tables) -> DataFrame:
    frames = {"lineitem": t.lineitem, "orders": t.orders, "region": t.region}
    return profiling.duplicate_reports(frames, {"lineitem": ["l_orderkey", "l_linenumber"], "orders": ["o_orderkey"]})


@query(
    "overview",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS "table", count(*) AS rows, {n}::BIGINT AS columns FROM {name}"""
        for name, n in {"lineitem": 11, "orders": 6, "events": 6, "documents": 5, "pages": 3, "conversations": 4}.items()
    ),
)
def _(t: Tables) -> DataFrame:
    return profiling.overview({n: getattr(t, n) for n in ("lineitem", "orders", "events", "documents", "pages", "conversations")})


_SUMMARIES = {
    "count": "count({c})",
    "mean": "round(avg({c}), 6)",
    "stddev": "round(stddev_samp({c}), 6)",
    "min": "min({c})",
    "25%": "quantile_disc({c}, 0.25)",
    "50%": "quantile_disc({c}, 0.5)",
    "75%": "quantile_disc({c}, 0.75)",
    "max": "max({c})",
}


@query(
    "describe",
    " UNION ALL ".join(
        f"SELECT '{name}' AS summary, ({sql.format(c='p_size')})::DOUBLE AS p_size, "
        f"({sql.format(c='length(p_name)')})::DOUBLE AS name_length FROM part"
        for name, sql in _SUMMARIES.items()
    ),
)
def _(t: Tables) -> DataFrame:
    found = profiling.describe_numbers(t.part.select("p_size", F.length("p_name").alias("name_length")))
    return found.select("summary", *(F.round(F.col(c).cast("double"), 6).alias(c) for c in ("p_size", "name_length")))


@query(
    "validation_report",
    """SELECT 'lineitem' AS "table", '' AS "column", 'rows' AS metric, count(*)::DOUBLE AS value FROM lineitem
       UNION ALL SELECT 'lineitem', '', 'columns', 5
       """
    + "".join(
        f"""UNION ALL SELECT 'lineitem', '{c}', 'null_count', count(*) - count({c}) FROM {GAPPY_LINES}
            UNION ALL SELECT 'lineitem', '{c}', 'null_percentage', round((count(*) - count({c})) * 100.0 / count(*), 2) FROM {GAPPY_LINES}
            """
        for c in ["l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_suppkey"]
    )
    + "".join(
        f"UNION ALL SELECT 'lineitem', '{c}', '{k}', ({sql.format(c=c)})::DOUBLE FROM {GAPPY_LINES}\n"
        for c in ["l_orderkey", "l_linenumber", "l_quantity", "l_suppkey"]
        for k, sql in {
            "min": "min({c})",
            "max": "max({c})",
            "mean": "round(avg({c}), 4)",
            "stddev": "round(stddev_samp({c}), 4)",
        }.items()
    )
    + f"""UNION ALL SELECT 'lineitem', 'l_returnflag', 'distinct_count', count(*)
          FROM (SELECT DISTINCT l_returnflag FROM {GAPPY_LINES})""",
)
def _(t: Tables) -> DataFrame:
    report = profiling.validation_report(gappy_lines(t), "lineitem")
    return report.filter(F.col("metric") != "type").select(
        "table", F.coalesce("column", F.lit("")).alias("column"), "metric", F.col("value").cast("double").alias("value")
    )


@query(
    "validation_status",
    """SELECT 'orders' AS "table", true AS ok, count(*) AS rows FROM orders
       UNION ALL SELECT 'pages', true, count(*) FROM pages UNION ALL SELECT 'nowhere', false, 0""",
)
def _(t: Tables) -> DataFrame:
    """Validation goes on after a table whose file is missing."""
    missing = f"{t.folder}/nowhere.parquet"
    openers = {"orders": lambda: t.orders, "nowhere": lambda: t.spark.read.parquet(missing), "pages": lambda: t.pages}
    reports, status = profiling.validate_tables(t.spark, openers)
    found = t.spark.createDataFrame([(name, int(r["rows"])) for name, r in reports.items()], "table string, rows bigint")
    return status.select("table", "ok").join(found, "table", "left").fillna(0, ["rows"])


@query(
    "impact",
    """SELECT 'lineitem' AS "table", raw_rows, proc_rows, proc_rows - raw_rows AS delta_rows, 11::BIGINT AS raw_cols,
              4::BIGINT AS proc_cols, (-7)::BIGINT AS delta_cols, 1::BIGINT AS added_cols, 8::BIGINT AS removed_cols
       FROM (SELECT count(*) AS raw_rows, count(*) FILTER (l_quantity > 10) AS proc_rows FROM lineitem)""",
)
def _(t: Tables) -> DataFrame:
    large = t.lineitem.filter("l_quantity > 10").selectExpr("l_orderkey", "l_linenumber", "l_quantity", "l_tax * 2 AS twice")
    return profiling.impact({"lineitem": t.lineitem}, {"lineitem": large})


@query(
    "quartiles",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", quantile_disc({c}, 0.25)::DOUBLE AS q1, quantile_disc({c}, 0.5)::DOUBLE AS median,
                   quantile_disc({c}, 0.75)::DOUBLE AS q3 FROM orders"""
        for c in ["o_custkey", "o_totalprice"]
    ),
)
def _(t: Tables) -> DataFrame:
    return distribution.quartiles(t.orders, ["o_custkey", "o_totalprice"])


@query(
    "histogram",
    """WITH e AS (SELECT min(o_totalprice) AS low, max(o_totalprice) AS high,
                         CAST(least(40, greatest(10, floor(sqrt(count(*))))) AS INTEGER) AS bins FROM orders),
            b AS (SELECT CAST(least(floor((o_totalprice - low) / ((high - low) / bins)), bins - 1) AS INTEGER) AS bin,
                         low, (high - low) / bins AS width FROM orders, e)
       SELECT bin, low + bin * width AS low, low + (bin + 1) * width AS high, CAST(NULL AS VARCHAR) AS value,
              count(*) AS count FROM b GROUP BY bin, low, width""",
)
def _(t: Tables) -> DataFrame:
    return distribution.distribution(t.orders, "o_totalprice")


@query(
    "value_counts",
    """SELECT CAST(year(o_orderdate) AS VARCHAR) AS value, count(*) AS count FROM orders GROUP BY year(o_orderdate)""",
)
def _(t: Tables) -> DataFrame:
    return distribution.distribution(t.orders.select(F.year("o_orderdate").alias("y")), "y").select("value", "count")
