"""Queries over data made awkward: large keys, empty tables, infinite numbers, blanks, odd dates, samples, components."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plazaframe.functions import dates, text
from plazaframe.functions.measures import rows
from plazaframe.operators import aggregate, distribution, durable, profiling, reducing
from plazaframe.plans.registered.registry import query
from plazaframe.plans.sample_tables import Tables
from plazaframe.sinks.files import bounded_sample, write_tables
from plazaframe.sources.tables import held


@query(
    "mean_of_large_keys",
    """SELECT o_orderpriority, CAST(sum(CAST(o_orderkey AS HUGEINT) * 10000000000000) AS DOUBLE) / count(*) AS mean_key
       FROM orders GROUP BY o_orderpriority""",
)
def _(t: Tables) -> DataFrame:
    """Keys so large that their sum does not fit a long, and in large tables the keys themselves do not."""
    large = t.orders.select("o_orderpriority", (F.col("o_orderkey").cast("decimal(19,0)") * F.lit(Decimal(10_000_000_000_000))).alias("key"))
    return aggregate.group_stats(large, ["o_orderpriority"], means={"mean_key": "key"})


@query(
    "report_empty_table",
    """WITH lost AS (SELECT * FROM documents d WHERE NOT EXISTS (SELECT 1 FROM documents o WHERE o.doc_id = d.doc_id))
       SELECT 'text' AS "column", count(DISTINCT text) AS distinct_count FROM lost
       UNION ALL SELECT 'lang', count(DISTINCT lang) FROM lost UNION ALL SELECT 'source', count(DISTINCT source) FROM lost""",
)
def _(t: Tables) -> DataFrame:
    """The documents that no document matches by its id: none of the whole table, and the report says so."""
    lost = t.documents.join(t.documents.select("doc_id"), "doc_id", "left_anti")
    return profiling.string_distinct(lost)


_FAR = "CASE WHEN o_orderpriority = '1-URGENT' THEN 'Infinity'::DOUBLE WHEN o_orderpriority = '5-LOW' THEN '-Infinity'::DOUBLE ELSE o_totalprice END"


@query(
    "histogram_with_infinity",
    f"""WITH f AS (SELECT price FROM (SELECT {_FAR} AS price FROM orders) WHERE isfinite(price)),
             e AS (SELECT min(price) AS low, max(price) AS high,
                          CAST(least(40, greatest(10, floor(sqrt(count(*))))) AS INTEGER) AS bins FROM f)
        SELECT CAST(least(floor((price - low) / ((high - low) / bins)), bins - 1) AS INTEGER) AS bin, count(*) AS count
        FROM f, e GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    priority = F.col("o_orderpriority")
    far = F.when(priority == "1-URGENT", F.lit(float("inf"))).when(priority == "5-LOW", F.lit(float("-inf"))).otherwise(F.col("o_totalprice"))
    return distribution.distribution(t.orders.select(far.alias("price")), "price").select("bin", "count")


@query(
    "filled_texts",
    """SELECT doc_id, lang FROM (SELECT doc_id, CASE lang WHEN 'de' THEN '' WHEN 'fr' THEN NULL ELSE lang END AS lang FROM documents)
       WHERE lang IS NOT NULL AND lang <> ''""",
)
def _(t: Tables) -> DataFrame:
    gappy = F.when(F.col("lang") == "de", "").when(F.col("lang") != "fr", F.col("lang"))
    return t.documents.select("doc_id", gappy.alias("lang")).filter(text.filled("lang"))


@query(
    "parse_mixed_dates",
    """SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR)
                WHEN 1 THEN strftime(o_orderdate, '%Y-%m-01') WHEN 4 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS date_parsed,
              CASE WHEN o_orderkey % 5 IN (0, 1, 4) THEN year(o_orderdate)::INTEGER END AS date_year,
              CASE WHEN o_orderkey % 5 IN (0, 1, 4) THEN month(o_orderdate)::INTEGER END AS date_month
       FROM orders""",
)
def _(t: Tables) -> DataFrame:
    """Days, months, junk, nothing and full timestamps in one column."""
    kind, day = F.col("o_orderkey") % 5, F.col("o_orderdate")
    mixed = F.when(kind == 0, F.date_format(day, "yyyy-MM-dd")).when(kind == 1, F.date_format(day, "yyyy-MM")).when(kind == 2, "soon")
    mixed = mixed.when(kind == 4, F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
    found = dates.with_date_parts(t.orders.select("o_orderkey", mixed.alias("date")))
    return found.select("o_orderkey", F.col("date_parsed").cast("string").alias("date_parsed"), "date_year", "date_month")


@query("random_sample_checks", "SELECT true AS enough, true AS bounded, true AS all_known, true AS no_repeats, true AS spread_out")
def _(t: Tables) -> DataFrame:
    """What must hold of any random sample: its size, where its rows come from, that none comes twice."""
    few = durable.materialise(bounded_sample(t.orders, 0.3, columns=["o_orderkey", "o_totalprice"]))
    cut = durable.materialise(bounded_sample(t.orders, 0.9, max_rows=400, columns=["o_orderkey"]))
    n, last = t.orders.agg(rows(), F.max("o_orderkey")).first()
    drawn, different = few.agg(rows(), F.count_distinct("o_orderkey")).first()
    unknown = few.join(t.orders, ["o_orderkey", "o_totalprice"], "left_anti").count()
    size, head = cut.agg(rows(), F.max("o_orderkey")).first()
    told = [(0.25 * n < drawn < 0.35 * n, size == 400, unknown == 0, drawn == different, head > 0.9 * last)]
    return t.spark.createDataFrame(told, "enough boolean, bounded boolean, all_known boolean, no_repeats boolean, spread_out boolean")


@query(
    "pca_of_two_columns",
    """WITH m AS (SELECT var_samp(x) AS a, covar_samp(x, y) AS b, var_samp(y) AS c FROM
                    (SELECT p_size::DOUBLE AS x, p_retailprice / 100 AS y FROM part)),
            l AS (SELECT a, b, (a + c) / 2 + sqrt(((a - c) / 2) ** 2 + b ** 2) AS top FROM m)
       SELECT p_partkey, round(abs((p_size * b + p_retailprice / 100 * (top - a)) / sqrt(b ** 2 + (top - a) ** 2)), 3) AS first,
              round(abs((p_size * (a - top) + p_retailprice / 100 * b) / sqrt(b ** 2 + (top - a) ** 2)), 3) AS second
       FROM part, l""",
)
def _(t: Tables) -> DataFrame:
    """The components of two columns, whose directions the covariances give in closed form (up to their signs)."""
    two = t.part.select("p_partkey", F.col("p_size").cast("double").alias("x"), (F.col("p_retailprice") / 100).alias("y"))
    found = reducing.principal_components(two, ["x", "y"], 2)
    return found.select("p_partkey", *(F.round(F.abs(F.col("components")[i]), 3).alias(n) for i, n in enumerate(("first", "second"))))


@query(
    "component_variances",
    """SELECT true AS falling, true AS all_variance, sum(v) > 0 AS some FROM (
         SELECT var_samp(x) AS v FROM (SELECT unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY i)""",
)
def _(t: Tables) -> DataFrame:
    """The variances of all components fall, and together they are those of the columns."""
    width = t.embeddings.agg(F.max(F.size("embedding"))).first()[0]
    turned = reducing.principal_components(t.embeddings, ["embedding"], width)
    found = turned.agg(*(F.var_samp(F.col("components")[i]).alias(f"c{i}") for i in range(width)), *(F.var_samp(F.col("embedding")[i]).alias(f"e{i}") for i in range(width)))
    falling = [F.col(f"c{i}") >= F.col(f"c{i + 1}") - 1e-9 for i in range(width - 1)]
    total = [sum((F.col(f"{k}{i}") for i in range(width)), start=F.lit(0.0)) for k in "ce"]
    return found.select(F.forall(F.array(*falling), lambda x: x).alias("falling"), (F.abs(total[0] - total[1]) < 1e-6 * total[1]).alias("all_variance"), (total[0] > 0).alias("some"))


@query("partitioned_sink", "SELECT l_returnflag, count(*) AS found, round(sum(l_quantity), 2) AS quantity FROM lineitem GROUP BY l_returnflag")
def _(t: Tables) -> DataFrame:
    """A table in one folder for each value, read back."""
    folder = durable.new_folder(t.spark)
    write_tables({"lineitem": t.lineitem}, folder, partition_by=["l_returnflag"])
    back = t.spark.read.parquet(f"{folder}/lineitem")
    return back.groupBy("l_returnflag").agg(rows().alias("found"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


@query("sink_partitions", "SELECT 6::BIGINT AS files, count(*) AS found FROM orders")
def _(t: Tables) -> DataFrame:
    """As many files as asked for."""
    folder = durable.new_folder(t.spark)
    write_tables({"orders": t.orders}, folder, num_partitions=6)
    back = t.spark.read.parquet(f"{folder}/orders").select(F.input_file_name().alias("file"))
    return back.agg(F.count_distinct("file").alias("files"), rows().alias("found"))


@query("held_tables", "SELECT (SELECT count(*) FROM orders) AS orders, (SELECT count(DISTINCT c_mktsegment) FROM customer) AS segments")
def _(t: Tables) -> DataFrame:
    """Two questions to tables that are kept between them, one of them with the columns it needs only."""
    with held({"orders": t.orders, "customer": t.customer}, {"customer": ["c_mktsegment", "nowhere"]}) as kept:
        assert kept["customer"].columns == ["c_mktsegment"]
        told = kept["orders"].count(), kept["customer"].distinct().count()
    return t.spark.createDataFrame([told], "orders bigint, segments bigint")
