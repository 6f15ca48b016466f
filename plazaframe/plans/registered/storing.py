"""Sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plazaframe.functions.measures import rows
from plazaframe.operators import durable, profiling
from plazaframe.plans import catalogue, preparation, shared
from plazaframe.plans.registered.registry import query
from plazaframe.plans.sample_tables import Tables, event_tips, line_reviews, supplier_places
from plazaframe.schemas import COMPLIMENTS, SCHEMAS
from plazaframe.sinks.files import write_csv, write_tables
from plazaframe.sources.tables import Source, counted, json_sources, observed, open_table, open_tables, parquet_sources


@query(
    "load_counts",
    """SELECT 'customer' AS "table", count(*) AS rows FROM customer UNION ALL SELECT 'orders', count(*) FROM orders
       UNION ALL SELECT 'pages', count(*) FROM pages""",
)
def _(t: Tables) -> DataFrame:
    """Tables that are there are opened (one is not), and counted while something else reads them."""
    frames = open_tables(t.spark, parquet_sources(t.folder, ["customer", "orders", "pages", "absent"], ".parquet"))
    watched = {name: observed(df) for name, df in frames.items()}
    for df, _ in watched.values():
        df.write.format("noop").mode("overwrite").save()
    return t.spark.createDataFrame([(n, counted(seen)) for n, (_, seen) in watched.items()], "table string, rows bigint")


@query("json_scan", "SELECT event_id, user_id, event_type, value, props FROM events")
def _(t: Tables) -> DataFrame:
    """Events through JSON lines and a declared schema."""
    folder = durable.new_folder(t.spark)
    t.events.select("event_id", "user_id", "event_type", "value", "props").write.json(folder)
    declared = "event_id bigint, user_id bigint, event_type string, value double, props string"
    return open_table(t.spark, Source(folder, "json", declared))


@query(
    "csv_sink",
    """SELECT c_mktsegment, count(*) AS customers FROM customer GROUP BY c_mktsegment""",
)
def _(t: Tables) -> DataFrame:
    counted = t.customer.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("customers")).orderBy("c_mktsegment")
    path = write_csv(counted, durable.new_folder(t.spark), single_file=True)
    return t.spark.read.csv(path, header=True, schema="c_mktsegment string, customers bigint")


@query(
    "parquet_sink",
    """SELECT 'customer' AS "table", count(*) AS written, count(*) AS found FROM customer
       UNION ALL SELECT 'orders', count(*), count(*) FROM orders""",
)
def _(t: Tables) -> DataFrame:
    folder = durable.new_folder(t.spark)
    written = write_tables({"customer": t.customer, "orders": t.orders}, folder)
    found = open_tables(t.spark, parquet_sources(folder, ["customer", "orders"]))
    counted = profiling.overview(found)
    told = t.spark.createDataFrame(list(written.items()), "table string, written bigint")
    return told.join(counted.select("table", F.col("rows").alias("found")), "table")


@query(
    "answers_to_csv",
    """SELECT 'highly_voted_reviews' AS question, least(20, count(*) FILTER (l_extendedprice + l_discount + l_tax > 10
              AND l_quantity >= 4)) AS lines FROM lineitem
       UNION ALL SELECT 'reviews_by_month', count(DISTINCT strftime(l_shipdate, '%Y-%m')) FROM lineitem
       UNION ALL SELECT 'latest_review_per_place', least(30, count(DISTINCT l_suppkey)) FROM lineitem
       UNION ALL SELECT 'most_reviewed_places', least(20, count(*)) FROM
         (SELECT l_suppkey FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY l_suppkey HAVING count(*) >= 50)
       UNION ALL SELECT 'five_star_food_reviews', least(30, count(*)) FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
         JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
         WHERE l_quantity = 5 AND contains(r_name, 'A')
       UNION ALL SELECT 'cumulative_reviews', least(30, count(*)) FROM lineitem""",
)
def _(t: Tables) -> DataFrame:
    """All questions about reviews, written and read back; the region stands for the categories with 'Food' for 'A'."""
    places = supplier_places(t)
    categories = F.replace(F.col("state"), F.lit("A"), F.lit("Food"))
    frames = {"business": places.withColumn("categories", categories), "review": line_reviews(t)}
    folder = durable.new_folder(t.spark)
    paths = catalogue.write_answers("review", frames, folder)
    lines = [t.spark.read.csv(p, header=True).agg(rows().alias("lines")) for p in paths]
    named = [df.select(F.lit(p.rsplit("/", 1)[1]).alias("question"), "lines") for df, p in zip(lines, paths)]
    return profiling.stacked(named)


_REVIEWS = "SELECT l_orderkey AS review_id, l_partkey AS user_id, l_suppkey AS business_id, l_quantity AS stars, l_extendedprice AS useful, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS date FROM lineitem"


_REVIEW_ANSWERS = f"""WITH review AS ({_REVIEWS}), place AS (
         SELECT s_suppkey AS business_id, s_name AS name, n_name AS city, r_name AS state FROM supplier
         JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
       latest AS (SELECT * FROM review QUALIFY row_number() OVER (
         PARTITION BY business_id ORDER BY date DESC, review_id, user_id, stars) = 1)
       (SELECT 'highly_voted_reviews' AS question, l_orderkey::VARCHAR AS first, l_suppkey::VARCHAR AS second, l_extendedprice AS number FROM lineitem
         WHERE l_extendedprice + l_discount + l_tax > 10 AND l_quantity >= 4
         ORDER BY l_extendedprice DESC, l_orderkey, l_suppkey, l_partkey, l_quantity, l_discount, l_tax, l_shipdate LIMIT 20)
       UNION ALL SELECT 'reviews_by_month', substr(date, 1, 7), count(*)::VARCHAR,
         round(CAST(sum(CAST(stars AS DECIMAL(18,2))) AS DOUBLE) / count(*), 9) FROM review GROUP BY substr(date, 1, 7)
       UNION ALL (SELECT 'latest_review_per_place', business_id::VARCHAR, review_id::VARCHAR, stars FROM latest ORDER BY date, business_id LIMIT 30)
       UNION ALL (SELECT 'most_reviewed_places', business_id::VARCHAR, any_value(name), round(CAST(sum(CAST(stars AS DECIMAL(18,2))) AS DOUBLE) / count(*), 9)
         FROM review JOIN place USING (business_id) GROUP BY business_id HAVING count(*) >= 50 ORDER BY count(*) DESC, business_id LIMIT 20)
       UNION ALL (SELECT 'five_star_food_reviews', name, city, useful FROM review JOIN place USING (business_id)
         WHERE stars = 5 AND contains(state, 'A') ORDER BY useful DESC, review_id, name, city LIMIT 30)
       UNION ALL (SELECT 'cumulative_reviews', business_id::VARCHAR, review_id::VARCHAR,
         row_number() OVER (PARTITION BY business_id ORDER BY date, review_id, stars)::DOUBLE
         FROM review ORDER BY business_id, date, review_id, stars LIMIT 30)"""


SHOWN = {
    "highly_voted_reviews": ("review_id", "business_id", "useful"),
    "reviews_by_month": ("year_month", "review_count", "round(avg_stars, 9)"),
    "latest_review_per_place": ("business_id", "review_id", "stars"),
    "most_reviewed_places": ("business_id", "name", "round(avg_review_stars, 9)"),
    "five_star_food_reviews": ("name", "city", "useful"),
    "cumulative_reviews": ("business_id", "review_id", "cumulative_reviews"),
}


def food_frames(t: Tables) -> dict[str, DataFrame]:
    """Suppliers and lines; the region stands for the categories with 'Food' for 'A'."""
    categories = F.replace(F.col("state"), F.lit("A"), F.lit("Food"))
    return {"business": supplier_places(t).withColumn("categories", categories), "review": line_reviews(t)}


def in_short(question: str, answer: DataFrame) -> DataFrame:
    """Two names and a number of each row of an answer."""
    first, second, number = SHOWN[question]
    return answer.selectExpr(f"'{question}' AS question", f"string({first}) AS first", f"string({second}) AS second", f"double({number}) AS number")


@query("review_answers_written", _REVIEW_ANSWERS)
def _(t: Tables) -> DataFrame:
    """The six answers about reviews as they stand in the CSV files, each reduced to two names and a number."""
    frames = food_frames(t)
    folder = durable.new_folder(t.spark)
    answers = catalogue.answers("review", frames)
    told = []
    for path in catalogue.write_answers("review", frames, folder):
        question = path.rsplit("/", 1)[1]
        told.append(in_short(question, t.spark.read.schema(answers[question].schema).csv(path, header=True)))
    return profiling.stacked(told)


@query("shared_review_answers", _REVIEW_ANSWERS)
def _(t: Tables) -> DataFrame:
    """The same six answers from one reading of the lines."""
    return profiling.stacked(in_short(name, df) for name, df in shared.review_answers(**food_frames(t)).items())


@query(
    "prepare_all",
    """SELECT 'customer' AS "table", c_custkey AS key, round((c_acctbal - min(c_acctbal) OVER ()) / (max(c_acctbal) OVER () - min(c_acctbal) OVER ()), 8) AS scaled,
              2::BIGINT AS columns FROM customer
       UNION ALL SELECT 'supplier', s_suppkey, round((s_acctbal - avg(s_acctbal) OVER ()) / stddev_samp(s_acctbal) OVER (), 6), 2 FROM supplier""",
)
def _(t: Tables) -> DataFrame:
    """Customers and suppliers from their files through all stages, each with its settings; a third table is not there."""
    settings = {
        "customer": preparation.Settings(keys=["c_custkey"], scale_exclude=["c_custkey"], drop=["c_name", "c_mktsegment", "c_nationkey"]),
        "supplier": preparation.Settings(keys=["s_suppkey"], scale_exclude=["s_suppkey"], scaling="standard", drop=["s_name", "s_nationkey"]),
    }
    prepared = preparation.prepare_all(t.spark, parquet_sources(t.folder, ["customer", "supplier", "absent"], ".parquet"), settings)
    digits = {"customer": 8, "supplier": 6}
    shown = []
    for name, done in prepared.items():
        key, balance = (f"{name[0]}_{c}" for c in ("custkey" if name == "customer" else "suppkey", "acctbal"))
        columns = F.lit(len(done.frame.columns)).cast("long").alias("columns")
        shown.append(done.frame.select(F.lit(name).alias("table"), F.col(key).alias("key"), F.round(balance, digits[name]).alias("scaled"), columns))
    return profiling.stacked(shown)


def six_tables(t: Tables) -> dict[str, DataFrame]:
    """The six declared tables out of suppliers, lines, customers and events."""
    whole = {c: F.col(c).cast("int") for c in ("useful", "funny", "cool")}
    places = supplier_places(t).withColumns(
        {"review_count": F.length("name") * 20, "is_open": F.lit(1), "categories": F.concat(F.lit("Restaurants, Food, "), "city"), "stars": F.lit(4.5)}
    )
    numbers = {c: (F.col("c_custkey") % 7).cast("int") for c in COMPLIMENTS}
    users = t.customer.select(
        F.col("c_custkey").cast("string").alias("user_id"),
        F.col("c_name").alias("name"),
        F.lit("2012-05-06 07:08:09").alias("yelping_since"),
        (F.col("c_custkey") * 5).cast("int").alias("review_count"),
        F.col("c_custkey").cast("int").alias("fans"),
        F.lit(3.5).alias("average_stars"),
        F.col("c_acctbal").cast("int").alias("useful"),
        F.when(F.col("c_nationkey") > 5, "2012, 2013").otherwise("").alias("elite"),
        *(n.alias(c) for c, n in numbers.items()),
    )
    tips = event_tips(t).withColumns({"compliment_count": F.col("compliment_count").cast("int"), "business_id": F.col("business_id") % 10 + 1})
    visits = t.supplier.select(F.col("s_suppkey").alias("business_id"), F.lit("2020-01-01 10:00:00, 2020-01-02 11:00:00").alias("date"))
    photos = t.events.select(F.col("event_id").alias("photo_id"), (F.col("user_id") % 10 + 1).alias("business_id"))
    return {"business": places, "review": line_reviews(t).withColumns({**whole, "stars": F.col("stars").cast("double")}), "user": users, "tip": tips, "checkin": visits, "photo": photos}


def same_rows(answer: DataFrame, back: DataFrame) -> bool:
    """Whether two frames hold the same rows, each as often, as CSV has them; either is evaluated once."""
    signed = [
        df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in answer.columns), F.lit(sign).alias("_more"))
        for df, sign in ((answer, 1), (back, -1))
    ]
    return signed[0].union(signed[1]).groupBy(*answer.columns).agg(F.sum("_more").alias("_more")).where("_more <> 0").isEmpty()


@query(
    "run_everything",
    "SELECT topic, 6::BIGINT AS answered, 6::BIGINT AS equal FROM (SELECT unnest(['business', 'user', 'review', 'engagement']) AS topic)",
)
def _(t: Tables) -> DataFrame:
    """All 24 questions from JSON to CSV; what was written must hold the rows of the answers, which other queries check."""
    raw, out = durable.new_folder(t.spark), durable.new_folder(t.spark)
    for name, df in six_tables(t).items():
        df.write.json(f"{raw}/{name}")
    sources = json_sources({name: f"{raw}/{name}" for name in SCHEMAS})
    written = catalogue.run_questions(t.spark, sources, out)
    # the lines are parsed once more, not for every answer
    frames = {name: durable.materialise(df.select(*catalogue.ASKED[name])) for name, df in open_tables(t.spark, sources).items()}
    told = []
    for topic in catalogue.TOPICS:
        equal = 0
        for name, answer in catalogue.answers(topic, frames).items():
            equal += same_rows(answer, t.spark.read.csv(f"{out}/{topic}/{name}", header=True))
        told.append((topic, sum(f"/{topic}/" in path for path in written), equal))
    return t.spark.createDataFrame(told, "topic string, answered bigint, equal bigint")
