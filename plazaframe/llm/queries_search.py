"""Queries over vectors: embeddings, and texts as vectors of impacts."""

from pyspark.sql import functions as F

from plazaframe.llm import lexical, topk
from plazaframe.llm.queries import documents, query


@query(
    "op7_exact_topk",
    """
    WITH fine AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))::BIGINT) AS q FROM embeddings
        WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scored AS (
        SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
            CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS BIGINT) AS score
        FROM fine a JOIN fine b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
    )
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
)
def op7(spark, folder):
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    found = topk.exact_topk(vectors, vectors.where(F.col("vec_id") % 50 == 0), 5)
    return found.withColumnRenamed("id", "vec_id")


@query(
    "op13_ranked_search",
    r"""
    WITH words AS (
        SELECT doc_id, row_number() OVER () AS row, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM documents
    ), tfs AS (
        SELECT row, any_value(doc_id) AS doc_id, term, count(*) AS tf FROM words GROUP BY row, term
    ), docs AS (
        SELECT row, sum(tf)::BIGINT AS n FROM tfs GROUP BY row
    ), corpus AS (
        SELECT count(*) AS n_docs, sum(n)::BIGINT AS l FROM docs
    ), weights AS (
        SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tfs, corpus GROUP BY term, n_docs
    ), impacts AS (
        SELECT doc_id, row, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // l))) AS part
        FROM tfs JOIN docs USING (row) JOIN weights USING (term), corpus
    ), items AS (
        SELECT DISTINCT item_id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM benchmark
    ), scores AS (
        SELECT item_id, doc_id, sum(part)::BIGINT AS score FROM items JOIN impacts USING (term) GROUP BY item_id, row, doc_id
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0
    )
    SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
    """,
)
def op13(spark, folder):
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    return lexical.search(documents(spark, folder), items).withColumnsRenamed({"item": "item_id", "id": "doc_id"})
