"""Queries of the operators that read texts: line dedup, language, near duplicates, phrases."""

from pyspark.sql import functions as F

from plazaframe.llm import language, lines, near, phrases
from plazaframe.llm.queries import documents, query


@query("op1_line_dedup")
def op1(spark, folder):
    return lines.dedup_lines(documents(spark, folder), whole=True).select(F.col("id").alias("doc_id"), "text", "n_lines", "n_removed_lines")


@query("op6_language_id")
def op6(spark, folder):
    docs = documents(spark, folder)
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    learned = language.dictionaries(docs.where(~F.coalesce(held_out, F.lit(False))))
    found = language.identify(docs, learned)
    return found.withColumnRenamed("id", "doc_id").select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


@query("op10_order_minhash")
def op10(spark, folder):
    return near.near_duplicates(documents(spark, folder)).withColumnRenamed("id", "doc_id")


@query(
    "op11_phrases",
    r"""
    WITH pieces AS (
        SELECT doc_id, coalesce(lang, 'und') AS lang,
            unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents
    ), listed AS (
        SELECT row_number() OVER () AS piece_id, lang, regexp_extract_all(piece, '[^ \t]+') AS w FROM pieces
    ), grams AS (
        SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, w[i:i + k - 1] AS p
        FROM (SELECT lang, w, i, unnest([1, 2, 3, 4]) AS k FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM listed))
        WHERE i + k - 1 <= len(w)
    ), counts AS (
        SELECT lang, k, phrase, any_value(p) AS p, count(*)::HUGEINT AS a FROM grams GROUP BY ALL
    ), totals AS (
        SELECT lang, sum(a) AS n FROM counts WHERE k = 1 GROUP BY lang
    ), candidates AS (
        SELECT * FROM counts WHERE k >= 2 AND a >= 30
    ), cuts AS (
        SELECT c.lang, c.phrase, c.a, cut, l.a AS l, r.a AS r, (2000000 * c.a) // (l.a + r.a) AS score
        FROM (SELECT *, array_to_string(p[1:cut], ' ') AS head, array_to_string(p[cut + 1:k], ' ') AS tail
            FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates)) c
        JOIN counts l ON l.lang = c.lang AND l.phrase = c.head
        JOIN counts r ON r.lang = c.lang AND r.phrase = c.tail
    ), best AS (
        SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
    ), inside AS (
        SELECT DISTINCT s.lang, s.phrase
        FROM (SELECT lang, a, array_to_string(p[i:i + size - 1], ' ') AS part
            FROM (SELECT *, unnest([2, 3]) AS size FROM (SELECT lang, a, k, p, unnest(range(1, k)) AS i FROM candidates))
            WHERE size < k AND i + size - 1 <= k) c
        JOIN candidates s ON s.lang = c.lang AND s.phrase = c.part WHERE 100 * c.a >= 80 * s.a
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best ANTI JOIN inside USING (lang, phrase)
    )
    SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
    FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
    """,
)
def op11(spark, folder):
    return phrases.collocations(documents(spark, folder))
