"""From raw documents to packed training sequences: language, repeated lines, near duplicates, personal data, packing.

Each stage takes all documents its predecessor kept, as written to Parquet, and all but the last
return the columns of ``documents``. SQL cannot express compression sizes, rolling hashes, sketches
and tokenizers, so there is no SQL for the result; the tests hold each stage against a plain version.

Null and empty texts have no language and go in the first stage, as do texts without letters. A null lang is filled in with the predicted one; a
null source stays null. Rows with a null id are documents like any other and come after all others where the first of several is kept. Rows repeated under
one id are one class of near duplicates, of which one row stays. Very long texts are worked on whole; packing cuts them into pieces. An
empty table gives an empty result. Columns of the input beyond those of ``documents`` are dropped by the first stage, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plazaframe.llm import language, lines, near, packing, personal
from plazaframe.llm.queries import documents, tokenizer
from plazaframe.operators.durable import materialise

ORACLE_SQL = None
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _documents(df: DataFrame, text: Column, lang: Column | None = None, doc_id: str = "id") -> DataFrame:
    """The columns of ``documents`` again, with a new text and its length."""
    return df.select(
        F.col(doc_id).alias("doc_id"),
        text.alias("text"),
        (F.col("carried.lang") if lang is None else lang).alias("lang"),
        F.col("carried.source").alias("source"),
        F.length(text).cast("long").alias("n_chars"),
    )


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters or with a narrow margin between languages go; a missing lang is filled in."""
    found = language.identify(docs, language.dictionaries(docs), carry=["lang", "source"])
    return _documents(found.where(~F.col("rejected")), F.col("text"), F.coalesce("carried.lang", "lang_pred"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has go, and with them documents of which nothing else is left."""
    found = lines.dedup_lines(docs, carry=["lang", "source"])
    emptied = (F.col("n_removed_lines") > 0) & ~F.col("text").rlike(r"\S")
    return _documents(found.where(~F.coalesce(emptied, F.lit(False))), F.col("text"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class stays, the one with the smallest id; rows repeated under that id stay once for each text."""
    classes = materialise(near.near_duplicates(docs))
    first = F.col("id").eqNullSafe(F.col("class_id"))
    stay = classes.where(first).groupBy("id").agg(F.count("*").alias("n"))
    kept = docs.join(stay, docs["doc_id"].eqNullSafe(stay["id"])).select(*COLUMNS, "n")
    return kept.where("n = 1").select(*COLUMNS).union(kept.where("n > 1").select(*COLUMNS).dropDuplicates(["doc_id", "text"]))


def remove_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that disclose it are replaced by their kinds."""
    found = personal.find_personal(docs, carry=["lang", "source"])
    clean = found.select("doc_id", personal.sanitised(found).alias("text"), "carried")
    return _documents(clean, F.col("text"), doc_id="doc_id")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences of 4096."""
    return packing.pack_documents(docs, tokenizer("word_bpe_49k.json")).withColumnRenamed("id", "doc_id")


STAGES = [
    ("language", keep_known_languages),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("personal_data", remove_personal_data),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
