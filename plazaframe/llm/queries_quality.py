"""The query of the quality classifier."""

from pyspark.sql import functions as F

from plazaframe.llm import line_crf
from plazaframe.llm.queries import documents, query


@query("op2_quality_classifier")
def op2(spark, folder):
    docs = documents(spark, folder)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    labels = spark.read.parquet(f"{folder}/labels.parquet").where(~held_out)
    weights, move = line_crf.learn(docs, labels)
    scored = line_crf.score(docs, weights, move).withColumnRenamed("id", "doc_id")
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_bad_lines")
