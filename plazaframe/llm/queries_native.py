"""Queries of the operators that are DataFrame expressions only."""

from plazaframe.llm import mixing, personal, quality_rules
from plazaframe.llm.queries import documents, query


@query("op5_quality_rules")
def op5(spark, folder):
    return quality_rules.judge(documents(spark, folder))


@query("op9_personal_data")
def op9(spark, folder):
    return personal.digest(personal.find_personal(documents(spark, folder)))


@query("op12_mixing")
def op12(spark, folder):
    return mixing.mix(documents(spark, folder)).withColumnRenamed("id", "doc_id").select("doc_id", "size", "source", "source_size", "target", "taken")
