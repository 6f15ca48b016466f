"""Queries whose result is made of token ids: packing and token files."""

from plazaframe.llm import packing, pieces, token_files
from plazaframe.llm.queries import documents, query, tokenizer


@query("op4_best_fit_packing")
def op4(spark, folder):
    return packing.pack_documents(documents(spark, folder), tokenizer("word_bpe_49k.json")).withColumnRenamed("id", "doc_id")


@query("op8_token_files")
def op8(spark, folder):
    files = token_files.local_folder(spark)
    manifest = token_files.write_token_files(documents(spark, folder), tokenizer("word_bpe_49k.json"), files)
    return token_files.read_token_files(manifest, files).withColumnRenamed("id", "doc_id")


@query("op3_sentencepiece")
def op3(spark, folder):
    encoded = pieces.encode(documents(spark, folder), tokenizer("piece_bpe_32k.model"))
    return pieces.summary(encoded).withColumnRenamed("id", "doc_id")
