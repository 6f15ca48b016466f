"""Token ids as flat unsigned integer files with 64-bit document offsets, read back by memory maps.

A range partitioning puts the documents in ascending order. Each task writes ``<name>.bin`` (the ids
of its documents one after another, in the narrowest unsigned type that holds the vocabulary),
``<name>.idx`` (where each document begins in it, and the end, as int64) and ``<name>.ids`` (the
document ids as int64, those that are not null). A task's files have names of their own, so that a repeated attempt
never meets another's; only the files that the written manifest names count. The prefix sums over the
manifest, one row per file, give the base of each file among all ids.

The files go below ``spark.checkpoint.dir``, which must be a folder that all machines mount: only
files can be mapped. Null texts are empty. Documents with a null id come first; rows with the same
id are ordered by their texts' hashes and count one by one. An empty table gives no files and no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plazaframe.llm.word_ids import word_encoder
from plazaframe.operators.durable import materialise, new_folder


def local_folder(spark: SparkSession) -> str:
    """A new folder below the shared one, as a path that can be opened and mapped."""
    at = urlparse(new_folder(spark))
    if at.scheme not in ("", "file"):
        raise ValueError(f"token files are mapped into memory; mount the shared folder instead of using {at.scheme}://")
    return unquote(at.path)


def write_token_files(docs: DataFrame, tokenizer: str, folder: str, *, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1, id_type: str = "<u2") -> DataFrame:
    """Writes the files and returns the manifest: part, name, n_docs, n_null_ids, n_tokens, base."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer, end_id)
        part, most = TaskContext.get().partitionId(), np.iinfo(id_type).max
        name = f"part-{part:06d}-{uuid.uuid4().hex}"
        os.makedirs(folder, exist_ok=True)
        ends, n_null, total = [0], 0, 0
        with open(f"{folder}/{name}.bin", "wb") as flat, open(f"{folder}/{name}.ids", "wb") as keys:
            for batch in batches:
                own = batch.column(0)
                n_null += own.null_count
                keys.write(own.drop_null().to_numpy().astype("<i8").tobytes())
                for ids in encoder.encode_all(batch.column(1).to_pylist()):
                    numbers = np.frombuffer(ids, "<u4")
                    if numbers.max() > most:
                        raise ValueError(f"token id {numbers.max()} does not fit {id_type}")
                    flat.write(numbers.astype(id_type).tobytes())
                    total += len(numbers)
                    ends.append(total)
        if total:
            np.array(ends, "<i8").tofile(f"{folder}/{name}.idx")
            yield pa.record_batch([pa.array([x]) for x in (part, name, len(ends) - 1, n_null, total)], ["part", "name", "n_docs", "n_null_ids", "n_tokens"])
        else:
            os.remove(f"{folder}/{name}.bin")
            os.remove(f"{folder}/{name}.ids")

    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).withColumn("tie", F.xxhash64("text"))
    ordered = slim.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie", "text").select("id", "text")
    written = materialise(ordered.mapInArrow(write, "part long, name string, n_docs long, n_null_ids long, n_tokens long"))
    before = F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    return written.withColumn("base", F.coalesce(before, F.lit(0)))


def read_token_files(manifest: DataFrame, folder: str, *, id_type: str = "<u2") -> DataFrame:
    """One row per document from the files: id, start (among all ids), n_tokens, ids_crc32 (of unsigned 32-bit ids)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.to_pylist():
                at = f"{folder}/{file['name']}"
                flat = np.memmap(f"{at}.bin", id_type, "r")
                ends = np.memmap(f"{at}.idx", "<i8", "r")
                keys = np.fromfile(f"{at}.ids", "<i8").tolist()
                crcs = [zlib.crc32(flat[a:b].astype("<u4").tobytes()) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
                yield pa.record_batch(
                    [pa.array([None] * file["n_null_ids"] + keys, pa.int64()), pa.array(ends[:-1] + file["base"]), pa.array(np.diff(ends)), pa.array(crcs, pa.int64())],
                    ["id", "start", "n_tokens", "ids_crc32"],
                )

    listed = materialise(manifest)
    # with a number of its own the exchange is not merged for being small: every file is read by a task of its own, as far as hashes allow
    dealt = listed.repartition(max(1, listed.count()), "part")
    return dealt.mapInArrow(read, "id long, start long, n_tokens long, ids_crc32 long")
