"""Removal of multi-line passages that stand in the corpus more than once.

A text's lines are hashed, and a rolling hash over the last ``WINDOW`` line hashes decides after
which lines a chunk ends. The places depend on the lines around them only, so a passage is cut in
the same way wherever it stands, however many lines come before it. Chunks of two lines or more
whose 128-bit hash stands in several documents are candidates; their bytes are compared with those
of the first document (the smallest id) that has the chunk, and where they are equal the chunk
stays only there. A chunk repeated within one text stays at its first place. Chunks of one line stay.

Chunks miss most passages of a few lines. With ``whole`` the passages are instead all pairs of neighbouring lines with content,
with the blank lines between them. Every passage of two such lines or more is a row of pairs, so it is found wherever it stands and
goes from its first to its last line; only lines that are repeated without a neighbour stay.

Null texts count as empty, and nothing is taken from them. Rows with one id count as one place: what an earlier id has
is removed from all of them, what they share with each other stays. Null ids come after all others. Equal
chunks never depend on the order of rows. An empty table gives no rows. Other columns may be carried
along in a struct, so that their names never clash.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plazaframe.llm.worker import give_back
from plazaframe.operators.durable import materialise

#: Lines that the rolling hash sees, and one line in how many ends a chunk.
WINDOW = 2
ONE_IN = 3
_BASE, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def chunks(text: str) -> list[list[str]]:
    """The lines of a text, cut where the rolling hash says so."""
    lines = text.split("\n")
    if len(lines) < 2:
        return [lines]
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(line.encode()) for line in lines), np.uint64, len(lines))
    rolling = hashes.copy()
    with np.errstate(over="ignore"):
        power = np.uint64(1)
        for back in range(1, WINDOW):
            power = power * _BASE
            rolling[back:] += hashes[:-back] * power
        rolling = (rolling ^ (rolling >> np.uint64(31))) * _MIX
    ends = np.flatnonzero((rolling >> np.uint64(33)) % np.uint64(ONE_IN) == 0) + 1
    cuts = [0, *ends.tolist(), len(lines)]
    return [lines[a:b] for a, b in zip(cuts, cuts[1:], strict=False) if a < b]


def _pairs(lines: list[str]) -> Iterator[tuple[int, int, str]]:
    """First and last line and text of each two neighbouring lines with content."""
    filled = [i for i, line in enumerate(lines) if line.strip()]
    for a, b in zip(filled, filled[1:], strict=False):
        yield a, b, "\n".join(lines[a : b + 1])


def _passages(text: str, whole: bool) -> Iterator[tuple[bytes, str]]:
    """Hash and text of each different chunk of several lines, or pair of lines."""
    seen = set()
    found = (p for _, _, p in _pairs(text.split("\n"))) if whole else ("\n".join(lines) for lines in chunks(text) if len(lines) > 1)
    for passage in found:
        digest = xxhash.xxh3_128_digest(passage.encode())
        if digest not in seen:
            seen.add(digest)
            yield digest, passage


def _without_pairs(text: str, gone: set[bytes]) -> tuple[str, int, int]:
    """The text without the pairs of lines in ``gone`` and those it repeats itself; its lines, and how many went."""
    lines = text.split("\n")
    drop: set[int] = set()
    first: dict[bytes, int] = {}
    for a, b, passage in _pairs(lines):
        digest = xxhash.xxh3_128_digest(passage.encode())
        # a pair that overlaps its first place, as in a run of equal lines, is a repeat only behind it
        if digest in gone or first.setdefault(digest, b) < a:
            drop.update(range(a, b + 1))
    return "\n".join(line for i, line in enumerate(lines) if i not in drop), len(lines), len(drop)


def _without(text: str, gone: set[bytes]) -> tuple[str, int, int]:
    """The text without the chunks in ``gone`` and without chunks it repeats itself; its lines, and how many went."""
    seen, kept, n, removed = set(gone), [], 0, 0
    for lines in chunks(text):
        n += len(lines)
        if len(lines) > 1:
            digest = xxhash.xxh3_128_digest("\n".join(lines).encode())
            if digest in seen:
                removed += len(lines)
                continue
            seen.add(digest)
        kept += lines
    return "\n".join(kept), n, removed


def same_bytes(several: DataFrame) -> DataFrame:
    """id and digest of the passages whose bytes are those of the first one with their digest."""
    firsts = several.where("id = first").select("digest", F.col("passage").alias("first_passage")).dropDuplicates(["digest"])
    return several.where("id <> first").join(firsts, "digest").where(F.col("passage") == F.col("first_passage")).select("id", "digest")


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = (), whole: bool = False) -> DataFrame:
    """id, text without repeated passages (``whole``: all of two lines or more, not chunks only), n_lines, n_removed_lines, and the ``carried`` columns in a struct."""
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.struct(F.lit(0).alias("none"), *carry).alias("carried"))

    def passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, digests, texts = [], [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for digest, passage in _passages(text.as_py() or "", whole):
                    ids.append(key)
                    digests.append(digest)
                    texts.append(passage)
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(digests, pa.binary()), pa.array(texts, pa.string())], ["id", "digest", "passage"])
        give_back()

    last = F.coalesce("id", F.lit(2**63 - 1)).alias("id")  # ids that are null come last
    found = slim.select("id", "text").mapInArrow(passages, "id long, digest binary, passage string").select(last, "digest", "passage")
    repeated = found.select("id", "digest").groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    several = materialise(found.join(repeated, "digest").select("digest", "id", "first", "passage"))
    gone = same_bytes(several).groupBy(F.col("id").alias("of")).agg(F.collect_set("digest").alias("gone"))

    without = _without_pairs if whole else _without

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [without(text.as_py() or "", set(gone.as_py() or ())) for text, gone in zip(batch["text"], batch["gone"], strict=True)]
            texts = pa.array([None if old is None else new for old, (new, _, _) in zip(batch["text"].to_pylist(), rows, strict=True)], pa.string())
            counts = [pa.array([row[i] for row in rows], pa.int32()) for i in (1, 2)]
            yield pa.record_batch([batch["id"], texts, *counts, batch["carried"]], ["id", "text", "n_lines", "n_removed_lines", "carried"])
        give_back()

    schema = slim.select("id", "text").schema.add("n_lines", "integer").add("n_removed_lines", "integer").add("carried", slim.schema["carried"].dataType)
    return slim.join(gone, F.coalesce("id", F.lit(2**63 - 1)) == F.col("of"), "left").select("id", "text", "gone", "carried").mapInArrow(remove, schema)
