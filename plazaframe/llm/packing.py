"""Best-two-fit packing of documents into sequences of a fixed number of tokens.

How documents are packed depends on their lengths alone, so the plan is made from a histogram: a
sequence is filled with the longest pieces that fit, then its smallest piece gives way to two
unpacked ones as long as they leave a smaller gap, and the same filling is repeated for as many
sequences as the counts allow. The histogram has at most one entry for each length, and each entry
of the plan uses up a length, so both are bounded by the capacity whatever the size of the corpus.
Spark then gives each piece its number among the pieces of its length, and the plan says where that
number goes. No task gathers the pieces of a length.

Texts that are null count as empty, and an empty text is its end token alone. Repeated rows are
packed as often as they occur. Of an empty table no rows result. Columns besides id and text are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plazaframe.llm.word_ids import word_encoder
from plazaframe.llm.worker import give_back
from plazaframe.operators.durable import materialise

CAPACITY = 4096


@dataclass
class Plan:
    """Where the pieces of each length go: ``copies`` of a length in each of the sequences from ``sequence`` on."""

    length: np.ndarray
    first: np.ndarray  # number of the first piece, among those of this length
    copies: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the pieces with these lengths and numbers."""
        at = np.searchsorted(_key(self.length, self.first), _key(length, number), "right") - 1
        ahead = number - self.first[at]
        return self.sequence[at] + ahead // self.copies[at], self.offset[at] + ahead % self.copies[at] * length


def _key(length: np.ndarray, number: np.ndarray) -> np.ndarray:
    return (length.astype(np.int64) << 48) + number


def best_two_fit(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """The plan for ``counts`` pieces of each length from 1 to ``capacity``."""
    left = np.zeros(capacity + 1, np.int64)
    for length, count in counts.items():
        left[length] = count
    used, lines, sequences = left * 0, [], 0
    while left.any():
        filling = _fill(left, capacity)
        times = min(int(left[length]) // copies for length, copies in filling.items())
        offset = 0
        for length, copies in sorted(filling.items(), reverse=True):
            lines.append((length, int(used[length]), copies, sequences, offset))
            offset += length * copies
            used[length] += copies * times
            left[length] -= copies * times
        sequences += times
    columns = np.array(sorted(lines), np.int64).reshape(-1, 5).T
    return Plan(*columns, sequences)


def _fill(left: np.ndarray, capacity: int) -> dict[int, int]:
    free, filling, gap = left.copy(), {}, capacity
    at_most = _largest(free)
    while gap and (length := int(at_most[gap])):
        copies = min(int(free[length]), gap // length)
        filling[length] = copies
        free[length] -= copies
        gap -= length * copies
        if length <= gap:  # none of it is left
            at_most = _largest(free)
    while gap:
        smallest = min(filling)
        pair = _tightest_pair(free, gap + smallest)
        if pair is None or sum(pair) <= smallest:
            break
        gap += smallest - sum(pair)
        filling[smallest] -= 1
        free[smallest] += 1
        if not filling[smallest]:
            del filling[smallest]
        for length in pair:
            filling[length] = filling.get(length, 0) + 1
            free[length] -= 1
    return filling


def _largest(free: np.ndarray) -> np.ndarray:
    """For each room the largest length that is there and fits, or 0."""
    return np.maximum.accumulate(np.where(free > 0, np.arange(len(free)), 0))


def _tightest_pair(free: np.ndarray, room: int) -> tuple[int, int] | None:
    """Two pieces that together come nearest to ``room`` without exceeding it."""
    room = min(room, 2 * (len(free) - 1))
    one = np.flatnonzero(free[:room])
    if not len(one):
        return None
    at_most = _largest(free)
    other = at_most[np.minimum(room - one, len(free) - 1)]
    alone = (other == one) & (free[one] < 2)
    other[alone] = at_most[one[alone] - 1]
    total = np.where(other > 0, one + other, 0)
    best = int(total.argmax())
    return (int(one[best]), int(other[best])) if total[best] else None


def token_pieces(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """Each document's ids in pieces of at most ``capacity``; a piece is numbered among those of its task and length."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer, end_id)
        part, seen = TaskContext.get().partitionId(), [0] * (capacity + 1)
        for batch in batches:
            rows = []
            for doc, ids in zip(batch.column(0).to_pylist(), encoder.encode_all(batch.column(1).to_pylist()), strict=True):
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at : at + 4 * capacity]
                    length = len(own) // 4
                    rows.append((doc, piece, at // 4, length, zlib.crc32(own), part, seen[length]))
                    seen[length] += 1
            yield pa.record_batch([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], names) if rows else pa.record_batch([pa.array([], t) for t in types], names)
        give_back()

    names = ["id", "piece", "start", "length", "ids_crc32", "part", "number"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(cut, "id long, piece int, start long, length long, ids_crc32 long, part int, number long")


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with sequence_id and offset; a sequence has no gaps and at most ``capacity`` tokens.

    ``pieces`` must have a written table's fixed part and number columns (see ``token_pieces``).
    """
    by_part = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = by_part.select("length", "part", F.coalesce(before, F.lit(0)).alias("base"))
    plan = best_two_fit({r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}, capacity)
    shared = pieces.sparkSession.sparkContext.broadcast(plan)
    columns = [c for c in pieces.columns if c not in ("part", "number")]
    numbered = pieces.join(bases, ["length", "part"]).select(*columns, (F.col("base") + F.col("number")).alias("number"))
    schema = pieces.select(*columns).schema.add("sequence_id", "long").add("offset", "long")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = shared.value.place(batch["length"].to_numpy(), batch["number"].to_numpy())
            kept = [batch[c] for c in columns]
            yield pa.record_batch([*kept, pa.array(sequence), pa.array(offset)], [*columns, "sequence_id", "offset"])

    return numbered.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(materialise(token_pieces(docs, tokenizer, id_col=id_col, text_col=text_col, end_id=end_id, capacity=capacity)), capacity)
