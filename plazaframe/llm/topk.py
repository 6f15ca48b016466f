"""Exact top-k inner products by an impact-ordered, score-at-a-time index.

Vectors become whole numbers, ``floor(scale * x)``. Each task packs its rows into blocks of bounded
size. In a block every component is a posting of its dimension; postings are dealt into segments by
their quantised impact, the power of four around their absolute value. Queries run through the segments by descending
impact and add them to accumulators. Behind segment s every unprocessed component is below the
segment's impact, so what a vector can still gain or lose is at most the norm of its unprocessed
components times that of the query (Cauchy-Schwarz). A query stops when fewer vectors than a small share
can still reach its k-th lower bound, and these possible members are scored exactly;
the bound is the only reason to stop, so the result is exact. Queries of a block run together, so
that a segment is added for all of them by one matrix product.

Query blocks meet index blocks, not rows rows: each pair of blocks returns k rows per query, and
k of these stay for each query.

Vectors that are null or hold null or non-finite components take no part, nor do rows without id;
vectors of another length than the queries' are not comparable and give no score. A vector's own id
is left out of its answers; rows repeated under one id count once, with their best score. An empty table on either side gives
no rows; other columns are ignored, whatever their names. Components
and scores that a 64-bit integer cannot hold become the nearest one it holds.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plazaframe.operators.durable import materialise

#: Vectors in an index block and in a query block.
BLOCK = 4096
QUERIES = 1024
#: Segments are processed until at most this share of a block can still be a member, or none are left.
FEW = 0.02


def _whole(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    v = F.col(vector_col)
    fine = v.isNotNull() & F.col(id_col).isNotNull() & F.forall(v, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    floors = F.transform(v, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    return vectors.where(fine).select(F.col(id_col).cast("long").alias("id"), floors.alias("q"))


def _blocks(whole: DataFrame, size: int) -> DataFrame:
    """Rows of one task and one vector length in blocks of at most ``size``: block, ids, data."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, held = TaskContext.get().partitionId(), 0, {}

        def block(ids: list[int], rows: list[np.ndarray]) -> pa.RecordBatch:
            out = io.BytesIO()
            np.savez(out, ids=np.array(ids, np.int64), rows=_narrow(np.stack(rows)))
            return pa.record_batch([pa.array([f"{part}-{made}"]), pa.array([out.getvalue()])], ["block", "data"])

        for batch in batches:
            for key, row in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids, rows = held.setdefault(len(row.values), ([], []))
                ids.append(key)
                rows.append(row.values.to_numpy())
                if len(ids) >= size:
                    yield block(*held.pop(len(row.values)))
                    made += 1
        for ids, rows in held.values():
            yield block(ids, rows)
            made += 1

    return whole.mapInArrow(pack, "block string, data binary")


def _narrow(rows: np.ndarray) -> np.ndarray:
    most = max(abs(int(rows.max(initial=0))), abs(int(rows.min(initial=0))))
    return rows.astype(np.int16 if most < 2**15 else np.int64)


def segments(rows: np.ndarray) -> list[np.ndarray]:
    """The index of a block: its postings by descending impact, one matrix per power of four."""
    size = np.abs(rows.astype(np.float64))
    levels = np.where(size > 0, (np.frexp(size)[1] + 1) // 2, 0)
    return [np.where(levels == level, rows, 0) for level in np.unique(levels)[::-1] if level]


def search_block(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> Iterator[tuple[int, int, int]]:
    """(query id, id, score) of each query's k best vectors of a block, and maybe more, ties to the smaller id."""
    unique, first = np.unique(ids, return_index=True)
    if len(unique) < len(ids):  # rows that repeat an id must not crowd out others: each repetition is searched by itself
        rest = np.setdiff1d(np.arange(len(ids)), first)
        for part in (first, rest):
            yield from search_block(queries, query_ids, rows[part], ids[part], k)
        return
    exact = _safe(queries, rows)
    kind = np.float64 if exact else object
    q = queries.astype(np.float64)
    norm = np.sqrt((q * q).sum(1))
    reach = np.zeros((len(q), len(ids)))
    rest = (rows.astype(np.float64) ** 2).sum(1)
    own = query_ids[:, None] == ids[None, :]
    alive, k_at = np.arange(len(q)), min(k, len(ids))
    members: dict[int, np.ndarray] = {}
    for level in segments(rows):
        reach[alive] += q[alive] @ level.T.astype(np.float64)
        rest = np.maximum(rest - (level.astype(np.float64) ** 2).sum(1), 0)
        slack = norm[alive, None] * np.sqrt(rest)[None, :]
        slack = slack * (1 + 1e-9) + 1e-6 * (1 + np.abs(reach[alive])) * (not exact)
        low = np.where(own[alive], -np.inf, reach[alive] - slack)
        bar = np.partition(low, len(ids) - k_at, axis=1)[:, len(ids) - k_at]
        possible = (reach[alive] + slack >= bar[:, None]) & ~own[alive]
        done = possible.sum(1) <= max(4 * k, FEW * len(ids))
        for i in np.flatnonzero(done):
            members[int(alive[i])] = np.flatnonzero(possible[i])
        alive = alive[~done]
        if not len(alive):
            break
    for i in alive.tolist():
        members[i] = np.flatnonzero(~own[i])
        if exact:  # all segments are in: the accumulators are the scores, and only those that tie with the k-th or beat it stay
            at = reach[i, members[i]]
            members[i] = members[i][at >= np.partition(at, max(len(at) - k, 0))[max(len(at) - k, 0)]] if len(at) else members[i]
    for i, at in members.items():
        scores = rows[at].astype(kind) @ queries[i].astype(kind)
        for j in np.lexsort((ids[at], -scores)).tolist() if exact else sorted(range(len(at)), key=lambda j: (-scores[j], ids[at[j]])):
            yield int(query_ids[i]), int(ids[at[j]]), int(scores[j])


def _safe(queries: np.ndarray, rows: np.ndarray) -> bool:
    """Whether all sums are below 2**53, so that doubles are exact."""
    most = [max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) for x in (queries, rows)]
    return most[0] * most[1] * rows.shape[1] < 2**53


def _best(found: Iterator[tuple[int, int, int]], k: int) -> list[tuple[int, int, int]]:
    kept, seen = [], {}
    for query, key, score in found:
        own = seen.setdefault(query, set())
        if len(own) < k and key not in own:
            own.add(key)
            kept.append((query, key, score))
    return kept


def exact_topk(vectors: DataFrame, queries: DataFrame, k: int, *, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """query_id, rank (from 1), id and score of the k best inner products of each query."""
    index = materialise(_blocks(_whole(vectors, id_col, vector_col, scale), BLOCK))
    asked = materialise(_blocks(_whole(queries, id_col, vector_col, scale), QUERIES))
    n = asked.count()
    # only the blocks' names are numbered in one task; the vectors stay where they are
    numbered = materialise(asked.select("block", F.row_number().over(Window.orderBy("block")).alias("ask")))
    asked = asked.join(numbered, "block").select("ask", F.col("data").alias("asked"))
    pairs = index.withColumn("ask", F.explode(F.sequence(F.lit(1), F.lit(max(n, 1))))).repartition("block", "ask").join(asked, "ask")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, ask in zip(batch.column(0), batch.column(1), strict=True):
                own, q = (np.load(io.BytesIO(x.as_py())) for x in (data, ask))
                rows, wanted = own["rows"], q["rows"]
                found = _best(search_block(wanted, q["ids"], rows, own["ids"], k), k) if rows.shape[1] == wanted.shape[1] else []
                yield pa.record_batch([pa.array([max(-(2**63), min(2**63 - 1, x[i])) for x in found], pa.int64()) for i in range(3)], ["query_id", "id", "score"])

    found = pairs.select("data", "asked").mapInArrow(search, "query_id long, id long, score long")
    found = found.groupBy("query_id", "id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")
