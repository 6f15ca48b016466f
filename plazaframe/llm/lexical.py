"""Ranked lexical search over impact vectors in buckets of like norm (after LEMP).

A document is the vector of its terms' impacts, a query the vector of its terms' weights; both are whole numbers, and the
score is their inner product. Only terms that some query has matter, so only these are kept. Vectors are written in order of falling
length (norm), and read as buckets of neighbours in that order. For a query and a bucket:

* Cauchy-Schwarz prunes the bucket: no score in it exceeds the query's norm times the bucket's largest norm;
* coordinate bounds filter inside. A vector close enough in direction to beat the query's bar has each of the query's
  strongest coordinates within an interval around the query's own; and what the other coordinates can add is at most the norms of the
  rests, and at most the sum of the weights times the bucket's largest impacts;
* the survivors are scored exactly in 64-bit integers.

The bar is the k-th score that the query is known to reach. The longest vectors are searched first, for their bars; then all others start
from these. Bounds only ever rule out vectors that cannot reach the bar, so the answer is exact. Bounds are computed in doubles with
a margin of a billionth.

Queries meet vectors in blocks: at most about ``QUERY_TERMS`` terms of queries are held at a time, by the driver and by each task, and the corpus is
read once per block. Counts of the corpus (documents, terms, and documents per term of the block) are sums over all rows.

A term is a maximal run of ASCII letters and digits and of characters beyond ASCII, with A-Z in lower case. Null and empty texts have none: such
documents are not counted, and such queries have no answers. Repeated rows, documents or queries, count each for itself; equal scores are ordered by id,
null ids last. Texts are processed whole, however long. An empty table on either side gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plazaframe.operators.durable import materialise

#: Terms of queries that are held at a time; a query with more is a block of its own.
QUERY_TERMS = 200_000
#: Vectors in a bucket, at most, and how much shorter than its first one a bucket's last may be once it has ``SMALL`` vectors.
BUCKET, SMALL, NARROW = 4096, 256, 0.9
#: Strongest coordinates of a query that are looked at first.
FOCUS = 6
#: Share of the vectors, the longest, that give the first bars.
HEAD = 0.02
_MARGIN = 1 + 1e-9
_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_BYTES).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """The share of a term's weight that a document with n terms gets for tf occurrences, in millionths."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))


def _queries(items: DataFrame) -> DataFrame:
    """number (any, different for each row), item and terms, once each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(terms(text.as_py()))) for text in batch.column(1).cast(pa.binary())]
            yield pa.record_batch([batch.column(0), pa.array(found, pa.list_(pa.binary()))], ["item", "terms"])

    found = items.mapInArrow(run, "item long, terms array<binary>").where("size(terms) > 0")
    return materialise(found.withColumn("number", F.monotonically_increasing_id()))


def _vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """id, n (terms with repeats), and of the vocabulary's terms in the text: places and tf; documents with terms only."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            sizes, places, tfs, ends = [], [], [], [0]
            for text in batch.column(1).cast(pa.binary()):
                words = terms(text.as_py())
                here = np.fromiter((i for i in map(known.get, words) if i is not None), np.int32)
                place, tf = np.unique(here, return_counts=True)
                sizes.append(len(words))
                places.append(place)
                tfs.append(tf)
                ends.append(ends[-1] + len(place))
            listed = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(x or [np.empty(0)]), t)) for x, t in ((places, pa.int32()), (tfs, pa.int64()))]
            yield pa.record_batch([batch.column(0), pa.array(sizes, pa.int64()), *listed], ["id", "n", "places", "tf"])

    found = docs.mapInArrow(run, "id long, n long, places array<int>, tf array<long>")
    return materialise(found.where("n > 0"))


def _index(vectors: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """id, norm, places and impacts of all vectors with a term of the vocabulary, written by falling norm."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tf, n = batch["tf"].flatten().to_numpy(), batch["n"].to_numpy()
            lengths = np.diff(batch["tf"].offsets.to_numpy())
            impact = impacts(tf, np.repeat(n, lengths), n_docs, n_terms)
            norm = np.sqrt(np.add.reduceat(np.append(impact.astype(float) ** 2, 0), np.append(0, np.cumsum(lengths))[:-1])) if len(n) else np.empty(0)
            listed = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lengths)), pa.int32()), pa.array(impact, pa.int64()))
            yield pa.record_batch([batch["id"], pa.array(norm), batch["places"], listed], ["id", "norm", "places", "impacts"])

    weighed = vectors.where("size(places) > 0").mapInArrow(run, "id long, norm double, places array<int>, impacts array<long>")
    width = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = weighed.withColumn("deal", F.xxhash64("id", "places", "impacts"))  # equal norms are no hot range
    return materialise(ordered.repartitionByRange(width, F.desc("norm"), "deal").sortWithinPartitions(F.desc("norm"), "deal").drop("deal"))


@dataclass
class Query:
    """A query's terms by falling weight."""

    item: int | None
    places: np.ndarray
    weights: np.ndarray
    norm: float
    bar: int = 0  # no score below it is of use


class Bucket:
    """Vectors of like norm, their impacts by term."""

    def __init__(self, norms: np.ndarray, places: np.ndarray, impact: np.ndarray, lengths: np.ndarray):
        self.norms, self.longest = norms, float(norms.max())
        order = np.argsort(places, kind="stable")
        self.rows = np.repeat(np.arange(len(norms)), lengths)[order]
        self.impact = impact[order]
        self.places, first = np.unique(places[order], return_index=True)
        self.ends = np.append(first, len(order))
        self.most = np.maximum.reduceat(self.impact, first)

    def lists(self, query: Query) -> list[tuple[int, np.ndarray, np.ndarray, int]]:
        """Weight, rows, impacts and largest impact of the query's terms that occur here, by falling weight."""
        at = np.searchsorted(self.places, query.places)
        at[at == len(self.places)] = 0
        hit = self.places[at] == query.places
        return [(int(w), self.rows[self.ends[i] : self.ends[i + 1]], self.impact[self.ends[i] : self.ends[i + 1]], int(self.most[i])) for w, i in zip(query.weights[hit], at[hit], strict=True)]

    def search(self, query: Query) -> tuple[np.ndarray, np.ndarray]:
        """Rows that may be of use, and their scores, exactly; none if no row can reach the query's bar."""
        bar, none = query.bar, (np.empty(0, np.int64), np.empty(0, np.int64))
        if not query.norm or query.norm * self.longest * _MARGIN < bar:
            return none
        lists = self.lists(query)
        if sum(w * most for w, _, _, most in lists) < bar:
            return none
        n = len(self.norms)
        score, seen, alive = np.zeros(n, np.int64), np.zeros(n), np.ones(n, bool)
        near = bar / (query.norm * self.longest * _MARGIN)  # cosine that a vector needs at least
        for w, rows, impact, _ in lists[:FOCUS]:
            score[rows] += w * impact
            seen[rows] += impact.astype(float) ** 2
            own = w / query.norm
            spread = math.sqrt((1 - own * own) * (1 - near * near)) if own < 1 else 0.0
            low, high = own * near - spread - 1e-9, 1.0 if own >= near else own * near + spread + 1e-9
            share = np.zeros(n)
            share[rows] = impact / self.norms[rows]
            alive &= (share >= low) & (share <= high)
        rest = query.norm**2 - float(sum(w * w for w, _, _, _ in lists[:FOCUS]))
        by_norm = math.sqrt(max(rest, 0.0)) * np.sqrt(np.maximum(self.norms**2 - seen, 0)) * _MARGIN + 1
        by_most = sum(w * most for w, _, _, most in lists[FOCUS:])
        alive &= score + np.minimum(by_norm, by_most) >= bar
        if not alive.any():
            return none
        for w, rows, impact, _ in lists[FOCUS:]:
            of_use = alive[rows]
            score[rows[of_use]] += w * impact[of_use]
        kept = np.flatnonzero(alive & (score > 0) & (score >= bar))
        return kept, score[kept]


def _buckets(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, Bucket]]:
    """The batch's rows, which come by falling norm, in buckets."""
    norms, i = batch["norm"].to_numpy(), 0
    while i < len(norms):
        like = i + int(np.count_nonzero(norms[i : i + BUCKET] >= NARROW * norms[i]))
        j = min(len(norms), i + BUCKET, max(like, i + SMALL))
        part = batch.slice(i, j - i)
        lengths = np.diff(part["places"].offsets.to_numpy())
        yield part["id"], Bucket(norms[i:j], part["places"].flatten().to_numpy(), part["impacts"].flatten().to_numpy(), lengths)
        i = j


def _search(index: DataFrame, queries: list[Query], k: int) -> DataFrame:
    """query (its place in the list), id and score: each task's k best rows of each query that reach its bar."""
    shared = index.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        bars = [query.bar for query in shared.value]
        for batch in batches:
            for ids, bucket in _buckets(batch):
                missing = ids.is_null().to_numpy(zero_copy_only=False)
                numbers = ids.fill_null(0).to_numpy()
                for place, query in enumerate(shared.value):
                    rows, scores = bucket.search(Query(query.item, query.places, query.weights, query.norm, bars[place]))
                    if len(rows):
                        new = (-scores, missing[rows], numbers[rows])
                        if place in held:
                            new = tuple(map(np.concatenate, zip(held[place], new, strict=True)))
                        best = np.lexsort(new[::-1])[:k]
                        held[place] = tuple(x[best] for x in new)
                        if len(best) == k:
                            bars[place] = max(bars[place], int(-held[place][0][-1]))
        for place, (scores, missing, ids) in held.items():
            columns = [pa.array(np.full(len(ids), place)), pa.array(ids, pa.int64(), mask=missing), pa.array(-scores)]
            yield pa.record_batch(columns, ["query", "id", "score"])

    return index.mapInArrow(run, "query long, id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _ranked(docs: DataFrame, asked: list, k: int) -> tuple[DataFrame, list[int | None]]:
    """The answers of one block of queries, and the item of each query of the block."""
    vocabulary = {term: i for i, term in enumerate(sorted({bytes(t) for row in asked for t in row["terms"]}))}
    vectors = _vectors(docs, vocabulary)
    n_docs, n_terms = vectors.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    frequency = dict(vectors.select(F.explode("places").alias("place")).groupBy("place").count().collect())  # the block's terms at most
    of_term = {term: weight(n_docs, frequency.get(i, 0)) for term, i in vocabulary.items()}
    queries = []
    for row in asked:
        strongest = sorted(((of_term[bytes(t)], vocabulary[bytes(t)]) for t in row["terms"]), reverse=True)
        weights = np.array([w for w, _ in strongest], np.int64)
        queries.append(Query(row["item"], np.array([p for _, p in strongest], np.int32), weights, math.sqrt(float((weights.astype(float) ** 2).sum()))))
    index = _index(vectors, n_docs, max(n_terms, 1))
    cut = index.agg(F.percentile_approx("norm", 1 - HEAD, 1000)).first()[0] or 0.0
    longest = materialise(_best(_search(index.where(F.col("norm") >= cut), queries, k), k))
    for place, bar in longest.where(F.col("rank") == k).select("query", "score").collect():
        queries[place].bar = bar
    found = longest.drop("rank").union(_search(index.where(F.col("norm") < cut), queries, k))
    return _best(found, k), [query.item for query in queries]


def search(docs: DataFrame, items: DataFrame, k: int = 10, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", query_terms: int = QUERY_TERMS) -> DataFrame:
    """item, rank (from 1), id and score of each item's k best documents with a score above 0."""
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    queries = _queries(items.select(F.col(item_col).cast("long"), F.col(item_text_col)))
    total = queries.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // query_terms))
    parts = []
    for block in range(blocks):
        asked = queries.where(F.pmod(F.xxhash64("number"), F.lit(blocks)) == block).orderBy("number").collect()
        if asked:
            found, of_query = _ranked(slim, asked, k)
            names = docs.sparkSession.createDataFrame(list(enumerate(of_query)), "query long, item long")
            parts.append(materialise(found.join(names, "query").select("item", "rank", "id", "score")))
    if not parts:
        return docs.sparkSession.createDataFrame([], "item long, rank int, id long, score long")
    out = parts[0]
    for more in parts[1:]:
        out = out.union(more)
    return out
