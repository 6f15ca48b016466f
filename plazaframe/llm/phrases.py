"""Collocations by set-oriented mining (SETM) over persisted occurrence relations.

R(1) holds all word occurrences sorted by piece and position, R(k) the occurrences of frequent phrases of k words.
Each relation is written. From one length to the next:

* R(k) is merge-joined with itself on the piece and the adjacent position: a phrase of k + 1 words is the pair of its first k
  and its last k words, both frequent;
* the pairs are counted by groups, first inside each block, then over all blocks;
* the occurrences are semi-joined with the pairs that are frequent, which gives R(k + 1).

The relation is kept in blocks of about ``BLOCK`` bytes of text. A block holds whole pieces, so the merge join is a walk along
its sorted rows, and a phrase is counted once per block before anything is shuffled, however often the block repeats it: no phrase is hot. A block's
row is ``at``, which tells for each position the phrase that begins there as a place in the block's list
``grams`` (-1: none, and between pieces), 32-bit integers packed by zstandard. What a block has counted is dealt by the phrase's hash
into as many parts as keep a part near ``PART`` phrases, packed as one compressed row per part; a task adds up one part at a time. Phrases are told apart
by words and pairs of numbers, never by hashes; a phrase's number is the least (block, place) where it was seen. Frequent phrases are never
broadcast by this module and never come to the driver.

A text is lower-cased (A-Z only) and split at the marks ``MARKS`` into pieces, and those at spaces and tabs into words.
Everything is counted per language; a null language is ``und``. Null and empty texts have no words. Repeated rows count
each time. Very long texts are cut into several blocks between pieces; a single piece is never cut. An empty table gives no rows. Other
columns are ignored, whatever their names. Ties are broken by count and then by the phrase in the order of its UTF-8 bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plazaframe.llm.shingles import mix
from plazaframe.llm.worker import give_back
from plazaframe.operators.durable import discard, materialise

MARKS = b".,;:!?\n\x0b\x0c\r"
#: Bytes of text in a block; a block of one giant piece is larger.
BLOCK = 16_000_000
#: Bytes of text split into words at a time.
STRETCH = 2_000_000
#: Phrases, as counted in blocks, that are added up at a time; a hash deals them out, so that this is an average.
PART = 2_000_000
#: A phrase's number: task, block of the task, place in the block.
_BLOCK_BITS, _PLACE_BITS = 14, 27
_MARK = b"\xff"  # stands in no UTF-8 text
_BYTES = bytes(0xFF if c in MARKS else 0x20 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))


def _pack(numbers: np.ndarray) -> bytes:
    """Whole numbers from -1 on, as compressed planes of their bytes."""
    planes = (numbers + 1).astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64) - 1


def _packed_rows(places: np.ndarray, columns: dict[str, pa.Array | np.ndarray]) -> bytes:
    """Columns of a small table as one compressed value, with ``places``, which rise, as their differences."""
    batch = pa.record_batch([pa.array(np.diff(places, prepend=0)), *map(pa.array, columns.values())], ["place", *columns])
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return out.getvalue().to_pybytes()


def _rows(data: pa.BinaryScalar) -> pa.Table:
    table = pa.ipc.open_stream(data.as_buffer()).read_all()
    return table.set_column(0, "place", pa.array(np.cumsum(table["place"].to_numpy())))


def _stretches(data: bytes, size: int) -> Iterator[bytes]:
    """``data`` cut between pieces into parts of about ``size`` bytes."""
    start = 0
    while len(data) - start > size:
        cut = data.find(_MARK, start + size)
        if cut < 0:
            break
        yield data[start:cut]
        start = cut + 1
    yield data[start:]


def _words(stretches: list[bytes]) -> tuple[np.ndarray, pa.Array]:
    """The word at each position, -1 between pieces, and the list of different words."""
    coded, start, size = [], 0, 0
    for i, stretch in enumerate(stretches, 1):
        size += len(stretch)
        if size >= STRETCH or i == len(stretches):
            tokens = _MARK.join(stretches[start:i]).replace(_MARK, b" \xff ").split()
            coded.append(pa.array([_MARK, *tokens, _MARK], pa.binary()).dictionary_encode())
            start, size = i, 0
    whole = pa.chunked_array(coded).unify_dictionaries()
    places = np.concatenate([c.indices.to_numpy() for c in whole.chunks])
    return places - 1, whole.chunk(0).dictionary[1:]  # the mark is the first of the list


def _occurrences(docs: DataFrame, block_bytes: int) -> DataFrame:
    """The words of all texts in blocks: block, at, size (different words), words (packed: language, mark and word; n) and totals (lang, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        held: dict[str, list[bytes]] = {}
        size = 0

        def block() -> pa.RecordBatch:
            if made >> _BLOCK_BITS:
                raise ValueError("a task has too many blocks: read the table in smaller partitions")
            at, words, counts, known = [], [], [], 0
            for lang, stretches in held.items():
                places, different = _words(stretches)
                at += [np.where(places < 0, -1, places + known), [-1]]
                counts.append(np.bincount(places[places >= 0], minlength=len(different)))
                words.append(pc.binary_join_element_wise(pa.scalar(lang.encode(), pa.binary()), different, _MARK))
                known += len(different)
            packed = _packed_rows(np.arange(known), {"word": pa.concat_arrays(words), "n": np.concatenate(counts)})
            totals = [{"lang": lang, "n": int(n.sum())} for lang, n in zip(held, counts, strict=True)]
            columns = [part << _BLOCK_BITS | made], [_pack(np.concatenate(at))], [known], [packed], [totals]
            return pa.record_batch(list(map(pa.array, columns)), ["block", "at", "size", "words", "totals"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
                for stretch in _stretches((text.as_py() or b"").translate(_BYTES), block_bytes):
                    held.setdefault(lang, []).append(stretch)
                    size += len(stretch)
                    if size >= block_bytes:
                        yield block()
                        held, size, made = {}, 0, made + 1
        if held:
            yield block()
        held.clear()
        give_back()

    slim = docs.select(F.coalesce("lang", F.lit("und")), "text")
    return slim.mapInArrow(run, "block long, at binary, size long, words binary, totals array<struct<lang:string,n:long>>")


def _adjacent(at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Where two phrases of the list follow each other by one position, and that pair as one number."""
    here, next_one = at[:-1], at[1:]
    places = np.flatnonzero((here >= 0) & (next_one >= 0))
    return places, here[places] * size + next_one[places]


def _dealt(block: int, hashes: np.ndarray, parts: int, columns: dict[str, pa.Array | np.ndarray]) -> pa.RecordBatch:
    """A block's counts as one packed row per part: part, block, counts."""
    which = (hashes % np.uint64(parts)).astype(np.int64)
    order = np.argsort(which, kind="stable")
    ends = np.searchsorted(which[order], np.arange(parts + 1))
    rows = [(p, order[a:b]) for p, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True)) if a < b]
    packed = [_packed_rows(at, {name: pa.array(c).take(pa.array(at)) for name, c in columns.items()}) for _, at in rows]
    return pa.record_batch([pa.array([p for p, _ in rows], pa.int64()), pa.array([block] * len(rows), pa.int64()), pa.array(packed, pa.binary())], ["part", "block", "counts"])


def _word_counts(occurrences: DataFrame, parts: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data in zip(batch["block"].to_pylist(), batch["words"], strict=True):
                words = _rows(data)
                hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words["word"].to_pylist()), np.uint64, words.num_rows)
                yield _dealt(block, hashes, parts, {c: words[c].combine_chunks() for c in ("word", "n")})
                del words, hashes
        give_back()

    return occurrences.select("block", "words").mapInArrow(run, "part long, block long, counts binary")


def _pair_counts(relation: DataFrame, parts: int) -> DataFrame:
    """The merge join's groups in each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data, listed in zip(batch["block"].to_pylist(), batch["at"], batch["grams"], strict=True):
                grams = listed.values.to_numpy()
                pairs, counts = np.unique(_adjacent(_unpack(data.as_py()), len(grams))[1], return_counts=True)
                if len(pairs):
                    first, last = grams[pairs // len(grams)], grams[pairs % len(grams)]
                    hashes = mix(mix(first.astype(np.uint64)) ^ last.astype(np.uint64))
                    yield _dealt(block, hashes, parts, {"first": first, "last": last, "n": counts})
                    del first, last, hashes
                del pairs, counts
        give_back()

    return relation.mapInArrow(run, "part long, block long, counts binary")


def _frequent(counts: DataFrame, key: list[str], least: int) -> DataFrame:
    """Per part and block the frequent phrases: kept (place and gram, packed), and grams, those numbered after this block."""

    def add_up(part: pa.Table) -> pa.Table:
        try:
            return add_up_part(part)
        finally:
            give_back()

    def add_up_part(part: pa.Table) -> pa.Table:
        tables = [_rows(data) for data in part["counts"].combine_chunks()]
        sizes = [t.num_rows for t in tables]
        block = np.repeat(part["block"].to_numpy(), sizes)
        table = pa.concat_tables(tables).combine_chunks()
        place, n = (table[c].to_numpy() for c in ("place", "n"))
        tag = (block << _PLACE_BITS) + place
        codes = [table[c].chunk(0).dictionary_encode().indices.to_numpy() if c == "word" else table[c].to_numpy() for c in key]
        order = np.lexsort(codes)
        fresh = np.concatenate(([True], np.any([c[order][1:] != c[order][:-1] for c in codes], axis=0)))
        start = np.flatnonzero(fresh)
        total, least_tag = np.add.reduceat(n[order], start), np.minimum.reduceat(tag[order], start)
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum(fresh) - 1
        a, gram = total[group], least_tag[group]
        often = np.flatnonzero(a >= least)  # still in the order of blocks
        ends = np.searchsorted(often, np.append(0, np.cumsum(sizes)))
        out = []
        for number, i, j in zip(part["block"].to_pylist(), ends[:-1], ends[1:], strict=True):
            here = often[i:j]
            if len(here):
                own = here[tag[here] == gram[here]]
                values = [table[c].chunk(0).take(pa.array(own)) for c in key]
                if key == ["word"]:
                    parted = [w.split(_MARK) for w in values[0].to_pylist()]
                    values = [pa.array([w[i].decode() for w in parted], pa.string()) for i in range(2)]
                named = pa.StructArray.from_arrays([pa.array(gram[own]), *values, pa.array(a[own])], [n for n, _ in fields])
                out.append((number, _packed_rows(place[here], {"gram": gram[here]}), named))
        kind = pa.struct([(n, pa.string() if t == "string" else pa.int64()) for n, t in fields])
        offsets = np.append(0, np.cumsum([len(x[2]) for x in out])).astype(np.int32)
        grams = pa.ListArray.from_arrays(pa.array(offsets), pa.concat_arrays([x[2] for x in out]) if out else pa.array([], kind))
        return pa.table([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.binary()), grams], ["block", "kept", "grams"])

    fields = [("gram", "long"), *([("lang", "string"), ("word", "string")] if key == ["word"] else [(c, "long") for c in key]), ("a", "long")]
    schema = ",".join(f"{n}:{t}" for n, t in fields)
    return materialise(counts.groupBy("part").applyInArrow(add_up, f"block long, kept binary, grams array<struct<{schema}>>"))


def _extended(relation: DataFrame, frequent: DataFrame, paired: bool) -> DataFrame:
    """The occurrences semi-joined with the frequent phrases of their block; ``paired``: of pairs of what ``relation`` holds.

    ``size`` is the number of frequent phrases of the block, ``pairs`` that of adjacent occurrences.
    """
    lists = frequent.groupBy("block").agg(F.collect_list("kept").alias("kept"))  # one row per part

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data, size, kept in zip(batch["block"].to_pylist(), batch["at"], batch["size"].to_pylist(), batch["kept"], strict=True):
                at = _unpack(data.as_py())
                listed = pa.concat_tables(map(_rows, kept.values)).sort_by("place")
                places, grams = listed["place"].to_numpy(), listed["gram"].to_numpy()
                if paired:
                    where, pairs = _adjacent(at, size)
                    different, which = np.unique(pairs, return_inverse=True)
                    at = np.full(len(at), -1)
                    at[where] = which
                    size = len(different)
                numbers = np.full(size + 1, -1)  # the last one is for -1
                numbers[places] = np.arange(len(places))
                new = numbers[at]
                adjacent = int(np.count_nonzero((new[:-1] >= 0) & (new[1:] >= 0)))
                columns = [block], [_pack(new)], [len(grams)], [adjacent], [grams]
                yield pa.record_batch(list(map(pa.array, columns)), ["block", "at", "size", "pairs", "grams"])
                del at, new, numbers, columns
        give_back()

    joined = relation.select("block", "at", "size").join(lists, "block").select("block", "at", "size", "kept")
    return materialise(joined.mapInArrow(run, "block long, at binary, size long, pairs long, grams array<long>"))


def _parts(relation: DataFrame, number: str) -> int:
    return 1 + (relation.agg(F.sum(number)).first()[0] or 0) // PART


def _named(frequent: DataFrame, shorter: DataFrame) -> DataFrame:
    """One row per frequent phrase: gram, lang, phrase, final (its last word), a, and the counts of all its first and last parts."""
    once = frequent.select(F.inline("grams"))
    first = shorter.select(F.col("gram").alias("first"), "lang", F.col("phrase").alias("start"), F.concat("heads", F.array("a")).alias("heads"))
    last = shorter.select(F.col("gram").alias("last"), "final", F.concat(F.array("a"), "tails").alias("tails"))
    joined = once.join(first, "first").join(last, "last")
    return materialise(joined.select("gram", "first", "last", "lang", F.concat_ws(" ", "start", "final").alias("phrase"), "final", "a", "heads", "tails"))


_SCORES = """transform(heads, (head, i) -> named_struct(
    'score', (2000000 * cast(a AS decimal(20,0))) div (cast(head AS decimal(20,0)) + cast(tails[i] AS decimal(20,0))),
    'cut', i, 'l', head, 'r', tails[i]))"""


def collocations(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", longest: int = 4, least: int = 30, top: int = 2000, block_bytes: int = BLOCK) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's ``top`` phrases of two to ``longest`` words.

    A phrase occurs a >= ``least`` times, its best-explained cut has parts that occur l and r times, and the language has n words;
    score is floor(2000000 * a / (l + r)). Phrases of which four fifths or more of the occurrences lie in one longer phrase are left out.
    """
    slim = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    occurrences = materialise(_occurrences(slim, block_bytes))
    totals = materialise(occurrences.select(F.inline("totals")).groupBy("lang").agg(F.sum("n").alias("n")))
    frequent = _frequent(_word_counts(occurrences, _parts(occurrences, "size")), ["word"], least)
    none = F.array().cast("array<long>")
    level = materialise(frequent.select(F.inline("grams")))
    level = level.select("gram", "lang", F.col("word").alias("phrase"), F.col("word").alias("final"), "a", none.alias("heads"), none.alias("tails"))
    relation, levels = occurrences, []
    for size in range(2, longest + 1):
        extended = _extended(relation, frequent, paired=size > 2)
        discard(relation)  # nothing reads it any more
        relation = extended
        frequent = _frequent(_pair_counts(relation, _parts(relation, "pairs")), ["first", "last"], least)
        level = _named(frequent, level)
        levels.append(level)
    discard(relation)

    # a longer phrase with nearly all occurrences contains one that is longer by a single word and has them too
    kept = []
    for level, longer in zip(levels, [*levels[1:], None], strict=True):
        if longer is not None:
            around = longer.select(F.col("first").alias("gram"), "a").union(longer.select("last", "a"))
            level = level.join(around.groupBy("gram").agg(F.max("a").alias("around")), "gram", "left")
            level = level.where("around IS NULL OR 100 * cast(around AS decimal(20,0)) < 80 * cast(a AS decimal(20,0))")
        kept.append(level.select("lang", "phrase", "a", F.array_min(F.expr(_SCORES)).alias("best")))
    everything = kept[0]
    for more in kept[1:]:
        everything = everything.union(more)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    scored = everything.select("lang", "phrase", "a", "best.l", "best.r", "best.score")
    ranked = scored.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
