"""SentencePiece encoding and decoding of texts of any length, by a max-plus parallel scan.

A text is cut into chunks at fixed places, also inside words. The state at a boundary is the piece
that covers the character before it. What lies in a chunk gives a sparse transfer matrix: for a left and a right state the
sum of the scores of the pieces that begin between, or minus infinity (no entry) if no encoding joins them.
Matrices combine by the max-plus product, which is associative; the products are combined in a balanced tree, the tree is descended
to find the state at each boundary, and then each chunk is traced back independently.

The vocabulary is one of merges, where an encoding is right exactly if each two adjacent pieces
alone would be encoded as these two pieces. So two adjacent pieces that would not are joined with minus infinity, and
the best path is the encoding the library itself gives. Pieces never hold a word boundary (a space behind something
else), so the words between the first and the last boundary of a chunk are encoded by the library one
by one and remembered; only the words at the chunk's ends go through the matrices.

Null and empty texts have no pieces. The space mark itself in a text is a space after decoding, as
in the library. Repeated rows are encoded one by one, an empty table gives no rows, and columns
besides id and text are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from plazaframe.operators.durable import materialise

#: Characters of a chunk; a shorter text is one chunk. Must exceed the longest piece twice.
CHUNK = 1 << 16
#: Words that a worker remembers before it starts anew.
REMEMBERED = 500_000
SPACE = "▁"
_UNIT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")

#: A boundary state: where the piece over the character before the boundary begins and ends, from the boundary. START is the
#: text's begin, END its end.
State = tuple[int, int]
START, END = (0, 0), (1, 1)
Matrix = dict[State, dict[State, float]]


class Pieces:
    """A vocabulary; texts must be prepared with ``prepare``."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            model = sentencepiece_model_pb2.ModelProto.FromString(file.read())
        model.normalizer_spec.add_dummy_prefix = False
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
        self.score = [p.score for p in model.pieces]
        self.text = [bytes([int(p.piece[3:5], 16)]) if p.type == 6 else p.piece.encode() for p in model.pieces]
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == 1}
        self.longest = max(map(len, self.ids))
        self.known: dict[str, bytes] = {}
        self.fits: dict[tuple[str, str], bool] = {}

    @staticmethod
    def prepare(text: str | None) -> str:
        return SPACE + text.replace(" ", SPACE) if text else ""

    def alone(self, piece: str) -> list[int]:
        """The ids of a piece, or of the bytes of a character that has none."""
        own = self.ids.get(piece)
        return self.library.encode(piece) if own is None else [own]

    def adjacent(self, left: str, right: str) -> bool:
        """Whether the two pieces stay as they are side by side."""
        key = (left, right)
        if (fit := self.fits.get(key)) is None:
            if len(self.fits) > REMEMBERED:
                self.fits.clear()
            fit = self.fits[key] = self.library.encode(left + right) == self.alone(left) + self.alone(right)
        return fit

    def words(self, prepared: str) -> bytes:
        """The ids of whole words as little-endian unsigned 32-bit numbers."""
        units = _UNIT.findall(prepared) if SPACE * 2 in prepared or not prepared.startswith(SPACE) else [SPACE + w for w in prepared.split(SPACE)[1:]]
        new = set(units).difference(self.known)
        if new:
            if len(self.known) + len(new) > REMEMBERED:
                self.known.clear()
                new = set(units)
            listed = list(new)
            for unit, ids in zip(listed, self.library.encode(listed, num_threads=1), strict=True):
                self.known[unit] = np.array(ids, "<u4").tobytes()
        return b"".join(map(self.known.__getitem__, units))

    def decode(self, ids: bytes) -> str:
        """The text of some pieces, with space marks as spaces; the mark before the text is still there."""
        return b"".join(map(self.text.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode().replace(SPACE, " ")

    def weight(self, ids: bytes) -> float:
        return sum(map(self.score.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=1)
def vocabulary(path: str) -> Pieces:
    return Pieces(path)


class Chunk:
    """A chunk of a prepared text: ``begin`` to ``end`` of ``text``, which also holds the longest piece's reach around it."""

    def __init__(self, pieces: Pieces, text: str, begin: int, end: int, first: bool, last: bool):
        self.pieces, self.text, self.begin, self.end, self.first, self.last = pieces, text, begin, end, first, last
        edges = [m.start() + 1 for m in re.finditer(f"[^{SPACE}]{SPACE}", text) if begin <= m.start() + 1 <= end]
        self.head_end = begin if first else (edges[0] if edges else None)
        self.tail_begin = (end if last else (edges[-1] if edges else begin if first else None)) if self.head_end is not None else None
        self.head_end = end if self.head_end is None and last else self.head_end
        self.tail_begin = end if self.tail_begin is None and last else self.tail_begin

    def states(self) -> list[State]:
        """The pieces of the vocabulary that may lie over the character before this chunk."""
        if self.first:
            return [START]
        at, most = self.begin, self.pieces.longest
        spans = [(a, b) for a in range(max(0, at - most), at) for b in range(at, min(len(self.text), a + most) + 1)]
        return [(a - at, b - at) for a, b in spans if self.text[a:b] in self.pieces.ids or b - a == 1]

    def _paths(self, last_piece: str | None, at: int, stop: int, reach: int) -> dict[int, tuple[int, float]]:
        """For each end of a piece up to ``reach`` where its encoding began and its weight; the pieces begin before ``stop``.

        For each end there is at most one right encoding from ``at`` on, so the first that fits is it.
        """
        text, ids, most, fits = self.text, self.pieces.ids, self.pieces.longest, self.pieces.adjacent
        found: dict[int, tuple[int, float]] = {at: (-1, 0.0)}
        for end in range(at + 1, reach + 1):
            for begin in range(max(at, end - most), min(end, stop)):
                if begin not in found:
                    continue
                piece = text[begin:end]
                own = ids.get(piece)
                if own is None and end - begin > 1:
                    continue
                before = found[begin][0]
                left = last_piece if before < 0 else text[before:begin]
                if left is None or fits(left, piece):
                    weight = found[begin][1] + (self.pieces.score[own] if own is not None else 0.0)
                    found[end] = (begin, weight)
                    break
        return found

    def _trace(self, found: dict[int, tuple[int, float]], end: int) -> bytes:
        ids: list[int] = []
        while (begin := found[end][0]) >= 0:
            ids[:0] = self.pieces.alone(self.text[begin:end])
            end = begin
        return np.array(ids, "<u4").tobytes()

    def _left(self, state: State) -> tuple[str | None, int]:
        if state == START:
            return None, self.begin
        return self.text[self.begin + state[0] : self.begin + state[1]], self.begin + state[1]

    def _ends(self, found: dict[int, tuple[int, float]]) -> Iterator[tuple[State, float]]:
        for end, (begin, weight) in found.items():
            if begin >= 0 and begin < self.end <= end:
                yield (begin - self.end, end - self.end), weight

    def _reach(self) -> int:
        return min(len(self.text), self.end + self.pieces.longest)

    def matrix(self) -> Matrix:
        out: Matrix = {}
        if self.head_end is None:  # no word ends here: every left state needs a path of its own
            for state in self.states():
                piece, at = self._left(state)
                out[state] = dict(self._ends(self._paths(piece, at, self.end, self._reach())))
            return out
        between = self.pieces.weight(self.pieces.words(self.text[self.head_end : self.tail_begin]))
        if self.last:
            ends = {END: 0.0}
        elif self.tail_begin == self.end:  # a word ends where the chunk ends
            ends = None
        else:
            ends = dict(self._ends(self._paths(None, self.tail_begin, self.end, self._reach())))
        for state in self.states():
            piece, at = self._left(state)
            if at > self.head_end:
                continue
            head = self._paths(piece, at, self.head_end, self.head_end)
            if self.head_end in head:
                weight = head[self.head_end][1] + between
                out[state] = {right: weight + more for right, more in (ends if ends is not None else self._closed()).items()}
        return out

    def _closed(self) -> dict[State, float]:
        """A word ends at the end: its last piece is the state, and its weight is already counted."""
        return {(-len(self._last_piece()), 0): 0.0}

    def _last_piece(self) -> str:
        word = _UNIT.findall(self.text[max(self.head_end, self.end - CHUNK) : self.end])[-1] if self.head_end < self.end else ""
        ids = self.pieces.library.encode(word)
        text = self.pieces.decode(np.array(ids[-1:], "<u4").tobytes()) if ids and ids[-1] in self.pieces.ids.values() else word[-1:]
        return text or " "

    def encode(self, left: State, right: State) -> bytes:
        """The ids of the pieces that begin in this chunk, on the way from ``left`` to ``right``."""
        piece, at = self._left(left)
        if self.head_end is None:
            return self._trace(self._paths(piece, at, self.end, self._reach()), self.end + right[1])
        head = self._trace(self._paths(piece, at, self.head_end, self.head_end), self.head_end)
        between = self.pieces.words(self.text[self.head_end : self.tail_begin])
        if self.last or self.tail_begin == self.end:
            return head + between
        return head + between + self._trace(self._paths(None, self.tail_begin, self.end, self._reach()), self.end + right[1])


def product(a: Matrix, b: Matrix) -> Matrix:
    """The max-plus product."""
    out: Matrix = {}
    for left, row in a.items():
        best: dict[State, float] = {}
        for middle, x in row.items():
            for right, y in b.get(middle, {}).items():
                if x + y > best.get(right, float("-inf")):
                    best[right] = x + y
        if best:
            out[left] = best
    return out


def boundary_states(matrices: list[Matrix]) -> list[State]:
    """The states of the best path from START to END: one more than there are matrices."""
    tree: list[list[Matrix]] = [matrices]
    while len(tree[-1]) > 1:
        below = tree[-1]
        tree.append([product(*below[i : i + 2]) if i + 1 < len(below) else below[i] for i in range(0, len(below), 2)])

    states = [START, END]
    for level in reversed(tree[:-1]):  # each product is opened into its two parts
        opened = [states[0]]
        for i in range(0, len(level), 2):
            left, right = states[i // 2], states[i // 2 + 1]
            if i + 1 < len(level):
                row, behind = level[i][left], level[i + 1]
                opened.append(max((m for m in row if right in behind.get(m, {})), key=lambda m: row[m] + behind[m][right]))
            opened.append(right)
        states = opened
    return states


def cut(prepared: str, size: int, halo: int) -> Iterator[tuple[int, str, int, int]]:
    """number, text with the reach around it, and where the chunk begins and ends in that."""
    for number, at in enumerate(range(0, len(prepared), size)):
        low, end = max(0, at - halo), min(len(prepared), at + size)
        yield number, prepared[low : end + halo], at - low, end - low


def encode(docs: DataFrame, model: str, *, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """id, part (the number of the chunk), ids (little-endian unsigned 32-bit), and round_trip: whether the ids give the text back."""
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    names = ["id", "part", "ids", "round_trip"]
    schema = "id long, part int, ids binary, round_trip boolean"

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = vocabulary(model)
        for batch in batches:
            made, same = [], []
            for text in batch.column(1):
                prepared = pieces.prepare(text.as_py())
                whole = Chunk(pieces, prepared, 0, len(prepared), True, True)
                ids = whole.encode(START, END) if prepared else b""
                made.append(ids)
                same.append(pieces.decode(ids) == prepared.replace(SPACE, " "))
            yield pa.record_batch([batch.column(0), pa.array([0] * len(made), pa.int32()), pa.array(made, pa.binary()), pa.array(same)], names)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, task, row = vocabulary(model), TaskContext.get().partitionId(), 0
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                prepared = pieces.prepare(text.as_py())
                rows = [(key, f"{task}-{row}", *x, x[0] == 0, (x[0] + 1) * chunk >= len(prepared)) for x in cut(prepared, chunk, pieces.longest)]
                row += 1
                for one in rows:
                    yield pa.record_batch([pa.array([v], t) for v, t in zip(one, chunk_types, strict=True)], chunk_names)

    chunk_names = ["id", "row", "part", "text", "begin", "end", "first", "last"]
    chunk_types = [pa.int64(), pa.string(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.bool_(), pa.bool_()]
    chunk_schema = "id long, row string, part int, text string, begin int, end int, first boolean, last boolean"

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = vocabulary(model)
        for batch in batches:
            for r in batch.to_pylist():
                matrix = Chunk(pieces, r["text"], r["begin"], r["end"], r["first"], r["last"]).matrix()
                flat = [[*a, *b, x] for a, row in matrix.items() for b, x in row.items()]
                yield pa.record_batch([pa.array([r["row"]]), pa.array([r["part"]], pa.int32()), pa.array([flat], pa.list_(pa.list_(pa.float64())))], ["row", "part", "entries"])

    def scan(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        found = []
        for entries in group.sort_values("part")["entries"]:
            matrix: Matrix = {}
            for a, b, c, d, x in entries:
                matrix.setdefault((int(a), int(b)), {})[(int(c), int(d))] = x
            found.append(matrix)
        states = boundary_states(found)
        ways = [[*a, *b] for a, b in zip(states, states[1:], strict=False)]
        return pd.DataFrame({"row": key[0], "part": np.arange(len(ways), dtype=np.int32), "way": ways})

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = vocabulary(model)
        for batch in batches:
            for r in batch.to_pylist():
                a, b, c, d = r["way"]
                ids = Chunk(pieces, r["text"], r["begin"], r["end"], r["first"], r["last"]).encode((a, b), (c, d))
                begin = r["begin"] + (0 if r["first"] else b)
                end = r["end"] + (0 if r["last"] else d)
                same = pieces.decode(ids) == r["text"][begin:end].replace(SPACE, " ")
                yield pa.record_batch([pa.array([r["id"]], pa.int64()), pa.array([r["part"]], pa.int32()), pa.array([ids]), pa.array([same]), pa.array([r["row"]])], [*names, "row"])

    long = F.length(F.coalesce("text", F.lit(""))) + 1 > chunk
    one = slim.where(~long).mapInArrow(short, schema).withColumn("row", F.lit(None).cast("string"))
    chunks = materialise(slim.where(long).mapInArrow(split, chunk_schema))
    found = chunks.repartition("row", "part").mapInArrow(matrices, "row string, part int, entries array<array<double>>")
    ways = found.groupBy("row").applyInPandas(scan, "row string, part int, way array<int>")
    traced = chunks.join(ways, ["row", "part"]).mapInArrow(trace, f"{schema}, row string")
    return one.unionByName(traced)


def summary(encoded: DataFrame) -> DataFrame:
    """Per document: n_tokens, ids_crc32, n_parts, and whether decoding gives the text back."""

    def whole(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        ids = b"".join(group.sort_values("part")["ids"])
        return pd.DataFrame({"id": group["id"].astype("Int64")[:1], "n_tokens": [len(ids) // 4], "ids_crc32": [zlib.crc32(ids)], "n_parts": [len(group)], "round_trip": [bool(group["round_trip"].all())]})

    one = encoded.where("row IS NULL").select(
        "id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"), F.lit(1).alias("n_parts"), "round_trip"
    )
    several = encoded.where("row IS NOT NULL").groupBy("row").applyInPandas(whole, "id long, n_tokens long, ids_crc32 long, n_parts int, round_trip boolean")
    return one.unionByName(several)
