"""Document quality by a linear-chain conditional random field over lines.

Each line has measures of its characters and repetitions, and a line's features are its own measures and those
of its neighbours. The field labels every line good or bad; the forward-backward marginals of good, weighted by
the lines' lengths, give the document's score.

The weights are fitted on a bounded sample: at most about ``SAMPLE`` labelled documents of at most ``LINES`` lines,
drawn by a hash of the text, where every line takes its document's label. Scoring reads whole texts, all lines.

Lines without words are left out; a text without words, or null, is one line without any, so it
gets a score too. Repeated rows get equal scores. An empty table gives no rows; without labelled texts all scores are 0.5.
Columns besides id and text are ignored.
"""

from __future__ import annotations

import io
import math
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plazaframe.llm.shingles import mix, word_hashes, word_runs

SAMPLE = 4000
LINES = 300
RUN = 4
OTHER, BLANK, UPPER, LOWER, DIGIT, SYMBOL, SHOUT, MEASURES = 0, 1, 2, 3, 4, 5, 6, 14


def _classes() -> np.ndarray:
    """The class of each code point below 65536; those above count as other letters."""
    out = np.zeros(1 << 16, np.uint8)
    for code in range(1 << 16):
        kind = unicodedata.category(chr(code))
        if kind[0] == "L":
            out[code] = UPPER if kind == "Lu" else LOWER
        elif kind == "Nd":
            out[code] = DIGIT
    out[[9, 10, 11, 12, 13, 32]] = BLANK
    out[[ord(c) for c in "#*$%&|<>"]] = SYMBOL
    out[[ord(c) for c in "!?"]] = SHOUT
    return out


_CLASS = _classes()


def _repeats(values: np.ndarray) -> np.ndarray:
    """Which of the values occurred before."""
    _, first, inverse = np.unique(values, return_index=True, return_inverse=True)
    return first[inverse] != np.arange(len(values))


def measures(text: str) -> tuple[np.ndarray, np.ndarray]:
    """One row of measures for each line with words, and the lines' lengths."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = np.where(codes < 1 << 16, _CLASS[np.minimum(codes, (1 << 16) - 1)], LOWER)
    breaks = codes == 10
    line = np.cumsum(breaks) - breaks
    n = int(breaks.sum()) + 1
    blank = kinds == BLANK
    count = np.bincount(line * 8 + kinds, minlength=8 * n).reshape(n, 8).astype(float)
    starts = ~blank & np.concatenate(([True], blank[:-1]))
    per_line = np.bincount(line[starts], minlength=n)
    words = word_hashes(text)
    of = np.repeat(np.arange(n), per_line)
    runs = word_runs(words, RUN)
    if len(words) < RUN:
        runs = runs[:0]
    again = np.bincount(of[: len(runs)][_repeats(runs)], minlength=n)
    same = np.bincount(of[1:][words[1:] == words[:-1]], minlength=n)
    with np.errstate(over="ignore"):
        own = np.bincount(of[_repeats(words ^ mix(of.astype(np.uint64)))], minlength=n)
    full = per_line > 0
    seen: set[str] = set()
    twice = np.zeros(n)
    for i, x in enumerate(text.split("\n")):
        twice[i] = x in seen
        seen.add(x)
    chars = count.sum(1) - count[:, BLANK]
    letters = count[:, UPPER] + count[:, LOWER]
    w, c, a = np.maximum(per_line, 1), np.maximum(chars, 1), np.maximum(letters, 1)
    columns = [
        np.ones(n), np.log1p(chars) / 5, np.log1p(per_line) / 4, chars / w / 10, count[:, UPPER] / a, count[:, DIGIT] / c, count[:, SYMBOL] / w,
        count[:, SHOUT] / w, letters / c, again / w, same / w, own / w, twice, count[:, OTHER] / w,
    ]
    rows = np.clip(np.stack(columns, 1), 0, 3)
    return (rows[full], chars[full]) if full.any() else (rows[:1], np.ones(1))


def features(rows: np.ndarray) -> np.ndarray:
    """A line's measures with those of the line before and of the line behind."""
    none = np.zeros((1, rows.shape[1]))
    return np.concatenate([rows, np.concatenate([none, rows[:-1]]), np.concatenate([rows[1:], none])], 1)


def marginals(gain: np.ndarray, move: np.ndarray) -> np.ndarray:
    """The probability that each line is good, by forward-backward; ``gain`` favours good, ``move`` is [from, to] with bad as 0."""
    stay_bad, go_good, go_bad, stay_good = (math.exp(x) for x in move.ravel().tolist())
    odds = np.clip(gain, -50, 50).tolist()
    ahead, p = [], None
    for x in odds:  # forward: the probability of good, scaled at each line
        good, bad = (1.0, 1.0) if p is None else (p * stay_good + (1 - p) * go_good, p * go_bad + (1 - p) * stay_bad)
        e = math.exp(x)
        p = good * e / (good * e + bad)
        ahead.append(p)
    out, b_good, b_bad = [0.0] * len(odds), 0.5, 0.5
    for i in range(len(odds) - 1, -1, -1):
        g, b = ahead[i] * b_good, (1 - ahead[i]) * b_bad
        out[i] = g / (g + b)
        e = math.exp(odds[i])
        g, b = stay_good * e * b_good + go_bad * b_bad, go_good * e * b_good + stay_bad * b_bad
        b_good, b_bad = g / (g + b), b / (g + b)
    return np.array(out)


def fit(examples: list[tuple[np.ndarray, int]], rounds: int = 250, rate: float = 0.1, ridge: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the features and of the moves, by Adam on the likelihood of the line labels."""
    width = 3 * MEASURES
    theta = np.zeros(width + 4)
    if not examples:
        return theta[:width], theta[width:].reshape(2, 2)
    examples = sorted(examples, key=lambda x: len(x[0]))
    batches = [_padded(examples[i : i + 500]) for i in range(0, len(examples), 500)]
    m, v = theta * 0, theta * 0
    for step in range(1, rounds + 1):
        slope = sum(_slope(theta, *batch) for batch in batches) / len(examples) - ridge * theta
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
        theta = theta + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return theta[:width], theta[width:].reshape(2, 2)


def _padded(examples: list[tuple[np.ndarray, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    most = max(len(x) for x, _ in examples)
    x = np.zeros((len(examples), most, 3 * MEASURES))
    there = np.zeros((len(examples), most), bool)
    for i, (rows, _) in enumerate(examples):
        x[i, : len(rows)], there[i, : len(rows)] = rows, True
    return x, there, np.array([label for _, label in examples])


def _slope(theta: np.ndarray, x: np.ndarray, there: np.ndarray, label: np.ndarray) -> np.ndarray:
    """What was seen less what the field expects, summed over documents."""
    width = x.shape[2]
    move = np.exp(theta[width:].reshape(2, 2))
    e = np.ones((*there.shape, 2))
    e[..., 1] = np.exp(np.clip(x @ theta[:width], -50, 50))
    n, length = there.shape
    ahead, back = np.zeros((n, length, 2)), np.full((n, length, 2), 0.5)
    ahead[:, 0] = e[:, 0] / e[:, 0].sum(1, keepdims=True)
    for i in range(1, length):
        a = (ahead[:, i - 1] @ move) * e[:, i]
        ahead[:, i] = np.where(there[:, i, None], a / a.sum(1, keepdims=True), ahead[:, i - 1])
    for i in range(length - 2, -1, -1):
        b = (e[:, i + 1] * back[:, i + 1]) @ move.T
        back[:, i] = np.where(there[:, i + 1, None], b / b.sum(1, keepdims=True), 0.5)
    p = ahead * back
    p /= p.sum(2, keepdims=True)
    off = np.where(there, label[:, None] - p[..., 1], 0)
    pairs = ahead[:, :-1, :, None] * move * (e * back)[:, 1:, None, :]
    pairs = pairs / np.maximum(pairs.sum((2, 3), keepdims=True), 1e-300) * there[:, 1:, None, None]
    steps = there[:, 1:].sum(1)
    seen = np.zeros((2, 2))
    seen[0, 0], seen[1, 1] = steps[label == 0].sum(), steps[label == 1].sum()
    return np.concatenate([np.einsum("nl,nlf->f", off, x), (seen - pairs.sum((0, 1))).ravel()])


def learn(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Fits the field on labelled documents; ``labels`` has the ids that may be learned from."""
    usable = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    n = usable.count()
    drawn = usable.where(F.pmod(F.xxhash64("id"), F.lit(2**40)) < F.lit(2.0**40 * min(1.0, sample / max(n, 1))))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made, kept = [], []
            for text, label in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                rows, _ = measures(text.as_py() or "")
                if len(rows) <= LINES:
                    out = io.BytesIO()
                    np.save(out, rows.astype(np.float32))
                    made.append(out.getvalue())
                    kept.append(label)
            yield pa.record_batch([pa.array(made, pa.binary()), pa.array(kept, pa.int32())], ["rows", "label"])

    labelled = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(drawn, "id").select("text", "label")
    found = labelled.mapInArrow(measure, "rows binary, label int").collect()
    return fit([(features(np.load(io.BytesIO(bytes(r.rows))).astype(float)), r.label) for r in sorted(found, key=lambda r: bytes(r.rows))])


def score_text(text: str | None, weights: np.ndarray, move: np.ndarray) -> tuple[float, int]:
    """The length-weighted share of good lines, and how many lines are more likely bad than good."""
    rows, length = measures(text or "")
    good = marginals(features(rows) @ weights, move)
    return min(1.0, max(0.0, float(good @ length / length.sum()))), int((good < 0.5).sum())


def score(docs: DataFrame, weights: np.ndarray, move: np.ndarray, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, score and n_bad_lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [score_text(text.as_py(), weights, move) for text in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array([m[0] for m in made], pa.float64()), pa.array([m[1] for m in made], pa.int32())], ["id", "score", "n_bad_lines"])

    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(run, slim.select("id").schema.add("score", "double").add("n_bad_lines", "integer"))
