"""Quality rules as a short-circuit cascade, in DataFrame expressions only.

Each rule says when a text is rejected. On a sample of at most about ``SAMPLE`` rows every rule is run alone: its seconds
are its cost, the share it rejects its selectivity. The rules are then asked in the order of
rejections per second, and a text is asked no further once a rule has rejected it. The order changes
only the cost, never the verdict: all rows are judged by all rules that are needed to judge them.

Words are runs of characters other than space, tab, line feed, vertical tab, form feed and carriage
return. Null texts have no words and fail the first base rule, as empty ones do. Repeated rows are
judged alike, an empty table gives no rows, and columns besides id and text are ignored.
"""

from __future__ import annotations

import time
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plazaframe.llm.arrays import let

SAMPLE = 2000
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8


def _count(text: Column, characters: str) -> Column:
    """How many characters of ``text`` are among ``characters``."""
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def words(text: Column) -> Column:
    return F.filter(F.split(text, r"[ \t-\r]+"), lambda w: w != "")


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: F.translate(line, BLANKS, "") != "")


def repeated_words(all_words: Column, window: int = WINDOW) -> Column:
    """Words that stand in a window of ``window`` words found twice or more in the text."""

    def covered(found: Column) -> Column:
        ordered = F.sort_array(F.transform(found, lambda x, i: F.struct(x.alias("hash"), i.alias("at"))))
        return let(
            ordered,
            lambda s: let(
                F.sort_array(
                    F.transform(
                        F.filter(s, lambda x, k: F.get(s, k + 1)["hash"].eqNullSafe(x["hash"]) | F.get(s, k - 1)["hash"].eqNullSafe(x["hash"])),
                        lambda x: x["at"],
                    )
                ),
                lambda at: F.aggregate(F.transform(at, lambda x, k: F.least(F.lit(window), F.coalesce(F.get(at, k + 1) - x, F.lit(window)))), F.lit(0), lambda a, b: a + b),
            ),
        )

    def count(hashes: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(1), F.size(hashes) - (window - 1)), lambda i: F.xxhash64(F.slice(hashes, i, window)))
        distinct_or_covered = let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(covered(w)))
        return F.when(F.size(hashes) <= window, F.lit(0)).otherwise(distinct_or_covered)

    return let(F.transform(all_words, lambda w: F.xxhash64(w)), count).cast("long")


def measures(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document what the rules look at."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    split = slim.select("doc_id", "text", words(F.col("text")).alias("words"), lines_with_words(F.col("text")).alias("lines"))
    text, all_words, lines = F.col("text"), F.col("words"), F.col("lines")
    return split.select(
        "doc_id",
        F.size(all_words).cast("long").alias("n_words"),
        F.length(F.translate(text, BLANKS, "")).cast("long").alias("word_chars"),
        _count(text, SYMBOLS).alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        repeated_words(all_words).alias("n_repeat_words"),
        F.size(lines).cast("long").alias("n_lines"),
        text,
    )


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def rules() -> dict[str, Column]:
    """When a text is rejected, beyond the base rules."""
    text = F.col("text")
    letters = F.length(F.regexp_replace(text, r"\P{L}+", ""))
    return {
        "symbols": 10 * F.col("n_symbols") > F.col("n_words"),
        "word_length": (F.col("word_chars") < 2 * F.col("n_words")) | (F.col("word_chars") > 15 * F.col("n_words")),
        "repeated_lines": (F.col("n_dup_lines") > 2) & (10 * F.col("n_dup_lines") > 3 * F.col("n_lines")),
        "capitals": 10 * F.length(F.regexp_replace(text, r"\P{Lu}+", "")) > 4 * letters,
        "letters": 10 * letters < 6 * F.col("word_chars"),
        "exclamations": 10 * _count(text, "!?") > 3 * F.col("n_words"),
    }


def cascade_order(measured: DataFrame, asked: Mapping[str, Column]) -> list[str]:
    """The names of the rules by rejections per second on ``measured``, the best first."""
    gain = {}
    for name, rejects in asked.items():
        took = []
        for _ in range(2):  # the first run compiles
            began = time.perf_counter()
            share = measured.agg(F.avg(F.coalesce(rejects, F.lit(False)).cast("int"))).first()[0] or 0.0
            took.append(time.perf_counter() - began)
        gain[name] = share / max(min(took), 1e-4)
    return sorted(gain, key=lambda name: (-gain[name], name))


def rejected(asked: Mapping[str, Column], order: list[str]) -> Column:
    """Whether a rule rejects; later rules are not computed once one has."""
    verdict = F.lit(False)
    for name in reversed(order):
        verdict = F.when(asked[name], F.lit(True)).otherwise(verdict)
    return verdict


def judge(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE) -> DataFrame:
    """Per document its base counts, base_failed, and kept by the cascade."""
    rows = docs.count()
    sample = docs.sample(min(1.0, sample_rows / rows), seed=5) if rows > sample_rows else docs
    asked = rules()
    with held(measures(sample, id_col=id_col, text_col=text_col)) as measured:
        order = cascade_order(measured, asked)
    measured = measures(docs, id_col=id_col, text_col=text_col)
    counts = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    judged = measured.select(*counts, "n_lines", "text", base_failed().alias("base_failed"))
    kept = F.when(F.col("base_failed"), F.lit(False)).otherwise(~rejected(asked, order))
    return judged.select(*counts, "base_failed", kept.alias("kept"))


class held:
    """Keeps a small frame in the executors' memory for a few passes; a lost part is computed again."""

    def __init__(self, df: DataFrame):
        self.df = df

    def __enter__(self) -> DataFrame:
        return self.df.persist()

    def __exit__(self, *_) -> None:
        self.df.unpersist()
