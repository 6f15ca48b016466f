"""Language identification by compression.

For each language a raw-content zstandard dictionary is filled with excerpts of labelled texts. A
text is compressed with each dictionary, in blocks so that a long text cannot live on its own
words, and the language that needs the fewest bytes is its language. Where the runner-up needs
hardly more, the prediction is marked as rejected.

The dictionaries are fitted on a bounded sample: about ``EXCERPTS`` excerpts of ``EXCERPT`` characters for each
language, drawn by a hash of the id; everything else reads all rows and whole texts.

A null text and a text without a letter is ``und`` with score 0, and rejected; so is every text if no labelled text
was there to learn from. On equal sizes the language with more labelled texts wins, then the smaller name. Repeated
rows get equal answers, an empty table gives no rows, and columns that are not named are carried
along only in the ``carried`` struct.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plazaframe.llm.worker import forget_words, give_back

EXCERPTS = 120
EXCERPT = 500
#: Characters compressed at a time.
BLOCK = 1200
LEVEL = 6
#: The least share of bytes by which the runner-up must be larger.
MARGIN = 0.004
UNKNOWN = "und"


def dictionaries(labelled: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", excerpts: int = EXCERPTS) -> list[tuple[str, bytes]]:
    """Language and dictionary, the language with the most labelled texts first. The result is bounded by the number of languages."""
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("draw")
    )
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    drawn = rows.where(F.pmod("draw", F.lit(2**40)) < F.lit(2**40) * _share(F.col("lang"), counts, excerpts))
    begin = (F.pmod(F.shiftright("draw", 40), F.greatest(F.length("text") - EXCERPT, F.lit(1)))).cast("int") + 1
    found = drawn.select("lang", "draw", F.substring(F.col("text"), begin, F.lit(EXCERPT)).alias("text")).collect()
    parts: dict[str, list[str]] = {lang: [] for lang in counts}
    for row in sorted(found, key=lambda r: (r.draw, r.text)):
        parts[row.lang].append(row.text.lower())
    size = max((sum(map(len, x)) for x in parts.values()), default=0)
    ordered = sorted(counts, key=lambda lang: (-counts[lang], lang))
    return [(lang, ("\n".join(parts[lang]) or " ").encode()[-size:]) for lang in ordered]


def _share(lang: Column, counts: dict[str, int], excerpts: int) -> Column:
    if not counts:
        return F.lit(0.0)
    return F.element_at(F.create_map(*(F.lit(x) for lang_n in counts.items() for x in (lang_n[0], min(1.0, excerpts / lang_n[1])))), lang)


class Classifier:
    def __init__(self, learned: Sequence[tuple[str, bytes]]):
        self.languages = [lang for lang, _ in learned]
        self.compressors = []
        for _, content in learned:
            entries = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            entries.precompute_compress(level=LEVEL)
            self.compressors.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=entries, write_content_size=False, write_dict_id=False))

    def sizes(self, text: str) -> list[int]:
        low = text.lower()
        blocks = [low[i : i + BLOCK].encode() for i in range(0, len(low), BLOCK)]
        return [sum(len(c.compress(block)) for block in blocks) for c in self.compressors]

    def classify(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score from 0 to 1, and whether the margin is too narrow."""
        if not text or not self.languages or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, True
        sizes = self.sizes(text)
        best = min(range(len(sizes)), key=sizes.__getitem__)
        others = sizes[:best] + sizes[best + 1 :]
        margin = 1.0 if not others else (min(others) - sizes[best]) / min(others)
        return self.languages[best], min(1.0, margin / (margin + 0.05)), margin < MARGIN


def identify(docs: DataFrame, learned: Sequence[tuple[str, bytes]], *, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = ()) -> DataFrame:
    """id, text, lang_pred, score, rejected, and the ``carried`` columns in a struct."""
    shared = docs.sparkSession.sparkContext.broadcast(list(learned))
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.struct(F.lit(0).alias("none"), *carry).alias("carried"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_words()
        classifier = Classifier(shared.value)
        for batch in batches:
            answers = [classifier.classify(text.as_py()) for text in batch["text"]]
            made = [pa.array([a[i] for a in answers], t) for i, t in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.record_batch([batch["id"], batch["text"], *made, batch["carried"]], ["id", "text", "lang_pred", "score", "rejected", "carried"])
        give_back()

    schema = slim.select("id", "text").schema.add("lang_pred", "string").add("score", "double").add("rejected", "boolean").add("carried", slim.schema["carried"].dataType)
    return slim.mapInArrow(run, schema)
