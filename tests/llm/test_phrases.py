"""Phrase mining against plain counting, and on awkward rows."""

import random
import re
from collections import Counter

import oracle
from plazaframe.llm import phrases, queries, registered  # noqa: F401

COLUMNS = "doc_id long, text string, lang string"


def plain(rows, least=30, longest=4, top=2000):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")):
            words = [w for w in re.split(r"[ \t]+", piece) if w]
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                counts.update((lang, tuple(words[i : i + size])) for i in range(len(words) - size + 1))
    candidates = {p: a for p, a in counts.items() if len(p[1]) > 1 and a >= least}
    found = {}
    for (lang, words), a in candidates.items():
        inside = any(
            other == lang and len(longer) > len(words) and 100 * b >= 80 * a and any(longer[i : i + len(words)] == words for i in range(len(longer)))
            for (other, longer), b in candidates.items()
        )
        if not inside:
            cuts = [(2000000 * a // (counts[lang, words[:k]] + counts[lang, words[k:]]), k, counts[lang, words[:k]], counts[lang, words[k:]]) for k in range(1, len(words))]
            score, _, left, right = min(cuts)
            found.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    return sorted(
        (lang, rank, phrase.decode(), -a, left, right, totals[lang], -score)
        for lang, listed in found.items()
        for rank, (score, a, phrase, left, right) in enumerate(sorted(listed)[:top], 1)
    )


def mined(spark, rows, partitions=3, **options):
    df = spark.createDataFrame([(i, text, lang) for i, (lang, text) in enumerate(rows)], COLUMNS).repartition(partitions)
    return sorted(tuple(r) for r in phrases.collocations(df, **options).collect())


def test_equals_plain_counting_whatever_the_blocks(spark):
    draw = random.Random(3)
    words = ["new", "York", "is", "a", "big", "city", "naïve", "日本", "x-y", "İ", "the"]
    rows = []
    for _ in range(700):
        text = "".join(draw.choice(words) + draw.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r\n"]) for _ in range(draw.randint(0, 60)))
        rows.append((draw.choice(["en", "en", "fr", None, "und"]), text + draw.choice(["", "New York is a big city", "in the end of it all"])))
    rows += [("en", None), ("en", ""), (None, " \t\n"), ("fr", "one two three four five " * 400)]  # a long text of one piece
    rows += [("fr", rows[-1][1].replace("five", "five."))] * 3
    wanted = plain(rows)
    assert len(wanted) > 60
    assert mined(spark, rows) == wanted
    assert mined(spark, rows, 1, block_bytes=200) == wanted
    assert mined(spark, rows, least=5, longest=3, top=4) == plain(rows, 5, 3, 4)


def test_counts_that_pass_64_bits_when_multiplied(spark):
    row = spark.sql("SELECT 5000000000000000L AS a, array(5000000000000000L) AS heads, array(9000000000000000000L) AS tails")
    assert row.selectExpr(phrases._SCORES + " AS s").first()["s"][0]["score"] == 2000000 * 5 * 10**15 // (5 * 10**15 + 9 * 10**18)


def test_empty_table_and_other_columns(spark, docs):
    assert phrases.collocations(docs.where("doc_id < 0")).collect() == []
    clashing = docs.selectExpr("doc_id", "text", "lang", "1 AS block", "2 AS at", "3 AS n", "4 AS gram", "5 AS rank")
    rows = [(r["lang"], r["text"]) for r in docs.collect()]
    assert sorted(map(tuple, phrases.collocations(clashing).collect())) == plain(rows)


def test_registered_query(spark, sample_folder):
    found = queries.QUERIES["op11_phrases"](spark, sample_folder)
    assert found.dtypes == [("lang", "string"), ("rank", "bigint"), ("phrase", "string"), *((c, "bigint") for c in "alrn"), ("score", "bigint")]
    assert oracle.of_spark(found) == oracle.of_sql(oracle.connect(sample_folder), queries.ORACLES["op11_phrases"])
