"""The operators made of DataFrame expressions: quality rules and personal data."""

import random

import brute
import pytest
from plazaframe.llm import arrays, personal, quality_rules
from pyspark.sql import functions as F

SLOW_NODES = ["EvalPython", "InPandas", "InArrow", "CartesianProduct", "BroadcastNestedLoopJoin"]


def texts(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "doc_id long, text string").repartition(4)


def no_python(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return not [node for node in SLOW_NODES if node in plan]


# ---- rules


def wordy(draw):
    some = draw.sample(["a", "b", "c", "dd", "e#", "x|y", "ß", "😀", "f", "g", "h"], draw.randint(1, 11))
    blank = [" ", "  ", "\n", "\t", "\x0b", "\x0c", "\r", " ", "\x1c", " "]
    return "".join(draw.choice(some) + draw.choice(blank[: draw.randint(1, 10)]) for _ in range(draw.randint(0, 60)))


def test_counts_equal_the_plain_ones(spark):
    draw = random.Random(9)
    values = [wordy(draw) for _ in range(300)] + [None, "", " ", "\n", "w " * 7, "w " * 8, "w " * 9, "a b c d e f g h i " * 3, "line\nline\n \nline", "# * $"]
    got = quality_rules.judge(texts(spark, values))
    assert no_python(got)
    for row in got.collect():
        counts = brute.rule_counts(values[row.doc_id])
        assert tuple(row)[1:6] == counts, values[row.doc_id]
        assert row.base_failed == (counts[0] < 20 or 100 * counts[4] > 30 * counts[0])
        assert not (row.base_failed and row.kept)


def test_every_order_of_the_rules_gives_one_verdict(spark):
    values = ["word " * 30, "UPPER CASE SHOUTED " * 1 + "ALL OF IT " * 9, "a#b " * 25, "fine text with words that differ " + " ".join(f"word{chr(97 + i)}" for i in range(25)), None]
    measured = quality_rules.measures(texts(spark, values))
    rules = quality_rules.rules()
    orders = [list(rules), list(rules)[::-1], sorted(rules)]
    told = [sorted(tuple(r) for r in measured.select("doc_id", quality_rules.rejected(rules, order)).collect()) for order in orders]
    assert told[0] == told[1] == told[2]


def test_order_is_by_rejections_per_second(spark):
    measured = texts(spark, ["x"] * 50).select("doc_id", "text")
    slow = F.length(F.repeat("text", 300_000)) > 400_000
    order = quality_rules.cascade_order(measured, {"never": F.col("doc_id") < 0, "always": F.col("doc_id") >= 0, "half": F.col("doc_id") % 2 == 0, "never_slow": slow})
    assert order.index("always") < order.index("never") and order.index("half") < order.index("never_slow")


def test_rules_of_awkward_rows(spark, docs):
    got = quality_rules.judge(docs)
    assert got.count() == docs.count()
    assert sorted((r.doc_id for r in got.collect()), key=repr) == sorted((r.doc_id for r in docs.collect()), key=repr)
    assert quality_rules.judge(docs.where("false")).collect() == []


# ---- personal data

TRICKY = [
    "a@b.c@d.e x_y@z.co", "a@b.c_d@e.f", "@@a@b..c", "a@b.c.", "..a@b-.c-", "mail: joe.doe+x%y_z@sub.host-name.example.com!", "é@b.c",
    "1.2.3.4.5.6.7.8.9", "256.1.1.1 1.1.1.256 001.002.003.004 0255.1.1.1", "1.2.3", "9999999999999999999999.1.1.1",
    "4539 1488 0343 6467", "4539-1488-0343-6467 4539 1488 0343 6468", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "4539  1488 0343 6467", "0000000000000000000",
    "45391488034364674", "+1 (587) 555-8467", "+1", "+12", "+1234567", "+12345678", "+1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "++1 234 567 89", "+49(0)30.123456-",
    "x\x01y@b.c a@b\x01c.d 4539\x011488\x010343\x016467", "\x02@a.b", "tab\t+1\t2345678", "😀 a@b.c 😀 1.2.3.4", None, "", " ", "a@b.c" * 50, "1." * 5000 + "1",
    "1 " * 20000, "a." * 20000 + "@x.y", "q@" + "x." * 20000 + "y", "7" * 60000, "+" + "1 " * 20000,
]


def test_base_spans_equal_the_plain_ones(spark):
    draw = random.Random(3)
    alphabet = list("aZ09@@..-_%+ +()12345\n\x01x ") + ["4539 1488 0343 6467", "10.0.0.1", "é"]
    values = TRICKY + ["".join(draw.choice(alphabet) for _ in range(draw.randint(0, 60))) for _ in range(1500)]
    found = personal.find_personal(texts(spark, values))
    got = personal.digest(found)
    assert no_python(got)
    for row in got.collect():
        assert (row.n_email, row.n_ip, row.n_card, row.n_phone, row.base_sha256) == brute.base_digest(values[row.doc_id]), repr(values[row.doc_id])[:300]


def disclosing(spark):
    """'zorblax' stands only with one address, 'hello' everywhere, 'once' in copies of one line."""
    values = [f"hello line number {chr(97 + i % 26)}x{i}" for i in range(300)]
    values += [f"hello zorblax wrote v{i}w to joe@example.com again" for i in range(5)]
    values += ["hello once seen near sue@example.com"] * 6
    values += [f"hello other o{i}o mail p{i}@example.com" for i in range(8)]
    return values


def test_terms_that_disclose_an_entity(spark):
    values = disclosing(spark)
    rows = personal.digest(personal.find_personal(texts(spark, values))).collect()
    for row in rows:
        text = values[row.doc_id]
        terms = [text[int(a) : int(b)] for kind, a, b in (s.split(":") for s in row.spans.split(",") if s) if kind == "term"]
        assert set(terms) <= {"zorblax", "wrote", "v", "w", "to", "again"}
        assert ("zorblax" in terms) == ("zorblax" in text)
        assert "hello" not in terms and "once" not in terms


def test_texts_without_what_was_found(spark):
    values = [*disclosing(spark), "call +1 (587) 555-8467 or 10.0.0.1, joe@a.b\nnext", None, "nothing here", "10.0.0.1"]
    found = personal.find_personal(texts(spark, values))
    got = dict(found.select("doc_id", personal.sanitised(found)).collect())
    assert got[len(values) - 4] == "call <PHONE> or <IP>, <EMAIL>\nnext"
    assert got[len(values) - 3] == "" and got[len(values) - 2] == "nothing here" and got[len(values) - 1] == "<IP>"
    assert got[300].startswith("hello <TERM> ") and "<EMAIL>" in got[300] and "zorblax" not in got[300]


def test_overlapping_spans_are_all_covered(spark):
    values = ["x +4539 1488 0343 6467 1.2.3.4@a.b y"]
    spans = [s for found in brute.base_spans(values[0]).values() for s in found]
    found = personal.find_personal(texts(spark, values))
    text = found.select(personal.sanitised(found)).first()[0]
    assert text.startswith("x ") and text.endswith(" y") and not any(values[0][a:b] in text for a, b in spans)


def test_personal_data_of_awkward_rows(spark, docs):
    got = {(r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone) for r in personal.digest(personal.find_personal(docs)).collect()}
    assert (5, 1, 1, 1, 1) in got and (None, 0, 0, 0, 0) in got and (1, 0, 0, 0, 0) in got
    assert personal.find_personal(docs).count() == docs.count()
    assert personal.digest(personal.find_personal(docs.where("false"))).collect() == []


@pytest.mark.parametrize("values", [[], [5], [1, 2, 3], list(range(100)), [7] * 33])
def test_prefix_sums(spark, values):
    df = spark.createDataFrame([(values,)], "x array<int>")
    wanted = [sum(values[: i + 1]) for i in range(len(values))]
    assert df.select(arrays.prefix_sums(F.col("x"))).first()[0] == wanted
