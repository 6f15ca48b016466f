"""Ranked search against scoring everything, pruning, and awkward rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import oracle
from plazaframe.llm import lexical, queries, registered  # noqa: F401

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def listed(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, k=10):
    counts = [(i, Counter(listed(text))) for i, text in docs]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    n_docs, n_terms = len(counts), sum(n for _, _, n in counts)
    df = Counter(term for _, c, _ in counts for term in c)
    out = []
    for item, text in items:
        found = []
        for i, c, n in counts:
            m = 100 - 90 + (90 * n * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(listed(text)))
            if score > 0:
                found.append((-score, i is None, i))
        for rank, (score, _, i) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1):
            out.append((item, rank, i, -score))
    return sorted(out, key=repr)


def corpus(n, seed=2):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(120)] + ["naïve", "日本語", "ß", "İx"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    texts = [draw.choice([" ", ", ", "\n"]).join(draw.choices(vocabulary, weights, k=draw.choice([1, 3, 10, 80, 400]))) for _ in range(n)]
    docs = list(enumerate(texts)) + [(n, None), (n + 1, ""), (n + 2, " .,! "), (None, texts[0]), (None, texts[1]), (3, texts[5]), (n + 3, "W0 w1-W2_w3 " * 2000)]
    docs += [(n + 10 + i, texts[7]) for i in range(40)]  # ties
    items = [(i, " ".join(draw.choices(vocabulary, k=draw.choice([1, 4, 30])))) for i in range(25)]
    items += [(100, None), (101, ""), (102, "nothing like it"), (103, texts[7]), (3, items[3][1]), (None, "w0 w5 W5 W119")]
    return docs, items


def searched(spark, docs, items, **options):
    docs = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    return sorted(map(tuple, lexical.search(docs, spark.createDataFrame(items, "item_id long, text string"), **options).collect()), key=repr)


def test_equals_scoring_everything(spark, monkeypatch):
    docs, items = corpus(700)
    wanted = plain(docs, items)
    assert searched(spark, docs, items) == wanted
    assert searched(spark, docs, items, query_terms=60) == wanted  # in several blocks
    assert searched(spark, docs, items, k=3) == plain(docs, items, 3)
    monkeypatch.setattr(lexical, "BUCKET", 16)
    monkeypatch.setattr(lexical, "SMALL", 4)
    monkeypatch.setattr(lexical, "FOCUS", 2)
    assert searched(spark, docs, items) == wanted


def test_buckets_are_pruned_by_norm_and_by_coordinates(monkeypatch):
    impact = np.array([900, 800, 10, 20, 15], np.int64)
    bucket = lexical.Bucket(np.array([900.0, 800.0, np.sqrt(725)]), np.array([0, 1, 0, 1, 2]), impact, np.array([1, 1, 3]))
    query = lexical.Query(1, np.array([0, 2]), np.array([5, 3]), math.sqrt(34))
    rows, scores = bucket.search(query)
    assert rows.tolist() == [0, 2] and scores.tolist() == [4500, 95]
    query.bar = 4500
    assert bucket.search(query)[0].tolist() == [0]
    query.bar = 4501  # the largest norm would allow for it, the largest impacts do not
    assert not len(bucket.search(query)[0])
    query.bar = 6000  # beyond the norms
    monkeypatch.setattr(bucket, "lists", None)
    assert not len(bucket.search(query)[0])


def test_awkward_tables(spark, docs):
    items = spark.createDataFrame([(1, "the word text"), (2, "example com 日本語のテキスト")], "item_id long, text string")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    clashing = docs.selectExpr("doc_id", "text", "1 AS norm", "2 AS n", "3 AS places", "4 AS rank", "5 AS item")
    assert sorted(map(tuple, lexical.search(clashing, items).collect()), key=repr) == plain(rows, [tuple(r) for r in items.collect()])
    assert lexical.search(docs.where("doc_id < 0"), items).collect() == []
    assert lexical.search(docs, items.where("item_id < 0")).collect() == []


def test_registered_query(spark, sample_folder):
    found = queries.QUERIES["op13_ranked_search"](spark, sample_folder)
    assert found.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert oracle.of_spark(found) == oracle.of_sql(oracle.connect(sample_folder), queries.ORACLES["op13_ranked_search"])
