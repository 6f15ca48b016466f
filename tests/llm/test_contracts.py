"""Each registered query of the first ten operators, called by itself and held against its contract."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import brute
import pytest
from plazaframe.llm import queries, registered, token_files  # noqa: F401
from plazaframe.llm.word_ids import WordEncoder


@pytest.fixture(scope="module")
def texts(spark, sample_folder):
    rows = spark.read.parquet(f"{sample_folder}/documents.parquet").select("doc_id", "text", "lang").collect()
    return {r["doc_id"]: r for r in rows}


@pytest.fixture(scope="module")
def asked(spark, sample_folder):
    return lambda name: queries.QUERIES[name](spark, sample_folder)


@pytest.fixture(scope="module")
def ids(texts, model):
    encoder = WordEncoder(model("word_bpe_49k.json"), 1)
    ordered = sorted(texts)
    return dict(zip(ordered, brute.token_rows(encoder.tokenizer, [texts[i]["text"] for i in ordered]), strict=True))


def kinds(df):
    return dict(df.dtypes)


def test_line_dedup(asked, texts):
    found = asked("op1_line_dedup")
    assert {"doc_id", "text", "n_lines", "n_removed_lines"} <= set(found.columns)
    rows = {r["doc_id"]: r for r in found.collect()}
    assert set(rows) == set(texts)
    for i, r in rows.items():
        assert set(r["text"].split("\n")) <= set((texts[i]["text"] or "").split("\n")) | {""}


def test_quality(asked, texts):
    found = asked("op2_quality_classifier")
    assert {c: kinds(found)[c] for c in ("doc_id", "held_out", "score", "predicted")} == {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}
    rows = found.collect()
    assert {r["doc_id"] for r in rows} == set(texts)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)


def test_sentencepiece(asked, texts):
    assert {r["doc_id"] for r in asked("op3_sentencepiece").collect()} == set(texts)


def test_packing(asked, ids):
    rows = asked("op4_best_fit_packing").collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(by_doc) == set(ids)
    for i, pieces in by_doc.items():
        whole, pieces = ids[i], sorted(pieces, key=lambda r: r["piece"])
        assert [(r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in pieces] == [
            (n, at // 4, len(whole[at : at + 4 * 4096]) // 4, zlib.crc32(whole[at : at + 4 * 4096])) for n, at in enumerate(range(0, len(whole), 4 * 4096))
        ]
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 4096


def test_quality_rules(asked, texts):
    for r in asked("op5_quality_rules").collect():
        text = texts[r["doc_id"]]["text"] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
        windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
        inside = {i + j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(8)}
        assert (r["n_words"], r["word_chars"], r["n_symbols"]) == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)))
        assert (r["n_dup_lines"], r["n_repeat_words"]) == (len(lines) - len(set(lines)), len(inside))
        assert r["base_failed"] == (len(words) < 20 or 100 * len(inside) > 30 * len(words)) and not (r["base_failed"] and r["kept"])


def test_language(asked, texts):
    rows = asked("op6_language_id").collect()
    known = {r["lang"] for r in texts.values() if r["lang"]}
    assert {r["doc_id"] for r in rows} == set(texts)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1
        lettered = any(c.isalpha() for c in texts[r["doc_id"]]["text"] or "")
        assert r["lang_pred"] in known if lettered else r["lang_pred"] == "und"


def test_token_files(asked, ids):
    start = 0
    for r in sorted(asked("op8_token_files").collect(), key=lambda r: r["doc_id"]):
        whole = ids[r["doc_id"]]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(whole) // 4, zlib.crc32(whole))
        start += len(whole) // 4


def test_token_files_are_read_by_several_tasks(spark, model):
    docs = spark.range(400).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so that small files are several
    try:
        folder = token_files.local_folder(spark)
        manifest = token_files.write_token_files(docs, model("word_bpe_49k.json"), folder)
        files = manifest.count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    read = token_files.read_token_files(manifest, folder)
    assert files > 3 and read.rdd.getNumPartitions() == files and read.count() == 400


def test_personal_data(asked, texts):
    found = asked("op9_personal_data")
    assert {c: kinds(found)[c] for c in ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")} == {**dict.fromkeys(("n_email", "n_ip", "n_card", "n_phone"), "bigint"), "base_sha256": "string", "spans": "string"}
    order = ["email", "ip", "card", "phone"]
    for r in found.collect():
        spans = [s.split(":") for s in r["spans"].split(",")] if r["spans"] else []
        base = sorted((order.index(k), int(a), int(b)) for k, a, b in spans if k in order)
        assert [sum(1 for k, _, _ in base if k == i) for i in range(4)] == [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]]
        text = ",".join(f"{order[k]}:{a}:{b}" for k, a, b in base)
        assert hashlib.sha256(text.encode()).hexdigest() == r["base_sha256"]


def test_near_duplicates(asked, texts):
    classes = {r["doc_id"]: r["class_id"] for r in asked("op10_order_minhash").collect()}
    assert set(classes) == set(texts)
    same = defaultdict(set)
    for i, c in classes.items():
        assert classes[c] == c <= i
        words = " ".join((texts[i]["text"] or "").lower().split())
        if words:
            same[words].add(c)
    assert all(len(found) == 1 for found in same.values())
