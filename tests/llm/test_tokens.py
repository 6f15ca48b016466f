"""Token ids, files and packing."""

import os
import random
import zlib

import brute
import numpy as np
import pytest
from plazaframe.llm import packing, pieces, token_files
from plazaframe.llm.word_ids import WordEncoder

ALPHABET = ["a", "B", "É", "'s", "it's", "don't", "ß", "İ", "Σ", ".", "!!", "<|endoftext|>", "1", "½", "é", "́", "日本", "😀", "\t", "\x0b", "\x1c", " ", " ", "\n", "_", "'LL"]


def test_word_by_word_equals_the_library(model):
    encoder = WordEncoder(model("word_bpe_49k.json"), 1)
    draw = random.Random(5)
    texts = ["".join(draw.choice(ALPHABET) for _ in range(draw.randint(0, 30))) for _ in range(1500)] + ["", None, "x" * 5000, "a b\n" * 2000]
    assert list(encoder.encode_all(texts)) == brute.token_rows(encoder.tokenizer, texts)


def test_common_latin_texts_by_pieces_equal_the_library(model):
    encoder = WordEncoder(model("word_bpe_49k.json"), 1)
    draw = random.Random(9)
    common = [chr(c) for c in range(128)] * 3 + list("ÀÉÖØßéöøÿĀąĲĳŊŋŠžıĸ«»¿¡–—‘’“”„…€£°•") + ["don't", "I'LL", "x're", "'s", "''s", "A1b2", "Straße", "...", " ", " ", "\r\n"]
    texts = ["".join(draw.choice(common) for _ in range(draw.randint(0, 40))) for _ in range(3000)]
    assert sum(encoder._split(text) is not None for text in texts) > 2900
    assert list(encoder.encode_all(texts)) == brute.token_rows(encoder.tokenizer, texts)


def test_giant_texts_in_stretches(model, monkeypatch):
    monkeypatch.setattr("plazaframe.llm.word_ids.STRETCH", 50)
    monkeypatch.setattr("plazaframe.llm.word_ids.REMEMBERED", 20)
    encoder = WordEncoder(model("word_bpe_49k.json"), 1)
    texts = [" ".join(f"word{i}, and" for i in range(100)), "y" * 300, "short", "  two  spaces  " * 30]
    assert list(encoder.encode_all(texts)) == brute.token_rows(encoder.tokenizer, texts)


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_piece_once_and_tightly(seed):
    draw = random.Random(seed)
    lengths = [draw.randint(1, 4096) if draw.random() < 0.4 else draw.randint(1, 900) for _ in range(3000)] + [4096] * 5 + [1] * 7
    counts = {n: lengths.count(n) for n in set(lengths)}
    plan = packing.best_two_fit(counts)
    length = np.array([n for n, c in counts.items() for _ in range(c)])
    number = np.array([i for c in counts.values() for i in range(c)])
    sequence, offset = plan.place(length, number)
    at = sorted(zip(sequence.tolist(), offset.tolist(), length.tolist(), strict=True))
    ends = {}
    for s, o, n in at:
        assert o == ends.get(s, 0)
        ends[s] = o + n
    assert max(ends.values()) <= 4096 and set(ends) == set(range(plan.sequences))
    assert plan.sequences <= -(-sum(lengths) // 4096) * 1.02 + 1


def test_the_smallest_gives_way_to_two_that_fit_tighter():
    plan = packing.best_two_fit({60: 1, 30: 1, 20: 2, 19: 0}, capacity=100)
    assert plan.sequences == 2
    filled = packing._fill(np.bincount([70, 20, 15, 15], minlength=101), 100)
    assert filled == {70: 1, 15: 2}  # 70 + 20 leaves 10, and 15 + 15 in place of 20 leaves none


def test_no_pieces_no_plan():
    assert packing.best_two_fit({}).sequences == 0


def test_packing_of_documents(spark, docs, model):
    encoder = WordEncoder(model("word_bpe_49k.json"), 1)
    got = packing.pack_documents(docs, model("word_bpe_49k.json"), capacity=512).collect()
    wanted = []
    for row in docs.collect():
        ids = brute.token_rows(encoder.tokenizer, [row.text])[0]
        wanted += [(row.doc_id, i, 512 * i, len(ids[a : a + 2048]) // 4, zlib.crc32(ids[a : a + 2048])) for i, a in enumerate(range(0, len(ids), 2048))]
    assert sorted([tuple(r)[:5] for r in got], key=repr) == sorted(wanted, key=repr)
    ends = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 512
    assert packing.pack_documents(docs.where("false"), model("word_bpe_49k.json")).collect() == []


def test_token_files_round_trip(spark, docs, model):
    encoder = WordEncoder(model("word_bpe_49k.json"), 1)
    folder = token_files.local_folder(spark)
    manifest = token_files.write_token_files(docs, model("word_bpe_49k.json"), folder)
    got = token_files.read_token_files(manifest, folder).collect()
    rows = docs.collect()
    ids = brute.token_rows(encoder.tokenizer, [r.text for r in rows])
    wanted = sorted(((r.doc_id, len(x) // 4, zlib.crc32(x)) for r, x in zip(rows, ids, strict=True)), key=repr)
    assert sorted(((r.id, r.n_tokens, r.ids_crc32) for r in got), key=repr) == wanted
    in_order = sorted(got, key=lambda r: r.start)
    assert [r.id for r in in_order] == sorted((r.doc_id for r in rows), key=lambda x: (x is not None, x))
    assert [r.start for r in in_order] == np.cumsum([0] + [r.n_tokens for r in in_order])[:-1].tolist()
    sizes = sum(os.path.getsize(f"{folder}/{name}") for name in os.listdir(folder) if name.endswith(".bin"))
    assert sizes == 2 * sum(r.n_tokens for r in got)
    nothing = token_files.local_folder(spark)
    none = token_files.write_token_files(docs.where("false"), model("word_bpe_49k.json"), nothing)
    assert token_files.read_token_files(none, nothing).collect() == []


PARTS = ["a", "b", "the", "ing", " ", "  ", "\n", "é", "日", "x", "tion", "re", "1", "▁", "st", "😀", "==", "    ", "https", "://", " and"]


@pytest.mark.parametrize("size", [34, 50, 100])
def test_chunks_joined_by_the_scan_equal_the_library(model, size):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=model("piece_bpe_32k.model"))
    own = pieces.vocabulary(model("piece_bpe_32k.model"))
    draw = random.Random(size)
    for _ in range(250):
        some = draw.sample(PARTS, draw.randint(1, 10))
        text = "".join(draw.choice(some) for _ in range(draw.randint(1, 150)))
        prepared = own.prepare(text)
        chunks = [pieces.Chunk(own, t, b, e, n == 0, (n + 1) * size >= len(prepared)) for n, t, b, e in pieces.cut(prepared, size, own.longest)]
        states = pieces.boundary_states([c.matrix() for c in chunks])
        ids = b"".join(c.encode(a, b) for c, a, b in zip(chunks, states, states[1:], strict=False))
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text)
        assert own.decode(ids)[1:] == text.replace("▁", " ")


def test_the_product_is_associative():
    draw = random.Random(2)
    states = [(-1, 0), (-2, 0), (-1, 1)]
    make = lambda: {a: {b: float(draw.randint(-9, 0)) for b in states if draw.random() < 0.8} for a in states}
    for _ in range(50):
        a, b, c = make(), make(), make()
        assert pieces.product(pieces.product(a, b), c) == pieces.product(a, pieces.product(b, c))


@pytest.mark.parametrize("chunk", [64, 1000, pieces.CHUNK])
def test_sentencepiece_of_documents(spark, docs, model, chunk):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=model("piece_bpe_32k.model"))
    few = docs.where("doc_id IS NULL OR doc_id <> 11 OR text IS NULL") if chunk == 64 else docs
    got = pieces.summary(pieces.encode(few, model("piece_bpe_32k.model"), chunk=chunk)).collect()
    wanted = []
    for row in few.collect():
        ids = library.encode(row.text or "")
        wanted.append((row.doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert sorted(((r.id, r.n_tokens, r.ids_crc32) for r in got), key=repr) == sorted(wanted, key=repr)
    assert all(r.round_trip for r in got)
    assert pieces.summary(pieces.encode(few.where("false"), model("piece_bpe_32k.model"))).collect() == []
