"""Line dedup, language, near duplicates, document quality."""

import random

import brute
import numpy as np
import pyarrow as pa
import pytest
from plazaframe.llm import components, language, line_crf, lines, near, shingles
from pyspark.sql import functions as F

DRAW = random.Random(11)
WORDS = ["".join(DRAW.choice("abcdefghijklmnop") for _ in range(DRAW.randint(2, 8))) for _ in range(400)]


def sentence(n=12):
    return " ".join(DRAW.choice(WORDS) for _ in range(n))


# ---- lines


def test_cuts_do_not_depend_on_what_comes_before():
    passage = [sentence() for _ in range(60)]
    alone = lines.chunks("\n".join(passage))
    behind = lines.chunks("\n".join([sentence() for _ in range(7)] + passage))
    inner = {tuple(c) for c in alone[1:-1]}
    assert inner and inner <= {tuple(c) for c in behind}
    for text in ("", "one", "a\nb", "\n\n\n", "same\n" * 50):
        assert "\n".join("\n".join(c) for c in lines.chunks(text)) == text


def test_repeated_passages_stay_once(spark):
    passage = "\n".join(sentence() for _ in range(25))
    texts = {i: "\n".join([sentence(), *([passage] if i % 3 == 0 else [sentence() for _ in range(9)]), sentence()]) for i in range(30)}
    texts |= {30: None, 31: "", 32: "one line", 33: "one line", 34: "\n".join([passage, passage]), 35: texts[1], 36: "\n\n\n\n"}
    df = spark.createDataFrame([(i, t, "x", i) for i, t in texts.items()], "doc_id long, text string, lang string, id long").repartition(4)
    got = {r.id: r for r in lines.dedup_lines(df, carry=["lang"]).collect()}
    wanted = brute.without_repeats(sorted(texts.items()), lines.chunks)
    assert {i: r.text for i, r in got.items()} == wanted
    assert got[35].text == "\n".join("\n".join(c) for c in lines.chunks(texts[1]) if len(c) == 1)
    assert got[3].n_removed_lines > 0 and got[0].n_removed_lines == 0 and got[3].carried.lang == "x"


def test_short_passages_are_found_whole(spark):
    """Passages of 2 to 10 lines in otherwise different texts go from all but the first, and nothing else goes."""
    texts, wanted = {}, {}
    for n in range(2, 11):
        passage = [sentence() for _ in range(n)]
        for copy in range(4):
            own = [sentence() for _ in range(5)]
            i = len(texts)
            texts[i] = "\n".join(own[:copy] + passage + own[copy:])
            wanted[i] = texts[i] if copy == 0 else "\n".join(own)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    assert {r.id: r.text for r in lines.dedup_lines(df, whole=True).collect()} == wanted


def test_equal_hashes_of_different_bytes_stay(spark, monkeypatch):
    """With a hash that is the same for every passage, only equal bytes go."""
    texts = {0: "a\nb", 1: "c\nd", 2: "a\nb"}
    found = spark.createDataFrame([(b"h", i, 0, t) for i, t in texts.items()], "digest binary, id long, first long, passage string")
    assert [r.id for r in lines.same_bytes(found).collect()] == [2]


def test_lines_of_awkward_rows(spark, docs):
    got = lines.dedup_lines(docs, carry=["lang", "source", "score"])
    assert got.count() == docs.count()
    assert sorted((r.text for r in got.collect()), key=repr) == sorted((r.text for r in docs.collect()), key=repr)
    assert lines.dedup_lines(docs.where("false")).collect() == []


# ---- language


def test_languages_are_told_apart(spark):
    syllables = {lang: ["".join(DRAW.choice("abcdefghij") for _ in range(3)) for _ in range(25)] for lang in ("aa", "bb", "cc")}
    alphabets = syllables

    def text(lang, n):
        return " ".join("".join(DRAW.choice(syllables[lang]) for _ in range(DRAW.randint(1, 3))) for _ in range(n))

    rows = [(i, text(lang, DRAW.randint(5, 200)), lang) for i in range(300) for lang in [list(alphabets)[i % 3]]]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learned = language.dictionaries(df.where("doc_id % 4 <> 2"))
    assert [lang for lang, _ in learned] == sorted(alphabets) or len(learned) == 3
    told = {r.id: r for r in language.identify(df.where("doc_id % 4 = 2").drop("lang"), learned).collect()}
    assert np.mean([told[i].lang_pred == lang for i, _, lang in rows if i in told]) > 0.97
    assert all(0 <= r.score <= 1 for r in told.values())


def test_languages_of_held_out_documents(spark, sample_folder):
    docs = spark.read.parquet(f"{sample_folder.replace('0.001', '0.01')}/documents.parquet")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    learned = language.dictionaries(docs.where(~held_out))
    told = language.identify(docs.where(held_out), learned, carry=["lang"]).collect()
    assert np.mean([r.lang_pred == r.carried.lang for r in told]) > 0.95
    assert np.mean([r.rejected for r in told]) < 0.03


def test_languages_of_awkward_rows(spark, docs):
    learned = language.dictionaries(docs)
    got = {(r.id, r.text): r for r in language.identify(docs, learned, carry=["lang"]).collect()}
    assert {got[(1, None)].lang_pred, got[(2, "")].lang_pred, got[(3, " \n\t ")].lang_pred, got[(10, "1234567890 " * 30)].lang_pred} == {"und"}
    assert got[(1, None)].score == 0.0 and got[(1, None)].rejected
    assert got[(0, "The quick brown fox jumps over the lazy dog near the river bank today.")].lang_pred == "en"
    none = language.dictionaries(docs.where("false"))
    assert none == [] and {r.lang_pred for r in language.identify(docs, none).collect()} == {"und"}
    assert language.identify(docs.where("false"), learned).collect() == []


def test_ties_go_to_the_language_with_more_texts():
    classifier = language.Classifier([("zz", b"same words here"), ("aa", b"same words here")])
    assert classifier.classify("some words") == ("zz", 0.0, True)


# ---- near duplicates


def edited(text, edits):
    words = text.split()
    for _ in range(edits):
        words[DRAW.randrange(len(words))] = DRAW.choice(WORDS)
    return " ".join(words)


def test_classes_equal_all_pairs(spark):
    texts, n = {}, 0
    for _ in range(12):
        base = sentence(DRAW.randint(30, 120))
        for _ in range(DRAW.randint(1, 8)):
            texts[n], n = edited(base, DRAW.randint(0, 4)), n + 1
    shared = sentence(40)
    for _ in range(25):  # a common passage alone makes no link
        texts[n], n = f"{sentence(30)} {shared}", n + 1
    base = sentence(100)
    for _ in range(30):  # a chain of copies of copies
        texts[n], n = base, n + 1
        base = edited(base, 1)
    texts |= {n: "a b c", n + 1: "a  B c", n + 2: "a b d", n + 3: "one two three four five six"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    assert {r.id: r.class_id for r in near.near_duplicates(df).collect()} == brute.near_classes(texts)


def test_copies_much_longer_or_shorter_than_the_pivot(spark):
    """Members too unlike the pivot in length to be aligned with it are linked with its near copies all the same."""
    texts, n = {}, 0
    for _ in range(5):
        words = sentence(190).split()
        for size in (104, 104, 104, 106, 125, 128, 130, 130, 145, 84, 82, 72):
            texts[n], n = " ".join(words[:size]) + (" " + sentence(1) if size == 104 else ""), n + 1
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    assert {r.id: r.class_id for r in near.near_duplicates(df).collect()} == brute.near_classes(texts)


def test_a_pair_not_aligned_with_the_pivot_is_not_ruled_out(spark):
    """One shared sketch whose pivot has 100 runs, a copy of 102 and one of 126: the last two are similar as 102 / 126."""
    words = sentence(400).split()
    rows = [(0, " ".join(words[:104])), (1, " ".join(words[:106])), (2, " ".join(words[:130])), (3, " ".join(words[:104] + words[200:203]))]
    docs = spark.createDataFrame(rows, "id long, text string")
    # text 3 shares a sketch of its own with the pivot, which makes text 0 the pivot of the group of all
    shared = {0: [7, 8, 9], 1: [7], 2: [7], 3: [8, 9]}
    made = [(i, bytearray(near.text_key(t)), len(near.runs_of(t)), shared[i]) for i, t in rows]
    signatures = spark.createDataFrame(made, "id long, key binary, n long, sketches array<long>")
    found = {frozenset((bytes(r.a), bytes(r.b))) for r in near.links(docs, signatures).collect()}
    assert frozenset((near.text_key(rows[1][1]), near.text_key(rows[2][1]))) in found


def counted_alignments(spark, monkeypatch, texts):
    """The classes of texts (id -> text), and how many pairs were aligned for them."""
    aligned, plain = [], near._aligned

    def counting(pairs, *rest):
        aligned.append(pairs.count())
        return plain(pairs, *rest)

    monkeypatch.setattr(near, "_aligned", counting)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    return {r.id: r.class_id for r in near.near_duplicates(df).collect()}, sum(aligned)


def test_copies_just_below_the_threshold_are_not_aligned_pair_by_pair(spark, monkeypatch):
    """Copies of one text with so many edits each that most pairs are a little less similar than the threshold."""
    base, texts = sentence(150), {}
    for i in range(240):
        words = base.split()
        for at in DRAW.sample(range(150), 1 + i % 4):
            words[at] = f"w{i}x{at}"
        texts[i] = " ".join(words)
    got, aligned = counted_alignments(spark, monkeypatch, texts)
    assert got == brute.near_classes(texts)
    assert aligned < 8 * len(texts)


def test_copies_with_passages_in_another_order(spark):
    """The same runs in other orders: the likeliest text of a component is not similar, another one is."""
    parts, texts = [sentence(40) for _ in range(4)], {}
    for i, order in enumerate([(0, 1, 2, 3), (1, 0, 2, 3), (2, 3, 0, 1), (3, 2, 1, 0), (0, 2, 1, 3)] * 3):
        words = " ".join(parts[k] for k in order).split()
        for at in DRAW.sample(range(160), i // 5):
            words[at] = f"w{i}x{at}"
        texts[i] = " ".join(words)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    assert {r.id: r.class_id for r in near.near_duplicates(df).collect()} == brute.near_classes(texts)


def test_block_pairs_equal_all_pairs():
    rows = [{"key": bytes([i]), "root": bytes([i % 7]), "far": DRAW.uniform(-3, 9), "differs": DRAW.sample(range(20), DRAW.randint(0, 12)), "outside": i < 15} for i in range(40)]
    fields = [("key", pa.binary()), ("root", pa.binary()), ("far", pa.float64()), ("differs", pa.list_(pa.int64())), ("outside", pa.bool_())]
    block = pa.Table.from_pylist(rows, pa.schema(fields))
    wanted = set()
    for x in rows[:15]:
        for y in rows[15:]:
            spare = len(set(x["differs"]) & set(y["differs"])) - (x["far"] + y["far"]) / 2
            if x["root"] != y["root"] and spare >= 0:
                wanted.add((x["key"], y["key"], y["root"], round(spare, 6)))
    every = {(r["a"], r["b"], r["root"], round(r["margin"], 6)) for r in near._block_pairs(True)(block).to_pylist()}
    assert every == wanted and wanted
    best = [(r["a"], r["root"], round(r["margin"], 6)) for r in near._block_pairs(False)(block).to_pylist()]
    likeliest = {(a, root): max(m for x, _, z, m in wanted if (x, z) == (a, root)) for a, _, root, _ in wanted}
    assert sorted(best) == sorted((a, root, m) for (a, root), m in likeliest.items())


def test_short_texts_are_always_candidates():
    """Every pair of short texts at the threshold or above it shares a bucket, 4 against 5 runs among them."""
    for n in range(1, near.SHORT + 1):
        runs = near.runs_of(sentence(n + 4))
        for m in range(n, near.SHORT + 1):
            for _ in range(5):
                extra = DRAW.sample(range(1 << 60), m)
                c = -(-4 * (n + m) // 9)  # the fewest in common at similarity 0.8
                if c > n:
                    continue
                a, b = (np.concatenate((runs[:c], np.array(extra[: k - c], np.uint64) + np.uint64(at))) for k, at in ((n, 0), (m, 1 << 61)))
                assert np.isin(near.remainders(a), near.remainders(b)).any(), (n, m, c)
    assert len(near.remainders(near.runs_of(sentence(200)))) == 0


def test_short_copies_with_a_word_more(spark):
    texts = {}
    for n in range(1, 16):
        for _ in range(3):
            base = sentence(n)
            for text in (base, f"{base} {sentence(1)}", f"{sentence(1)} {base}"):
                texts[len(texts)] = text
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    wanted = brute.near_classes(texts)
    assert {r.id: r.class_id for r in near.near_duplicates(df).collect()} == wanted
    eight = [i for i, t in texts.items() if len(t.split()) == 8 and len(texts[i + 1].split()) == 9]
    assert eight and all(wanted[i] == wanted[i + 1] == wanted[i + 2] for i in eight)


def test_order_matters():
    a, b = sentence(60), sentence(60)
    one, other = near.runs_of(f"{a} {b}"), near.runs_of(f"{b} {a}")
    assert near.Aligner(one, 1.0).distance(other) > 0.5
    assert np.isin(one, other).mean() > 0.9


def test_alignment_equals_the_table():
    for _ in range(200):
        x = [DRAW.choice(WORDS[:30]) for _ in range(DRAW.randint(1, 60))]
        y = x[:]
        for _ in range(DRAW.randint(0, 20)):
            y[DRAW.randrange(len(y))] = DRAW.choice(WORDS[:30])
        del y[: DRAW.randint(0, 3)]
        a, b = " ".join(x), " ".join(y) or "z"
        p, q = brute.labelled_runs(a), brute.labelled_runs(b)
        common = brute.aligned(p, q)
        wanted = 1 - common / (len(p) + len(q) - common)
        got = near.Aligner(near.runs_of(a), 0.4).distance(near.runs_of(b))
        assert got == wanted if wanted <= 0.4 else got >= 0.4


def test_alignment_of_texts_exactly_at_the_threshold():
    """4 of 5 runs with the odd one at the beginning: the band is exactly one run wide."""
    runs = np.arange(1, 6, dtype=np.uint64)
    limit = 1 - near.SIMILARITY
    assert near.Aligner(runs, limit).distance(runs[1:]) <= limit


def test_near_duplicates_of_awkward_rows(spark, docs):
    got = sorted(((r.id, r.class_id) for r in near.near_duplicates(docs).collect()), key=repr)
    assert got == sorted(((r.doc_id, r.doc_id) for r in docs.collect()), key=repr)
    assert near.near_duplicates(docs.where("false")).collect() == []
    twins = spark.createDataFrame([(None, "the same text of six words"), (4, "The same text of six words")], "doc_id long, text string")
    assert {r.class_id for r in near.near_duplicates(twins).collect()} == {4}


def test_word_hashes_in_stretches(monkeypatch):
    text = " ".join(sentence(30) for _ in range(40)) + " é日本 " + "w" * 300
    whole = shingles.word_hashes(text)
    assert len(whole) == len(text.split())
    monkeypatch.setattr(shingles, "STRETCH", 200)
    assert (shingles.word_hashes(text)[:-1] == whole[:-1]).all()
    assert len(set(whole.tolist())) == len(set(text.lower().split()))


@pytest.mark.parametrize("seed", range(3))
def test_components_equal_union_find(spark, seed):
    draw = random.Random(seed)
    pairs = [(draw.randint(0, 300), draw.randint(0, 300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)]
    root = {x: x for p in pairs for x in p}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    got = components.components(spark.createDataFrame(pairs, "a long, b long"))
    assert {r.node: r.root for r in got.collect()} == {x: find(x) for x in linked}
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


# ---- quality


def test_marginals_equal_all_paths():
    draw = np.random.default_rng(4)
    for n in (1, 2, 5):
        gain, move = draw.normal(size=n), draw.normal(size=(2, 2))
        total, good = 0.0, np.zeros(n)
        for path in np.ndindex(*[2] * n):
            weight = np.exp(sum(gain[i] for i in range(n) if path[i]) + sum(move[a, b] for a, b in zip(path, path[1:], strict=False)))
            total += weight
            good += weight * np.array(path)
        assert np.allclose(line_crf.marginals(gain, move), good / total)


def test_slope_is_that_of_the_likelihood():
    draw = np.random.default_rng(5)
    examples = [(draw.normal(size=(n, 3 * line_crf.MEASURES)) / 3, label) for n, label in ((1, 0), (3, 1), (6, 0))]
    theta = draw.normal(size=3 * line_crf.MEASURES + 4) / 3

    def likelihood(t):
        out = 0.0
        for rows, label in examples:
            gain, move = rows @ t[:-4], t[-4:].reshape(2, 2)
            weights = [
                sum(gain[i] for i in range(len(rows)) if path[i]) + sum(move[a, b] for a, b in zip(path, path[1:], strict=False))
                for path in np.ndindex(*[2] * len(rows))
            ]
            own = gain.sum() * label + (len(rows) - 1) * move[label, label]
            out += own - np.log(np.exp(weights).sum())
        return out

    slope = line_crf._slope(theta, *line_crf._padded(examples))
    for i in [0, 7, 40, *range(len(theta) - 4, len(theta))]:
        step = np.zeros_like(theta)
        step[i] = 1e-5
        assert abs((likelihood(theta + step) - likelihood(theta - step)) / 2e-5 - slope[i]) < 1e-4


def test_quality_on_held_out_documents(spark, sample_folder):
    folder = sample_folder.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    weights, move = line_crf.learn(docs, labels.where(~held_out))
    scored = line_crf.score(docs, weights, move).join(labels.where(held_out), F.col("id") == F.col("doc_id")).collect()
    assert np.mean([(r.score >= 0.5) == bool(r.quality) for r in scored]) > 0.95


def test_quality_of_awkward_rows(spark, docs):
    labels = spark.createDataFrame([(0, 1), (6, 0), (8, 1), (8, 1), (None, 0), (5, None), (10, 0)], "doc_id long, quality int")
    weights, move = line_crf.learn(docs, labels)
    got = line_crf.score(docs, weights, move).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    weights, move = line_crf.learn(docs, labels.where("false"))
    assert {round(r.score, 9) for r in line_crf.score(docs, weights, move).collect()} == {0.5}
    assert line_crf.score(docs.where("false"), weights, move).collect() == []
