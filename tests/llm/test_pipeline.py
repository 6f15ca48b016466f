"""The registered queries and the pipeline on the sample tables."""

import sys

import brute
import oracle
import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from plazaframe.llm import lines
from plazaframe.llm.queries import documents
from plazaframe.llm.registered import ORACLES, QUERIES
from plazaframe.operators.durable import materialise


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_its_sql(spark, sample_folder, name):
    wanted = oracle.of_sql(oracle.connect(sample_folder), ORACLES[name])
    assert oracle.of_spark(entry_points.queries()[name](spark, sample_folder)) == wanted


def test_all_operators_and_the_pipeline_are_registered():
    names = list(entry_points.queries())
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(names)


def test_stages_one_by_one(spark, sample_folder):
    kept = {}
    docs = documents(spark, sample_folder)
    columns, all_ids = docs.columns, {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()} if name != "language" else None
        docs = materialise(stage(spark, docs, sample_folder))
        if name != "packing":
            assert docs.columns == columns
            rows = docs.collect()
            assert all(r.n_chars == len(r.text) for r in rows)
            kept[name] = {r.doc_id: r.text for r in rows}
        if name == "line_dedup":
            plain = brute.without_repeats(sorted(before.items()), lines.chunks)
            assert kept[name] == {i: t for i, t in plain.items() if t.strip() or t == before[i]}
        if name == "near_dedup":
            classes = brute.near_classes(before)
            assert kept[name] == {i: before[i] for i, c in classes.items() if i == c}
        if name == "personal_data":
            assert set(kept[name]) == set(before)
            for i, text in kept[name].items():
                if not any(brute.base_spans(before[i]).values()):
                    assert text == before[i]
                assert "@mail" not in text
    assert len(kept["language"]) > 0.95 * len(all_ids)
    assert {r.doc_id for r in docs.collect()} == set(kept["personal_data"])
    once = corpus_pipeline.run(spark, sample_folder)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, once.select(*key).collect())) == sorted(map(tuple, docs.select(*key).collect()))


def test_stages_of_awkward_and_no_rows(spark, docs, sample_folder):
    own = docs.select(*corpus_pipeline.COLUMNS)
    for rows in (own, own.where("false")):
        now = rows
        for _, stage in corpus_pipeline.STAGES:
            now = materialise(stage(spark, now, sample_folder))
        assert now.count() >= (1 if rows is own else 0)


def test_nothing_else_imports_this_package():
    import subprocess

    code = "import sys; sys.path.insert(0, '.'); import plazaframe.plans.registered; assert not [m for m in sys.modules if 'llm' in m.split('.')]"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=entry_points.__file__.rsplit("/", 1)[0])
