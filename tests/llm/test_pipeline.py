"""The pipeline's stages on small tables, each against its definition."""

import os

import pytest

import corpus_pipeline
from leadlift.llm import near
from leadlift.llm.common import drop_scratch, scratch, scratch_root
from tests.llm.test_near_and_scoring import brute_classes
from tests.llm.test_row_operators import check_packing

SF = "/root/testdata/sf0.001"


@pytest.fixture
def folder(spark, tmp_path, words):
    items = spark.createDataFrame([(1, words(77, 30))], "item_id long, text string")
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


def test_stage_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontamination", "packing"]


def test_stages_in_turn(spark, documents, words, folder):
    french = ("le", "que", "eau", "ier", "ment", "ré")
    clean = [(i, words(i, 60), "en") for i in range(1, 40)] + [(50 + i, words(500 + i, 60, french), "fr") for i in range(20)]
    run = f"{words(601, 12)}\n{words(602, 12)}"
    rows = clean + [
        (200, "1234 5678 ### $$$", "en"),
        (201, None, "en"),
        (202, "", None),
        (203, f"{words(603, 40)}\n{run}\n{words(604, 40)}", "en"),
        (204, f"{words(605, 40)}\n{run}\n{words(606, 40)}", "en"),
        (205, run, "en"),
        (210, words(1, 60) + " tail", "en"),
        (211, f"{words(607, 30)} {words(77, 30)} {words(608, 30)}", "en"),
        (None, words(609, 60), "en"),
    ]
    docs, columns = documents(rows), corpus_pipeline.COLUMNS
    stages = dict(corpus_pipeline.STAGES)

    def step(name, docs):
        return scratch(stages[name](spark, docs, folder), name)

    one = step("language_id", docs)
    assert one.columns == columns
    ids = lambda df: {r.doc_id for r in df.collect()}
    assert ids(one) == {r[0] for r in rows} - {200, 201, 202}
    two = step("line_dedup", one)
    got = {r.doc_id: r for r in two.collect()}
    assert two.columns == columns and set(got) == ids(one) - {205}
    assert got[203].text == rows[-6][1]
    assert got[204].text == f"{words(605, 40)}\n{words(606, 40)}" and got[204].n_chars == len(got[204].text)
    assert got[1].n_chars == len(words(1, 60)) and two.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    three = step("near_dedup", two)
    want = brute_classes([(i, r.text) for i, r in got.items() if i is not None], 5)
    assert ids(three) == {i for i, (_, c) in want.items() if i == c} | {None}
    assert 210 not in ids(three)
    four = step("decontamination", three)
    assert four.columns == columns and ids(four) == ids(three) - {211}
    five = step("packing", four)
    check_packing(five.collect(), [(r.doc_id, r.text) for r in four.collect()], 4096)


def test_stages_bear_empty_and_odd_tables(spark, documents, odd, folder):
    for rows in ([], [(i, t, None) for i, t in odd]):
        docs = documents(rows)
        for name, stage in corpus_pipeline.STAGES:
            docs = scratch(stage(spark, docs, folder), name)
        assert {f.name for f in docs.schema.fields} >= {"doc_id", "sequence_id"}


@pytest.mark.skipif(not os.path.isdir(SF), reason="no fixture tables")
def test_run_over_the_fixture_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = corpus_pipeline.run(spark, SF).collect()
    kept = {r.doc_id for r in got}
    assert kept and kept < {r.doc_id for r in docs.select("doc_id").collect()}
    gone = {r.doc_id for r in near.classes(docs).filter("kept = false").collect()}
    assert len(kept & gone) <= len(gone)


def test_scratch_needs_a_shared_folder_and_can_be_dropped(spark):
    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf = Conf()

    with pytest.raises(RuntimeError):
        scratch_root(Session())
    kept = scratch(spark.range(3), "dropped")
    assert kept.count() == 3 and all("/leadlift-llm-" in f for f in kept.inputFiles())
    drop_scratch(spark)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    assert not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
