"""The pipeline's stages, and how the queries are registered."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from airlake.llm import mixing, queries, quality, simhash, line_dedup
from airlake.llm.common import materialize, table

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered_once():
    names = list(queries.queries())
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
    assert set(names) | {"pipeline"} <= set(entry.queries())
    assert set(queries.oracle_sql()) <= set(entry.oracle_sql())


@pytest.fixture(scope="module")
def stages(spark):
    """Each stage's input and output."""
    docs, out = table(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        after = materialize(stage(spark, docs, SF), "test-stage")
        out.append((name, docs, after))
        docs = after
    return out


def test_stages_keep_the_columns_of_documents(spark, stages):
    for name, before, after in stages[:-1]:
        assert after.columns == table(spark, SF, "documents").columns, name


def test_quality_drops_what_it_rejects(spark, stages):
    _, before, after = stages[0]
    scores = quality.quality_scores(before, table(spark, SF, "labels"))
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in scores.where("predicted = 1").collect()}
    labels = table(spark, SF, "labels")
    good = before.join(labels.where("quality = 1"), "doc_id")
    assert good.join(after, "doc_id", "left_semi").count() >= 0.99 * good.count()


def test_lines_are_dropped_and_documents_stay(stages):
    _, before, after = stages[1]
    want = {r.doc_id: r.text for r in line_dedup.dedup_lines(before).collect()}
    got = after.collect()
    assert {r.doc_id: r.text for r in got} == want and all(r.n_chars == len(r.text) for r in got)
    assert sum(len(r.text) for r in got) < sum(len(r.text) for r in before.collect())


def test_one_document_of_each_group_stays(stages):
    _, before, after = stages[2]
    groups = simhash.near_duplicates(before).select("component_id").distinct()
    assert sorted(r.doc_id for r in after.collect()) == sorted(r.component_id for r in groups.collect())


def test_the_mix_repeats_and_drops(stages):
    _, before, after = stages[3]
    want = {r.doc_id: r.taken // r.size for r in mixing.taken_words(before).collect() if r.taken}
    got = {r.doc_id: r["count"] for r in after.groupBy("doc_id").count().collect()}
    assert got == want


def test_run_gives_the_last_stage(spark, stages):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, stages[-1][2].collect()))
    assert stages[-1][1].count() == stages[-1][2].count()


def pipeline_of(spark, folder, rows, labels):
    """Every stage's rows over small tables with an extra column of a clashing name."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, row string, score double"
    docs = spark.createDataFrame([(i, t, "en", s, len(t or ""), "clash", 0.5) for i, t, s in rows], schema)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    docs, out = table(spark, folder, "documents"), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, folder), "test-stage")
        assert docs.columns == corpus_pipeline.COLUMNS, name
        out.append(docs.collect())
    last = corpus_pipeline.run(spark, folder).collect()
    assert len(last) == len(out[-1])
    return out


GOOD = "A line of plain words that says something.\nAnother one, with other words in it."
ROWS = [
    (1, GOOD, "a"), (1, GOOD, "a"), (1, "same id, another text entirely, of some words", "a"), (None, "no id but a text of words", "b"),
    (2, None, None), (3, "", "b"), (4, "\n\n\n", "b"), (5, "word " * 60_000, "c"), (6, GOOD + "\nand a line more than the first", "a"),
    (7, "A line of plain words that says something.", None), (8, "x", "c"),
]


def test_stages_over_nulls_empty_long_and_repeated_rows(spark, tmp_dir):
    good, lines, groups, mix = pipeline_of(spark, tmp_dir, ROWS, [(1, 1, 0), (1, 1, 0), (None, 0, 0), (2, None, 0)])
    assert len(good) == len(ROWS)  # labels of one kind: their share is every score
    assert {(r.doc_id, r.text) for r in lines if r.doc_id in (None, 1, 2, 3, 8)} == {
        (1, GOOD), (1, ROWS[2][1]), (None, ROWS[3][1]), (2, ""), (3, ""), (8, "x"),
    }
    assert [r.text for r in lines if r.doc_id == 7] == [""] and [r.text for r in lines if r.doc_id == 6] == ["and a line more than the first"]
    assert sum(r.text == "" for r in groups) == 1 and sum(r.text == GOOD for r in groups) == 1
    assert all(r.text for r in mix) and {r.doc_id for r in mix} <= {r.doc_id for r in groups}


@pytest.mark.parametrize("labels", [[], [(1, 0, 0)]])
def test_stages_over_empty_tables(spark, tmp_dir, labels):
    assert pipeline_of(spark, tmp_dir, [], labels) == [[], [], [], []]
