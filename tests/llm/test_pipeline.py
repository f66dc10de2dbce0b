"""The pipeline against the plain versions of its stages, one after the other."""

import corpus_pipeline
import pytest
from test_decontaminate import brute as brute_items
from test_lines_licences import brute_lines
from test_simhash import brute as brute_groups
from test_simhash import brute_print
from test_tokens_packing_files import check_packing

from survista.llm import quality
from survista.llm.common import read
from survista.session import ensure_checkpoint_dir


def expected(spark, sf, docs):
    """Documents (id, source, text) that reach the packing stage. The classifier's scores are its own; the rest is plain."""
    good = {r.doc_id for r in quality.classify(docs, read(spark, sf, "labels")).filter("score >= 0.3").collect()}
    rows = [(r.doc_id, r.source, r.text) for r in docs.collect() if r.doc_id in good]
    rows = [(i, h, t) for i, h, t, *_ in brute_lines(rows, 0.01, 5)]
    groups = brute_groups([(i, brute_print(t)) for i, _, t in rows])
    rows = [r for r, (i, c) in zip(rows, groups, strict=True) if i == c]
    leaks = {x[0] for x in brute_items([(i, t) for i, _, t in rows], [(r.item_id, r.text) for r in read(spark, sf, "benchmark").collect()])}
    return [r for r in rows if r[0] not in leaks]


def test_run(spark, sf):
    want = expected(spark, sf, read(spark, sf, "documents"))
    assert 0 < len(want) < read(spark, sf, "documents").count()
    check_packing([(i, t) for i, _, t in want], corpus_pipeline.run(spark, sf).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset").collect(), 1024)


def test_stages_keep_the_columns_and_their_decisions(spark, sf, tmp_path):
    docs = read(spark, sf, "documents")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, sf).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == columns
        assert docs.count() == before if name == "line_dedup" else docs.count() < before, name
        before = docs.count()
        assert docs.filter("n_chars != length(text)").count() == 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "line_dedup", "simhash_dedup", "decontamination", "best_fit_packing"]


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_on_odd_tables(spark, sf, frame, name, stage):
    rows = [(None, None), (1, None), (1, None), (2, ""), (3, "Some text. " * 30), (3, "Some text. " * 30), (None, "x"), (9, "y " * 30_000)]
    extra = frame(rows).selectExpr("*", "doc_id AS id", "text AS line", "1 AS fp", "'q' AS component_id")
    got = stage(spark, extra, sf)
    assert got.count() >= 0 and (name == "best_fit_packing" or got.columns == extra.columns)
    assert stage(spark, frame([]), sf).count() == 0


def test_line_dedup_keeps_the_text_of_exact_copies(spark, sf, frame):
    prose = "One line of prose\nand another one"
    rows = [(i, prose, "s") for i in range(30)] + [(100 + i, f"Menu\nown words {i}", "s") for i in range(20)]
    got = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, frame(rows), sf).collect()}
    assert got == {i: t if t == prose else t.split("\n")[1] for i, t, _ in rows}


def test_checkpoint_folder_is_the_sessions(spark):
    path = ensure_checkpoint_dir(spark)
    assert path == spark.conf.get("spark.checkpoint.dir")
