"""Every operator on missing, empty and very long texts, repeated rows, empty tables and clashing columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from logwarden.llm import (
    decontaminate, exact_dedup, html_extract, lm_score, near_dedup, quality, secret_scan, sentencepiece_codec,
    sharding, toxicity)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
EXTRA = "salt int, digest string, shard int, bucket int, cluster int, rep int, label int, band int, host string, label_2 int"
LONG = "word stupid " * 12_000


def texts():
    base = [
        (1, "plain words of an ordinary sentence with enough length to matter"), (2, None), (3, ""), (4, " \t\n"),
        (5, "plain words of an ordinary sentence with enough length to matter"), (6, LONG), (7, "x" * 150_000),
        (8, "you are a stupid idiot and a stupid fool"), (8, "you are a stupid idiot and a stupid fool"),
        (None, "a row without any id"), (None, None), (9, "é▁😀   ‎"),
    ]
    return [(i, t, "en", "s", len(t or ""), 1, "d", 2, 3, 4, 5, 6, 7, "h", 8) for i, t in base]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(texts(), f"{DOCS}, {EXTRA}")


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, i % 2, 1 - i % 2, 0) for i in range(1, 9)] + [(None, 1, 1, 0), (7, 1, None, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, None), (2, "short"), (None, "x" * 90), (3, "x" * 90)], "item_id long, text string")


OPERATORS = {
    "quality": (lambda d, l, b: quality.score_quality(d, l), 12),
    "decontaminate": (lambda d, l, b: decontaminate.find_contamination(d, b), None),
    "sentencepiece": (lambda d, l, b: sentencepiece_codec.encode_documents(d), 12),
    "sharding": (lambda d, l, b: sharding.assign_shards(d), 12),
    "secret_scan": (lambda d, l, b: secret_scan.digest_columns(secret_scan.scan_secrets(d)), 12),
    "lm_score": (lambda d, l, b: lm_score.score_documents(d, l), 12),
    "toxicity": (lambda d, l, b: toxicity.score_toxicity(d, l), 12),
    "near_dedup": (lambda d, l, b: near_dedup.near_duplicates(d), 12),
    "exact_dedup": (lambda d, l, b: exact_dedup.exact_dedup(d), 12),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows(name, docs, labels, benchmark):
    operator, rows = OPERATORS[name]
    found = operator(docs, labels, benchmark).collect()
    assert rows is None or len(found) == rows
    if name == "decontaminate":  # only the document of 150,000 equal letters holds an item
        assert {(r.doc_id, r.item_id) for r in found} == {(7, 3)}
    if name == "sentencepiece":
        assert all(r.roundtrip for r in found)
    if name == "near_dedup":
        by = {r.doc_id: r for r in found if r.doc_id is not None}
        assert by[5].component_id == 1 and by[3].component_id == 3 and by[8].kept
        assert all(r.component_id is None and r.kept for r in found if r.doc_id is None)
    if name == "exact_dedup":
        by = {r.doc_id: r for r in found if r.doc_id is not None}
        assert by[5].keep_id == 1 and by[2].keep_id == 4 and by[3].group_size == 4 and by[8].group_size == 2


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables(name, docs, labels, benchmark):
    operator, _ = OPERATORS[name]
    assert operator(docs.limit(0), labels.limit(0), benchmark.limit(0)).collect() == []


@pytest.mark.parametrize("name", ["quality", "lm_score", "toxicity"])
def test_without_labels(name, docs, labels, benchmark):
    assert OPERATORS[name][0](docs, labels.limit(0), benchmark).count() == 12


def test_pages(spark):
    pages = spark.createDataFrame(
        [(1, "http://h/x", None, 0), (2, None, "", 0), (3, "not a url", "no markup  at all", 0),
         (None, "http://h/y", "<article><p>a&amp;b<p>c", 0), (4, "http://h/y", "<p" * 2000, 0),
         (5, "http://h/z", "<article>" + "<p>line\n x</p>" * 5000, 0)] * 2,
        "page_id long, url string, html string, wrapper int")
    found = html_extract.extract_pages(pages).collect()
    by = {r.page_id: r for r in found}
    assert len(found) == 12 and by[1].text == "" and by[2].n_chars == 0 and by[3].text == "no markup at all"
    assert by[None].text == "a&b\n\nc" and by[5].text == "\n\n".join(["line x"] * 5000)
    assert html_extract.extract_pages(pages.limit(0)).collect() == []


def test_pipeline_stages_keep_columns(spark, docs, labels, benchmark, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns, name
    kept = {r.doc_id for r in corpus_pipeline.exact_dedup_stage(spark, docs, str(tmp_path)).collect()}
    assert kept == {1, 4, 6, 7, 8, 9, None}
    assert corpus_pipeline.exact_dedup_stage(spark, docs, "").where("doc_id = 8").count() == 1
    assert {r.doc_id for r in corpus_pipeline.near_dedup_stage(spark, docs, "").collect()} == {1, 2, 3, 4, 6, 7, 8, 9, None}
    assert corpus_pipeline.decontamination_stage(spark, docs, str(tmp_path)).where("doc_id = 7").count() == 0
