"""Each stage of the pipeline against brute force on what the stage before it kept."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from test_texts import grouped, removed

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs.collect()]
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        out.append(docs.collect())
        if out[-1] and "text" in docs.columns:
            docs = spark.createDataFrame(out[-1], docs.schema)
    return out


def ids(rows):
    return {r["doc_id"] for r in rows}


def test_columns_stay_those_of_documents(stages):
    for rows in stages[1:-1]:
        assert rows[0].__fields__ == ["doc_id", "text", "lang", "source", "n_chars"]


def test_languages_and_quality_keep_clean_documents(stages, spark):
    assert ids(stages[0]) - ids(stages[1]) == {
        r["doc_id"] for r in stages[0] if not any(c.isalpha() for c in r["text"] or "")}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    clean = {i for i in ids(stages[1]) if labels.get(i) == 1}
    assert len(clean & ids(stages[2])) >= 0.99 * len(clean)
    assert ids(stages[2]) < ids(stages[1])


def test_texts_of_no_language_go_and_the_language_is_written(spark):
    rng = random.Random(1)
    letters = [chr(c) for c in range(0x21, 0x7F)]
    noise = "".join(rng.choice(letters) for _ in range(400))
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(corpus_pipeline.COLUMNS)
    known = {r["doc_id"]: r["lang"] for r in docs.collect()}
    added = spark.createDataFrame([(10**6, noise, None, "s", 400)], docs.schema)
    got = {r["doc_id"]: r["lang"] for r in corpus_pipeline.language_stage(
        spark, docs.withColumn("lang", F.expr("if(doc_id % 7 = 0, null, lang)")).union(added), SF).collect()}
    assert 10**6 not in got
    assert sum(got[i] == known[i] for i in got) >= 0.97 * len(got) and None not in got.values()


def test_one_document_of_each_group_stays(stages):
    groups = grouped([(r["doc_id"], r["text"]) for r in stages[2]])
    assert ids(stages[3]) == {i for i, (_, c) in groups.items() if i == c}
    assert len(stages[3]) < len(stages[2])


def test_repeated_passages_go(stages):
    want = removed([(r["doc_id"], r["text"]) for r in stages[3]])
    before = {r["doc_id"]: r["text"] for r in stages[3]}
    assert {r["doc_id"]: r["text"] for r in stages[4]} == {
        i: kept if gone else before[i] for i, (n, gone, kept) in want.items() if gone < n}
    assert any("\n" in r["text"] for r in stages[4])
    assert all(r["n_chars"] == len(r["text"]) for r in stages[4])


def test_all_that_is_left_is_packed(stages):
    size = {}
    for r in stages[5]:
        size[r["doc_id"]] = size.get(r["doc_id"], 0) + r["size"]
    assert size == {r["doc_id"]: len(r["text"].encode()) for r in stages[4]}


def test_run(spark, stages):
    assert len(corpus_pipeline.run(spark, SF).collect()) == len(stages[5])


def test_stages_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_stages_take_extra_columns_of_clashing_names(spark, documents):
    docs = documents([f"the cat number {i} sat on the mat and the hat of day {i}" for i in range(12)] + [None])
    for name in ("lang_pred", "predicted", "bits_per_byte", "component_id", "n_removed", "kept"):
        docs = docs.withColumn(name, F.lit("theirs"))
    plain = docs.select(corpus_pipeline.COLUMNS)
    for name, stage in corpus_pipeline.STAGES:
        got, want = stage(spark, docs, SF), stage(spark, plain, SF)
        assert name == "packing" or got.columns == corpus_pipeline.COLUMNS, name
        assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str), name
