"""A training corpus from raw documents: five stages, each an operator of ``tideline.llm``.

1. language ID: texts without a letter, null texts, and texts that every learned language codes in
   more than ``MOST_BITS`` a byte, go; ``lang`` becomes the predicted language;
2. quality classifier: texts predicted to be of low quality go;
3. n-gram Jaccard join: of each group of near duplicates the smallest doc_id stays;
4. substring dedup: words of repeated passages are removed from ``text`` (the others are
   joined by one space; ``n_chars`` follows; a text that loses none stays as it is); a text left
   without words goes;
5. best-fit packing: the pieces of the texts with their bins.

Every stage is written before the next reads it. Models are fitted on the stage's own input.
The first four stages read and return the columns of ``documents``; others are left behind.
Rows that repeat a doc_id are one document and stay or go together. Rows without a doc_id
are compared with nothing and stay, if their text does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tideline.llm import jaccard, langid, packing, quality, substring
from tideline.llm.queries import BIN_BYTES
from tideline.session import materialise


COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
MOST_BITS = 6.0  # running text takes 2 to 3 bits a byte in its language, a few words with keys or numbers up to 5.5


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = langid.identify(docs.select(COLUMNS), langid.fit(docs))
    known = found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("bits_per_byte") <= MOST_BITS))
    return known.withColumn("lang", F.col("lang_pred")).select(COLUMNS)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.classify(docs.select(COLUMNS), model).where("predicted = 1").select(COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    later = jaccard.similar(docs).where("doc_id <> component_id").select("doc_id")
    return docs.select(COLUMNS).join(later, "doc_id", "left_anti")


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = substring.remove_repeats(docs, carry=["lang", "source"], untouched=True).where("n_removed < n_words")
    return kept.select("doc_id", F.col("kept").alias("text"), "lang", "source",
                       F.length("kept").cast("long").alias("n_chars"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, BIN_BYTES, F.octet_length("text"), packing.copies("text"))


STAGES = [
    ("language_id", language_stage),
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("substring_dedup", substring_stage),
    ("packing", packing_stage),
]

# The stages are models, joins by hashing and sequential packing: not expressible in SQL.
# tests/llm/test_pipeline.py compares them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``; each is written to the shared folder and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    name, last = STAGES[-1]
    return materialise(last(spark, docs, sf_dir), f"stage-{name}")
