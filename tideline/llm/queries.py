"""The thin queries of the operators: each over the whole of its table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tideline.llm import (
    alignment, bpe, chat, embedding_dedup, jaccard, langid, lexical, neighbours, packing, perplexity, quality,
    sharding, substring,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


SHARDS = 40
BIN_BYTES = 8192
BEST = 50


@query
def op1_substring_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return substring.remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op2_embedding_dedup(spark, sf_dir):
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


@query
def op3_sharding(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "text")
    return sharding.interleave(docs, SHARDS).withColumns({
        "law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")})


@query
def op4_chat_rotation(spark, sf_dir):
    return chat.rotate(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


@query
def op5_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    trees = langid.fit(docs)
    scored = langid.identify(docs.select("doc_id", "text"), trees)
    return scored.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score",
                         "bits_per_byte")


@query
def op6_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    scored = quality.classify(docs, model)
    return scored.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query
def op7_neighbours(spark, sf_dir):
    return neighbours.search(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 100 == 0)


@query
def op8_bpe(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    decoded = bpe.decode(bpe.encode(docs, path, public_tokenizers.PATTERN), path)
    digits = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                          F.sha2(digits, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op9_jaccard_join(spark, sf_dir):
    return jaccard.similar(table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op10_packing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "text")
    return packing.pack(docs, BIN_BYTES, F.octet_length("text"), packing.copies("text"))


@query
def op11_alignment(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return alignment.align(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN,
                           public_tokenizers.path("piece_bpe_32k.model"))


@query
def op12_lexical_search(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return lexical.search(docs, table(spark, sf_dir, "benchmark", "item_id", "text"), BEST)


@query
def op13_perplexity(spark, sf_dir):
    return perplexity.judge(table(spark, sf_dir, "documents", "doc_id", "text", "lang"))


# The dialogue table in SQL: running sums over each dialogue, as the operator defines them.
ORACLES["op4_chat_rotation"] = """
WITH lines AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS words FROM conversations),
speakers AS (SELECT DISTINCT conv_id, speaker AS perspective FROM lines WHERE speaker <> 'system'),
heads AS (
  SELECT l.conv_id, perspective, turn, speaker, words,
    CASE WHEN speaker = perspective THEN 'assistant' WHEN speaker = 'system' THEN 'system' ELSE 'user' END AS role
  FROM lines l JOIN speakers s ON l.conv_id IS NOT DISTINCT FROM s.conv_id),
headed AS (
  SELECT *, CASE WHEN role = 'user' THEN '<|user|>' || speaker ELSE '<|' || role || '|>' END || chr(10) AS head
  FROM heads),
segments AS (SELECT *, head || words || chr(10) || '<|end|>' || chr(10) AS segment FROM headed),
placed AS (
  SELECT *, row_number() OVER w - 1 AS position,
    coalesce(sum(length(segment)) OVER (PARTITION BY conv_id, perspective
      ORDER BY turn NULLS FIRST, speaker, segment ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS b
  FROM segments WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, segment))
SELECT conv_id, perspective, position, turn, speaker, role, segment, b AS "begin", b + length(segment) AS "end",
  CASE WHEN role = 'assistant' THEN b + length(head) ELSE b + length(segment) END AS target_begin,
  CASE WHEN role = 'assistant' THEN b + length(head) + length(words) ELSE b + length(segment) END AS target_end
FROM placed
"""

# The formula of the search over all terms of all documents.
ORACLES["op12_lexical_search"] = r"""
WITH terms AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
lengths AS (SELECT doc_id, count(*) AS n FROM terms GROUP BY doc_id),
corpus AS (SELECT count(*) AS docs, sum(n)::BIGINT AS length FROM lengths),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
counts AS (
  SELECT doc_id, term, count(*) AS tf FROM terms WHERE term IN (SELECT term FROM asked) GROUP BY doc_id, term),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM counts, corpus GROUP BY term, docs),
impacts AS (
  SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // length))) AS impact
  FROM counts JOIN weights USING (term) JOIN lengths USING (doc_id), corpus),
scores AS (
  SELECT item_id, doc_id, sum(impact)::BIGINT AS score FROM asked JOIN impacts USING (term) GROUP BY item_id, doc_id)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scores WHERE score > 0
QUALIFY rank <= 50
"""

# Every window of 20 words by its text; the earliest start of each is the one that stays.
ORACLES["op1_substring_dedup"] = r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
starts AS (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS start FROM texts),
windows AS (SELECT doc_id, start, array_to_string(words[start:start + 19], ' ') AS content FROM starts),
later AS (
  SELECT doc_id, start FROM windows QUALIFY row_number() OVER (PARTITION BY content ORDER BY doc_id, start) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(start, start + 20)) AS place FROM later),
places AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM texts),
stay AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS kept, count(*) AS n
  FROM places ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM texts LEFT JOIN stay USING (doc_id)
"""

# Sets of shingles joined on a common one, counted, and components by walking the links.
ORACLES["op9_jaccard_join"] = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words FROM documents),
starts AS (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS start FROM texts WHERE len(words) > 0),
shingles AS (SELECT DISTINCT doc_id, array_to_string(words[start:start + 4], ' ') AS shingle FROM starts),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b USING (shingle)
  WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * common.n >= 75 * (x.n + y.n - common.n)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) LEFT JOIN sizes USING (doc_id)
"""
