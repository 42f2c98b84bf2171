"""Language identification, quality classifier and BPE."""

import hashlib
import math

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tideline.llm import bpe, langid, quality
from tideline.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [None, "", " ", "\n\n  x", "a<|endoftext|>b <|endoftext|>", "don't WE'LL 12345 x_y", "日本語のテキスト" * 20, "x" * 3000,
       "é" * 200, "½ ² Ⅷ", "a b c", "👩‍👩‍👧 ok", "é combining", "\x1c\x1d x", "ab" * 300 + " tail", "a\r\n\tb"]


def test_bpe_equals_the_library_and_round_trips(documents):
    texts = ODD + [t for t in ODD if t]
    decoded = bpe.decode(bpe.encode(documents(texts), PATH, public_tokenizers.PATTERN), PATH)
    library = Tokenizer.from_file(PATH)
    for r in decoded.collect():
        want = library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["ids"] == want, texts[r["doc_id"]]
        assert r["decoded"] == library.decode(want, skip_special_tokens=False)
        assert (r["key"], r["size"]) == ("k", 7)


def test_bpe_of_long_words_equals_that_of_short_ones():
    vocabulary = bpe.Vocabulary(PATH, public_tokenizers.PATTERN)
    words = [b" internationalization", b"aaaaaaaaaaaa", "überraschend".encode(), b"zzxqj", b"a"]
    order, ids, sizes = vocabulary.encode_words(words)
    ends = np.cumsum(sizes)
    for place, end, size in zip(order, ends, sizes):
        assert ids[end - size:end].tolist() == vocabulary.encode_long(words[place]).tolist()


def test_bpe_forgets_and_goes_on(monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 2)
    encoder = bpe.Encoder(bpe.Vocabulary(PATH, public_tokenizers.PATTERN))
    first = encoder.encode(["the quick brown fox", "jumps"])
    again = encoder.encode(["the quick brown fox", "jumps"])
    assert first[0].tolist() == again[0].tolist() and first[1].tolist() == again[1].tolist()


def test_bpe_query(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    library = Tokenizer.from_file(PATH)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in QUERIES["op8_bpe"](spark, SF).collect():
        ids = library.encode(docs[r["doc_id"]], add_special_tokens=False).ids
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (
            len(ids), digest(",".join(map(str, ids))), digest(docs[r["doc_id"]]))


def test_decode_of_broken_ids(spark):
    ids = spark.createDataFrame([(1, [220, 128]), (2, None), (3, [])], "doc_id INT, ids ARRAY<INT>")
    library = Tokenizer.from_file(PATH)
    got = {r["doc_id"]: r["decoded"] for r in bpe.decode(ids, PATH).collect()}
    assert got == {1: library.decode([220, 128]), 2: "", 3: ""}


def plain_code_length(sample, text, order=langid.ORDER):
    """PPM with escapes, symbol by symbol."""
    trees = langid.ContextTrees({"x": [sample]})
    train = trees.symbol[np.frombuffer(sample.encode(), np.uint8)].tolist()
    coded = trees.symbol[np.frombuffer(text.encode(), np.uint8)].tolist()
    space = int(trees.symbol[32])
    counts = {}
    for k in range(order + 1):
        for i in range(k, len(train)):
            counts.setdefault(tuple(train[i - k:i]), {}).setdefault(train[i], 0)
            counts[tuple(train[i - k:i])][train[i]] += 1
    bits, past = 0.0, [space] * order
    for symbol in coded:
        chance = 1.0
        for k in range(order, -1, -1):
            node = counts.get(tuple(past[len(past) - k:]))
            if not node:
                continue
            whole = sum(node.values()) + len(node)
            if symbol in node:
                chance *= node[symbol] / whole
                break
            chance *= len(node) / whole
        else:
            chance /= langid.SYMBOLS
        bits -= math.log2(chance)
        past = (past + [symbol])[1:]
    return bits


def test_code_lengths_are_those_of_the_context_tree():
    sample = "the cat sat on the mat. a cat! The 12 hats"
    trees = langid.ContextTrees({"x": [sample]})
    for text in ("the cat", "zebra 7", "hat hat", "é"):
        raw = text.encode()
        bits, _, _ = trees.score(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        assert bits[0, 0] == pytest.approx(plain_code_length(sample, text), rel=1e-5)


def test_language_of_odd_texts(documents):
    texts = ["the cat and the hat"] * 6 + ["der Hund und die Katze"] * 6 + [None, "", "12 !?", "und der", "the hat " * 5000]
    docs = documents(texts).withColumn("lang", F.when(F.col("text").contains("und"), "de").otherwise("en"))
    trees = langid.fit(docs)
    got = {r["doc_id"]: r for r in langid.identify(docs, trees).collect()}
    assert trees.languages == ["de", "en"]
    assert [got[i]["lang_pred"] for i in (0, 6, 12, 13, 14, 15, 16)] == ["en", "de", "und", "und", "und", "de", "en"]
    assert got[12]["score"] == 0 and all(0 <= r["score"] <= 1 for r in got.values()) and got[0]["key"] == "k"


def test_only_letters_make_a_language(documents):
    bare = ["👩‍👩‍👧 🎉", "“…” – — ‘’", "€ 5 £ ¥", "١٢٣ ४५६", "½ ² Ⅷ", "\u0301"]
    texts = ["the cat and the hat"] * 6 + bare + [f"{t} é" for t in bare] + ["日本語", "кот", "१२ क", "ª"]
    docs = documents(texts)
    got = {r["doc_id"]: r for r in langid.identify(docs, langid.fit(docs.where("doc_id < 6"))).collect()}
    for i, text in enumerate(texts):
        known = any(c.isalpha() for c in text)
        assert (got[i]["lang_pred"], got[i]["score"] > 0) == (("en", True) if known else ("und", False)), text


def test_language_without_labels(documents):
    docs = documents(["some text", None], langs=(None,))
    got = langid.identify(docs, langid.fit(docs)).collect()
    assert {(r["lang_pred"], r["score"]) for r in got} == {("und", 0.0)}
    empty = documents([])
    assert langid.identify(empty, langid.fit(empty)).count() == 0


def test_language_on_held_out_documents(spark):
    got = QUERIES["op5_language_id"](spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    held = got.where("held_out").join(docs, "doc_id")
    assert got.count() == docs.count() and held.count() > 150
    assert held.where("lang_pred = lang").count() / held.count() > 0.98


def test_quality_on_held_out_documents(spark):
    got = QUERIES["op6_quality"](spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet").where("quality is not null")
    held = got.where("held_out").join(labels, "doc_id")
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert held.where("predicted = quality").count() / held.count() > 0.95
    assert got.where("score < 0 or score > 1 or predicted <> int(score >= 0.3)").count() == 0


def test_quality_of_odd_texts(documents, spark):
    docs = documents([None, "", "a text", "x " * 50_000])
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 0), (2, None, 0)], "doc_id BIGINT, quality INT, toxic INT")
    for marked in (labels, labels.where("false")):
        got = quality.classify(docs, quality.fit(docs, marked)).collect()
        assert len(got) == 4 and all(0 <= r["score"] <= 1 and r["key"] == "k" for r in got)
    assert quality.classify(documents([]), quality.fit(docs, labels)).count() == 0


def test_pairs_explain_what_single_figures_cannot():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(int)
    model = quality.AdditiveModel(x, y)
    assert ((model.score(x) > 0.5) == y).mean() > 0.95
    assert {model.pairs[0][0], model.pairs[0][1]} == {0, 1}


def test_figures_do_not_depend_on_the_slice():
    texts = ["One two. One two!", "", "AAA 12 | b", "x\nx\nx", "é è"]
    raw = [t.encode() for t in texts]
    whole = quality.features(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    single = [quality.features(np.frombuffer(r, np.uint8), np.array([0, len(r)]))[0] for r in raw]
    assert np.allclose(whole, np.stack(single))
    assert np.isfinite(whole).all()


def test_fits_read_back_no_more_than_their_sample(spark, monkeypatch):
    """A key with very many rows, some of one text and some of others."""
    rows = [(1, f"the same text {i % 5}", "en") for i in range(3000)] + [
        (i, f"der text nummer {i} und so weiter", "de") for i in range(2, 40)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING")
    seen = {}
    monkeypatch.setattr(langid, "ContextTrees", lambda samples: seen.update(samples) or samples)
    langid.fit(docs)
    assert sorted(seen["en"]) == [f"the same text {i}" for i in range(5)] and len(seen["de"]) > 20
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 40)], "doc_id BIGINT, quality INT")
    sizes = []
    monkeypatch.setattr(quality, "AdditiveModel", lambda x, y: sizes.append((len(x), len(y))))
    quality.fit(docs, labels.union(labels))
    assert sizes == [(len(seen["de"]) + 1,) * 2]


def test_every_one_of_many_languages_is_learned(spark, monkeypatch):
    monkeypatch.setattr(langid, "SAMPLE_DOCS", 4)
    monkeypatch.setattr(langid, "MOST_LANGUAGES", 10)
    rows = [(40 * k + i, f"text {i} of {k}", f"l{k:03d}") for k in range(30) for i in range(8)]
    seen = {}
    monkeypatch.setattr(langid, "ContextTrees", lambda samples: seen.update(samples) or samples)
    langid.fit(spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING"))
    assert len(seen) == 30 and sum(map(len, seen.values())) <= 4 * 10
