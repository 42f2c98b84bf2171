"""Base figures, the Kneser-Ney model and the bands against brute force."""

import math
import random
import re
import statistics
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tideline.llm import perplexity as X

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ORDER = X.ORDER


def base_figures(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    times, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered.update(range(i, i + 8))
    lines, seen, repeated = (text or "").split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), repeated, len(covered)]


class KneserNey:
    """Interpolated modified Kneser-Ney over bytes, recursively, of one language."""

    def __init__(self, texts):
        top = Counter()
        for t in texts:
            padded = [256] * (ORDER - 1) + list(t.encode())
            top.update(tuple(padded[i:i + ORDER]) for i in range(len(padded) - ORDER + 1))
        self.counts = {ORDER: top}
        for size in range(ORDER - 1, 0, -1):
            self.counts[size] = Counter(g[1:] for g in self.counts[size + 1])
        self.discounts = {size: self._discounts(c) for size, c in self.counts.items()}
        self.followers = defaultdict(list)
        for size, counts in self.counts.items():
            for g, c in counts.items():
                self.followers[size, g[:-1]].append(c)

    @staticmethod
    def _discounts(counts):
        n = [0] + [sum(c == i for c in counts.values()) for i in range(1, 5)]
        found = []
        for i in (1, 2, 3):
            y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0
            d = i - (i + 1) * y * n[i + 1] / n[i] if n[i] else -1
            found.append(d if n[1] and 0 < d < i else X.FALLBACK[i - 1])
        return found

    def chance(self, gram):
        size = len(gram)
        if not size:
            return 1 / 256
        shorter, beside = self.chance(gram[1:]), self.followers.get((size, gram[:-1]))
        if not beside:
            return shorter
        d = lambda c: self.discounts[size][min(c, 3) - 1]
        c = self.counts[size].get(gram, 0)
        return ((c - d(c) if c else 0) + sum(map(d, beside)) * shorter) / sum(beside)

    def bits(self, text):
        padded = [256] * (ORDER - 1) + list(text.encode())
        return -sum(math.log2(self.chance(tuple(padded[i:i + ORDER]))) for i in range(len(padded) - ORDER + 1))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(8)
    syllables = {"en": "the an on re ing ti ed", "de": "der üb ch ei ß en ge", None: "ка то не по ра ли ст"}
    rows = []
    for lang, parts in syllables.items():
        parts = parts.split()
        word = lambda: "".join(rng.choice(parts) for _ in range(rng.randint(1, 4)))  # noqa: B023,E731
        for _ in range(40):
            lines = [" ".join(word() for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(1, 30))]
            rows.append(("\n".join(lines), lang))
        rows.append((rows[-1][0], lang))
        rows.append((" ".join("".join(rng.choice("qxzjvw") for _ in range(5)) for _ in range(400)), lang))
        rows.append(("\n".join(["a line again and again of this"] * 12), lang))
    rows += [(None, "en"), ("", "en"), (" \n\t ", "de"), ("one", None), ("## | <b> $5 %&*\n## | <b> $5 %&*\n\n\n", "en")]
    return [(i, t, lang) for i, (t, lang) in enumerate(rows)]


@pytest.fixture(scope="module")
def table(spark, texts):
    schema = "doc_id BIGINT, text STRING, lang STRING, n_words INT, bits STRING, language_2 INT"
    return spark.createDataFrame([(*r, 1, "x", 2) for r in texts], schema).repartition(3)


@pytest.fixture(scope="module")
def judged(table):
    return X.judge(table).collect()


def test_base_figures(judged, texts):
    got = {r["doc_id"]: [r[c] for c in X.FIGURES] for r in judged}
    assert got == {i: base_figures(t) for i, t, _ in texts}


def of_language(texts):
    by = defaultdict(list)
    for _, t, lang in texts:
        by[lang].append(t or "")
    return {lang: KneserNey(ts) for lang, ts in by.items()}


def test_scores_equal_brute_force(judged, texts):
    models = of_language(texts)
    for r in judged:
        text, lang = texts[r["doc_id"]][1:]
        if not text:
            assert r["bits_per_byte"] is None and r["base_failed"] and not r["kept"]
        else:
            assert r["bits_per_byte"] == pytest.approx(models[lang].bits(text) / len(text.encode()), rel=1e-4)


def test_unseen_texts_back_off(table, texts, documents, spark):
    model = X.fit(X.count_grams(table))
    other = [(0, "never seen: ÅÄÖ 12345", "en"), (1, "the inger", "en"), (2, "the", "zz"), (3, "дер", None)]
    docs = spark.createDataFrame(other, "doc_id BIGINT, text STRING, lang STRING")
    models = of_language(texts)
    for r in X.score(docs, model, "text", "lang", "doc_id").collect():
        text, lang = other[r["doc_id"]][1:]
        wanted = models[lang].bits(text) if lang in models else 8 * len(text.encode())
        assert r["bits"] == pytest.approx(wanted, rel=1e-4)


def test_blocks_score_as_a_broadcast_does(table, monkeypatch):
    key = lambda rows: sorted((tuple(r) for r in rows), key=str)
    model = X.fit(X.count_grams(table))
    whole = key(X.score(table, model, "text", "lang", "doc_id").collect())
    monkeypatch.setattr(X, "BROADCAST_ENTRIES", 0)
    monkeypatch.setattr(X, "BLOCK_BYTES", 9000)
    assert key(X.score(table, model, "text", "lang", "doc_id").collect()) == whole


def test_chances_of_a_context_add_up_to_one(texts):
    model = of_language(texts)["en"]
    for context in ((), (ord("h"),), tuple(b"the"), tuple(b"zzz")):
        assert sum(model.chance((*context, b)) for b in range(256)) == pytest.approx(1)


def quartile(values, share):
    return statistics.quantiles(values, n=4, method="inclusive")[int(4 * share) - 1] if len(values) > 1 else values[0]


def test_verdicts_follow_the_bands(judged, texts):
    by = defaultdict(list)
    for r in judged:
        failed = r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"]
        assert r["base_failed"] == failed
        if not failed:
            by[texts[r["doc_id"]][2]].append((round(r["bits_per_byte"], 3), len(texts[r["doc_id"]][1].encode())))
    for r in judged:
        if r["base_failed"]:
            assert not r["kept"]
            continue
        _, text, lang = texts[r["doc_id"]]
        median, classes = statistics.median(v for v, _ in by[lang]), defaultdict(list)
        for v, n in by[lang]:
            classes[int(math.log2(n))].append((v, n))
        points = []
        for members in classes.values():
            values, x = [v for v, _ in members], statistics.fmean(1 / n for _, n in members)
            spread = max((quartile(values, .75) - quartile(values, .25)) / X.QUARTILES, X.LEAST_SPREAD)
            points.append((x, spread ** 2, len(members) / x ** 2))
        s, sx, sy, sxx, sxy = (sum(w * f(x, y) for x, y, w in points) for f in (
            lambda x, y: 1, lambda x, y: x, lambda x, y: y, lambda x, y: x * x, lambda x, y: x * y))
        slope = max((s * sxy - sx * sy) / (s * sxx - sx * sx), 0) if len(points) > 1 else 0
        level = (sy - slope * sx) / s
        if level < 0:
            slope, level = sxy / sxx, 0
        deviation = math.sqrt(level + slope / len(text.encode()))
        assert r["low"] == pytest.approx(median - X.BELOW * deviation, rel=1e-6)
        assert r["high"] == pytest.approx(median + X.ABOVE * deviation, rel=1e-6)
        assert r["kept"] == (r["low"] <= r["bits_per_byte"] <= r["high"])


def test_noise_among_many_goes(spark):
    rng = random.Random(2)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(rng.randint(2, 7)))
    rows = [(i, " ".join(word("etaoin shr") for _ in range(200)), "en") for i in range(200)]
    rows += [(900 + i, " ".join(word("qxzjkv#%") for _ in range(200)), "en") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING")
    gone = {r["doc_id"] for r in X.judge(docs).where("not kept").collect()}
    assert gone == {900, 901, 902}


def test_empty_table(table):
    assert X.judge(table.where(F.lit(False))).collect() == []


def test_repeated_rows_and_null_keys(spark):
    text = " ".join(f"word{i} of" for i in range(30))
    docs = spark.createDataFrame([(1, text, "en")] * 40 + [(None, text, "en")], "doc_id BIGINT, text STRING, lang STRING")
    rows = X.judge(docs).collect()
    assert len(rows) == 41 and all(r["kept"] for r in rows)
