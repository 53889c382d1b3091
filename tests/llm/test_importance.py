"""Resampling towards a target against a brute-force version."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from tests.llm.support import awkward_texts, documents, empty, prose
from tripstream.llm import importance

TARGET = ["The cat of THE house, the 2nd.", None, "", "été au lait; not from it"]


def brute(texts, target, longest=1, buckets=10_000, percent=10, min_words=20, seed=2024):
    def words(text):
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)

    def features(text):
        w = words(text)
        return [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]

    def bucket(feature):
        return zlib.crc32(feature.encode()) % buckets

    s, t = (Counter(bucket(f) for x in side for f in features(x)) for side in (texts.values(), target))
    all_s, all_t = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))

    out = {}
    for i, x in texts.items():
        weight = sum(gain(bucket(f)) for f in features(x))
        h = int(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()[:8], 16)
        out[i] = [len(features(x)), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None]
    able = sorted((i for i in out if len(words(texts[i])) >= min_words), key=lambda i: (-out[i][2], i))
    for rank, i in enumerate(able[: percent * len(able) // 100], 1):
        out[i][3] = rank
    return {i: tuple(v) for i, v in out.items()}


def frames(spark, texts, target):
    return documents(spark, texts), spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")


def got(frame):
    return {r["doc_id"]: (r["n_features"], r["weight"], r["score"], r["rank"]) for r in frame.collect()}


@pytest.mark.parametrize("choices", [{}, {"longest": 3, "buckets": 64, "percent": 35, "min_words": 3, "seed": 7}, {"percent": 100, "min_words": 0}])
def test_equals_brute_force(spark, choices):
    texts = [*awkward_texts(), "Zürich-West 3x\x00y’s " * 9, *(prose(random.Random(i), 25) for i in range(60))]
    docs, target = frames(spark, texts, TARGET)
    found = importance.resample(docs, target, **choices)
    assert found.columns == ["doc_id", "lang", "source", "n_chars", "keep_id", "n_tokens", "kept", "n_features", "weight", "score", "rank"]
    assert got(found) == brute(dict(enumerate(texts)), TARGET, **choices)


def test_empty_tables(spark):
    docs, target = frames(spark, [prose(random.Random(i), 30) for i in range(12)], TARGET)
    assert importance.resample(empty(spark), target).count() == 0
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert got(importance.resample(docs, target.where("item_id < 0"))) == brute(texts, [])


def test_names_that_clash_and_a_null_id(spark):
    rows = [(None if i == 3 else i, prose(random.Random(i), 30), "a", "b", 1, "c") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string, of string, Rank int, words string")
    found = importance.resample(docs, frames(spark, [], TARGET)[1], keep_text=True)
    assert found.columns == ["doc_id", "text", "row", "of", "words", "n_features", "weight", "score", "rank"]
    rows = found.collect()
    assert sorted(r["rank"] for r in rows if r["rank"]) == [1, 2] and {(r["row"], r["of"], r["words"]) for r in rows} == {("a", "b", "c")}


def test_ties_go_to_the_smaller_id_and_repeated_rows_count_each(spark):
    copies = spark.range(40).selectExpr("7L as doc_id", "'one two three' as text")
    found = importance.resample(copies, frames(spark, [], TARGET)[1], min_words=1)
    assert sorted(r["rank"] for r in found.collect() if r["rank"]) == [1, 2, 3, 4]


def test_a_cut_that_is_too_high_is_noticed(spark, monkeypatch):
    # With a share far below zero for slack the cut lies above most of what is drawn.
    monkeypatch.setattr(importance, "SLACK", -0.08)
    monkeypatch.setattr(importance.F, "percentile_approx", lambda c, s, a, f=importance.F.percentile_approx: f(c, s, importance.F.lit(1000)))
    texts = [prose(random.Random(i), 30) for i in range(100)]
    docs, target = frames(spark, texts, TARGET)
    assert got(importance.resample(docs, target)) == brute(dict(enumerate(texts)), TARGET)
