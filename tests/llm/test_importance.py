"""Importance resampling against a plain version, and its parts."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fixtures import documents, nothing, rows, texts
from hirelens.llm import importance
from hirelens.llm.base import Scratch


def plain_words(text):
    lowered = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain_features(text, longest):
    ws = plain_words(text)
    return [" ".join(ws[i:i + n]) for n in range(1, longest + 1) for i in range(len(ws) - n + 1)]


def plain(docs, targets, longest, buckets, percent, least):
    """(doc_id, n_features, weight, score, rank) by the definition."""
    def counts(some):
        return Counter(zlib.crc32(f.encode()) % buckets for t in some for f in plain_features(t, longest))

    s, t = counts(x for _, x in docs), counts(targets)
    big_s, big_t = sum(s.values()), sum(t.values())
    out = []
    for i, text in docs:
        fs = plain_features(text, longest)
        weight = 0
        for f in fs:
            b = zlib.crc32(f.encode()) % buckets
            weight += math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets))))
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(plain_words(text))])
    able = sorted((o for o in out if o[5] >= least), key=lambda o: (-o[3], o[0] is None, o[0] or 0, o[1], o[2]))
    for k, o in enumerate(able[:percent * len(able) // 100]):
        o[4] = k + 1
    return sorted((tuple(o[:5]) for o in out), key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("row.doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


@pytest.mark.parametrize("longest,buckets,percent", [(1, 10_000, 10), (3, 50, 60), (2, 1, 100)])
def test_against_plain(spark, longest, buckets, percent):
    some = texts()
    target = [some[9], None, "", some[20]]
    drawn = importance.draw(documents(spark, some), spark.createDataFrame([(t,) for t in target], "text string"), longest, buckets, percent)
    assert found(drawn) == plain([r[:2] for r in rows(some)], target, longest, buckets, percent, 20)


def test_many_ties(spark):
    # one id (null) holds a third of the rows, and equal texts give equal scores
    some = [(None if i % 3 == 0 else i % 7, "same words here" if i % 2 else f"other words {i % 5}") for i in range(3000)]
    docs = spark.createDataFrame(some, "doc_id long, text string").repartition(5)
    target = spark.createDataFrame([("same",)], "text string")
    drawn = importance.draw(docs, target, buckets=100, percent=37, least_words=1)
    assert found(drawn) == plain(some, ["same"], 1, 100, 37, 1)


def test_empty_tables(spark):
    none = nothing(spark)
    assert importance.draw(none, none).count() == 0
    assert importance.resample(none, none).columns == none.columns
    docs = documents(spark)
    assert {r.rank for r in importance.draw(docs.filter("doc_id < 8"), none, least_words=2).collect()} == {None}
    assert importance.draw(docs, none, percent=50).filter(F.col("rank").isNotNull()).count() > 0


def test_text_ids_and_own_columns(spark):
    docs = spark.createDataFrame([(f"d{i}", "w " * 30, i, "x") for i in range(40)], "doc_id string, text string, rank int, row string")
    taken = importance.resample(docs, docs, percent=25)
    assert taken.columns == docs.columns and taken.count() == 10


@pytest.mark.parametrize("stretch", [1, 7, 64])
def test_long_texts_in_stretches(stretch):
    text = "Ab, cdé fghij-k 漢字 l " * 50
    whole = [w for ws in importance.word_stretches(text.encode(), stretch) for w in ws]
    assert [w.decode() for w in whole] == plain_words(text)


def test_features_across_stretches(monkeypatch):
    text = ("Ab, cdé fghij-k 漢字 l " * 9).encode()
    def all_of(longest):
        return sorted(int(b) for _, bs in importance.hashed(text, longest, 1000) for b in bs)
    whole = {n: all_of(n) for n in (1, 2, 3)}
    cut = importance.word_stretches
    monkeypatch.setattr(importance, "word_stretches", lambda t: cut(t, 5))
    assert {n: all_of(n) for n in (1, 2, 3)} == whole
    assert whole[3] == sorted(zlib.crc32(f.encode()) % 1000 for f in plain_features(text.decode(), 3))


@pytest.mark.parametrize("accuracy", [1, 2000])
def test_cutoff_holds_for_a_bad_sketch(spark, accuracy, monkeypatch):
    monkeypatch.setattr(importance, "ACCURACY", accuracy)
    values = [(i * i * 37) % 101 - 50 for i in range(500)]
    scores = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "score long, number long")
    for drawn in (1, 3, 250, 499, 500):
        scratch = Scratch(spark, "cut")
        assert importance.cutoff(scores, drawn, 500, scratch) == sorted(values, reverse=True)[drawn - 1]


def test_only_the_drawn_have_ranks_in_a_row(spark):
    docs = documents(spark)
    ranks = sorted(r.rank for r in importance.draw(docs, docs.limit(3), percent=50).filter(F.col("rank").isNotNull()).select("rank").collect())
    assert ranks == list(range(1, len(ranks) + 1)) and ranks
