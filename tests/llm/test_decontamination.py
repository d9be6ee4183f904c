import re

import pytest
from fixtures import documents, nothing, rows, texts
from pyspark.sql import functions as F

from hirelens.llm import decontamination

SEPARATORS = re.compile("[\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in SEPARATORS.split(lowered) if w]


def brute(docs, items, size=10):
    windows = [(i, w[s:s + size]) for i, t in items for w in [words(t)] if w for s in range(max(1, len(w) - size + 1))]
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for item, window in windows:
            n = len(window)
            for s in range(len(w) - n + 1):
                if w[s:s + n] == window:
                    hit |= set(range(s, s + n))
                    found.add(str(item))
        out.append((i, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


def items(some):
    long = [t for t in some if t and len(t) > 500]
    cut = lambda t, a, n: " ".join(t.split()[a:a + n])
    return [(1, cut(long[0], 5, 25)), (2, cut(long[1], 0, 12).upper()), (3, "word"), (4, "of the"), (5, cut(long[2], 9, 5)), (6, None),
            (7, ""), (8, cut(long[0], 5, 25)), (8, cut(long[0], 5, 25)), (9, "ab ab ab ab"), (10, "not in any of the texts at all, ever"),
            (11, cut(long[3], 3, 10) + " zzz"), (12, cut(long[-1], -10, 10)), (13, "ab " * 15)]


def found(docs, bench):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in decontamination.contamination(docs, bench).collect()), key=str)


@pytest.mark.parametrize("short", [True, False])
def test_against_brute_force(spark, short):
    some = texts()
    bench = [x for x in items(some) if short or len((x[1] or "").split()) > 9]
    table = spark.createDataFrame(bench, "item_id long, text string").withColumn("window", F.lit("extra"))
    assert found(documents(spark), table) == brute([r[:2] for r in rows(some)], bench)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert found(nothing(spark), none) == []
    assert {r[2] for r in found(documents(spark), none)} == {0}
    assert found(nothing(spark), spark.createDataFrame([(1, "of the")], "item_id long, text string")) == []


def test_clean_documents(spark):
    some = texts()
    bench = [x for x in items(some) if x[0] in (1, 2, 5)]
    kept = decontamination.clean_documents(documents(spark), spark.createDataFrame(bench, "item_id long, text string"))
    assert kept.columns == documents(spark).columns
    wanted = [r[0] for r in brute([r[:2] for r in rows(some)], bench) if not r[2]]
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(wanted, key=str)
    assert 0 < len(wanted) < len(rows(some))
