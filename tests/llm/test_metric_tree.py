"""Exact top-k search against all products, and the tree by itself."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hirelens.llm import metric_tree

LONG = metric_tree.LONG


def plain(points, queries, k, own=True):
    """(query_id, rank, id, score): points and queries are (id, list of whole numbers)."""
    out = []
    width = max([len(v) for _, v in points + queries] + [1])
    pad = lambda v: list(v) + [0] * (width - len(v))
    clamped = lambda s: max(-LONG - 1, min(LONG, s))
    for qid, q in queries:
        rows = sorted(((-clamped(sum(a * b for a, b in zip(pad(q), pad(v)))), i is None, i or 0, i) for i, v in points))
        if own:
            mine = (-clamped(sum(a * a for a in q)), qid is None, qid or 0, qid)
            rows.remove(mine)
        out += [(qid, n + 1, r[3], -r[0]) for n, r in enumerate(rows[:k])]
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("query_id", "rank", "id", "score").collect()), key=repr)


def frames(spark, points, queries, kind="long"):
    p = spark.createDataFrame(points, f"id {kind}, v array<bigint>").repartition(3)
    return p, spark.createDataFrame(queries, f"query_id {kind}, v array<bigint>")


def clouds(n, width, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 200, (6, width))
    x = centres[rng.integers(0, 6, n)] + rng.normal(0, 40, (n, width))
    return [(i, [int(c) for c in np.floor(row)]) for i, row in enumerate(x)]


@pytest.mark.parametrize("width,k", [(3, 5), (16, 1), (2, 40)])
def test_against_all_products(spark, width, k, monkeypatch):
    monkeypatch.setattr(metric_tree, "SHARD", 150)
    monkeypatch.setattr(metric_tree, "PAGE", 8)
    monkeypatch.setattr(metric_tree, "ASKED", 7)
    monkeypatch.setattr(metric_tree, "ROOTS", 3)
    points = clouds(1200, width, width)
    queries = [p for p in points if p[0] % 20 == 0]
    assert found(metric_tree.search(*frames(spark, points, queries), k)) == plain(points, queries, k)


def test_copies_ties_and_null_ids(spark, monkeypatch):
    monkeypatch.setattr(metric_tree, "SHARD", 40)
    monkeypatch.setattr(metric_tree, "PAGE", 4)
    points = clouds(200, 3, 9) + [(300 + i, [5, 5, 5]) for i in range(400)] + [(None, [5, 5, 5])] * 30 + [(7, [1, 2, 3]), (300, [5, 5, 5]), (300, [9, 9, 9])]
    points += [(900 + i, [i % 3, 0, 0]) for i in range(50)] + [(1000, [0, 0, 0]), (1000, [0, 0, 0])]
    queries = [p for p in points if p[0] is not None and p[0] % 50 == 0]
    assert found(metric_tree.search(*frames(spark, points, queries), 5)) == plain(points, queries, 5)


def test_huge_components_and_odd_lengths(spark, monkeypatch):
    monkeypatch.setattr(metric_tree, "SHARD", 30)
    monkeypatch.setattr(metric_tree, "PAGE", 4)
    points = clouds(90, 4, 3) + [(200, [LONG, LONG, LONG, LONG]), (201, [-LONG - 1, 3, 0, 1]), (202, [1 << 27, 1, 1, 1]), (203, [1 << 26, 0, 0, 0]),
                                 (204, [LONG, 0, 0, 0]), (205, [7]), (206, []), (207, [3, 4, 5, 6, 7])]
    queries = [p for p in points if p[0] % 10 == 0 or p[0] >= 200]
    assert found(metric_tree.search(*frames(spark, points, queries), 4)) == plain(points, queries, 4)


def test_fewer_rows_than_k_and_other_queries(spark):
    points = [(1, [1, 0]), (2, [0, 1])]
    assert found(metric_tree.search(*frames(spark, points, points), 5)) == plain(points, points, 5)
    queries = [(9, [2, 1]), (9, [2, 1]), (None, [1, 1])]
    assert found(metric_tree.search(*frames(spark, points, queries), 5, own=False)) == plain(points, queries, 5, own=False)
    named = [("a", [1, 0]), ("b", [0, 1]), ("c", [1, 1])]
    assert found(metric_tree.search(*frames(spark, named, named[:1], "string"), 5)) == [("a", 1, "c", 1), ("a", 2, "b", 0)]


def test_empty_tables(spark):
    p, q = frames(spark, [], [])
    assert metric_tree.search(p, q).count() == 0
    p, q = frames(spark, [(1, [1])], [])
    assert metric_tree.search(p, q).count() == 0


def test_vectors_that_take_no_part(spark):
    rows = [(0, [0.5, -0.001], 1), (1, None, 1), (2, [1.0, None], 1), (3, [float("nan"), 1.0], 1), (4, [float("-inf")], 1), (5, [], 1), (6, [1e300, -1e300], 1)]
    df = spark.createDataFrame(rows, "id long, embedding array<double>, rank int")
    kept = {r.id: r.v for r in metric_tree.usable(df, "embedding").select("id", F.col("v")).collect()}
    assert kept == {0: [128, -1], 5: [], 6: [LONG, -LONG - 1]}


def test_pages_cover_what_lies_below(monkeypatch):
    monkeypatch.setattr(metric_tree, "PAGE", 8)
    for points in (clouds(700, 5, 1), [(i, [i * i, 0, 1]) for i in range(300)], [(i, [1 << (i % 20), i, 0]) for i in range(100)]):
        x = np.array([v for _, v in points], np.int64)
        space = metric_tree.Space(x)
        made = {p["page"]: p for p in metric_tree.pages(space)}

        def below(page):
            p = made[page]
            return list(p["entries"]) if p["child"][0] < 0 else [m for c in p["child"] for m in below(int(c))]

        assert sorted(below(0)) == list(range(len(x)))
        for p in made.values():
            assert len(p["entries"]) <= 8
            assert np.allclose(p["apart"], space.apart(p["centre"], p["entries"]))
            for e, r, c in zip(p["entries"], p["radius"], p["child"]):
                if c >= 0:
                    assert space.apart(int(e), np.array(below(int(c)))).max() <= r + 1e-9


def test_search_skips_most_of_a_clustered_tree(monkeypatch):
    monkeypatch.setattr(metric_tree, "PAGE", 64)
    points = clouds(3000, 3, 4)
    x = np.array([v for _, v in points], np.int64)
    space = metric_tree.Space(x)
    rows = [{"page": p["page"], "vectors": x[p["entries"]].ravel().tolist(), "radius": p["radius"].tolist(), "apart": p["apart"].tolist(),
             "child": p["child"].tolist(), "ids": [[int(i)] for i in p["entries"]] if p["child"][0] < 0 else [], "most": space.most} for p in metric_tree.pages(space)]
    tree = metric_tree.Tree(pa.Table.from_pylist(rows), 3)
    computed = []
    add = metric_tree.Best.add
    monkeypatch.setattr(metric_tree.Best, "add", lambda self, s, i: (computed.append(len(s)), add(self, s, i)))
    rng = random.Random(1)
    for _ in range(20):
        i = rng.randrange(len(points))
        expected = sorted(((-int(x[i] @ x[j]), j) for j in range(len(x))))[:5]
        assert tree.search(x[i], 5, None) == [(-s, j) for s, j in expected]
    assert sum(computed) < 20 * len(points) / 4
