import numpy as np
from fixtures import documents, nothing, rows, texts
from pyspark.sql import functions as F

from hirelens.llm import quality_classifier as qc


def walk(forest, row):
    """One row down every tree, node by node."""
    total = forest.start
    for feature, threshold, leaf in zip(forest.feature, forest.bin, forest.leaf):
        node = 0
        while node < len(feature):
            b = np.searchsorted(forest.edges[feature[node]], row[feature[node]])
            node = 2 * node + (2 if b > threshold[node] else 1)
        total += leaf[node - len(feature)]
    return 1 / (1 + np.exp(-total))


def test_traversal_equals_a_walk():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 6)).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    forest = qc.grow(x, y, qc.Fit(trees=30))
    scores = forest.scores(x)
    assert np.allclose(scores, [walk(forest, r) for r in x])
    assert ((scores > 0.5) == (y > 0.5)).mean() > 0.97


def test_one_kind_of_label():
    forest = qc.grow(np.zeros((5, 3), np.float32), np.ones(5))
    assert np.allclose(forest.scores(np.ones((2, 3), np.float32)), 6 / 7)
    assert np.allclose(qc.grow(np.zeros((0, 3), np.float32), np.zeros(0)).scores(np.ones((1, 3), np.float32)), 0.5)


def test_statistics_of_awkward_texts():
    for t in [None, "", " \n", "é", "#" * 10_000, "a\n" * 5000]:
        assert len(qc.statistics(t)) == len(qc.NAMES) and np.isfinite(qc.statistics(t)).all()


def test_junk_is_told_from_prose(spark):
    some = [t for t in texts(n=120) if t and len(t) > 200]
    good = [(i, t) for i, t in enumerate(some)]
    bad = [(1000 + i, " ".join(w.upper() + "!!" for w in t.split())) for i, t in enumerate(some)]
    docs = spark.createDataFrame(good + bad + [(5000, None), (5001, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 1000)) for i, _ in good + bad] + [(3, None), (None, 1), (77_777, 0)], "doc_id long, quality int")
    held_out = F.col("doc_id") % 3 == 0
    found = {r.doc_id: r.score for r in qc.classify(docs, labels, ~held_out).collect()}
    assert len(found) == len(good) + len(bad) + 2
    assert all((found[i] > 0.5) == (i < 1000) for i, _ in good + bad if i % 3 == 0)


def test_awkward_tables(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    found = qc.classify(documents(spark), none, F.lit(True)).collect()
    assert len(found) == len(rows(texts())) and {r.score for r in found} == {0.5}
    assert qc.classify(nothing(spark), none, F.lit(True)).count() == 0
