from collections import defaultdict

from fixtures import documents, nothing

from hirelens.llm import mixing


def filled(sizes, units=(5, 2, 1), most=3):
    """Targets by resharing the excess until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    unit = {s: units[i % len(units)] for i, s in enumerate(names)}
    fixed = {}
    while True:
        free = [s for s in names if s not in fixed]
        share = (sum(sizes.values()) - sum(fixed.values())) / (sum(unit[s] for s in free) or 1)
        over = [s for s in free if share * unit[s] > most * sizes[s]]
        if not over:
            return fixed | {s: share * unit[s] for s in free}
        fixed |= {s: most * sizes[s] for s in over}


def test_targets_and_taken(spark):
    for buckets in (1, 7, 4096):
        rows = mixing.mix(documents(spark), mixing.Plan(buckets=buckets)).collect()
        sizes, taken, longest = defaultdict(int), defaultdict(int), defaultdict(int)
        for r in rows:
            sizes[r.source] += r["size"]
            taken[r.source] += r.taken
            longest[r.source] = max(longest[r.source], r["size"])
            assert r.taken <= 3 * r["size"]
        wanted = filled(sizes)
        for r in rows:
            assert abs(r.target - wanted[r.source]) < 1e-6 and r.source_size == sizes[r.source]
        for s in sizes:
            assert abs(taken[s] - wanted[s]) <= longest[s]
        if buckets == 1:
            first = sorted(rows, key=str)
        assert sorted(rows, key=str) == first


def test_many_sources_that_stop(spark):
    docs = spark.createDataFrame([(i, "w " * n, s) for i, (s, n) in enumerate(
        [("a", 1), ("b", 1), ("c", 300), ("d", 2), ("e", 0), (None, 40), ("f", 500), ("c", 100)])], "doc_id long, text string, source string")
    sizes = {"a": 1, "b": 1, "c": 400, "d": 2, "e": 0, None: 40, "f": 500}
    wanted = filled(sizes)
    for r in mixing.mix(docs).collect():
        assert abs(r.target - wanted[r.source]) < 1e-6


def test_better_documents_come_more_often(spark):
    docs = spark.createDataFrame(
        [(i, ("plain word here " if i % 2 else "### $$$ word ") * 10, "a") for i in range(2000)] + [(9999, "w " * 40_000, "b")],
        "doc_id long, text string, source string")
    rows = [r for r in mixing.mix(docs, mixing.Plan(weights=(1, 4))).collect() if r.source == "a"]
    good, bad = (sum(r.selected for r in rows if r.weight == w) for w in (1.0, 0.25))
    assert good > 2 * bad > 0


def test_mixed_documents(spark):
    docs = documents(spark)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == [*docs.columns, "target", "copies"]  # the input has a `size` of its own
    taken = {(r.doc_id, r.taken) for r in mixing.mix(docs).collect() if r.epochs + r.selected}
    assert {(r.doc_id, r.copies * len((r.text or "").split())) for r in mixed.collect()} == taken


def test_nothing(spark):
    assert mixing.mix(nothing(spark)).count() == 0 and mixing.mixed_documents(nothing(spark)).count() == 0
