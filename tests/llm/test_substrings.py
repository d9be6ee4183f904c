import hashlib
import random
from collections import defaultdict

import pytest
from fixtures import documents, nothing, rows, texts

from hirelens.llm import substrings


def brute(some, size=50):
    first = defaultdict(lambda: float("inf"))
    order = lambda i: float("inf") if i is None else i
    for i, t in some:
        b = (t or "").encode()
        for s in range(len(b) - size + 1):
            first[b[s:s + size]] = min(first[b[s:s + size]], order(i))
    out = []
    for i, t in some:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - size + 1):
            if first[b[s:s + size]] < order(i):
                gone[s:s + size] = b"\1" * size
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(g and not (j and gone[j - 1]) for j, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept))
    return sorted(out, key=str)


def run(docs, cut=substrings.Cut()):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept))
                   for r in substrings.remove_repeats(docs, cut).collect()), key=str)


@pytest.mark.parametrize("most", [300_000, 2])
def test_against_brute_force(spark, most):
    assert run(documents(spark), substrings.Cut(most=most)) == brute([r[:2] for r in rows(texts())])


def alike(seed):
    """Texts over few letters, put together from shared pieces of about the length of a string."""
    rng = random.Random(seed)
    pieces = ["".join(rng.choices("ab", k=rng.randint(30, 75))) for _ in range(8)] + ["a" * 60, "ab" * 30, " " * 55]
    return ["".join(rng.choices(pieces, k=rng.randint(1, 8))) + "".join(rng.choices("abc", k=rng.randint(0, 20))) for _ in range(40)]


@pytest.mark.parametrize("seed", range(4))
def test_shared_pieces(spark, seed):
    some = list(enumerate(alike(seed)))
    docs = spark.createDataFrame(some, "doc_id long, text string").repartition(4)
    assert run(docs) == brute(some)
    if seed < 2:
        assert run(docs, substrings.Cut(most=1)) == brute(some)


def test_long_texts_are_cut(spark, monkeypatch):
    monkeypatch.setattr(substrings, "PART", 700)
    some = list(enumerate(alike(9) + ["".join(alike(9)[:12]), "xyz" * 900]))
    assert run(spark.createDataFrame(some, "doc_id long, text string").repartition(2)) == brute(some)


def test_nothing(spark):
    assert run(nothing(spark)) == []


def test_many_rows_of_one_id(spark):
    # half of thousands of rows without an id, and of rows with one id, hold a string of an earlier document
    planted = "a string of sixty bytes that stands in the first document ok."
    rng = random.Random(3)
    some = [(1, planted)]
    for k in range(8000):
        own = "".join(rng.choices("abcdefghijklmnop", k=60))
        some.append((None if k % 2 else 5, own + (planted if k % 4 < 2 else "")))
    docs = spark.createDataFrame(some, "doc_id long, text string").repartition(4)
    found = run(docs)
    assert found == brute(some)
    assert sum(r[2] > 0 for r in found) == 4000


def test_text_ids(spark):
    some = [(f"d{i}", t) for i, t in enumerate(alike(2))] + [(None, alike(2)[3])]
    numbered = {name: k for k, name in enumerate(sorted(i for i, _ in some if i))}
    expected = brute([(None if i is None else numbered[i], t) for i, t in some])
    docs = spark.createDataFrame(some, "doc_id string, text string").repartition(3)
    assert sorted(((None if r[0] is None else numbered[r[0]], *r[1:]) for r in run(docs)), key=str) == expected
