import os
import subprocess
import sys
from collections import Counter
from math import log10
from pathlib import Path
from zlib import crc32

import numpy as np
import pytest
from fixtures import documents, nothing, rows, texts
from pyspark.sql import functions as F

from hirelens.llm import arrays, language_model as lm
from hirelens.llm.base import Scratch

SMALL = lm.Shape(head=32, size=8, trigrams=64, rows=16, common=40, updates=6)


def tokens(text):
    return (text or "").encode().lower().split()


def base(some, learnt):
    counts = Counter(w for i, t in some if learnt(i) for w in [*tokens(t), None])
    n, v = sum(counts.values()), len(counts)
    score = lambda t: sum(log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in [*tokens(t), None])
    return n, {i: (len(tokens(t)) + 1, sum(counts[w] > 0 for w in [*tokens(t), None]), score(t)) for i, t in some}


@pytest.mark.parametrize("common", [100_000, 40, 0])
def test_base_scores(spark, common):
    some = [(r[0], r[1]) for r in rows(texts())]
    found = lm.score_all(documents(spark), F.col("doc_id") % 3 > 0, lm.Shape(head=32, size=8, trigrams=64, rows=16, common=common, updates=2)).collect()
    n, wanted = base(some, lambda i: i is not None and i % 3 > 0)
    assert len(found) == len(some)
    for r in found:
        size, known, score = wanted[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (size, known, n)
        assert r.base_score == pytest.approx(score, rel=1e-9)
        assert np.isfinite(r.score) and r.score < 0


def test_probabilities_add_up_to_one(spark):
    """Over all outcomes that may follow two tokens, words outside the head and unseen ones included."""
    scratch = Scratch(spark, "test")
    docs = documents(spark).filter("doc_id is not null")
    model, counts = lm.fit(docs, scratch, SMALL)
    every = {bytes(r.word): r.n for r in counts.filter("word is not null").collect()}
    before = [b"the of", b"zz the", b"of zz"]
    ends = {c: s for c, s in zip(before, _scores(spark, before, model, counts, scratch))}
    for c in before:
        # A text that goes on with w and ends: P(w) P(end | ..); take P(end) away by scoring it.
        two = _steps(model, c, every)
        assert sum(two) == pytest.approx(1, abs=1e-6)
        assert ends[c] < 0


def _scores(spark, some, model, counts, scratch):
    df = spark.createDataFrame([(i, t.decode()) for i, t in enumerate(some)], "doc_id long, text string")
    return [r.score for r in lm.score(df, model, counts, Scratch(spark, "test")).orderBy("doc_id").collect()]


def _steps(model, context, every):
    """Probability of each word, of an unseen one in each band, and of the end after a context."""
    shape, c = model.shape, model.counts
    codes = lm.Codes(c.common, shape)
    ids = [codes[w] for w in context.split()]
    of_class = model.weights.of_class(np.array([ids[-2]]), np.array([ids[-1]]))[0].astype(float)
    within = model.weights.of_word(lm.hashed(np.array([ids[-1]]), 0, shape.rows), shape.size)[0].astype(float)
    k = shape.head // shape.size
    out = [of_class[k]] + [of_class[i // shape.size] * within[i] for i in range(shape.head)]
    tail = [w for w in every if codes[w] > shape.begin]
    norm = [n + 0.5 * (types + 1) for n, types in zip(c.other, c.other_types)]
    assert len(tail) == len(every) - shape.head == sum(c.other_types)
    out += [of_class[k + 1 + crc32(w) % shape.bands] * (every[w] + 0.5) / norm[crc32(w) % shape.bands] for w in tail]
    return out + [of_class[k + 1 + band] * 0.5 / norm[band] for band in range(shape.bands)]


def test_training_beats_the_base_on_held_out_text(spark):
    rng = np.random.default_rng(1)
    some = []
    for i in range(300):  # every word follows from the one before
        w, out = int(rng.integers(30)), []
        for _ in range(60):
            out.append(f"w{w}")
            w = (3 * w + int(rng.integers(3))) % 30
        some.append((i, " ".join(out)))
    docs = spark.createDataFrame(some, "doc_id long, text string")
    shape = lm.Shape(head=32, size=8, trigrams=256, rows=64, common=100, updates=15)
    found = [r for r in lm.score_all(docs, F.col("doc_id") % 5 != 1, shape).collect() if r.doc_id % 5 == 1]
    mean = lambda name: sum(r[name] for r in found) / sum(r.n_tokens for r in found)
    assert mean("base_score") < -1.3 and mean("score") > -0.75  # three equally likely words: -0.48


def test_sums(spark):
    def run(batches):
        from pyspark import TaskContext

        for _ in batches:
            pass
        p = TaskContext.get().partitionId()
        yield from arrays.blocks("a", np.arange(10_000) * (p + 1), p)
        yield from arrays.blocks("b", np.array([p]), p)

    made = arrays.summed(spark.range(100).repartition(5).mapInArrow(run, arrays.SCHEMA))
    out = arrays.collected(made, {"a": (100, 100), "b": (1,)})
    assert (out["a"].ravel() == np.arange(10_000) * 15).all() and out["b"][0] == 10


def test_awkward_tables(spark):
    found = lm.score_all(documents(spark), F.lit(False), SMALL).collect()
    assert {r.train_tokens for r in found} == {0} and all(r.n_known == 0 for r in found)
    assert all(r.base_score == pytest.approx(0) for r in found)
    assert lm.score_all(nothing(spark), F.lit(True), SMALL).count() == 0


def test_equal_counts_fill_the_head(spark):
    docs = spark.createDataFrame([(" ".join(f"w{i:02d}" for i in range(60)) + " top top",)], "text string")
    counts = lm.count_words(docs)
    seen = lm.frequent(counts, lm.Shape(head=32, size=8, trigrams=64, rows=16, common=50, updates=1))
    assert list(seen.common) == [b"top", *(f"w{i:02d}".encode() for i in range(49))]
    assert (seen.total, seen.types, sum(seen.other_types), sum(seen.other)) == (63, 62, 61 - 32, 62 - 33)
    assert len(lm.frequent(counts, SMALL).common) == 40


def plain_counts(some, codes, shape):
    """Feature and context counts of all tokens, one by one."""
    out = {name: Counter() for name in ("bigram", "skip", "trigram", "within", "contexts")}
    for text in some:
        line = [shape.begin, shape.begin, *[codes[w] for w in tokens(text)], shape.end]
        for before2, before, now in zip(line, line[1:], line[2:]):
            k = int(lm.class_of(np.array(now), shape))
            out["bigram"][before, k] += 1
            out["skip"][before2, k] += 1
            out["trigram"][int(lm.hashed(np.array(before2), np.array(before), shape.trigrams)), k] += 1
            out["contexts"][before2, before] += 1
            if now < shape.head:
                out["within"][int(lm.hashed(np.array(before), 0, shape.rows)), now] += 1
    return out


def test_counts_and_weights_equal_plain_ones(spark):
    """Observed counts by counting, weights by the same updates over every context in plain numpy, scores token by token."""
    docs = documents(spark).filter("doc_id is not null")
    some = [(r.doc_id, r.text) for r in docs.collect()]
    scratch = Scratch(spark, "test")
    counts = lm.count_words(docs)
    seen = lm.frequent(counts, SMALL)
    shape = SMALL.grown(seen.types)
    codes = lm.Codes(seen.common, shape)
    sums, contexts = lm.observed(docs, seen, shape, scratch)
    wanted = plain_counts([t for _, t in some], codes, shape)
    assert {(r["at"] // shape.tokens, r["at"] % shape.tokens): r.n for r in contexts.collect()} == wanted["contexts"]
    for name, values in sums.items():
        assert {tuple(map(int, at)): values[tuple(at)] for at in np.argwhere(values)} == wanted[name]

    weights = lm.train(scratch, sums, contexts, shape)
    plain = lm.Weights.zero(shape)
    for _ in range(shape.updates):
        expected = {k: np.zeros(s) for k, s in lm.Weights.shapes(shape).items()}
        for (before2, before), n in wanted["contexts"].items():
            p = n * plain.of_class(np.array([before2]), np.array([before]))[0]
            row = int(lm.hashed(np.array(before2), np.array(before), shape.trigrams))
            for name, at in (("bias", ...), ("bigram", before), ("skip", before2), ("trigram", row)):
                expected[name][at] += p
        for row in range(shape.rows):
            mass = sums["within"][row].reshape(-1, shape.size).sum(axis=1).repeat(shape.size)
            expected["within"][row] = plain.of_word(np.array([row]), shape.size)[0] * mass
        expected["word"] = expected["within"].sum(axis=0)
        target = sums | {"bias": sums["bigram"].sum(axis=0), "word": sums["within"].sum(axis=0)}
        for name, e in expected.items():
            w = getattr(plain, name)
            step = (target[name] - e - shape.ridge * w) / ((2 if name in ("word", "within") else 4) * (e + shape.ridge))
            w += np.clip(step, -shape.stride, shape.stride).astype(np.float32)
    for name in expected:
        assert np.allclose(getattr(weights, name), getattr(plain, name), atol=1e-3)

    every = {bytes(r.word): r.n for r in counts.filter("word is not null").collect()}
    model = lm.Model(shape, seen, weights)
    found = {r.doc_id: r.score for r in lm.score(docs, model, counts, scratch).collect()}
    for i, t in some:
        assert found[i] == pytest.approx(plain_score(t, model, every), rel=1e-5)


def plain_score(text, model, every):
    shape, seen, codes = model.shape, model.counts, lm.Codes(model.counts.common, model.shape)
    line, out = [shape.begin, shape.begin], 0.0
    for w in [*tokens(text), None]:
        now = shape.end if w is None else codes[w]
        k = int(lm.class_of(np.array(now), shape))
        p = float(model.weights.of_class(np.array([line[-2]]), np.array([line[-1]]))[0][k])
        if now < shape.head:
            p *= float(model.weights.of_word(lm.hashed(np.array([line[-1]]), 0, shape.rows), shape.size)[0][now])
        elif now > shape.begin:
            band = crc32(w) % shape.bands
            p *= (every.get(w, 0) + 0.5) / (seen.other[band] + 0.5 * (seen.other_types[band] + 1))
        out += log10(p)
        line.append(now)
    return out


def test_the_model_grows_with_the_vocabulary():
    shape = lm.Shape()
    small, large, huge = (shape.grown(n) for n in (1_000_000, 16_000_000, 1_000_000_000))
    assert (small.tail, large.tail, huge.tail) == (512, 2048, 16384) and shape.grown(0).tail == 64
    assert huge.trigrams == 8 * huge.tail and all(s.tail % s.bands == 0 for s in (small, large, huge))


def test_rare_words_are_contexts(spark):
    """After a word far outside the head its own follower is likelier than another word of the same count."""
    rng = np.random.default_rng(2)
    # Pairs (ri, si): s follows r wherever it occurs, but all are rarer than the head.
    fill = [f"f{i}" for i in range(32)]
    some = []
    for i in range(400):
        out = []
        for _ in range(15):
            out += [str(rng.choice(fill)) for _ in range(6)] + [f"r{(k := int(rng.integers(60)))}", f"s{k}"]
        some.append((i, " ".join(out)))
    docs = spark.createDataFrame(some, "doc_id long, text string")
    shape = lm.Shape(head=32, size=8, tail=256, bands=16, trigrams=2048, rows=64, common=200, updates=15)
    scratch = Scratch(spark, "test")
    model, counts = lm.fit(docs, scratch, shape)
    asked = spark.createDataFrame([(k, f"f1 r{k} s{k}") for k in range(60)] + [(100 + k, f"f1 r{k} s{(k + 7) % 60}") for k in range(60)], "doc_id long, text string")
    found = {r.doc_id: r.score for r in lm.score(asked, model, counts, scratch).collect()}
    better = sum(found[k] > found[100 + k] + 0.3 for k in range(60))
    assert better >= 45


ELSEWHERE = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession, functions as F
from hirelens.llm import language_model as lm
spark = (SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").getOrCreate())
docs = spark.createDataFrame([(i, "a b c a b d e " * (i + 1)) for i in range(10)], "doc_id long, text string")
shape = lm.Shape(head=8, size=4, trigrams=16, rows=8, common=3, updates=2)
print("rows:", lm.score_all(docs, F.col("doc_id") > 2, shape).filter("score < 0").count())
"""


def test_workers_need_no_copy_of_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    (tmp_path / "run.py").write_text(ELSEWHERE.format(repo=str(Path(__file__).resolve().parents[2])))
    done = subprocess.run([sys.executable, "run.py"], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert "rows: 10" in done.stdout, done.stderr[-3000:]
