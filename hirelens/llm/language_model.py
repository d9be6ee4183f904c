"""Language-model scores from a hashed maximum-entropy model.

A text is its words in lower case (A-Z) and an end. The `head` most frequent words have a number each; every other word, seen or
not, has a bucket by its hash, and buckets count as tokens. The probability of a word is that of its class given the two
tokens before, times that of the word in its class:

* class: a softmax over weights of the class itself, of the token before (bigram), of the one before that (skip), and of
  both together (trigram, hashed). Head words are in classes of equal size, the end in one of its own, all other words in `bands` classes by their hash;
* a head word: a softmax within the class over weights of the word and of the token before, hashed likewise;
* any other word: its smoothed share of the words of its class.

So every word has features, as a context and through its class. The number of buckets and the rows of the trigram table follow the
square root of the number of different words learnt from, so the model grows with the corpus.

The gradient of the likelihood is observed minus expected feature counts. Observed counts, and how often each context
occurs, are summed over all texts learnt from, once. Every update is then a Spark job over the table of different contexts:
tasks compute expected counts under the present weights, Spark adds them up, and the driver, which holds the weights only, moves
them along the gradient. Words, contexts and their counts stay in Spark.

Texts are scored in numpy batches, one softmax per different context of a batch. Counts of the most frequent words, at most `common`,
travel with the tasks; all others meet their counts in a join, so every word counts, however rare.

Nulls and empty texts are the end alone. Rows are scored one by one, so repeated rows get equal scores. If there is nothing to learn from, all
scores are those of an empty count table.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace
from itertools import repeat
from math import isqrt
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.llm.arrays import SALTS, SCHEMA, blocks, collected, summed
from hirelens.llm.base import Scratch

LOG10 = float(np.log(10))


@dataclass(frozen=True)
class Shape:
    """`head` words in classes of `size`; least number of buckets of other words (`tail`), and of rows of the trigram table; classes of
    other words (`bands`, which divides `tail`); rows of the word table; words whose counts travel; updates
    of the weights, their `ridge`, and the longest step of a weight in one update."""

    head: int = 1024
    size: int = 32
    tail: int = 64
    bands: int = 16
    trigrams: int = 512
    rows: int = 1024
    common: int = 100_000
    updates: int = 12
    ridge: float = 1.0
    stride: float = 1.0

    def grown(self, types: int) -> Shape:
        """The shape for so many different words: one bucket for every two of their square root, in powers of two, and eight trigram rows a bucket."""
        tail = max(self.tail, 1 << (max(isqrt(types) // 2, 1) - 1).bit_length())
        return replace(self, tail=tail, trigrams=max(self.trigrams, 8 * tail))

    @property
    def classes(self) -> int:
        """Classes of head words, then that of the end, then those of other words."""
        return self.head // self.size + 1 + self.bands

    @property
    def tokens(self) -> int:
        """Head words, the end, the place before a text, and the buckets of other words."""
        return self.head + 2 + self.tail

    @property
    def end(self) -> int:
        return self.head

    @property
    def begin(self) -> int:
        return self.head + 1


class Codes:
    """Numbers of the common words, by frequency from 0, and the token of every word: of common ones by a table, of any other by its hash."""

    def __init__(self, common: Iterable[bytes], shape: Shape) -> None:
        self.shape, self.number = shape, {w: i for i, w in enumerate(common)}
        # The place of number -1, for other words, is the last one.
        self.token = np.array([*[i if i < shape.head else self.bucket(w) for w, i in self.number.items()], 0], np.int64)

    def bucket(self, word: bytes) -> int:
        return self.shape.begin + 1 + crc32(word) % self.shape.tail

    def __getitem__(self, word: bytes) -> int:
        i = self.number.get(word)
        return self.bucket(word) if i is None else int(self.token[i])


def tokens_of(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def class_of(tokens: np.ndarray, shape: Shape) -> np.ndarray:
    """Class of every token; the band of a bucket is that of the words' hash, since `bands` divides `tail`."""
    words = shape.head // shape.size
    return np.where(tokens < shape.head, tokens // shape.size, np.where(tokens > shape.begin, words + 1 + (tokens - shape.begin - 1) % shape.bands, words))


def hashed(a: np.ndarray, b: np.ndarray | int, rows: int) -> np.ndarray:
    """Row of a hashed table for a pair of tokens."""
    with np.errstate(over="ignore"):
        x = (np.asarray(a).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.asarray(b).astype(np.uint64) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
        x ^= x >> np.uint64(29)
        return (x * np.uint64(0x165667B19E3779F9) >> np.uint64(33)).astype(np.int64) % rows


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


@dataclass
class Weights:
    """Tables by token or hashed row. `within` holds weights of head words, a row per hashed token before."""

    bias: np.ndarray
    bigram: np.ndarray
    skip: np.ndarray
    trigram: np.ndarray
    word: np.ndarray
    within: np.ndarray

    @staticmethod
    def zero(shape: Shape) -> Weights:
        return Weights(*[np.zeros(s, np.float32) for s in Weights.shapes(shape).values()])

    @staticmethod
    def shapes(shape: Shape) -> dict[str, tuple[int, ...]]:
        c = shape.classes
        return {"bias": (c,), "bigram": (shape.tokens, c), "skip": (shape.tokens, c), "trigram": (shape.trigrams, c),
                "word": (shape.head,), "within": (shape.rows, shape.head)}

    def logits(self, before2: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Logarithms of the class probabilities in contexts, but for a constant each."""
        return self.bias + self.bigram[before] + self.skip[before2] + self.trigram[hashed(before2, before, len(self.trigram))]

    def of_class(self, before2: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Class probabilities in contexts."""
        return softmax(self.logits(before2, before))

    def log_class(self, before2: np.ndarray, before: np.ndarray, k: np.ndarray, chunk: int = 8192) -> np.ndarray:
        """Logarithm of the probability of one class in each context. Every different context is summed up once, few at a time to stay in the cache."""
        tokens = len(self.bigram)
        pairs, place = np.unique(before2 * tokens + before, return_inverse=True)
        norm = np.empty(len(pairs))
        for i in range(0, len(pairs), chunk):
            x = self.logits(pairs[i:i + chunk] // tokens, pairs[i:i + chunk] % tokens)
            top = x.max(axis=1)
            np.exp(np.subtract(x, top[:, None], out=x), out=x)
            norm[i:i + chunk] = top + np.log(x.sum(axis=1))
        row = hashed(before2, before, len(self.trigram))
        return self.bias[k] + self.bigram[before, k] + self.skip[before2, k] + self.trigram[row, k] - norm[place]

    def of_word(self, rows: np.ndarray, size: int) -> np.ndarray:
        """Probabilities of head words within their class, for rows of the word table."""
        return softmax((self.word + self.within[rows]).reshape(len(rows), -1, size)).reshape(len(rows), -1)


@dataclass(frozen=True)
class Lines:
    """Many texts in one row: each token with the one before it and the one before that; words by text. A word's number is -1 if it is not common."""

    now: np.ndarray
    before: np.ndarray
    before2: np.ndarray
    sizes: np.ndarray
    numbers: np.ndarray
    of: np.ndarray
    others: list[tuple[int, bytes]]


def sequences(texts: list[bytes | None], codes: Codes) -> Lines:
    """Every word is looked up once; all else is done on arrays."""
    words: list[bytes] = []
    sizes = np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        ws = tokens_of(t)
        words += ws
        sizes[i] = len(ws)
    numbers = np.fromiter(map(codes.number.get, words, repeat(-1)), np.int64, len(words))
    tokens, of = codes.token[numbers], np.repeat(np.arange(len(texts)), sizes)
    rare = np.flatnonzero(numbers < 0)
    others = [words[i] for i in rare.tolist()]
    tokens[rare] = np.fromiter(map(codes.bucket, others), np.int64, len(others))
    # Two places before each text, and its end.
    every = np.full(len(words) + 3 * len(texts), codes.shape.begin, np.int64)
    ends = np.cumsum(sizes + 3) - 1
    every[np.arange(len(words)) + 3 * of + 2] = tokens
    every[ends] = codes.shape.end
    real = np.ones(len(every), bool)
    real[ends - sizes - 2] = real[ends - sizes - 1] = False
    at = np.flatnonzero(real)
    return Lines(every[at], every[at - 1], every[at - 2], sizes, numbers, of, list(zip(of[rare].tolist(), others)))


def portions(texts: list[bytes | None], most: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Stretches of texts of about `most` bytes."""
    begin = size = 0
    for i, t in enumerate(texts):
        size += len(t or b"")
        if size > most:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


# Counting -------------------------------------------------------------------------------------------------


def count_words(docs: DataFrame) -> DataFrame:
    """Every word with its number; one row per document adds its end, under a null word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for a, b in portions(texts, 32_000_000):
                counts: Counter = Counter()
                for t in texts[a:b]:
                    counts.update(tokens_of(t))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([None, *counts], pa.binary()), pa.array([b - a, *counts.values()], pa.int64())], ["word", "n"])

    texts = docs.select(F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Counts:
    """Total tokens and different ones; frequent words with their counts, most frequent first; for each band of the words outside
    the head, their total and how many are different."""

    total: int
    types: int
    ends: int
    common: dict[bytes, int]
    other: list[int]
    other_types: list[int]


def frequent(counts: DataFrame, shape: Shape) -> Counts:
    """The `common` most frequent words, ties in the order of their bytes; their least count is found on a scale of 16 steps per doubling."""
    words = counts.filter("word is not null")
    step = F.floor(F.log2("n") * 16).cast("int")
    scale = words.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n")).orderBy(F.desc("step")).collect()
    reached, least, cut = 0, 1 << 30, None
    for r in scale:
        if reached + r.k > shape.common:
            cut = r.step
            break
        reached, least = reached + r.k, r.step
    ends = next((r.n for r in counts.filter("word is null").collect()), 0)
    rows = words.filter(step >= least).collect()  # at most `common`
    if cut is not None:  # the rest from the step that does not fit as a whole
        rows += words.filter(step == cut).orderBy(F.desc("n"), "word").limit(shape.common - reached).collect()
    common = dict(sorted(((bytes(r.word), r.n) for r in rows), key=lambda x: (-x[1], x[0])))
    of_words, types = sum(r.n for r in scale), sum(r.k for r in scale)
    other, other_types = [0] * shape.bands, [0] * shape.bands
    for r in words.groupBy(_band(shape).alias("band")).agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n")).collect():
        other[r.band], other_types[r.band] = r.n, r.k
    for w in list(common)[:shape.head]:
        other[crc32(w) % shape.bands] -= common[w]
        other_types[crc32(w) % shape.bands] -= 1
    return Counts(of_words + ends, types + (ends > 0), ends, common, other, other_types)


def _band(shape: Shape) -> Column:
    return (F.crc32("word") % shape.bands).cast("int")


#: Rows of sums as in `arrays`, or a context and how often it occurs.
OBSERVED = f"{SCHEMA}, at long, times long"
_CONTEXTS = pa.schema([("name", pa.string()), ("block", pa.int32()), ("salt", pa.int32()), ("n", pa.list_(pa.float64())), ("at", pa.int64()), ("times", pa.int64())])


def observed(docs: DataFrame, seen: Counts, shape: Shape, scratch: Scratch) -> tuple[dict[str, np.ndarray], DataFrame]:
    """Feature counts over all texts, summed by Spark to arrays of the shape's size, and the table (at, n) of different contexts."""
    t, c, common = shape.tokens, shape.classes, docs.sparkSession.sparkContext.broadcast(list(seen.common))
    sizes = {k: s for k, s in Weights.shapes(shape).items() if k not in ("bias", "word")}

    def merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        if len(held) == 1:
            return held[0]
        at, n = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(at, kind="stable")  # quick on sorted runs
        at = at[order]
        begins = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        return at[begins], np.add.reduceat(n[order], begins)

    def rows(at: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(at), 100_000):
            k = len(at[i:i + 100_000])
            yield pa.RecordBatch.from_arrays([*[pa.nulls(k, f.type) for f in list(_CONTEXTS)[:4]], pa.array(at[i:i + k]), pa.array(n[i:i + k])], schema=_CONTEXTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Codes(common.value, shape)
        sums = {name: np.zeros(int(np.prod(size))) for name, size in sizes.items()}
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for a, b in portions(texts):
                lines = sequences(texts[a:b], codes)
                now, before, before2 = lines.now, lines.before, lines.before2
                k, head = class_of(now, shape), now < shape.head
                for name, at in (("bigram", before * c + k), ("skip", before2 * c + k), ("trigram", hashed(before2, before, shape.trigrams) * c + k),
                                 ("within", hashed(before[head], 0, shape.rows) * shape.head + now[head])):
                    sums[name] += np.bincount(at, minlength=len(sums[name]))
                held.append(np.unique(before2 * t + before, return_counts=True))
                if sum(len(at) for at, _ in held) > 4_000_000:
                    held = [merged(held)]
                    if len(held[0][0]) > 2_000_000:
                        yield from rows(*held.pop())
        if held:
            yield from rows(*merged(held))
        salt = TaskContext.get().partitionId() % SALTS
        for name, values in sums.items():
            for made in blocks(name, values, salt):
                nulls = pa.nulls(made.num_rows, pa.int64())
                yield pa.RecordBatch.from_arrays([*made.columns, nulls, nulls], schema=_CONTEXTS)

    # Several splits a task, so that their sums meet before they are written.
    texts = docs.select(F.col("text").cast("binary").alias("text"))
    most = max(4 * docs.sparkSession.sparkContext.defaultParallelism, texts.rdd.getNumPartitions() // 8)
    made = scratch.keep(texts.coalesce(most).mapInArrow(run, OBSERVED), "observed")
    added = scratch.keep(summed(made.filter("name is not null").drop("at", "times"), most), "sums")
    contexts = scratch.keep(made.filter("name is null").groupBy("at").agg(F.sum("times").alias("n")), "contexts")
    sums = collected(added, sizes)
    scratch.drop("observed", "sums")
    return sums, contexts


# Training -------------------------------------------------------------------------------------------------


def train(scratch: Scratch, seen: dict[str, np.ndarray], contexts: DataFrame, shape: Shape) -> Weights:
    """Move the weights along the gradient, whose expected counts Spark sums over the different contexts."""
    spark, sizes = scratch.spark, Weights.shapes(shape)
    target = seen | {"bias": seen["bigram"].sum(axis=0), "word": seen["within"].sum(axis=0)}
    weights = Weights.zero(shape)
    tasks = spark.sparkContext.defaultParallelism  # each adds up arrays of its own
    contexts = contexts.coalesce(tasks)
    for _ in range(shape.updates if target["bias"].any() else 0):
        sent = spark.sparkContext.broadcast(dict(vars(weights)))  # arrays only, so workers need no copy of this package
        expected = collected(summed(contexts.mapInArrow(_expected(sent, shape), SCHEMA), tasks), {k: sizes[k] for k in ("bias", "bigram", "skip", "trigram")})
        sent.unpersist()
        # The word table needs no contexts: how often each class follows a row is known.
        p = weights.of_word(np.arange(shape.rows), shape.size)
        mass = seen["within"].reshape(shape.rows, -1, shape.size).sum(axis=2).repeat(shape.size, axis=1)
        expected |= {"within": p * mass, "word": (p * mass).sum(axis=0)}
        for name in sizes:
            w = getattr(weights, name)
            gradient = target[name] - expected[name] - shape.ridge * w
            features = 2 if name in ("word", "within") else 4
            w += np.clip(gradient / (features * (expected[name] + shape.ridge)), -shape.stride, shape.stride).astype(np.float32)
    return weights


def _expected(sent, shape: Shape):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, sums = Weights(**sent.value), None
        for batch in batches:
            if sums is None:
                sums = {k: np.zeros(s) for k, s in Weights.shapes(shape).items() if k not in ("word", "within")}
            at, n = batch.column(0).to_numpy(), batch.column(1).to_numpy().astype(np.float32)
            before2, before = at // shape.tokens, at % shape.tokens
            p = w.of_class(before2, before)
            p *= n[:, None]
            sums["bias"] += p.sum(axis=0)
            for name, rows in (("bigram", before), ("skip", before2), ("trigram", hashed(before2, before, shape.trigrams))):
                order = np.argsort(rows, kind="stable")
                keys = rows[order]
                begins = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
                sums[name][keys[begins]] += np.add.reduceat(p[order], begins, axis=0)
        for name, values in (sums or {}).items():
            yield from blocks(name, values, TaskContext.get().partitionId() % SALTS)

    return run


# Scoring --------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    shape: Shape
    counts: Counts
    weights: Weights


SCORED = "row long, doc_id {kind}, n_tokens long, n_known long, base_score double, score double, word binary, times long"


def score(docs: DataFrame, model: Model, counts: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    # At most `common` words and the weights, as plain values and arrays.
    sent = docs.sparkSession.sparkContext.broadcast([dict(vars(part)) for part in (model.shape, model.counts, model.weights)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*(kind(**part) for kind, part in zip((Shape, Counts, Weights), sent.value)))
        shape, seen, codes = model.shape, model.counts, Codes(model.counts.common, model.shape)
        # By the number of a word; the last place is for words that are not common and get their share in the join.
        n = np.array([*seen.common.values(), 0], float)
        base_of = np.log10((n + 0.5) / (seen.total + 0.5 * (seen.types + 1)))
        base_end = float(np.log10((seen.ends + 0.5) / (seen.total + 0.5 * (seen.types + 1))))
        norms = np.array([of + 0.5 * (types + 1) for of, types in zip(seen.other, seen.other_types)])
        other_of = np.log10((n + 0.5) / norms[[*[crc32(w) % shape.bands for w in seen.common], 0]])
        base_of[-1] = other_of[-1] = 0
        other_of[:min(shape.head, len(seen.common))] = 0
        with np.errstate(divide="ignore"):
            within = np.log10(model.weights.of_word(np.arange(shape.rows), shape.size))
        row_of = hashed(np.arange(shape.tokens), 0, shape.rows)
        row = TaskContext.get().partitionId() << 40

        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for a, b in portions(texts):
                lines, n = sequences(texts[a:b], codes), b - a
                now, before = lines.now, lines.before
                total = model.weights.log_class(lines.before2, before, class_of(now, shape)) / LOG10
                head = now < shape.head
                total[head] += within[row_of[before[head]], now[head]]
                sizes, of = lines.sizes + 1, lines.of
                scores = np.add.reduceat(total, np.cumsum(sizes) - sizes) + np.bincount(of, other_of[lines.numbers], n)
                bases = base_end + np.bincount(of, base_of[lines.numbers], n)
                known = np.bincount(of[lines.numbers >= 0], minlength=n) + int(seen.ends > 0)
                rare = [(row + i, w, times) for (i, w), times in Counter(lines.others).items()]
                m = len(rare)
                none = lambda k, t: pa.nulls(k, t)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.arange(row, row + n)), ids.slice(a, n), pa.array(sizes, pa.int64()), pa.array(known, pa.int64()), pa.array(bases),
                    pa.array(scores), none(n, pa.binary()), none(n, pa.int64())], names=NAMES)
                for c in range(0, m, 200_000):
                    part = rare[c:c + 200_000]
                    k = len(part)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([x[0] for x in part], pa.int64()), none(k, ids.type), none(k, pa.int64()), none(k, pa.int64()), none(k, pa.float64()),
                        none(k, pa.float64()), pa.array([x[1] for x in part], pa.binary()), pa.array([x[2] for x in part], pa.int64())], names=NAMES)
                row += n

    made = scratch.keep(docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, SCORED.format(kind=kind)), "scored")
    c = model.counts
    least = min(c.common.values(), default=0)
    times, n = F.col("times"), F.coalesce(F.col("n"), F.lit(0))
    log = lambda of, types: F.log10((n + 0.5) / (of + 0.5 * (types + 1)))
    in_band = lambda numbers: F.get(F.lit(numbers).cast("array<long>"), _band(model.shape))
    rare = made.filter("word is not null").select("row", "word", "times").join(
        counts.filter(F.col("word").isNotNull() & (F.col("n") <= least if c.common else F.lit(True))), "word", "left")
    added = rare.groupBy("row").agg(
        F.sum(times * log(c.total, c.types)).alias("more_base"), F.sum(times * log(in_band(c.other), in_band(c.other_types))).alias("more"),
        F.sum(F.when(n > 0, times).otherwise(0)).alias("more_known"))
    rows = made.filter("word is null").drop("word", "times")
    zero = F.lit(0)
    return rows.join(added, "row", "left").select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("more_known", zero)).alias("n_known"),
        (F.col("base_score") + F.coalesce("more_base", zero)).alias("base_score"), (F.col("score") + F.coalesce("more", zero)).alias("score"))


NAMES = [x.split()[0] for x in SCORED.split(", ")]


def fit(docs: DataFrame, scratch: Scratch, shape: Shape = Shape()) -> tuple[Model, DataFrame]:
    """Learn from all texts of `docs`; comes with the counts of all words."""
    counts = scratch.keep(count_words(docs), "counts")
    seen = frequent(counts, shape)
    shape = shape.grown(seen.types)
    return Model(shape, seen, train(scratch, *observed(docs, seen, shape, scratch), shape)), counts


def score_all(docs: DataFrame, learnt: Column, shape: Shape = Shape()) -> DataFrame:
    """Learn from the rows where `learnt` holds and score all rows. `train_tokens` is the number of tokens learnt from."""
    scratch = Scratch(docs.sparkSession, "language-model")
    model, counts = fit(docs.filter(learnt), scratch, shape)
    scored = score(docs, model, counts, scratch).withColumn("train_tokens", F.lit(model.counts.total).cast("long"))
    return scratch.finish(scored)
