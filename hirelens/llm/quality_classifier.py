"""Quality classifier: histogram gradient-boosted trees over statistics of a document.

One pass over the whole texts turns each into a row of numbers. The trees are fitted to a bounded sample of labelled rows:
values are binned by quantiles, and every level of a tree is grown from histograms of gradients and
curvatures of the logistic loss. The fitted forest is flattened into arrays (feature, bin and leaf value by place in a
complete tree), so a batch of rows walks down all of them with numpy indexing.

Nulls and empty texts have statistics like any text (all zero) and get a score. Labels that are null are left
out; with labels of one kind only, or none, every score is the smoothed share of good labels. A document
row counts once for every label row with its id. Repeated rows are scored alike.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.llm.base import Scratch

SYMBOLS = "#*$%&|<>"
NAMES = (
    "words chars word_length long_words different top_word next_equal symbols symbol_words bars shouts capitals capital_words "
    "digits stops other_ascii beyond_ascii lines line_words short_lines dup_lines junk_lines mixed_lines longest_run").split()


@dataclass(frozen=True)
class Fit:
    """At most about `rows` labelled rows are learnt from. `trees` of `depth` levels over `bins` bins a feature;
    `rate` scales each tree, `ridge` smooths leaf values, and a leaf holds at least `least` curvature."""

    rows: int = 30_000
    trees: int = 80
    depth: int = 4
    bins: int = 64
    rate: float = 0.15
    ridge: float = 1.0
    least: float = 2.0


def statistics(text: str | None) -> list[float]:
    """The numbers of NAMES for a text."""
    t = text or ""
    ws = t.split()
    n, length = max(len(ws), 1), max(len(t), 1)
    counts = Counter(ws)
    sizes = [len(w) for w in ws]
    chars = max(sum(sizes), 1)
    symbols = sum(map(t.count, SYMBOLS))
    upper = len(UPPER.findall(t))
    lines = [x for x in t.split("\n") if x and not x.isspace()]
    n_lines = max(len(lines), 1)
    junk = mixed = short = 0
    for line in lines:
        marks = sum(map(line.count, "#*$%&|!"))
        spaces = line.count(" ") + 1
        short += spaces < 4
        junk += 2 * marks > spaces
        mixed += marks > 0
    run = best = 1
    same = 0
    for a, b in zip(ws, ws[1:]):
        if a == b:
            run += 1
            same += 1
            best = max(best, run)
        else:
            run = 1
    return [
        np.log1p(len(ws)), np.log1p(len(t)), chars / n, sum(s > 20 for s in sizes) / n, len(counts) / n,
        max(counts.values(), default=0) / n, same / n, symbols / n, len(SYMBOL_END.findall(t)) / n, t.count("|") / n,
        t.count("!") / n, upper / chars, sum(map(str.isupper, ws)) / n, len(DIGITS.findall(t)) / chars,
        sum(map(t.count, ".,;:")) / n, len(OTHER.findall(t)) / chars, (len(t.encode()) - len(t)) / length, np.log1p(len(lines)),
        np.log1p(n / n_lines), short / n_lines, 1 - len(set(lines)) / n_lines if lines else 0.0, junk / n_lines, mixed / n_lines,
        best / n]


UPPER, DIGITS = re.compile("[A-Z]"), re.compile("[0-9]")
SYMBOL_END = re.compile(r"[#*$%&|!](?=\s|$)")
OTHER = re.compile(r"[\"'()\[\]{}=/\\_@^~`?-]")


def with_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and `x`, the statistics of the text, for every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([statistics(t) for t in batch.column(1).to_pylist()], np.float32).reshape(-1, len(NAMES))
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(0, x.size + 1, len(NAMES), dtype=np.int32)), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["doc_id", "x"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, x array<float>")


@dataclass(frozen=True)
class Forest:
    """Trees by place: node k has children 2k + 1 (bin at most `bin`) and 2k + 2. `edges` are the upper ends of a feature's bins."""

    edges: list[np.ndarray]
    feature: np.ndarray  # tree by inner node
    bin: np.ndarray
    leaf: np.ndarray  # tree by leaf
    start: float

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k]) for k, e in enumerate(self.edges)], axis=1).astype(np.uint8)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1."""
        b, total, rows = self.binned(x), np.full(len(x), self.start), np.arange(len(x))
        for feature, threshold, leaf in zip(self.feature, self.bin, self.leaf):
            node = np.zeros(len(x), np.int64)
            while True:
                if node[0] >= len(feature):
                    break
                node = 2 * node + 1 + (b[rows, feature[node]] > threshold[node])
            total += leaf[node - len(feature)]
        return 1 / (1 + np.exp(-total))


def grow(x: np.ndarray, y: np.ndarray, how: Fit = Fit()) -> Forest:
    """Fit a forest to rows x and labels y (0 or 1)."""
    share = (y.sum() + 1) / (len(y) + 2)
    start, inner = float(np.log(share / (1 - share))), 2 ** how.depth - 1
    if len(np.unique(y)) < 2:
        return Forest([np.zeros(0)] * x.shape[1], np.zeros((0, inner), int), np.zeros((0, inner), int), np.zeros((0, inner + 1)), start)
    cuts = np.linspace(0, 1, how.bins + 1)[1:-1]
    edges = [np.unique(np.quantile(x[:, k], cuts).astype(np.float32)) for k in range(x.shape[1])]
    forest = Forest(edges, np.zeros((how.trees, inner), int), np.full((how.trees, inner), how.bins), np.zeros((how.trees, inner + 1)), start)
    b, total, rows = forest.binned(x), np.full(len(y), start), np.arange(len(y))
    for t in range(how.trees):
        p = 1 / (1 + np.exp(-total))
        g, h = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for level in range(how.depth):
            first, width = 2 ** level - 1, 2 ** level
            best = np.zeros(width)
            for f in range(x.shape[1]):
                place = (node - first) * how.bins + b[:, f]
                left_g = np.bincount(place, g, width * how.bins).reshape(width, -1).cumsum(axis=1)
                left_h = np.bincount(place, h, width * how.bins).reshape(width, -1).cumsum(axis=1)
                all_g, all_h = left_g[:, -1:], left_h[:, -1:]
                right_g, right_h = all_g - left_g, all_h - left_h
                gain = (left_g ** 2 / (left_h + how.ridge) + right_g ** 2 / (right_h + how.ridge) - all_g ** 2 / (all_h + how.ridge))
                gain[(left_h < how.least) | (right_h < how.least)] = 0
                at = gain.argmax(axis=1)
                top = gain[np.arange(width), at]
                better = np.flatnonzero(top > best + 1e-9)
                best[better] = top[better]
                forest.feature[t, first + better], forest.bin[t, first + better] = f, at[better]
            node = 2 * node + 1 + (b[rows, forest.feature[t, node]] > forest.bin[t, node])
        leaf = node - inner
        value = -np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + how.ridge) * how.rate
        forest.leaf[t] = value
        total += value[leaf]
    return forest


def fit(measured: DataFrame, labels: DataFrame, how: Fit = Fit()) -> Forest:
    """Learn from measured documents that have a label; which of them is drawn by a hash of the id."""
    marked = measured.join(labels.filter(F.col("quality").isNotNull()).select(
        F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("y")), F.col("doc_id") == F.col("_id"))
    n = marked.count()
    share = min(1.0, how.rows / max(n, 1))
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30))
    sample = marked.filter(drawn).select("x", "y", "doc_id").orderBy("doc_id", "y").toArrow()  # bounded by how.rows
    x = np.array(sample.column("x").to_pylist(), np.float32).reshape(-1, len(NAMES))
    return grow(x, np.array(sample.column("y").to_pylist(), float), how)


def classify(docs: DataFrame, labels: DataFrame, learnt: Column, how: Fit = Fit()) -> DataFrame:
    """doc_id and score of every row; labels of the rows where `learnt`, a condition on doc_id, holds are used."""
    scratch = Scratch(docs.sparkSession, "quality-classifier")
    measured = scratch.keep(with_statistics(docs), "measured")
    forest = fit(measured.filter(learnt), labels, how)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray(batch.column(1).flatten()).reshape(-1, len(NAMES))
            scores = forest.scores(x) if len(x) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], ["doc_id", "score"])

    return measured.mapInArrow(run, f"doc_id {kind}, score double")
