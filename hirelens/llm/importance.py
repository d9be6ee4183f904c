"""Draw the documents that look most like a target set: hashed n-gram importance weights and Gumbel top-k.

1. Counts. Every text is cut into words; runs of 1 to `longest` words are features, hashed into buckets. The
   buckets of all documents and of all target texts are counted by tasks and added up by Spark.
2. Weights. The gain of a bucket is the log ratio of its smoothed shares. The gains are one array, whose size is a
   parameter; a document's weight is a sum over that array at its features' buckets.
3. Draw. Gumbel noise from a hash of the id is added, and the highest scores are a sample without replacement. The cutoff
   is bracketed by a quantile sketch; exact counts outside the bracket show whether it holds the cutoff, else it is
   widened; only the scores in the bracket are sorted to find the cutoff.

Nulls, empty texts and texts without words have no features and the weight 0. Texts of any length are read
whole, a stretch at a time. Repeated rows are drawn each by itself; equal scores go to the smaller id (a null id
comes last), then to the fewer features, then to the lower weight. Empty tables give empty results, and an empty target or an
empty corpus gives the ratio of the smoothing alone. Other columns of the documents are left alone, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.llm.base import Scratch
from hirelens.llm.ordering import positions

#: Digits and lower-case letters stay, A-Z are lower-cased, everything else of ASCII parts words.
_PLAIN = bytes(b if b >= 128 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256))
STRETCH = 1 << 20
#: The sketch's error is one in so many ranks.
ACCURACY = 2000


def word_stretches(text: bytes | None, stretch: int = STRETCH) -> Iterator[list[bytes]]:
    """The words of a text in order, in lists of a bounded number of bytes (a longer word is whole)."""
    text, at = text or b"", 0
    while at < len(text):
        end = at + stretch
        while end < len(text) and _PLAIN[text[end]] != 32:
            end += 1
        yield text[at:end].translate(_PLAIN).split()
        at = end


def hashed(text: bytes | None, longest: int, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Words and buckets of features, a stretch of the text at a time."""
    before: list[bytes] = []
    for ws in word_stretches(text):
        found = [crc32(w) for w in ws]
        run = before + ws
        for n in range(2, longest + 1):
            found += [crc32(b" ".join(run[max(0, end - n):end])) for end in range(max(len(before) + 1, n), len(run) + 1)]
        before = run[max(0, len(run) - longest + 1):] if longest > 1 else []
        yield len(ws), np.array(found, np.int64) % buckets


def _counter(longest: int, buckets: int) -> Callable:
    out = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0):
                for _, found in hashed(text.as_py(), longest, buckets):
                    total += np.bincount(found, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], schema=out)

    return count


def bucket_counts(texts: DataFrame, longest: int, buckets: int) -> DataFrame:
    """(bucket, n) of all features of the column `text`."""
    return texts.select(F.col("text").cast("binary")).mapInArrow(_counter(longest, buckets), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, longest: int, buckets: int) -> np.ndarray:
    """The gain of every bucket; the array has as many numbers as there are buckets."""
    both = (docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
            .join(bucket_counts(docs, longest, buckets).withColumnRenamed("n", "s"), "bucket", "left")
            .join(bucket_counts(target, longest, buckets).withColumnRenamed("n", "t"), "bucket", "left").fillna(0, ["s", "t"]))
    found = both.toArrow()
    s, t = (np.zeros(buckets, np.int64) for _ in range(2))
    at = found.column("bucket").to_numpy()
    s[at], t[at] = found.column("s").to_numpy(), found.column("t").to_numpy()
    ratio = (t + 1.0) * (float(s.sum()) + buckets) / ((s + 1.0) * (float(t.sum()) + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weighed(rows: DataFrame, gain: np.ndarray, longest: int) -> DataFrame:
    """`row`, n_words, n_features and weight for a frame of (`row`, `text`)."""
    shared = rows.sparkSession.sparkContext.broadcast(gain)
    row = rows.schema["row"].dataType.simpleString()

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in batches:
            out = np.zeros((3, batch.num_rows), np.int64)
            for i, text in enumerate(batch.column(1)):
                for n, found in hashed(text.as_py(), longest, len(gain)):
                    out[:, i] += n, len(found), gain[found].sum()
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, out)], ["row", "n_words", "n_features", "weight"])

    return rows.mapInArrow(weigh, f"row {row}, n_words long, n_features long, weight long")


def gumbel(doc_id: Column, seed: str) -> Column:
    """Gumbel noise in thousandths, from a hash of the seed and the id; a null id counts as empty."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10)
    return F.floor(-1000 * F.log(-F.log((h.cast("double") + 0.5) / 4294967296.0))).cast("long")


def cutoff(scores: DataFrame, drawn: int, total: int, scratch: Scratch) -> int:
    """The `drawn`-th highest of `total` values of the column `score`, for 1 <= drawn <= total; `number` is different in every row."""
    share, margin = 1 - drawn / total, 2 / ACCURACY
    while True:
        edges = [max(0.0, share - margin), min(1.0, share + margin)]
        low, high = scores.agg(F.percentile_approx("score", edges, ACCURACY)).first()[0]
        if margin >= 1:  # the widest bracket
            low, high = scores.agg(F.min("score"), F.max("score")).first()
        above, reached = scores.agg(F.count_if(F.col("score") > high), F.count_if(F.col("score") >= low)).first()
        if above < drawn <= reached:
            break
        margin *= 8
    # The number of the row parts equal scores, so a hot score is no hot key of the sort.
    placed = positions(scores.filter(F.col("score").between(low, high)), [F.desc("score"), F.asc("number")], "place", scratch, "bracket")
    return placed.filter(F.col("place") == drawn - above).first()["score"]


def draw(docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = 10_000, percent: int = 10, least_words: int = 20,
         seed: str = "2024", carry: bool = False) -> DataFrame:
    """n_words, n_features, weight, score and rank (null if not drawn) for every document.

    `target` needs the column `text`, `docs` also `doc_id`. Of the documents with at least `least_words` words `percent` in a
    hundred are drawn. With `carry` the column `row` holds all columns of the document, else its doc_id.
    """
    scratch = Scratch(docs.sparkSession, "importance")
    gain = gains(docs, target, longest, buckets)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in (docs.columns if carry else ["doc_id"])]).alias("row"), F.col("text").cast("binary").alias("text"))
    score = (F.col("weight") + gumbel(F.col("row.doc_id"), seed)).alias("score")
    scored = scratch.keep(weighed(rows, gain, longest).select("*", score, F.monotonically_increasing_id().alias("number")), "scored")
    able = F.col("n_words") >= least_words
    total = scored.filter(able).count()
    drawn = percent * total // 100
    if not drawn:
        return scored.drop("number").withColumn("rank", F.lit(None).cast("long"))
    cut = cutoff(scored.filter(able).select("score", "number"), drawn, total, scratch)
    near = able & (F.col("score") >= cut)
    order = [F.desc("score"), F.asc_nulls_last("row.doc_id"), F.asc("n_features"), F.asc("weight"), F.asc("number")]
    first = positions(scored.filter(near), order, "rank", scratch, "drawn")
    rank = F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank")
    names = ["row", "n_words", "n_features", "weight", "score"]
    result = scratch.keep(first.select(*names, rank).unionByName(scored.filter(~near).select(*names, F.lit(None).cast("long").alias("rank"))), "result")
    scratch.close("result")
    return result


def resample(docs: DataFrame, target: DataFrame, **arguments) -> DataFrame:
    """The drawn documents with their own columns."""
    return draw(docs, target, carry=True, **arguments).filter(F.col("rank").isNotNull()).select("row.*")
