"""Mix sources to target weights by Efraimidis-Spirakis sampling.

A document's size is its number of words. Sources, in code-point order with null last, weigh in
turn 5, 2, 1 and share the total size by weight; a target stops at `most` times its source's size
and the excess goes to the others. A source is taken in whole epochs first. The rest of its target
is filled by weighted sampling without replacement: each document draws the key -ln(u)/w, u being a
hash of its id and text and w its quality weight, and documents with the smallest keys are taken
while the sum of their sizes, to the middle of the document, is within the rest. So a source misses
its target by half a document at most, and reruns agree. Rows with equal id and text are one draw.

A source is never sorted in one task: the distribution of keys in a source is known from the counts
of its weights, so the keys fall evenly into buckets; bucket sums say which single bucket holds the
budget's end, and only that one is sorted.

Nulls and empty texts have size 0 and add 0 words. Null ids draw by their text. An empty table gives
an empty result. The columns of the input are kept by `mixed_documents`, which leaves out a column
of its own where the input has one of that name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelens.llm.base import WORD, Scratch

#: Sampling weights by symbols a word, best first: at most so many symbols in 100 words.
QUALITY = ((1, 1.0), (5, 0.75), (20, 0.5))
WORST = 0.25
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Plan:
    """`weights` repeat over the sources; `most` epochs at most; `buckets` of keys in a source."""

    weights: tuple[int, ...] = (5, 2, 1)
    most: int = 3
    buckets: int = 4096


def drawn(doc_id: Column, text: Column) -> Column:
    """A number in (0, 1) from the id and the text."""
    digits = F.md5(F.concat(
        F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(text, F.lit("")))))
    return (F.conv(F.substring(digits, 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, draw, quality weight and key of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    size = F.regexp_count(text, F.lit(WORD)).cast("long")
    symbols = F.length(text) - F.length(F.translate(text, SYMBOLS, ""))
    df = docs.select("doc_id", "source", size.alias("size"), symbols.alias("_symbols"),
                     drawn(F.col("doc_id"), F.col("text")).alias("draw"))
    weight = F.lit(WORST)
    for bound, value in reversed(QUALITY):
        weight = F.when(100 * F.col("_symbols") <= bound * F.col("size"), F.lit(value)).otherwise(weight)
    df = df.withColumn("weight", weight)
    return df.withColumn("key", -F.log("draw") / F.col("weight")).drop("_symbols")


def targets(sources: DataFrame, plan: Plan) -> DataFrame:
    """Target, whole epochs and rest for every source; `sources` has one row per source.

    The share of a weight unit is found by filling: sources are ordered by the share at which they
    stop; the first one that does not stop with what is left names the share of it and all after it.
    """
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    units = F.array(*[F.lit(w) for w in plan.weights])
    df = sources.withColumn("_unit", F.get(units, (F.row_number().over(in_order) - 1) % len(plan.weights)))
    df = df.withColumn("_top", F.col("source_size") * plan.most)
    filling = Window.orderBy(F.col("_top") / F.col("_unit"), F.col("source").asc_nulls_last())
    before, after = filling.rowsBetween(Window.unboundedPreceding, -1), filling.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy(F.lit(0))
    df = df.withColumn("_share", (F.sum("source_size").over(whole) - F.coalesce(F.sum("_top").over(before), F.lit(0)))
                       / F.sum("_unit").over(after))
    first = F.min(F.when(F.col("_share") * F.col("_unit") < F.col("_top"), F.struct(
        (F.col("_top") / F.col("_unit")).alias("at"), F.col("_share").alias("share")))).over(whole)
    df = df.withColumn("_share", first["share"])
    fill = F.col("_share") * F.col("_unit")
    df = df.withColumn("target", F.when(F.col("_share").isNull() | (fill >= F.col("_top")), F.col("_top").cast("double"))
                       .otherwise(fill))
    df = df.withColumn("epochs", F.when(F.col("source_size") > 0, F.least(
        F.floor(F.col("target") / F.greatest(F.col("source_size"), F.lit(1))), F.lit(plan.most))).otherwise(F.lit(0)).cast("long"))
    df = df.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    return df.select("source", "source_size", "target", "epochs", "rest", "by_weight", "n_rows")


def mix(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """doc_id, source, size, weight, draw, source_size, target, epochs, selected and taken of every row."""
    scratch = Scratch(docs.sparkSession, "mixing")
    rows = scratch.keep(measured(docs), "rows")
    levels = sorted({WORST, *(w for _, w in QUALITY)})
    of_level = F.struct(*[F.count_if(F.col("weight") == w).alias(f"n{i}") for i, w in enumerate(levels)])
    sources = rows.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows"), of_level.alias("by_weight"))
    goals = scratch.keep(targets(sources, plan), "targets")

    below = sum((F.col(f"by_weight.n{i}") * (1 - F.exp(-w * F.col("key"))) for i, w in enumerate(levels)), F.lit(0.0))
    right = goals.withColumnRenamed("source", "_source")
    placed = rows.join(right, F.col("source").eqNullSafe(F.col("_source"))).drop("_source").withColumn(
        "bucket", F.least(F.floor(below / F.col("n_rows") * plan.buckets), F.lit(plan.buckets - 1)).cast("int"))
    placed = placed.drop("by_weight", "n_rows")

    up_to = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"), F.first("rest").alias("rest"))
    sums = sums.withColumn("before", F.coalesce(F.sum("bucket_size").over(up_to), F.lit(0)))
    last = scratch.keep(
        sums.filter((F.col("before") < F.col("rest")) & (F.col("before") + F.col("bucket_size") >= F.col("rest")))
        .select("source", F.col("bucket").alias("end"), "before"), "ends")

    ends = last.withColumnRenamed("source", "_source")
    ended = placed.join(ends, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
    inside = F.coalesce(F.col("bucket") == F.col("end"), F.lit(False))
    columns = ["doc_id", "source", "size", "weight", "draw", "source_size", "target", "epochs"]
    clear = ended.filter(~inside).select(
        *columns, ((F.col("rest") > 0) & F.coalesce(F.col("bucket") < F.col("end"), F.lit(True))).alias("selected"))
    in_turn = Window.partitionBy("source").orderBy("key", "doc_id")
    ranked = ended.filter(inside).withColumns({
        "_up_to": F.sum("size").over(in_turn),  # with its equals
        "_equals": F.sum("size").over(Window.partitionBy("source", "key", "doc_id"))})
    edge = ranked.select(
        *columns, (F.col("before") + F.col("_up_to") - F.col("_equals") / 2 <= F.col("rest")).alias("selected"))
    taken = F.col("size") * (F.col("epochs") + F.col("selected").cast("long"))
    return clear.unionByName(edge).withColumn("taken", taken)


def mixed_documents(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """The documents that a mix takes: their columns, then `size`, `target` and `copies`, how often each is taken."""
    taken = mix(docs, plan).withColumn("copies", F.col("epochs") + F.col("selected").cast("long")).filter("copies > 0")
    right = taken.select(F.col("doc_id").alias("_id"), F.col("draw").alias("_drawn"), "size", "target", "copies").distinct()
    left = docs.select(F.struct("*").alias("_row"), "doc_id", drawn(F.col("doc_id"), F.col("text")).alias("draw"))
    joined = left.join(right, (F.col("draw") == F.col("_drawn")) & F.col("doc_id").eqNullSafe(F.col("_id")))
    return joined.select("_row.*", *[F.col(c) for c in ("size", "target", "copies") if c not in docs.columns])
