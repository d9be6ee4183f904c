"""Quality rules with cutoffs that labelled holdouts certify.

Every rule is a ratio of two counts of a text, in steps of a fixed grid. The cutoffs of all rules go together along one
path of levels that is fixed beforehand, from lenient to strict; a text's level is the first at which some rule rejects it. For each stratum the
good holdouts say how many of them a level rejects. With n good holdouts, the exact binomial test allows a level that
rejects at most k of them, where k is the largest count with P(Bin(n, limit) <= k) <= error: were the true false
rejection above the limit, so few rejections would be that unlikely. Levels are tested from the most lenient one on, up to the first
that fails, so the tests of one path need no further correction (fixed sequence), and the limit holds for all rules together. Strata share
the error evenly (Bonferroni). Among the certified levels the one that parts bad from good holdouts best is taken, or none.

Strata with too few good holdouts to certify anything are pooled into one, for which the limit then holds as a whole.

Nulls and empty texts have no words: all counts are 0. A stratum may be null and is then one of its
own. If even the pool has too few holdouts, or there are none, its rules stay off. Repeated rows are
judged row by row; a label row counts for every document row with its id.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelens.llm.base import Scratch, words

SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WINDOW = 8
COUNTS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals", "n_shouts"]

#: Rules as two counts each: the text is rejected if their ratio is above the cutoff.
RULES = {
    "symbols": ("n_symbols", "n_words"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
    "capitals": ("n_capitals", "word_chars"),
    "shouts": ("n_shouts", "n_words"),
}
#: The ratios in thousandths at the middle of the path, and its levels: four of them halve all cutoffs.
MIDDLE = {"symbols": 100, "dup_lines": 300, "repeats": 200, "capitals": 250, "shouts": 50}
LEVELS = 33
PATH = {rule: [int(m * 2 ** ((LEVELS // 2 - t) / 4)) for t in range(LEVELS)] for rule, m in MIDDLE.items()}


@dataclass(frozen=True)
class Risk:
    """`limit`: false rejections of all rules together allowed in a stratum, as a share of its good documents; `error`: the
    chance that any of these promises fails; `steps`: grid steps in 1; `highest`: last step of the grid."""

    limit: float = 0.05
    error: float = 0.05
    steps: int = 1000
    highest: int = 20_000


def repeated_words(repeats: Column) -> Column:
    """Words that windows starting at `repeats`, sorted, cover."""
    return F.aggregate(
        F.transform(repeats, lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(repeats, j + 1) - p, F.lit(WINDOW)))),
        F.lit(0), lambda a, b: a + b)


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the columns of COUNTS to documents.

    Repeated windows are looked for by hash first; only texts with an equal pair of hashes build
    and sort the windows themselves, so the count is exact. Work is n log n in a text's words.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    chars = lambda of: (F.length(t) - F.length(F.translate(t, of, ""))).cast("long")
    others = range(1, WINDOW)
    df = docs.withColumn("_w", words(t)).withColumn("_n", F.size("_w"))
    df = df.withColumn("_h", F.when(F.col("_n") >= WINDOW, F.transform("_w", lambda w: F.xxhash64(w))))
    df = df.withColumn("_g", F.transform(
        F.slice("_h", 1, F.col("_n") - (WINDOW - 1)),
        lambda h, i: F.xxhash64(h, *[F.get(F.col("_h"), i + k) for k in others])))
    df = df.withColumn("_s", F.when(
        F.size(F.array_distinct("_g")) < F.size("_g"),
        F.sort_array(F.transform(F.sequence(F.lit(0), F.col("_n") - WINDOW), lambda i: F.struct(
            F.array_join(F.slice("_w", i + 1, F.lit(WINDOW)), " ").alias("g"), i.alias("i"))))))
    s = F.col("_s")
    df = df.withColumn("_p", F.sort_array(F.transform(
        F.filter(s, lambda x, j: F.coalesce(x["g"] == F.get(s, j - 1)["g"], F.lit(False))
                 | F.coalesce(x["g"] == F.get(s, j + 1)["g"], F.lit(False))),
        lambda x: x["i"])))
    df = df.withColumn("_l", F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    return df.withColumns({
        "n_words": F.col("_n").cast("long"),
        "word_chars": F.length(F.translate(t, " \t\n\x0b\x0c\r", "")).cast("long"),
        "n_symbols": chars(SYMBOLS),
        "n_lines": F.size("_l").cast("long"),
        "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"),
        "n_repeat_words": F.coalesce(repeated_words(F.col("_p")), F.lit(0)).cast("long"),
        "n_capitals": chars(CAPITALS),
        "n_shouts": chars("!"),
    }).drop("_w", "_n", "_h", "_g", "_s", "_p", "_l")


def step(rule: str, risk: Risk) -> Column:
    """The ratio of a rule in grid steps, rounded up; 0 where there is nothing to divide by."""
    top, below = (F.col(c) for c in RULES[rule])
    up = F.floor((top * risk.steps + below - 1) / F.greatest(below, F.lit(1)))
    return F.when(below > 0, F.least(up, F.lit(risk.highest))).otherwise(F.lit(0)).cast("long")


def allowed(n: Column, limit: float, error: Column) -> Column:
    """The largest k with P(Bin(n, limit) <= k) <= error; -1 if not even 0 is.

    Sums the distribution from 0 up in logarithms, as far as the mean.
    """
    ratio = F.lit(limit / (1 - limit))
    start = n * F.log1p(F.lit(-limit))
    state = F.struct(start.alias("term"), start.alias("total"), F.lit(-1).cast("long").alias("k"))

    def advance(a: Column, i: Column) -> Column:
        """Takes i into the sum that holds 0..i."""
        inside = a["total"] <= F.log(error)
        term = a["term"] + F.log((n - i) / (i + 1) * ratio)
        high, low = F.greatest(a["total"], term), F.least(a["total"], term)
        return F.struct(
            term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("total"),
            F.when(inside, i).otherwise(a["k"]).alias("k"))

    steps = F.sequence(F.lit(0).cast("long"), F.floor(n * F.lit(limit)).cast("long"))
    return F.aggregate(steps, state, advance, lambda a: a["k"])


def levels(risk: Risk) -> dict[str, Column]:
    """For each rule the first level of the path that rejects the text, LEVELS if none does."""
    def first(rule: str) -> Column:
        at = step(rule, risk)
        return F.size(F.filter(F.array(*[F.lit(c).cast("long") for c in PATH[rule]]), lambda c: c >= at))

    return {rule: first(rule) for rule in RULES}


def cutoffs(holdouts: DataFrame, stratum: str, good: str = "good", risk: Risk = Risk()) -> DataFrame:
    """(stratum, level): the certified level of each stratum that has holdouts; null where its rules are off.

    `holdouts` has the columns of COUNTS, the stratum and a boolean. Its rows are counted per level
    before anything is shuffled, so a row group of the result is at most a path long.
    """
    seen = holdouts.filter(F.col(good).isNotNull()).select(
        F.col(stratum).alias("stratum"), good, F.least(*levels(risk).values()).alias("at")).groupBy("stratum", "at").agg(
        F.count_if(F.col(good)).alias("good"), F.count_if(~F.col(good)).alias("bad"))
    totals = seen.groupBy("stratum").agg(F.sum("good").alias("n"))
    totals = totals.withColumn("error", F.lit(risk.error) / totals.agg(F.count(F.lit(1)).alias("strata")).scalar())
    # Null is a stratum, too, so the pool is told by a column of its own.
    pooled = totals.select(F.col("stratum").alias("_own"), "error", (allowed(F.col("n"), risk.limit, F.col("error")) < 0).alias("pooled"))
    counted = seen.join(pooled, F.col("stratum").eqNullSafe(F.col("_own"))).withColumn(
        "name", F.when(~F.col("pooled"), F.col("stratum"))).groupBy("pooled", "name", "error", "at").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    whole = Window.partitionBy("pooled", "name")
    upto = whole.orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    tails = counted.select(
        "pooled", "name", "error", "at", F.sum("good").over(whole).alias("n_good"), F.sum("bad").over(whole).alias("n_bad"),
        F.sum("good").over(upto).alias("good_out"), F.sum("bad").over(upto).alias("bad_out"))
    share_of = lambda part, all_: F.col(part) / F.greatest(F.col(all_), F.lit(1))
    gain = share_of("bad_out", "n_bad") - share_of("good_out", "n_good")
    # Rejections grow along the path, so the levels up to the first that fails are those within the bound.
    best = tails.filter((F.col("at") < LEVELS) & (F.col("good_out") <= allowed(F.col("n_good"), risk.limit, F.col("error"))) & (gain > 0)).groupBy(
        "pooled", "name").agg(F.min(F.struct((-gain).alias("loss"), "at"))["at"].alias("level"))
    own, found = pooled.withColumn("name", F.when(~F.col("pooled"), F.col("_own"))), best.withColumnsRenamed({"pooled": "_pooled", "name": "_name"})
    return own.join(found, (F.col("pooled") == F.col("_pooled")) & F.col("name").eqNullSafe(F.col("_name")), "left").select(
        F.col("_own").alias("stratum"), "level")


def verdicts(counted: DataFrame, cuts: DataFrame, stratum: str, risk: Risk = Risk()) -> DataFrame:
    """Add `base_failed`, `rejected_by` (names of the rules above their cutoff) and `kept`."""
    joined = counted.join(cuts.withColumnsRenamed({"stratum": "_stratum", "level": "_level"}), F.col(stratum).eqNullSafe(F.col("_stratum")), "left")
    broken = F.array_compact(F.array(*[F.when(at <= F.col("_level"), F.lit(r)) for r, at in levels(risk).items()]))
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return joined.withColumn("base_failed", base).withColumn("rejected_by", broken).withColumn(
        "kept", ~F.col("base_failed") & (F.size("rejected_by") == 0)).drop("_stratum", "_level")


def judge(docs: DataFrame, labels: DataFrame, risk: Risk = Risk()) -> DataFrame:
    """doc_id, digest (hash of the text), counts and verdict of every document row, strata being languages.

    The counts are written once; holdouts and verdicts both read them.
    """
    scratch = Scratch(docs.sparkSession, "quality-rules")
    texts = docs.select("doc_id", "lang", "text", F.xxhash64("text").alias("digest"))
    counted = scratch.keep(with_counts(texts).drop("text"), "counts")
    return verdicts(counted, certified(scratch, counted, labels, risk), "lang", risk)


def certified(scratch: Scratch, counted: DataFrame, labels: DataFrame, risk: Risk) -> DataFrame:
    marked = labels.select(F.col("doc_id").alias("_id"), (F.col("quality") == 1).alias("good"))
    holdouts = counted.join(marked, F.col("doc_id") == F.col("_id"))
    return scratch.keep(cutoffs(holdouts, "lang", risk=risk), "cutoffs")


def filter_documents(docs: DataFrame, labels: DataFrame, risk: Risk = Risk()) -> DataFrame:
    """Documents that the rules keep, with all their columns."""
    rejected = judge(docs, labels, risk).filter(~F.col("kept")).select(
        F.col("doc_id").alias("_id"), F.col("digest").alias("_digest")).distinct()
    inner = docs.select(F.struct("*").alias("_row"), "doc_id", F.xxhash64("text").alias("digest"))
    kept = inner.join(rejected, (F.col("digest") == F.col("_digest")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left_anti")
    return kept.select("_row.*")
