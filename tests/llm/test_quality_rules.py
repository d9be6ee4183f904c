import random
import re
from collections import Counter
from math import comb

from fixtures import documents, nothing, rows, texts
from pyspark.sql import functions as F

from hirelens.llm import quality_rules


def brute(text):
    t = text or ""
    ws = re.findall("[^\x20\x09-\x0d]+", t)
    grams = Counter(tuple(ws[i:i + 8]) for i in range(len(ws) - 7))
    covered = {i + k for i in range(len(ws) - 7) if grams[tuple(ws[i:i + 8])] > 1 for k in range(8)}
    lines = [x for x in t.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return (len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))


def test_counts(spark):
    some = texts() + ["a b c d e f g h " * 3, "l1 x\nl1 x\n\n \nl1 x ", "#*$%&|<> a!! B", "w " * 8, "w " * 9]
    found = quality_rules.with_counts(documents(spark, some)).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    wanted = sorted(((r[0], *brute(r[1])) for r in rows(some)), key=str)
    assert sorted(((r.doc_id, *[r[n] for n in names]) for r in found), key=str) == wanted


def test_allowed_is_the_exact_binomial_bound(spark):
    cases = [(0, 0.1), (10, 0.05), (300, 0.01), (1000, 0.01), (2500, 0.002), (5000, 0.5)]
    df = spark.createDataFrame([(n, e) for n, e in cases], "n long, e double")
    found = [r.k for r in df.select(quality_rules.allowed(F.col("n"), 0.01, F.col("e")).alias("k")).collect()]
    for (n, e), k in zip(cases, found):
        cdf = lambda m: sum(comb(n, i) * 0.01 ** i * 0.99 ** (n - i) for i in range(m + 1))
        assert k == -1 or cdf(k) <= e
        assert cdf(k + 1) > e or k + 1 > n * 0.01


def test_cutoffs_part_bad_from_good(spark):
    good = [(i, "plain words here and there " * 8 + str(i), "en") for i in range(1200)]
    bad = [(10_000 + i, "### $$$ bad&&& " * 15 + str(i), "en") for i in range(200)]
    few = [(20_000 + i, "### $$$ rare " * 12, "xx") for i in range(5)]
    docs = spark.createDataFrame(good + bad + few, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], int(r[0] < 10_000)) for r in good + bad + few] + [(None, 1), (5, None)], "doc_id long, quality int")
    judged = {r.doc_id: r for r in quality_rules.judge(docs, labels).collect()}
    rejected = [i for i, r in judged.items() if "symbols" in r.rejected_by]
    assert set(rejected) == {r[0] for r in bad}
    kept = quality_rules.filter_documents(docs.withColumn("n_words", F.lit("mine")), labels)
    assert kept.columns == ["doc_id", "text", "lang", "n_words"]
    assert {r.doc_id for r in kept.collect()} == {i for i, r in judged.items() if r.kept}


def test_without_labels_or_documents(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    judged = quality_rules.judge(documents(spark), none).collect()
    assert len(judged) == len(rows(texts())) and not any(r.rejected_by for r in judged)
    assert quality_rules.judge(nothing(spark), none).count() == 0


def holdouts(spark, rows):
    """(stratum, thousandths of symbols, good) as texts of 1,000 words."""
    zero = [F.lit(0).cast("long").alias(c) for c in quality_rules.COUNTS if c not in ("n_words", "n_symbols")]
    return spark.createDataFrame(rows, "lang string, n_symbols long, good boolean").select(
        "*", F.lit(1000).cast("long").alias("n_words"), *zero)


def test_the_limit_holds_in_simulations(spark):
    """Many strata, each a draw of 150 good holdouts: seldom has the level taken a true false rejection above the limit."""
    rng, strata, n, path = random.Random(4), 400, 150, quality_rules.PATH["symbols"]
    tops = [60 + 10 * (k % 40) for k in range(strata)]  # good texts have 0 to `top` symbols, all equally likely
    rows = [(f"s{k:03d}", rng.randint(0, tops[k]), True) for k in range(strata) for _ in range(n)]
    rows += [(f"s{k:03d}", 3000 + rng.randint(0, 5), False) for k in range(strata) for _ in range(3)]
    rows += [(f"s{k:03d}", rng.randint(0, tops[k]), False) for k in range(strata) for _ in range(40)]
    risk = quality_rules.Risk(limit=0.05, error=0.1 * strata)  # a tenth for each stratum
    found = {r.stratum: r.level for r in quality_rules.cutoffs(holdouts(spark, rows), "lang", risk=risk).collect()}
    wrong = sum(found[f"s{k:03d}"] is not None and max(0, top - path[found[f"s{k:03d}"]]) / (top + 1) > 0.05 for k, top in enumerate(tops))
    assert len(found) == strata and all(v is not None for v in found.values())
    assert wrong <= 0.1 * strata + 3 * (strata * 0.09) ** 0.5


def test_levels_follow_the_path(spark):
    rows = [("x", v, True) for v in (0, 3, 6, 7, 100, 101, 1600, 1601, 19_000)]
    at = quality_rules.levels(quality_rules.Risk())["symbols"]
    found = {r.n_symbols: r.at for r in holdouts(spark, rows).select("n_symbols", at.alias("at")).collect()}
    path = quality_rules.PATH["symbols"]
    assert found == {v: next((t for t, c in enumerate(path) if v > c), quality_rules.LEVELS) for _, v, _ in rows}
    assert path == sorted(path, reverse=True) and (path[0], path[16], path[32]) == (1600, 100, 6)


def test_small_strata_are_pooled(spark):
    rows = [(lang, 0, True) for lang in ("a", "b", None) for _ in range(40)] + [("c", 0, True)] * 200
    rows += [(lang, 900, False) for lang in ("a", None, "c", "d") for _ in range(5)]
    found = {r.stratum: r.level for r in quality_rules.cutoffs(holdouts(spark, rows), "lang").collect()}
    # 40 good holdouts certify nothing alone, 120 do; `d` has none and is part of the pool.
    assert found == dict.fromkeys(["a", "b", "c", "d", None], 4)
    few = {r.stratum: r.level for r in quality_rules.cutoffs(holdouts(spark, rows).filter("lang in ('a', 'd')"), "lang").collect()}
    assert few == {"a": None, "d": None}


def test_good_holdouts_stop_the_path(spark):
    rows = [("a", 120, True)] * 30 + [("a", 0, True)] * 270 + [("a", 110, False)] * 50 + [("a", 800, False)] * 3
    (r,) = quality_rules.cutoffs(holdouts(spark, rows), "lang").collect()
    assert quality_rules.PATH["symbols"][r.level] >= 120
