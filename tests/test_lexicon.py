"""The lexicon as a table against a plain search, on few and on very many terms."""

import random
import time

import pytest
from pyspark.sql import functions as F

from hirelens import workspace
from hirelens.fixed_values import SKILL_LEXICON
from hirelens.functions import skills
from hirelens.operators import lexicon
from test_skills import brute_force


def found(spark, texts, terms):
    t = spark.createDataFrame([(x, "extra") for x in texts], "text string, term string").repartition(3)
    made = lexicon.lexicon_spans(t, spark.createDataFrame([(x,) for x in terms], "term string"))
    rows = made.collect()
    assert len(rows) == len({r.text for r in rows})
    return {r.text: [(s["start"], s["end"]) for s in r.spans] for r in rows}


def expected(texts, terms):
    spans = {t: brute_force(t, [x for x in terms if x]) for t in texts if t}
    return {t: s for t, s in spans.items() if s}


def test_spans_equal_brute_force(spark):
    rng = random.Random(11)
    pieces = SKILL_LEXICON + ["React", "Native", " ", " ", ".", ",", "_", "é", "Đ", "😀", "x", "9", "GitLab CI/CD", " ", "++", "a++b"]
    texts = ["".join(rng.choice([p, p.upper(), p.lower()]) for p in rng.choices(pieces, k=rng.randint(0, 30))) for _ in range(300)]
    terms = SKILL_LEXICON + ["++", ".", "a b", "ĐÉ", "native react"]
    result = found(spark, [*texts, None, "", texts[0]], terms)
    assert result == expected(texts, terms)
    assert sum(map(len, result.values())) > 300


def test_terms_that_overlap_themselves(spark):
    texts = ["a b a b a b a", "aa aa aa", "x"]
    terms = ["a b a", "aa aa", "a", "", "never there"]
    assert found(spark, texts, terms) == expected(texts, terms)


def test_same_spans_as_the_column_function(spark):
    texts = [f"{a} and {b.lower()}, {c}." for a, b, c in zip(SKILL_LEXICON, SKILL_LEXICON[3:], SKILL_LEXICON[7:])]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    by_column = {r.text: [tuple(s) for s in r.s] for r in df.select("text", skills.skill_spans(F.col("text")).alias("s")).collect()}
    assert found(spark, texts, SKILL_LEXICON) == {t: s for t, s in by_column.items() if s}


def test_a_hundred_thousand_terms(spark):
    terms = spark.range(100_000).select(F.concat(F.lit("term"), F.col("id"), F.when(F.col("id") % 2 == 0, " of trade").otherwise("")).alias("term"))
    texts = spark.range(2000).select(F.concat(F.lit("we use Term"), F.col("id") * 31, F.lit(" of trade, and the term of trade")).alias("text"))
    start = time.time()
    rows = lexicon.lexicon_spans(texts, terms).collect()
    assert time.time() - start < 120
    assert len(rows) == 2000 and all(len(r.spans) == 1 for r in rows)


def test_very_many_spans_in_one_text(spark):
    """Spans were told apart pair by pair, and worked out twice."""
    words = [f"w{i}" for i in range(60_000)]
    start = time.time()
    (spans,) = found(spark, [" ".join(words)], [*words, "w1 w2", "w3 w5"]).values()
    assert time.time() - start < 40
    assert len(spans) == 60_001 and spans == sorted(spans) and spans[:4] == [(0, 2), (3, 5), (3, 8), (6, 8)]


def test_nothing(spark):
    assert found(spark, [], ["a"]) == {} and found(spark, ["a"], []) == {} and found(spark, [None, ""], ["", "a"]) == {}


def test_a_token_of_most_texts_is_not_the_key(spark):
    texts = spark.createDataFrame([(f"the way {i}",) for i in range(50)] + [("the crux",)], "text string")
    counts = texts.select(F.explode(lexicon.tokens(F.col("text"))).alias("key")).groupBy("key").agg(F.count("*").alias("n"))
    terms = spark.createDataFrame([("the crux",), ("the moon",)], "term string")
    assert [(r.key, r.offset) for r in lexicon.keyed_terms(terms, counts).collect()] == [("crux", 2)]


@pytest.mark.parametrize("n", [1, 63, 64, 65, 500])
def test_starts_of_tokens(spark, n):
    text = "é, " * n
    row = spark.createDataFrame([(text,)], "t string").select(lexicon.token_starts(lexicon.tokens(F.col("t"))).alias("s")).first()
    assert row.s == [i for k in range(n) for i in (3 * k, 3 * k + 1)] + [3 * n]


@pytest.mark.parametrize("sent", [32 << 20, -1])
def test_long_texts_whether_terms_are_sent_or_joined(spark, monkeypatch, sent):
    monkeypatch.setattr(lexicon, "SENT_BYTES", sent)
    rng = random.Random(5)
    words = ["a", "B", "c", "é", "Ω", "ſ", "K", ", ", " ", " ", "\x01", "😀", "-"]
    texts = ["".join(rng.choices(words, k=k)) for k in (1, 7, 8, 31, 32, 33, 63, 64, 65, 300, 1000)]
    texts += ["a b " * 40, "x " * 16 + "end", " start" + " x" * 30 + " ", "-" + "c a-" * 20]
    terms = ["a", "a b", "a b a", " ", "a-c", "-", "end", "start ", "x x x x x x x x x x x x x x x x x x x x x", "é, a", "k", "s ω", "\x01", "", "none"]
    # The plain search folds single characters only.
    plain = [t.translate(str.maketrans("ſK", "sk")) for t in texts]
    assert found(spark, texts, terms) == {t: e for t, e in zip(texts, (expected([p], terms).get(p) for p in plain)) if e}


def test_spans_by_the_key_of_the_text(spark):
    texts = spark.createDataFrame([("a b",), ("a b",), (None,), ("x",), ("",)], "text string")
    terms = spark.createDataFrame([("B",), ("a b",)], "term string")
    rows = lexicon.lexicon_spans(texts, terms, keyed=True).collect()
    key = texts.select(lexicon.text_key(F.col("text")).alias("k")).first().k
    assert [(r.key, [tuple(x) for x in r.spans]) for r in rows] == [(key, [(0, 3), (2, 3)])]


def test_folding_keeps_the_length(spark):
    codes = spark.range(1, 0x110000).filter("(id < 55296 OR id > 57343) AND id <> 65279")
    char = codes.select(F.concat(F.lit("a"), F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32"), F.lit("b")).alias("c"))
    assert char.filter((F.char_length("c") != 3) | (F.char_length(lexicon.folded(F.col("c"))) != 3)).count() == 0


def test_little_is_written(spark, monkeypatch, tmp_path):
    """The tokens of all texts were stored twice over, and shuffled with the terms of every candidate: 6.1 times the texts here."""
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 9))) for _ in range(3000)]
    rows = [(" ".join(rng.choices(words, k=2000)),) for _ in range(300)]
    spark.createDataFrame(rows, "text string").repartition(4).write.parquet(str(tmp_path / "texts"))
    texts = spark.read.parquet(str(tmp_path / "texts"))
    terms = spark.createDataFrame([(w,) for w in words[:1500]] + [(f"{a} {b}",) for a, b in zip(words, words[1:])], "term string")
    kept = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = kept.getAllFiles()
        return {f.getName(): f.length() for f in map(files.apply, range(files.size())) if f.getName().startswith("shuffle_")}

    written = []

    def stage(df, label, **_):
        staged = workspace.stage(df, label)
        written.extend(workspace.size_of(spark, name) for name in staged.inputFiles())
        return staged

    monkeypatch.setattr(lexicon, "stage", stage)
    before = shuffled()
    spans = lexicon.lexicon_spans(texts, terms)
    size = workspace.size_of(spark, str(tmp_path / "texts"))
    moved = sum(n for name, n in shuffled().items() if name not in before)
    assert spans.count() == 300
    assert sum(written) + moved < 5 * size
