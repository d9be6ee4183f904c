"""Small tables with the awkward cases: nulls, empty and long texts, ties, repeated rows, extra columns."""

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, k int, size string, score string"
VOCABULARY = "the of and to in a is that it for was with as be on by at from ab cd ef gh ij kl mn".split()


def prose(rng: random.Random, n: int) -> str:
    ws = [rng.choice(VOCABULARY) if rng.random() < 0.5 else "".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(n)]
    return " ".join(w + ("\n" if rng.random() < 0.05 else "") for w in ws)


def texts(seed: int = 1, n: int = 60) -> list[str | None]:
    """Prose of many lengths with copies, near copies and shared passages."""
    rng = random.Random(seed)
    passage = prose(rng, 30)
    out: list[str | None] = [None, "", "   \n\t ", "Word", "two Words", "ÉCOLE été ß ÀB 漢字かな", "a" * 3000, "ab " * 700]
    for i in range(n):
        kind = i % 6
        plain = [t for t in out if t and len(t) > 300]
        if kind == 0 or not plain:
            out.append(prose(rng, rng.randint(60, 300)))
        elif kind == 1:
            out.append(rng.choice(plain))
        elif kind == 2:
            ws = rng.choice(plain).split(" ")
            ws[rng.randrange(len(ws))] = "Changed"
            out.append(" ".join(ws))
        elif kind == 3:
            out.append(prose(rng, 40) + " " + passage + " " + prose(rng, 40))
        elif kind == 4:
            out.append(prose(rng, rng.randint(0, 12)))
        else:
            t = rng.choice(plain)
            out.append(prose(rng, 20) + t[rng.randrange(len(t) // 2):])
    out.append(prose(rng, 9000))
    return out


def rows(some: list[str | None], seed: int = 2) -> list[tuple]:
    """Rows in random order, some repeated, one with a null id."""
    rng = random.Random(seed)
    out = [(i, t, rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "s3", "s4", None]), len(t or ""), "x", i, "y", "z")
           for i, t in enumerate(some)]
    out += [out[10], out[10], out[0]]
    out.append((None, some[12], None, None, None, None, None, None, None))
    rng.shuffle(out)
    return out


def documents(spark: SparkSession, some: list[str | None] | None = None, partitions: int = 3) -> DataFrame:
    return spark.createDataFrame(rows(texts() if some is None else some), SCHEMA).repartition(partitions)


def nothing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)
