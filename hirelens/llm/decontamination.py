"""Find passages of benchmark items in documents: a prefix-filtered set join on word shingles.

An item is cut into windows of `size` consecutive words; a shorter item is one window. A document
contains a window only if it contains all its shingles, so one of them is a sufficient prefix: the
rarest in the documents. The join works in these steps:

1. One pass over the texts hashes every shingle and keeps those that a bitmap of the item shingles
   may hold, with the words around them. The bitmap has a fixed size; more items let more shingles pass, and
   what passes wrongly falls out in the next join.
2. The kept shingles are counted; every window picks its rarest one, the prefix, with its offset.
3. Windows join kept shingles on the prefix. Length and position bounds drop windows that would
   begin before the document's first word or end after its last.
4. The words around the shingle are compared with the window's words, so hashes never decide.

Windows that several items share are joined once. Nulls and empty texts have no words and are never hit;
items without words have no window and an empty benchmark hits nothing. Rows with equal id and text get equal results; rows that
share only the id are told apart by their text. Item ids count once, however often they repeat.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.llm.base import PLAIN_WORD, Scratch, lower_ascii, words

LONGS = 1 << 16


@dataclass(frozen=True)
class Shape:
    """`size` words in a window, `shingle` words in a shingle (less in windows that are shorter)."""

    size: int = 10
    shingle: int = 3


def windows(items: DataFrame, shape: Shape) -> DataFrame:
    """item_id, window (its words) and length of every different window of an item."""
    w = items.select("item_id", words(lower_ascii(F.col("text")), PLAIN_WORD).alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (shape.size - 1), F.lit(1)))
    cut = w.select("item_id", "w", F.explode(starts).alias("at"))
    return cut.select("item_id", F.slice("w", F.col("at"), F.lit(shape.size)).alias("window")).distinct().withColumn(
        "length", F.size("window"))


def shingles(ws: Column, width: int) -> Column:
    """Hashes of all shingles of a width, by position."""
    hashes = F.transform(ws, lambda w: F.xxhash64(w)) if width == 1 else F.transform(
        F.slice(ws, 1, F.greatest(F.size(ws) - (width - 1), F.lit(0))),
        lambda w, i: F.xxhash64(w, *[F.get(ws, i + k) for k in range(1, width)]))
    return hashes


def bitmap(tokens: DataFrame) -> DataFrame:
    """One row with an array of LONGS numbers, whose bits mark the tokens."""
    place = F.pmod(F.col("token"), F.lit(LONGS * 64))
    marked = tokens.select(F.floor(place / 64).alias("id"), F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int")).alias("bit"))
    bits = marked.groupBy("id").agg(F.bit_or("bit").alias("bits"))
    every = tokens.sparkSession.range(LONGS).join(bits, "id", "left")
    return every.agg(F.transform(
        F.sort_array(F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")))),
        lambda x: x["bits"]).alias("bits"))


def marked(token: Column, bits: Column) -> Column:
    place = F.pmod(token, F.lit(LONGS * 64))
    return F.getbit(F.get(bits, F.floor(place / 64).cast("int")), (place % 64).cast("int")) == 1


def candidates(docs: DataFrame, tokens: DataFrame, widths: list[int], shape: Shape) -> DataFrame:
    """For every document row its key and number of words, and a row for each shingle that the bitmap lets pass.

    The first kind has a null `token`. `around` holds the words from `size - 1` before the shingle's first word,
    which is number `at`, to as many after it; `first` is the number of the first of them.
    """
    df = docs.select("doc_id", F.xxhash64("text").alias("digest"), words(lower_ascii(F.col("text")), PLAIN_WORD).alias("w"))
    df = df.withColumns({f"s{n}": shingles(F.col("w"), n) for n in widths})
    every = F.concat(F.array(F.lit(None).cast("long")), *[F.col(f"s{n}") for n in widths])
    df = df.select(
        "doc_id", "digest", "w", F.size("w").alias("n_words"), *[F.size(f"s{n}").alias(f"n{n}") for n in widths],
        F.posexplode(every).alias("_at", "token"))
    df = df.filter(F.col("token").isNull() | marked(F.col("token"), bitmap(tokens).scalar()) if widths else F.lit(True))
    # The arrays of all widths stand one after the other.
    at, width, begin = F.lit(None).cast("int"), F.lit(None).cast("int"), F.lit(1)
    for n in widths:
        at = F.when(F.col("_at") >= begin, F.col("_at") - begin).otherwise(at)
        width = F.when(F.col("_at") >= begin, F.lit(n)).otherwise(width)
        begin = begin + F.col(f"n{n}")
    df = df.select("doc_id", "digest", "w", "n_words", "token", at.alias("at"), width.alias("width"))
    first = F.greatest(F.col("at") - (shape.size - 1), F.lit(0))
    return df.select("doc_id", "digest", F.col("n_words").cast("long").alias("n_words"), "width", "token", "at", first.alias("first"),
                     F.when(F.col("token").isNotNull(), F.slice("w", first + 1, F.col("at") - first + shape.size)).alias("around"))


def occurrences(docs: DataFrame, of_items: DataFrame, scratch: Scratch, shape: Shape = Shape()) -> tuple[DataFrame, DataFrame]:
    """Two frames: a row for every document row (doc_id, digest, n_words), and the places of windows.

    A place has doc_id, digest, `start` (number of its first word, from 0), `length` and `window`.
    """
    different = of_items.select("window", "length").distinct()
    width = F.least("length", F.lit(shape.shingle))
    widths = [r.w for r in different.select(width.alias("w")).distinct().orderBy("w").collect()]  # at most `shingle` rows
    # The shingles of a window with their offsets in it. The first place of each will do.
    of_width = F.coalesce(*[F.when(width == n, shingles(F.col("window"), n)) for n in widths or [1]])
    offsets = scratch.keep(
        different.select("window", "length", width.alias("width"), F.posexplode(of_width).alias("offset", "token"))
        .groupBy("window", "length", "width", "token").agg(F.min("offset").alias("offset")), "offsets")
    tokens = offsets.select("width", "token").distinct()
    passed = scratch.keep(candidates(docs, tokens, widths, shape), "passed")
    rows = passed.filter("token is null").select("doc_id", "digest", "n_words")
    hits = passed.filter("token is not null")
    counts = hits.groupBy("width", "token").agg(F.count(F.lit(1)).alias("n")).join(tokens, ["width", "token"])
    prefixes = offsets.join(counts, ["width", "token"]).groupBy("window", "length").agg(
        F.min(F.struct("n", "token", "offset", "width")).alias("p")).select(
        "window", "length", "p.offset", "p.width", "p.token")
    start = F.col("at") - F.col("offset")
    met = hits.join(scratch.keep(prefixes, "prefixes"), ["width", "token"]).filter(
        (start >= 0) & (start + F.col("length") <= F.col("n_words")))
    verified = met.filter(F.slice("around", start - F.col("first") + 1, F.col("length")) == F.col("window"))
    return rows, verified.select("doc_id", "digest", start.alias("start"), "length", "window")


def covered(places: Column) -> Column:
    """Number of words in the union of places (start, length), sorted."""
    zero = F.struct(F.lit(0).alias("to"), F.lit(0).alias("n"))

    def add(a: Column, p: Column) -> Column:
        end = p["start"] + p["length"]
        return F.struct(F.greatest(a["to"], end).alias("to"),
                        (a["n"] + F.greatest(end - F.greatest(a["to"], p["start"]), F.lit(0))).alias("n"))

    return F.aggregate(places, zero, add, lambda a: a["n"].cast("long"))


def contamination(docs: DataFrame, items: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """doc_id, digest (hash of the text), n_words, n_hit and items (sorted ids as text) of every document row."""
    scratch = Scratch(docs.sparkSession, "decontamination")
    of_items = scratch.keep(windows(items, shape), "windows")
    rows, places = occurrences(docs, of_items, scratch, shape)
    places = scratch.keep(places, "places")
    hit = places.groupBy("doc_id", "digest").agg(
        covered(F.sort_array(F.collect_set(F.struct("start", "length")))).alias("n_hit"))
    found = places.select("doc_id", "digest", "window").distinct().join(of_items.drop("length"), "window").groupBy(
        "doc_id", "digest").agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    key = ["doc_id", "digest"]
    result = _beside(_beside(rows, hit, key), found, key)
    return scratch.finish(result.select(
        "doc_id", "digest", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items")))


def _beside(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    named = right.select(*[F.col(k).alias(f"_{k}") for k in key], *[c for c in right.columns if c not in key])
    condition = F.lit(True)
    for k in key:
        condition = condition & left[k].eqNullSafe(named[f"_{k}"])
    return left.join(named, condition, "left").drop(*[f"_{k}" for k in key])


def clean_documents(docs: DataFrame, items: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """Documents without any window of an item, with all their columns."""
    hit = contamination(docs, items, shape).filter("n_hit > 0").select(
        F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"))
    inner = docs.select(F.struct("*").alias("_row"), "doc_id", F.xxhash64("text").alias("digest"))
    kept = inner.join(hit, (F.col("digest") == F.col("_digest")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left_anti")
    return kept.select("_row.*")
