"""Skill tagging with a lexicon that is a table: any number of terms, joined with the words of the texts.

A term stands between word boundaries, so it is a run of whole tokens: words, and the gaps between them. Every token of
the texts is joined with the terms whose rarest token it is; what meets there is checked in the text's own tokens.
The work grows with the texts and with what they hold of the lexicon, not with texts times terms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.functions.skills import collect
from hirelens.functions.text import WORD, bind
from hirelens.workspace import stage, unstage

TOKEN = rf"{WORD}++|[^\p{{L}}\p{{N}}_]++"
# Signs outside ASCII that count as case forms of ASCII letters.
SIGNS, LETTERS = "ſKİ", "ski"

# Tokens that one known place serves, and those of a piece of a text, at least.
STEP, PIECE = 8, 32
# Terms of more bytes than this are not sent to every task.
SENT_BYTES = 32 << 20


def tokens(text: Column) -> Column:
    """The words of a text and the gaps between them, in order; together they are the text."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0))


def folded(token: Column) -> Column:
    """The token with letter case taken away. It has as many characters as before."""
    return F.lower(F.translate(token, SIGNS, LETTERS))


def has_signs(text: Column) -> Column:
    """Few texts hold one of the signs, and looking for them token by token costs more than all else."""
    return F.contains(text, F.lit(SIGNS[0])) | F.contains(text, F.lit(SIGNS[1])) | F.contains(text, F.lit(SIGNS[2]))


def folded_tokens(text: Column) -> Column:
    return F.when(has_signs(text), F.transform(tokens(text), folded)).otherwise(F.transform(tokens(text), F.lower))


def text_key(text: Column) -> Column:
    """256 bits that stand for a text, so that joins need not move it; null for a null."""
    return F.unhex(F.sha2(text, 256))


def token_starts(found: Column) -> Column:
    """The place in the text where each token starts, and the text's length as the last one."""
    def step(acc: Column, token: Column):
        return {"at": acc["at"] + F.char_length(token)}, F.lit(True), acc["at"]

    return collect(F.concat(found, F.array(F.lit(""))), {"at": F.lit(0)}, step, "int")


def numbers_of(found: Column, step: int) -> Column:
    return F.sequence(F.lit(0), F.floor(F.size(found) / F.lit(step)).cast("int"))


def step_starts(found: Column) -> Column:
    """The place in the text where every eighth token starts: places of the others are counted on from there."""
    return token_starts(F.transform(numbers_of(found, STEP), lambda p: F.array_join(F.slice(found, p * STEP + 1, STEP), "")))


def start_of(first: Column, starts: Column, found: Column) -> Column:
    """The place where a token starts, by its number."""
    beyond = first.bitwiseAND(F.lit(STEP - 1))
    return F.get(starts, F.shiftright(first, STEP.bit_length() - 1)) + F.char_length(F.array_join(F.slice(found, first - beyond + 1, beyond), ""))


def keyed_terms(lexicon: DataFrame, counts: DataFrame) -> DataFrame:
    """(key, offset, term): the terms as arrays of folded tokens, each under the token that is rarest in the texts and its place.

    `counts` are (key, n) of the tokens that the texts have. A term with a token that no text has cannot occur and is left out.
    """
    terms = lexicon.select(F.transform(tokens(F.col("term")), folded).alias("term")).filter(F.size("term") > 0).distinct()
    parts = terms.select("term", F.posexplode("term").alias("offset", "key")).join(counts, "key", "left")
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "offset", "key")).alias("rarest")
    return parts.groupBy("term").agg(rarest).filter("rarest.n > 0").select("rarest.key", "rarest.offset", "term")


def lexicon_spans(texts: DataFrame, lexicon: DataFrame, keyed: bool = False) -> DataFrame:
    """(text, spans) for every different text of the column `text` that holds a term of `lexicon` (column `term`).

    Spans are [start, end) in characters, each once, by start and end; those of one term do not overlap each other. Letter
    case is ignored. Null and empty texts and terms hold nothing. With `keyed`, the result is (key, spans), where `text_key` of
    a text is its key: texts are then neither moved nor written again. A token that very many texts share is dealt
    out by its texts: before the join only the lexicon's few rows with it are copied.
    """
    name = "key" if keyed else "text"
    split = texts.select("text").filter(F.col("text").isNotNull()).distinct().select(F.monotonically_increasing_id().alias("_id"), "text")
    found = stage(split.withColumn("key", text_key(F.col("text"))) if keyed else split, "texts", clean=True)
    words = found.select(F.explode(folded_tokens(F.col("text"))).alias("key"))
    wanted = lexicon.select(F.explode(tokens(F.col("term"))).alias("key")).select(folded(F.col("key")).alias("key")).distinct()
    counts = words.join(wanted, "key", "left_semi").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    terms = stage(keyed_terms(lexicon, counts).select(
        "key", "offset", F.monotonically_increasing_id().alias("number"), "term", F.size("term").alias("size"),
        is_word(F.get("term", F.lit(0))).alias("from_word"), is_word(F.element_at("term", F.lit(-1))).alias("to_word"),
        overlaps_itself(F.col("term")).alias("again")), "terms", clean=True)
    joined = F.array_join("term", "")
    most, sent = terms.agg(F.max("size"), F.sum(F.octet_length(joined) + 16 * F.col("size") + 64)).first()
    if (sent or 0) <= SENT_BYTES:
        held = spans_at_join(found, terms.withColumn("length", F.char_length(joined)), most or 1)
        spans = found.select("_id", name).join(held, "_id").select(name, sorted_spans(F.col("plain"), F.col("again")).alias("spans"))
    else:
        tried = tried_terms(found, terms)
        spans = found.join(tried, "_id").select(name, checked_spans(folded_tokens(F.col("text")), F.col("_tried")).alias("spans"))
    # A filter before the spans are written would work them out a second time.
    result = stage(spans, "spans", clean=True).filter(F.size("spans") > 0)
    for df in (found, terms):
        unstage(df)
    return result


def spans_at_join(found: DataFrame, terms: DataFrame, most: int) -> DataFrame:
    """(_id, plain, again): the spans in each text of `terms`, which are sent to every task and have up to `most` tokens.

    Texts are cut into pieces that overlap by the longest term, so a place of a token carries all that decides about its terms,
    and only spans leave the task: those in `plain` as numbers, those of terms that can overlap themselves with their term.
    """
    # A token beyond the longest term tells whether the text goes on.
    overlap = -(-most // STEP) * STEP
    piece = max(PIECE, 2 * overlap)

    def begin(p: Column) -> Column:
        return F.greatest(p * piece - overlap, F.lit(0))

    def cut(words: Column) -> Column:
        def parts(items: Column, step: int) -> Column:
            return F.transform(numbers_of(words, piece), lambda p: F.slice(
                items, F.floor(begin(p) / F.lit(step)).cast("int") + 1, F.floor((p * piece + (piece + overlap) - begin(p)) / F.lit(step)).cast("int")))

        # Pieces that were structs of an array function would be copied several times.
        return F.arrays_zip(parts(words, 1).alias("near"), bind(step_starts(words), lambda starts: parts(starts, STEP)).alias("starts"))

    pieces = found.select("_id", F.posexplode(bind(folded_tokens(F.col("text")), cut)).alias("p", "x")).select(
        "_id", begin(F.col("p")).alias("begin"), (F.col("p") * piece - begin(F.col("p"))).alias("before"), "x.near", "x.starts")
    places = pieces.select("*", F.posexplode(F.slice("near", F.col("before") + 1, F.lit(piece))).alias("at", "key"))
    first = F.col("before") + F.col("at") - F.col("offset")
    end = F.col("first") + F.col("size")
    # Most places of a frequent token are ruled out by the term's own first and last tokens.
    met = (
        places.join(F.broadcast(terms), "key").withColumn("first", first).filter("first >= 0")
        .filter((F.get("near", F.col("first")) == F.get("term", F.lit(0))) & (F.get("near", end - 1) == F.get("term", F.col("size") - 1)))
        .filter((F.col("size") == 1) | (F.slice("near", F.col("first") + 1, F.col("size")) == F.col("term")))
        # A gap at an end of the term needs a word beyond it.
        .filter((F.col("from_word") | (F.col("begin") + F.col("first") > 0)) & (F.col("to_word") | (end < F.size("near"))))
        .withColumn("start", start_of(F.col("first"), F.col("starts"), F.col("near")))
        .withColumn("end", F.col("start") + F.col("length")))
    return met.groupBy("_id").agg(
        F.collect_list(F.when(~F.col("again"), span_number(F.col("start"), F.col("end")))).alias("plain"),
        F.collect_list(F.when(F.col("again"), F.struct("number", "start", "end"))).alias("again"))


def tried_terms(found: DataFrame, terms: DataFrame) -> DataFrame:
    """(_id, _tried): the terms that a text may hold, and the token where each would begin."""
    told = ["number", "first", "term", "from_word", "to_word", "again"]
    near_terms = terms.withColumns({"_before": F.get("term", F.col("offset") - 2), "_after": F.get("term", F.col("offset") + 2)})
    # Most places of a frequent token are ruled out by the tokens two before and two after it, mostly the next words.
    none = F.lit(None).cast("string")
    near = bind(folded_tokens(F.col("text")), lambda words: F.arrays_zip(
        words.alias("key"), F.concat(F.array(none, none), words).alias("before"), F.slice(words, F.lit(3), F.size(words)).alias("after")))
    places = found.select("_id", F.posexplode(near).alias("at", "x")).select("_id", "at", "x.*").toDF("_id", "at", "key", "before", "after")
    may_hold = [F.col(f"_{side}").isNull() | (F.col(f"_{side}") == F.col(side)) for side in ("before", "after")]
    met = places.join(near_terms, "key").filter(may_hold[0] & may_hold[1]).withColumn("first", F.col("at") - F.col("offset")).filter("first >= 0")
    return met.groupBy("_id").agg(F.collect_list(F.struct(*told)).alias("_tried"))


def is_word(token: Column) -> Column:
    return token.rlike(f"^{WORD}")


def overlaps_itself(term: Column) -> Column:
    """Can two places of the term share tokens? Then its last tokens are also its first ones."""
    size = F.size(term)
    shares = F.exists(F.sequence(F.lit(1), size - 1), lambda k: F.slice(term, F.lit(1), size - k) == F.slice(term, k + 1, size - k))
    return F.when(size > 1, shares).otherwise(F.lit(False))


def span_number(start: Column, end: Column) -> Column:
    """A span is one number, start and end, until all are sorted: numbers are told apart by hashing, structs pair by pair."""
    return F.shiftleft(start.cast("long"), 32) + end


def sorted_spans(plain: Column, again: Column) -> Column:
    """Spans from the numbers of some and the (number, start, end) of terms that can overlap themselves."""
    def step(acc: Column, x: Column):
        # By term and start: a term's next span begins after its last one.
        fits = ~acc["number"].eqNullSafe(x["number"]) | (x["start"] >= acc["last"])
        following = {"number": x["number"], "last": F.when(fits, x["end"]).otherwise(acc["last"])}
        return following, fits, span_number(x["start"], x["end"])

    state = {"number": F.lit(None).cast("long"), "last": F.lit(-1)}
    apart = F.when(F.size(again) > 0, collect(F.sort_array(again), state, step, "long")).otherwise(F.array().cast("array<bigint>"))
    numbers = F.concat(plain, apart)
    return F.transform(F.sort_array(F.array_distinct(numbers)), lambda n: F.struct(
        F.shiftright(n, 32).cast("int").alias("start"), n.bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("end")))


def checked_spans(words: Column, tried: Column) -> Column:
    """Spans of those tried that the folded tokens of a text really have."""
    def checked(words: Column) -> Column:
        def held(x: Column) -> Column:
            end = x["first"] + F.size(x["term"])
            # A gap at an end of the term needs a word beyond it.
            inside = (x["from_word"] | (x["first"] > 0)) & (x["to_word"] | (end < F.size(words)))
            return inside & (F.slice(words, x["first"] + 1, F.size(x["term"])) == x["term"])

        def placed(starts: Column, right: Column) -> Column:
            def span(x: Column) -> Column:
                return bind(start_of(x["first"], starts, words), lambda start: F.struct(
                    x["number"].alias("number"), start.alias("start"), (start + F.char_length(F.array_join(x["term"], ""))).alias("end")))

            # Only of a term that can overlap itself a span may be in the way of another.
            plain = F.transform(F.transform(F.filter(right, lambda x: ~x["again"]), span), lambda s: span_number(s["start"], s["end"]))
            return sorted_spans(plain, F.transform(F.filter(right, lambda x: x["again"]), span))

        return bind(step_starts(words), lambda starts: bind(F.filter(tried, held), lambda right: placed(starts, right)))

    return bind(words, checked)
