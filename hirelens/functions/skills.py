"""Skill tagging with a lexicon, as column functions.

A term matches wherever it stands between word boundaries, in any letter case. Different terms
may overlap in the text, but one regular expression only reports matches side by side. The
lexicon is therefore cut into a few layers of terms that can never overlap each other, and each
layer costs one pass over the text instead of one pass per term.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelens.fixed_values import SKILL_LEXICON
from hirelens.functions.text import WORD, bind

SPAN = "struct<start:int,end:int>"
# Marks the matches inside a text; the twin replaces it where the text already holds one.
MARK, TWIN = "\x01", "\x02"
# A fold copies its state at every step, so arrays are walked in chunks of this size.
CHUNK = 64


def _fold(term: str) -> str:
    """The term with letter case taken away, as case-blind matching sees it."""
    return term.upper().lower()


def _is_word(char: str) -> bool:
    return char.isalnum() or char == "_"


def _boundary(left: str, right: str) -> bool:
    return _is_word(left) != _is_word(right)


def _can_overlap(first: str, second: str) -> bool:
    """Could some text hold both terms with `second` starting inside `first`?"""
    for shift in range(len(first)):
        shared = min(len(first) - shift, len(second))
        if first[shift:shift + shared] != second[:shared]:
            continue
        text = first + second[shared:] if len(second) > shared else first
        edges = {shift, shift + len(second), len(first)} - {0, len(text)}
        if all(_boundary(text[e - 1], text[e]) for e in edges):
            return True
    return False


def layers(terms: Sequence[str]) -> list[list[str]]:
    """Cut the terms into lists of which no two terms can overlap in a text."""
    result: list[list[str]] = []
    for term in dict.fromkeys(_fold(t) for t in terms):
        for layer in result:
            if not any(_can_overlap(term, t) or _can_overlap(t, term) for t in layer):
                layer.append(term)
                break
        else:
            result.append([term])
    return result


def _any_case(chars: set[str]) -> str:
    """Character class of the given characters in upper and lower case."""
    every = {form for c in chars for form in (c.lower(), c.upper()) if len(form) == 1}
    # Two signs outside ASCII count as case forms of an ASCII letter.
    every |= {sign for letter, sign in (("s", "\u017f"), ("k", "\u212a")) if letter in chars}
    return "[" + "".join(re.escape(c) for c in sorted(every)) + "]"


def lexicon_pattern(terms: Sequence[str]) -> str:
    """One Java regular expression for all terms, sorted by edge and first character.

    The boundary tests are written out as look-arounds, so that "word" means the same thing
    under every Java version. The cheap test for a possible first character comes first.
    """
    tree: dict = defaultdict(lambda: defaultdict(lambda: defaultdict(list)))
    for term in dict.fromkeys(_fold(t) for t in terms):
        tree[_is_word(term[0])][_is_word(term[-1])][term[0]].append(term[1:])
    lefts = []
    for left_word, rights in tree.items():
        choices = []
        for right_word, firsts in rights.items():
            bodies = [
                re.escape(first) + "(?:" + "|".join(re.escape(rest) for rest in rests) + ")"
                for first, rests in firsts.items()
            ]
            edge = f"(?!{WORD})" if right_word else f"(?={WORD})"
            choices.append("(?:" + "|".join(bodies) + ")" + edge)
        starts = _any_case({first for firsts in rights.values() for first in firsts})
        edge = f"(?<!{WORD})" if left_word else f"(?<={WORD})"
        lefts.append(f"(?={starts}){edge}(?iu:" + "|".join(choices) + ")")
    return "|".join(lefts)


def mentions_skill(text: Column, lexicon: Sequence[str] = SKILL_LEXICON) -> Column:
    """True where the text holds at least one term."""
    return F.coalesce(text.rlike(lexicon_pattern(lexicon)), F.lit(False))


def collect(
    items: Column,
    state: dict[str, Column],
    step: Callable[[Column, Column], tuple[dict[str, Column], Column, Column]],
    kind: str,
) -> Column:
    """Walk over an array with a state and collect an array of `kind`.

    `step` gets the state and an item and returns the next state, whether to collect something
    at this item, and what. Of more than one chunk, a first walk only finds the state at the start of each; then
    each chunk collects for itself. The work grows with the length of the array, not its square.
    """
    def packed(columns: dict[str, Column]) -> Column:
        return F.struct(*[c.alias(name) for name, c in columns.items()])

    def advance(acc: Column, chunk: Column) -> Column:
        after = F.aggregate(chunk, acc["now"], lambda now, item: packed(step(now, item)[0]))
        return packed({"now": after, "starts": F.concat(acc["starts"], F.array(acc["now"]))})

    def gather(acc: Column, item: Column) -> Column:
        following, take, value = step(acc["now"], item)
        found = F.when(take, F.concat(acc["found"], F.array(value))).otherwise(acc["found"])
        return packed({"now": packed(following), "found": found})

    def of_chunk(chunk: Column, start: Column) -> Column:
        begin = packed({"now": start, "found": F.array().cast(f"array<{kind}>")})
        return F.aggregate(chunk, begin, gather, lambda acc: acc["found"])

    start = packed(state)
    no_starts = F.slice(F.array(start), 1, 0)

    def cut(items: Column) -> Column:
        last = F.floor(F.greatest(F.size(items) - 1, F.lit(0)) / F.lit(CHUNK)).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(items, i * CHUNK + 1, CHUNK))

    def join(chunks: Column) -> Column:
        starts = F.aggregate(chunks, packed({"now": start, "starts": no_starts}), advance, lambda acc: acc["starts"])
        return F.when(F.size(chunks) == 1, of_chunk(F.get(chunks, F.lit(0)), start)).otherwise(F.flatten(F.zip_with(chunks, starts, of_chunk)))

    return bind(items, lambda items: bind(cut(items), join))


def _span(start: Column, end: Column) -> Column:
    return F.struct(start.alias("start"), end.alias("end"))


def _layer_spans(text: Column, pattern: str) -> Column:
    # With every match between two marks, splitting gives gap, match, gap, match, ..., gap.
    marked = F.regexp_replace(F.replace(text, F.lit(MARK), F.lit(TWIN)), pattern, f"{MARK}$0{MARK}")

    def step(acc: Column, part: Column):
        end = acc["at"] + F.char_length(part)
        return {"at": end, "hit": ~acc["hit"]}, acc["hit"], _span(acc["at"], end)

    def spans(pieces: Column) -> Column:
        found = collect(pieces, {"at": F.lit(0), "hit": F.lit(False)}, step, SPAN)
        return F.when(F.size(pieces) > 1, found).otherwise(F.array().cast(f"array<{SPAN}>"))

    return bind(F.split(marked, MARK), spans)


def skill_spans(text: Column, lexicon: Sequence[str] = SKILL_LEXICON) -> Column:
    """All matches as [start, end) in characters, each span once, by start and end."""
    text = F.coalesce(text, F.lit(""))
    found = [_layer_spans(text, lexicon_pattern(layer)) for layer in layers(lexicon)]
    return found[0] if len(found) == 1 else F.sort_array(F.concat(*found))


def non_overlapping(spans: Column) -> Column:
    """Walk the spans by start and end, keep each one that begins after the last kept one."""
    def step(acc: Column, span: Column):
        fits = span["start"] >= acc["last"]
        return {"last": F.when(fits, span["end"]).otherwise(acc["last"])}, fits, _span(span["start"], span["end"])

    def kept(spans: Column) -> Column:
        # One span overlaps none.
        return F.when(F.size(spans) < 2, spans).otherwise(collect(spans, {"last": F.lit(-1)}, step, SPAN))

    return bind(F.sort_array(spans), kept)


def span_texts(text: Column, spans: Column) -> Column:
    """The pieces of text the spans stand for."""
    return F.transform(spans, lambda s: F.substr(text, s["start"] + 1, s["end"] - s["start"]))


def tag_skills(text: Column, lexicon: Sequence[str] = SKILL_LEXICON) -> Column:
    """Skills named in the text, in order, as written there, repeats kept."""
    return span_texts(text, non_overlapping(skill_spans(text, lexicon)))
