"""Column functions for text. Every function takes and returns a Column."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelens.fixed_values import ELSEWHERE, OTHER

# White space as Unicode text handling understands it, with the four ASCII separators that
# Java's \s leaves out even in Unicode mode. Use SPACE together with the flag (?U).
SPACE = r"[\s\x1c-\x1f]"
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# A word character: letter, number or underscore.
WORD = r"[\p{L}\p{N}_]"
# List bullets and dashes.
BULLETS = "[•●▪️■□○★☆‣⁃∙–—-]"
# The same class behind a range test that most characters fail at once.
FAST_BULLETS = rf"[\x2d\u2013-\ufe0f&&{BULLETS}]"
# A run of white space that is not a single space already.
UNTIDY_SPACE = rf"(?U)(?: (?={SPACE})|[\s\x1c-\x1f&&[^ ]]){SPACE}*"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)`, with `value` worked out once however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c: Column) -> Column:
    """Remove white space of any kind from both ends."""
    return F.btrim(c, F.lit(SPACE_CHARS))


def is_blank(c: Column) -> Column:
    return strip(F.coalesce(c, F.lit(""))) == ""


def collapse_spaces(c: Column) -> Column:
    """Turn every run of white space into one space and trim the ends."""
    return strip(F.regexp_replace(c, UNTIDY_SPACE, " "))


def default_blank(c: Column, default: str) -> Column:
    """`default` where the text is null or blank, else the trimmed text."""
    return F.when(is_blank(c), F.lit(default)).otherwise(strip(c))


def is_usable(c: Column) -> Column:
    """True for a text that can be the key or the value of a reported line: not blank, no tab."""
    return ~is_blank(c) & ~c.contains("\t")


def one_line(c: Column) -> Column:
    """Line ends become spaces, ends are trimmed, null becomes the empty text."""
    return strip(F.translate(F.coalesce(c, F.lit("")), "\r\n", "  "))


def clean_requirements(c: Column) -> Column:
    """Drop the [Required]/[Preferred] tags and skill-list tails, collapse white space."""
    untagged = F.regexp_replace(c, r"\[(?:Required|Preferred)\]", "")
    trimmed = F.regexp_replace(untagged, rf"(?iud)(?<!{WORD})(?:Skill Required|Kỹ năng[:&]).*", "")
    return collapse_spaces(trimmed)


def clean_text(c: Column) -> Column:
    """Drop markup, turn bullets and dashes into spaces, collapse white space."""
    bare = F.regexp_replace(c, "<[^>]+>", "")
    return collapse_spaces(F.regexp_replace(bare, FAST_BULLETS, " "))


def split_sentences(c: Column) -> Column:
    """Array of the trimmed, non-blank sentences; a sentence ends at . ! or ? before white space."""
    parts = F.split(c, rf"(?U)(?<=[.!?]){SPACE}+")
    return F.filter(F.transform(parts, strip), lambda s: s != "")


def split_cities(c: Column) -> Column:
    """Array of the places a location names; parts that say "elsewhere" are left out."""
    parts = F.transform(F.split(F.coalesce(c, F.lit("")), "[,&]| và "), strip)
    return F.filter(parts, lambda p: (p != "") & ~F.lower(p).contains(OTHER))


def is_single_city(c: Column) -> Column:
    """True where the location names one place only. Null stays null."""
    return ~c.rlike("[&,]") & ~F.lower(c).contains(ELSEWHERE)


def first_number(c: Column) -> Column:
    """First run of digits, empty text if there is none."""
    return F.regexp_extract(c, r"(?U)\d+", 0)


def parse_skill_list(c: Column) -> Column:
    """Comma-separated text to an array of trimmed names without blanks."""
    parts = F.transform(F.split(F.coalesce(c, F.lit("")), ","), strip)
    return F.filter(parts, lambda s: s != "")


def join_skill_list(c: Column) -> Column:
    """Array of names to one comma-separated text; null gives the empty text."""
    return F.coalesce(F.array_join(F.transform(c, strip), ", "), F.lit(""))


def strip_count(c: Column) -> Column:
    """Remove a trailing number, as in a label with a hit count."""
    return strip(F.regexp_replace(strip(c), rf"(?U){SPACE}*\d+\z", ""))


def strip_parentheses(c: Column) -> Column:
    """Remove parenthesised remarks."""
    return strip(F.regexp_replace(c, rf"(?Ud){SPACE}*\(.*?\)", ""))


def slug(c: Column) -> Column:
    return F.replace(F.lower(c), F.lit(" "), F.lit("-"))


def absolute_url(base: str, link: Column) -> Column:
    """`link` itself when it is absolute, else `link` after `base`."""
    return F.when(link.startswith("http"), link).otherwise(F.concat(F.lit(base), link))


def contains_any(c: Column, needles: list[str]) -> Column:
    """True where the lower-cased text holds one of the needles."""
    hit = F.lit(False)
    for needle in needles:
        hit = hit | F.lower(c).contains(needle.lower())
    return hit
