"""Column functions that pick posting fields out of stored HTML."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelens.fixed_values import NO_TITLE
from hirelens.functions.text import bind, strip, strip_parentheses

TITLE = r"(?is)<title[^>]*>(.*?)</title>"
LIST_ITEM = r"(?is)<li[^>]*>(.*?)</li>"
LINK = r'(?is)<a\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a>'
TAG = r"</?[A-Za-z][^>]*>"
# Marks the tags of a page; the twin replaces it where the page already holds one.
MARK, TWIN = "\x01", "\x02"
# Elements that stand on lines of their own.
LINE_TAG = r"(?i)<br\s*/?>|</?(?:p|div|ul|ol|li|h[1-6]|table|tr|section|article|header|footer)\b[^>]*>"


def opening(tag: str = r"\w+", style: str = "") -> str:
    """Opening tag of an element, `tag` being a pattern; with `style`, one whose class names it."""
    named = rf'[^>]*\bclass="(?:[^"]*\s)?{re.escape(style)}(?:\s[^"]*)?"' if style else ""
    return rf"<(?:{tag})\b{named}[^>]*>"


def rendered(html: Column) -> Column:
    """Text of an HTML fragment: line ends around blocks, no tags, common entities resolved, lines and ends trimmed."""
    text = F.regexp_replace(F.regexp_replace(html, LINE_TAG, "\n"), "<[^>]+>", "")
    text = F.regexp_replace(text, r"[ \t\r]*\n[ \t\r\n]*", "\n")
    for entity, char in (
        ("&nbsp;", "\xa0"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"),
    ):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return strip(text)


def from_first(html: Column, tag: str) -> Column:
    """The page from the first such opening tag on, null if there is none."""
    return F.nullif(F.regexp_extract(html, f"(?is)({tag}.*)", 1), F.lit(""))


def page_pieces(html: Column) -> Column:
    """The page as an array of text, tag, text, tag, ..., text."""
    marked = F.regexp_replace(F.replace(F.coalesce(html, F.lit("")), F.lit(MARK), F.lit(TWIN)), TAG, f"{MARK}$0{MARK}")
    return F.split(marked, MARK)


def page_tags(pieces: Column, kinds: Sequence[str]) -> Column:
    """Array of (at, end, k0, k1, ...) of all tags in page order: the tag's number, that of the end tag that matches it (the
    number of tags if none does), and whether it is an opening tag of each of the given patterns.

    Tags are sorted by name. Among those of one name, a tag's place and its place among the opening ones give its depth;
    sorted by name and depth, every opening tag stands right before the end tag that matches it. So nothing is walked
    with a growing state, and a page costs about as much as its tags.
    """
    count = F.floor(F.size(pieces) / 2).cast("int")

    def tag(i: Column) -> Column:
        name = F.regexp_extract(F.get(pieces, 2 * i + 1), r"^</?(\w+)", 1)
        return F.struct(F.lower(name).alias("name"), i.alias("at"), F.startswith(F.get(pieces, 2 * i + 1), F.lit("</")).alias("closes"))

    def placed(closes: bool) -> Column:
        """Of the sorted tags (bound below) those that open or close, with their depth."""
        def depth(x: Column, k: Column) -> Column:
            level = x["i"] - 2 * k if closes else 2 * k + 1 - x["i"]
            return F.struct(x["tag"]["name"].alias("name"), level.alias("level"), x["tag"]["at"].alias("at"), F.lit(closes).alias("closes"))

        return lambda tags: F.transform(F.filter(tags, lambda x: x["tag"]["closes"] == closes), depth)

    def paired(tags: Column) -> Column:
        def end(x: Column, i: Column) -> Column:
            following = F.get(tags, i + 1)
            met = (~x["closes"]) & following["closes"] & (following["name"] == x["name"]) & (following["level"] == x["level"])
            return F.struct(x["at"].alias("at"), F.when(met, following["at"]).otherwise(count).alias("end"), x["closes"].alias("closes"))

        return F.sort_array(F.transform(tags, end))

    def flagged(x: Column) -> Column:
        flags = [(~x["closes"] & F.rlike(F.get(pieces, 2 * x["at"] + 1), F.lit(f"(?is)^{kind}$"))).alias(f"k{i}") for i, kind in enumerate(kinds)]
        return F.struct(x["at"], x["end"], *flags)

    numbers = F.slice(F.sequence(F.lit(0), count), F.lit(1), count)
    by_name = F.transform(F.sort_array(F.transform(numbers, tag)), lambda x, i: F.struct(x.alias("tag"), i.alias("i")))
    by_depth = bind(by_name, lambda tags: F.sort_array(F.concat(placed(False)(tags), placed(True)(tags))))
    return F.transform(bind(by_depth, paired), flagged)


class Page:
    """Elements of a page whose pieces and tags are columns, so that all fields share one walk over it."""

    def __init__(self, pieces: Column, tags: Column, kinds: Sequence[str]) -> None:
        self.pieces, self.tags, self.kinds = pieces, tags, list(kinds)

    def _is(self, tag: Column, kind: str) -> Column:
        return tag[f"k{self.kinds.index(kind)}"]

    def between(self, first: Column, end: Column) -> Column:
        """The tags with numbers from `first` on, up to `end`."""
        return F.slice(self.tags, first + 1, F.greatest(end - first, F.lit(0)))

    def content(self, tag: Column, limit: Column | None = None) -> Column:
        """What stands in the element that the tag opens, up to the tag with the number `limit` at most."""
        end = tag["end"] if limit is None else F.least(tag["end"], limit)
        return F.array_join(F.slice(self.pieces, 2 * tag["at"] + 3, 2 * (end - tag["at"]) - 1), "")

    def all(self, kind: str, among: Column | None = None) -> Column:
        return F.filter(self.tags if among is None else among, lambda t: self._is(t, kind))

    def first(self, kind: str, among: Column | None = None, limit: Column | None = None) -> Column:
        """Text of the first element of the kind, null if there is none."""
        tag = F.get(self.all(kind, among), F.lit(0))
        return bind(tag, lambda t: F.when(t.isNotNull(), rendered(self.content(t, limit))))

    def contained_pairs(self, container: str, label: str, value: str) -> Column:
        """Array of (label, value) texts: the first of each in every container that has both."""
        def pair(box: Column) -> Column:
            return bind(self.between(box["at"] + 1, box["end"]), lambda inside: F.struct(
                self.first(label, inside, box["end"]).alias("label"), self.first(value, inside, box["end"]).alias("value")))

        return F.filter(F.transform(self.all(container), pair), lambda p: p["label"].isNotNull() & p["value"].isNotNull())

    def headed_pairs(self, label: str, value: str) -> Column:
        """Array of (label, value) texts: every label with the first such element after it and before the next label."""
        def pairs(labels: Column) -> Column:
            def pair(x: Column, i: Column) -> Column:
                near = F.get(labels, i + 1)["at"]
                # Only a label inside another one is not simply followed by the next.
                later = F.when(near < x["end"], F.get(F.filter(labels, lambda y: y["at"] > x["end"]), F.lit(0))["at"]).otherwise(near)
                following = F.coalesce(later, F.size(self.tags))
                found = bind(following, lambda stop: self.first(value, self.between(x["end"] + 1, stop), stop))
                return F.struct(rendered(self.content(x)).alias("label"), F.when(x["end"] < F.size(self.tags), found).alias("value"))

            return F.transform(labels, pair)

        return F.filter(bind(self.all(label), pairs), lambda p: p["value"].isNotNull())

    def bullets(self, kind: str) -> Column:
        """Every element of the kind as a line `- text`, all lines in one text."""
        return _bullets(F.transform(self.all(kind), lambda t: rendered(self.content(t))))


def with_page(html: Column, kinds: Sequence[str], body: Callable[[Page], Column]) -> Column:
    """`body` of the page, for a single column; several columns had better share the pieces and tags as columns."""
    return bind(page_pieces(html), lambda pieces: bind(page_tags(pieces, kinds), lambda tags: body(Page(pieces, tags, kinds))))


def element(start: Column) -> Column:
    """(content, rest): what stands between the opening tag that the text begins with and the end tag that matches it,
    and what follows. Elements of the same name inside are part of it. Without an end tag the content is all that follows.
    """
    def cut(page: Page) -> Column:
        tag = F.get(page.tags, F.lit(0))
        return F.struct(page.content(tag).alias("content"), F.array_join(F.slice(page.pieces, 2 * tag["end"] + 3, F.size(page.pieces)), "").alias("rest"))

    return with_page(start, [], cut)


def text_of_first(html: Column, tag: str) -> Column:
    """Text of the first element with such an opening tag, null if there is none."""
    return with_page(html, [tag], lambda page: page.first(tag))


def page_title(html: Column) -> Column:
    return rendered(F.regexp_extract(html, TITLE, 1))


def posting_title(html: Column, site: str, headline: Column | None = None) -> Column:
    """Headline without remarks; without a headline the page title, unless it only names the site.

    `headline` is the text of the headline, by default that of the first h1.
    """
    title = page_title(html)
    fallback = F.when(F.lower(title).contains(site.lower()), F.lit(NO_TITLE)).otherwise(title)
    return F.coalesce(strip_parentheses(text_of_first(html, opening("h1")) if headline is None else headline), fallback)


def labelled_pairs(html: Column, pattern: str, label: int = 1, value: int = 2) -> Column:
    """Array of (label, value) texts for every match of the pattern, in page order."""
    labels = F.regexp_extract_all(html, F.lit(pattern), F.lit(label))
    values = F.regexp_extract_all(html, F.lit(pattern), F.lit(value))
    return F.transform(
        F.arrays_zip(labels.alias("label"), values.alias("value")),
        lambda p: F.struct(rendered(p["label"]).alias("label"), rendered(p["value"]).alias("value")),
    )


def contained_pairs(html: Column, container: str, label: str, value: str) -> Column:
    """Array of (label, value) texts: the first of each in every container that has both."""
    return with_page(html, [container, label, value], lambda page: page.contained_pairs(container, label, value))


def headed_pairs(html: Column, label: str, value: str) -> Column:
    """Array of (label, value) texts: every label with the first such element after it and before the next label."""
    return with_page(html, [label, value], lambda page: page.headed_pairs(label, value))


def pick_field(pairs: Column, field: str, keywords: Mapping[str, str], exact: bool = False) -> Column:
    """Value of the last pair whose label belongs to `field`, empty text if there is none.

    A label belongs to the first field whose keyword it holds, or with `exact` is, in any letter case.
    """
    def belongs(pair: Column) -> Column:
        owner, label = F.lit(None).cast("string"), F.lower(pair["label"])
        for name, keyword in reversed(keywords.items()):
            hit = label == keyword.lower() if exact else label.contains(keyword.lower())
            owner = F.when(hit, F.lit(name)).otherwise(owner)
        return F.coalesce(owner == field, F.lit(False))

    return F.coalesce(F.try_element_at(F.filter(pairs, belongs), F.lit(-1))["value"], F.lit(""))


def _bullets(items: Column) -> Column:
    return F.array_join(F.transform(items, lambda i: F.concat(F.lit("- "), i, F.lit("\n"))), "")


def bullet_text(html: Column, item: str = LIST_ITEM) -> Column:
    """Every match of a pattern of list items as a line `- text`, all lines in one text."""
    return _bullets(F.transform(F.regexp_extract_all(html, F.lit(item), F.lit(1)), rendered))


def bullet_elements(html: Column, tag: str) -> Column:
    """The same for every element with such an opening tag."""
    return with_page(html, [tag], lambda page: page.bullets(tag))


def page_links(html: Column) -> Column:
    """Array of the link targets on the page, in page order."""
    return F.regexp_extract_all(html, F.lit(LINK), F.lit(1))
