"""Raw postings out of stored pages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens import fixed_values as fixed
from hirelens.functions.dates import resolve_relative_deadline
from hirelens.functions.pages import Page, bullet_text, labelled_pairs, opening, page_pieces, page_tags, pick_field, posting_title, rendered
from hirelens.operators.links import not_blocked
from hirelens.schemas import JOB_FIELDS


@dataclass(frozen=True)
class Pairs:
    """Labels with values: a pattern with two groups, and the keyword of each field's label."""

    pattern: str
    keywords: Mapping[str, str]
    label: int = 1
    value: int = 2


@dataclass(frozen=True)
class Blocks:
    """Labels with values as whole elements: opening tags of both, and the keyword of each field's label.

    With a `container` label and value are the first of their kind in it; without one the value follows the label. `exact` labels are
    the keyword and do not only hold it.
    """

    label: str
    value: str
    keywords: Mapping[str, str]
    container: str = ""
    exact: bool = False


@dataclass(frozen=True)
class PageLayout:
    """Where a site's pages hold the fields of a posting.

    `site` marks page titles that name only the site, `headline` is the opening tag of the title. `fields` are patterns with
    one group, `elements` opening tags of whole elements; a field there that is not found becomes `missing`, any other
    one the empty text. `lists` are patterns of list items, `items` opening tags of them. `copies` are fields that repeat another one.
    """

    site: str
    headline: str = opening("h1")
    fields: Mapping[str, str] = field(default_factory=dict)
    elements: Mapping[str, str] = field(default_factory=dict)
    pairs: Sequence[Pairs | Blocks] = ()
    lists: Mapping[str, str] = field(default_factory=dict)
    items: Mapping[str, str] = field(default_factory=dict)
    copies: Mapping[str, str] = field(default_factory=dict)
    missing: str = ""

    def tags(self) -> list[str]:
        """All opening tags that a page is searched for."""
        blocks = [t for p in self.pairs if isinstance(p, Blocks) for t in (p.container, p.label, p.value) if t]
        return list(dict.fromkeys([self.headline, *self.elements.values(), *blocks, *self.items.values()]))


def first_layout(site: str) -> PageLayout:
    """Pages that name every field in a heading beside it."""
    return PageLayout(
        site=site,
        headline=opening("h1", fixed.TITLE_CLASS),
        elements={"deadline": opening("div", fixed.DEADLINE_CLASS)},
        pairs=[
            Blocks(opening(style=fixed.INFO_KEY_CLASS), opening(style=fixed.INFO_VALUE_CLASS), fixed.INFO_LABELS,
                   container=opening(style=fixed.INFO_CLASS)),
            Blocks(opening("h3"), opening(style=fixed.SECTION_CLASS), fixed.DESCRIPTION_LABELS,
                   container=opening(style=fixed.DESCRIPTION_CLASS)),
        ],
    )


def second_layout(site: str) -> PageLayout:
    """Pages with styled fields, headed blocks and labelled paragraphs."""
    return PageLayout(
        site=site,
        elements={name: opening(tag, style) for name, (tag, style) in fixed.SECOND_CLASSES.items()},
        pairs=[
            Blocks(opening("h2"), opening("div"), fixed.SECOND_SECTION_LABELS),
            Blocks(opening("label"), opening("p"), fixed.SECOND_INFO_LABELS, exact=True),
        ],
        items={"benefits": opening("div", fixed.SECOND_BENEFIT_CLASS)},
        copies={"work_location_detail": "location"},
        missing=fixed.NOT_SCRAPED,
    )


def extract_postings(pages: DataFrame, layout: PageLayout, crawl_date: Column, keep: Sequence[str] = ()) -> DataFrame:
    """One raw posting per page (url, html) that was not blocked, after the columns in `keep`.

    Deadlines given as "expires in N days" are counted from the crawl date. The whole page is read, elements
    nested to any depth included, and its tags are numbered and paired once for all fields; nothing is shuffled.
    """
    html = F.col("html")
    found = not_blocked(pages).withColumn("_pieces", page_pieces(html)).withColumn("_tags", page_tags(F.col("_pieces"), layout.tags()))
    page = Page(F.col("_pieces"), F.col("_tags"), layout.tags())
    columns: dict[str, Column] = {"link": F.col("url"), "title": posting_title(html, layout.site, page.first(layout.headline))}
    for i, pairs in enumerate(layout.pairs):
        if isinstance(pairs, Pairs):
            both = labelled_pairs(html, pairs.pattern, pairs.label, pairs.value)
        elif pairs.container:
            both = page.contained_pairs(pairs.container, pairs.label, pairs.value)
        else:
            both = page.headed_pairs(pairs.label, pairs.value)
        # Its own column, so that the pairs are worked out once for all their fields.
        found = found.withColumn(f"_pairs{i}", both)
        exact = isinstance(pairs, Blocks) and pairs.exact
        columns |= {name: pick_field(F.col(f"_pairs{i}"), name, pairs.keywords, exact) for name in pairs.keywords}
    columns |= {name: bullet_text(html, item) for name, item in layout.lists.items()}
    columns |= {name: page.bullets(tag) for name, tag in layout.items.items()}
    for name, pattern in layout.fields.items():
        value = rendered(F.regexp_extract(html, pattern, 1))
        columns[name] = F.when(html.rlike(pattern), value).otherwise(F.lit(layout.missing))
    columns |= {name: F.coalesce(page.first(tag), F.lit(layout.missing)) for name, tag in layout.elements.items()}
    for name, source in layout.copies.items():
        columns[name] = columns[source]
    columns["deadline"] = resolve_relative_deadline(columns.get("deadline", F.lit("")), crawl_date)
    return found.select(*keep, *[columns.get(name, F.lit("")).alias(name) for name in JOB_FIELDS])
