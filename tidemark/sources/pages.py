"""Records and links from the list items of raw HTML pages.

Pages come as a table. Nested markup cannot be cut out with column expressions,
so each page is parsed inside an Arrow batch; pages without the needed tag never
leave the JVM.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Mapping, Sequence
from html.parser import HTMLParser

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Executors get this module with the task; they need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Where directory pages keep people, and their fields.
PEOPLE_SECTIONS = ("div.section-toggle div.section-body", "div.section-info")
PEOPLE_LIST = "ul"
PEOPLE_FIELDS = {"position": ".rank", "name": ".name", "email": ".email div"}
PEOPLE_REQUIRED = ("position", "name")

# Where directory pages list the units below them.
LINK_SECTIONS = ("div.tab-pane",)
LINK_LIST = "ul.section-listing"

_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_NO_TEXT = frozenset(("script", "style", "template"))


class _Node:
    """An element: tag, attributes, and children that are elements or text."""

    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag, attrs):
        self.tag, self.attrs, self.children = tag, attrs, []

    def below(self):
        """Descendant elements in document order."""
        pending = list(reversed(self.children))
        while pending:
            child = pending.pop()
            if isinstance(child, _Node):
                yield child
                pending.extend(reversed(child.children))

    def text(self):
        """Text below, without that of scripts, styles and templates."""
        parts, pending = [], list(reversed(self.children))
        while pending:
            child = pending.pop()
            if isinstance(child, _Node):
                if child.tag not in _NO_TEXT:
                    pending.extend(reversed(child.children))
            else:
                parts.append(child)
        return "".join(parts)

    def fits(self, simple):
        tag, _, name = simple.partition(".")
        return (not tag or tag == self.tag) and (
            not name or name in (self.attrs.get("class") or "").split()
        )

    def find(self, selector):
        """Follow the blank-separated steps, each to the first fitting descendant."""
        node = self
        for simple in selector.split():
            node = next((n for n in node.below() if n.fits(simple)), None)
            if node is None:
                return None
        return node


class _Tree(HTMLParser):
    """Builds elements; an end tag closes up to its own start, or nothing."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = _Node("", {})
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        node = _Node(tag, dict(attrs))
        self.open[-1].children.append(node)
        if tag not in _VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.open[-1].children.append(_Node(tag, dict(attrs)))

    def handle_endtag(self, tag):
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth].tag == tag:
                del self.open[depth:]
                return

    def handle_data(self, data):
        self.open[-1].children.append(data)

    def parse_marked_section(self, i, report=1):
        """Skip a declaration the parser does not know; one odd page must not end the job."""
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:
            return self.rawdata.find(">", i) + 1 or -1


def _items(html: str, sections: Sequence[str], listing: str) -> Iterator[_Node]:
    """Items of the first list in every section.

    A section selector is `outer` or `outer inner`: all fitting outer elements,
    and in each the first fitting inner one.
    """
    tree = _Tree()
    tree.feed(html)
    tree.close()
    for selector in sections:
        outer, _, inner = selector.partition(" ")
        for section in [n for n in tree.root.below() if n.fits(outer)]:
            body = section.find(inner) if inner else section
            found = body.find(listing) if body is not None else None
            if found is not None:
                yield from (n for n in found.below() if n.tag == "li")


def _field(item: _Node, selector: str) -> str:
    """Text of the selected element, or with `selector@name` an attribute; '' if absent."""
    path, _, attribute = selector.partition("@")
    node = item.find(path) if path else item
    if node is None:
        return ""
    return (node.attrs.get(attribute) or "") if attribute else node.text().strip()


def extract_page_records(
    pages: DataFrame,
    html: str = "html",
    keep: Sequence[str] = ("department", "url"),
    sections: Sequence[str] = PEOPLE_SECTIONS,
    listing: str = PEOPLE_LIST,
    fields: Mapping[str, str] = PEOPLE_FIELDS,
    required: Sequence[str] = PEOPLE_REQUIRED,
) -> DataFrame:
    """One row per list item: the selected fields and the kept page columns.

    An item without text in a required field is dropped; other fields may be ''.
    """
    sections, fields, required, keep = tuple(sections), dict(fields), tuple(required), list(keep)
    schema = T.StructType(
        [T.StructField(f, T.StringType()) for f in fields] + [pages.schema[k] for k in keep]
    )

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for page, *kept in batch.itertuples(index=False, name=None):
                for item in _items(page, sections, listing):
                    record = {f: _field(item, s) for f, s in fields.items()}
                    if all(record[f] for f in required):
                        rows.append((*record.values(), *kept))
            yield pd.DataFrame(rows, columns=[*fields, *keep])

    return _with_items(pages, html).select(html, *keep).mapInPandas(parse, schema)


def extract_page_links(
    pages: DataFrame,
    html: str = "html",
    parent: str = "department",
    sections: Sequence[str] = LINK_SECTIONS,
    listing: str = LINK_LIST,
) -> DataFrame:
    """One row per list item: parent page, text with single blanks, href, place on the page.

    An item without a link has a null href. Places count from 0 over the page.
    """
    sections = tuple(sections)
    schema = T.StructType(
        [
            T.StructField("parent", pages.schema[parent].dataType),
            T.StructField("name", T.StringType()),
            T.StructField("link", T.StringType()),
            T.StructField("ordinal", T.LongType()),
        ]
    )

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (owner, " ".join(item.text().split()), _field(item, "a@href") or None, place)
                for page, owner in batch.itertuples(index=False, name=None)
                for place, item in enumerate(_items(page, sections, listing))
            ]
            yield pd.DataFrame(rows, columns=schema.names)

    return _with_items(pages, html).select(html, parent).mapInPandas(parse, schema)


def _with_items(pages: DataFrame, html: str) -> DataFrame:
    return pages.filter(F.col(html).rlike("(?i)<li"))
