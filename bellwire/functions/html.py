"""Article text and links out of HTML pages."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Where an article's text and a feed's links are found.
ARTICLE_TAG, ARTICLE_CLASS = "div", "article_content"
LINK_CLASS = "news_item"

# Entities that are decoded; the ampersand comes last.
ENTITIES = (
    ("&nbsp;", " "),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&amp;", "&"),
)


def class_pattern(css_class: str) -> str:
    """A class attribute, in either kind of quotes, that names the class as it is written."""
    name = rf"(?-i:{css_class})"
    quoted = [rf"{q}(?:[^{q}]*\s)?{name}(?:\s[^{q}]*)?{q}" for q in ("\"", "'")]
    return rf"\sclass\s*=\s*(?:{'|'.join(quoted)})"


def element_pattern(tag: str, css_class: str | None = None) -> str:
    """Pattern of the inside of the first element with a tag (and class)."""
    if css_class is None:
        return rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}\s*>"
    return rf"(?is)<{tag}(?=\s)[^>]*{class_pattern(css_class)}[^>]*>(.*?)</{tag}\s*>"


def flat_text(html: Column, tag: str, css_class: str | None = None) -> Column:
    """Text of the first such element, ``''`` if none; it must not nest its own tag."""
    inside = F.regexp_extract(html, element_pattern(tag, css_class), 1)
    bare = F.regexp_replace(F.regexp_replace(inside, r"(?s)<!--.*?-->", ""), r"<[^>]*>", "")
    return decoded(bare)


def decoded(text: Column) -> Column:
    """``text`` with the entities of ``ENTITIES`` decoded."""
    for entity, plain in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(plain))
    return text


def nested_text(
    html: Column, tag: str = ARTICLE_TAG, css_class: str | None = ARTICLE_CLASS
) -> Column:
    """Like :func:`flat_text` for elements that nest their own tag, which no pattern can match.

    The parser is defined in here so that it travels with the function: workers need
    not have this package installed.
    """

    class FirstElement(HTMLParser):
        """Collects the text of the first element that matches, nested tags included."""

        def __init__(self) -> None:
            HTMLParser.__init__(self, convert_charrefs=True)
            self.depth, self.done, self.parts = 0, False, []

        def handle_starttag(self, name, attrs):
            if self.done or name != tag:
                return
            classes = (dict(attrs).get("class") or "").split()
            if self.depth:
                self.depth += 1
            elif css_class is None or css_class in classes:
                self.depth = 1

        def handle_endtag(self, name):
            if self.depth and name == tag:
                self.depth -= 1
                self.done = self.depth == 0

        def handle_data(self, data):
            if self.depth:
                self.parts.append(data)

    def text(page: str | None) -> str:
        parser = FirstElement()
        parser.feed(page or "")
        parser.close()
        return "".join(parser.parts)

    @F.pandas_udf("string")
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pages.map(text)

    return extract(html)


def link_targets(html: Column, css_class: str | None = LINK_CLASS) -> Column:
    """``href`` of every link (of a class), in page order, in either kind of quotes and case."""
    anchors = F.regexp_extract_all(html, F.lit(r"(?i)(<a\s[^>]*>)"), F.lit(1))
    if css_class is not None:
        anchors = F.filter(anchors, lambda a: a.rlike(f"(?i){class_pattern(css_class)}"))
    target = r"(?i)\shref\s*=\s*(?:\"([^\"]*)\"|'([^']*)')"
    linked = F.filter(anchors, lambda a: a.rlike(target))
    return F.transform(
        linked,
        lambda a: decoded(F.concat(F.regexp_extract(a, target, 1), F.regexp_extract(a, target, 2))),
    )
