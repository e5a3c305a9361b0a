"""Visible text of HTML."""

from __future__ import annotations

from html.parser import HTMLParser

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltstone.functions import text as T
from siltstone.functions import words as W


class _Visible(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.title: str | None = None
        self.hidden: list[str] = []
        self.in_title = False

    def handle_starttag(self, tag, attrs):
        if tag in W.HTML_DROPPED_TAGS:
            self.hidden.append(tag)
        self.in_title = tag == "title"

    def handle_endtag(self, tag):
        if tag in self.hidden:
            del self.hidden[len(self.hidden) - 1 - self.hidden[::-1].index(tag) :]
        self.in_title = False

    def handle_data(self, data):
        text = data.strip()
        if text and not self.hidden:
            self.parts.append(text)
            if self.in_title and self.title is None:
                self.title = text


def visible(source: str) -> tuple[str, str | None]:
    """(text, title): strings outside scripts, styles, navigation, forms and the like, a line each; the title stays in the text."""
    parser = _Visible()
    parser.feed(source)
    parser.close()
    return "\n".join(parser.parts), parser.title


def html_reader(content: bytes) -> tuple[str, dict[str, str]]:
    from siltstone.sources.files import decode_any

    source, encoding = decode_any(content)
    text, title = visible(source)
    return text, {"encoding": encoding} | ({"titulo": title} if title else {})


def strip_tags(source: Column | str) -> Column:
    """Without a parser: scripts, styles, noscript and svg become a blank, other tags line breaks, and the five usual entities and the hard blank are read."""
    out = T.col(source)
    for tag in ("script", "style", "noscript", "svg"):
        out = F.regexp_replace(out, rf"(?is)<{tag}.*?</{tag}>", " ")
    out = F.regexp_replace(out, r"(?s)<[^>]+>", "\n")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(char))
    return out


def title(source: Column | str) -> Column:
    """What stands in the first title element, trimmed; null if there is none."""
    found = F.trim(F.regexp_extract(T.col(source), r"(?is)<title[^>]*>(.*?)</title>", 1))
    return F.when(found != "", found)


def links(source: Column | str) -> Column:
    """The targets of all links, in order."""
    return F.regexp_extract_all(T.col(source), F.lit(r'(?i)<a\s[^>]*href="([^"]*)"'), F.lit(1))
