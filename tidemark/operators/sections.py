"""Cut the risk-factor section out of filing HTML.

Only the step from HTML to text needs Python (the standard library parser inside an Arrow
function); finding the heading and the end of the section are Spark expressions.
"""

from __future__ import annotations

import re
from html import unescape
from html.entities import html5
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import text as X
from tidemark.schemas import assert_columns

# Patterns, tags and limits that decide what counts as the section.
HEADING = (
    r"(?:item\s+1a\.?\s*[:\-–—]?\s*risk\s+factors"
    r"|risk\s+factors\s*[:\-–—]?\s*item\s+1a|item\s+1a\b)"
)
BOUNDARY = (
    r"(?:item\s+1b\.?\s*[:\-–—]?\s*unresolved\s+staff\s+comments"
    r"|item\s+1b\.?\b|item\s+1c\.?\b|item\s+2\.?\b|item\s+3\.?\b)"
)
LINK_TEXT = r"item\s+1a"
INLINE_XBRL_TAGS = frozenset({"ix:nonnumeric", "ix:continuation", "ix:header"})
SKIPPED_TAGS = frozenset({"script", "style", "header", "footer"})
CONTENTS_GAP = 150
MIN_SECTION_CHARS = 30
HEADING_NOT_FOUND = "ITEM_1A_HEADING_NOT_FOUND"
SECTION_TOO_SHORT = "EXTRACTED_SECTION_TOO_SHORT"
# HTML elements without an end tag.
VOID_TAGS = frozenset(
    "area base br col embed hr img input keygen link menuitem meta param source track wbr".split()
)
_LINK = re.compile(LINK_TEXT, re.IGNORECASE)
_FLAGS = "(?isuU)"


class _TextCollector(HTMLParser):
    """Collects text nodes in document order, leaving out skipped subtrees and marked links."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=False)
        self.open: list[tuple[str, int | None]] = []
        self.nodes: list[str] = []
        self.pending: list[str] = []
        self.inline_xbrl = False

    def _flush(self) -> None:
        if not self.pending:
            return
        node = "".join(self.pending)
        self.pending.clear()
        if not any(tag in SKIPPED_TAGS for tag, _ in self.open):
            self.nodes.append(node if node.strip() else ("\n" if "\n" in node else " "))

    def _close(self, index: int) -> None:
        while len(self.open) > index:
            _, first_node = self.open.pop()
            if first_node is not None and _LINK.search("".join(self.nodes[first_node:])):
                del self.nodes[first_node:]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self._flush()
        self.inline_xbrl |= tag in INLINE_XBRL_TAGS
        if tag in VOID_TAGS:
            return
        target = dict(attrs).get("href") or ""
        linked = tag == "a" and target.startswith("#")
        self.open.append((tag, len(self.nodes) if linked else None))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self._flush()
        self.inline_xbrl |= tag in INLINE_XBRL_TAGS

    def handle_endtag(self, tag: str) -> None:
        self._flush()
        for index in range(len(self.open) - 1, -1, -1):
            if self.open[index][0] == tag:
                self._close(index)
                return

    def handle_data(self, data: str) -> None:
        self.pending.append(data)

    def handle_entityref(self, name: str) -> None:
        self.pending.append(html5.get(f"{name};", f"&{name}"))

    def handle_charref(self, name: str) -> None:
        self.pending.append(unescape(f"&#{name};"))

    def handle_comment(self, data: str) -> None:
        self._flush()

    def handle_decl(self, decl: str) -> None:
        self._flush()

    def handle_pi(self, data: str) -> None:
        self._flush()

    def unknown_decl(self, data: str) -> None:
        self._flush()
        if data.upper().startswith("CDATA["):
            self.pending.append(data[len("CDATA[") :])
            self._flush()

    def finish(self) -> tuple[str, bool]:
        self.close()
        self._flush()
        self._close(0)
        return "\n".join(self.nodes), self.inline_xbrl


def html_to_text(html: str) -> tuple[str, bool]:
    """Text nodes joined by line feeds, and whether inline XBRL tags occur."""
    collector = _TextCollector()
    collector.feed(html)
    return collector.finish()


_PARSED = T.StructType(
    [T.StructField("full_text", T.StringType()), T.StructField("is_ixbrl", T.BooleanType())]
)


@F.pandas_udf(_PARSED)
def _parse(html: pd.Series) -> pd.DataFrame:
    parsed = [html_to_text(h) if isinstance(h, str) else (None, None) for h in html]
    return pd.DataFrame(parsed, columns=["full_text", "is_ixbrl"])


def page_text(html: Column) -> Column:
    """Readable text of an HTML document with normalised blanks."""
    return X.normalize_whitespace(_parse(html)["full_text"])


def _after(text: Column, pattern: str) -> Column:
    """Text behind the first match."""
    return F.regexp_extract(text, rf"{_FLAGS}\A.*?{pattern}(.*)\z", 1)


def _before(text: Column, pattern: str) -> Column:
    """Text in front of the first match; empty when there is none."""
    return F.regexp_extract(text, rf"{_FLAGS}\A(.*?){pattern}", 1)


def _matches(text: Column, pattern: str) -> Column:
    return F.rlike(text, F.lit(f"{_FLAGS}{pattern}"))


def extract_sections(filings: DataFrame, html_col: str = "html") -> DataFrame:
    """Adds ``text, success, char_count, is_ixbrl, extraction_method, failure_reason, error``.

    Of several headings the first counts, unless the second follows so closely that the first
    must be a line in a table of contents. The section ends at the next item heading; one that
    stands directly at its start does not end it.
    """
    assert_columns(filings, (html_col,), "extract_sections")
    parsed = filings.withColumn("_p", _parse(F.col(html_col))).select(
        *[F.col(c) for c in filings.columns],
        F.col("_p.full_text").alias("_full"),
        F.col("_p.is_ixbrl").alias("is_ixbrl"),
    )
    found = parsed.withColumn("_found", _matches(F.col("_full"), HEADING)).withColumn(
        "_rest", F.when(F.col("_found"), _after(F.col("_full"), HEADING))
    )
    contents_line = _matches(F.col("_rest"), HEADING) & (
        F.length(_before(F.col("_rest"), HEADING)) < CONTENTS_GAP
    )
    started = found.withColumn(
        "_rest", F.when(contents_line, _after(F.col("_rest"), HEADING)).otherwise(F.col("_rest"))
    )
    head = _before(F.col("_rest"), BOUNDARY)
    cut = started.withColumn(
        "text",
        F.coalesce(
            X.strip(F.when(F.length(head) > 0, head).otherwise(F.col("_rest"))), F.lit("")
        ),
    )
    long_enough = F.length("text") >= MIN_SECTION_CHARS
    kind = F.when(F.col("is_ixbrl"), F.lit("ixbrl")).otherwise(F.lit("legacy_html"))
    reason = F.when(~F.col("_found"), F.lit(HEADING_NOT_FOUND)).when(
        ~long_enough, F.lit(SECTION_TOO_SHORT)
    )
    return cut.select(
        *[F.col(c) for c in filings.columns if c != "text"],
        "text",
        (F.col("_found") & long_enough).alias("success"),
        F.length("text").alias("char_count"),
        "is_ixbrl",
        F.when(~F.col("_found"), F.lit("none"))
        .otherwise(
            F.concat(kind, F.when(long_enough, F.lit("_boundary")).otherwise(F.lit("_fallback")))
        )
        .alias("extraction_method"),
        reason.alias("failure_reason"),
        reason.alias("error"),
    )
