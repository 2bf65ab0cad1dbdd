"""Scraped pages to meeting records.

Reading HTML needs a parser Spark does not have, so one Arrow step pulls the
few texts a record is made of out of each page. Everything done with those
texts afterwards is column functions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import asdict, dataclass
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.values import parse_month_day_year
from ..operators.select import within_window


@dataclass(frozen=True)
class ListingLayout:
    """Class names of a listing page, one container per meeting."""

    # Classes of the page elements.
    container: str = "row borderBottomNone paginationItem"
    details: str = "col-xs-12 col-sm-8 col-md-9"
    date: str = "videoDate"
    agenda: str = "titleExcerptText"
    media: str = "col-xs-12 col-sm-4 col-md-3"


@dataclass(frozen=True)
class SingleLayout:
    """Class names of the page of a single meeting."""

    # Classes and ids of the page elements.
    details: str = "programDescription col-xs-12 col-sm-4"
    title: str = "episodeTitle"
    date: str = "episodeDate"
    agenda: str = "episodeDescription"
    main: str = "mainContent"


_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class _Node:
    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []

    def walk(self) -> Iterator[_Node]:
        for child in self.children:
            if isinstance(child, _Node):
                yield child
                yield from child.walk()

    def find(self, tag: str, **attrs: str) -> _Node | None:
        matches = (n for n in self.walk() if n.tag == tag and all(n.attrs.get(k) == v for k, v in attrs.items()))
        return next(matches, None)

    def text(self) -> str:
        return "".join(c if isinstance(c, str) else c.text() for c in self.children)


class _Page(HTMLParser):
    def __init__(self, html: str):
        super().__init__()
        self.root = _Node("", {})
        self.open = [self.root]
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        node = _Node(tag, {k: " ".join((v or "").split()) if k == "class" else v or "" for k, v in attrs})
        self.open[-1].children.append(node)
        if tag not in _VOID:
            self.open.append(node)

    def handle_endtag(self, tag):
        depth = max((i for i, n in enumerate(self.open) if n.tag == tag), default=0)
        if depth:
            del self.open[depth:]

    def handle_data(self, data):
        self.open[-1].children.append(data)


def _text(node: _Node | None) -> str | None:
    return None if node is None else node.text()


def _agenda(block: _Node | None) -> str | None:
    return None if block is None else _text(block.find("p") or block)


def _listing_pieces(page: _Page, layout: dict[str, str]) -> Iterator[tuple]:
    for box in page.root.walk():
        if box.tag != "div" or box.attrs.get("class") != layout["container"]:
            continue
        details = box.find("div", **{"class": layout["details"]}) or _Node("", {})
        media = box.find("div", **{"class": layout["media"]}) or _Node("", {})
        link = media.find("a")
        attrs = link.attrs if link else {}
        date = details.find("div", **{"class": layout["date"]})
        agenda = details.find("div", **{"class": layout["agenda"]})
        yield _text(details.find("h2")), _text(date), _agenda(agenda), attrs.get("onclick"), attrs.get("href")


def _single_pieces(page: _Page, layout: dict[str, str]) -> Iterator[tuple]:
    details = page.root.find("div", **{"class": layout["details"]})
    if details is None:
        return
    main = page.root.find("div", id=layout["main"])
    date = details.find("div", **{"class": layout["date"]})
    direct = next((c for c in date.children if isinstance(c, str)), None) if date else None
    agenda = details.find("div", **{"class": layout["agenda"]})
    script = _text(main.find("script")) if main else None
    yield _text(details.find("div", **{"class": layout["title"]})), direct, _agenda(agenda), script, None


def _pieces(pages: DataFrame, layout: ListingLayout | SingleLayout) -> DataFrame:
    extract = _listing_pieces if isinstance(layout, ListingLayout) else _single_pieces
    names = asdict(layout)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (url, n, *piece)
                for url, html in zip(batch["url"], batch["html"])
                for n, piece in enumerate(extract(_Page(html or ""), names))
            ]
            yield pd.DataFrame(rows, columns=["url", "position", "title", "date", "agenda", "script", "href"])

    schema = "url string, position int, title string, date string, agenda string, script string, href string"
    return pages.select("url", "html").mapInPandas(parse, schema)


def page_records(
    pages: DataFrame,
    now: Column,
    layout: ListingLayout | SingleLayout,
    video_host: str,
    caption_base: str,
    days: int | None = None,
    backfill: bool = False,
) -> DataFrame:
    """Meeting records with a `status`: parsed, out-of-bounds or unparseable.

    A record needs an agenda and a video; one dated outside the last `days` is
    out of bounds unless it is a backfill. The default is 8 days for a listing
    and 14 for a single page.
    """
    listing = isinstance(layout, ListingLayout)
    span = days if days is not None else (8 if listing else 14)
    source = tx.resolve_route(F.col("url"), F.col("href")) if listing else F.col("url")
    pieces = _pieces(pages, layout).select(
        "url",
        "position",
        tx.clean_web_string(tx.normalize_name(F.col("title"))).alias("body"),
        parse_month_day_year(F.col("date")).alias("event_datetime"),
        tx.split_agenda(F.col("agenda")).alias("minutes_items"),
        source.alias("source_uri"),
        tx.video_uri(F.col("script"), video_host).alias("video_uri"),
        tx.caption_uri(F.col("script"), caption_base).alias("caption_uri"),
    )
    whole = F.col("minutes_items").isNotNull() & F.col("video_uri").isNotNull()
    whole = whole & F.col("event_datetime").isNotNull()
    admitted = within_window(F.col("event_datetime"), now, span, backfill)
    status = F.when(~whole, "unparseable").when(~admitted, "out-of-bounds").otherwise("parsed")
    return pieces.withColumn("status", status)


def list_item_links(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """Targets of links that open a list item: `(key, position, href)`."""
    links = F.regexp_extract_all(html, F.lit('<li><a href="([^"]*)"'), 1)
    return pages.select(key, F.posexplode(links).alias("position", "href"))


def outcome_counts(records: DataFrame, key: str) -> DataFrame:
    """Per source, how many records parsed, fell out of bounds or failed."""
    return records.groupBy(key).agg(
        F.count_if(F.col("status") == "parsed").alias("success"),
        F.count_if(F.col("status") == "out-of-bounds").alias("warning"),
        F.count_if(F.col("status") == "unparseable").alias("error"),
    )
