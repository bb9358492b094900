"""Download links in portal pages."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Classes of the package blocks, date and link marks.
CONTAINER, INFO, ACTIONS = "pkg-container", "package-info", "pkg-actions"
DATE_IN_TEXT = r"(\d{4}-\d{2}-\d{2})"
LINK_MARKS = ("download", ".zip")
BUTTON_TEXT = "DESCARGAR"

HREF = r'href="([^"]*)"'
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


def page_links(pages: DataFrame) -> DataFrame:
    """Every archive link of a page table: page_id, position, href."""
    links = pages.select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit(HREF), 1)).alias("posicion", "href"))
    lower = F.lower("href")
    return links.filter(lower.contains(LINK_MARKS[0]) | lower.contains(LINK_MARKS[1]))


class _Packages(HTMLParser):
    """Collects (info text, action links, button links) of each package block."""

    def __init__(self) -> None:
        super().__init__()
        self.stack: list[tuple[str, str | None]] = []
        self.found: list[dict] = []
        self.link: str | None = None
        self.link_text = ""

    def _inside(self, role: str) -> bool:
        return any(r == role for _, r in self.stack)

    def handle_starttag(self, tag, attrs):
        attributes = dict(attrs)
        classes = (attributes.get("class") or "").split()
        role = next((r for r in (CONTAINER, INFO, ACTIONS) if r in classes), None)
        if role == CONTAINER and not self._inside(CONTAINER):
            self.found.append({"info": "", "closed": False, "actions": [], "buttons": []})
        if tag == "p" and self._inside(INFO):
            role = "text"
        if tag == "a" and attributes.get("href") and self._inside(CONTAINER):
            self.link, self.link_text = attributes["href"], ""
            if self._inside(ACTIONS):
                self.found[-1]["actions"].append(self.link)
        if tag not in _VOID:
            self.stack.append((tag, role))

    def handle_data(self, data):
        if self._inside(CONTAINER):
            if self._inside("text") and not self.found[-1]["closed"]:
                self.found[-1]["info"] += data
            if self.link is not None:
                self.link_text += data

    def handle_endtag(self, tag):
        if tag == "a" and self.link is not None:
            if BUTTON_TEXT in self.link_text:
                self.found[-1]["buttons"].append(self.link)
            self.link = None
        while self.stack and any(t == tag for t, _ in self.stack):
            open_tag, role = self.stack.pop()
            if role == "text" and self.found:
                self.found[-1]["closed"] = True
            if open_tag == tag:
                break


def _package_links(html: str) -> list[tuple[str, str]]:
    parser = _Packages()
    parser.feed(html)
    links = []
    for block in parser.found:
        day = re.search(DATE_IN_TEXT, block["info"])
        if not day:
            continue
        marked = [h for h in block["actions"] if any(m in h.lower() for m in LINK_MARKS)]
        href = next(iter(marked + block["buttons"]), None)
        if href is not None:
            links.append((day.group(1), href))
    return links


def package_links(pages: DataFrame) -> DataFrame:
    """Dated packages of portal pages: page_id, position, day text, download link."""

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (page, position, day, href)
                for page, html in zip(batch["page_id"], batch["html"])
                for position, (day, href) in enumerate(_package_links(html or ""))
            ]
            yield pd.DataFrame(rows, columns=["page_id", "posicion", "fecha", "href"])

    schema = "page_id bigint, posicion int, fecha string, href string"
    return pages.select("page_id", "html").mapInPandas(extract, schema)


def link_for_day(links: DataFrame, day: str) -> DataFrame:
    """First link per page for a business date."""
    wanted = links.filter(F.col("fecha") == day)
    return wanted.groupBy("page_id").agg(F.min_by("href", "posicion").alias("href"))
