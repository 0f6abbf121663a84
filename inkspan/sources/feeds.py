"""The two feeds: list pages of HTML and search answers of JSON, and the paged data source that a connector plugs into."""

from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader

from inkspan.functions import text as T
from inkspan.functions.calls import arguments
from inkspan.functions.dates import from_parts, normalize

HIT_FIELDS = "stored_toc_seq stored_field_subject stored_field_year stored_field_month stored_field_day keyword_field_regdate stored_ebook_no stored_organ_nm stored_category_name stored_field_url stored_pdf_file_path stored_laword_nm keyword_toc_seq".split()
HITS = "data array<struct<category_name string, count string, category_order string, list array<struct<" + ", ".join(f"{f} string" for f in HIT_FIELDS) + ">>>>, error string"
ROW_FIELDS = ["id", "title", "date", "book_name", "category", "agency", "law", "correction_yn", "revision_reason", "content_id", "toc_id", "viewer_path"]


def query(year: Column, institution: Column) -> Column:
    """The search expression of a year, with an institution if one is given."""
    inner = F.concat_ws(" AND ", year.cast("string"), T.nz(institution))
    return F.concat(F.lit("unstored_field_subject:("), inner, F.lit(") AND keyword_category_order:(@@ORDER_NUM)"))


def search_groups(pages: DataFrame, payload: str = "payload") -> DataFrame:
    """The groups of search answers: category, count, hits."""
    a = pages.withColumn("__a", F.from_json(payload, HITS))
    return a.select(*pages.columns, F.posexplode_outer("__a.data").alias("group", "g")).select(*pages.columns, "group", F.col("g.category_name").alias("category_name"), F.col("g.count").try_cast("bigint").alias("count"), F.col("g.list").alias("hits"))


def search_items(pages: DataFrame, payload: str = "payload") -> DataFrame:
    """The hits of search answers as items; groups without hits give none, missing fields are empty."""
    h = search_groups(pages, payload).select("category_name", F.explode("hits").alias("h"))
    c = lambda n: F.coalesce(F.col(f"h.{n}"), F.lit(""))
    date = from_parts(c("stored_field_year"), c("stored_field_month"), c("stored_field_day"), F.col("h.keyword_field_regdate"))
    return h.select(
        T.first_filled(c("stored_toc_seq"), c("keyword_toc_seq")).alias("id"), c("stored_field_subject").alias("title"), date.alias("date"), c("stored_ebook_no").alias("book_name"), T.first_filled(c("stored_category_name"), F.col("category_name")).alias("category"), c("stored_organ_nm").alias("agency"),
        c("stored_laword_nm").alias("law"), F.replace(c("stored_field_url"), F.lit("&amp;"), F.lit("&")).alias("viewer_path"), c("stored_pdf_file_path").alias("stored_pdf_file_path"), F.lit("search").alias("source_detail"),
    )


def first_hit(payload: Column) -> Column:
    """The first hit of an answer that has a URL."""
    a = F.from_json(payload, HITS)["data"]
    hits = F.flatten(F.transform(a, lambda g: F.coalesce(g["list"], F.slice(g["list"], 1, 0))))
    all_ = F.flatten(F.filter(F.transform(a, lambda g: g["list"]), lambda x: x.isNotNull()))
    return F.get(F.filter(F.coalesce(hits, all_), lambda h: T.nz(h["stored_field_url"]).isNotNull()), F.lit(0))


class _Rows(HTMLParser):
    """Cells and handlers of the rows of the result table."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[dict] = []
        self.table = self.depth = 0
        self.cell: list[str] | None = None
        self.link: list[str] | None = None
        self.count: list[str] | None = None
        self.total = ""

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        a = dict(attrs)
        if a.get("id") == "countArea":
            self.count = []
        if a.get("id") == "tableArea":
            self.table = 1
        if not self.table:
            return
        if tag == "tr":
            self.rows.append({"cells": [], "onclick": None, "link": ""})
        elif tag == "td" and self.rows:
            self.cell = []
        elif tag == "a" and self.rows and "fnDetail(" in (a.get("onclick") or "") and not self.rows[-1]["onclick"]:
            self.rows[-1]["onclick"], self.link = a["onclick"], []

    def handle_endtag(self, tag: str) -> None:
        if tag == "td" and self.cell is not None:
            self.rows[-1]["cells"].append(" ".join("".join(self.cell).split()))
            self.cell = None
        elif tag == "a" and self.link is not None:
            self.rows[-1]["link"], self.link = " ".join("".join(self.link).split()), None
        if self.count is not None and tag in ("div", "span", "p", "em", "strong"):
            self.total, self.count = "".join(self.count), None

    def handle_data(self, data: str) -> None:
        for held in (self.cell, self.link, self.count):
            if held is not None:
                held.append(data)


#: Tags of pages that need no parser: text between them and attributes in double quotes, nothing else.
_PLAIN_TAGS = "a b body br div em html i li p span strong table tbody td tfoot th thead tr ul".split()
_TOKEN = re.compile(rf"""<(/?)({"|".join(_PLAIN_TAGS)})((?:\s+[a-z]+="[^"<>&]*(?:&(?:amp|quot|lt|gt|\#39);[^"<>&]*)*")*)>|([^<&]+|[^<]+(?=<))""")
_ATTRIBUTE = re.compile(r'''([a-z]+)="([^"]*)"''')


def _fed(html: str) -> _Rows:
    """The rows of a page: of a plain one from its tokens, of any other from the parser, alike."""
    p, at = _Rows(), 0
    for m in _TOKEN.finditer(html):
        if m.start() != at:
            break
        at = m.end()
        end, tag, attributes, data = m.groups()
        if data is not None:
            if p.cell is not None or p.link is not None or p.count is not None:
                p.handle_data(entities.unescape(data))
        elif end:
            if attributes:
                at = -1
                break
            p.handle_endtag(tag)
        else:
            p.handle_starttag(tag, [(k, entities.unescape(v) if "&" in v else v) for k, v in _ATTRIBUTE.findall(attributes)] if attributes else [])
    if at != len(html):
        p = _Rows()
        p.feed(html)
    return p


def list_rows(html: str | None) -> tuple[int, int, list[dict]]:
    """(total, pages, rows with ROW_FIELDS) of a list page."""
    p = _fed(html or "")
    number = re.search(r"([\d,]+)\s*건", p.total)
    total = int(number[1].replace(",", "")) if number else 0
    numbers = [int(x) for x in re.findall(r"fnGoPage\('(\d+)'\)", html or "")]
    out = []
    for r in p.rows:
        args = arguments(r["onclick"], "fnDetail") if r["onclick"] else []
        if len(r["cells"]) < 5 or len(args) < 10:
            continue
        cells, args = r["cells"], [x.strip() for x in args]
        path = args[7]
        found = {k: (re.search(rf"[?&]{k}=([^&#]+)", path) or ["", ""])[1] for k in ("contentId", "tocId")}
        toc = found["tocId"] or args[0]
        if not (toc or found["contentId"]):
            continue
        values = [toc or found["contentId"], args[1] or r["link"], args[2] or cells[4], args[3], args[4] or cells[0], args[5] or cells[2], args[6] or cells[3], args[8], args[9], found["contentId"], toc, path]
        out.append(dict(zip(ROW_FIELDS, values)))
    return total, max(numbers, default=1 if total else 0), out


def list_items(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """The rows of list pages as items."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [r | {"source_url": u} for h, u in zip(b["html"], b["url"]) for r in list_rows(h)[2]]
            yield pd.DataFrame(rows, columns=[*ROW_FIELDS, "source_url"])

    schema = ", ".join(f"{f} string" for f in [*ROW_FIELDS, "source_url"])
    found = pages.select(F.col(html).alias("html"), F.col(url).alias("url")).mapInPandas(run, schema)
    return found.withColumns({"date": normalize(F.col("date")), "status": F.lit("discovered"), "source_detail": F.lit("list")})


def page_parts(pages: DataFrame) -> DataFrame:
    """Title, links and text lengths of raw pages, by regular expressions inside the JVM."""
    h = F.coalesce(F.col("html"), F.lit(""))
    body = F.regexp_replace(F.regexp_replace(h, r"(?is)<(script|style)\b.*?</\1>", " "), r"(?s)<[^>]*>", " ")
    return pages.select("page_id", T.squash(F.regexp_extract(h, r"(?is)<title>(.*?)</title>", 1)).alias("title"), F.regexp_extract_all(h, F.lit(r'<a href="([^"]*)"'), 1).alias("links"), F.length(T.squash(body)).alias("text_chars"))


Fetch = Callable[[dict, int], list[dict]]
FETCHERS: dict[str, Fetch] = {}


class Part(InputPartition):
    def __init__(self, values: dict) -> None:
        self.values = values


class Paged(DataSource):
    """A paged feed: a partition for each combination of year and institution, pages read until one is empty.

    Options: feed (module:function of (combination, page) -> rows), combinations (JSON list), fields (comma-separated), limit (rows of a
    combination), fallback (a feed that answers where the first raises a ValueError)."""

    @classmethod
    def name(cls) -> str:
        return "paged_feed"

    def schema(self) -> str:
        return ", ".join(f"{f.strip()} string" for f in self.options["fields"].split(","))

    def reader(self, schema) -> "PagedReader":
        return PagedReader(dict(self.options))

    def simpleStreamReader(self, schema) -> "PagedStream":
        return PagedStream(dict(self.options))


def _fetcher(name: str) -> Fetch:
    import importlib

    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def _all_pages(options: dict, combination: dict) -> Iterator[tuple]:
    fields, limit = [f.strip() for f in options["fields"].split(",")], int(options.get("limit", 0))
    fetch, n = _fetcher(options["feed"]), 0
    other = _fetcher(options["fallback"]) if options.get("fallback") else None
    page = 1
    while True:
        try:
            rows = fetch(combination, page)
        except ValueError:
            if other is None:
                raise
            fetch, other = other, None
            rows = fetch(combination, page)
        if not rows:
            return
        for r in rows:
            yield tuple(None if r.get(f) is None else str(r[f]) for f in fields)
            n += 1
            if limit and n >= limit:
                return
        page += 1


class PagedReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.options = options

    def partitions(self) -> list[Part]:
        return [Part(c) for c in json.loads(self.options["combinations"])]

    def read(self, partition: Part) -> Iterator[tuple]:
        return _all_pages(self.options, partition.values)


class PagedStream(SimpleDataSourceStreamReader):
    """One combination a batch, in order; the offset is how many are done."""

    def __init__(self, options: dict) -> None:
        self.options = options
        self.combinations = json.loads(options["combinations"])

    def initialOffset(self) -> dict:
        return {"done": 0}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        done = start["done"]
        if done >= len(self.combinations):
            return iter(()), start
        return iter(list(_all_pages(self.options, self.combinations[done]))), {"done": done + 1}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return (r for k in range(start["done"], end["done"]) for r in _all_pages(self.options, self.combinations[k]))

    def commit(self, end: dict) -> None:
        pass
