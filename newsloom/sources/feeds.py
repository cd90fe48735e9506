"""Parsing of collected payloads into items.

Fetching is not part of the engine: payloads arrive as a text column.  Each parser turns a payload into rows of
one item contract (``ITEM``) with column expressions; only an HTML list needs a document parser, in an Arrow
function.  A payload that cannot be read gives no item and is named by ``feed_errors``.

JSON feeds differ in where the records are and how fields are called; ``JsonFeed`` states that as data.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions import text as X
from newsloom.operators.timestamps import iso_utc, put_together, take_apart

ITEM = ["title", "summary", "url", "canonical_url", "published_at", "timestamp_quality"]


@dataclass(frozen=True)
class JsonFeed:
    """Where the records of a JSON payload are and which keys may hold a field (the first non-blank one counts)."""

    path: str
    title: tuple[str, ...]
    url: tuple[str, ...]
    summary: tuple[str, ...] = ()
    published: tuple[str, ...] = ()
    url_prefix: str = ""
    title_prefix: tuple[str, ...] = ()
    publisher: tuple[str, ...] = ()
    tz: str = "UTC"
    #: Keys whose truth drops a record, and (key, least) pairs of which one must hold.
    drop_if: tuple[str, ...] = ()
    any_least: tuple[tuple[str, int], ...] = field(default=())
    #: Where the records are if the first place has none.
    also: tuple[str, ...] = ()


# Layouts of the JSON feeds that are read.
FEEDS = {
    "govcn": JsonFeed("$", ("TITLE",), ("URL",), ("SUB_TITLE",), ("DOCRELPUBTIME",), tz="Asia/Shanghai"),
    "cninfo": JsonFeed("$.announcements", ("shortTitle", "announcementTitle"), ("adjunctUrl",), (), ("announcementTime",), "https://static.cninfo.com.cn/", ("secName",)),
    "marketaux": JsonFeed("$.data", ("title",), ("url", "article_url"), ("description", "snippet", "summary"), ("published_at", "published", "updated_at"), publisher=("source.name", "source.title", "source")),
    "mediastack": JsonFeed("$.data", ("title",), ("url",), ("description",), ("published_at", "published", "date"), publisher=("source",)),
    "serpstack": JsonFeed("$.news_results", ("title",), ("url", "link"), ("snippet", "description"), ("date", "published_at"), also=("$.organic_results",)),
    "reddit": JsonFeed("$.data.children", ("data.title",), ("data.permalink",), ("data.selftext",), ("data.created_utc",), "https://www.reddit.com", drop_if=("data.stickied",), any_least=(("data.ups", 5), ("data.num_comments", 3))),
    "hkex": JsonFeed("$.result", ("TITLE",), ("FILE_LINK",), ("SHORT_TEXT", "LONG_TEXT"), ("DATE_TIME",), "https://www1.hkexnews.hk", ("STOCK_NAME",), tz="Asia/Hong_Kong"),
}


def _first(v: Column, keys: tuple[str, ...]) -> Column:
    got = [F.nullif(X.squeeze(F.try_variant_get(v, f"$.{k}", "string")), F.lit("")) for k in keys]
    return F.coalesce(*got) if got else F.lit(None).cast("string")


def unwrap_jsonp(payload: Column) -> Column:
    """The JSON inside ``callback(...);``, or the payload as it is."""
    inner = F.regexp_extract(payload, r"(?s)^\s*[A-Za-z_$][\w$.]*\((.*)\)\s*;?\s*$", 1)
    return F.when(inner != "", inner).otherwise(payload)


def _finish(rows: DataFrame, keep: list[str], title: Column, summary: Column, url: Column, raw: Column, collected_at: str, tz: str) -> DataFrame:
    """The item contract; the steps are columns of their own, so that no long expression is repeated in another."""
    rows = rows.select(*keep, F.col("pos"), title.alias("title"), summary.alias("summary"), url.alias("url"), raw.alias("_raw"), F.col(collected_at).alias("_at"))
    out = rows.withColumn("canonical_url", X.canonical_url(F.col("url"))).withColumn("_parts", take_apart(F.col("_raw")))
    out = out.withColumn("_sec", put_together(F.col("_parts"), F.col("_at"), F.lit(tz), F.lit(True)))
    out = out.withColumn("published_at", F.when(F.col("_sec").isNotNull(), iso_utc(F.col("_sec")))).withColumn("timestamp_quality", F.when(F.col("_sec").isNotNull(), "exact").otherwise("unknown"))
    return out.filter((F.coalesce("title", F.lit("")) != "") & (F.coalesce("canonical_url", F.lit("")) != "")).select(*keep, "pos", *ITEM)


def json_items(df: DataFrame, payload: str, feed: JsonFeed, keep: list[str], collected_at: str) -> DataFrame:
    """Items of JSON (or JSONP) payloads; a record list given as JSON text inside the JSON is read too."""
    v = F.try_parse_json(unwrap_jsonp(F.col(payload)))
    listed = F.coalesce(F.try_variant_get(v, feed.path, "array<variant>"), F.try_variant_get(F.try_parse_json(F.try_variant_get(v, feed.path, "string")), "$", "array<variant>"))
    for path in feed.also:
        listed = F.when(F.coalesce(F.size(listed), F.lit(0)) > 0, listed).otherwise(F.try_variant_get(v, path, "array<variant>"))
    rows = df.select(*keep, F.col(collected_at).alias("_c"), F.posexplode(listed).alias("pos", "r"))
    r = F.col("r")
    for k in feed.drop_if:
        rows = rows.filter(~F.coalesce(F.try_variant_get(r, f"$.{k}", "boolean"), F.lit(False)))
    if feed.any_least:
        ok = F.lit(False)
        for k, least in feed.any_least:
            ok = ok | (F.coalesce(F.try_variant_get(r, f"$.{k}", "bigint"), F.lit(0)) >= least)
        rows = rows.filter(ok)
    title, lead = X.strip_html(_first(r, feed.title)), _first(r, feed.title_prefix)
    if feed.title_prefix:
        title = F.when(lead.isNotNull(), F.concat(lead, F.lit("："), title)).otherwise(title)
    summary = F.coalesce(F.nullif(X.strip_html(_first(r, feed.summary)), F.lit("")), title)
    who = _first(r, feed.publisher)
    summary = F.when(who.isNotNull() & ~F.contains(F.lower(summary), F.lower(who)), F.concat(who, F.lit("："), summary)).otherwise(summary)
    url = _first(r, feed.url)
    if feed.url_prefix:
        url = F.when(url.startswith("http"), url).otherwise(F.concat(F.lit(feed.url_prefix), F.regexp_replace(url, "^/+", "" if feed.url_prefix.endswith("/") else "/")))
    return _finish(rows, keep, title, summary, url, _first(r, feed.published), "_c", feed.tz)


def xml_items(df: DataFrame, payload: str, kind: str, keep: list[str], collected_at: str) -> DataFrame:
    """Items of RSS (``channel/item``) or Atom (``entry``, alternate link preferred) feeds."""
    p = F.regexp_replace(payload, r"\sxmlns(:\w+)?=\"[^\"]*\"", "")
    p = F.when(feed_errors(F.col(payload)).isNull(), p)
    tag, at = ("item", "/rss/channel/item") if kind == "rss" else ("entry", "/feed/entry")
    parts = F.regexp_extract_all(p, F.lit(f"(?s)<{tag}[ >].*?</{tag}>"), F.lit(0))
    rows = df.select(*keep, F.col(collected_at).alias("_c"), F.posexplode(parts).alias("pos", "x"))
    one = lambda path: F.nullif(X.squeeze(F.xpath_string("x", F.lit(f"/{tag}/{path}"))), F.lit(""))
    if kind == "rss":
        link, text, when = F.coalesce(one("link"), one("guid")), one("description"), one("pubDate")
    else:
        link, text, when = F.coalesce(one("link[@rel='alternate']/@href"), one("link/@href")), one("summary"), one("updated")
    title = X.strip_html(one("title"))
    return _finish(rows, keep, title, F.coalesce(X.strip_html(text), F.lit("")), link, when, "_c", "UTC")


def feed_errors(payload: Column) -> Column:
    """Why an XML payload cannot be a feed, or null: empty, html_page, not_xml or malformed (the XML parser's own verdict)."""
    t = F.lower(F.substring(F.ltrim(payload), 1, 20))
    bad = F.from_xml(payload, "_bad string", {"columnNameOfCorruptRecord": "_bad", "mode": "PERMISSIVE"})["_bad"]
    return (
        F.when(payload.isNull() | (F.trim(payload) == ""), "empty")
        .when(t.startswith("<!doctype html") | t.startswith("<html"), "html_page")
        .when(~t.startswith("<"), "not_xml")
        .when(bad.isNotNull(), "malformed")
    )


def term_filter(text: Column, allow: list[str] | None = None, block: list[str] | None = None) -> Column:
    """Case-blind substring allow and block lists; an empty list is no constraint."""
    low = F.lower(F.coalesce(text, F.lit("")))
    has = lambda terms: F.exists(F.array(*[F.lit(t.lower()) for t in terms]), lambda t: F.contains(low, t))
    out = F.lit(True)
    if allow:
        out = out & has(allow)
    if block:
        out = out & ~has(block)
    return out


def pattern_items(df: DataFrame, payload: str, pattern: str, names: list[str], keep: list[str]) -> DataFrame:
    """One row per match of a pattern in a page, its groups by name; the first of an equal first group counts."""
    groups = [F.regexp_extract_all(payload, F.lit(pattern), F.lit(i + 1)).alias(n) for i, n in enumerate(names)]
    rows = df.select(*keep, F.posexplode(F.arrays_zip(*groups)).alias("pos", "m")).select(*keep, "pos", *[F.col(f"m.{n}").alias(n) for n in names])
    return rows.groupBy(*keep, names[0]).agg(F.min(F.struct("pos", *names[1:])).alias("m")).select(*keep, names[0], *[F.col(f"m.{n}").alias(n) for n in names[1:]])


class _Links(HTMLParser):
    def __init__(self, cls: str):
        super().__init__()
        self.cls, self.depth, self.href, self.words, self.out = cls, 0, None, [], []

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if self.cls in (a.get("class") or "").split():
            self.depth += 1
        if tag == "a" and self.depth and a.get("href"):
            self.href, self.words = a["href"], []

    def handle_data(self, data):
        if self.href is not None:
            self.words.append(data)

    def handle_endtag(self, tag):
        if tag == "a" and self.href is not None:
            self.out.append((self.href, " ".join(" ".join(self.words).split())))
            self.href = None
        elif tag == "li" and self.depth:
            self.depth -= 1


def html_list_items(df: DataFrame, payload: str, key: str, item_class: str, base_url: str) -> DataFrame:
    """key, pos, title, url of the links inside the ``li`` elements of a class."""
    rows = df.select(key, payload)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, pos, titles, urls = [], [], [], []
            for k, html in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                parser = _Links(item_class)
                parser.feed(html or "")
                for i, (href, title) in enumerate(parser.out):
                    if title:
                        keys.append(k), pos.append(i), titles.append(title), urls.append(urljoin(base_url, href))
            yield pa.RecordBatch.from_arrays([pa.array(keys, b.schema.field(0).type), pa.array(pos, pa.int32()), pa.array(titles, pa.string()), pa.array(urls, pa.string())], names=[key, "pos", "title", "url"])

    return rows.mapInArrow(run, f"`{key}` {rows.schema[key].dataType.simpleString()}, pos int, title string, url string")
