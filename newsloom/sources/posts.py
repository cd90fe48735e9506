"""Parsers of posts, boards, tables and rendered pages, and the dispatcher over all kinds of payloads.

What counts as noise, rumour or wanted in a post is the caller's (``PostRules``); the defaults suit market talk.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions import text as X
from newsloom.sources import feeds as P


@dataclass(frozen=True)
class PostRules:
    noise: str = "giveaway|lottery|follow me|抽奖|转发有礼"
    rumour: str = "rumou?r|hearsay|hear that|传闻|听说|据说"
    wanted: str = "factory|plant|order|contract|deal|recall|strike|订单|停工|召回|合作"
    keywords: tuple[str, ...] = ("profit", "利润", "expand", "扩建", "delays", "推迟")
    #: Price moves in one post from which on it is a list of quotes.
    most_moves: int = 3
    #: Characters around the target that are looked at, and the length from which a post must be a rumour.
    around: int = 80
    long: int = 180


def around(text: Column, target: Column, n: int) -> Column:
    """The text from n characters before the first mention of the target to n after it; '' without one."""
    at = F.instr(text, target)
    begin = F.greatest(at - n, F.lit(1))
    return F.when(at > 0, F.substr(text, begin, at + F.length(target) + n - begin)).otherwise("")


def keep_post(text: Column, target: Column, author: Column, rules: PostRules = PostRules()) -> Column:
    """Whether a post says something about its target; null or empty texts and targets never do.  Rules in order: it names the target;
    no noise; no list of quotes; the target's own account counts only with rumours; what stands around the mention is wanted, or, in a text that is
    not long or is a rumour, has one of the keywords."""
    t, low = X.squeeze(text), F.lower(X.squeeze(text))
    near = F.lower(around(X.squeeze(text), target, rules.around))
    rumour = low.rlike(rules.rumour)
    keyword = F.exists(F.array(*[F.lit(k) for k in rules.keywords]), lambda k: F.contains(near, k))
    kept = (
        F.when((t == "") | (target == "") | ~F.contains(t, target), False)
        .when(low.rlike(rules.noise), False)
        .when(F.size(F.regexp_extract_all(low, F.lit(r"[0-9](?:\.[0-9]+)?%"), F.lit(0))) >= rules.most_moves, False)
        .when(F.contains(F.coalesce(author, F.lit("")), target) & ~rumour, False)
        .when(near.rlike(rules.wanted), True)
        .when((F.length(t) >= rules.long) & ~near.rlike(rules.rumour), False)
        .otherwise(keyword)
    )
    return F.coalesce(kept, F.lit(False))


def _text(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "string")


def card_posts(df: DataFrame, payload: str, keep: list[str], depth: int = 3) -> DataFrame:
    """Kept columns, text, author, post_id of the posts (``mblog``) in cards and in groups of cards up to ``depth`` levels down."""
    v = F.try_parse_json(F.col(payload))
    level = df.select(*keep, F.explode(F.try_variant_get(v, "$.data.cards", "array<variant>")).alias("card"))
    out = None
    for _ in range(depth):
        card = F.col("card")
        got = level.filter(F.try_variant_get(card, "$.mblog", "variant").isNotNull())
        got = got.select(*keep, X.strip_html(_text(card, "$.mblog.text")).alias("text"), F.coalesce(_text(card, "$.mblog.user.screen_name"), F.lit("")).alias("author"), F.coalesce(_text(card, "$.mblog.bid"), _text(card, "$.mblog.id")).alias("post_id"))
        out = got if out is None else out.unionByName(got)
        level = level.select(*keep, F.explode(F.try_variant_get(card, "$.card_group", "array<variant>")).alias("card"))
    return out


def listed_posts(df: DataFrame, payload: str, keep: list[str], list_keys: tuple[str, ...] = ("list", "items", "statuses")) -> DataFrame:
    """Kept columns, rank (position from 1), title, text, author, post_id of a list that may stand under several keys and whose
    records may be JSON written as text under ``data``."""
    v = F.try_parse_json(F.col(payload))
    listed = F.coalesce(*[F.try_variant_get(v, f"$.{k}", "array<variant>") for k in list_keys], *[F.try_variant_get(v, f"$.data.{k}", "array<variant>") for k in list_keys])
    rows = df.select(*keep, F.posexplode(listed).alias("pos", "r"))
    r = F.coalesce(F.try_parse_json(_text(F.col("r"), "$.data")), F.col("r"))
    rows = rows.withColumn("r", r)
    one = lambda k: _text(F.col("r"), f"$.{k}")
    return rows.select(*keep, (F.col("pos") + 1).alias("rank"), X.strip_html(F.coalesce(one("title"), F.lit(""))).alias("title"), X.strip_html(F.coalesce(one("text"), one("description"))).alias("text"), F.coalesce(one("user.screen_name"), F.lit("")).alias("author"), one("id").alias("post_id"))


def symbol_of(ticker: Column, region: Column) -> Column:
    """Ticker as exchange and padded code (SH600000, HK00700); what fits nothing stays as it is, in capitals."""
    t = F.upper(F.trim(F.coalesce(ticker, F.lit(""))))
    code, ending = F.substring_index(t, ".", 1), F.when(F.contains(t, F.lit(".")), F.regexp_extract(t, r"\.(.*)$", 1)).otherwise("")
    wide = lambda c, n: F.when(F.length(c) < n, F.lpad(c, n, "0")).otherwise(c)
    figures = t.rlike("^[0-9]+$")
    return (
        F.when(t.rlike("^(SH|SZ|HK)[0-9]{5,6}$"), t)
        .when(ending.isin("SZ", "SH"), F.concat(ending, wide(code, 6)))
        .when(ending == "HK", F.concat(ending, wide(code, 5)))
        .when((region == "HK") & figures, F.concat(F.lit("HK"), wide(t, 5)))
        .when((region == "CN") & figures, F.concat(F.when(t.rlike("^[69]"), "SH").otherwise("SZ"), wide(t, 6)))
        .otherwise(t)
    )


def count_of(text: Column) -> Column:
    """A count as written on pages: 12, 1,234, 1.2万, 3k; 0 where there is none."""
    t = F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), "[,+\\s]", ""))
    n = F.regexp_extract(t, r"^([0-9]+(?:\.[0-9]+)?)", 1).try_cast("decimal(18,4)")
    unit = F.when(t.rlike("(万|w)$"), 10_000).when(t.rlike("千|k$"), 1_000).when(t.rlike("亿$"), 100_000_000).otherwise(1)
    return F.coalesce(F.round(n * unit).cast("bigint"), F.lit(0).cast("bigint"))


class _Rows(HTMLParser):
    """Rows of a class, with the text of each cell by the class of the innermost element that has a wanted one."""

    def __init__(self, row: str, fields: tuple[str, ...]):
        super().__init__()
        self.row, self.fields, self.stack, self.now, self.out = row, fields, [], None, []

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        classes = (a.get("class") or "").split()
        if tag == "tr":
            self.now = {} if self.row in classes else None
        self.stack.append((tag, next((c for c in classes if c in self.fields), None)))
        field = next((f for _, f in reversed(self.stack) if f), None)
        if self.now is not None and tag == "a" and field == self.fields[0] and a.get("href"):
            self.now.setdefault("href", a["href"])

    def handle_data(self, data):
        field = next((f for _, f in reversed(self.stack) if f), None)
        if self.now is not None and field:
            self.now[field] = f"{self.now.get(field, '')} {data}"

    def handle_endtag(self, tag):
        while self.stack and self.stack.pop()[0] != tag:
            pass
        if tag == "tr" and self.now is not None:
            self.out.append(self.now)
            self.now = None


def board_rows(df: DataFrame, payload: str, key: str, base_url: str, row: str = "listitem", fields: tuple[str, ...] = ("title", "author", "read", "reply")) -> DataFrame:
    """key, pos, url and the texts of the fields of an HTML table board; of rows with one URL the last counts."""
    rows = df.select(key, payload)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for k, html in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                parser = _Rows(row, fields)
                parser.feed(html or "")
                last = {urljoin(base_url, r["href"]): (i, r) for i, r in enumerate(parser.out) if "href" in r}
                out += [(k, i, url, *[" ".join(r.get(f, "").split()) for f in fields]) for url, (i, r) in last.items()]
            cols = list(zip(*out)) if out else [()] * (3 + len(fields))
            types = [b.schema.field(0).type, pa.int32(), *[pa.string()] * (1 + len(fields))]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)], names=[key, "pos", "url", *fields])

    return rows.mapInArrow(run, f"`{key}` {rows.schema[key].dataType.simpleString()}, pos int, url string, " + ", ".join(f"`{f}` string" for f in fields))


@dataclass(frozen=True)
class Layout:
    """Which columns of a table hold the fields of an item; a date without a time of day is an estimate."""

    title: str
    body: str
    date: str
    time: str | None = None
    url: str | None = None


#: Column names of the tabular sources that are read.
LAYOUTS = {"cctv": Layout("title", "content", "date"), "global_cls": Layout("标题", "内容", "发布日期", "发布时间"), "global_em": Layout("标题", "摘要", "发布时间", url="链接"), "notices": Layout("公告标题", "公告类型", "公告日期", url="网址")}


def table_items(df: DataFrame, layout: Layout, keep: list[str], tz: str = "Asia/Shanghai") -> DataFrame:
    """Items of a table: title (else the beginning of the body), summary, url, published_at, timestamp_quality."""
    from newsloom.operators.timestamps import field_times, iso_utc

    body = X.squeeze(F.coalesce(F.col(layout.body), F.lit("")))
    title = F.coalesce(F.nullif(X.squeeze(F.col(layout.title)), F.lit("")), F.substring(body, 1, 80))
    rows = df.select(*keep, title.alias("title"), body.alias("summary"), (F.col(layout.url) if layout.url else F.lit("")).alias("url"), F.col(layout.date).cast("string").alias("_d"), (F.col(layout.time).cast("string") if layout.time else F.lit(None).cast("string")).alias("_h"))
    rows = field_times(rows.filter("title <> ''"), F.col("_d"), F.col("_h"), tz)
    quality = F.when(F.col("sec").isNull(), "unknown").when(F.col("dated"), "estimated").otherwise("exact")
    return rows.select(*keep, "title", "summary", F.coalesce("url", F.lit("")).alias("url"), F.when(F.col("sec").isNotNull(), iso_utc(F.col("sec"))).alias("published_at"), quality.alias("timestamp_quality"))


def first_items(df: DataFrame, keys: list[str], position: str, n: int) -> DataFrame:
    """The first n items of each payload by position; 0 is no limit."""
    from newsloom.plans.relational import first_of

    return df if n == 0 else first_of(df, keys, [F.col(position)], n).drop("_rn")


#: kind of source: parser of (df, payload column, kept columns, collected_at column) to the item contract.
PARSERS: dict[str, Callable[[DataFrame, str, list[str], str], DataFrame]] = {
    "rss": lambda df, p, keep, at: P.xml_items(df, p, "rss", keep, at),
    "atom": lambda df, p, keep, at: P.xml_items(df, p, "atom", keep, at),
    **{name: (lambda feed: lambda df, p, keep, at: P.json_items(df, p, feed, keep, at))(feed) for name, feed in P.FEEDS.items()},
}


def dispatch(df: DataFrame, kind: str, payload: str, keep: list[str], collected_at: str, kinds: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(items, errors): every payload read by the parser of its kind; errors (kept columns, kind, error) has payloads of unknown kind and feeds
    that cannot be read.  One branch a kind over the same scan, without a shuffle; a bad payload never touches others."""
    kinds = kinds or list(PARSERS)
    items = None
    for k in kinds:
        got = PARSERS[k](df.filter(F.col(kind) == k), payload, keep, collected_at)
        items = got if items is None else items.unionByName(got)
    xml = F.when(F.col(kind).isin("rss", "atom"), P.feed_errors(F.col(payload)))
    js = F.when(~F.col(kind).isin("rss", "atom") & F.try_parse_json(P.unwrap_jsonp(F.col(payload))).isNull(), "not_json")
    why = F.when(F.col(kind).isNull() | ~F.col(kind).isin(*kinds), "unknown_kind").otherwise(F.coalesce(xml, js))
    return items, df.select(*keep, F.col(kind).alias("kind"), why.alias("error")).filter("error is not null")
