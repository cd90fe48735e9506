"""Queries of the post, board, table and page parsers, the dispatcher, registry files, ingest and resumable replay.

Payloads are made of all articles; each holds several records, among them ones that must not come out.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions import text as X
from newsloom.operators import ingest, timestamps
from newsloom.operators.extract import headline_entity
from newsloom.operators.state import VersionedTable
from newsloom.operators.windows import windowed
from newsloom.plans.feeds import _ISO, _R, _U, _esc, _items, _rows
from newsloom.session import stash, stash_path, table
from newsloom.sources import feeds as P
from newsloom.sources import posts, registry_files


def _lit(**fields):
    return F.struct(*[(v if not isinstance(v, str) else F.lit(v)).alias(k) for k, v in fields.items()])


def a3_feed_errors(spark: SparkSession, d: str) -> DataFrame:
    """What is wrong with payloads, of which four in five are broken in one way each."""
    k = F.length("title") % 5
    x = F.when(k == 0, "  ").when(k == 1, F.concat(F.lit("<!DOCTYPE html><html>"), _esc("title"))).when(k == 2, F.col("title")).when(k == 3, F.concat(F.lit("<rss><channel><item>"), _esc("title"))).otherwise(F.concat(F.lit("<rss><channel><title>"), _esc("title"), F.lit("</title></channel></rss>")))
    return _rows(spark, d).select("article_id", P.feed_errors(x).alias("error"))


def a6_six_lists(spark: SparkSession, d: str) -> DataFrame:
    """Allow and block lists over three fields: publisher, title and summary."""
    a = table(spark, d, "news_articles").select("article_id", "source_id", "title", "summary").distinct()
    ok = P.term_filter(F.col("source_id"), ["wire", "markets"], ["tidegate_wire_live"]) & P.term_filter(F.col("title"), ["profit", "利润", "plan"], ["Exclusive"]) & P.term_filter(F.col("summary"), None, ["million crowns"])
    return a.filter(ok).select("article_id")


def a7_dispatch(spark: SparkSession, d: str) -> DataFrame:
    """Payloads of three kinds, and of an unknown one, each read by its parser."""
    return _items(_dispatched(spark, d)[0])


def a7_dispatch_errors(spark: SparkSession, d: str) -> DataFrame:
    return _dispatched(spark, d)[1].select("article_id", "kind", "error")


def _dispatched(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    k = F.length("title") % 5
    rss = F.concat(F.lit("<rss><channel><item><title/></item><item><title>"), _esc("title"), F.lit("</title><guid>"), _esc("url"), F.lit("</guid><pubDate>"), F.col("at"), F.lit("</pubDate></item></channel></rss>"))
    atom = F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>'), _esc("title"), F.lit('</title><link rel="alternate" href="'), _esc("url"), F.lit('"/><updated>'), F.col("at"), F.lit("</updated></entry><entry><title>no link</title></entry></feed>"))
    js = F.to_json(F.array(_lit(TITLE="", URL=F.col("url"), DOCRELPUBTIME=""), F.struct(F.col("title").alias("TITLE"), F.col("url").alias("URL"), F.col("at").alias("DOCRELPUBTIME"))))
    rows = _rows(spark, d).withColumn("kind", F.when(k == 0, "rss").when(k == 1, "atom").when(k == 2, "govcn").when(k == 3, "govcn").otherwise("telex"))
    rows = rows.withColumn("payload", F.when(k == 0, rss).when(k == 1, atom).when(k == 2, js).otherwise(F.lit("{broken")))
    return posts.dispatch(rows.select("article_id", "collected_at", "kind", "payload"), "kind", "payload", ["article_id"], "collected_at", ["rss", "atom", "govcn"])


def a9_cninfo(spark: SparkSession, d: str) -> DataFrame:
    at = F.unix_seconds("collected_at") * 1000
    one = F.struct(F.lit("Firm").alias("secName"), F.col("title").alias("shortTitle"), F.lit(None).cast("string").alias("announcementTitle"), F.concat(F.lit("f/"), F.col("article_id"), F.lit(".PDF")).alias("adjunctUrl"), at.alias("announcementTime"))
    two = F.struct(F.lit("").alias("secName"), F.lit(" ").alias("shortTitle"), F.concat("title", F.lit(" 2")).alias("announcementTitle"), F.concat(F.lit("/g/"), F.col("article_id"), F.lit(".PDF")).alias("adjunctUrl"), at.alias("announcementTime"))
    none = F.struct(F.lit("Firm").alias("secName"), F.lit("").alias("shortTitle"), F.lit("").alias("announcementTitle"), F.lit("x").alias("adjunctUrl"), at.alias("announcementTime"))
    j = F.to_json(F.struct(F.array(one, none, two).alias("announcements")))
    out = P.json_items(_rows(spark, d).withColumn("payload", j), "payload", P.FEEDS["cninfo"], ["article_id"], "collected_at")
    return out.select("article_id", "title", "url", "published_at")


def a10_marketaux(spark: SparkSession, d: str) -> DataFrame:
    """Alternate keys and a publisher given as an object."""
    who = F.struct(F.lit("The Pub").alias("name"))
    one = F.struct("title", F.col("url").alias("article_url"), F.lit(None).cast("string").alias("url"), F.lit(" ").alias("description"), F.concat("title", F.lit(" in short")).alias("snippet"), F.col("at").alias("updated_at"), who.alias("source"))
    two = F.struct(F.concat("title", F.lit(" again")).alias("title"), F.lit(None).cast("string").alias("article_url"), "url", F.lit("by the pub: text").alias("description"), F.lit("").alias("snippet"), F.col("at").alias("updated_at"), who.alias("source"))
    j = F.to_json(F.struct(F.array(one, two).alias("data")))
    return P.json_items(_rows(spark, d).withColumn("payload", j), "payload", P.FEEDS["marketaux"], ["article_id"], "collected_at").select("article_id", "title", "summary", "canonical_url")


def a11_search_results(spark: SparkSession, d: str) -> DataFrame:
    """News results, else organic ones, at most two of each payload."""
    item = lambda n: F.struct(F.concat("title", F.lit(f" {n}")).alias("title"), F.concat("url", F.lit(f"?p={n}")).alias("link"), F.col("at").alias("date"))
    news = F.length("title") % 2 == 0
    j = F.when(news, F.to_json(F.struct(F.array(item(1), item(2), item(3)).alias("news_results"), F.array(item(9)).alias("organic_results")))).otherwise(F.to_json(F.struct(F.array(item(4)).alias("organic_results"))))
    rows = _rows(spark, d).filter("not url rlike '[?#]'").withColumn("payload", j)
    return posts.first_items(P.json_items(rows, "payload", P.FEEDS["serpstack"], ["article_id"], "collected_at"), ["article_id"], "pos", 2).select("article_id", "title", "canonical_url")


def a16_board_rows(spark: SparkSession, d: str) -> DataFrame:
    cell = lambda cls, x: F.concat(F.lit(f'<td><div class="{cls}">'), x, F.lit("</div></td>"))
    row = lambda cls, title, href, reads: F.concat(F.lit(f'<tr class="{cls}">'), cell("title", F.concat(F.lit('<a href="'), href, F.lit('">'), title, F.lit("</a>"))), cell("author", F.lit("<a>Ann &amp; Bo</a>")), cell("read", reads), cell("reply", F.lit("7")), F.lit("</tr>"))
    link = F.concat(F.lit("/b/"), F.col("article_id"))
    x = F.concat(F.lit('<table><tbody class="listbody">'), row("head", F.lit("no"), F.lit("/no"), F.lit("0")), row("listitem", F.lit("earlier"), link, F.lit("1")), row("listitem hot", _esc("title"), link, F.lit("1.2万")), F.lit("</tbody></table>"))
    out = posts.board_rows(_rows(spark, d).withColumn("payload", x).select("article_id", "payload"), "payload", "article_id", "https://board.example/list")
    return out.select("article_id", "title", "url", "author", posts.count_of(F.col("read")).alias("reads"), posts.count_of(F.col("reply")).alias("replies"))


def _talk(spark: SparkSession, d: str) -> DataFrame:
    """Posts made of titles and summaries, with the firm of the title as target."""
    a = table(spark, d, "news_articles").select("article_id", "title", "summary").distinct()
    return a.select("article_id", F.coalesce(headline_entity(F.col("title")), F.lit("")).alias("target"), F.concat_ws(" ", X.squeeze(F.col("title")), X.squeeze(F.col("summary"))).alias("said"))


def a17_card_posts(spark: SparkSession, d: str) -> DataFrame:
    """Posts in cards and in groups of cards two levels down; kept by the rules."""
    post = lambda text, who, i: F.struct(F.struct(text.alias("text"), F.struct(F.lit(who).alias("screen_name")).alias("user"), F.concat("article_id", F.lit(i)).alias("id")).alias("mblog"))
    deep = F.struct(F.array(F.struct(F.array(post(F.col("said"), "Ann", "-b"))  .alias("card_group"))).alias("card_group"))
    flat = post(F.concat(F.lit("<b>"), F.col("said"), F.lit("</b> giveaway")), "Bo", "-a")
    j = F.concat(F.lit('{"data":{"cards":['), F.to_json(flat), F.lit(","), F.to_json(deep), F.lit(',{"other":1}]}}'))
    got = posts.card_posts(_talk(spark, d).withColumn("payload", j), "payload", ["article_id", "target"])
    return got.filter(posts.keep_post(F.col("text"), F.col("target"), F.col("author"))).select("article_id", "post_id", "author", F.length("text").alias("n_chars"))


def a18_listed_posts(spark: SparkSession, d: str) -> DataFrame:
    """A list under one of several keys whose records are JSON text; the rank is the position."""
    rec = lambda title, i: F.struct(F.to_json(F.struct(title.alias("title"), F.col("said").alias("text"), F.concat("article_id", F.lit(i)).alias("id"), F.struct(F.lit("Ann").alias("screen_name")).alias("user"))).alias("data"))
    both = F.array(rec(F.lit("first"), "-1"), rec(F.lit(""), "-2"))
    j = F.when(F.length("said") % 2 == 0, F.to_json(F.struct(both.alias("items")))).otherwise(F.to_json(F.struct(F.struct(both.alias("statuses")).alias("data"))))
    got = posts.listed_posts(_talk(spark, d).withColumn("payload", j), "payload", ["article_id"])
    return got.select("article_id", "rank", "title", F.length("text").alias("n_chars"), "post_id")


def a18_symbols(spark: SparkSession, d: str) -> DataFrame:
    n = F.length("article_id") + F.length("title")
    t = F.when(n % 5 == 0, F.concat(n.cast("string"), F.lit(".sz"))).when(n % 5 == 1, F.concat(n.cast("string"), F.lit(".HK"))).when(n % 5 == 2, n.cast("string")).when(n % 5 == 3, F.concat(F.lit("6"), n.cast("string"))).otherwise(" abc ")
    return _rows(spark, d).select("article_id", posts.symbol_of(t, F.when(n % 2 == 0, "HK").otherwise("CN")).alias("symbol"))


def a19_tables(spark: SparkSession, d: str) -> DataFrame:
    """Tables with date and time in one field, in two fields, and with a bare date."""
    local = F.from_utc_timestamp("collected_at", "Asia/Shanghai")
    rows = _rows(spark, d)
    cls = rows.select("article_id", F.when(F.length("title") % 2 == 0, F.lit("")).otherwise(F.col("title")).alias("标题"), F.col("title").alias("内容"), F.date_format(local, "yyyy-MM-dd").alias("发布日期"), F.date_format(local, "HH:mm:ss").alias("发布时间"))
    cctv = rows.select("article_id", "title", F.col("title").alias("content"), F.date_format(local, "yyyyMMdd").alias("date"))
    out = posts.table_items(cls, posts.LAYOUTS["global_cls"], ["article_id"]).withColumn("table", F.lit("cls"))
    out = out.unionByName(posts.table_items(cctv, posts.LAYOUTS["cctv"], ["article_id"]).withColumn("table", F.lit("cctv")))
    return out.select("table", "article_id", "title", "published_at", "timestamp_quality")


def a20_counts(spark: SparkSession, d: str) -> DataFrame:
    """Counts as pages write them."""
    n = F.length("title")
    t = F.when(n % 4 == 0, F.concat((n / 10).cast("decimal(10,1)").cast("string"), F.lit("万"))).when(n % 4 == 1, F.format_number(n * 1000, 0)).when(n % 4 == 2, F.concat(n.cast("string"), F.lit("k"))).otherwise("赞")
    return _rows(spark, d).select("article_id", posts.count_of(t).alias("n"))


def _registry(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    cols = ["source_id", "name", "lane", "trust_tier", "phase1_disposition", "enabled"]
    # the registry is a fixed table of some dozen rows
    rows = [r.asDict() for r in table(spark, d, "source_registry").select(*cols).orderBy("source_id").collect()]
    rows += [{"id": "x-odd", "name": "Odd", "lane": "odd"}, {"name": "no id", "lane": "signal"}, {"id": "x-min", "name": "Min", "lane": "signal"}]
    path = stash_path(spark, "registry")
    spark.createDataFrame([(json.dumps({"sources": rows}),)], "t string").coalesce(1).write.text(path)
    return registry_files.read_registry(spark, path)


def a1_registry(spark: SparkSession, d: str) -> DataFrame:
    good, bad = _registry(spark, d)
    cols = ["source_id", "name", "lane", "trust_tier", "coverage_scope", "scheduler_class", "phase1_disposition", "enabled"]
    return good.select(*cols, F.lit(True).alias("accepted")).unionByName(bad.select(*cols, F.lit(False).alias("accepted")))


def a2_catalogue(spark: SparkSession, d: str) -> DataFrame:
    cat = table(spark, d, "source_clock").select("source_id", F.when(F.length("source_id") % 2 == 0, F.upper("source_id")).alias("name"), F.length("tz_name").alias("max_items"))
    return registry_files.merge_catalogue(_registry(spark, d)[0], cat, ["tidegate_filings"]).select("source_id", "name", "lane", "max_items")


def a22_release_items(spark: SparkSession, d: str) -> DataFrame:
    """Nested releases, two of each article, of which one is outside the span."""
    at = F.date_format("collected_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    cons = F.struct(F.length("title").cast("double").alias("actual"), F.lit(None).cast("double").alias("forecast"), F.lit(1.5).alias("previous"))
    one = F.struct(F.col("article_id").alias("id"), at.alias("createdAt"), F.lit("s").alias("sourceId"), F.lit("Label").alias("sourceLabel"), F.col("title").alias("textEn"), F.struct((F.length("title") % 2 == 0).alias("releaseDateApproximate"), cons.alias("consensus")).alias("metadata"))
    two = F.struct(F.col("article_id").alias("id"), F.lit("2030-01-01T00:00:00Z").alias("createdAt"), F.lit("s").alias("sourceId"), F.lit("Label").alias("sourceLabel"), F.lit("late").alias("textEn"), F.struct(F.lit(False).alias("releaseDateApproximate"), cons.alias("consensus")).alias("metadata"))
    rows = _rows(spark, d).select(F.to_json(F.struct(F.array(two, one).alias("events"))).alias("payload"))
    return registry_files.release_items(rows, "payload", "2026-01-01 00:00:00", "2026-01-31 23:59:59").select("article_id", "title", "summary", "timestamp_quality", F.unix_seconds("published_at").alias("published"))


def a30_json_view(spark: SparkSession, d: str) -> DataFrame:
    """A view written as JSON, latest and dated copy, and read back."""
    v = table(spark, d, "news_events").select("event_id", "event_type", "event_rank_score").distinct()
    paths = registry_files.write_view(v, stash_path(spark, "views"), "events", "2026-03-01T00:00:00")
    return spark.read.schema(v.schema).json(paths[1])


def x11_failed_write(spark: SparkSession, d: str) -> DataFrame:
    """A table after an upsert that fails half-way: as it was before."""
    kept = VersionedTable(spark, stash_path(spark, "x11"))
    rows = table(spark, d, "source_registry").select("source_id", "lane")
    kept.replace(rows)
    try:
        kept.upsert(rows.withColumn("lane", F.when(F.col("source_id") > "m", F.raise_error(F.lit("broken"))).otherwise("changed")), ["source_id"])
    except Exception as e:  # noqa: BLE001
        if "broken" not in str(e):
            raise
    return kept.read().select("source_id", "lane")


def x13_ingest_health(spark: SparkSession, d: str) -> DataFrame:
    """Articles of February on top of all earlier ones, source by source."""
    a = table(spark, d, "news_articles").select("article_id", "source_id", "title", "canonical_url", "published_at", "collected_at").distinct()
    month = F.lit("2026-02-01").cast("timestamp")
    cols = ["article_id", "source_id", "title", "canonical_url"]
    kept = a.filter(F.col("collected_at") < month).unionByName(a.filter((F.col("collected_at") >= month) & (F.length("title") % 3 == 0)).withColumn("title", F.when(F.length("title") % 2 == 0, F.lit("old")).otherwise(F.col("title"))))
    faults = {"no_url": F.col("canonical_url").isNull(), "no_time": F.col("published_at").isNull()}
    batch = a.filter(F.col("collected_at") >= month)
    _, _, health = ingest.persist(kept.select(*cols), batch.select(*cols, "published_at").withColumn("canonical_url", F.when(F.col("published_at").isNotNull(), F.col("canonical_url"))).drop("published_at"), "article_id", "source_id", {"no_url": faults["no_url"]})
    return health.select("source_id", "delivered", "inserted", "updated", "same", "rejected", "status")


def s7_resumable_replay(spark: SparkSession, d: str) -> DataFrame:
    """Weekly windows replayed in two goes: the first one stops at a window that fails, the second one goes on from there."""
    e = windowed(table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts")), "ts", "week", "2024-01-03", "2024-01-25")
    e = stash(e.select("event_id", "window_label"), "replay")
    # one label a week of the span
    weeks = sorted(r[0] for r in e.select("window_label").distinct().collect())
    progress = VersionedTable(spark, stash_path(spark, "progress"))

    def run(week: str, broken: bool):
        if broken:
            raise RuntimeError("stopped")
        return e.filter(F.col("window_label") == week).count()

    for go in (1, 2):
        out = ingest.resume(progress, {w: (lambda w=w, i=i: run(w, go == 1 and i == 2)) for i, w in enumerate(weeks)})
    return out.select("run_key", "status", "attempts", "n")


def t5_field_times(spark: SparkSession, d: str) -> DataFrame:
    """Date and time in two fields, in one, and a bare date (noon), in China's zone."""
    local, k = F.from_utc_timestamp("collected_at", "Asia/Shanghai"), F.length("title") % 4
    day = F.when(k == 0, F.date_format(local, "yyyy-MM-dd")).when(k == 1, F.date_format(local, "yyyy/MM/dd HH:mm:ss")).when(k == 2, F.date_format(local, "yyyyMMdd")).otherwise("soon")
    time = F.when(k == 0, F.date_format(local, "HH:mm:ss"))
    rows = timestamps.field_times(_rows(spark, d).select("article_id", day.alias("day"), time.alias("time")), F.col("day"), F.col("time"), "Asia/Shanghai")
    return rows.select("article_id", F.coalesce("sec", F.lit(-1)).cast("bigint").alias("sec"), "dated")


def t6_recent_month_day(spark: SparkSession, d: str) -> DataFrame:
    """Month and day without a year, as written up to 300 days ago, read at collection time."""
    now = F.col("collected_at")
    back = F.length("title") * 3 % 300
    then = F.from_utc_timestamp(F.timestamp_add("DAY", -back, now), "Asia/Shanghai")
    text = F.when(F.length("title") % 2 == 0, F.date_format(then, "MM-dd HH:mm")).otherwise(F.date_format(then, "M月d日"))
    rows = timestamps.recent_month_day(_rows(spark, d).select("article_id", "collected_at", text.alias("text")), F.col("text"), now, "Asia/Shanghai")
    return rows.select("article_id", "sec")


QUERIES = {k: f for k, f in globals().items() if k[:1] in "astx" and k[1:2].isdigit()}

_ITEMS = f"SELECT article_id, title, {_U} canonical_url, {_ISO} published_at FROM {_R}"
_FIRM = r"(?:\p{Lu}[\pL'-]+ ){1,3}(?:Airlines|Bank|Batteries|Chemicals|Energy|Foods|Games|Insurance|Logistics|Mining|Motors|Optics|Paper|Pharma|Retail|Robotics|Securities|Semiconductor|Shipping|Software|Steel|Telecom|Textiles|Water)"


def _oracles() -> dict[str, str]:
    from newsloom.plans.entities import ORACLE as E

    talk = f"""(SELECT article_id, coalesce(entity, '') target, concat_ws(' ', trim(regexp_replace(title, '[\\s\\pZ]+', ' ', 'g')), trim(regexp_replace(summary, '[\\s\\pZ]+', ' ', 'g'))) said FROM (SELECT DISTINCT article_id, title, summary FROM news_articles) JOIN ({E['d2_headline_entity']}) USING (article_id))"""
    near = "lower(CASE WHEN strpos(t, target) > 0 THEN substr(t, greatest(1, strpos(t, target) - 80), strpos(t, target) + length(target) + 80 - greatest(1, strpos(t, target) - 80)) ELSE '' END)"
    keep = f"""t <> '' AND target <> '' AND contains(t, target) AND NOT regexp_matches(lower(t), 'giveaway|lottery|follow me|抽奖|转发有礼') AND len(regexp_extract_all(lower(t), '[0-9](?:\\.[0-9]+)?%')) < 3
      AND CASE WHEN regexp_matches({near}, 'factory|plant|order|contract|deal|recall|strike|订单|停工|召回|合作') THEN true WHEN length(t) >= 180 AND NOT regexp_matches({near}, 'rumou?r|hearsay|hear that|传闻|听说|据说') THEN false
      ELSE regexp_matches({near}, 'profit|利润|expand|扩建|delays|推迟') END"""
    local = "(collected_at AT TIME ZONE 'Asia/Shanghai')"
    return {
        "a3_feed_errors": f"SELECT article_id, CASE length(title) % 5 WHEN 0 THEN 'empty' WHEN 1 THEN 'html_page' WHEN 2 THEN 'not_xml' WHEN 3 THEN 'malformed' END error FROM {_R}",
        "a6_six_lists": """SELECT article_id FROM (SELECT DISTINCT article_id, source_id, title, summary FROM news_articles) WHERE regexp_matches(lower(coalesce(source_id,'')), 'wire|markets') AND NOT contains(lower(coalesce(source_id,'')), 'tidegate_wire_live')
          AND regexp_matches(lower(coalesce(title,'')), 'profit|利润|plan') AND NOT contains(lower(coalesce(title,'')), 'exclusive') AND NOT contains(lower(coalesce(summary,'')), 'million crowns')""",
        "a7_dispatch": _ITEMS + " WHERE length(title) % 5 < 3",
        "a7_dispatch_errors": f"SELECT article_id, CASE length(title) % 5 WHEN 3 THEN 'govcn' ELSE 'telex' END kind, CASE length(title) % 5 WHEN 3 THEN 'not_json' ELSE 'unknown_kind' END error FROM {_R} WHERE length(title) % 5 >= 3",
        "a9_cninfo": f"SELECT article_id, 'Firm：'||title title, 'https://static.cninfo.com.cn/f/'||article_id||'.PDF' url, {_ISO} published_at FROM {_R} UNION ALL SELECT article_id, title||' 2', 'https://static.cninfo.com.cn/g/'||article_id||'.PDF', {_ISO} FROM {_R}",
        "a10_marketaux": f"SELECT article_id, title, CASE WHEN contains(lower(title), 'the pub') THEN '' ELSE 'The Pub：' END||title||' in short' summary, {_U} canonical_url FROM {_R} UNION ALL SELECT article_id, title||' again', 'by the pub: text', {_U} FROM {_R}",
        "a11_search_results": f"SELECT article_id, title||' '||n title, url||'?p='||n canonical_url FROM {_R}, (SELECT unnest([1, 2, 4]) n) WHERE NOT regexp_matches(url, '[?#]') AND CASE WHEN length(title) % 2 = 0 THEN n IN (1, 2) ELSE n = 4 END",
        "a16_board_rows": f"SELECT article_id, title, 'https://board.example/b/'||article_id url, 'Ann & Bo' author, 12000::BIGINT reads, 7::BIGINT replies FROM {_R}",
        "a17_card_posts": f"SELECT article_id, article_id||'-b' post_id, 'Ann' author, length(t)::INT n_chars FROM (SELECT *, said t FROM {talk}) WHERE {keep}",
        "a18_listed_posts": f"SELECT article_id, r::INT AS \"rank\", CASE r WHEN 1 THEN 'first' ELSE '' END title, length(said)::INT n_chars, article_id||'-'||r post_id FROM {talk}, (SELECT unnest([1, 2]) r)",
        "a18_symbols": f"""SELECT article_id, CASE n % 5 WHEN 0 THEN 'SZ'||lpad(n::VARCHAR, 6, '0') WHEN 1 THEN 'HK'||lpad(n::VARCHAR, 5, '0') WHEN 4 THEN 'ABC' ELSE CASE WHEN n % 2 = 0 THEN 'HK'||lpad(c, 5, '0') ELSE CASE WHEN c[1] IN ('6','9') THEN 'SH' ELSE 'SZ' END||lpad(c, 6, '0') END END symbol
          FROM (SELECT *, CASE n % 5 WHEN 3 THEN '6'||n ELSE n::VARCHAR END c FROM (SELECT article_id, length(article_id) + length(title) n FROM {_R}))""",
        "a19_tables": f"""SELECT 'cls' AS "table", article_id, CASE WHEN length(title) % 2 = 0 THEN substr(title, 1, 80) ELSE title END title, {_ISO} published_at, 'exact' timestamp_quality FROM {_R} WHERE title <> ''
          UNION ALL SELECT 'cctv', article_id, title, strftime({local}::DATE + INTERVAL 4 HOUR, '%Y-%m-%dT%H:%M:%S+00:00'), 'estimated' FROM {_R} WHERE title <> ''""",
        "a20_counts": f"SELECT article_id, (CASE n % 4 WHEN 0 THEN n * 1000 WHEN 1 THEN n * 1000 WHEN 2 THEN n * 1000 ELSE 0 END)::BIGINT n FROM (SELECT article_id, length(title) n FROM {_R})",
        "a1_registry": """SELECT source_id, name, lane, trust_tier::INT trust_tier, 'mixed' coverage_scope, 'daily' scheduler_class, phase1_disposition, enabled, true accepted FROM source_registry
          UNION ALL SELECT 'x-min', 'Min', 'signal', 2, 'mixed', 'daily', 'defer', true, true UNION ALL SELECT 'x-odd', 'Odd', 'odd', 2, 'mixed', 'daily', 'defer', true, false UNION ALL SELECT NULL, 'no id', 'signal', 2, 'mixed', 'daily', 'defer', true, false""",
        "a2_catalogue": """SELECT source_id, CASE WHEN length(source_id) % 2 = 0 THEN upper(source_id) ELSE name END name, lane, length(tz_name)::INT max_items FROM source_registry JOIN source_clock USING (source_id)
          WHERE enabled AND phase1_disposition IN ('migrate_phase1', 'compat_keep') AND source_id <> 'tidegate_filings'""",
        "a22_release_items": f"""SELECT 'rel_'||substr(sha256('s|'||article_id),1,24) article_id, title, 'Label | actual '||length(title)||'.0 | previous 1.5' summary, CASE WHEN length(title) % 2 = 0 THEN 'estimated' ELSE 'exact' END timestamp_quality, epoch(collected_at)::BIGINT published
          FROM {_R} WHERE date_trunc('second', collected_at) BETWEEN TIMESTAMPTZ '2026-01-01 00:00:00+00' AND TIMESTAMPTZ '2026-01-31 23:59:59+00'""",
        "a30_json_view": "SELECT DISTINCT event_id, event_type, event_rank_score FROM news_events",
        "x11_failed_write": "SELECT source_id, lane FROM source_registry",
        "x13_ingest_health": """WITH a AS (SELECT DISTINCT article_id, source_id, title, CASE WHEN published_at IS NOT NULL THEN canonical_url END u, canonical_url c, length(title) n FROM news_articles WHERE collected_at >= TIMESTAMPTZ '2026-02-01 00:00:00+00'),
          k AS (SELECT *, CASE WHEN u IS NULL THEN 'rejected' WHEN n % 3 <> 0 THEN 'inserted' WHEN n % 2 = 0 THEN 'updated' WHEN u IS DISTINCT FROM c THEN 'updated' ELSE 'same' END w FROM a)
          SELECT source_id, count(*) delivered, count(*) FILTER (w = 'inserted') inserted, count(*) FILTER (w = 'updated') updated, count(*) FILTER (w = 'same') same, count(*) FILTER (w = 'rejected') rejected,
            CASE WHEN count(*) FILTER (w = 'rejected') = 0 THEN 'ok' WHEN count(*) FILTER (w = 'rejected') = count(*) THEN 'down' ELSE 'degraded' END status FROM k GROUP BY 1""",
        "s7_resumable_replay": """SELECT run_key, 'ok' status, CASE WHEN row_number() OVER (ORDER BY run_key) = 3 THEN 2 ELSE 1 END::INT attempts, n FROM (SELECT 'week:'||strftime(ts, '%G-W%V') run_key, count(*) n FROM events WHERE ts >= '2024-01-03' AND ts < '2024-01-25' GROUP BY 1)""",
        "t5_field_times": f"""SELECT article_id, CASE length(title) % 4 WHEN 2 THEN epoch({local}::DATE)::BIGINT + 4 * 3600 WHEN 3 THEN -1 ELSE epoch(date_trunc('second', collected_at))::BIGINT END sec, length(title) % 4 = 2 dated FROM {_R}""",
        "t6_recent_month_day": f"""SELECT article_id, epoch(CASE WHEN length(title) % 2 = 0 THEN date_trunc('minute', w) ELSE w::DATE::TIMESTAMP END)::BIGINT - 8 * 3600 sec FROM (SELECT article_id, title, {local} - to_days((length(title) * 3 % 300)::INT) w FROM {_R})""",
    }


ORACLE = _oracles()
