"""Queries of the feed parsers: payloads are made of all articles and must come back as the same items.

Also the persisted views and the term search.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions import text as X
from newsloom.sources import feeds as P
from newsloom.session import table


def _rows(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "news_articles").select("article_id", "title", "url", "collected_at").distinct().filter("url is not null")
    return a.withColumn("title", X.squeeze(F.col("title"))).withColumn("at", F.date_format("collected_at", "yyyy-MM-dd'T'HH:mm:ssxxx"))


def _json(spark: SparkSession, d: str, wrap) -> DataFrame:
    return _rows(spark, d).select("article_id", "collected_at", wrap.alias("payload"))


def _items(df: DataFrame) -> DataFrame:
    return df.select("article_id", "title", "canonical_url", "published_at")


def _esc(c: str) -> Column:
    out = F.col(c)
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def a4_rss(spark: SparkSession, d: str) -> DataFrame:
    x = F.concat(F.lit("<rss><channel><title>feed</title><item><title>"), _esc("title"), F.lit("</title><link>"), _esc("url"), F.lit("</link><pubDate>"), F.col("at"), F.lit("</pubDate></item></channel></rss>"))
    return _items(P.xml_items(_json(spark, d, x), "payload", "rss", ["article_id"], "collected_at"))


def a5_atom(spark: SparkSession, d: str) -> DataFrame:
    x = F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>'), _esc("title"), F.lit('</title><link rel="self" href="https://no.example/x"/><link rel="alternate" href="'), _esc("url"), F.lit('"/><updated>'), F.col("at"), F.lit("</updated></entry></feed>"))
    return _items(P.xml_items(_json(spark, d, x), "payload", "atom", ["article_id"], "collected_at"))


def a8_govcn(spark: SparkSession, d: str) -> DataFrame:
    j = F.to_json(F.array(F.struct(F.col("title").alias("TITLE"), F.col("url").alias("URL"), F.col("at").alias("DOCRELPUBTIME"))))
    return _items(P.json_items(_json(spark, d, j), "payload", P.FEEDS["govcn"], ["article_id"], "collected_at"))


def a10_mediastack(spark: SparkSession, d: str) -> DataFrame:
    j = F.to_json(F.struct(F.array(F.struct("title", "url", F.col("at").alias("published"), F.lit("pub").alias("source"))).alias("data")))
    out = P.json_items(_json(spark, d, j), "payload", P.FEEDS["mediastack"], ["article_id"], "collected_at")
    return out.select("article_id", "title", "summary", "canonical_url", "published_at")


def a12_reddit(spark: SparkSession, d: str) -> DataFrame:
    ups = F.pmod(F.xxhash64("article_id"), F.lit(1)).cast("int") + F.length("title") % 10
    one = F.struct(F.struct("title", F.col("url").alias("permalink"), ups.alias("ups"), F.unix_seconds("collected_at").alias("created_utc"), (F.length("title") % 7 == 0).alias("stickied")).alias("data"))
    j = F.to_json(F.struct(F.struct(F.array(one).alias("children")).alias("data")))
    return _items(P.json_items(_json(spark, d, j), "payload", P.FEEDS["reddit"], ["article_id"], "collected_at"))


def a13_hkex_jsonp(spark: SparkSession, d: str) -> DataFrame:
    """JSON text inside JSON inside a JSONP call; local times of Hong Kong."""
    inner = F.to_json(F.array(F.struct(F.col("title").alias("TITLE"), F.col("url").alias("FILE_LINK"), F.date_format(F.from_utc_timestamp("collected_at", "Asia/Hong_Kong"), "dd/MM/yyyy HH:mm").alias("DATE_TIME"))))
    j = F.concat(F.lit("callback("), F.to_json(F.struct(inner.alias("result"))), F.lit(");"))
    return _items(P.json_items(_json(spark, d, j), "payload", P.FEEDS["hkex"], ["article_id"], "collected_at"))


def a14_page_pattern(spark: SparkSession, d: str) -> DataFrame:
    x = F.concat(F.lit("<script>id:["), F.col("article_id"), F.lit("] t:["), F.regexp_replace("title", r"[\[\]]", " "), F.lit("] id:["), F.col("article_id"), F.lit("] t:[again] </script>"))
    out = P.pattern_items(_json(spark, d, x), "payload", r"id:\[([^\]]*)\] t:\[([^\]]*)\]", ["id", "t"], ["article_id"])
    return out.select("article_id", "id", "t")


def a15_html_list(spark: SparkSession, d: str) -> DataFrame:
    x = F.concat(F.lit('<ul><li class="other"><a href="/no">no</a></li><li class="news hot"><a href="/n/'), F.col("article_id"), F.lit('">'), _esc("title"), F.lit("</a></li></ul>"))
    return P.html_list_items(_json(spark, d, x), "payload", "article_id", "news", "https://base.example/").select("article_id", "title", "url")


def a6_term_lists(spark: SparkSession, d: str) -> DataFrame:
    ok = P.term_filter(F.col("title"), ["profit", "利润", "Exclusive"], ["Bank", "银行"])
    return table(spark, d, "news_articles").select("article_id", "title").distinct().filter(ok).select("article_id")


def a32_digest_view(spark: SparkSession, d: str) -> DataFrame:
    """The daily digest as a persisted view with an as-of parameter."""
    cols = ["event_id", "event_type", "primary_industry", "event_rank_score", "novelty_state", "event_state", "last_seen_at"]
    table(spark, d, "news_events").select(*cols).distinct().createOrReplaceTempView("newsloom_events")
    spark.sql("""CREATE OR REPLACE TEMP VIEW newsloom_digest AS SELECT event_id, event_type, primary_industry, event_rank_score FROM newsloom_events
      WHERE event_rank_score >= 20 AND novelty_state IN ('new', 'developing') AND event_state <> 'rejected' AND last_seen_at >= TIMESTAMP '2026-02-01 00:00:00+00:00' AND last_seen_at < TIMESTAMP '2026-03-01 00:00:00+00:00'""")
    return spark.table("newsloom_digest")


def c9_term_search(spark: SparkSession, d: str) -> DataFrame:
    """Articles and the reference entry their text mentions, counted by entry."""
    from newsloom.operators.term_match import first_term

    a = table(spark, d, "news_articles").select("article_id", F.concat_ws(" ", "title", "summary").alias("text")).distinct()
    hit = first_term(a, "article_id", "text", table(spark, d, "entity_aliases_v1"), "canonical_id", "alias", "entity")
    return hit.filter("entity is not null").groupBy("entity").agg(F.count("*").alias("n_articles"))


QUERIES = {k: f for k, f in globals().items() if k[0] in "ac" and k[1:2].isdigit()}

_R = r"(SELECT DISTINCT article_id, trim(regexp_replace(title, '[\s\pZ]+', ' ', 'g')) title, url, collected_at FROM news_articles WHERE url IS NOT NULL) r"
_U = r"""CASE WHEN len(list_filter(string_split(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '&'), lambda p: regexp_matches(p, '^[^=]+=.+') AND lower(split_part(p,'=',1)) NOT IN ('oc','src','guccounter') AND NOT starts_with(lower(split_part(p,'=',1)), 'utm_'))) > 0
  THEN regexp_extract(url, '^([^?#]*)', 1)||'?'||array_to_string(list_filter(string_split(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '&'), lambda p: regexp_matches(p, '^[^=]+=.+') AND lower(split_part(p,'=',1)) NOT IN ('oc','src','guccounter') AND NOT starts_with(lower(split_part(p,'=',1)), 'utm_')), '&') ELSE regexp_extract(url, '^([^?#]*)', 1) END"""
_ISO = "strftime(collected_at AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%S+00:00')"
_ITEM = f"SELECT article_id, title, {_U} canonical_url, {_ISO} published_at FROM {_R}"
ORACLE = {
    "a4_rss": _ITEM,
    "a5_atom": _ITEM,
    "a8_govcn": _ITEM,
    "a10_mediastack": f"SELECT article_id, title, CASE WHEN contains(lower(title), 'pub') THEN title ELSE 'pub：'||title END summary, {_U} canonical_url, {_ISO} published_at FROM {_R}",
    "a12_reddit": _ITEM + " WHERE length(title) % 10 >= 5 AND length(title) % 7 <> 0",
    "a13_hkex_jsonp": f"SELECT article_id, title, {_U} canonical_url, strftime(collected_at AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:00+00:00') published_at FROM {_R}",
    "a14_page_pattern": rf"SELECT article_id, article_id id, regexp_replace(title, '[\[\]]', ' ', 'g') t FROM {_R}",
    "a15_html_list": f"SELECT article_id, title, 'https://base.example/n/'||article_id url FROM {_R}",
    "a6_term_lists": "SELECT DISTINCT article_id FROM news_articles WHERE (contains(lower(title),'profit') OR contains(title,'利润') OR contains(lower(title),'exclusive')) AND NOT contains(lower(title),'bank') AND NOT contains(title,'银行')",
    "a32_digest_view": """SELECT DISTINCT event_id, event_type, primary_industry, event_rank_score FROM news_events WHERE event_rank_score >= 20 AND novelty_state IN ('new','developing') AND event_state <> 'rejected'
      AND last_seen_at >= TIMESTAMPTZ '2026-02-01 00:00:00+00' AND last_seen_at < TIMESTAMPTZ '2026-03-01 00:00:00+00'""",
    "c9_term_search": r"""SELECT entity, count(*) n_articles FROM (SELECT a.article_id, arg_min(canonical_id, (-length(trim(p)), canonical_id)) entity
      FROM (SELECT DISTINCT article_id, ' '||trim(regexp_replace(lower(concat_ws(' ', title, summary)), '[^\pL\pN]+', ' ', 'g'))||' ' t FROM news_articles) a
      JOIN (SELECT DISTINCT canonical_id, CASE WHEN regexp_matches(q, '[\x{4e00}-\x{9fff}]') THEN q ELSE ' '||q||' ' END p FROM (SELECT canonical_id, trim(regexp_replace(lower(alias), '[^\pL\pN]+', ' ', 'g')) q FROM entity_aliases_v1)) k ON contains(t, p) GROUP BY 1) GROUP BY 1""",
}
