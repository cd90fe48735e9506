"""Queries of the scalar cleaning and filter operators over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions import text as X
from newsloom.session import table

AS_OF = "2026-03-01 00:00:00"


def _articles(spark: SparkSession, d: str, *cols: str) -> DataFrame:
    return table(spark, d, "news_articles").select("article_id", *cols).distinct()


def b1_normalize_title(spark: SparkSession, d: str) -> DataFrame:
    a = _articles(spark, d, "title")
    return a.select("article_id", X.squeeze(F.col("title")).alias("title_clean"), X.title_key(F.col("title")).alias("title_key"))


def b2_strip_html(spark: SparkSession, d: str) -> DataFrame:
    """Each text as a page: tags, escaped tags, named and numeric entities around it, its own ampersands as they are."""
    bare = X.strip_html(F.concat(F.lit("<p>"), F.col("text"), F.lit("</p><br/>&lt;b&gt;end&#8217;s&lt;/b&gt; &amp;lt; &eacute;&#x4e2d; &nosuch;")))
    return table(spark, d, "documents").select("doc_id", "text").distinct().select("doc_id", F.length(bare).alias("n"), F.sha2(bare, 256).alias("digest"))


def b3_canonical_url(spark: SparkSession, d: str) -> DataFrame:
    a = _articles(spark, d, "url")
    return a.select("article_id", X.canonical_url(F.col("url")).alias("clean_url"), X.url_host(F.col("url")).alias("host"))


def b4_focus(spark: SparkSession, d: str) -> DataFrame:
    return _articles(spark, d, "title").select("article_id", X.focus(F.col("title")).alias("focus"))


def b5_skeleton(spark: SparkSession, d: str) -> DataFrame:
    return _articles(spark, d, "title").select("article_id", X.skeleton(F.col("title")).alias("skeleton"))


def b6_language(spark: SparkSession, d: str) -> DataFrame:
    a = _articles(spark, d, "title", "summary", "language").withColumn("detected", X.language(F.col("title"), F.col("summary")))
    return a.groupBy("language", "detected").agg(F.count("*").alias("n_articles"))


def b7_slug(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "event_entity_links").select("entity_name").distinct().select("entity_name", X.slug(F.col("entity_name")).alias("slug"))


def b8_lookup_key(spark: SparkSession, d: str) -> DataFrame:
    k = table(spark, d, "entity_aliases_v1").select("alias").distinct()
    return k.select("alias", X.lookup_key(F.col("alias")).alias("lookup_key"), X.company_key(F.col("alias")).alias("company_key"))


def b9_window_filter(spark: SparkSession, d: str) -> DataFrame:
    """Half-open window on the published text, on the collection time only where nothing is published."""
    lo, hi = "2026-01-01T00:00:00+00:00", "2026-02-01T00:00:00+00:00"
    p, c = F.col("published_at"), F.date_format("collected_at", "yyyy-MM-dd'T'HH:mm:ssxxx")
    inside = F.when(p.isNotNull(), (p >= lo) & (p < hi)).otherwise((c >= lo) & (c < hi))
    return _articles(spark, d, "published_at", "collected_at").filter(inside).select("article_id", p.isNull().alias("by_collection"))


def b9_source_filter(spark: SparkSession, d: str) -> DataFrame:
    a = _articles(spark, d, "source_id").filter(F.col("source_id").endswith("_wire") & ~F.col("source_id").isin("lowfen_wire"))
    return a.groupBy("source_id").agg(F.count("*").alias("n"))


def b10_recent(spark: SparkSession, d: str) -> DataFrame:
    t = F.try_to_timestamp("published_at", F.lit("yyyy-MM-dd'T'HH:mm:ssXXX"))
    ok = t.isNull() | (t >= F.lit(AS_OF).cast("timestamp") - F.expr("INTERVAL 720 HOURS"))
    return _articles(spark, d, "source_id", "published_at").groupBy("source_id").agg(F.count_if(ok).alias("fresh"), F.count_if(t.isNull()).alias("undated"))


def b12_prefix_predicates(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "source_registry")
    official = F.coalesce(F.col("source_family"), F.lit("")).startswith("exchange:") | F.col("source_id").endswith("_filings")
    return s.select("source_id", official.alias("is_official"))


def b18_json_flags(spark: SparkSession, d: str) -> DataFrame:
    """A JSON text read defensively: unreadable gives null, an absent key the default."""
    v = F.try_parse_json("props")
    return table(spark, d, "events").select("event_id", F.coalesce(F.try_variant_get(v, "$.k", "bigint"), F.lit(-1).cast("bigint")).alias("k"))


def b19_effective_time(spark: SparkSession, d: str) -> DataFrame:
    """Estimated and unknown times count from collection, others from publication where it can be read."""
    t = F.try_to_timestamp("published_at", F.lit("yyyy-MM-dd'T'HH:mm:ssXXX"))
    q = F.lower(F.trim(F.coalesce("timestamp_quality", F.lit("unknown"))))
    eff = F.when(q.isin("estimated", "unknown"), F.coalesce("collected_at", t)).otherwise(F.coalesce(t, "collected_at"))
    return _articles(spark, d, "published_at", "timestamp_quality", "collected_at").select("article_id", F.unix_seconds(eff).alias("effective_epoch"))


QUERIES = {k: f for k, f in globals().items() if k[:1] == "b" and k[1:2].isdigit()}

_SQ = r"trim(regexp_replace({c}, '[\s\pZ]+', ' ', 'g'))"
_T = _SQ.format(c="title")
# the documents' own text holds no entity; a query of its own would show one as a difference
_HTML = r"""trim(regexp_replace(regexp_replace('<p>'||text||'</p><br/><b>end’s</b> &lt; é中 &nosuch;', '<[^>]+>', ' ', 'g'), '[\s\pZ]+', ' ', 'g'))"""
_PUB = r"CASE WHEN regexp_full_match(published_at, '\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(Z|[+-]\d\d:\d\d)') THEN try_cast(published_at AS TIMESTAMPTZ) END"
ORACLE = {
    "b1_normalize_title": f"SELECT DISTINCT article_id, {_T} title_clean, lower({_T}) title_key FROM news_articles",
    "b2_strip_html": f"SELECT doc_id, length(b) n, sha256(b) digest FROM (SELECT DISTINCT doc_id, {_HTML} b FROM documents)",
    "b3_canonical_url": r"""SELECT article_id, CASE WHEN url IS NULL THEN NULL WHEN NOT (scheme = '' OR regexp_matches(url, '(?i)^https?://[^/?#]+')) THEN ''
      ELSE scheme || substr(CASE WHEN len(kept) > 0 THEN base||'?'||array_to_string(list_transform(list_sort(list_transform(range(1, len(kept) + 1), lambda i: {'f': list_position(list_transform(kept, lambda p: split_part(p,'=',1)), split_part(kept[i],'=',1)), 'i': i, 'p': kept[i]})), lambda x: x.p), '&') ELSE base END, length(scheme) + 1) END clean_url,
      regexp_replace(lower(regexp_extract(url, '(?i)^https?://([^/?#:]+)', 1)), '^www\.', '') host
      FROM (SELECT *, lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) scheme, list_transform(list_filter(string_split(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '&'), lambda p: regexp_matches(p, '^[^=]+=.+')
        AND lower(split_part(p,'=',1)) NOT IN ('oc','src','guccounter') AND NOT starts_with(lower(split_part(p,'=',1)), 'utm_')),
        lambda p: replace(url_encode(url_decode(replace(split_part(p,'=',1),'+',' '))),'%20','+') || '=' || replace(url_encode(url_decode(replace(regexp_extract(p,'^[^=]+=(.*)',1),'+',' '))),'%20','+')) kept
        FROM (SELECT DISTINCT article_id, url, regexp_extract(url, '^([^?#]*)', 1) base FROM news_articles))""",
    "b4_focus": f"SELECT DISTINCT article_id, substr(trim(regexp_extract({_T}, '^([^。！？!?;；]*)', 1)), 1, 140) focus FROM news_articles",
    "b5_skeleton": rf"SELECT DISTINCT article_id, substr(trim(regexp_replace(regexp_replace(lower({_T}), '[0-9]{{1,4}}(?:[./:-][0-9]{{1,2}})+', ' ', 'g'), '[^\pL\pN_]+', ' ', 'g')), 1, 120) skeleton FROM news_articles",
    "b6_language": r"SELECT language, CASE WHEN regexp_matches(concat_ws(' ', title, summary), '[\x{4e00}-\x{9fff}]') THEN 'zh' ELSE 'en' END detected, count(*) n_articles FROM (SELECT DISTINCT article_id, title, summary, language FROM news_articles) GROUP BY ALL",
    "b7_slug": r"""SELECT entity_name, CASE WHEN entity_name IS NULL THEN NULL WHEN s = '' THEN 'zh-'||substr(sha1(c),1,12) WHEN length(s) > 80 THEN substr(s,1,64)||'-'||substr(sha1(c),1,12) ELSE s END slug
      FROM (SELECT *, regexp_replace(regexp_replace(lower(c), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') s FROM (SELECT DISTINCT entity_name, trim(regexp_replace(entity_name, '[\s\pZ]+', ' ', 'g')) c FROM event_entity_links))""",
    "b8_lookup_key": r"SELECT DISTINCT alias, regexp_replace(lower(alias), '[^\pL\pN]+', '', 'g') lookup_key, lower(regexp_replace(regexp_replace(alias, '(?:有限责任公司|股份有限公司|有限公司|集团|股份|Inc|Ltd|Corp|Group|Holdings|PLC)', '', 'g'), '[\s_,.-]+', '', 'g')) company_key FROM entity_aliases_v1",
    "b9_window_filter": """SELECT DISTINCT article_id, published_at IS NULL by_collection FROM news_articles WHERE CASE WHEN published_at IS NOT NULL
      THEN published_at >= '2026-01-01T00:00:00+00:00' AND published_at < '2026-02-01T00:00:00+00:00'
      ELSE collected_at >= TIMESTAMPTZ '2026-01-01 00:00:00+00' AND collected_at < TIMESTAMPTZ '2026-02-01 00:00:00+00' END""",
    "b9_source_filter": "SELECT source_id, count(DISTINCT article_id) n FROM news_articles WHERE ends_with(source_id, '_wire') AND source_id <> 'lowfen_wire' GROUP BY 1",
    "b10_recent": f"""SELECT source_id, count(*) FILTER (t IS NULL OR t >= TIMESTAMPTZ '2026-03-01 00:00:00+00' - INTERVAL 720 HOUR) fresh, count(*) FILTER (t IS NULL) undated
      FROM (SELECT DISTINCT article_id, source_id, {_PUB} t FROM news_articles) GROUP BY 1""",
    "b12_prefix_predicates": "SELECT source_id, starts_with(coalesce(source_family,''), 'exchange:') OR ends_with(source_id, '_filings') is_official FROM source_registry",
    "b18_json_flags": "SELECT event_id, coalesce(try_cast(json_extract_string(props, '$.k') AS BIGINT), -1) k FROM events",
    "b19_effective_time": f"""SELECT article_id, CASE WHEN lower(trim(coalesce(timestamp_quality,'unknown'))) IN ('estimated','unknown') THEN epoch(coalesce(collected_at, t)) ELSE epoch(coalesce(t, collected_at)) END::BIGINT effective_epoch
      FROM (SELECT DISTINCT article_id, timestamp_quality, collected_at, {_PUB} t FROM news_articles)""",
}
