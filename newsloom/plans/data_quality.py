"""Queries of the general data problems: mixed timestamps (p4) and broken references (p5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.operators.references import Parent, Reference, broken_by_period, broken_references
from newsloom.operators.timestamps import unnormalised
from newsloom.session import table


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return unnormalised(table(spark, d, "news_articles"), table(spark, d, "source_clock"))


def _model(spark: SparkSession, d: str) -> tuple[list[Parent], list[Reference]]:
    articles, links = table(spark, d, "news_articles"), table(spark, d, "article_event_links")
    both = F.concat_ws("|", F.coalesce("article_id", F.lit("")), F.coalesce("event_id", F.lit("")))
    parents = [
        Parent("news_articles", articles, "article_id", "collected_at"),
        Parent("news_events", table(spark, d, "news_events"), "event_id", "created_at"),
        Parent("source_registry", table(spark, d, "source_registry"), "source_id", "created_at"),
    ]
    references = [
        Reference("article_event_links", "article_id", links, both, "created_at", "news_articles"),
        Reference("article_event_links", "event_id", links, both, "created_at", "news_events"),
        Reference("news_articles", "source_id", articles, F.col("article_id"), "collected_at", "source_registry"),
    ]
    return parents, references


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return broken_references(*_model(spark, d))


def p5_by_period(spark: SparkSession, d: str) -> DataFrame:
    return broken_by_period(*_model(spark, d))


QUERIES = {"p4_found": p4_found, "p5_found": p5_found, "p5_by_period": p5_by_period}

_P5 = """
WITH refs AS (
  SELECT DISTINCT 'article_event_links' table_name, 'article_id' field_name, coalesce(article_id,'')||'|'||coalesce(event_id,'') record_key,
         article_id ref_key, created_at t, 'news_articles' parent FROM article_event_links
  UNION SELECT DISTINCT 'article_event_links', 'event_id', coalesce(article_id,'')||'|'||coalesce(event_id,''), event_id, created_at, 'news_events' FROM article_event_links
  UNION SELECT DISTINCT 'news_articles', 'source_id', article_id, source_id, collected_at, 'source_registry' FROM news_articles),
parents AS (
  SELECT 'news_articles' parent, lower(trim(article_id)) k, min(collected_at) arrival FROM news_articles GROUP BY 1, 2
  UNION ALL SELECT 'news_events', lower(trim(event_id)), min(created_at) FROM news_events GROUP BY 1, 2
  UNION ALL SELECT 'source_registry', lower(trim(source_id)), min(created_at) FROM source_registry GROUP BY 1, 2),
found AS (
  SELECT r.table_name, r.field_name, r.record_key, r.ref_key,
         CASE WHEN p.k IS NULL THEN 'missing' WHEN p.arrival > r.t THEN 'late' END status, strftime(r.t AT TIME ZONE 'UTC', '%Y-%m') period
  FROM refs r LEFT JOIN parents p ON p.parent = r.parent AND p.k = lower(trim(r.ref_key, E' \\t\\r\\n')) WHERE r.ref_key IS NOT NULL)
"""
ORACLE = {
    "p5_found": _P5 + "SELECT * FROM found WHERE status IS NOT NULL",
    "p5_by_period": _P5 + "SELECT table_name, field_name, status, period, count(*) n_refs FROM found WHERE status IS NOT NULL GROUP BY ALL",
}
