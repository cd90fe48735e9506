"""Streaming queries, run over all the data there is."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.operators.state import VersionedTable
from newsloom.session import stash_path
from newsloom.streaming.jobs import first_copies, run_to_end, run_updates, stream_of, upsert_stream, window_counts


def _events(spark: SparkSession, d: str) -> DataFrame:
    return stream_of(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def s4_stream_tumbling(spark: SparkSession, d: str) -> DataFrame:
    """Days by type, the last one as far as it has come."""
    out = run_updates(window_counts(_events(spark, d), "ts", "1 day", None, ["event_type"], "1 day"), ["w", "event_type"], "tumbling")
    return out.select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), "event_type", "n")


def s2_stream_sliding(spark: SparkSession, d: str) -> DataFrame:
    """Three days sliding by one, named by their last day; the first and last ones are as full as the input makes them."""
    out = run_updates(window_counts(_events(spark, d), "ts", "3 days", "1 day", ["event_type"], "1 day"), ["w", "event_type"], "sliding")
    day = F.date_format(F.col("w.end") - F.expr("INTERVAL 1 DAY"), "yyyy-MM-dd")
    return out.select(day.alias("day"), "event_type", "n")


def s6_stream_dedupe(spark: SparkSession, d: str) -> DataFrame:
    """Articles of a stream once per source and content: how many are left."""
    a = stream_of(spark, d, "news_articles").select("source_id", "content_hash", "collected_at")
    out = run_to_end(first_copies(a, ["source_id", "content_hash"], "collected_at", "400 days"), "dedupe")
    return out.groupBy("source_id").agg(F.count("*").alias("n"))


def s5_stream_upsert(spark: SparkSession, d: str) -> DataFrame:
    """The latest action of each user, kept in a versioned table by a stream of upserts."""
    kept = VersionedTable(spark, stash_path(spark, "upsert"))
    rows = _events(spark, d).select("user_id", "event_id", "event_type", F.struct("ts", "event_id").alias("at"))
    upsert_stream(rows, kept, ["user_id"], "at", "upsert-job")
    return kept.read().select("user_id", "event_id", "event_type")


QUERIES = {k: f for k, f in globals().items() if k[:1] == "s" and k[1:2].isdigit()}
ORACLE = {
    "s4_stream_tumbling": "SELECT ts::DATE::VARCHAR AS \"day\", event_type, count(*) n FROM events GROUP BY ALL",
    "s2_stream_sliding": "SELECT (ts::DATE + k)::VARCHAR AS \"day\", event_type, count(*) n FROM events, (SELECT unnest([0,1,2])::INT k) GROUP BY ALL",
    "s6_stream_dedupe": "SELECT source_id, count(DISTINCT content_hash) n FROM news_articles GROUP BY 1",
    "s5_stream_upsert": "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) k FROM events) WHERE k = 1",
}
