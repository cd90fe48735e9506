"""Persisting collected items source by source, and replays that go on where they stopped."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.operators.state import VersionedTable, merge_rows


def persist(kept: DataFrame, batch: DataFrame, key: str, source: str, faults: dict[str, Column]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(table, rejects, health) after a batch; each row is judged alone, so a source that fails never touches another.

    ``faults`` are conditions that reject a row, by name; null counts as no fault.  Of accepted rows with one key one counts.  health has per source delivered, inserted,
    updated, same, rejected, the commonest fault and status: ok, degraded (some rejected) or down (all rejected)."""
    why = F.coalesce(*[F.when(F.coalesce(bad, F.lit(False)), name) for name, bad in faults.items()])
    judged = batch.withColumn("_fault", why)
    good = judged.filter("_fault is null").drop("_fault").dropDuplicates([key])
    merged = merge_rows(kept, good, [key])
    mine = good.select(key).join(merged.select(key, source, "change"), key)
    done = mine.groupBy(source).agg(*[F.count_if(F.col("change") == c).alias(c) for c in ("inserted", "updated", "same")])
    bad = judged.groupBy(source).agg(F.count("*").alias("delivered"), F.count("_fault").alias("rejected"), F.mode("_fault", True).alias("fault"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    status = F.when(F.col("rejected") == 0, "ok").when(F.col("rejected") == F.col("delivered"), "down").otherwise("degraded")
    health = bad.join(done, source, "left").select(source, "delivered", zero("inserted"), zero("updated"), zero("same"), "rejected", "fault", status.alias("status"))
    return merged, judged.filter("_fault is not null").withColumnRenamed("_fault", "fault"), health


def resume(progress: VersionedTable, runs: dict[str, Callable[[], int]], rerun: bool = False, stop_on_error: bool = True) -> DataFrame:
    """Run what has not ended well yet, in order, and return the progress table: run_key, status, attempts, n, error.

    Each run is marked started before and finished after, so that a stop shows; finished runs are skipped unless ``rerun``."""
    spark, shape = progress.spark, "run_key string, status string, attempts int, n bigint, error string"
    table = progress.read()
    known = {r["run_key"]: r for r in table.collect()} if table is not None else {}  # one row a run
    mark = lambda *row: progress.upsert(spark.createDataFrame([row], shape), ["run_key"])
    for key, run in runs.items():
        before = known.get(key)
        if before and before["status"] == "ok" and not rerun:
            continue
        attempts = (before["attempts"] if before else 0) + 1
        mark(key, "running", attempts, None, None)
        try:
            mark(key, "ok", attempts, run(), None)
        except Exception as e:  # noqa: BLE001 - whatever it is, it is this run's
            mark(key, "failed", attempts, None, str(e)[:200])
            if stop_on_error:
                break
    return progress.read()
