"""Structured Streaming twins of the batch operators.

Every job reads a folder of parquet files as a stream, runs with ``availableNow`` and checkpoints in the shared
folder, so that a restart goes on where it stopped.  The batch result is the contract.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.operators.state import VersionedTable
from newsloom.session import stash_path


def stream_of(spark: SparkSession, d: str, name: str) -> DataFrame:
    """A table as a stream; the schema is that of the table."""
    path = f"{d}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if _is_folder(spark, path):
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(d)


def _is_folder(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()


def run_to_end(df: DataFrame, label: str) -> DataFrame:
    """Run an append stream over all that is there and read what it wrote."""
    spark, out = df.sparkSession, stash_path(df.sparkSession, label)
    query = df.writeStream.format("parquet").option("path", f"{out}/data").option("checkpointLocation", f"{out}/checkpoint").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{out}/data")


def first_copies(df: DataFrame, keys: list[str], at: str, late: str) -> DataFrame:
    """Rows of a stream whose key has not been seen within the watermark."""
    return df.withWatermark(at, late).dropDuplicatesWithinWatermark(keys)


def window_counts(df: DataFrame, at: str, width: str, slide: str | None, by: list[str], late: str) -> DataFrame:
    """Counts per tumbling or sliding window; the state of a window is dropped when the watermark has passed it."""
    w = F.window(at, width, slide) if slide else F.window(at, width)
    return df.withWatermark(at, late).groupBy(w.alias("w"), *by).agg(F.count("*").alias("n"))


def run_updates(df: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Run an update stream over all that is there and read the last state of each key.

    Every batch's changed rows go to a folder of its own, which a retry replaces; so also the windows that the watermark
    has not passed when the input ends come out."""
    spark, out = df.sparkSession, stash_path(df.sparkSession, label)
    schema = df.schema.add("_batch", "long")

    def keep(batch: DataFrame, number: int) -> None:
        batch.withColumn("_batch", F.lit(number).cast("long")).write.mode("overwrite").parquet(f"{out}/data/batch={number}")

    query = df.writeStream.foreachBatch(keep).option("checkpointLocation", f"{out}/checkpoint").outputMode("update").trigger(availableNow=True).start()
    query.awaitTermination()
    if not query.lastProgress:
        return spark.createDataFrame([], df.schema)
    rest = [c for c in df.columns if c not in keys]
    rows = spark.read.schema(schema).parquet(f"{out}/data/*")
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "_batch").alias("_r")).select(*keys, "_r.*")


def upsert_stream(df: DataFrame, table: VersionedTable, keys: list[str], at: str, label: str) -> None:
    """Keyed upserts batch by batch: the newest row of each key, by ``at``, stays, in whatever order the rows come."""

    def merge(batch: DataFrame, _: int) -> None:
        if batch.isEmpty():
            return
        rest = [c for c in batch.columns if c not in keys]
        newest = batch.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(at)).alias("r")).select(*keys, "r.*")
        table.upsert(newest, keys, newest_by=at)

    out = stash_path(df.sparkSession, label)
    df.writeStream.foreachBatch(merge).option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start().awaitTermination()
