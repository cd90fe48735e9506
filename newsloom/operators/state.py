"""Keyed state without a table format: merges, duplicate tiers, manifests and versioned tables."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def merge_rows(old: DataFrame, new: DataFrame, keys: list[str], keep_old: list[str] | None = None) -> DataFrame:
    """Full outer merge by key with a column ``change``: inserted, updated, same or kept.

    New values win, except for the columns of ``keep_old``, whose old value stays where there is one.  Keys are
    unique on each side; a null new value replaces an old one.
    """
    keep_old = keep_old or []
    rest = [c for c in old.columns if c not in keys]
    o = old.select(*keys, F.struct(*rest).alias("_o"), F.lit(True).alias("_has_o"))
    n = new.select(*keys, F.struct(*rest).alias("_n"), F.lit(True).alias("_has_n"))
    j = o.join(n, keys, "full_outer")
    fresh = F.col("_has_n").isNotNull()

    def value(c: str) -> Column:
        both = F.coalesce(F.col(f"_o.{c}"), F.col(f"_n.{c}")) if c in keep_old else F.col(f"_n.{c}")
        return F.when(fresh, both).otherwise(F.col(f"_o.{c}")).alias(c)

    change = F.when(F.col("_has_o").isNull(), "inserted").when(~fresh, "kept").when(F.col("_o").eqNullSafe(F.col("_n")), "same").otherwise("updated")
    return j.select(*keys, *[value(c) for c in rest], change.alias("change"))


def duplicate_tiers(df: DataFrame, key: str, source: str, at: str, tiers: dict[str, list[str]], only: dict[str, Column] | None = None) -> DataFrame:
    """key, tier, existing_id: what a row repeats of its source's earlier ones, by the first of the tiers that hits.

    A tier is a list of columns that must all be given and equal; of several earlier rows the newest (by ``at``,
    then ``key``) is the existing one.  It is sought within the row's day first and else is the last row of the group's
    last day before, which comes from a table of one row a group and day; so a value that is shared by very many
    rows is spread over its days.  A row asks in a tier only where the condition ``only[tier]`` holds."""
    out = df.select(key, source, at, *dict.fromkeys(c for cols in tiers.values() for c in cols)).withColumn("_day", F.to_date(at))
    name, found = F.lit(None).cast("string"), F.lit(None).cast("string")
    for tier, cols in reversed(tiers.items()):
        given = F.col(source).isNotNull()
        for c in cols:
            given = given & F.col(c).isNotNull() & (F.trim(F.col(c).cast("string")) != "")
        # rows without the tier's values stand alone, each under its own key
        out = out.withColumn("_g", F.when(given, F.xxhash64(F.lit(tier), source, *cols)).otherwise(F.xxhash64(F.lit("alone"), key)))
        last = out.groupBy("_g", "_day").agg(F.max_by(key, F.struct(at, key)).alias("_last"))
        last = last.select("_g", "_day", F.lag("_last").over(Window.partitionBy("_g").orderBy("_day")).alias("_before"))
        same_day = F.lag(key).over(Window.partitionBy("_g", "_day").orderBy(at, key))
        out = out.withColumn("_same", same_day).join(last.filter("_before is not null"), ["_g", "_day"], "left")
        asks = (only or {}).get(tier, F.lit(True))
        out = out.withColumn(f"_{tier}", F.when(asks, F.coalesce("_same", "_before"))).drop("_g", "_same", "_before")
        name, found = F.when(F.col(f"_{tier}").isNotNull(), tier).otherwise(name), F.coalesce(F.col(f"_{tier}"), found)
    return out.select(key, name.alias("tier"), found.alias("existing_id")).filter("tier is not null")


class Manifest:
    """A small JSON state as numbered files under ``path``: each is written aside, then renamed to the next number, which
    fails if another writer was there first.  No file is ever replaced or deleted, and the highest number holds, so a
    stop at any point leaves the last complete state."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._folder = self._jvm.org.apache.hadoop.fs.Path(self.path)
        self._fs = self._folder.getFileSystem(self._conf)

    def numbers(self) -> list[int]:
        if not self._fs.exists(self._folder):
            return []
        names = [f.getPath().getName() for f in self._fs.listStatus(self._folder)]
        return sorted(int(n[1:]) for n in names if n[:1] == "m" and n[1:].isdigit())

    def read(self) -> dict | None:
        numbers = self.numbers()
        if not numbers:
            return None
        stream = self._fs.open(self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/m{numbers[-1]:012d}"))
        try:
            return json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()

    def write(self, state: dict) -> int:
        number = max(self.numbers(), default=0) + 1
        aside = self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/aside-{uuid.uuid4().hex}")
        stream = self._fs.create(aside, False)
        stream.write(json.dumps(state).encode())
        stream.close()
        files = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._folder.toUri(), self._conf)
        none = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        files.rename(aside, self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/m{number:012d}"), none)
        return number


class VersionedTable:
    """A parquet table written as whole versions; the manifest names the one that holds.

    A failing write, or a stop at any point, leaves the table as it was.  Versions without any manifest are no empty table: they
    are refused."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.manifest = Manifest(spark, f"{self.path}/manifest")

    def version(self) -> str | None:
        state = self.manifest.read()
        return state and state["version"]

    def read(self) -> DataFrame | None:
        v = self.version()
        return None if v is None else self.spark.read.parquet(f"{self.path}/{v}")

    def replace(self, df: DataFrame) -> str:
        v = f"v-{uuid.uuid4().hex[:12]}"
        df.write.parquet(f"{self.path}/{v}")
        self.manifest.write({"version": v})
        return v

    def upsert(self, new: DataFrame, keys: list[str], keep_old: list[str] | None = None, newest_by: str | None = None) -> None:
        """Merge ``new`` (one row a key counts) into the table; with ``newest_by`` the row with the larger value of that
        column stays, so that rows which come late do not replace newer ones."""
        old = self.read()
        if newest_by:
            rest = [c for c in new.columns if c not in keys]
            both = new if old is None else old.unionByName(new)
            self.replace(both.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(newest_by)).alias("_r")).select(*keys, "_r.*"))
            return
        new = new.dropDuplicates(keys)
        self.replace(new if old is None else merge_rows(old, new, keys, keep_old).drop("change"))
