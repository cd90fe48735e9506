"""References to records that do not exist, or that arrive later than the row that names them.

Parent keys and child keys are tagged and put into one long table, which is grouped by parent table and key
with map-side combination, so a key that holds a third of all rows is one row per task before it is shuffled.
Only groups without a parent, or whose parent arrives after their first reference, are joined back to the
child rows; that join is salted.

Defined results: a null reference is none; a blank one names nothing and is ``missing``; keys compare without
letter case and outer blanks; a parent without arrival time is present and never late; a child without time
has a null period and is never late; whole repeated rows count once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.session import SALTS


@dataclass(frozen=True)
class Parent:
    name: str
    rows: DataFrame
    key: str
    arrival: str


@dataclass(frozen=True)
class Reference:
    table: str
    field: str
    rows: DataFrame
    record_key: Column
    time: str
    parent: str


def bare_key(c: Column) -> Column:
    return F.lower(F.regexp_replace(c, r"^[\s 　]+|[\s 　]+$", ""))


def _children(references: list[Reference]) -> DataFrame:
    out = None
    for r in references:
        part = r.rows.select(
            F.lit(r.parent).alias("parent"),
            bare_key(F.col(r.field)).alias("key"),
            F.lit(r.table).alias("table_name"),
            F.lit(r.field).alias("field_name"),
            r.record_key.alias("record_key"),
            F.col(r.field).alias("ref_key"),
            F.col(r.time).alias("time"),
        ).filter(F.col("ref_key").isNotNull())
        out = part if out is None else out.unionByName(part)
    return out


def suspect_keys(parents: list[Parent], references: list[Reference]) -> DataFrame:
    """Groups (parent, key, arrival, has_parent) without a parent row or with a parent later than a reference."""
    kids = _children(references)
    long = kids.select("parent", "key", F.lit(False).alias("is_parent"), F.lit(None).cast("timestamp").alias("arrival"), F.col("time").alias("ref_time"))
    for p in parents:
        long = long.unionByName(
            p.rows.filter(F.col(p.key).isNotNull()).select(
                F.lit(p.name).alias("parent"), bare_key(F.col(p.key)).alias("key"), F.lit(True).alias("is_parent"), F.col(p.arrival).alias("arrival"), F.lit(None).cast("timestamp").alias("ref_time")
            )
        )
    groups = long.groupBy("parent", "key").agg(F.max("is_parent").alias("has_parent"), F.min("arrival").alias("arrival"), F.min("ref_time").alias("first_ref"), F.max(~F.col("is_parent")).alias("has_child"))
    return groups.filter(F.col("has_child") & (~F.col("has_parent") | (F.col("arrival") > F.col("first_ref")))).select("parent", "key", "has_parent", "arrival")


def broken_references(parents: list[Parent], references: list[Reference]) -> DataFrame:
    """One row per broken reference: table_name, field_name, record_key, ref_key, status, period."""
    kids = _children(references).distinct().withColumn("_salt", F.pmod(F.xxhash64("record_key"), F.lit(SALTS)))
    bad = suspect_keys(parents, references).withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
    return (
        kids.join(bad, ["parent", "key", "_salt"])
        .withColumn("status", F.when(~F.col("has_parent"), F.lit("missing")).when(F.col("arrival") > F.col("time"), F.lit("late")))
        .filter(F.col("status").isNotNull())
        .select("table_name", "field_name", "record_key", "ref_key", "status", F.date_format("time", "yyyy-MM").alias("period"))
    )


def broken_by_period(parents: list[Parent], references: list[Reference]) -> DataFrame:
    """Counts of broken references by table, field, status and month.

    Missing ones are summed inside the groups: children are counted by key and month before they meet their parent rows, and the counts of groups
    without a parent are added up, so no reference is joined back.  Only references to parents that come too late need their own time, and are joined
    with those few parents."""
    kids = _children(references).distinct()
    month = F.date_format("time", "yyyy-MM")
    counted = kids.groupBy("parent", "key", "table_name", "field_name", month.alias("period")).agg(F.count("*").alias("n"))
    tagged = counted.select("parent", "key", F.lit(False).alias("is_parent"), F.struct("table_name", "field_name", "period", "n").alias("c"))
    for p in parents:
        keys = p.rows.filter(F.col(p.key).isNotNull()).select(F.lit(p.name).alias("parent"), bare_key(F.col(p.key)).alias("key")).distinct()
        tagged = tagged.unionByName(keys.select("parent", "key", F.lit(True).alias("is_parent"), F.lit(None).cast(tagged.schema["c"].dataType).alias("c")))
    # a group has at most one row a table, field and month, and one of its parent
    orphans = tagged.groupBy("parent", "key").agg(F.max("is_parent").alias("has_parent"), F.collect_list("c").alias("c")).filter(~F.col("has_parent"))
    missing = orphans.select(F.explode("c").alias("c")).select("c.table_name", "c.field_name", F.lit("missing").alias("status"), "c.period", "c.n")
    late = suspect_keys(parents, references).filter("has_parent").withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
    behind = kids.withColumn("_salt", F.pmod(F.xxhash64("record_key"), F.lit(SALTS))).join(late, ["parent", "key", "_salt"]).filter(F.col("arrival") > F.col("time"))
    behind = behind.select("table_name", "field_name", F.lit("late").alias("status"), month.alias("period"), F.lit(1).cast("bigint").alias("n"))
    return missing.unionByName(behind).groupBy("table_name", "field_name", "status", "period").agg(F.sum("n").alias("n_refs"))
