"""Lines repeated across the documents of one site or source.

Method: incremental per-source line-count tables.  A batch's documents are taken apart once, into (key, source, line number, line
hash) rows that are kept as a run; its counts are merged as a delta into the kept tables, ``crossings`` names the lines whose
status changed, and only documents that hold such a line, or new documents with a repeated one, are rebuilt, with all lines that
are repeated now (``LineIndex``).  Documents already counted are left out of a delta, so a batch delivered twice counts once.

Lines are equal if they agree apart from letter case, blanks and digits.  The counts are combined before the
shuffle, so a line or source that holds a third of all rows is one row per task.

Defined results: null text has no lines and is no document of its source; a line with nothing left after
normalising is never repeated; empty lines count for the numbering; whole repeated rows count once; a null
source is a source of its own.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.operators.state import Manifest
from newsloom.session import join_checked, stash, stash_path

_DROPPED = r"[\s\p{Z}\p{Nd}﻿​⁠]+"


@dataclass(frozen=True)
class Rule:
    least: int = 6
    #: A line must stand in one of ``one_in`` documents of its source at least (5 %).
    one_in: int = 20


def line_key(line: Column) -> Column:
    """Hash of what is left of a line; null if nothing is."""
    bare = F.regexp_replace(F.lower(line), _DROPPED, "")
    return F.when(bare != "", F.xxhash64(bare))


def _source(df: DataFrame, source: str) -> Column:
    return F.coalesce(df[source], F.lit("")).alias("src")


def lines_of(df: DataFrame, key: str, source: str, text: str, keep: list[Column] | None = None) -> DataFrame:
    """id, src, kept columns, no, line: every line with something left, and of each document without any such line one row with null line."""
    docs = df.filter(F.col(text).isNotNull())
    rows = docs.select(F.col(key).alias("id"), _source(df, source), *(keep or []), F.posexplode(F.transform(F.split(text, "\n"), line_key)).alias("pos", "line"))
    return rows.filter("line is not null or pos = 0").select(*[c for c in rows.columns if c not in ("pos", "line")], (F.col("pos") + 1).alias("no"), "line")


def count_lines(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(src, line, n) and (src, docs) of ``lines_of``: in how many documents each line stands, how many documents there are."""
    once = lines.filter("line is not null").select("id", "src", "line").distinct()
    return once.groupBy("src", "line").agg(F.count("*").alias("n")), lines.select("id", "src").distinct().groupBy("src").agg(F.count("*").alias("docs"))


def merge(kept: tuple[DataFrame, DataFrame] | None, delta: tuple[DataFrame, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """The kept tables with a delta of new documents added."""
    if kept is None:
        return delta
    counts = kept[0].unionByName(delta[0]).groupBy("src", "line").agg(F.sum("n").alias("n"))
    totals = kept[1].unionByName(delta[1]).groupBy("src").agg(F.sum("docs").alias("docs"))
    return counts, totals


def repeated(tables: tuple[DataFrame, DataFrame], rule: Rule) -> DataFrame:
    """(src, line) of the lines that are repeated excessively.  At most ``one_in`` times the mean number of lines a
    document has, for each source."""
    counts, totals = tables
    return counts.filter(F.col("n") >= rule.least).join(totals, "src").filter(F.col("n") * rule.one_in >= F.col("docs")).select("src", "line")


def crossings(before: DataFrame, after: DataFrame) -> DataFrame:
    """(src, line, now): lines that became repeated (now true) or ceased to be (false)."""
    keys = ["src", "line"]
    return after.join(before, keys, "left_anti").withColumn("now", F.lit(True)).unionByName(before.join(after, keys, "left_anti").withColumn("now", F.lit(False)))


class LineIndex:
    """Line counts, line rows and repeated lines kept between batches under ``path``, a folder all executors share.  A manifest
    names what holds, so a new object on the same path goes on where the last one stopped."""

    def __init__(self, spark: SparkSession, path: str, key: str, source: str, text: str, rule: Rule = Rule()):
        self.spark, self.path, self.names, self.rule = spark, path.rstrip("/"), (key, source, text), rule
        self.manifest = Manifest(spark, f"{self.path}/manifest")

    def _write(self, name: str, df: DataFrame) -> str:
        path = f"{self.path}/{name}-{uuid.uuid4().hex[:12]}"
        df.write.parquet(path)
        return path

    def _state(self) -> dict:
        return self.manifest.read() or {"lines": [], "counts": None, "totals": None, "repeated": None}

    def lines(self) -> DataFrame | None:
        """id, src, no, line of all documents."""
        paths = self._state()["lines"]
        return self.spark.read.parquet(*paths).select("id", "src", "no", "line") if paths else None

    def repeated(self) -> DataFrame | None:
        path = self._state()["repeated"]
        return self.spark.read.parquet(path) if path else None

    def add(self, batch: DataFrame) -> DataFrame:
        """Merge a batch; (id) of the documents to rebuild: those that hold a line whose status changed, and new ones with a repeated line."""
        return self.add_lines(self._write("lines", lines_of(batch, *self.names)))

    def add_lines(self, path: str) -> DataFrame:
        """``add`` for a batch whose ``lines_of`` lie in a folder, where they stay."""
        state, fresh = self._state(), self.spark.read.parquet(path).select("id", "src", "no", "line")
        kept, old, before = self.lines(), None, self.repeated()
        if kept is not None:
            seen = kept.select("id").distinct()
            again = fresh.select("id").distinct().join(seen, "id", "left_semi")
            if not again.isEmpty():  # delivered before: left out, and the rest kept as a run of its own
                path = self._write("lines", fresh.join(again, "id", "left_anti"))
                fresh = self.spark.read.parquet(path)
            old = self.spark.read.parquet(state["counts"]), self.spark.read.parquet(state["totals"])
        counts, totals = (self._write(n, t) for n, t in zip(("counts", "totals"), merge(old, count_lines(fresh))))
        after = self._write("repeated", repeated((self.spark.read.parquet(counts), self.spark.read.parquet(totals)), self.rule))
        now = {"lines": [*state["lines"], path], "counts": counts, "totals": totals, "repeated": after}
        self.manifest.write(now)
        lines = self.spark.read.parquet(after)
        touched = join_checked(fresh.filter("line is not null"), lines, ["src", "line"]).select("id")
        if before is not None:
            changed = stash(crossings(before, lines).select("src", "line"), "crossings")
            touched = touched.unionByName(join_checked(kept.filter("line is not null"), changed, ["src", "line"]).select("id"))
        return touched.distinct()

    def occurrences(self) -> DataFrame:
        """(key, line_no): where repeated lines stand; lines are counted from 1."""
        hits = join_checked(self.lines().filter("line is not null"), self.repeated(), ["src", "line"])
        return hits.select(F.col("id").alias(self.names[0]), F.col("no").cast("int").alias("line_no")).distinct()


def rebuild(df: DataFrame, key: str, source: str, text: str, lines: DataFrame) -> DataFrame:
    """(key, text) of the documents that contain a given (src, line), without those lines.

    Each source's lines travel to its documents as one array (bounded as in ``repeated``), so no text is shuffled, but for the
    rows of ids that stand in the table more than once."""
    by_source = lines.groupBy("src").agg(F.collect_set("line").alias("_bad"))
    more = df.groupBy(key).agg(F.count("*").alias("_n")).filter("_n > 1").select(key)
    rows = df.filter(F.col(text).isNotNull()).select(key, _source(df, source), text)
    rows = join_checked(rows, more.withColumn("_more", F.lit(True)), [key], "left")
    parts = F.transform(F.split(text, "\n"), lambda s: F.struct(s.alias("s"), line_key(s).alias("k")))
    held = join_checked(rows, by_source, ["src"]).withColumn("_parts", parts)
    left = F.filter("_parts", lambda x: x["k"].isNull() | ~F.array_contains("_bad", x["k"]))
    cut = held.filter(F.exists("_parts", lambda x: x["k"].isNotNull() & F.array_contains("_bad", x["k"]))).select(key, "_more", F.array_join(F.transform(left, lambda x: x["s"]), "\n").alias(text))
    return cut.filter("_more is null").select(key, text).unionByName(cut.filter("_more").select(key, text).distinct())


def index_of(df: DataFrame, key: str, source: str, at: str, text: str, rule: Rule = Rule(), period: str = "year") -> LineIndex:
    """An index over a whole table, fed in batches, one a calendar ``period``; documents are taken apart once for all."""
    spark, path = df.sparkSession, stash_path(df.sparkSession, "site-lines")
    batch = F.coalesce(F.date_format(F.date_trunc(period, at), "yyyyMMdd"), F.lit("0")).alias("batch")
    lines = lines_of(df, key, source, text, [batch])
    lines.write.partitionBy("batch").parquet(f"{path}/lines")
    index = LineIndex(spark, f"{path}/index", key, source, text, rule)
    # as many as there are periods
    for b in sorted(str(r[0]) for r in spark.read.schema(lines.schema).parquet(f"{path}/lines").select("batch").distinct().collect()):
        index.add_lines(f"{path}/lines/batch={b}")
    return index


def found_in(df: DataFrame, key: str, source: str, at: str, text: str, rule: Rule = Rule()) -> DataFrame:
    """(key, line_no) of every repeated line of a table."""
    index = index_of(df, key, source, at, text, rule)
    return df.select(F.col(key), F.lit(0).alias("line_no")).limit(0) if index.lines() is None else index.occurrences()


def cleaned(df: DataFrame, key: str, source: str, at: str, text: str, rule: Rule = Rule()) -> DataFrame:
    """(key, text) of every document that holds a repeated line, without those lines."""
    lines = index_of(df, key, source, at, text, rule).repeated()
    return df.select(key, text).limit(0) if lines is None else rebuild(df, key, source, text, lines)
