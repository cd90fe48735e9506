"""All queries of the core, by name, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from newsloom.plans import catalogue, cleaning, data_quality, entities, events, feeds, posts, relational, streams, views

MODULES = [data_quality, cleaning, relational, events, entities, feeds, posts, catalogue, views, streams]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracles() -> dict[str, str]:
    return {k: sql for m in MODULES for k, sql in m.ORACLE.items()}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queries()["e1_event_build"](spark, sf_dir)
