"""Source registry and catalogue files, the nested JSON releases of macro data, and the JSON sink of views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns of a registry row and what stands for an absent one.
REGISTRY = {
    "source_id": None, "name": None, "lane": None, "source_family": "", "source_type": "", "trust_tier": 2, "coverage_scope": "mixed", "collector_owner": "shared",
    "scheduler_class": "daily", "origin_system": "", "legacy_key": "", "phase1_disposition": "defer", "enabled": True, "description": "",
}
LANES = ("confirmation", "signal")


def read_registry(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of a registry file, YAML or JSON; a row without id, name or a known lane is rejected."""
    text = "\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect())  # one small file
    try:
        import yaml

        data = yaml.safe_load(text)
    except ImportError:
        import json

        data = json.loads(text)
    rows = [tuple(s.get(k, s.get("id") if k == "source_id" else v) for k, v in REGISTRY.items()) for s in (data or {}).get("sources", [])]
    kinds = {"trust_tier": T.IntegerType(), "enabled": T.BooleanType()}
    df = spark.createDataFrame(rows, T.StructType([T.StructField(k, kinds.get(k, T.StringType())) for k in REGISTRY]))
    good = F.col("source_id").isNotNull() & F.col("name").isNotNull() & F.coalesce(F.col("lane").isin(*LANES), F.lit(False))
    return df.filter(good), df.filter(~good)


def merge_catalogue(registry: DataFrame, catalogue: DataFrame, blocked: list[str] | None = None) -> DataFrame:
    """Enabled, migrated and unblocked sources that the catalogue knows; catalogue fields override the registry's."""
    r = registry.filter(F.col("enabled") & F.col("phase1_disposition").isin("migrate_phase1", "compat_keep") & ~F.col("source_id").isin(blocked or []))
    both = [c for c in catalogue.columns if c in registry.columns and c != "source_id"]
    c = catalogue.select("source_id", *[F.col(x).alias(f"_c_{x}") for x in both], *[x for x in catalogue.columns if x not in registry.columns])
    j = r.join(c, "source_id")
    return j.select(*[F.coalesce(f"_c_{x}", x).alias(x) if x in both else F.col(x) for x in registry.columns], *[x for x in catalogue.columns if x not in registry.columns])


RELEASE = "generatedAt string, sourceId string, events array<struct<id string, createdAt string, primaryCategory string, sourceId string, sourceLabel string, textEn string, textZh string, url string, metadata struct<seriesId string, observationDate string, releaseDateApproximate boolean, value double, valueUnit string, consensus struct<actual double, forecast double, previous double, surprise double, unit string>>>>"


def release_items(payloads: DataFrame, column: str, since: str, until: str) -> DataFrame:
    """Articles of nested JSON releases with since <= created <= until, both inclusive."""
    e = payloads.select(F.explode(F.from_json(column, RELEASE)["events"]).alias("e")).select("e.*")
    t = F.try_to_timestamp("createdAt")
    m = "metadata.consensus"
    part = lambda label, c: F.when(F.col(c).isNotNull(), F.concat(F.lit(label), F.col(c).cast("string")))
    return e.filter((t >= F.lit(since).cast("timestamp")) & (t <= F.lit(until).cast("timestamp"))).select(
        F.concat(F.lit("rel_"), F.substring(F.sha2(F.concat_ws("|", "sourceId", "id"), 256), 1, 24)).alias("article_id"),
        F.coalesce("textEn", "textZh").alias("title"),
        F.concat_ws(" | ", "sourceLabel", part("actual ", f"{m}.actual"), part("forecast ", f"{m}.forecast"), part("previous ", f"{m}.previous")).alias("summary"),
        F.when(F.col("metadata.releaseDateApproximate"), "estimated").otherwise("exact").alias("timestamp_quality"),
        t.alias("published_at"),
    )


def write_view(df: DataFrame, root: str, name: str, run_at: str | None = None) -> list[str]:
    """A view as JSON: the latest version and, with ``run_at`` (yyyy-MM-ddTHH:mm:ss), a dated copy."""
    paths = [f"{root}/latest/{name}"]
    if run_at:
        day, clock = run_at.split("T")
        paths.append(f"{root}/{day.replace('-', '/')}/{clock.replace(':', '')}Z/{name}")
    for p in paths:
        df.write.mode("overwrite").json(p)
    return paths
