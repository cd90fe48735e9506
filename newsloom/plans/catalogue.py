"""Further queries: scans with guards, target lists, lookups, headline extraction, hydration, constraints."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.functions import text as X
from newsloom.plans.relational import _articles, _entities, _events, _links, first_of
from newsloom.session import table


def a23_legacy_mapping(spark: SparkSession, d: str) -> DataFrame:
    """Articles of migrated sources under their legacy key."""
    m = table(spark, d, "source_registry").filter(F.col("legacy_key").isNotNull() & F.col("phase1_disposition").isin("migrate_phase1", "compat_keep")).select("source_id", "legacy_key")
    return _articles(spark, d, "source_id").join(m, "source_id").groupBy("legacy_key").agg(F.count("*").alias("n_articles"))


def a24_days(spark: SparkSession, d: str) -> DataFrame:
    """Days from the first to the last event of each type, those without one included."""
    e = table(spark, d, "events").select("event_type", F.to_date("ts").alias("day"))
    per = e.groupBy("event_type", "day").agg(F.count("*").alias("n"))
    span = per.groupBy("event_type").agg(F.min("day").alias("lo"), F.max("day").alias("hi")).select("event_type", F.explode(F.sequence("lo", "hi")).alias("day"))
    return span.join(per, ["event_type", "day"], "left").select("event_type", F.col("day").cast("string").alias("day"), F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))


def guarded(df: DataFrame, most: int) -> DataFrame:
    """Admission control: refuses a scan of more than ``most`` rows before anything is written; looks at one row more."""
    if df.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} rows selected")
    return df


def a25_guarded_scan(spark: SparkSession, d: str) -> DataFrame:
    a = _articles(spark, d, "source_id", "collected_at").filter((F.col("collected_at") >= "2026-01-01") & (F.col("collected_at") < "2026-01-08"))
    j = guarded(a, 50_000_000).join(table(spark, d, "source_registry").select("source_id", "lane"), "source_id")
    return j.select("article_id", "lane", F.unix_seconds("collected_at").alias("collected"))


def a28_targets(spark: SparkSession, d: str) -> DataFrame:
    """Explicit, then listed, then fed names; the first of equal names counts."""
    listed = table(spark, d, "entity_aliases_v1").filter("entity_type = 'company'").select(F.lit(1).alias("prio"), F.col("canonical_name").alias("name"))
    fed = _entities(spark, d).filter("entity_type = 'company' and entity_name is not null").select(F.lit(2).alias("prio"), F.col("entity_name").alias("name"))
    both = listed.unionByName(fed).distinct().withColumn("key", X.company_key(X.squeeze(F.col("name")))).filter("key <> ''")
    return both.groupBy("key").agg(F.min(F.struct("prio", "name")).alias("m")).select("key", "m.prio", "m.name")


def c13_first_hit(spark: SparkSession, d: str) -> DataFrame:
    """Hash lookup by normalised key: the first term that hits, id before name."""
    idx = table(spark, d, "entity_aliases_v1").select(X.lookup_key(F.col("alias")).alias("k"), "canonical_id").groupBy("k").agg(F.min("canonical_id").alias("canonical_id"))
    terms = _entities(spark, d).select("id", F.posexplode(F.array(F.replace("entity_id", F.lit("_"), F.lit(" ")), "entity_name")).alias("pos", "term"))
    hit = terms.select("id", "pos", X.lookup_key(F.col("term")).alias("k")).join(idx, "k")
    return hit.groupBy("id").agg(F.min_by("canonical_id", "pos").alias("canonical_id"), F.min("pos").alias("pos"))


def e5_official(spark: SparkSession, d: str) -> DataFrame:
    j = _links(spark, d).join(_articles(spark, d, "source_id"), "article_id")
    return j.groupBy("event_id").agg(F.bool_or(F.col("source_id").endswith("_filings")).alias("has_official"))


def e20_run_totals(spark: SparkSession, d: str) -> DataFrame:
    """Totals by collection day, with the share of each source's articles that are new to it by content."""
    a = _articles(spark, d, "source_id", "content_hash", "collected_at")
    first = a.groupBy("source_id", "content_hash").agg(F.min_by("article_id", F.struct("collected_at", "article_id")).alias("article_id")).select("article_id", F.lit(1).alias("fresh"))
    return a.join(first, "article_id", "left").groupBy(F.date_format("collected_at", "yyyy-MM").alias("month")).agg(F.count("*").alias("fetched"), F.sum(F.coalesce("fresh", F.lit(0))).alias("inserted"))


def f6_timeline(spark: SparkSession, d: str) -> DataFrame:
    link = _entities(spark, d).filter("entity_type = 'company'").select("entity_id", "event_id").distinct()
    e = _events(spark, d, "last_seen_at", "event_rank_score").filter("last_seen_at is not null")
    return first_of(link.join(e, "event_id"), ["entity_id"], [F.col("last_seen_at").desc(), F.col("event_id")], 12).select("entity_id", F.col("_rn").alias("place"), "event_id")


def f8_topic_index(spark: SparkSession, d: str) -> DataFrame:
    e = _events(spark, d, "topic_key", "event_rank_score").filter("topic_key is not null").withColumn("score", F.coalesce("event_rank_score", F.lit(-1.0)))
    return first_of(e, ["topic_key"], [F.col("score").desc(), F.col("event_id")], 8).select("topic_key", F.col("_rn").alias("place"), "event_id")


def f14_overlapping_lists(spark: SparkSession, d: str) -> DataFrame:
    """Each event in every list whose condition holds: one pass, an array of conditions and an explode."""
    e = _events(spark, d, "event_type", "event_state", "confirmation_count", "primary_entity", "source_family_count")
    lists = {"confirmed": F.col("event_state") == "confirmed", "with_entity": F.col("primary_entity").isNotNull(), "multi_family": F.col("source_family_count") > 1, "unconfirmed": F.coalesce("confirmation_count", F.lit(0)) == 0}
    names = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in lists.items()]))
    return e.select("event_id", F.explode(names).alias("list")).groupBy("list").agg(F.count("*").alias("n"))


def f18_hydrated(spark: SparkSession, d: str) -> DataFrame:
    """Events with their entities by type and number of articles, from pre-aggregated sides."""
    ent = _entities(spark, d).groupBy("event_id").agg(*[F.count_if(F.col("entity_type") == t).alias(f"n_{t}") for t in ("company", "institution", "industry", "macro_theme")])
    art = _links(spark, d).groupBy("event_id").agg(F.count("*").alias("n_links"), F.count_if(F.col("link_type") == "primary").alias("n_primary"))
    out = _events(spark, d).join(ent, "event_id", "left").join(art, "event_id", "left")
    return out.select("event_id", *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in out.columns if c != "event_id"])


def t8_calendar(spark: SparkSession, d: str) -> DataFrame:
    """ISO week, month and year starts and ends of event days."""
    day = F.col("day")
    e = table(spark, d, "events").select(F.to_date("ts").alias("day")).distinct()
    text = lambda c: c.cast("string")
    return e.select(text(day).alias("day"), text(F.to_date(F.date_trunc("week", day))).alias("week_start"), text(F.to_date(F.date_trunc("month", day))).alias("month_start"), text(F.add_months(F.date_trunc("month", day), 1)).alias("next_month"), F.weekofyear(day).cast("bigint").alias("iso_week"))


def x5_rejects(spark: SparkSession, d: str) -> DataFrame:
    """Rows that break a constraint, by constraint: domain, range, presence, uniqueness and reference."""
    e = _entities(spark, d)
    known = _events(spark, d).select("event_id", F.lit(True).alias("there"))
    dup = Window.partitionBy("event_id", "entity_type", "entity_id", "entity_name")
    e = e.join(known, "event_id", "left").withColumn("copies", F.count("*").over(dup))
    rules = {
        "type_domain": ~F.coalesce(F.col("entity_type").isin("company", "institution", "industry", "macro_theme"), F.lit(False)),
        "score_range": ~F.coalesce(F.col("relevance_score").between(0, 1), F.lit(True)),
        "confidence_missing": F.col("mapping_confidence").isNull(),
        "not_unique": F.col("copies") > 1,
        "event_missing": F.col("there").isNull(),
    }
    broken = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()]))
    return e.select("id", F.explode(broken).alias("rule")).groupBy("rule").agg(F.count("*").alias("n"))


def x8_stale_links(spark: SparkSession, d: str) -> DataFrame:
    """Links of processed articles to events that were not rebuilt, and what is left of each event."""
    processed = _articles(spark, d, "source_id").filter(F.col("source_id").endswith("_wire")).select("article_id")
    rebuilt = _events(spark, d, "event_type").filter("event_type = 'earnings'").select("event_id")
    links = _links(spark, d)
    stale = links.join(processed, "article_id", "left_semi").join(rebuilt, "event_id", "left_anti").select("article_id", "event_id")
    left = links.join(stale, ["article_id", "event_id"], "left_anti")
    return _events(spark, d).join(left.select("event_id"), "event_id", "left_anti").join(links.select("event_id"), "event_id", "left_semi")


def x10_entity_union(spark: SparkSession, d: str) -> DataFrame:
    """Kept manual links before built ones before those of the event itself; the first of equal (event, type, id) counts."""
    e = _entities(spark, d).filter("entity_id is not null and event_id is not null")
    src = e.select("event_id", "entity_type", "entity_id", F.when(F.col("mapping_reason") == "preserved_existing_link", 0).otherwise(1).alias("prio"))
    own = _events(spark, d, "primary_industry").filter("primary_industry is not null").select("event_id", F.lit("industry").alias("entity_type"), F.col("primary_industry").alias("entity_id"), F.lit(2).alias("prio"))
    return src.unionByName(own).groupBy("event_id", "entity_type", "entity_id").agg(F.min("prio").alias("prio")).groupBy("entity_type", "prio").agg(F.count("*").alias("n"))


def x12_schema_evolution(spark: SparkSession, d: str) -> DataFrame:
    """An older and a newer schema read as one: absent columns get their default."""
    old = _links(spark, d).filter("link_type = 'primary'").select("article_id", "event_id")
    new = _links(spark, d).filter("link_type <> 'primary'").select("article_id", "event_id", "link_type")
    both = old.unionByName(new, allowMissingColumns=True).fillna({"link_type": "unset"})
    return both.groupBy("link_type").agg(F.count("*").alias("n"))


QUERIES = {k: f for k, f in globals().items() if k[0] in "abcdefxt" and k[1:2].isdigit()}

_L = "(SELECT DISTINCT article_id, event_id, link_type, created_at FROM article_event_links) l"
_A = "(SELECT DISTINCT article_id, source_id, content_hash, collected_at FROM news_articles) a"
_E = "(SELECT DISTINCT id, event_id, entity_type, entity_id, entity_name, relevance_score, mapping_confidence, mapping_reason FROM event_entity_links) x"
_V = "(SELECT DISTINCT ON (event_id) * FROM news_events) e"
_LK = r"regexp_replace(lower({c}), '[^\pL\pN]+', '', 'g')"
_CK = r"lower(regexp_replace(regexp_replace(trim(regexp_replace(name, '[\s\pZ]+', ' ', 'g')), '(?:有限责任公司|股份有限公司|有限公司|集团|股份|Inc|Ltd|Corp|Group|Holdings|PLC)', '', 'g'), '[\s_,.-]+', '', 'g'))"
ORACLE = {
    "a23_legacy_mapping": f"SELECT legacy_key, count(*) n_articles FROM {_A} JOIN source_registry USING (source_id) WHERE legacy_key IS NOT NULL AND phase1_disposition IN ('migrate_phase1','compat_keep') GROUP BY 1",
    "a24_days": "WITH p AS (SELECT event_type, ts::DATE dd, count(*) n FROM events GROUP BY ALL), s AS (SELECT event_type, unnest(generate_series(min(dd), max(dd), INTERVAL 1 DAY))::DATE dd FROM p GROUP BY 1) SELECT event_type, dd::VARCHAR AS \"day\", coalesce(n, 0) n FROM s LEFT JOIN p USING (event_type, dd)",
    "a25_guarded_scan": f"SELECT article_id, lane, epoch(collected_at)::BIGINT collected FROM {_A} JOIN source_registry USING (source_id) WHERE collected_at >= TIMESTAMPTZ '2026-01-01 00:00:00+00' AND collected_at < TIMESTAMPTZ '2026-01-08 00:00:00+00'",
    "a28_targets": f"""SELECT key, prio, name FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY prio, name) k FROM (SELECT prio, name, {_CK} AS key FROM (SELECT DISTINCT 1 prio, canonical_name name FROM entity_aliases_v1 WHERE entity_type='company'
      UNION SELECT DISTINCT 2, entity_name FROM event_entity_links WHERE entity_type='company' AND entity_name IS NOT NULL))) WHERE k = 1 AND key <> ''""",
    "c13_first_hit": f"""WITH i AS (SELECT {_LK.format(c='alias')} k, min(canonical_id) canonical_id FROM entity_aliases_v1 GROUP BY 1), t AS (SELECT id, 0 pos, {_LK.format(c="replace(entity_id,'_',' ')")} k FROM {_E} UNION ALL SELECT id, 1, {_LK.format(c='entity_name')} FROM {_E})
      SELECT id, arg_min(canonical_id, pos) canonical_id, min(pos) pos FROM t JOIN i USING (k) GROUP BY 1""",
    "e5_official": f"SELECT event_id, bool_or(ends_with(source_id, '_filings')) has_official FROM {_L} JOIN {_A} USING (article_id) GROUP BY 1",
    "e20_run_totals": f"SELECT strftime(collected_at AT TIME ZONE 'UTC', '%Y-%m') AS \"month\", count(*) fetched, count(*) FILTER (k = 1)::BIGINT inserted FROM (SELECT *, row_number() OVER (PARTITION BY source_id, content_hash ORDER BY collected_at, article_id) k FROM {_A}) GROUP BY 1",
    "f6_timeline": f"SELECT entity_id, k::INT place, event_id FROM (SELECT entity_id, event_id, row_number() OVER (PARTITION BY entity_id ORDER BY last_seen_at DESC, event_id) k FROM (SELECT DISTINCT entity_id, event_id FROM event_entity_links WHERE entity_type='company') JOIN {_V} USING (event_id) WHERE last_seen_at IS NOT NULL) WHERE k <= 12",
    "f8_topic_index": f"SELECT topic_key, k::INT place, event_id FROM (SELECT topic_key, event_id, row_number() OVER (PARTITION BY topic_key ORDER BY coalesce(event_rank_score,-1.0) DESC, event_id) k FROM {_V} WHERE topic_key IS NOT NULL) WHERE k <= 8",
    "f14_overlapping_lists": f"SELECT list, count(*) n FROM (SELECT unnest(list_filter([CASE WHEN event_state='confirmed' THEN 'confirmed' END, CASE WHEN primary_entity IS NOT NULL THEN 'with_entity' END, CASE WHEN source_family_count > 1 THEN 'multi_family' END, CASE WHEN coalesce(confirmation_count,0)=0 THEN 'unconfirmed' END], lambda z: z IS NOT NULL)) list FROM {_V}) GROUP BY 1",
    "f18_hydrated": f"""SELECT e.event_id, coalesce(n_company,0) n_company, coalesce(n_institution,0) n_institution, coalesce(n_industry,0) n_industry, coalesce(n_macro_theme,0) n_macro_theme, coalesce(n_links,0) n_links, coalesce(n_primary,0) n_primary FROM {_V}
      LEFT JOIN (SELECT event_id, count(*) FILTER (entity_type='company') n_company, count(*) FILTER (entity_type='institution') n_institution, count(*) FILTER (entity_type='industry') n_industry, count(*) FILTER (entity_type='macro_theme') n_macro_theme FROM {_E} GROUP BY 1) p USING (event_id)
      LEFT JOIN (SELECT event_id, count(*) n_links, count(*) FILTER (link_type='primary') n_primary FROM {_L} GROUP BY 1) q USING (event_id)""",
    "t8_calendar": "SELECT DISTINCT ts::DATE::VARCHAR AS \"day\", date_trunc('week', ts)::DATE::VARCHAR week_start, date_trunc('month', ts)::DATE::VARCHAR month_start, (date_trunc('month', ts) + INTERVAL 1 MONTH)::DATE::VARCHAR next_month, weekofyear(ts) iso_week FROM events",
    "x5_rejects": f"""SELECT rule, count(*) n FROM (SELECT unnest(list_filter([CASE WHEN coalesce(entity_type IN ('company','institution','industry','macro_theme'), false) = false THEN 'type_domain' END, CASE WHEN NOT coalesce(relevance_score BETWEEN 0 AND 1, true) THEN 'score_range' END,
      CASE WHEN mapping_confidence IS NULL THEN 'confidence_missing' END, CASE WHEN copies > 1 THEN 'not_unique' END, CASE WHEN gone THEN 'event_missing' END], lambda z: z IS NOT NULL)) rule
      FROM (SELECT x.*, count(*) OVER (PARTITION BY x.event_id, entity_type, entity_id, entity_name) copies, e.event_id IS NULL gone FROM {_E} LEFT JOIN {_V} ON x.event_id = e.event_id)) GROUP BY 1""",
    "x8_stale_links": f"""WITH s AS (SELECT l.article_id, l.event_id FROM {_L} SEMI JOIN (SELECT article_id FROM news_articles WHERE ends_with(source_id,'_wire')) USING (article_id) ANTI JOIN (SELECT event_id FROM news_events WHERE event_type='earnings') USING (event_id))
      SELECT e.event_id FROM {_V} SEMI JOIN article_event_links USING (event_id) ANTI JOIN (SELECT l.event_id FROM {_L} ANTI JOIN s USING (article_id, event_id)) r USING (event_id)""",
    "x10_entity_union": f"""SELECT entity_type, prio, count(*) n FROM (SELECT event_id, entity_type, entity_id, min(p)::INT prio FROM (SELECT event_id, entity_type, entity_id, CASE WHEN mapping_reason='preserved_existing_link' THEN 0 ELSE 1 END p FROM {_E} WHERE entity_id IS NOT NULL AND event_id IS NOT NULL
      UNION ALL SELECT event_id, 'industry', primary_industry, 2 FROM {_V} WHERE primary_industry IS NOT NULL) GROUP BY ALL) GROUP BY ALL""",
    "x12_schema_evolution": f"SELECT CASE WHEN link_type='primary' THEN 'unset' ELSE link_type END link_type, count(*) n FROM {_L} WHERE link_type IS NOT NULL GROUP BY 1",
}
