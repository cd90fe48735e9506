"""Views for consumers: recent events, hydrated events, briefs, retrieval profiles, related queries, topics, feed sections, manifest,
coverage and the state that survives a rebuild.

Lists in a row are bounded by a top-k whose share is cut before the shuffle; hot events never gather all their links.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions import text as X
from newsloom.operators import extract
from newsloom.plans.entities import admitted_aliases
from newsloom.plans.relational import _articles, _entities, _events, _links, first_of
from newsloom.session import table

AS_OF = "2026-03-01 00:00:00"


@dataclass(frozen=True)
class Policy:
    """How long events stay in the views: all for ``hours``, those in ``state`` for ``persistent_hours`` if one threshold holds."""

    hours: int = 72
    persistent_hours: int = 336
    state: str = "mature"
    rank: float = 60.0
    articles: int = 3
    evidence: int = 2
    platforms: int = 1


def recent_events(events: DataFrame, as_of: str, policy: Policy = Policy()) -> DataFrame:
    now = F.lit(as_of).cast("timestamp")
    seen = F.col("last_seen_at")
    back = lambda h: F.timestamp_add("HOUR", F.lit(-h), now)
    least = [("event_rank_score", policy.rank), ("article_count_raw", policy.articles), ("independent_evidence_count", policy.evidence), ("signal_platform_count", policy.platforms)]
    strong = F.lit(False)
    for c, n in least:
        strong = strong | (F.coalesce(F.col(c), F.lit(0)) >= n)
    kept = (F.col("event_state") == policy.state) & (seen >= back(policy.persistent_hours)) & strong
    return events.filter((F.coalesce("opportunity_state", F.lit("unreviewed")) != "rejected") & (F.coalesce(seen >= back(policy.hours), F.lit(False)) | F.coalesce(kept, F.lit(False))))


_FIELDS = ["event_title", "event_type", "event_state", "novelty_state", "opportunity_state", "topic_key", "last_seen_at", "first_seen_at", "event_rank_score", "article_count_raw", "independent_evidence_count", "source_family_count",
           "signal_platform_count", "confirmation_count", "calibrated_confirmation", "uncertainty", "primary_industry", "primary_entity"]
SCORES = ["market_significance", "entity_impact", "entity_local_priority", "confirmation", "novelty", "researchability", "coverage_independent", "coverage_residual", "urgency", "uncertainty"]


def _recent(spark: SparkSession, d: str) -> DataFrame:
    # a map column cannot be compared, so repeated rows are told by their key
    e = table(spark, d, "news_events").select("event_id", *_FIELDS, "score_vector", "event_rank_flags").dropDuplicates(["event_id"])
    return recent_events(e, AS_OF)


def a26_recent_events(spark: SparkSession, d: str) -> DataFrame:
    return _recent(spark, d).select("event_id", "event_state", "event_rank_score", F.unix_seconds("last_seen_at").alias("last_seen"))


def by_rank() -> list[Column]:
    """Highest ranked first, then last seen, then by id."""
    return [F.col(c).desc_nulls_last() for c in ("event_rank_score", "last_seen_at", "event_id")]


def top_list(df: DataFrame, keys: list[str], order: list[Column], value: str, k: int, out: str) -> DataFrame:
    """keys and ``out``: the first k values of each key in order, as an array."""
    top = first_of(df, keys, order, k)
    return top.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("_rn", F.col(value).alias("v")))), lambda x: x["v"]).alias(out))


def f18_hydrated(spark: SparkSession, d: str) -> DataFrame:
    """Events with the ordered names of their entities by type (20 each) and their newest five articles, in order."""
    e = _events(spark, d, "event_title")
    named = _entities(spark, d).filter("entity_type is not null and entity_name is not null")
    by = top_list(named, ["event_id", "entity_type"], [F.col("relevance_score").desc_nulls_last(), F.col("entity_name"), F.col("id")], "entity_name", 20, "names")
    types = by.groupBy("event_id").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "entity_type", F.array_join("names", ";")))), "|").alias("entities"))
    arts = _links(spark, d).select("event_id", "article_id").distinct().join(_articles(spark, d, "collected_at"), "article_id")
    five = top_list(arts, ["event_id"], [F.col("collected_at").desc_nulls_last(), F.col("article_id")], "article_id", 5, "ids")
    return e.join(types, "event_id", "left").join(five.select("event_id", F.array_join("ids", "|").alias("articles")), "event_id", "left")


def f19_event_brief(spark: SparkSession, d: str) -> DataFrame:
    """One flat row an event: fields, scores to three places, flags."""
    score = [F.round(F.col(f"score_vector.{s}"), 3).alias(f"score_{s}") for s in SCORES]
    rest = [F.round(F.col(c), 3).alias(c) for c in ("event_rank_score", "calibrated_confirmation", "uncertainty")]
    flags = [F.round("event_rank_flags.penalty", 3).alias("penalty"), F.col("event_rank_flags.micro_event_protected").alias("protected"), F.col("event_rank_flags.macro_coverage_capped").alias("capped")]
    plain = ["event_id", "event_title", "event_type", "event_state", "novelty_state", "opportunity_state", "topic_key", "article_count_raw", "independent_evidence_count", "source_family_count", "signal_platform_count", "confirmation_count", "primary_industry", "primary_entity"]
    return _recent(spark, d).select(*plain, F.unix_seconds("first_seen_at").alias("first_seen"), F.unix_seconds("last_seen_at").alias("last_seen"), *rest, *score, *flags)


def profiles(entities: DataFrame, events: DataFrame, aliases: DataFrame, entity_type: str, k: int = 10) -> DataFrame:
    """entity_id, entity_name, n_events, latest, top (ids of the k highest events, in order), terms: what an entity is looked up by.

    Firms' names are cleaned and must have a firm's shape; their id is that of the alias list where it knows the name."""
    e = entities.filter(F.col("entity_type") == entity_type).select("event_id", "entity_id", "entity_name")
    listed = admitted_aliases(aliases).filter(F.col("entity_type") == entity_type)
    if entity_type == "company":
        e = e.withColumn("entity_name", extract.clean_candidate(F.col("entity_name"))).filter(extract.looks_like_company(F.col("entity_name")))
        e = e.withColumn("look", X.lookup_key(F.col("entity_name"))).join(listed.select("look", "canonical_id"), "look", "left")
        e = e.withColumn("entity_id", F.coalesce("canonical_id", "entity_id")).drop("look", "canonical_id")
    e = e.filter("entity_id is not null and entity_name is not null").distinct().join(events.select("event_id", "event_rank_score", "last_seen_at"), "event_id")
    keys = ["entity_id", "entity_name"]
    counted = e.groupBy(*keys).agg(F.count("*").alias("n_events"), F.max("last_seen_at").alias("latest"))
    names = listed.groupBy(F.col("canonical_id").alias("entity_id")).agg(F.collect_set("alias").alias("_a"))
    none = F.array().cast("array<string>")
    out = counted.join(top_list(e, keys, by_rank(), "event_id", k, "top"), keys).join(names, "entity_id", "left")
    return out.select(*keys, "n_events", "latest", "top", F.array_sort(F.array_distinct(F.concat(F.array(*keys), F.coalesce("_a", none)))).alias("terms"))


def _profiles(spark: SparkSession, d: str, kind: str) -> DataFrame:
    return profiles(_entities(spark, d), _events(spark, d, "event_rank_score", "last_seen_at"), table(spark, d, "entity_aliases_v1"), kind)


def f10_entity_index(spark: SparkSession, d: str) -> DataFrame:
    out = None
    for kind in ("company", "industry", "institution"):
        p = _profiles(spark, d, kind).select(F.lit(kind).alias("entity_type"), "entity_id", "entity_name", "n_events", F.unix_seconds("latest").alias("latest_seen"), F.array_join("top", "|").alias("top_events"), F.array_join("terms", "|").alias("lookup_terms"))
        out = p if out is None else out.unionByName(p)
    return out


def f11_related_queries(spark: SparkSession, d: str) -> DataFrame:
    """Up to twelve queries an institution leads to: its name, id and spellings, then industry and topic of its first eight events; of
    queries that differ in letter case only the first stays."""
    p = _profiles(spark, d, "institution")
    own = p.select("entity_id", "entity_name", F.posexplode(F.concat(F.array("entity_name", "entity_id"), F.array_except("terms", F.array("entity_name", "entity_id")))).alias("pos", "query"))
    own = own.select("entity_id", "entity_name", F.col("pos").alias("p"), F.lit(0).alias("q"), "query", F.when(F.col("pos") == 0, "canonical_name").when(F.col("pos") == 1, "canonical_id").otherwise("alias").alias("reason"))
    ev = p.select("entity_id", "entity_name", F.posexplode(F.slice("top", 1, 8)).alias("pos", "event_id")).join(_events(spark, d, "primary_industry", "topic_key"), "event_id")
    far = ev.select("entity_id", "entity_name", (F.col("pos") + 100_000).alias("p"), F.inline(F.array(F.struct(F.lit(0).alias("q"), F.col("primary_industry").alias("query"), F.lit("primary_industry").alias("reason")), F.struct(F.lit(1).alias("q"), F.col("topic_key").alias("query"), F.lit("topic_key").alias("reason")))))
    every = own.unionByName(far).withColumn("query", F.trim("query")).filter("query <> ''")
    once = first_of(every, ["entity_id", "entity_name", F.lower("query")], [F.col("p"), F.col("q")]).drop("_rn")
    best = first_of(once, ["entity_id", "entity_name"], [F.col("p"), F.col("q")], 12)
    return best.select("entity_id", "entity_name", F.col("_rn").alias("position"), "query", "reason")


def f9_topic_profiles(spark: SparkSession, d: str) -> DataFrame:
    """The twenty topics of the highest ranked events: how many events, the six highest, and a label from the highest one."""
    e = _events(spark, d, "topic_key", "event_rank_score", "last_seen_at", "primary_entity", "primary_industry").filter("topic_key is not null")
    best = F.max(F.struct(F.coalesce("event_rank_score", F.lit(-1.0)).alias("r"), F.coalesce("last_seen_at", F.lit("1970-01-01").cast("timestamp")).alias("s"), "event_id", F.coalesce("primary_entity", "primary_industry", "topic_key").alias("label")))
    topics = e.groupBy("topic_key").agg(F.count("*").alias("n_events"), best.alias("b")).orderBy(F.col("b.r").desc(), "topic_key").limit(20)
    six = top_list(e, ["topic_key"], by_rank(), "event_id", 6, "top")
    return topics.join(six, "topic_key").select("topic_key", "b.label", "n_events", F.array_join("top", "|").alias("top_events"))


def f21_research_feed(spark: SparkSession, d: str) -> DataFrame:
    """The sections of the research document as rows: recent events, the ten most frequent entities of each type, topics."""
    recent = first_of(_recent(spark, d).withColumn("section", F.lit("recent_events")), ["section"], by_rank(), 50).select("section", F.col("_rn").alias("position"), F.col("event_id").alias("key"), F.col("event_title").alias("label"))
    named = _entities(spark, d).filter("entity_type in ('company', 'industry', 'institution') and entity_id is not null")
    n = named.select("entity_type", "entity_id", "event_id").distinct().groupBy("entity_type", "entity_id").agg(F.count("*").alias("n"))
    index = first_of(n, ["entity_type"], [F.col("n").desc(), F.col("entity_id")], 10).select(F.concat("entity_type", F.lit("_index")).alias("section"), F.col("_rn").alias("position"), F.col("entity_id").alias("key"), F.col("n").cast("string").alias("label"))
    t = _events(spark, d, "topic_key").filter("topic_key is not null").groupBy("topic_key").agg(F.count("*").alias("n")).withColumn("section", F.lit("topic_index"))
    topics = first_of(t, ["section"], [F.col("n").desc(), F.col("topic_key")], 20).select("section", F.col("_rn").alias("position"), F.col("topic_key").alias("key"), F.col("n").cast("string").alias("label"))
    return recent.unionByName(index).unionByName(topics)


def f22_manifest(spark: SparkSession, d: str) -> DataFrame:
    """One row on an export: how much is in it and from when."""
    e = _recent(spark, d).agg(F.count("*").alias("event_count"), F.min(F.unix_seconds("last_seen_at")).alias("oldest"), F.max(F.unix_seconds("last_seen_at")).alias("newest"))
    return e.select(F.lit(AS_OF).alias("as_of"), "event_count", "oldest", "newest", F.lit(72).alias("lookback_hours"), F.lit(336).alias("persistent_hours"))


def n_source_health(spark: SparkSession, d: str) -> DataFrame:
    """Health view: what each registered source delivered in the last seven days, and its state."""
    now = F.lit(AS_OF).cast("timestamp")
    a = _articles(spark, d, "source_id", "collected_at").filter((F.col("collected_at") < now) & (F.col("collected_at") >= F.timestamp_add("DAY", F.lit(-7), now)))
    n = a.groupBy("source_id").agg(F.count("*").alias("n_week"), F.max(F.unix_seconds("collected_at")).alias("last_at"))
    r = table(spark, d, "source_registry").select("source_id", "enabled").join(n, "source_id", "left")
    state = F.when(~F.col("enabled"), "other").when(F.col("n_week").isNull(), "down").when(F.col("n_week") < 3, "degraded").otherwise("ok")
    return r.select("source_id", F.coalesce("n_week", F.lit(0)).cast("bigint").alias("n_week"), F.coalesce("last_at", F.lit(0)).alias("last_at"), state.alias("status"))


def e18_coverage_audit(spark: SparkSession, d: str) -> DataFrame:
    """Totals of the sources: registered, with articles, silent, with a clock, unregistered ones that deliver or have a clock."""
    reg = table(spark, d, "source_registry").select("source_id").distinct()
    seen = table(spark, d, "news_articles").select("source_id").filter("source_id is not null").distinct()
    clock = table(spark, d, "source_clock").select("source_id").distinct()
    parts = {"registered": reg, "covered": reg.join(seen, "source_id", "left_semi"), "silent": reg.join(seen, "source_id", "left_anti"), "clocked": reg.join(clock, "source_id", "left_semi"),
             "unregistered_articles": seen.join(reg, "source_id", "left_anti"), "unregistered_clock": clock.join(reg, "source_id", "left_anti")}
    out = None
    for name, df in parts.items():
        one = df.agg(F.count("*").alias("n"), F.array_join(F.slice(F.array_sort(F.collect_list("source_id")), 1, 5), "|").alias("first_ids")).select(F.lit(name).alias("bucket"), "n", "first_ids")
        out = one if out is None else out.unionByName(one)
    return out


def carry_state(old: DataFrame, old_links: DataFrame, new: DataFrame, new_links: DataFrame, state: list[str]) -> DataFrame:
    """New events (event_id) with what is known of them: the state of the old event of the same id, else of the old event with which they share
    most articles (of several the smallest id), else nulls.  Pairs are counted per article link, so they are as many as links of shared articles."""
    kept = new.select("event_id").join(old.select("event_id", F.col("event_id").alias("from_id"), *state), "event_id")
    moved = new.select("event_id").join(kept.select("event_id"), "event_id", "left_anti")
    shared = new_links.join(moved, "event_id", "left_semi").select("event_id", "article_id").distinct().join(old_links.select(F.col("event_id").alias("from_id"), "article_id").distinct(), "article_id")
    best = shared.groupBy("event_id", "from_id").agg(F.count("*").alias("n")).groupBy("event_id").agg(F.min(F.struct(-F.col("n"), "from_id")).alias("m"))
    found = moved.join(best.select("event_id", "m.from_id"), "event_id", "left").join(old.select(F.col("event_id").alias("from_id"), *state), "from_id", "left")
    return kept.select("event_id", "from_id", *state).unionByName(found.select("event_id", "from_id", *state))


def x9_state_preservation(spark: SparkSession, d: str) -> DataFrame:
    """A rebuild that gives every event whose id ends in an even figure a new id: what state each one has afterwards."""
    old = _events(spark, d, "opportunity_state").withColumn("created", F.lit(1))
    links = _links(spark, d).select("event_id", "article_id").distinct()
    again = F.when(F.col("event_id").rlike("[02468]$"), F.concat(F.lit("re-"), F.col("event_id"))).otherwise(F.col("event_id"))
    new, new_links = old.select(again.alias("event_id")), links.select(again.alias("event_id"), "article_id")
    return carry_state(old, links, new, new_links, ["opportunity_state"])


QUERIES = {k: f for k, f in globals().items() if k[:1] in "aefnx" and (k[1:2].isdigit() or k == "n_source_health")}

_E = "(SELECT DISTINCT ON (event_id) * FROM news_events)"
_L = "(SELECT DISTINCT article_id, event_id FROM article_event_links)"
_N = "(SELECT DISTINCT id, event_id, entity_type, entity_id, entity_name, relevance_score FROM event_entity_links)"
_AS = "TIMESTAMPTZ '2026-03-01 00:00:00+00'"
_REC = f"""(SELECT * FROM {_E} WHERE coalesce(opportunity_state, 'unreviewed') <> 'rejected' AND (last_seen_at >= {_AS} - INTERVAL 72 HOUR OR (event_state = 'mature' AND last_seen_at >= {_AS} - INTERVAL 336 HOUR
  AND (coalesce(event_rank_score, 0) >= 60 OR coalesce(article_count_raw, 0) >= 3 OR coalesce(independent_evidence_count, 0) >= 2 OR coalesce(signal_platform_count, 0) >= 1))))"""
_RANK = "event_rank_score DESC NULLS LAST, last_seen_at DESC NULLS LAST, event_id DESC"
_SQUEEZE = r"trim(regexp_replace({c}, '[\s\pZ]+', ' ', 'g'))"
_LOOK = r"regexp_replace(lower({c}), '[^\pL\pN]+', '', 'g')"


def _profile_sql(kind: str) -> str:
    from newsloom.plans.entities import _ADMIT, _CAND, ORACLE

    shape = ORACLE["d5_looks_like_company"].split("SELECT DISTINCT entity_name, ")[1].split(" is_company FROM")[0].replace("regexp_full_match(q", "regexp_full_match(nm").replace("regexp_matches(q", "regexp_matches(nm")
    cand = _CAND.replace("title", "entity_name")
    if kind == "company":
        rows = f"(SELECT DISTINCT event_id, coalesce(canonical_id, entity_id) entity_id, nm entity_name FROM (SELECT *, {cand} nm FROM {_N} WHERE entity_type = 'company') LEFT JOIN (SELECT look, canonical_id FROM {_ADMIT} WHERE entity_type = 'company') ON look = {_LOOK.format(c='nm')} WHERE {shape})"
    else:
        rows = f"(SELECT DISTINCT event_id, entity_id, entity_name FROM {_N} WHERE entity_type = '{kind}')"
    return f"""SELECT '{kind}' entity_type, entity_id, entity_name, count(*) n_events, epoch(max(last_seen_at))::BIGINT latest_seen, array_to_string(list(event_id ORDER BY {_RANK})[1:10], '|') top_events, list(event_id ORDER BY {_RANK})[1:8] eight,
      array_to_string(list_sort(list_distinct([entity_id, entity_name] || coalesce(any_value(al), []))), '|') lookup_terms, list_sort(list_distinct(coalesce(any_value(al), []))) al
      FROM {rows} r JOIN {_E} USING (event_id) LEFT JOIN (SELECT canonical_id, list(alias) al FROM {_ADMIT} WHERE entity_type = '{kind}' GROUP BY 1) k ON k.canonical_id = r.entity_id WHERE entity_id IS NOT NULL AND entity_name IS NOT NULL GROUP BY entity_id, entity_name"""


def _oracles() -> dict[str, str]:
    cols = "event_id, event_title, event_type, event_state, novelty_state, opportunity_state, topic_key, article_count_raw, independent_evidence_count, source_family_count, signal_platform_count, confirmation_count, primary_industry, primary_entity"
    scores = ", ".join(f"round(score_vector.{s}, 3) score_{s}" for s in SCORES)
    return {
        "a26_recent_events": f"SELECT event_id, event_state, event_rank_score, epoch(last_seen_at)::BIGINT last_seen FROM {_REC}",
        "f18_hydrated": f"""SELECT event_id, event_title, entities, articles FROM {_E} e
          LEFT JOIN (SELECT event_id, array_to_string(list_sort(list(entity_type||'='||array_to_string(names, ';'))), '|') entities FROM (SELECT event_id, entity_type, list(entity_name ORDER BY relevance_score DESC NULLS LAST, entity_name, id)[1:20] names FROM {_N} WHERE entity_type IS NOT NULL AND entity_name IS NOT NULL GROUP BY ALL) GROUP BY 1) USING (event_id)
          LEFT JOIN (SELECT event_id, array_to_string(list(article_id ORDER BY collected_at DESC NULLS LAST, article_id)[1:5], '|') articles FROM {_L} JOIN (SELECT DISTINCT article_id, collected_at FROM news_articles) USING (article_id) GROUP BY 1) USING (event_id)""",
        "f19_event_brief": f"""SELECT {cols}, epoch(first_seen_at)::BIGINT first_seen, epoch(last_seen_at)::BIGINT last_seen, round(event_rank_score, 3) event_rank_score, round(calibrated_confirmation, 3) calibrated_confirmation, round(uncertainty, 3) uncertainty, {scores},
          round(event_rank_flags.penalty, 3) penalty, event_rank_flags.micro_event_protected "protected", event_rank_flags.macro_coverage_capped capped FROM {_REC}""",
        "f10_entity_index": " UNION ALL ".join(f"SELECT entity_type, entity_id, entity_name, n_events, latest_seen, top_events, lookup_terms FROM ({_profile_sql(k)})" for k in ("company", "industry", "institution")),
        "f11_related_queries": f"""WITH p AS ({_profile_sql('institution')}),
          c AS (SELECT entity_id, entity_name, 0 p, 0 q, entity_name AS "query", 'canonical_name' reason FROM p UNION ALL SELECT entity_id, entity_name, 1, 0, entity_id, 'canonical_id' FROM p
            UNION ALL SELECT entity_id, entity_name, 2 + i, 0, x, 'alias' FROM (SELECT entity_id, entity_name, unnest(o) x, generate_subscripts(o, 1) i FROM (SELECT *, list_filter(al, lambda y: y NOT IN (entity_id, entity_name)) o FROM p))
            UNION ALL SELECT x.entity_id, x.entity_name, 100000 + i, k, CASE k WHEN 0 THEN primary_industry ELSE topic_key END, CASE k WHEN 0 THEN 'primary_industry' ELSE 'topic_key' END FROM (SELECT entity_id, entity_name, unnest(eight) event_id, generate_subscripts(eight, 1) i FROM p) x JOIN {_E} USING (event_id), (SELECT unnest([0, 1]) k)),
          o AS (SELECT * FROM c WHERE trim("query") <> '' QUALIFY row_number() OVER (PARTITION BY entity_id, entity_name, lower(trim("query")) ORDER BY p, q) = 1)
          SELECT entity_id, entity_name, row_number() OVER (PARTITION BY entity_id, entity_name ORDER BY p, q)::INT AS "position", trim("query") AS "query", reason FROM o QUALIFY row_number() OVER (PARTITION BY entity_id, entity_name ORDER BY p, q) <= 12""",
        "f9_topic_profiles": f"""SELECT topic_key, arg_max(coalesce(primary_entity, primary_industry, topic_key), (coalesce(event_rank_score, -1), coalesce(last_seen_at, TIMESTAMPTZ '1970-01-01 00:00:00+00'), event_id)) label, count(*) n_events, array_to_string(list(event_id ORDER BY {_RANK})[1:6], '|') top_events
          FROM {_E} WHERE topic_key IS NOT NULL GROUP BY 1 ORDER BY max(coalesce(event_rank_score, -1)) DESC, topic_key LIMIT 20""",
        "f21_research_feed": f"""SELECT 'recent_events' AS "section", row_number() OVER (ORDER BY {_RANK})::INT AS "position", event_id AS "key", event_title AS label FROM {_REC} QUALIFY row_number() OVER (ORDER BY {_RANK}) <= 50
          UNION ALL SELECT entity_type||'_index', k::INT, entity_id, n::VARCHAR FROM (SELECT entity_type, entity_id, count(DISTINCT event_id) n, row_number() OVER (PARTITION BY entity_type ORDER BY count(DISTINCT event_id) DESC, entity_id) k FROM {_N} WHERE entity_type IN ('company', 'industry', 'institution') AND entity_id IS NOT NULL AND event_id IS NOT NULL GROUP BY 1, 2) WHERE k <= 10
          UNION ALL SELECT 'topic_index', k::INT, topic_key, n::VARCHAR FROM (SELECT topic_key, count(*) n, row_number() OVER (ORDER BY count(*) DESC, topic_key) k FROM {_E} WHERE topic_key IS NOT NULL GROUP BY 1) WHERE k <= 20""",
        "f22_manifest": f"SELECT '2026-03-01 00:00:00' as_of, count(*) event_count, min(epoch(last_seen_at)::BIGINT) oldest, max(epoch(last_seen_at)::BIGINT) newest, 72 lookback_hours, 336 persistent_hours FROM {_REC}",
        "n_source_health": f"""SELECT source_id, coalesce(n, 0) n_week, coalesce(last_at, 0) last_at, CASE WHEN NOT enabled THEN 'other' WHEN n IS NULL THEN 'down' WHEN n < 3 THEN 'degraded' ELSE 'ok' END status FROM source_registry
          LEFT JOIN (SELECT source_id, count(DISTINCT article_id) n, max(epoch(collected_at)::BIGINT) last_at FROM news_articles WHERE collected_at < {_AS} AND collected_at >= {_AS} - INTERVAL 7 DAY GROUP BY 1) USING (source_id)""",
        "e18_coverage_audit": """WITH s AS (SELECT DISTINCT source_id FROM news_articles WHERE source_id IS NOT NULL), b AS (SELECT 'registered' bucket, source_id FROM source_registry UNION ALL SELECT 'covered', source_id FROM source_registry SEMI JOIN s USING (source_id)
          UNION ALL SELECT 'silent', source_id FROM source_registry ANTI JOIN s USING (source_id) UNION ALL SELECT 'clocked', source_id FROM source_registry SEMI JOIN source_clock USING (source_id)
          UNION ALL SELECT 'unregistered_articles', source_id FROM s ANTI JOIN source_registry USING (source_id) UNION ALL SELECT 'unregistered_clock', source_id FROM source_clock ANTI JOIN source_registry USING (source_id))
          SELECT bucket, count(source_id) n, coalesce(array_to_string(list(source_id ORDER BY source_id) FILTER (source_id IS NOT NULL)[1:5], '|'), '') first_ids FROM (SELECT unnest(['registered','covered','silent','clocked','unregistered_articles','unregistered_clock']) bucket) LEFT JOIN b USING (bucket) GROUP BY 1""".replace("list(source_id ORDER BY source_id) FILTER (source_id IS NOT NULL)[1:5]", "(list(source_id ORDER BY source_id) FILTER (source_id IS NOT NULL))[1:5]"),
        "x9_state_preservation": f"""WITH n AS (SELECT event_id o, CASE WHEN regexp_matches(event_id, '[02468]$') THEN 're-'||event_id ELSE event_id END event_id FROM {_E}),
          nl AS (SELECT CASE WHEN regexp_matches(event_id, '[02468]$') THEN 're-'||event_id ELSE event_id END event_id, article_id FROM {_L}),
          best AS (SELECT nl.event_id, l.event_id from_id, count(DISTINCT article_id) c FROM nl JOIN {_L} l USING (article_id) GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY nl.event_id ORDER BY c DESC, l.event_id) = 1),
          f AS (SELECT n.event_id, CASE WHEN n.event_id = n.o THEN n.o ELSE from_id END from_id FROM n LEFT JOIN best USING (event_id))
          SELECT f.event_id, from_id, opportunity_state FROM f LEFT JOIN {_E} e ON e.event_id = from_id""",
    }


ORACLE = _oracles()
