"""Queries of the join, aggregation, ranking and set operators over whole tables.

The dimension tables (registry, aliases) are joined without a hint: the planner broadcasts them by their size.
Several distinct counts are made by grouping to (key, member) first, so no row is expanded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.functions import text as X
from newsloom.session import table


def _t(spark: SparkSession, d: str, name: str, *cols: str) -> DataFrame:
    df = table(spark, d, name)
    return (df.select(*cols) if cols else df).distinct()


def _links(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "article_event_links", "article_id", "event_id", "link_type", "created_at")


def _articles(spark: SparkSession, d: str, *cols: str) -> DataFrame:
    return _t(spark, d, "news_articles", "article_id", *cols)


def _events(spark: SparkSession, d: str, *cols: str) -> DataFrame:
    return _t(spark, d, "news_events", "event_id", *cols)


def _entities(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "event_entity_links", "id", "event_id", "entity_type", "entity_id", "entity_name", "relevance_score", "mapping_confidence", "mapping_reason")


def first_of(df: DataFrame, keys: list[str], order: list[Column], k: int = 1) -> DataFrame:
    """The first k rows of each key; the planner cuts each task's share before the shuffle."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("_rn") <= k)


# joins


def c1_articles_by_source(spark: SparkSession, d: str) -> DataFrame:
    a = _articles(spark, d, "source_id").join(table(spark, d, "source_registry").select("source_id", "lane", "trust_tier"), "source_id")
    return a.groupBy("lane", "trust_tier").agg(F.count("*").alias("n_articles"))


def c2_event_entities(spark: SparkSession, d: str) -> DataFrame:
    j = _events(spark, d, "event_type").join(_entities(spark, d), "event_id")
    return j.groupBy("event_type", "entity_type").agg(F.count("*").alias("n_links"), F.count_if(F.col("relevance_score") > 0.5).alias("n_strong"))


def c3_links_articles_sources(spark: SparkSession, d: str) -> DataFrame:
    j = _links(spark, d).join(_articles(spark, d, "source_id"), "article_id").join(table(spark, d, "source_registry").select("source_id", "lane", "trust_tier"), "source_id", "left")
    return j.select("article_id", "event_id", F.coalesce("lane", F.lit("")).alias("lane"), F.coalesce("trust_tier", F.lit(3)).alias("trust_tier"))


def c4_links_without_event(spark: SparkSession, d: str) -> DataFrame:
    e = _events(spark, d, "event_title").withColumn("there", F.lit(True))
    return _entities(spark, d).join(e, "event_id", "left").groupBy("entity_type", F.coalesce("there", F.lit(False)).alias("event_exists")).agg(F.count("*").alias("n"))


def c5_event_names(spark: SparkSession, d: str) -> DataFrame:
    n = _entities(spark, d).groupBy("event_id").agg(F.array_join(F.sort_array(F.collect_set("entity_name")), ";").alias("names"))
    return _events(spark, d).join(n, "event_id", "left").select("event_id", F.coalesce("names", F.lit("")).alias("names"))


def c6_latest_link(spark: SparkSession, d: str) -> DataFrame:
    e = _entities(spark, d)
    last = e.groupBy("event_id").agg(F.max("id").alias("id"))
    return e.join(last.select("id"), "id", "left_semi").select("id", "event_id", "entity_type")


def c7_orphan_events(spark: SparkSession, d: str) -> DataFrame:
    return _events(spark, d).join(_links(spark, d).select("event_id"), "event_id", "left_anti")


def c8_unlinked_articles(spark: SparkSession, d: str) -> DataFrame:
    return _articles(spark, d, "source_id").join(_links(spark, d).select("article_id"), "article_id", "left_anti").groupBy("source_id").agg(F.count("*").alias("n"))


def c12_event_overlap(spark: SparkSession, d: str) -> DataFrame:
    """For each event the other event that shares most of its articles, if one alone does: explode and equi-join on
    the article, count, best tuple, no winner on a tie.  An article belongs to a few events, so the join stays small."""
    link = _links(spark, d).select("event_id", "article_id").distinct()
    pairs = link.join(link.withColumnRenamed("event_id", "other_id"), "article_id").filter("event_id <> other_id").groupBy("event_id", "other_id").agg(F.count("*").alias("overlap"))
    sizes = link.groupBy(F.col("event_id").alias("other_id")).agg(F.count("*").alias("n"))
    best = pairs.join(sizes, "other_id").withColumn("coverage", F.floor(F.col("overlap") / F.col("n") * 10000 + 0.5) / 10000)
    top = best.groupBy("event_id").agg(F.max(F.struct("overlap", "coverage")).alias("top"))
    won = best.join(top, "event_id").filter((F.col("overlap") == F.col("top.overlap")) & (F.col("coverage") == F.col("top.coverage")))
    return won.groupBy("event_id").agg(F.count("*").alias("_n"), F.min("other_id").alias("other_id"), F.max("overlap").alias("overlap"), F.max("coverage").alias("coverage")).filter("_n = 1").drop("_n")


def c14_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Sources of the clock table and whether the registry knows them, compared by normalised key."""
    known = table(spark, d, "source_registry").select(X.lookup_key(F.col("source_id")).alias("k")).distinct().withColumn("covered", F.lit(True))
    return table(spark, d, "source_clock").select("source_id", X.lookup_key(F.col("source_id")).alias("k")).join(known, "k", "left").select("source_id", F.coalesce("covered", F.lit(False)).alias("covered"))


def c15_asof(spark: SparkSession, d: str) -> DataFrame:
    """Extension: for each link the latest entity link of its event made at or before it; one pass over the union.

    An event is cut into days, so that a hot one is no single task: within a day the last one before is found by order, and what a day begins
    with comes from a table of one row an event and day."""
    probe = _links(spark, d).select("event_id", F.col("created_at").alias("t"), "article_id", F.lit(None).cast("bigint").alias("id"), F.lit(1).alias("side"))
    build = _t(spark, d, "event_entity_links", "event_id", "created_at", "id").groupBy("event_id", F.col("created_at").alias("t")).agg(F.max("id").alias("id"))
    both = probe.unionByName(build.select("event_id", "t", F.lit(None).cast("string").alias("article_id"), "id", F.lit(0).alias("side"))).withColumn("day", F.to_date("t"))
    within = Window.partitionBy("event_id", "day").orderBy("t", "side").rowsBetween(Window.unboundedPreceding, 0)
    days = both.groupBy("event_id", "day").agg(F.max_by("id", F.when(F.col("id").isNotNull(), F.col("t"))).alias("last"))
    earlier = Window.partitionBy("event_id").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    days = days.select("event_id", "day", F.last("last", ignorenulls=True).over(earlier).alias("before")).filter("before is not null")
    found = both.withColumn("same", F.last("id", ignorenulls=True).over(within)).filter("side = 1")
    return found.join(days, ["event_id", "day"], "left").select("article_id", "event_id", F.coalesce("same", "before").alias("entity_link_id"))


# aggregations


def e2_event_span(spark: SparkSession, d: str) -> DataFrame:
    j = _links(spark, d).join(_articles(spark, d, "collected_at"), "article_id")
    return j.groupBy("event_id").agg(F.unix_seconds(F.min("collected_at")).alias("first_seen"), F.unix_seconds(F.max("collected_at")).alias("last_seen"), F.count("*").alias("n_articles"))


def family(source: Column, declared: Column) -> Column:
    """The declared family, or the source as a family of its own."""
    return F.coalesce(F.nullif(F.trim(declared), F.lit("")), F.concat(F.lit("source:"), source))


def e4_evidence(spark: SparkSession, d: str) -> DataFrame:
    """Distinct families in the confirmation lane, distinct sources in the signal lane, their sum and the families of both."""
    reg = table(spark, d, "source_registry").select("source_id", "lane", family(F.col("source_id"), F.col("source_family")).alias("family"))
    j = _links(spark, d).join(_articles(spark, d, "source_id"), "article_id").join(reg, "source_id")
    per = j.groupBy("event_id", "lane", "family", "source_id").agg(F.count("*").alias("n"))
    fam = per.groupBy("event_id", "family").agg(F.max((F.col("lane") == "confirmation").cast("int")).alias("c"), F.max((F.col("lane") == "signal").cast("int")).alias("s"), F.count_if(F.col("lane") == "signal").alias("signals"), F.sum("n").alias("n"))
    out = fam.groupBy("event_id").agg(F.sum("n").alias("article_count"), F.sum("c").alias("confirmation_count"), F.sum("signals").alias("signal_count"), F.sum(F.col("c") + F.col("s")).alias("independent_evidence_count"), F.count("*").alias("source_family_count"))
    return out


def e3_source_mix(spark: SparkSession, d: str) -> DataFrame:
    j = _links(spark, d).join(_articles(spark, d, "source_id"), "article_id").join(table(spark, d, "source_registry").select("source_id", "lane"), "source_id")
    n = j.select("event_id", "lane", "source_id").distinct().groupBy("event_id", "lane").agg(F.count("*").alias("n"))
    mix = n.groupBy("event_id").agg(F.array_sort(F.collect_list(F.struct("lane", "n"))).alias("m"))
    return mix.select("event_id", F.array_join(F.transform("m", lambda x: F.concat(x["lane"], F.lit("="), x["n"].cast("string"))), ",").alias("source_mix"))


def e6_representative(spark: SparkSession, d: str) -> DataFrame:
    """Arg-max of (confirmation lane, lower tier, shorter title); ties go to the smaller id."""
    reg = table(spark, d, "source_registry").select("source_id", "lane", "trust_tier")
    j = _links(spark, d).join(_articles(spark, d, "source_id", "title"), "article_id").join(reg, "source_id")
    rank = F.struct((F.col("lane") != "confirmation").cast("int"), "trust_tier", F.length("title"), "article_id")
    return j.groupBy("event_id").agg(F.min_by("article_id", rank).alias("representative"), F.min_by("title", rank).alias("event_title"))


def e7_titles(spark: SparkSession, d: str) -> DataFrame:
    j = _links(spark, d).join(_articles(spark, d, "title", "collected_at"), "article_id")
    rows = F.sort_array(F.collect_list(F.struct("collected_at", "article_id", "title")), asc=False)
    g = j.groupBy("event_id").agg(F.transform(rows, lambda x: x["title"]).alias("t"))
    return g.select("event_id", F.sha2(F.array_join("t", " "), 256).alias("titles_digest"), F.size("t").alias("n"))


def e8_updates(spark: SparkSession, d: str) -> DataFrame:
    """Distinct updates of an event by their signature, newest first, at most five, and how many there are."""
    from newsloom.operators.classify import update_signature

    j = _links(spark, d).join(_articles(spark, d, "title", "collected_at"), "article_id").withColumn("signature", update_signature(F.col("title"))).filter("signature <> ''")
    newest = [F.col("collected_at").desc(), F.col("article_id")]
    once = first_of(j, ["event_id", "signature"], newest).drop("_rn")
    count = once.groupBy("event_id").agg(F.count("*").alias("n_updates"))
    return first_of(once, ["event_id"], newest, 5).join(count, "event_id").select("event_id", F.col("_rn").alias("update_no"), "signature", "article_id", "n_updates")


def e9_article_sets(spark: SparkSession, d: str) -> DataFrame:
    return _links(spark, d).groupBy("event_id").agg(F.array_join(F.sort_array(F.collect_set("article_id")), ",").alias("article_ids"))


def e10_source_health(spark: SparkSession, d: str) -> DataFrame:
    at = F.lit("2026-03-01 00:00:00").cast("timestamp")
    recent = (F.col("collected_at") >= at - F.expr("INTERVAL 24 HOURS")) & (F.col("collected_at") < at)
    return _articles(spark, d, "source_id", "collected_at").groupBy("source_id").agg(F.count_if(recent).alias("articles_24h"), F.unix_seconds(F.max(F.when(F.col("collected_at") < at, F.col("collected_at")))).alias("last_article"))


def e11_rolling_quota(spark: SparkSession, d: str) -> DataFrame:
    """Actions of a user in the 24 hours up to each; range window over seconds."""
    w = Window.partitionBy("user_id").orderBy("s").rangeBetween(-86400, 0)
    e = table(spark, d, "events").select("event_id", "user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("us")).withColumn("s", F.floor(F.col("us") / 1000000))
    return e.withColumn("runs_24h", F.count("*").over(w)).groupBy("user_id").agg(F.max("runs_24h").alias("max_runs"), F.count_if(F.col("runs_24h") > 3).alias("over_quota"))


def e12_status_summary(spark: SparkSession, d: str) -> DataFrame:
    """Latest row of each user by (time, id), rolled up by status."""
    e = table(spark, d, "events").groupBy("user_id").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("latest"))
    return e.groupBy("latest").agg(F.count("*").alias("n_users"))


def e13_day_panel(spark: SparkSession, d: str) -> DataFrame:
    """Day by entity: events, confirmed events, best score, distinct topics and a histogram of states."""
    ev = _events(spark, d, "created_at", "event_state", "topic_key", "event_rank_score")
    link = _entities(spark, d).filter(F.col("entity_type") == "company").select("event_id", "entity_id").distinct()
    base = ev.join(link, "event_id").withColumn("day", F.date_format("created_at", "yyyy-MM-dd"))
    states = base.groupBy("day", "entity_id", "event_state").agg(F.count("*").alias("n"), F.max("event_rank_score").alias("best"), F.collect_set("topic_key").alias("topics"))
    return states.groupBy("day", "entity_id").agg(
        F.sum("n").alias("event_count"),
        F.sum(F.when(F.col("event_state") == "confirmed", F.col("n")).otherwise(0)).alias("confirmed_count"),
        F.max("best").alias("max_rank"),
        F.size(F.array_distinct(F.flatten(F.collect_list("topics")))).alias("topic_count"),
        F.array_join(F.array_sort(F.collect_list(F.concat(F.coalesce("event_state", F.lit("-")), F.lit(":"), F.col("n").cast("string")))), ",").alias("state_mix"),
    )


def e14_mixes(spark: SparkSession, d: str) -> DataFrame:
    return _events(spark, d, "event_type", "event_state", "novelty_state").groupBy("event_type", "event_state", "novelty_state").agg(F.count("*").alias("n"))


def e15_top_industries(spark: SparkSession, d: str) -> DataFrame:
    g = _events(spark, d, "primary_industry").filter("primary_industry is not null").groupBy("primary_industry").agg(F.count("*").alias("n"))
    return g.orderBy(F.col("n").desc(), "primary_industry").limit(3)


def e16_industry_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Per industry the number of events and the sum of the three best scores."""
    e = _events(spark, d, "primary_industry", "event_rank_score").filter("primary_industry is not null")
    top = first_of(e.filter("event_rank_score is not null"), ["primary_industry"], [F.col("event_rank_score").desc(), F.col("event_id")], 3).groupBy("primary_industry").agg(F.sum(F.floor(F.col("event_rank_score") * 100 + 0.5)).alias("top3_cents"))
    return e.groupBy("primary_industry").agg(F.count("*").alias("event_count")).join(top, "primary_industry", "left").select("primary_industry", "event_count", "top3_cents")


def e17_registry_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "source_registry").groupBy("lane", "phase1_disposition", "scheduler_class").agg(F.count("*").alias("n"))


def e18_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Extension: rollup of links by entity type and reason."""
    e = _entities(spark, d).select("id", F.coalesce("entity_type", F.lit("?")).alias("entity_type"), F.coalesce("mapping_reason", F.lit("?")).alias("mapping_reason"))
    return e.rollup("entity_type", "mapping_reason").agg(F.count("*").alias("n"), F.grouping_id().cast("bigint").alias("level"))


def e21_listagg(spark: SparkSession, d: str) -> DataFrame:
    e = _entities(spark, d).filter("entity_name is not null")
    return e.groupBy("entity_type", "entity_id").agg(F.array_join(F.sort_array(F.collect_set("entity_name")), "|").alias("spellings"), F.count("*").alias("n"))


# rankings


def f1_evidence_order(spark: SparkSession, d: str) -> DataFrame:
    """Articles of an event: min-max freshness in the event, first article of each family before the repeats."""
    reg = table(spark, d, "source_registry").select("source_id", "trust_tier", family(F.col("source_id"), F.col("source_family")).alias("family"))
    j = _links(spark, d).join(_articles(spark, d, "source_id", "title", "collected_at"), "article_id").join(reg, "source_id").withColumn("s", F.unix_seconds("collected_at"))
    span = j.groupBy("event_id").agg(F.min("s").alias("lo"), F.max("s").alias("hi"))
    j = j.join(span, "event_id").withColumn("fresh", F.when(F.col("hi") > F.col("lo"), F.floor((F.col("s") - F.col("lo")) * 1000 / (F.col("hi") - F.col("lo")))).otherwise(1000))
    j = j.withColumn("specific", (F.col("title").rlike("[0-9]").cast("int") + (F.length("title") >= 18).cast("int")))
    key = [F.col("trust_tier"), F.col("specific").desc(), F.col("fresh").desc(), F.col("article_id")]
    # of one family at most the first five repeats can be among the five; the rest is let go before the shuffle
    some = first_of(j, ["event_id", "family"], key, 6).withColumn("repeat", (F.col("_rn") > 1).cast("int"))
    placed = first_of(some.drop("_rn"), ["event_id"], [F.col("repeat"), *key], 5)
    return placed.select("event_id", F.col("_rn").alias("place"), "article_id", "fresh")


def f4_event_rank(spark: SparkSession, d: str) -> DataFrame:
    order = [F.col("score").desc(), F.col("last_seen_at").desc(), F.col("event_id")]
    e = _events(spark, d, "event_type", "event_rank_score", "last_seen_at").withColumn("score", F.coalesce("event_rank_score", F.lit(-1.0)))
    return first_of(e, ["event_type"], order, 10).select("event_type", F.col("_rn").alias("place"), "event_id", "score")


def f5_first_occurrence(spark: SparkSession, d: str) -> DataFrame:
    """Walk the events of a type by rank and keep each article where it occurs first."""
    e = _events(spark, d, "event_type", "event_rank_score").withColumn("score", F.coalesce("event_rank_score", F.lit(-1.0)))
    j = _links(spark, d).select("event_id", "article_id").join(e, "event_id")
    return j.groupBy("event_type", "article_id").agg(F.min_by("event_id", F.struct(-F.col("score"), F.col("event_id"))).alias("event_id"))


def f7_topic_slices(spark: SparkSession, d: str) -> DataFrame:
    """Topics of each industry by number of events, six of them, with their four best events."""
    e = _events(spark, d, "primary_industry", "topic_key", "event_rank_score").filter("primary_industry is not null and topic_key is not null").withColumn("score", F.coalesce("event_rank_score", F.lit(-1.0)))
    n = e.groupBy("primary_industry", "topic_key").agg(F.count("*").alias("n"), F.max("score").alias("best"))
    top = first_of(n, ["primary_industry"], [F.col("n").desc(), F.col("best").desc(), F.col("topic_key")], 6).select("primary_industry", "topic_key", F.col("_rn").alias("topic_place"))
    return first_of(e.join(top, ["primary_industry", "topic_key"]), ["primary_industry", "topic_key"], [F.col("score").desc(), F.col("event_id")], 4).select("primary_industry", "topic_key", "topic_place", F.col("_rn").alias("place"), "event_id")


def f15_top_events(spark: SparkSession, d: str) -> DataFrame:
    e = _events(spark, d, "event_rank_score", "last_seen_at").filter("event_rank_score is not null")
    return e.orderBy(F.col("event_rank_score").desc(), F.col("last_seen_at").desc(), F.col("event_id").desc()).limit(10).select("event_id", "event_rank_score")


def f16_entity_lists(spark: SparkSession, d: str) -> DataFrame:
    e = _entities(spark, d).filter("relevance_score is not null and entity_name is not null")
    rows = F.array_sort(F.collect_list(F.struct((-F.col("relevance_score")).alias("r"), F.col("entity_name").alias("n"), F.col("id").alias("i"))))
    return e.groupBy("event_id", "entity_type").agg(F.array_join(F.transform(rows, lambda x: x["n"]), ";").alias("names"))


def f17_low_confidence(spark: SparkSession, d: str) -> DataFrame:
    e = _entities(spark, d).filter((F.col("mapping_confidence") > 0) & (F.col("mapping_confidence") < 0.7))
    return e.orderBy("mapping_confidence", "id").limit(100).select("id", "entity_name", F.col("mapping_confidence").alias("confidence"))


def f20_query_index(spark: SparkSession, d: str) -> DataFrame:
    """Normalised term to entity, first wins: companies before institutions, industries, themes."""
    kinds = {"company": 0, "institution": 1, "industry": 2, "macro_theme": 3}
    order = F.create_map(*[F.lit(x) for kv in kinds.items() for x in kv])
    e = _entities(spark, d).select(X.lookup_key(F.col("entity_name")).alias("term"), "entity_type", "entity_id").filter("term <> '' and entity_type is not null and entity_id is not null").distinct()
    return e.groupBy("term").agg(F.min(F.struct(F.try_element_at(order, F.col("entity_type")), "entity_type", "entity_id")).alias("m")).select("term", "m.entity_type", "m.entity_id")


# set operations and keyed state


def x1_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Merge of the links made before 2026 with those made later, keyed by article: counts of inserted, updated, kept."""
    from newsloom.operators.state import merge_rows

    links = _links(spark, d).groupBy("article_id", F.when(F.col("created_at") < "2026-01-01", "old").otherwise("new").alias("part")).agg(F.max("event_id").alias("event_id"))
    old, new = (links.filter(F.col("part") == p).drop("part") for p in ("old", "new"))
    return merge_rows(old, new, ["article_id"]).groupBy("change").agg(F.count("*").alias("n"), F.count_if(F.col("event_id").isNull()).alias("n_null"))


def x2_first_wins(spark: SparkSession, d: str) -> DataFrame:
    a = _articles(spark, d, "title", "collected_at").withColumn("key", X.title_key(F.col("title")))
    return a.groupBy("key").agg(F.min_by("article_id", F.struct("collected_at", "article_id")).alias("article_id"))


def x3_last_wins(spark: SparkSession, d: str) -> DataFrame:
    a = _articles(spark, d, "canonical_url", "collected_at").filter("canonical_url is not null")
    return a.groupBy("canonical_url").agg(F.max_by("article_id", F.struct("collected_at", "article_id")).alias("article_id"), F.unix_seconds(F.min("collected_at")).alias("first_at"))


def x4_duplicate_tiers(spark: SparkSession, d: str) -> DataFrame:
    """What each article repeats of its source's earlier ones: same hash, else same canonical URL, else same URL where it is
    another, else same title at the same published time; which tier and the newest such article."""
    from newsloom.operators.state import duplicate_tiers

    a = _articles(spark, d, "source_id", "content_hash", "canonical_url", "url", "title_norm", "published_at", "collected_at")
    tiers = {"content_hash": ["content_hash"], "canonical_url": ["canonical_url"], "url": ["url"], "title_time": ["title_norm", "published_at"]}
    return duplicate_tiers(a, "article_id", "source_id", "collected_at", tiers, {"url": ~F.col("url").eqNullSafe(F.col("canonical_url"))})


def x6_set_ops(spark: SparkSession, d: str) -> DataFrame:
    arts = _articles(spark, d).select(X.lookup_key(F.col("article_id")).alias("k"))
    links = _links(spark, d).select(X.lookup_key(F.col("article_id")).alias("k"))
    count = lambda df, op: df.agg(F.count("*").alias("n")).select(F.lit(op).alias("op"), "n")
    return count(arts.union(links).distinct(), "union").union(count(arts.intersect(links), "intersect")).union(count(arts.subtract(links), "except")).union(count(arts.unionAll(links), "union_all"))


def x7_demoted_links(spark: SparkSession, d: str) -> DataFrame:
    """Slice-safe reset: links of touched articles go, other primary links of touched events become supporting."""
    touched = _articles(spark, d, "source_id").filter(F.col("source_id").endswith("_markets")).select("article_id")
    links = _links(spark, d)
    events = links.join(touched, "article_id", "left_semi").select("event_id").distinct().withColumn("hit", F.lit(True))
    kept = links.join(touched, "article_id", "left_anti").join(events, "event_id", "left")
    return kept.select("article_id", "event_id", F.when(F.col("hit") & (F.col("link_type") == "primary"), "supporting").otherwise(F.col("link_type")).alias("link_type"))


QUERIES = {k: f for k, f in globals().items() if k[0] in "cefx" and k[1:2].isdigit()}

_L = "(SELECT DISTINCT article_id, event_id, link_type, created_at FROM article_event_links) l"
_A = "(SELECT DISTINCT article_id, source_id, title, collected_at FROM news_articles) a"
_E = "(SELECT DISTINCT id, event_id, entity_type, entity_id, entity_name, relevance_score, mapping_confidence, mapping_reason FROM event_entity_links) x"
_V = "(SELECT DISTINCT ON (event_id) * FROM news_events) e"
_SK = r"substr(trim(regexp_replace(regexp_replace(lower(trim(regexp_replace(title, '[\s\pZ]+', ' ', 'g'))), '[0-9]{1,4}(?:[./:-][0-9]{1,2})+', ' ', 'g'), '[^\pL\pN_]+', ' ', 'g')), 1, 80)"
_FAM = "coalesce(nullif(trim(source_family), ''), 'source:'||source_id)"
_LK = r"regexp_replace(lower({c}), '[^\pL\pN]+', '', 'g')"
_SK_ALL = r"trim(regexp_replace(regexp_replace(lower(trim(regexp_replace(title, '[\s\pZ]+', ' ', 'g'))), '[0-9]{1,4}(?:[./:-][0-9]{1,2})+', ' ', 'g'), '[^\pL\pN_]+', ' ', 'g'))"
ORACLE = {
    "c1_articles_by_source": f"SELECT lane, trust_tier, count(*) n_articles FROM {_A} JOIN source_registry USING (source_id) GROUP BY ALL",
    "c2_event_entities": f"SELECT event_type, entity_type, count(*) n_links, count(*) FILTER (relevance_score > 0.5) n_strong FROM {_V} JOIN {_E} USING (event_id) GROUP BY ALL",
    "c3_links_articles_sources": f"SELECT article_id, event_id, coalesce(lane,'') lane, coalesce(trust_tier,3) trust_tier FROM {_L} JOIN {_A} USING (article_id) LEFT JOIN source_registry USING (source_id)",
    "c4_links_without_event": f"SELECT entity_type, e.event_id IS NOT NULL event_exists, count(*) n FROM {_E} LEFT JOIN {_V} ON e.event_id = x.event_id GROUP BY ALL",
    "c5_event_names": f"SELECT e.event_id, coalesce(string_agg(DISTINCT entity_name, ';' ORDER BY entity_name), '') names FROM {_V} LEFT JOIN {_E} ON e.event_id = x.event_id GROUP BY 1",
    "c6_latest_link": f"SELECT id, event_id, entity_type FROM {_E} WHERE id IN (SELECT max(id) FROM event_entity_links GROUP BY event_id)",
    "c7_orphan_events": f"SELECT event_id FROM {_V} ANTI JOIN article_event_links USING (event_id)",
    "c8_unlinked_articles": f"SELECT source_id, count(*) n FROM {_A} ANTI JOIN article_event_links USING (article_id) GROUP BY 1",
    "c12_event_overlap": """WITH l AS (SELECT DISTINCT event_id, article_id FROM article_event_links),
      p AS (SELECT a.event_id, b.event_id other_id, count(*) overlap FROM l a JOIN l b ON a.article_id = b.article_id AND a.event_id <> b.event_id GROUP BY ALL),
      s AS (SELECT event_id other_id, count(*) n FROM l GROUP BY 1), b AS (SELECT p.*, floor(overlap / n * 10000 + 0.5) / 10000 coverage FROM p JOIN s USING (other_id)),
      r AS (SELECT *, rank() OVER (PARTITION BY event_id ORDER BY overlap DESC, coverage DESC) k FROM b)
      SELECT event_id, min(other_id) other_id, max(overlap) overlap, max(coverage) coverage FROM r WHERE k = 1 GROUP BY 1 HAVING count(*) = 1""",
    "c14_coverage": f"SELECT source_id, {_LK.format(c='source_id')} IN (SELECT {_LK.format(c='source_id')} FROM source_registry) covered FROM source_clock",
    "c15_asof": f"""SELECT l.article_id, l.event_id, b.id entity_link_id FROM {_L}
      ASOF LEFT JOIN (SELECT event_id, created_at, max(id) id FROM event_entity_links GROUP BY 1, 2) b ON l.event_id = b.event_id AND l.created_at >= b.created_at""",
    "e2_event_span": f"SELECT event_id, epoch(min(collected_at))::BIGINT first_seen, epoch(max(collected_at))::BIGINT last_seen, count(*) n_articles FROM {_L} JOIN {_A} USING (article_id) GROUP BY 1",
    "e3_source_mix": f"SELECT event_id, string_agg(lane||'='||n, ',' ORDER BY lane) source_mix FROM (SELECT event_id, lane, count(DISTINCT source_id) n FROM {_L} JOIN {_A} USING (article_id) JOIN source_registry USING (source_id) GROUP BY ALL) GROUP BY 1",
    "e4_evidence": f"""SELECT event_id, count(*) article_count, count(DISTINCT f) FILTER (lane='confirmation') confirmation_count, count(DISTINCT source_id) FILTER (lane='signal') signal_count,
      count(DISTINCT f) FILTER (lane='confirmation') + count(DISTINCT f) FILTER (lane='signal') independent_evidence_count, count(DISTINCT f) source_family_count
      FROM {_L} JOIN {_A} USING (article_id) JOIN (SELECT *, {_FAM} f FROM source_registry) USING (source_id) GROUP BY 1""",
    "e6_representative": f"SELECT event_id, article_id representative, title event_title FROM (SELECT l.event_id, article_id, title, row_number() OVER (PARTITION BY event_id ORDER BY (lane <> 'confirmation')::INT, trust_tier, length(title), article_id) k FROM {_L} JOIN {_A} USING (article_id) JOIN source_registry USING (source_id)) WHERE k = 1",
    "e7_titles": f"SELECT event_id, sha256(string_agg(title, ' ' ORDER BY collected_at DESC, article_id DESC)) titles_digest, count(*)::INT n FROM {_L} JOIN {_A} USING (article_id) GROUP BY 1",
    "e8_updates": f"""WITH w AS (SELECT DISTINCT article_id, collected_at, {_SK_ALL} sk, list_filter(string_split(substr({_SK_ALL},1,400), ' '), lambda w: regexp_matches(w, '[0-9]') OR (length(w) > 1 AND NOT regexp_full_match(w, '[a-z]{{1,3}}'))) t FROM news_articles),
      g AS (SELECT article_id, collected_at, CASE WHEN len(list_distinct(t)) >= 3 THEN array_to_string(list_sort(list_transform(list_sort(list_transform(list_distinct(t), lambda x: {{'p': list_position(t, x), 'x': x}}))[1:12], lambda s: s.x)), ' ') ELSE substr(sk,1,80) END signature FROM w),
      o AS (SELECT event_id, article_id, collected_at, signature FROM {_L} JOIN g USING (article_id) WHERE signature <> '' QUALIFY row_number() OVER (PARTITION BY event_id, signature ORDER BY collected_at DESC, article_id) = 1)
      SELECT event_id, row_number() OVER (PARTITION BY event_id ORDER BY collected_at DESC, article_id)::INT update_no, signature, article_id, count(*) OVER (PARTITION BY event_id) n_updates FROM o QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY collected_at DESC, article_id) <= 5""",
    "e9_article_sets": f"SELECT event_id, string_agg(DISTINCT article_id, ',' ORDER BY article_id) article_ids FROM {_L} GROUP BY 1",
    "e10_source_health": f"SELECT source_id, count(*) FILTER (collected_at >= TIMESTAMPTZ '2026-02-28 00:00:00+00' AND collected_at < TIMESTAMPTZ '2026-03-01 00:00:00+00') articles_24h, epoch(max(collected_at) FILTER (collected_at < TIMESTAMPTZ '2026-03-01 00:00:00+00'))::BIGINT last_article FROM {_A} GROUP BY 1",
    "e11_rolling_quota": "SELECT user_id, max(r) max_runs, count(*) FILTER (r > 3) over_quota FROM (SELECT user_id, count(*) OVER (PARTITION BY user_id ORDER BY floor(epoch_us(ts)/1000000)::BIGINT RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW) r FROM events) GROUP BY 1",
    "e12_status_summary": "SELECT latest, count(*) n_users FROM (SELECT user_id, event_type latest FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) k FROM events) WHERE k = 1) GROUP BY 1",
    "e13_day_panel": f"""WITH b AS (SELECT e.*, k.entity_id ent, strftime(created_at AT TIME ZONE 'UTC', '%Y-%m-%d') AS d FROM {_V} JOIN (SELECT DISTINCT event_id, entity_id FROM event_entity_links WHERE entity_type='company') k USING (event_id)),
      s AS (SELECT d, ent, event_state, count(*) n FROM b GROUP BY ALL), m AS (SELECT d, ent, string_agg(coalesce(event_state,'-')||':'||n, ',' ORDER BY coalesce(event_state,'-')||':'||n) state_mix FROM s GROUP BY ALL)
      SELECT b.d AS "day", b.ent entity_id, count(*) event_count, count(*) FILTER (event_state='confirmed') confirmed_count, max(event_rank_score) max_rank, count(DISTINCT topic_key)::INT topic_count, any_value(state_mix) state_mix FROM b JOIN m ON b.d = m.d AND b.ent IS NOT DISTINCT FROM m.ent GROUP BY b.d, b.ent""",
    "e14_mixes": f"SELECT event_type, event_state, novelty_state, count(*) n FROM {_V} GROUP BY ALL",
    "e15_top_industries": f"SELECT primary_industry, count(*) n FROM {_V} WHERE primary_industry IS NOT NULL GROUP BY 1 ORDER BY n DESC, 1 LIMIT 3",
    "e16_industry_rollup": f"SELECT primary_industry, count(*) event_count, sum(floor(event_rank_score*100+0.5)) FILTER (k <= 3 AND event_rank_score IS NOT NULL)::BIGINT top3_cents FROM (SELECT *, row_number() OVER (PARTITION BY primary_industry ORDER BY event_rank_score DESC NULLS LAST, event_id) k FROM {_V} WHERE primary_industry IS NOT NULL) GROUP BY 1",
    "e17_registry_counts": "SELECT lane, phase1_disposition, scheduler_class, count(*) n FROM source_registry GROUP BY ALL",
    "e18_rollup": f"SELECT entity_type, mapping_reason, count(*) n, grouping_id(entity_type, mapping_reason)::BIGINT AS \"level\" FROM (SELECT coalesce(entity_type,'?') entity_type, coalesce(mapping_reason,'?') mapping_reason FROM {_E}) GROUP BY ROLLUP (entity_type, mapping_reason)",
    "e21_listagg": f"SELECT entity_type, entity_id, string_agg(DISTINCT entity_name, '|' ORDER BY entity_name) spellings, count(*) n FROM {_E} WHERE entity_name IS NOT NULL GROUP BY ALL",
    "f1_evidence_order": f"""WITH j AS (SELECT l.event_id, article_id, title, trust_tier, {_FAM} f, epoch(collected_at)::BIGINT s FROM {_L} JOIN {_A} USING (article_id) JOIN source_registry USING (source_id)),
      k AS (SELECT *, CASE WHEN max(s) OVER w > min(s) OVER w THEN floor((s - min(s) OVER w) * 1000 / (max(s) OVER w - min(s) OVER w))::BIGINT ELSE 1000 END fresh, regexp_matches(title,'[0-9]')::INT + (length(title) >= 18)::INT sp FROM j WINDOW w AS (PARTITION BY event_id)),
      r AS (SELECT *, (row_number() OVER (PARTITION BY event_id, f ORDER BY trust_tier, sp DESC, fresh DESC, article_id) > 1)::INT rep FROM k)
      SELECT event_id, place::INT place, article_id, fresh FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY rep, trust_tier, sp DESC, fresh DESC, article_id) place FROM r) WHERE place <= 5""",
    "f4_event_rank": f"SELECT event_type, k::INT place, event_id, score FROM (SELECT event_type, event_id, coalesce(event_rank_score,-1.0) score, row_number() OVER (PARTITION BY event_type ORDER BY coalesce(event_rank_score,-1.0) DESC, last_seen_at DESC NULLS LAST, event_id) k FROM {_V}) WHERE k <= 10",
    "f5_first_occurrence": f"SELECT event_type, article_id, event_id FROM (SELECT event_type, article_id, event_id, row_number() OVER (PARTITION BY event_type, article_id ORDER BY coalesce(event_rank_score,-1.0) DESC, event_id) k FROM {_L} JOIN {_V} USING (event_id)) WHERE k = 1",
    "f7_topic_slices": f"""WITH b AS (SELECT *, coalesce(event_rank_score,-1.0) score FROM {_V} WHERE primary_industry IS NOT NULL AND topic_key IS NOT NULL),
      n AS (SELECT primary_industry, topic_key, row_number() OVER (PARTITION BY primary_industry ORDER BY count(*) DESC, max(score) DESC, topic_key) k FROM b GROUP BY 1, 2)
      SELECT primary_industry, topic_key, k::INT topic_place, r::INT place, event_id FROM (SELECT b.*, n.k, row_number() OVER (PARTITION BY primary_industry, topic_key ORDER BY score DESC, event_id) r FROM b JOIN n USING (primary_industry, topic_key) WHERE n.k <= 6) WHERE r <= 4""",
    "f15_top_events": f"SELECT event_id, event_rank_score FROM {_V} WHERE event_rank_score IS NOT NULL ORDER BY event_rank_score DESC, last_seen_at DESC NULLS LAST, event_id DESC LIMIT 10",
    "f16_entity_lists": f"SELECT event_id, entity_type, string_agg(entity_name, ';' ORDER BY relevance_score DESC, entity_name, id) names FROM {_E} WHERE relevance_score IS NOT NULL AND entity_name IS NOT NULL GROUP BY ALL",
    "f17_low_confidence": f"SELECT id, entity_name, mapping_confidence confidence FROM {_E} WHERE mapping_confidence > 0 AND mapping_confidence < 0.7 ORDER BY mapping_confidence, id LIMIT 100",
    "f20_query_index": f"SELECT term, entity_type, entity_id FROM (SELECT {_LK.format(c='entity_name')} term, entity_type, entity_id, row_number() OVER (PARTITION BY {_LK.format(c='entity_name')} ORDER BY CASE entity_type WHEN 'company' THEN 0 WHEN 'institution' THEN 1 WHEN 'industry' THEN 2 ELSE 3 END, entity_type, entity_id) k FROM {_E} WHERE entity_type IS NOT NULL AND entity_id IS NOT NULL) WHERE k = 1 AND term <> ''",
    "x1_upsert": """WITH l AS (SELECT article_id, created_at < TIMESTAMPTZ '2026-01-01 00:00:00+00' o, max(event_id) event_id FROM article_event_links GROUP BY 1, 2)
      SELECT CASE WHEN a.article_id IS NULL THEN 'inserted' WHEN b.article_id IS NULL THEN 'kept' WHEN a.event_id IS NOT DISTINCT FROM b.event_id THEN 'same' ELSE 'updated' END "change", count(*) n, 0::BIGINT n_null
      FROM (SELECT * FROM l WHERE o) a FULL JOIN (SELECT * FROM l WHERE NOT o) b USING (article_id) GROUP BY 1""",
    "x2_first_wins": r"SELECT key, article_id FROM (SELECT lower(trim(regexp_replace(title, '[\s\pZ]+', ' ', 'g'))) AS key, article_id, row_number() OVER (PARTITION BY lower(trim(regexp_replace(title, '[\s\pZ]+', ' ', 'g'))) ORDER BY collected_at, article_id) k FROM " + _A + ") WHERE k = 1",
    "x3_last_wins": "SELECT canonical_url, max_by(article_id, (collected_at, article_id)) article_id, epoch(min(collected_at))::BIGINT first_at FROM news_articles WHERE canonical_url IS NOT NULL GROUP BY 1",
    "x4_duplicate_tiers": """WITH a AS (SELECT DISTINCT article_id, source_id, nullif(trim(content_hash), '') content_hash, nullif(trim(canonical_url), '') canonical_url, nullif(trim(url), '') url, nullif(trim(title_norm), '') title_norm, nullif(trim(published_at), '') published_at, collected_at FROM news_articles WHERE source_id IS NOT NULL),
      m AS (SELECT x.article_id, y.article_id existing_id, y.collected_at, CASE WHEN x.content_hash = y.content_hash THEN 1 WHEN x.canonical_url = y.canonical_url THEN 2 WHEN x.url = y.url AND x.url IS DISTINCT FROM x.canonical_url THEN 3 ELSE 4 END tier
        FROM a x JOIN a y ON x.source_id = y.source_id AND (y.collected_at, y.article_id) < (x.collected_at, x.article_id)
         AND (x.content_hash = y.content_hash OR x.canonical_url = y.canonical_url OR (x.url = y.url AND x.url IS DISTINCT FROM x.canonical_url) OR (x.title_norm = y.title_norm AND x.published_at = y.published_at)))
      SELECT article_id, ['content_hash','canonical_url','url','title_time'][tier] tier, existing_id FROM m QUALIFY row_number() OVER (PARTITION BY article_id ORDER BY tier, collected_at DESC, existing_id DESC) = 1""",
    "x6_set_ops": f"""WITH a AS (SELECT {_LK.format(c='article_id')} k FROM {_A}), b AS (SELECT {_LK.format(c='article_id')} k FROM {_L})
      SELECT 'union' op, count(*) n FROM (FROM a UNION FROM b) UNION ALL SELECT 'intersect', count(*) FROM (FROM a INTERSECT FROM b) UNION ALL SELECT 'except', count(*) FROM (FROM a EXCEPT FROM b) UNION ALL SELECT 'union_all', count(*) FROM (FROM a UNION ALL FROM b)""",
    "x7_demoted_links": f"""WITH t AS (SELECT article_id FROM {_A} WHERE ends_with(source_id, '_markets')), ev AS (SELECT DISTINCT event_id FROM article_event_links SEMI JOIN t USING (article_id))
      SELECT article_id, event_id, CASE WHEN link_type = 'primary' AND event_id IN (FROM ev) THEN 'supporting' ELSE link_type END link_type FROM {_L} ANTI JOIN t USING (article_id)""",
}
