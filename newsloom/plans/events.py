"""Queries that build events from articles: entity lookup, classification, merge keys, grouping, replay windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions import text as X
from newsloom.operators import classify as C
from newsloom.operators.term_match import first_term
from newsloom.operators.windows import CADENCES, windowed
from newsloom.plans.relational import family
from newsloom.session import table


def _base(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "news_articles").select("article_id", "source_id", "title", "summary", "collected_at").distinct()
    reg = table(spark, d, "source_registry").select("source_id", "lane", "trust_tier", "coverage_scope", family(F.col("source_id"), F.col("source_family")).alias("family"))
    return a.join(reg, "source_id")


def d2_title_entity(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "news_articles").select("article_id", "title").distinct()
    return first_term(a, "article_id", "title", table(spark, d, "entity_aliases_v1"), "canonical_id", "alias", "entity")


def classified(spark: SparkSession, d: str) -> DataFrame:
    base = _base(spark, d)
    cols = base.columns
    terms = table(spark, d, "entity_aliases_v1")
    # the entity is a function of the title alone and is found in the same pass over the rows
    packed = base.withColumn("_row", F.struct(*cols))
    entity = first_term_rows(packed, "title", terms)
    return C.classify(entity)


def first_term_rows(df: DataFrame, text: str, terms: DataFrame) -> DataFrame:
    """The rows with a column ``entity``; the row travels through the lookup as one struct column."""
    keyed = df.select("_row", text)
    return first_term(keyed, "_row", text, terms, "canonical_id", "alias", "entity").select("_row.*", "entity")


def d1_classify(spark: SparkSession, d: str) -> DataFrame:
    return C.classify(_base(spark, d).withColumn("entity", F.lit(None).cast("string"))).select("article_id", "kind", "action", "industry", "theme")


def d8_context_signature(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "news_articles").select("article_id", "title").distinct()
    return a.select("article_id", C.context_signature(F.col("title")).alias("signature"))


def d12_source_family(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "source_registry").select("source_id", family(F.col("source_id"), F.col("source_family")).alias("family"))


def d13_ids(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "news_articles").select("article_id", "source_id", "title", "canonical_url").distinct()
    return a.select("article_id", X.hashed_id("art_", 24, F.col("source_id"), X.title_key(F.col("title")), F.coalesce("canonical_url", F.lit(""))).alias("derived_id"))


def e1_event_build(spark: SparkSession, d: str) -> DataFrame:
    """Flagship: articles merged into events by key, with evidence counted by independent families.

    One shuffle on (key, family), a second one on the key over rows already combined; metadata is the newest
    article's non-null value, field by field.
    """
    a = classified(spark, d)
    newest = F.struct("collected_at", "article_id")
    fam = a.groupBy("merge_key", "family").agg(
        F.count("*").alias("n"),
        F.max(F.when(F.col("lane") == "confirmation", 1).otherwise(0)).alias("c"),
        F.min("collected_at").alias("lo"),
        F.max("collected_at").alias("hi"),
        F.max(F.when(F.col("industry").isNotNull(), F.struct(newest.alias("o"), F.col("industry").alias("v")))).alias("industry"),
        F.max(F.struct(newest.alias("o"), F.struct("kind", "action").alias("v"))).alias("newest"),
        F.min(F.struct((F.col("lane") != "confirmation").cast("int").alias("l"), "trust_tier", F.length("title").alias("len"), "article_id", "title")).alias("rep"),
        F.max("entity").alias("entity"),
    )
    ev = fam.groupBy("merge_key").agg(
        F.sum("n").alias("article_count"), F.count("*").alias("family_count"), F.sum("c").alias("confirmation_count"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.max("industry").alias("industry"), F.max("newest").alias("newest"), F.min("rep").alias("rep"), F.max("entity").alias("entity"),
    )
    return ev.select(
        X.hashed_id("evt_", 24, F.col("merge_key")).alias("event_id"), F.col("newest.v.kind").alias("event_type"), F.col("newest.v.action").alias("action"), "entity", F.col("industry.v").alias("industry"),
        F.substring("rep.title", 1, 240).alias("event_title"), "article_count", "family_count", F.col("confirmation_count").cast("bigint").alias("confirmation_count"), F.unix_seconds("lo").alias("first_seen"), F.unix_seconds("hi").alias("last_seen"),
    )


def _replay(cadence: str):
    def query(spark: SparkSession, d: str) -> DataFrame:
        e = table(spark, d, "events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
        w = windowed(e, "ts", cadence, "2024-01-03", "2024-01-25")
        return w.groupBy("window_label", "window_start", "window_end", "event_type").agg(F.count("*").alias("n_events"))

    return query


def s9_snapshot_ids(spark: SparkSession, d: str) -> DataFrame:
    """Snapshots of users by week: id, as-of time (end of the window) and sorted id list."""
    e = table(spark, d, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    g = windowed(e, "ts", "week", "2024-01-03", "2024-01-25").groupBy("user_id", "window_label", "window_end").agg(F.array_join(F.transform(F.array_sort(F.collect_list("event_id")), lambda x: x.cast("string")), ",").alias("ids"))
    return g.select(X.hashed_id("snap_", 64, F.col("user_id").cast("string"), F.col("window_label")).alias("snapshot_id"), F.col("window_end").alias("as_of"), F.length("ids").alias("n_chars"))


def s3_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Extension: sessions of a user with gaps of less than six hours."""
    e = table(spark, d, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    g = e.groupBy("user_id", F.session_window("ts", "6 hours").alias("w")).agg(F.count("*").alias("n_events"))
    return g.select("user_id", F.unix_seconds("w.start").alias("session_start"), "n_events")


QUERIES = {k: f for k, f in globals().items() if k[:2] in ("d1", "d2", "d8", "e1", "s3", "s9")} | {f"s1_replay_{c}": _replay(c) for c in CADENCES}

_A = "(SELECT DISTINCT article_id, source_id, title, summary, collected_at FROM news_articles) a"
_SQ = r"trim(regexp_replace({c}, '[\s\pZ]+', ' ', 'g'))"
_COMBO = "lower(concat_ws(' ', " + _SQ.format(c="title") + ", coalesce(" + _SQ.format(c="summary") + ", ''), source_id))"
_FOCUS = "substr(trim(regexp_extract(" + _SQ.format(c="title") + ", '^([^。！？!?;；]*)', 1)), 1, 140)"
_SKEL = r"trim(regexp_replace(regexp_replace(lower(" + _SQ.format(c="title") + r"), '[0-9]{1,4}(?:[./:-][0-9]{1,2})+', ' ', 'g'), '[^\pL\pN_]+', ' ', 'g'))"
_TELLING = f"list_filter(string_split(substr({_SKEL},1,400),' '), lambda w: length(w) > 1 AND NOT regexp_full_match(w, '[a-z]{{1,3}}'))"
# the first of equal words is kept: its first position decides
_SIG = f"array_to_string(list_sort(list_filter({_TELLING}, lambda w, i: list_position({_TELLING}, w) = i)[1:4]), '-')"
# written out by hand and matched by a join: rank, event type, action, Latin words, Chinese parts
_VOCABULARY = """
  actions(rank, kind, "action", latin, han) AS (VALUES
    (1, 'earnings_guidance', 'earnings', 'profit margin margins slips loss outlook', '利润 毛利率 营收'), (2, 'contract_order', 'order', 'wins bid bids tender tenders', '中标 招标 签下'),
    (3, 'deal_mna', 'deal', 'venture stake joins spin', '合资 入股 加入 合作推进'), (4, 'production_supply', 'supply', 'expand restart delays complete output phase', '重启 扩建 推迟 完工 落地'),
    (5, 'regulation', 'regulation', 'clears fines fined inquiry recall permit', '罚款 核查 召回 许可'), (6, 'policy', 'policy', 'ministry council authority board monetary', '能源部 货币署 管理局 港务局'),
    (7, 'financing_capital', 'financing', 'loan credit lenders notes', '授信 债券 贷款'), (8, 'company_action', 'capital_return', 'dividend payout', '分红 股份回购'),
    (9, 'commodity_disruption', 'commodity', 'ore grain resin fuel', '矿石 粮食 树脂'), (10, 'macro_data', 'macro_release', 'statistics census survey', '统计局 调查'),
    (11, 'macro_data', 'macro_move', 'rates currency wages', '汇率 利率 工资'), (12, 'social_signal', 'signal', 'hearsay lol psa', '听说 据说')),
  sectors(rank, label, latin, han) AS (VALUES (1,'航空业','airlines','航空'),(2,'银行业','bank','银行'),(3,'电池','batteries','电池'),(4,'化学品','chemicals','化工'),(5,'能源电力','energy','能源'),(6,'食品饮料','foods','食品'),
    (7,'软件服务','games','游戏'),(8,'保险业','insurance','保险'),(9,'交通运输','logistics','物流'),(10,'矿产','mining','矿业'),(11,'汽车','motors','汽车'),(12,'光学','optics','光学'),(13,'造纸','paper','纸业'),(14,'医药','pharma','制药'),
    (15,'零售业','retail','零售'),(16,'机器人','robotics','机器人'),(17,'证券业','securities','证券'),(18,'芯片','semiconductor','半导体'),(19,'交通运输','shipping','航运'),(20,'软件服务','software','软件'),(21,'钢铁','steel','钢铁'),
    (22,'通信网','telecom','通信'),(23,'纺织','textiles','纺织'),(24,'水务','water','水务')),
  themes(rank, label, latin, han) AS (VALUES (1,'credit','lending loan loans bank','信贷 贷款'),(2,'weather','rains rain drought warmer','天气 水位'),(3,'trade','tariff export customs','关税 出口'),
    (4,'wages','wage wages pension','工资 养老金'),(5,'ports','ports port harbour','港口 港务'),(6,'raw materials','ore scrap grain','矿石 废料 粮食')),"""
_HIT = r"(list_has_any(string_split(trim(regexp_replace({t}, '[^\pL\pN]+', ' ', 'g')), ' '), string_split(latin, ' ')) OR len(list_filter(string_split(han, ' '), lambda h: contains({t}, h))) > 0)"
_FAM = "coalesce(nullif(trim(source_family), ''), 'source:'||source_id)"
_CLASS = f"""WITH {_VOCABULARY}
  texts AS (SELECT *, {_COMBO} combo, lower({_FOCUS}) foc FROM {_A} JOIN source_registry USING (source_id)),
  by_action AS (SELECT article_id, arg_min(actions.kind, rank) k, arg_min(actions."action", rank) a FROM texts JOIN actions ON {_HIT.format(t="combo")} GROUP BY 1),
  by_sector AS (SELECT article_id, arg_min(label, rank) industry FROM texts JOIN sectors ON {_HIT.format(t="foc")} GROUP BY 1),
  by_theme AS (SELECT article_id, arg_min(label, rank) theme FROM texts JOIN themes ON {_HIT.format(t="foc")} GROUP BY 1)
  SELECT article_id, title, collected_at, lane, trust_tier, {_FAM} fam, coalesce(k, CASE WHEN lane='signal' THEN 'social_signal' WHEN coverage_scope='company' THEN 'company_action' ELSE 'macro_data' END) kind,
  coalesce(a, CASE WHEN lane='signal' THEN 'signal' ELSE 'general_update' END) "action", industry, theme
  FROM texts LEFT JOIN by_action USING (article_id) LEFT JOIN by_sector USING (article_id) LEFT JOIN by_theme USING (article_id)"""
_ENT = r"""SELECT a.article_id, arg_min(canonical_id, (-length(trim(p)), canonical_id)) entity
  FROM (SELECT DISTINCT article_id, ' '||trim(regexp_replace(lower(title), '[^\pL\pN]+', ' ', 'g'))||' ' t FROM news_articles) a
  LEFT JOIN (SELECT DISTINCT canonical_id, CASE WHEN regexp_matches(q, '[\x{4e00}-\x{9fff}]') THEN q ELSE ' '||q||' ' END p
    FROM (SELECT canonical_id, trim(regexp_replace(lower(alias), '[^\pL\pN]+', ' ', 'g')) q FROM entity_aliases_v1)) k ON contains(t, p) GROUP BY 1"""


def _replay_sql(cadence: str) -> str:
    parts = {
        "day": "ts::DATE s, (ts::DATE + 1)::DATE e, 'day:'||ts::DATE lab, 0 k",
        "week": "date_trunc('week', ts)::DATE s, (date_trunc('week', ts)::DATE + 7)::DATE e, 'week:'||strftime(ts, '%G-W%V') lab, 0 k",
        "month": "date_trunc('month', ts)::DATE s, (date_trunc('month', ts) + INTERVAL 1 MONTH)::DATE e, 'month:'||strftime(ts, '%Y-%m') lab, 0 k",
        "year": "date_trunc('year', ts)::DATE s, (date_trunc('year', ts) + INTERVAL 1 YEAR)::DATE e, 'year:'||strftime(ts, '%Y') lab, 0 k",
        "rolling3": "(ts::DATE + k - 2)::DATE s, (ts::DATE + k + 1)::DATE e, 'rolling3:'||(ts::DATE + k) lab, k",
    }[cadence]
    src = "events, (SELECT unnest([0,1,2])::INT k) o" if cadence == "rolling3" else "events"
    return f"""SELECT lab window_label, greatest(s, DATE '2024-01-03')::VARCHAR window_start, least(e, DATE '2024-01-25')::VARCHAR window_end, event_type, count(*) n_events
      FROM (SELECT event_type, {parts} FROM {src} WHERE ts >= '2024-01-03' AND ts < '2024-01-25') WHERE e - 1 < DATE '2024-01-25' OR lab NOT LIKE 'rolling3%' GROUP BY ALL"""


ORACLE = {
    "d1_classify": f"SELECT article_id, kind, \"action\", industry, theme FROM ({_CLASS})",
    "d2_title_entity": _ENT,
    "d8_context_signature": f"SELECT DISTINCT article_id, {_SIG} signature FROM news_articles",
    "d12_source_family": f"SELECT source_id, {_FAM} \"family\" FROM source_registry",
    "d13_ids": "SELECT DISTINCT article_id, 'art_'||substr(sha256(concat_ws('|', source_id, lower(" + _SQ.format(c="title") + "), coalesce(canonical_url,''))),1,24) derived_id FROM news_articles",
    "e1_event_build": f"""WITH c AS (SELECT x.*, n.entity, CASE WHEN entity IS NOT NULL THEN concat_ws('|','entity',entity,kind,"action",{_SIG}) WHEN industry IS NOT NULL THEN concat_ws('|','industry',industry,kind,"action",strftime(collected_at AT TIME ZONE 'UTC','%Y-%m-%d'))
        WHEN theme IS NOT NULL THEN concat_ws('|','macro',theme,kind,"action",strftime(collected_at AT TIME ZONE 'UTC','%Y-%m-%d')) ELSE concat_ws('|','title',kind,substr({_SKEL},1,80),strftime(collected_at AT TIME ZONE 'UTC','%Y-%m-%d')) END mk
        FROM ({_CLASS}) x JOIN ({_ENT}) n USING (article_id))
      SELECT 'evt_'||substr(sha256(mk),1,24) event_id, arg_max(kind, (collected_at, article_id)) event_type, arg_max("action", (collected_at, article_id)) "action", max(entity) entity,
        arg_max(industry, (collected_at, article_id)) FILTER (industry IS NOT NULL) industry, substr(arg_min(title, ((lane <> 'confirmation')::INT, trust_tier, length(title), article_id)),1,240) event_title,
        count(*) article_count, count(DISTINCT fam) family_count, count(DISTINCT fam) FILTER (lane='confirmation') confirmation_count, epoch(min(collected_at))::BIGINT first_seen, epoch(max(collected_at))::BIGINT last_seen FROM c GROUP BY mk""",
    "s3_sessions": """SELECT user_id, floor(epoch(min(ts)))::BIGINT session_start, count(*) n_events FROM (SELECT user_id, ts, sum(b) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) g
      FROM (SELECT user_id, ts, (coalesce(ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) >= INTERVAL 6 HOUR, true))::INT b FROM events)) GROUP BY user_id, g""",
    "s9_snapshot_ids": """SELECT 'snap_'||sha256(user_id||'|week:'||strftime(s, '%G-W%V')) snapshot_id, least(s + 7, DATE '2024-01-25')::DATE::VARCHAR as_of, length(string_agg(event_id::VARCHAR, ',' ORDER BY event_id))::INT n_chars
      FROM (SELECT *, date_trunc('week', ts)::DATE s FROM events WHERE ts >= '2024-01-03' AND ts < '2024-01-25') GROUP BY user_id, s""",
} | {f"s1_replay_{c}": _replay_sql(c) for c in CADENCES}
