"""Queries on names: headline extraction, candidates, shapes, variants, aliases, source families, regions, signatures and topics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions import text as X
from newsloom.operators import classify as C
from newsloom.operators import extract
from newsloom.plans.events import _CLASS, _ENT, _SIG, classified
from newsloom.plans.relational import _articles, _entities
from newsloom.session import table


def d2_headline_entity(spark: SparkSession, d: str) -> DataFrame:
    return _articles(spark, d, "title").select("article_id", extract.headline_entity(F.col("title")).alias("entity"))


def d3_institution(spark: SparkSession, d: str) -> DataFrame:
    return _articles(spark, d, "title").select("article_id", extract.headline_institution(F.col("title")).alias("institution"))


def d4_candidates(spark: SparkSession, d: str) -> DataFrame:
    return _articles(spark, d, "title").select("article_id", extract.clean_candidate(F.col("title")).alias("candidate"))


def d5_looks_like_company(spark: SparkSession, d: str) -> DataFrame:
    return _entities(spark, d).select("entity_name").distinct().select("entity_name", extract.looks_like_company(F.col("entity_name")).alias("is_company"))


def d6_company_variants(spark: SparkSession, d: str) -> DataFrame:
    """Ids and spellings of firms: the id of the alias list, else a slug; spellings longest first."""
    names = _entities(spark, d).filter("entity_type = 'company' and entity_name is not null").select("entity_name").distinct()
    listed = admitted_aliases(table(spark, d, "entity_aliases_v1")).filter("entity_type = 'company'").groupBy("look").agg(F.min("canonical_id").alias("canonical_id"))
    found = names.withColumn("look", X.lookup_key(F.col("entity_name"))).join(listed, "look", "left")
    spelt = F.array_sort(extract.company_variants(F.col("entity_name")), lambda a, b: F.when(F.length(a) != F.length(b), F.length(b) - F.length(a)).when(a < b, -1).when(a > b, 1).otherwise(0))
    return found.select("entity_name", F.coalesce("canonical_id", X.slug(F.col("entity_name"))).alias("company_id"), F.array_join(spelt, "|").alias("variants"))


def admitted_aliases(aliases: DataFrame) -> DataFrame:
    """entity_type, canonical_id, alias, look: spellings fit for searching texts.  A Latin alias needs four characters or a figure, a
    Chinese one two; the first id of a spelling (by id) has it."""
    a = aliases.select("entity_type", "canonical_id", X.squeeze(F.col("alias")).alias("alias")).filter("canonical_id is not null and alias <> ''")
    fit = F.when(F.col("alias").rlike(X.HAN), F.length("alias") >= 2).otherwise((F.length("alias") >= 4) | F.col("alias").rlike("[0-9]"))
    return a.filter(fit).withColumn("look", X.lookup_key(F.col("alias"))).filter("look <> ''").groupBy("entity_type", "look").agg(F.min(F.struct("canonical_id", "alias")).alias("m")).select("entity_type", "m.canonical_id", "m.alias", "look")


def a27_alias_admission(spark: SparkSession, d: str) -> DataFrame:
    return admitted_aliases(table(spark, d, "entity_aliases_v1"))


def d9_update_signature(spark: SparkSession, d: str) -> DataFrame:
    return _articles(spark, d, "title").select("article_id", C.update_signature(F.col("title")).alias("signature"))


def d11_topic_key(spark: SparkSession, d: str) -> DataFrame:
    a = classified(spark, d)
    return a.groupBy(C.topic_key(F.col("entity"), F.col("theme"), F.col("industry"), F.col("title")).alias("topic")).agg(F.count("*").alias("n_articles"), F.countDistinct("source_id").alias("n_sources"))


#: (part of a host, family) of articles whose source declares none, before the prefixes of source ids.
HOST_FAMILIES = [("tidegate", "wire:tidegate"), ("norvale", "wire:norvale"), ("kestrelby", "press:kestrelby")]
PREFIX_FAMILIES = [("songhe_", "wire:songhe"), ("baiyan_", "wire:baiyan"), ("chixia_", "press:chixia")]


def family_of(declared, source, host):
    """The declared family, else by host, else by the beginning of the source id, else the source alone."""
    steps = [F.nullif(F.trim(declared), F.lit(""))]
    steps += [F.when(F.contains(host, F.lit(part)), label) for part, label in HOST_FAMILIES]
    steps += [F.when(F.startswith(source, F.lit(begin)), label) for begin, label in PREFIX_FAMILIES]
    return F.coalesce(*steps, F.concat(F.lit("source:"), source))


def d12_article_families(spark: SparkSession, d: str) -> DataFrame:
    """Articles by source family, of sources the registry no longer knows as well."""
    reg = table(spark, d, "source_registry").select("source_id", "source_family")
    a = _articles(spark, d, "source_id", "url").join(reg, "source_id", "left")
    host = F.coalesce(X.url_host(F.col("url")), F.lit(""))
    return a.groupBy(family_of(F.col("source_family"), F.col("source_id"), host).alias("family")).agg(F.count("*").alias("n_articles"))


#: ticker ending: region
REGIONS = {"HK": "HK", "SZ": "CN", "SS": "CN", "SH": "CN", "T": "JP", "L": "UK", "DE": "EU", "PA": "EU"}


def region_of(ticker, name):
    """By what follows the ticker's last dot; five figures are Hong Kong, six are China; else Chinese names are China."""
    ending = F.upper(F.regexp_extract(ticker, r"\.([A-Za-z]+)$", 1))
    by = F.element_at(F.create_map(*[F.lit(x) for kv in REGIONS.items() for x in kv]), ending)
    return F.coalesce(by, F.when(ticker.rlike("^[0-9]{5}$"), "HK").when(ticker.rlike("^[0-9]{6}$"), "CN").when(ticker.rlike("^[A-Z]{1,5}$"), "US"), F.when(name.rlike(X.HAN), "CN"), F.lit(""))


def d15_region(spark: SparkSession, d: str) -> DataFrame:
    """Regions of listed firms; the tickers are made of the id here, in all shapes."""
    a = table(spark, d, "entity_aliases_v1").filter("entity_type = 'company'").groupBy("canonical_id").agg(F.min("canonical_name").alias("name"))
    n = F.length("canonical_id")
    ticker = F.when(n % 5 == 0, F.lpad(n.cast("string"), 5, "0")).when(n % 5 == 1, F.lpad(n.cast("string"), 6, "6")).when(n % 5 == 2, F.concat(n.cast("string"), F.lit(".hk"))).when(n % 5 == 3, F.lit("ABC")).otherwise(F.lit(""))
    return a.select("canonical_id", region_of(ticker, F.col("name")).alias("region"))


def d16_query_strings(spark: SparkSession, d: str) -> DataFrame:
    """Search strings of entities: at most six spellings, quoted, joined by OR."""
    a = admitted_aliases(table(spark, d, "entity_aliases_v1")).groupBy("entity_type", "canonical_id").agg(F.array_sort(F.collect_set("alias")).alias("s"))
    return a.select("entity_type", "canonical_id", F.concat(F.lit("("), F.array_join(F.transform(F.slice("s", 1, 6), lambda x: F.concat(F.lit('"'), F.replace(x, F.lit('"'), F.lit("")), F.lit('"'))), " OR "), F.lit(")")).alias("query"))


def d18_target_terms(spark: SparkSession, d: str) -> DataFrame:
    """Search terms of each firm: id, name, admitted aliases and what the name is without its legal form."""
    base = table(spark, d, "entity_aliases_v1").filter("entity_type = 'company'").groupBy("canonical_id").agg(F.min("canonical_name").alias("name"))
    al = admitted_aliases(table(spark, d, "entity_aliases_v1")).filter("entity_type = 'company'").groupBy("canonical_id").agg(F.collect_set("alias").alias("aliases"))
    terms = F.array_distinct(F.flatten(F.array(F.array("canonical_id", X.squeeze(F.col("name"))), F.coalesce("aliases", F.array().cast("array<string>")))))
    return base.join(al, "canonical_id", "left").select("canonical_id", F.array_join(F.array_sort(terms), "|").alias("terms"), F.size(terms).alias("n_terms"))


QUERIES = {k: f for k, f in globals().items() if k[:1] in "ad" and k[1:2].isdigit()}

_A = "(SELECT DISTINCT article_id, source_id, title, url FROM news_articles) a"
_SQUEEZE = r"trim(regexp_replace({c}, '[\s\pZ]+', ' ', 'g'))"
_LOOK = r"regexp_replace(lower({c}), '[^\pL\pN]+', '', 'g')"
_SKEL = r"trim(regexp_replace(regexp_replace(lower(trim(regexp_replace(title, '[\s\pZ]+', ' ', 'g'))), '[0-9]{1,4}(?:[./:-][0-9]{1,2})+', ' ', 'g'), '[^\pL\pN_]+', ' ', 'g'))"
_FIRST = r"regexp_replace(trim(regexp_replace(title, '[\s\pZ]+', ' ', 'g')), '^((UPDATE [0-9]+|RPT|CORRECTED|REFILE|EXCLUSIVE|Exclusive|Corrected|Follow-up|更新|更正|独家|跟进)\s*[-:：]\s*)+', '')"
_CAND = rf"regexp_replace(trim(regexp_replace(regexp_replace({_FIRST}, '[\"“”【】《》]', ' ', 'g'), '[\s\pZ]+', ' ', 'g')), '[\s,，;；:：-]+$', '')"
_FIRM = r"'((?:\p{Lu}[\pL''-]+ ){1,3}(?:Airlines|Bank|Batteries|Chemicals|Energy|Foods|Games|Insurance|Logistics|Mining|Motors|Optics|Paper|Pharma|Retail|Robotics|Securities|Semiconductor|Shipping|Software|Steel|Telecom|Textiles|Water))(?:[^\pL]|$)'"
_FIRM_ALONE = _FIRM.removesuffix(r"(?:[^\pL]|$)'") + "'"
_FIRM_HAN = r"(?:航空|银行|电池|化工|能源|食品|游戏|保险|物流|矿业|汽车|光学|纸业|制药|零售|机器人|证券|半导体|航运|软件|钢铁|通信|纺织|水务)"
_BODY = r"'((?:\p{Lu}[\pL''-]+ ){1,3}(?:Ministry|Authority|Board|Bureau|Office|Council))(?:[^\pL]|$)'"
_EDGE = r"(?:^|[\s\pP]|与|和|对|批准|获)"
_ADMIT = rf"""(SELECT entity_type, look, min(canonical_id) canonical_id, arg_min(alias, (canonical_id, alias)) alias FROM
  (SELECT entity_type, canonical_id, alias, {_LOOK.format(c="alias")} look FROM (SELECT entity_type, canonical_id, {_SQUEEZE.format(c="alias")} alias FROM entity_aliases_v1 WHERE canonical_id IS NOT NULL)
   WHERE alias <> '' AND CASE WHEN regexp_matches(alias, '[\x{{4e00}}-\x{{9fff}}]') THEN length(alias) >= 2 ELSE length(alias) >= 4 OR regexp_matches(alias, '[0-9]') END) WHERE look <> '' GROUP BY 1, 2)"""
_SLUG = r"""CASE WHEN sl = '' THEN 'zh-'||substr(sha1(q),1,12) WHEN length(sl) > 80 THEN substr(sl,1,64)||'-'||substr(sha1(q),1,12) ELSE sl END"""
_SLUGGED = r"""CASE WHEN trim(regexp_replace(lower({c}), '[^a-z0-9]+', '-', 'g'), '-') = '' THEN 'zh-'||substr(sha1({c}),1,12) ELSE trim(regexp_replace(lower({c}), '[^a-z0-9]+', '-', 'g'), '-') END"""
_BARE = r"trim(regexp_replace(trim(regexp_replace(q, '(?i)[ ,.]*\b(?:inc|ltd|corp|group|holdings|plc|co)\.?$', '')), '[\s\pZ]+', ' ', 'g'))"
ORACLE = {
    "d2_headline_entity": rf"SELECT DISTINCT article_id, coalesce(nullif(regexp_extract({_CAND}, {_FIRM}, 1), ''), nullif(regexp_extract({_CAND}, '{_EDGE}([\x{{4e00}}-\x{{9fff}}]{{2,6}}?{_FIRM_HAN})', 1), '')) entity FROM news_articles",
    "d3_institution": rf"SELECT DISTINCT article_id, coalesce(nullif(regexp_extract({_CAND}, {_BODY}, 1), ''), nullif(regexp_extract({_CAND}, '{_EDGE}([\x{{4e00}}-\x{{9fff}}]{{2,6}}?(?:部|港务局|管理局|统计局|货币署|委员会))', 1), '')) institution FROM news_articles",
    "d4_candidates": f"SELECT DISTINCT article_id, {_CAND} candidate FROM news_articles",
    "d5_looks_like_company": rf"SELECT DISTINCT entity_name, NOT regexp_matches(q, '[0-9]') AND (regexp_full_match(q, {_FIRM_ALONE}) OR regexp_full_match(q, '[\x{{4e00}}-\x{{9fff}}]{{1,6}}{_FIRM_HAN}')) is_company FROM (SELECT entity_name, {_SQUEEZE.format(c='entity_name')} q FROM event_entity_links)",
    "d6_company_variants": rf"""SELECT entity_name, coalesce(canonical_id, {_SLUG}) company_id,
      array_to_string(list_transform(list_sort(list_transform(list_distinct(list_filter([q, bare, regexp_extract(bare, '^(\S+ \S+(?: \S+)*) \S+$', 1), lower(bare)], lambda x: x <> '')), lambda x: {{'n': -length(x), 'x': x}})), lambda s: s.x), '|') variants
      FROM (SELECT *, {_BARE} bare, trim(regexp_replace(lower(q), '[^a-z0-9]+', '-', 'g'), '-') sl FROM (SELECT DISTINCT entity_name, {_SQUEEZE.format(c='entity_name')} q, {_LOOK.format(c='entity_name')} look FROM event_entity_links WHERE entity_type = 'company' AND entity_name IS NOT NULL))
      LEFT JOIN (SELECT look, min(canonical_id) canonical_id FROM {_ADMIT} WHERE entity_type = 'company' GROUP BY 1) USING (look)""",
    "d11_topic_key": f"""SELECT coalesce('company:'||({_SLUGGED.format(c="entity")}), 'macro:'||({_SLUGGED.format(c="theme")}), 'industry:'||({_SLUGGED.format(c="industry")}), 'title:'||{_SIG}) topic, count(*) n_articles, count(DISTINCT source_id) n_sources
      FROM ({_CLASS}) x JOIN ({_ENT}) n USING (article_id) JOIN (SELECT DISTINCT article_id, source_id FROM news_articles) USING (article_id) GROUP BY 1""",
    "a27_alias_admission": f"SELECT entity_type, canonical_id, alias, look FROM {_ADMIT}",
    "d9_update_signature": rf"""SELECT article_id, CASE WHEN len(w) >= 3 THEN array_to_string(w, ' ') ELSE substr(sk,1,80) END signature FROM (SELECT article_id, sk, list_sort(list_transform(list_sort(list_transform(list_distinct(t), lambda x: {{'p': list_position(t, x), 'x': x}}))[1:12], lambda s: s.x)) w
      FROM (SELECT DISTINCT article_id, {_SKEL} sk, list_filter(string_split(substr({_SKEL},1,400), ' '), lambda w: regexp_matches(w, '[0-9]') OR (length(w) > 1 AND NOT regexp_full_match(w, '[a-z]{{1,3}}'))) t FROM news_articles))""",
    "d12_article_families": """SELECT coalesce(nullif(trim(source_family), ''), CASE WHEN h LIKE '%tidegate%' THEN 'wire:tidegate' WHEN h LIKE '%norvale%' THEN 'wire:norvale' WHEN h LIKE '%kestrelby%' THEN 'press:kestrelby'
        WHEN starts_with(source_id,'songhe_') THEN 'wire:songhe' WHEN starts_with(source_id,'baiyan_') THEN 'wire:baiyan' WHEN starts_with(source_id,'chixia_') THEN 'press:chixia' END, 'source:'||source_id) AS "family", count(*) n_articles
      FROM (SELECT DISTINCT article_id, source_id, url, lower(regexp_extract(coalesce(url,''), '(?i)^https?://([^/?#:]+)', 1)) h FROM news_articles) LEFT JOIN source_registry USING (source_id) GROUP BY 1""",
    "d15_region": r"""SELECT canonical_id, CASE n % 5 WHEN 0 THEN 'HK' WHEN 1 THEN 'CN' WHEN 2 THEN 'HK' WHEN 3 THEN 'US' ELSE CASE WHEN regexp_matches(name, '[\x{4e00}-\x{9fff}]') THEN 'CN' ELSE '' END END region
      FROM (SELECT canonical_id, min(canonical_name) name, length(canonical_id) n FROM entity_aliases_v1 WHERE entity_type='company' GROUP BY 1)""",
    "d16_query_strings": f"SELECT entity_type, canonical_id, '('||array_to_string(list_transform(list_sort(list(DISTINCT alias))[1:6], lambda x: '\"'||replace(x,'\"','')||'\"'), ' OR ')||')' AS \"query\" FROM {_ADMIT} GROUP BY 1, 2",
    "d18_target_terms": f"""SELECT canonical_id, array_to_string(list_sort(list(DISTINCT t)), '|') terms, count(DISTINCT t)::INT n_terms FROM (SELECT canonical_id, canonical_id t FROM entity_aliases_v1 WHERE entity_type='company'
      UNION SELECT canonical_id, {_SQUEEZE.format(c='min(canonical_name)')} FROM entity_aliases_v1 WHERE entity_type='company' GROUP BY 1 UNION SELECT canonical_id, alias FROM {_ADMIT} WHERE entity_type='company') GROUP BY 1""",
}
