"""Queries of the training-text problems and their SQL where SQL can express them on whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm import abuse, arrivals, bpe, canonical_names, lookalikes, packing, site_lines
from newsloom.llm import near_duplicates as ND
from newsloom.session import table

STORY = ["title_norm", "summary", "body_text"]
STORY_PLAN = ND.Plan(width=3, threshold=0.5)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return lookalikes.equal_looking_pairs(table(spark, d, "news_articles"), "article_id", "title", "title_norm")


def p1_forms(spark: SparkSession, d: str) -> DataFrame:
    """Every headline in its one form."""
    return lookalikes.look_keys(table(spark, d, "news_articles"), "article_id", ["title", "title_norm"]).select("article_id", "title_form", "title_norm_form").distinct()


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    reference = table(spark, d, "entity_aliases_v1")
    links = table(spark, d, "event_entity_links").filter(F.col("entity_type").isin("company", "institution")).select("id", "entity_name")
    spelt = reference.select(F.col("alias").alias("entity_name")).unionByName(reference.select(F.col("canonical_name").alias("entity_name"))).distinct()
    typed = links.join(spelt, "entity_name", "left_anti")
    return canonical_names.map_names(typed, "id", "entity_name", reference, "canonical_id", ["alias", "canonical_name"])


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return ND.similar_pairs(table(spark, d, "news_articles"), "article_id", STORY, STORY_PLAN)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return site_lines.found_in(table(spark, d, "news_articles"), "article_id", "source_id", "collected_at", "body_text")


def p6_cleaned(spark: SparkSession, d: str) -> DataFrame:
    return site_lines.cleaned(table(spark, d, "news_articles"), "article_id", "source_id", "collected_at", "body_text")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    nb = arrivals.Neighbourhood(width=3, threshold=0.5)
    return arrivals.found_in(table(spark, d, "news_articles"), "article_id", "source_id", "collected_at", "content_hash", "canonical_url", STORY, nb)


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return bpe.encode(table(spark, d, "documents"), "doc_id", "text")


def _packed(spark: SparkSession, d: str) -> tuple[DataFrame, dict[str, int]]:
    # a fixed table of three rows
    capacities = {r["capacity_name"]: r["capacity_tokens"] for r in table(spark, d, "pack_capacity").collect()}
    return packing.pack(bpe.token_counts(table(spark, d, "documents"), "doc_id", "text"), "doc_id", "tokens", capacities), capacities


def p9_packed(spark: SparkSession, d: str) -> DataFrame:
    return _packed(spark, d)[0]


def p9_fill(spark: SparkSession, d: str) -> DataFrame:
    return packing.fill_report(*_packed(spark, d))


def p10_scores(spark: SparkSession, d: str) -> DataFrame:
    """Every document with its score and its nearest flagged example."""
    return abuse.score(table(spark, d, "documents"), table(spark, d, "review_labels"), "doc_id", "text", "label", keep=["source"])


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return p10_scores(spark, d).filter("is_case").select("doc_id")


def p10_rates(spark: SparkSession, d: str) -> DataFrame:
    return abuse.rates(p10_scores(spark, d), "source")


QUERIES = {
    "p1_found": p1_found,
    "p1_forms": p1_forms,
    "p2_found": p2_found,
    "p3_found": p3_found,
    "p6_found": p6_found,
    "p6_cleaned": p6_cleaned,
    "p7_found": p7_found,
    "p8_ids": p8_ids,
    "p9_packed": p9_packed,
    "p9_fill": p9_fill,
    "p10_found": p10_found,
    "p10_scores": p10_scores,
    "p10_rates": p10_rates,
}

_LINES = r"""
WITH docs AS (SELECT DISTINCT article_id, coalesce(source_id, '') src, body_text FROM news_articles WHERE body_text IS NOT NULL),
lines AS (SELECT article_id, src, body_text, s.s line, s.i line_no FROM docs, LATERAL (SELECT unnest(string_split(body_text, E'\n')) s, generate_subscripts(string_split(body_text, E'\n'), 1) i) s),
keyed AS (SELECT *, regexp_replace(lower(line), '[\s\pZ\p{Nd}]+', '', 'g') k FROM lines),
n AS (SELECT src, k, count(DISTINCT article_id) n FROM keyed WHERE k <> '' GROUP BY ALL),
t AS (SELECT src, count(*) docs FROM docs GROUP BY ALL),
bad AS (SELECT src, k FROM n JOIN t USING (src) WHERE n >= 6 AND n * 20 >= docs)
"""
_HAN = r"\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}\x{f900}-\x{faff}\x{20000}-\x{3ffff}"
# every ideograph a word of its own, then the words, then the distinct runs of three
_RUNS = rf"""
WITH a AS (SELECT DISTINCT article_id, source_id, collected_at, content_hash, canonical_url,
    regexp_extract_all(regexp_replace(lower(coalesce(title_norm,'')||E'\n'||coalesce(summary,'')||E'\n'||coalesce(body_text,'')), '([{_HAN}])', ' \1 ', 'g'), '[\pL\pN]+') w FROM news_articles),
r AS (SELECT DISTINCT article_id, source_id, collected_at, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i]||' '||w[i+1]||' '||w[i+2])) g FROM a),
n AS (SELECT article_id, count(*) n FROM r GROUP BY 1)
"""
_PAGE = r"""CASE WHEN trim(canonical_url) <> '' THEN concat_ws(E'\n',
  regexp_replace(regexp_replace(lower(regexp_extract(regexp_replace(trim(canonical_url), '(?i)^https?://', ''), '^([^/?#]*)', 1)), ':[0-9]*$', ''), '^www\.', ''),
  regexp_replace(regexp_extract(regexp_replace(trim(canonical_url), '(?i)^https?://', ''), '^[^/?#]*([^?#]*)', 1), '/$', ''),
  regexp_extract(regexp_extract(canonical_url, '^[^?#]*\?([^#]*)', 1), '(?:^|&)id=([^&]*)', 1), regexp_extract(regexp_extract(canonical_url, '^[^?#]*\?([^#]*)', 1), '(?:^|&)page=([^&]*)', 1)) END"""
ORACLE: dict[str, str] = {
    "p3_found": _RUNS
    + """, c AS (SELECT x.article_id p, y.article_id q, count(*) m FROM r x JOIN r y ON x.g = y.g AND x.article_id < y.article_id GROUP BY ALL)
      SELECT p article_id_a, q article_id_b FROM c JOIN n i ON i.article_id = p JOIN n j ON j.article_id = q WHERE m >= 0.5 * (i.n + j.n - m)""",
    "p7_found": _RUNS
    + f""", c AS (SELECT x.article_id p, y.article_id q, x.collected_at pt, y.collected_at qt, count(*) m FROM r x JOIN r y ON x.source_id = y.source_id AND x.g = y.g AND x.article_id < y.article_id GROUP BY ALL),
      k AS (SELECT article_id, content_hash h, source_id s, {_PAGE} u, row_number() OVER (PARTITION BY source_id, content_hash ORDER BY collected_at, article_id) hn, row_number() OVER (PARTITION BY source_id, {_PAGE} ORDER BY collected_at, article_id) un FROM a WHERE source_id IS NOT NULL)
      SELECT CASE WHEN (pt, p) < (qt, q) THEN q ELSE p END article_id FROM c JOIN n i ON i.article_id = p JOIN n j ON j.article_id = q WHERE m >= 0.5 * (i.n + j.n - m)
      UNION SELECT article_id FROM k WHERE h IS NOT NULL AND hn > 1 UNION SELECT article_id FROM k WHERE u IS NOT NULL AND un > 1""",
    "p6_found": _LINES + "SELECT article_id, line_no::INTEGER line_no FROM keyed SEMI JOIN bad USING (src, k)",
    "p6_cleaned": _LINES
    + """SELECT article_id, coalesce(string_agg(line, E'\\n' ORDER BY line_no) FILTER (NOT hit), '') body_text
    FROM (SELECT keyed.*, bad.k IS NOT NULL hit FROM keyed LEFT JOIN bad USING (src, k)) GROUP BY article_id HAVING bool_or(hit)""",
}
