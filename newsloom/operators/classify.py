"""Classification of headlines by vocabulary, and the keys that merge articles into events.

A text is cut into words once; each entry of the vocabulary is then a test of overlap (Latin words) or containment (Chinese
parts), and the first entry that fits wins.  So classification is a map-only expression without any join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions import text as X
from newsloom.operators import vocabulary as V


def mentions(text: Column, words: Column, latin: str, han: str) -> Column:
    """Whether one of the blank-separated Latin words, or of the Chinese parts, is in the lower-case text."""
    hit = F.arrays_overlap(words, F.array(*[F.lit(w) for w in latin.split()])) if latin else F.lit(False)
    for part in han.split():
        hit = hit | F.contains(text, F.lit(part))
    return hit


def first_entry(rows: list[tuple[Column, Column]]) -> Column:
    """The value of the first row whose condition holds, else null."""
    return F.coalesce(*[F.when(hit, value) for hit, value in rows])


def action_of(text: Column, words: Column, actions: dict = V.ACTIONS) -> Column:
    """struct(kind, action) of a lower-case text, null where nothing fits."""
    return first_entry([(mentions(text, words, latin, han), F.struct(F.lit(kind).alias("kind"), F.lit(name).alias("action"))) for name, (kind, latin, han) in actions.items()])


def industry_of(text: Column, words: Column, sectors: list = V.SECTORS) -> Column:
    return first_entry([(mentions(text, words, latin, han), F.lit(label)) for latin, han, label in sectors])


def theme_of(text: Column, words: Column, themes: dict = V.THEMES) -> Column:
    return first_entry([(mentions(text, words, latin, han), F.lit(label)) for label, (latin, han) in themes.items()])


def words_of(text: Column) -> Column:
    """Words of a lower-case text."""
    return F.split(F.trim(F.regexp_replace(text, r"[^\p{L}\p{N}]+", " ")), " ")


def context_signature(title: Column, most: int = 4) -> Column:
    """The first telling words of a headline, sorted, once each: Latin words of four letters or more, Chinese runs of two or more."""
    telling = F.filter(F.split(X.skeleton(title, 400), " "), lambda w: ~w.rlike("^[a-z]{1,3}$") & (F.length(w) > 1))
    return F.array_join(F.array_sort(F.slice(F.array_distinct(telling), 1, most)), "-")


def update_signature(title: Column, most: int = 12, least: int = 3) -> Column:
    """What tells one update of an event from another: the sorted telling words with figures among them; of headlines with fewer
    than ``least`` of them the first 80 characters of the skeleton."""
    words = F.array_sort(F.slice(F.array_distinct(F.filter(F.split(X.skeleton(title, 400), " "), lambda w: w.rlike("[0-9]") | (~w.rlike("^[a-z]{1,3}$") & (F.length(w) > 1)))), 1, most))
    return F.when(F.size(words) >= least, F.array_join(words, " ")).otherwise(X.skeleton(title, 80))


def topic_key(entity: Column, theme: Column, industry: Column, title: Column) -> Column:
    """The topic events belong to: the entity, else the theme, else the industry, else the headline's signature."""
    return F.coalesce(F.concat(F.lit("company:"), X.slug(entity)), F.concat(F.lit("macro:"), X.slug(theme)), F.concat(F.lit("industry:"), X.slug(industry)), F.concat(F.lit("title:"), context_signature(title)))


def merge_key(entity: Column, kind: Column, action: Column, industry: Column, theme: Column, title: Column, at: Column) -> Column:
    """Entity events live on, all others are kept apart by day."""
    day = F.date_format(at, "yyyy-MM-dd")
    return (
        F.when(entity.isNotNull(), F.concat_ws("|", F.lit("entity"), entity, kind, action, context_signature(title)))
        .when(industry.isNotNull(), F.concat_ws("|", F.lit("industry"), industry, kind, action, day))
        .when(theme.isNotNull(), F.concat_ws("|", F.lit("macro"), theme, kind, action, day))
        .otherwise(F.concat_ws("|", F.lit("title"), kind, X.skeleton(title, 80), day))
    )


def classify(articles: DataFrame, actions: dict = V.ACTIONS, sectors: list = V.SECTORS, themes: dict = V.THEMES) -> DataFrame:
    """Articles (title, summary, source_id, lane, coverage_scope, collected_at, entity) with kind, action, labels and merge key."""
    combo = F.lower(F.concat_ws(" ", X.squeeze(F.col("title")), F.coalesce(X.squeeze(F.col("summary")), F.lit("")), F.col("source_id")))
    signal, company = F.col("lane") == "signal", F.col("coverage_scope") == "company"
    # each text is made once, as a column of its own, before the vocabulary is tried on it
    out = articles.withColumn("_combo", combo).withColumn("_focus", F.lower(X.focus(F.col("title"))))
    out = out.withColumn("_cw", words_of(F.col("_combo"))).withColumn("_fw", words_of(F.col("_focus")))
    out = out.withColumn("_ka", action_of(F.col("_combo"), F.col("_cw"), actions)).withColumn("industry", industry_of(F.col("_focus"), F.col("_fw"), sectors)).withColumn("theme", theme_of(F.col("_focus"), F.col("_fw"), themes))
    out = out.withColumn("kind", F.coalesce("_ka.kind", F.when(signal, "social_signal").when(company, "company_action").otherwise("macro_data")))
    out = out.withColumn("action", F.coalesce("_ka.action", F.when(signal, "signal").otherwise("general_update"))).drop("_combo", "_focus", "_ka", "_cw", "_fw")
    return out.withColumn("merge_key", merge_key(F.col("entity"), F.col("kind"), F.col("action"), F.col("industry"), F.col("theme"), F.col("title"), F.col("collected_at")))
