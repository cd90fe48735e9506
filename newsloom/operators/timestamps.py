"""Normalising timestamps written in many ways to one UTC instant.

An ordered cascade of anchored patterns (``PATTERNS``) takes each value apart; the first pattern that fits
decides.  The parts are put together strictly: a field out of range or a date that does not exist gives
``unknown``.  Everything is a column expression, so the operator stays in the JVM and never shuffles.

Policy for local times (no zone written): the zone comes from the lookup table; a local time that occurs twice
is the first of the two, a skipped one is read with the offset in force before the change.

Defined results: null in, null out; empty or unreadable text gives instant null and quality ``unknown``; a
source without a lookup row counts as UTC and day-first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Offsets in minutes of zone abbreviations.
ZONE_MINUTES = {
    "Z": 0, "UTC": 0, "GMT": 0, "UT": 0, "WET": 0, "WEST": 60, "BST": 60, "CET": 60, "CEST": 120, "EET": 120, "EEST": 180,
    "MSK": 180, "IST": 330, "SGT": 480, "HKT": 480, "JST": 540, "KST": 540, "AWST": 480, "ACST": 570, "ACDT": 630, "AEST": 600,
    "AEDT": 660, "NZST": 720, "NZDT": 780, "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420, "MDT": -360,
    "PST": -480, "PDT": -420,
}
# Month names, by their first three letters.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
MONTH_RE = (
    r"(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)\.?"
)
#: Seconds of each unit of a relative time.
UNIT_SECONDS = [(r"sec|秒", 1), (r"min|分", 60), (r"h|小时|時|时", 3600), (r"d|天|日", 86400), (r"w|周|星期", 604800)]

_ZONE = r"(z|[a-z]{2,4}|(?:utc|gmt)?[+-]\d{2}(?::?\d{2})?)"
_CLOCK = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,]\d{1,9})?)?(?:\s*([ap]\.?m\.?))?(?:\s*" + _ZONE + r")?"
CANONICAL = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\+00:00\z"

#: name, pattern, positions of (year, month, day, hour, minute, second, half of day, zone); 0: not written.
PATTERNS = [
    ("iso", rf"^(\d{{4}})([-/.])(\d{{1,2}})\2(\d{{1,2}})(?:(?:\s*t\s*|\s+){_CLOCK})?$", (1, 3, 4, 5, 6, 7, 8, 9)),
    ("compact", r"^(\d{4})(\d{2})(\d{2})(?:t?(\d{2})(\d{2})(\d{2})(z|[+-]\d{2}(?::?\d{2})?)?)?$", (1, 2, 3, 4, 5, 6, 0, 7)),
    ("rfc", rf"^(?:[a-z]{{3,9}}\.?,?\s+)?(\d{{1,2}})(?:st|nd|rd|th)?[\s-]+{MONTH_RE},?[\s-]+(\d{{4}})(?:,?\s+(?:at\s+)?{_CLOCK})?$", (3, 2, 1, 4, 5, 6, 7, 8)),
    ("named", rf"^(?:[a-z]{{3,9}}\.?,?\s+)?{MONTH_RE}\s+(\d{{1,2}})(?:st|nd|rd|th)?,?\s+(\d{{4}})(?:,?\s+(?:at\s+)?{_CLOCK})?$", (3, 1, 2, 4, 5, 6, 7, 8)),
    ("slash", rf"^(\d{{1,2}})/(\d{{1,2}})/(\d{{4}})(?:,?\s+{_CLOCK})?$", (3, 2, 1, 4, 5, 6, 7, 8)),
    ("hanzi", r"^(\d{4})\s*年\s*(\d{1,2})\s*月\s*(\d{1,2})\s*[日号](?:\s*(上午|下午|凌晨|早上|中午|晚上|傍晚)?\s*(\d{1,2})\s*[:：时時点](?:\s*(\d{1,2}))?(?:\s*[:：分]\s*(?:(\d{1,2})\s*秒?)?)?)?$", (1, 2, 3, 5, 6, 7, 4, 0)),
]
EPOCH = [(r"^\d{9,10}(\.\d+)?$", 1), (r"^\d{12,13}$", 1_000), (r"^\d{15,16}$", 1_000_000), (r"^\d{18,19}$", 1_000_000_000)]
NOW = r"^(just now|now|moments? ago|a moment ago|刚刚|刚才)$"
AGO = r"^(\d{1,6}|an?)\s*(seconds?|secs?|minutes?|mins?|hours?|hrs?|days?|weeks?|秒钟?|分钟?|小时|天|日|周|星期)\s*(?:ago|之?前)$"
DAY_NAME = rf"^(today|yesterday|今天|今日|昨天|昨日|前天)(?:,?\s*(?:at\s+)?{_CLOCK})?$"


def blanks_off(c: Column) -> Column:
    """Trim blanks of every kind, make inner runs one space."""
    return F.trim(F.regexp_replace(c, r"[\s  -​ 　﻿]+", " "))


def _take(v: Column, kind: str, pattern: str, at: tuple[int, ...]) -> Column:
    """``kind|part|...`` of a fitting value; a group that took no part leaves its place empty."""
    return F.regexp_replace(v, pattern, "|".join([kind, *(f"${k}" if k else "" for k in at)]))


def _whole(c: Column) -> Column:
    return F.when(c != "", c.cast("int"))


def _month(c: Column) -> Column:
    return F.when(c.rlike(r"^\d+$"), c.cast("int")).otherwise(
        F.when(F.array_position(F.array(*map(F.lit, MONTHS)), F.substring(c, 1, 3)) > 0, F.array_position(F.array(*map(F.lit, MONTHS)), F.substring(c, 1, 3)).cast("int"))
    )


def _offset_minutes(zone: Column, tz_name: Column) -> Column:
    """Minutes east of UTC of a written zone; null for an unknown abbreviation or an impossible offset."""
    names = F.create_map(*[F.lit(x) for k, m in ZONE_MINUTES.items() for x in (k.lower(), m)])
    sign = F.when(F.regexp_extract(zone, r"([+-])", 1) == "-", -1).otherwise(1)
    hours, minutes = F.regexp_extract(zone, r"[+-](\d{2})", 1), F.regexp_extract(zone, r"[+-]\d{2}:?(\d{2})", 1)
    written = hours.cast("int") * 60 + F.when(minutes == "", F.lit(0)).otherwise(minutes.cast("int"))
    return (
        F.when(zone.rlike(r"[+-]\d"), F.when((written <= 18 * 60) & ((minutes == "") | (minutes < "60")), sign * written))
        .when((zone == "cst") & tz_name.startswith("Asia/"), F.lit(480))
        .when((zone == "ist") & (tz_name == "Europe/Dublin"), F.lit(60))
        .otherwise(F.try_element_at(names, zone))
    )


def _hour(h: Column, half: Column) -> Column:
    """24-hour value of an hour with a written half of day."""
    late = half.rlike(r"^p|下午|晚上|傍晚")
    early = half.rlike(r"^a|上午|凌晨|早上")
    noon = half.rlike("中午")
    return (
        F.when(half == "", h)
        .when(half.rlike("^[ap]") & ((h < 1) | (h > 12)), F.lit(None).cast("int"))
        .when(late & (h < 12), h + 12)
        .when(early & (h == 12), F.lit(0))
        .when(noon & (h < 3), h + 12)
        .otherwise(h)
    )


def _seconds_of(y: Column, mo: Column, d: Column, h: Column, mi: Column, s: Column) -> Column:
    """Seconds of a wall clock reading as if it were UTC; null when it does not exist."""
    ts = F.try_make_timestamp(y, mo, d, F.lit(0), F.lit(0), F.lit(0), F.lit("UTC"))
    good = h.between(0, 23) & mi.between(0, 59) & s.between(0, 59) & (y >= 1000)
    return F.when(good, F.unix_seconds(ts) + h * 3600 + mi * 60 + s)


def _to_utc(local: Column, tz_name: Column) -> Column:
    """Java's rule for wall clock readings is the policy above: overlap, the earlier offset; gap, the offset before."""
    return F.unix_seconds(F.to_utc_timestamp(F.timestamp_seconds(local), tz_name))


def take_apart(value: Column) -> Column:
    """The cascade: [kind, year, month, day, hour, minute, second, half of day, zone] as written, or null.

    For kind ``epoch<n>`` (n to the second) and ``ago`` the places hold the figure and the unit instead.
    """
    v = F.lower(blanks_off(F.translate(value, "０１２３４５６７８９：／", "0123456789:/")))
    steps = [(pattern, _take(v, name, pattern, at)) for name, pattern, at in PATTERNS]
    steps += [(pattern, F.concat(F.lit(f"epoch{per}|"), v, F.lit("|||||||"))) for pattern, per in EPOCH]
    steps += [(NOW, F.lit("ago|0|sec||||||")), (AGO, _take(v, "ago", AGO, (1, 2, 0, 0, 0, 0, 0, 0))), (DAY_NAME, _take(v, "day", DAY_NAME, (1, 0, 0, 2, 3, 4, 5, 6)))]
    out = None
    for pattern, text in steps:
        out = F.when(v.rlike(pattern), text) if out is None else out.when(v.rlike(pattern), text)
    return F.split(out, r"\|", -1)


def put_together(parts: Column, collected_at: Column, tz_name: Column, day_first: Column) -> Column:
    """Epoch seconds of what ``take_apart`` gave, or null."""
    tz_name, now = F.coalesce(tz_name, F.lit("UTC")), F.unix_seconds(collected_at)
    kind, one, two, three, half, zone = parts[0], parts[1], parts[2], parts[3], parts[7], parts[8]
    back = F.when(one.isin("today", "今天", "今日"), 0).when(one == "前天", 2).otherwise(1)
    named = F.date_sub(F.to_date(F.from_utc_timestamp(F.timestamp_seconds(now), tz_name)), back)
    swap = (kind == "slash") & ~day_first
    is_day = kind == "day"
    y = F.when(is_day, F.year(named)).otherwise(_whole(one))
    mo = F.when(is_day, F.month(named)).when(swap, _whole(three)).otherwise(_month(two))
    d = F.when(is_day, F.dayofmonth(named)).when(swap, _whole(two)).otherwise(_whole(three))
    h = F.when(parts[4] == "", F.lit(0)).otherwise(_hour(_whole(parts[4]), half))
    local = _seconds_of(y, mo, d, h, F.coalesce(_whole(parts[5]), F.lit(0)), F.coalesce(_whole(parts[6]), F.lit(0)))
    dated = F.when(zone == "", _to_utc(local, tz_name)).otherwise(local - _offset_minutes(zone, tz_name) * 60)
    unit = F.lit(None).cast("bigint")
    for pattern, n in reversed(UNIT_SECONDS):
        unit = F.when(two.rlike("^(?:" + pattern + ")"), F.lit(n).cast("bigint")).otherwise(unit)
    count = F.when(one.rlike(r"^\d"), one.cast("bigint")).otherwise(F.lit(1).cast("bigint"))
    epoch = F.floor(one.cast("decimal(30,9)") / F.substring(kind, 6, 12).cast("decimal(12,0)")).cast("bigint")
    return F.when(kind.startswith("epoch"), epoch).when(kind == "ago", now - count * unit).otherwise(dated.cast("bigint"))


def quality_of(parts: Column, sec: Column) -> Column:
    """``exact`` when a time of day is written on a date, ``estimated`` for a bare date or a relative time (a day
    named relatively included), ``unknown`` when nothing can be read or the date does not exist."""
    return (
        F.when(sec.isNull(), F.lit("unknown"))
        .when(parts[0].startswith("epoch"), F.lit("exact"))
        .when(parts[0].isin("ago", "day") | (parts[4] == ""), F.lit("estimated"))
        .otherwise(F.lit("exact"))
    )


def iso_utc(sec: Column) -> Column:
    """``YYYY-MM-DDTHH:MM:SS+00:00`` of epoch seconds, whatever the session's zone."""
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(sec / 86400).cast("int"))
    rest = F.pmod(sec, F.lit(86400))
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    return F.concat(day.cast("string"), F.lit("T"), two(F.floor(rest / 3600)), F.lit(":"), two(F.floor(rest % 3600 / 60)), F.lit(":"), two(rest % 60), F.lit("+00:00"))


def normalise_published(articles: DataFrame, clock: DataFrame) -> DataFrame:
    """Every article once: article_id, published_at, published_utc (``unknown`` if unreadable), quality.

    ``clock`` has one row per source (source_id, tz_name, date_order); it is small and left to the size-checked
    join choice of the planner.  A null published_at gives null published_utc and quality.
    """
    clock = clock.groupBy("source_id").agg(F.min("tz_name").alias("_tz"), F.min("date_order").alias("_order"))
    rows = articles.select("article_id", "source_id", "published_at", "collected_at").distinct().join(clock, "source_id", "left")
    day_first = F.coalesce(F.col("_order"), F.lit("dmy")) != "mdy"
    rows = rows.withColumn("_parts", take_apart(F.col("published_at")))
    rows = rows.withColumn("_sec", put_together(F.col("_parts"), F.col("collected_at"), F.col("_tz"), day_first))
    read = F.col("published_at").isNotNull()
    return rows.select(
        "article_id",
        "published_at",
        F.when(read, F.coalesce(iso_utc(F.col("_sec")), F.lit("unknown"))).alias("published_utc"),
        F.when(read, quality_of(F.col("_parts"), F.col("_sec"))).alias("quality"),
    )


def unnormalised(articles: DataFrame, clock: DataFrame) -> DataFrame:
    """article_id, published_utc, quality of the articles whose published_at is neither null nor canonical."""
    rough = articles.filter(F.col("published_at").isNotNull() & ~F.col("published_at").rlike(CANONICAL))
    return normalise_published(rough, clock).select("article_id", "published_utc", "quality")


def field_times(df: DataFrame, date: Column, time: Column, tz: str, noon: bool = True) -> DataFrame:
    """df with ``sec``, epoch seconds of a date and a time of day that stand in two fields, in zone ``tz``, and ``dated``.

    The time may be missing or already be within the date field; a bare date is noon (or midnight) and ``dated``.  What cannot
    be read gives null seconds.  Each step is a column of its own, so that no long expression is repeated in another."""
    day, hour = F.coalesce(blanks_off(date), F.lit("")), F.coalesce(blanks_off(time), F.lit(""))
    out = df.withColumn("_both", F.trim(F.concat_ws(" ", day, hour))).withColumn("_parts", take_apart(F.col("_both")))
    parts = F.col("_parts")
    out = out.withColumn("_sec", put_together(parts, F.lit(0).cast("timestamp"), F.lit(tz), F.lit(True)))
    bare = F.coalesce(~parts[0].startswith("epoch") & (parts[4] == ""), F.lit(False))
    readable = parts[0].isNotNull() & ~parts[0].isin("ago", "day")
    out = out.withColumn("dated", bare).withColumn("sec", F.when(readable, F.col("_sec") + F.when(bare & F.lit(noon), 43_200).otherwise(0)))
    return out.drop("_both", "_parts", "_sec")


def recent_month_day(df: DataFrame, text: Column, now: Column, tz: str) -> DataFrame:
    """df with ``sec``, epoch seconds of ``MM-dd``, ``MM-dd HH:mm`` or a day named relatively with ``HH:mm``, as pages write recent times.

    The year is that of ``now`` in zone ``tz``, or the one before where the date would lie more than two days ahead."""
    pattern = r"^(\d{1,2})[-/.月](\d{1,2})日?(?:\s+(\d{1,2}):(\d{2}))?\z"
    out = df.withColumn("_t", blanks_off(text)).withColumn("_local", F.from_utc_timestamp(now, tz)).withColumn("_parts", take_apart(F.col("_t")))
    two = lambda i: F.lpad(F.coalesce(F.nullif(F.regexp_extract("_t", pattern, i), F.lit("")), F.lit("0")), 2, "0")
    out = out.withColumn("_rest", F.concat(F.lit("-"), two(1), F.lit("-"), two(2), F.lit(" "), two(3), F.lit(":"), two(4)))
    for name, back in (("_this", 0), ("_before", 1)):
        out = out.withColumn(name, F.try_to_timestamp(F.concat((F.year("_local") - back).cast("string"), F.col("_rest")), F.lit("yyyy-MM-dd HH:mm")))
    chosen = F.when(F.col("_this") > F.col("_local") + F.expr("INTERVAL 2 DAYS"), F.col("_before")).otherwise(F.coalesce("_this", "_before"))
    named = F.when(F.col("_parts")[0].isin("day", "ago"), put_together(F.col("_parts"), now, F.lit(tz), F.lit(True)))
    out = out.withColumn("_named", named)
    out = out.withColumn("sec", F.when(F.col("_t").rlike(pattern), F.unix_seconds(F.to_utc_timestamp(chosen, tz))).otherwise(F.col("_named")))
    return out.drop("_t", "_local", "_parts", "_rest", "_this", "_before", "_named")
