"""Calendar windows over a closed-open span, clipped to it: every row is sent to all windows it belongs to at once.

``windowed`` needs no loop over windows and no join: day, week, month and year have one window per row, the
three-day rolling window at most three.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CADENCES = ["day", "rolling3", "week", "month", "year"]


def windowed(df: DataFrame, at: str, cadence: str, start: str, end: str) -> DataFrame:
    """The rows of [start, end) with window_label, window_start and window_end (dates as text, end exclusive)."""
    if cadence not in CADENCES:
        raise ValueError(f"unsupported cadence: {cadence}")
    lo, hi = F.lit(start).cast("date"), F.lit(end).cast("date")
    day = F.to_date(at)
    rows = df.filter((day >= lo) & (day < hi))
    if cadence == "rolling3":
        rows = rows.withColumn("_last", F.explode(F.sequence(day, F.least(F.date_add(day, 2), F.date_sub(hi, 1)))))
        first, after, label = F.date_sub("_last", 2), F.date_add("_last", 1), F.concat(F.lit("rolling3:"), F.col("_last").cast("string"))
    elif cadence == "day":
        first, after, label = day, F.date_add(day, 1), F.concat(F.lit("day:"), day.cast("string"))
    else:
        first = F.to_date(F.date_trunc(cadence, F.col(at)))
        step = {"week": F.date_add(first, 7), "month": F.add_months(first, 1), "year": F.add_months(first, 12)}
        after = step[cadence]
        thursday = F.date_add(first, 3)  # the ISO year of a week is that of its Thursday
        label = {
            "week": F.concat(F.lit("week:"), F.year(thursday).cast("string"), F.lit("-W"), F.lpad(F.weekofyear(first).cast("string"), 2, "0")),
            "month": F.concat(F.lit("month:"), F.date_format(first, "yyyy-MM")),
            "year": F.concat(F.lit("year:"), F.date_format(first, "yyyy")),
        }[cadence]
    return rows.select(*df.columns, label.alias("window_label"), F.greatest(first, lo).cast("string").alias("window_start"), F.least(after, hi).cast("string").alias("window_end"))
