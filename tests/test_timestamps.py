import datetime as dt

import pytest

from newsloom.operators import timestamps as T

NOW = dt.datetime(2026, 3, 10, 12, 0, 30, tzinfo=dt.timezone.utc)
CASES = [
    # written, zone, order, instant, quality
    ("2026-01-21T09:27:51Z", "UTC", "dmy", "2026-01-21T09:27:51+00:00", "exact"),
    (" 2025-12-31T18:25:52.536652Z\n", "UTC", "dmy", "2025-12-31T18:25:52+00:00", "exact"),
    ("2025-11-10T09:07:51+0800", "UTC", "dmy", "2025-11-10T01:07:51+00:00", "exact"),
    ("2026-02-21 13:56:39+01", "UTC", "dmy", "2026-02-21T12:56:39+00:00", "exact"),
    ("2026.02.23 12:20", "Asia/Shanghai", "dmy", "2026-02-23T04:20:00+00:00", "exact"),
    ("20251009044331", "Asia/Tokyo", "dmy", "2025-10-08T19:43:31+00:00", "exact"),
    ("20260213T081632Z", "Asia/Tokyo", "dmy", "2026-02-13T08:16:32+00:00", "exact"),
    ("1760442342", "UTC", "dmy", "2025-10-14T11:45:42+00:00", "exact"),
    ("1762973842182", "UTC", "dmy", "2025-11-12T18:57:22+00:00", "exact"),
    ("1767204100530569", "UTC", "dmy", "2025-12-31T18:01:40+00:00", "exact"),
    ("Fri, 7 Nov 2025 17:01:59 AEDT", "UTC", "dmy", "2025-11-07T06:01:59+00:00", "exact"),
    ("31 Mar 2026 17:41:13 +0100", "UTC", "dmy", "2026-03-31T16:41:13+00:00", "exact"),
    ("Jan 30, 2026, 3:31 p.m. UTC", "UTC", "dmy", "2026-01-30T15:31:00+00:00", "exact"),
    ("December 24, 2025, 12:23 AM GMT", "UTC", "dmy", "2025-12-24T00:23:00+00:00", "exact"),
    ("01/02/2026 3:35 pm", "UTC", "dmy", "2026-02-01T15:35:00+00:00", "exact"),
    ("01/02/2026 3:35 pm", "UTC", "mdy", "2026-01-02T15:35:00+00:00", "exact"),
    ("2026年2月17日 22:37", "Asia/Shanghai", "dmy", "2026-02-17T14:37:00+00:00", "exact"),
    ("2026年04月12日3时15分", "Asia/Shanghai", "dmy", "2026-04-11T19:15:00+00:00", "exact"),
    ("2026年1月19日 下午8:14", "UTC", "dmy", "2026-01-19T20:14:00+00:00", "exact"),
    ("5 December 2025", "America/New_York", "dmy", "2025-12-05T05:00:00+00:00", "estimated"),
    ("2025-12-09", "Asia/Kolkata", "dmy", "2025-12-08T18:30:00+00:00", "estimated"),
    ("11 minutes ago", "UTC", "dmy", "2026-03-10T11:49:30+00:00", "estimated"),
    ("3小时前", "UTC", "dmy", "2026-03-10T09:00:30+00:00", "estimated"),
    ("just now", "UTC", "dmy", "2026-03-10T12:00:30+00:00", "estimated"),
    ("yesterday 20:27", "Australia/Sydney", "dmy", "2026-03-09T09:27:00+00:00", "estimated"),
    ("昨天 01:10", "Asia/Shanghai", "dmy", "2026-03-08T17:10:00+00:00", "estimated"),
    # occurs twice: the first; skipped: the offset before the change
    ("2025-11-02 01:30", "America/New_York", "dmy", "2025-11-02T05:30:00+00:00", "exact"),
    ("2026-03-08 02:30", "America/New_York", "dmy", "2026-03-08T07:30:00+00:00", "exact"),
    ("2026-03-29 02:30", "Europe/Berlin", "dmy", "2026-03-29T01:30:00+00:00", "exact"),
    *[(x, "UTC", "dmy", "unknown", "unknown") for x in ("", "  ", "TBD", "2025-11-31", "25:61", "2025-13-05T08:00:00Z", "0000-00-00 00:00:00", "2026-01-01 24:30", "13:00 PM", "x" * 3000, "31/11/2025 10:00", "2026-01-01 10:00 QQQ")],
]


def test_cascade(spark):
    rows = [(str(i), f"s{i}", c[0], NOW, "extra") for i, c in enumerate(CASES)] + [("n", "s0", None, NOW, "extra")]
    articles = spark.createDataFrame(rows + rows[:2], "article_id string, source_id string, published_at string, collected_at timestamp, sec string")
    clock = spark.createDataFrame([(f"s{i}", c[1], c[2]) for i, c in enumerate(CASES)], "source_id string, tz_name string, date_order string")
    got = {r.article_id: r for r in T.normalise_published(articles, clock).collect()}
    assert len(got) == len(CASES) + 1 and got["n"].published_utc is None and got["n"].quality is None
    for i, c in enumerate(CASES):
        assert (got[str(i)].published_utc, got[str(i)].quality) == (c[3], c[4]), c


def test_unnormalised_skips_canonical_and_empty_table(spark):
    schema = "article_id string, source_id string, published_at string, collected_at timestamp"
    clock = spark.createDataFrame([], "source_id string, tz_name string, date_order string")
    df = spark.createDataFrame([("a", None, "2026-01-01T00:00:00+00:00", NOW), ("b", None, None, NOW), ("c", None, "2026-01-01 10:00", NOW)], schema)
    assert [tuple(r) for r in T.unnormalised(df, clock).collect()] == [("c", "2026-01-01T10:00:00+00:00", "exact")]
    assert T.unnormalised(df.filter("article_id = 'z'"), clock).count() == 0


@pytest.mark.parametrize("zone,minutes", [("AEDT", 660), ("IST", 330), ("EST", -300)])
def test_zone_table(zone, minutes):
    assert T.ZONE_MINUTES[zone] == minutes
