import datetime as dt

from pyspark.sql import functions as F

from newsloom.operators.references import Parent, Reference, broken_by_period, broken_references


def day(n):
    return dt.datetime(2026, 1, n, tzinfo=dt.timezone.utc)


def model(spark, kids, parents):
    p = spark.createDataFrame(parents, "pid string, at timestamp, parent string")
    k = spark.createDataFrame(kids, "kid string, ref string, at timestamp, key string")
    return [Parent("p", p, "pid", "at")], [Reference("k", "ref", k, F.col("kid"), "at", "p")]


def test_statuses(spark):
    parents = [("A ", day(5), "x"), ("a", day(3), "x"), ("b", day(9), "x"), ("c", None, "x"), (None, day(1), "x")]
    kids = [("1", "a", day(4), "z"), ("2", " B\t", day(4), "z"), ("3", "b", day(10), "z"), ("4", "zz", day(4), "z"), ("5", None, day(4), "z"), ("6", "", day(4), "z"), ("7", "c", day(1), "z"), ("8", "zz", None, "z"), ("9", "b", None, "z")]
    got = {tuple(r)[2:] for r in broken_references(*model(spark, kids + kids[:4], parents)).collect()}
    assert got == {("2", " B\t", "late", "2026-01"), ("4", "zz", "missing", "2026-01"), ("6", "", "missing", "2026-01"), ("8", "zz", "missing", None)}


def test_hot_key_and_empty(spark):
    kids = [(str(i), "gone" if i % 3 == 0 else "a", day(2), "z") for i in range(3000)]
    p, r = model(spark, kids, [("a", day(1), "x")])
    assert broken_references(p, r).count() == 1000
    assert [tuple(x)[2:] for x in broken_by_period(p, r).collect()] == [("missing", "2026-01", 1000)]
    p, r = model(spark, [], [])
    assert broken_references(p, r).count() == 0
