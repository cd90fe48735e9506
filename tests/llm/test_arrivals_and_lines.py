import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from newsloom.llm import arrivals as A
from newsloom.llm import near_duplicates as ND
from newsloom.llm import site_lines as L
from newsloom.llm import shingles as S

NB = A.Neighbourhood(width=3, threshold=0.5)
SCHEMA = "article_id string, source_id string, collected_at timestamp, content_hash string, url string, body string, rid string, a int"
ARGS = ("article_id", "source_id", "collected_at", "content_hash", "url", ["body"])


def rows(n=250, seed=4):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(4000)]
    out, start = [], dt.datetime(2026, 1, 1, tzinfo=dt.timezone.utc)
    for k in range(n):
        old = r.choice(out) if out and r.random() < 0.5 else None
        body = " ".join(r.choice(vocab) for _ in range(80))
        h, url = f"h{k}", f"https://www.site.example:443/a/{k}/?x=1"
        if old and old[5]:
            kind = r.randrange(4)
            if kind == 0:
                h = old[3]
            elif kind == 1 and old[4]:
                url = old[4].replace("https://www.", "http://").replace(":443", "").replace("/?x=1", "?y=2#f")
            elif kind == 2:
                w = old[5].split()
                w[5] = "edited"
                body = " ".join(w)
            else:
                body = old[5]
        out.append((f"id{k:04d}", r.choice(["s1", "s1", "s2", None]), start + dt.timedelta(hours=k), h if k % 9 else None, url if k % 7 else None, body if k % 11 else None, "x", 1))
    return out


def page(u):
    from urllib.parse import urlsplit

    return None if not u else (urlsplit(u).hostname.removeprefix("www."), urlsplit(u).path.rstrip("/"))


def brute(data):
    out = set()
    sets = {x[0]: {tuple(w[i : i + 3]) for w in [S.words(x[5] or "")] for i in range(len(w) - 2)} for x in data}
    for i, x in enumerate(data):
        for y in data[:i]:
            if x[1] is None or x[1] != y[1]:
                continue
            a, b = sets[x[0]], sets[y[0]]
            if (x[3] and x[3] == y[3]) or (page(x[4]) and page(x[4]) == page(y[4])) or (a and b and len(a & b) / len(a | b) >= 0.5):
                out.add(x[0])
    return out


def test_bulk_equals_brute_force(spark):
    data = rows()
    df = spark.createDataFrame(data + data[:9], SCHEMA)
    assert {r[0] for r in A.found_in(df, *ARGS, NB).collect()} == brute(data)
    assert A.found_in(df.filter("a = 2"), *ARGS, NB).count() == 0


def test_index_over_batches_equals_bulk(spark, tmp_path):
    data = rows(120, 9)
    make = lambda: A.ArrivalIndex(spark, f"file://{tmp_path}/index", *ARGS, NB, parts=4, compact_after=3)
    got = set()
    for k in range(0, 120, 30):  # a new object each time: everything that is kept is in the folder
        got |= {r[0] for r in make().add(spark.createDataFrame(data[k : k + 30], SCHEMA)).collect()}
    assert got == brute(data)
    index = make()
    state = index._state()
    assert len(state["keys"]) == len(state["exact"]) == 2  # three runs became one, and one came after
    with pytest.raises(ValueError, match="before the end"):
        index.add(spark.createDataFrame(data[:5], SCHEMA))
    assert make()._state() == state and make().add(spark.createDataFrame([], SCHEMA)).count() == 0
    # a batch of one source looks only at the parts of that source, and there only at its ranges
    every = index.kept_keys(state, [0, 1, 2, 3])
    one = spark.createDataFrame([("s2",)], "s string").select(F.pmod(F.xxhash64("s"), F.lit(4)).alias("p")).first().p
    part = index.kept_keys(state, [one])
    assert 0 < part.count() < every.count()
    few = ND.perhaps_in(part, part.limit(5), "rng")
    assert 5 <= few.count() <= 40 and "PartitionFilters: [isnotnull(part" in few._jdf.queryExecution().toString()


def crowd(n, shared, own, seed):
    """n texts of one source with a common text of ``shared`` words and ``own`` words of their own."""
    r = random.Random(seed)
    start = dt.datetime(2026, 1, 1, tzinfo=dt.timezone.utc)
    common = " ".join(f"c{i}" for i in range(shared))
    times = r.sample(range(10 * n), n)
    return [(f"id{k:05d}", "s1", start + dt.timedelta(minutes=times[k]), None, None, f"{common} " + " ".join(f"o{k}x{i}" for i in range(own)), "x", 1) for k in range(n)]


def test_all_but_the_first_of_a_crowd_are_found(spark):
    data = crowd(3000, 60, 10, 3)
    first = min(data, key=lambda x: (x[2], x[0]))[0]
    got = {r[0] for r in A.found_in(spark.createDataFrame(data, SCHEMA), *ARGS, NB).collect()}
    assert {x[0] for x in data} - got == {first}


def test_single_partners_in_a_crowd_are_found(spark):
    data = crowd(500, 40, 40, 5)  # similar to 0.32 only
    words = {x[0]: x[5].split() for x in data}
    again = [(f"z{k}", "s1", x[2] + dt.timedelta(days=90), None, None, " ".join(words[x[0]][:-12] + [f"z{k}x{i}" for i in range(12)]), "x", 1) for k, x in enumerate(data[:40])]
    df = spark.createDataFrame(data + again, SCHEMA)
    assert {r[0] for r in A.found_in(df, *ARGS, A.Neighbourhood(width=3, threshold=0.5, window=2, best=1)).collect()} == {x[0] for x in again}


def test_page_keys(spark):
    urls = ["https://www.A.example:443/x/?id=5&utm=1#t", "http://a.example/x?id=5", "a.example/x?z=1&id=5", "http://a.example/x?id=6", "http://a.example/X?id=5", "", "  ", None]
    got = [r[0] for r in spark.createDataFrame([(u,) for u in urls], "u string").select(A.page_key(A.F.col("u"))).collect()]
    assert got[0] == got[1] == got[2] and len({got[0], got[3], got[4]}) == 3 and got[5:] == [None] * 3


def docs():
    out = []
    for k in range(40):
        lines = [f"Story {chr(97 + k % 26)}{chr(97 + k // 26)} itself", "Share  THIS 12\r" if k % 4 == 0 else "plain word " + "x" * k, ""]
        out.append((f"d{k:02d}", "s" if k < 30 else None, "\n".join(lines), 7))
    return out + [("e1", "s", None, 7), ("e2", "s", "", 7), ("e3", "t", "Share this", 7)]


def test_repeated_lines_and_cleaning(spark):
    df = spark.createDataFrame(docs() + docs()[:3], "id string, source string, body string, line int").withColumn("at", F.make_date(F.lit(2026), F.col("line"), F.lit(1)).cast("timestamp"))
    args = ("id", "source", "at", "body")
    got = {tuple(r) for r in L.found_in(df, *args).collect()}
    assert got == {(f"d{k:02d}", 2) for k in range(0, 30, 4)}
    made = L.cleaned(df, *args).collect()
    clean = {r.id: r.body for r in made}
    assert len(made) == len(clean) and set(clean) == {k for k, _ in got} and clean["d00"] == "Story aa itself\n"
    assert L.found_in(df.filter("id = 'zz'"), *args).count() == 0 and L.cleaned(df.filter("id = 'zz'"), *args).count() == 0


def test_deltas_equal_one_count(spark, tmp_path):
    df = spark.createDataFrame(docs(), "id string, source string, body string, line int")
    make = lambda: L.LineIndex(spark, f"file://{tmp_path}/lines", "id", "source", "body")
    first, second = df.filter("id < 'd15'"), df.filter("id >= 'd15'")
    assert make().add(first).count() == 0
    touched = {r[0] for r in make().add(second).collect()}
    assert touched == {f"d{k:02d}" for k in range(0, 30, 4)}  # the old documents with the line that crossed, and the new ones
    before = make()._state()
    make().add(first)
    state = make()._state()
    for n in ("counts", "totals"):  # a batch that comes again counts nothing twice
        assert sorted(map(tuple, spark.read.parquet(state[n]).collect())) == sorted(map(tuple, spark.read.parquet(before[n]).collect()))
    whole = L.count_lines(L.lines_of(df, "id", "source", "body"))
    assert sorted(map(tuple, spark.read.parquet(state["counts"]).select("src", "line", "n").collect())) == sorted(map(tuple, whole[0].collect()))
    assert {tuple(r) for r in make().occurrences().collect()} == {(k, 2) for k in touched}
    more = spark.createDataFrame([(f"n{k}", "s", f"quite other text {'x' * k}", 7) for k in range(200)], df.schema)
    assert {r[0] for r in make().add(more).collect()} == touched  # now it is too rare: its documents get it back
    assert make().repeated().count() == 0
