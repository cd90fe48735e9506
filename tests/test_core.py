import datetime as dt
import json
import sys

import pytest
from pyspark.sql import functions as F

from newsloom.functions import text as X
from newsloom.operators import state, windows
from newsloom.operators.term_match import Terms, first_term
from newsloom.sources import feeds, registry_files


def one(spark, value, *exprs):
    return tuple(spark.createDataFrame([(value,)], "c string").select(*[e(F.col("c")) for e in exprs]).first())


def test_text_functions(spark):
    assert one(spark, "  A　b\n c ", X.squeeze, X.title_key) == ("A b c", "a b c")
    assert one(spark, "<p>a &amp; <b>b</b></p>", X.strip_html) == ("a & b",)
    assert one(spark, "https://X.example/a?UTM_x=1&id=5&oc=2&e=#f", X.canonical_url, X.url_host) == ("https://X.example/a?id=5", "x.example")
    assert one(spark, "&lt;b&gt;x &#8217;&#x4e2d;&eacute; &amp;lt; &nosuch; a&b &#55555555;", X.strip_html) == ("x ’中é &lt; &nosuch; a&b &#55555555;",)
    assert one(spark, "ftp://x/a", X.canonical_url) == ("",)
    assert one(spark, "//x.example/a?utm_q=1&b=a b", X.canonical_url) == ("//x.example/a?b=a+b",) and one(spark, "HTTPS:///a", X.canonical_url) == ("",)
    assert one(spark, "http://x.example/a?b=%41*~&c=1&b=2&utm%5Fz=1", X.canonical_url) == ("http://x.example/a?b=A%2A~&b=2&c=1",)
    click = "http://www.bing.com/news/apiclick.aspx?ref=x&url=https%3a%2f%2fx.example%2fa%3futm_s%3d1%26id%3d7&c=2"
    assert one(spark, click, X.canonical_url) == ("https://x.example/a?id=7",)
    assert one(spark, "Éa, b!", X.slug)[0] == "a-b" and one(spark, "利滩", X.slug)[0].startswith("zh-")
    assert len(one(spark, "x" * 200, X.slug)[0]) == 77
    assert one(spark, None, X.squeeze, X.canonical_url, X.slug, X.skeleton) == (None,) * 4


def test_merge_rows(spark):
    old = spark.createDataFrame([(1, "a", "t"), (2, "b", "t"), (3, "c", "t")], "k int, v string, keep string")
    new = spark.createDataFrame([(2, "b", "n"), (3, None, "n"), (4, "d", "n")], "k int, v string, keep string")
    got = sorted(map(tuple, state.merge_rows(old, new, ["k"], ["keep"]).collect()))
    assert got == [(1, "a", "t", "kept"), (2, "b", "t", "updated"), (3, None, "t", "updated"), (4, "d", "n", "inserted")]


def test_versioned_table_survives_a_failing_write(spark, tmp_path):
    t = state.VersionedTable(spark, f"file://{tmp_path}/t")
    assert t.read() is None
    t.upsert(spark.createDataFrame([(1, "a")], "k int, v string"), ["k"])
    bad = spark.createDataFrame([(1, "z")], "k int, v string").withColumn("v", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        t.replace(bad)
    assert [tuple(r) for r in t.read().collect()] == [(1, "a")]
    t.upsert(spark.createDataFrame([(1, "b"), (2, "c")], "k int, v string"), ["k"])
    assert sorted(tuple(r) for r in t.read().collect()) == [(1, "b"), (2, "c")]


def test_a_stop_between_write_and_marker_loses_nothing(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/t"
    t = state.VersionedTable(spark, path)
    t.replace(spark.range(100).withColumn("v", F.lit("old")))
    monkeypatch.setattr(t.manifest, "write", lambda s: (_ for _ in ()).throw(RuntimeError("stopped")))
    with pytest.raises(RuntimeError):
        t.upsert(spark.createDataFrame([(1, "new")], "id long, v string"), ["id"])
    again = state.VersionedTable(spark, path)
    again.upsert(spark.createDataFrame([(1, "new"), (100, "new")], "id long, v string"), ["id"])
    assert again.read().count() == 101 and again.read().filter("v = 'new'").count() == 2
    assert again.manifest.numbers() == [1, 2]


def test_an_older_row_in_a_later_file_does_not_win(spark, tmp_path):
    from newsloom.streaming.jobs import run_updates, upsert_stream, window_counts

    for name, at, v in (("a", 20, "newer"), ("b", 10, "older")):
        spark.createDataFrame([(1, at, v)], "k int, at int, v string").coalesce(1).write.parquet(f"file://{tmp_path}/in/{name}")
    stream = spark.readStream.schema("k int, at int, v string").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"file://{tmp_path}/in")
    t = state.VersionedTable(spark, f"file://{tmp_path}/t")
    upsert_stream(stream, t, ["k"], "at", "order")
    assert [tuple(r) for r in t.read().select("k", "at", "v").collect()] == [(1, 20, "newer")]
    days = [(dt.datetime(2024, 1, d, 5, tzinfo=dt.timezone.utc),) for d in (1, 1, 2, 9)]
    spark.createDataFrame(days, "ts timestamp").write.parquet(f"file://{tmp_path}/ts")
    stream = spark.readStream.schema("ts timestamp").option("maxFilesPerTrigger", 1).parquet(f"file://{tmp_path}/ts")
    out = run_updates(window_counts(stream, "ts", "1 day", None, [], "10 days"), ["w"], "days")
    assert sorted(r.n for r in out.collect()) == [1, 1, 2]


def test_duplicate_tiers(spark):
    at = lambda d: dt.datetime(2026, 1, d, tzinfo=dt.timezone.utc)
    rows = [("a", "s", at(1), "h", "u1", "u1", "t", None), ("b", "s", at(1), "h", "u2", "u9", "t", "p"), ("c", "s", at(5), "h", "u1", "u1", "x", None),
            ("d", "s", at(6), "k", "u3", "u9", "y", None), ("e", "s", at(7), None, None, "u3", "t", "p"), ("f", None, at(8), "h", "u1", "u1", "t", "p"), ("g", "s", at(9), "", " ", None, "t", None)]
    df = spark.createDataFrame(rows, "id string, s string, at timestamp, h string, c string, u string, t string, p string")
    tiers = {"hash": ["h"], "page": ["c"], "url": ["u"], "title": ["t", "p"]}
    got = sorted(map(tuple, state.duplicate_tiers(df, "id", "s", "at", tiers, {"url": ~F.col("u").eqNullSafe(F.col("c"))}).collect()))
    assert got == [("b", "hash", "a"), ("c", "hash", "b"), ("d", "url", "b"), ("e", "title", "b")]


def test_windows(spark):
    rows = [(dt.datetime(2024, 1, d, 12, tzinfo=dt.timezone.utc),) for d in (2, 3, 4, 31)]
    df = spark.createDataFrame(rows, "ts timestamp")
    got = lambda c: sorted(tuple(r)[1:] for r in windows.windowed(df, "ts", c, "2024-01-03", "2024-02-02").collect())
    assert got("day") == [("day:2024-01-03", "2024-01-03", "2024-01-04"), ("day:2024-01-04", "2024-01-04", "2024-01-05"), ("day:2024-01-31", "2024-01-31", "2024-02-01")]
    assert got("rolling3")[0] == ("rolling3:2024-01-03", "2024-01-03", "2024-01-04") and len(got("rolling3")) == 8
    assert got("week")[0] == ("week:2024-W01", "2024-01-03", "2024-01-08") and got("month")[0] == ("month:2024-01", "2024-01-03", "2024-02-01") and got("year")[0][2] == "2024-02-02"
    with pytest.raises(ValueError):
        windows.windowed(df, "ts", "hour", "2024-01-01", "2024-01-02")


def test_terms(spark):
    terms = [("b", "Big Corp"), ("a", "Big"), ("z", "利滩"), ("y", "利滩银行"), ("c", "BIG corp")]
    t = Terms(terms)
    assert [t.find(x) for x in ("the big corp.", "bigger", "BIG!", "在利滩银行外", "", None)] == ["b", None, "a", "y", None, None]
    t.auto = None
    assert t.find("the big corp.") == "b"
    df = spark.createDataFrame([(1, "big"), (2, None)], "id int, text string")
    ref = spark.createDataFrame(terms, "v string, t string")
    assert sorted(map(tuple, first_term(df, "id", "text", ref, "v", "t", "hit").collect())) == [(1, "a"), (2, None)]


def test_feed_guard_and_bad_payloads(spark):
    rows = ["", None, "<!DOCTYPE html><html>", "plain", "<rss><channel>", '<rss><channel><item><title>A &amp; B</title><guid>https://x.example/1</guid><pubDate>Tue, 06 Jan 2026 10:00:00 GMT</pubDate></item><item><title></title></item></channel></rss>']
    at = dt.datetime(2026, 1, 7, tzinfo=dt.timezone.utc)
    df = spark.createDataFrame([(i, p, at) for i, p in enumerate(rows)], "id int, p string, at timestamp")
    assert [r[0] for r in df.orderBy("id").select(feeds.feed_errors(F.col("p"))).collect()] == ["empty", "empty", "html_page", "not_xml", "malformed", None]
    got = feeds.xml_items(df, "p", "rss", ["id"], "at").collect()
    assert [(r.id, r.title, r.url, r.published_at) for r in got] == [(5, "A & B", "https://x.example/1", "2026-01-06T10:00:00+00:00")]
    js = [json.dumps({"data": [{"title": "T", "url": "https://x.example/1", "source": {"name": "Pub"}}, {"title": "no url"}, 5]}), "nonsense", "[]", None]
    df = spark.createDataFrame([(i, p, at) for i, p in enumerate(js)], "id int, p string, at timestamp")
    assert [(r.id, r.summary, r.timestamp_quality) for r in feeds.json_items(df, "p", feeds.FEEDS["marketaux"], ["id"], "at").collect()] == [(0, "Pub：T", "unknown")]


def test_registry_and_catalogue(spark, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps({"sources": [{"id": "a", "name": "A", "lane": "signal", "phase1_disposition": "migrate_phase1"}, {"id": "b", "name": "B", "lane": "odd"}, {"id": "c", "name": "C", "lane": "signal", "enabled": False}]}))
    good, bad = registry_files.read_registry(spark, f"file://{tmp_path}/r.json")
    assert {r.source_id: r.trust_tier for r in good.collect()} == {"a": 2, "c": 2} and [r.source_id for r in bad.collect()] == ["b"]
    cat = spark.createDataFrame([("a", "A2", 7), ("x", "X", 1)], "source_id string, name string, max_items int")
    assert [(r.source_id, r.name, r.max_items) for r in registry_files.merge_catalogue(good, cat).collect()] == [("a", "A2", 7)]
    paths = registry_files.write_view(good.select("source_id"), f"file://{tmp_path}/out", "view", "2026-01-02T03:04:05")
    assert paths[1].endswith("2026/01/02/030405Z/view") and spark.read.json(paths[0]).count() == 2


def test_release_items(spark):
    payload = {"events": [{"id": "1", "createdAt": "2026-01-02T00:00:00Z", "sourceId": "s", "sourceLabel": "L", "textEn": "CPI", "metadata": {"releaseDateApproximate": True, "consensus": {"actual": 1.5}}}, {"id": "2", "createdAt": "2027-01-01T00:00:00Z"}]}
    df = spark.createDataFrame([(json.dumps(payload),), ("bad",)], "p string")
    got = registry_files.release_items(df, "p", "2026-01-02 00:00:00", "2026-12-31 00:00:00").collect()
    assert [(r.title, r.summary, r.timestamp_quality) for r in got] == [("CPI", "L | actual 1.5", "estimated")]


def test_core_never_imports_llm():
    import subprocess

    code = "import sys, newsloom.registry as r; assert r.queries() and not [m for m in sys.modules if m.startswith('newsloom.llm')]"
    assert subprocess.run([sys.executable, "-c", code], cwd=str(__import__("pathlib").Path(__file__).parent.parent)).returncode == 0


def test_every_oracle_has_a_query():
    from newsloom import registry

    assert set(registry.oracles()) <= set(registry.queries())


def test_private_folder_only_in_local_sessions(spark, monkeypatch):
    from newsloom import session

    class Bare:
        """A session without the setting."""

        def __init__(self, master):
            self.conf, self.sparkContext = self, self
            self.master, self.applicationId = master, "test-app"

        def get(self, *_):
            return None

        def getConf(self):
            return self

    first = session.shared_dir(Bare("local[2]"))
    assert first.startswith("file:///") and session.shared_dir(Bare("local[2]")) == first
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Bare("spark://host:7077"))
