import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from newsloom.operators import classify, extract, ingest, state, timestamps
from newsloom.plans import entities, relational, views
from newsloom.sources import feeds, posts

AT = dt.datetime(2026, 1, 7, 12, tzinfo=dt.timezone.utc)


def test_post_rules(spark):
    long = "x" * 200
    rows = [("Rerisi Bank has an order", "Rerisi Bank", "Ann"), ("Rerisi Bank giveaway order", "Rerisi Bank", "Ann"), ("Rerisi Bank 1% 2.5% 3% order", "Rerisi Bank", "Ann"), ("an order", "Rerisi Bank", "Ann"),
            ("Rerisi Bank has an order", "Rerisi Bank", "Rerisi Bank official"), ("I hear that Rerisi Bank has an order", "Rerisi Bank", "Rerisi Bank official"), ("Rerisi Bank profit", "Rerisi Bank", None), (f"Rerisi Bank profit {long}", "Rerisi Bank", "a"),
            ("Rerisi Bank says nothing", "Rerisi Bank", "a"), (None, "Rerisi Bank", "a"), ("text", None, "a"), ("", "", "")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, t string, target string, who string").orderBy("i")
    got = [r[0] for r in df.select(posts.keep_post(F.col("t"), F.col("target"), F.col("who"))).collect()]
    assert got == [True, False, False, False, False, True, True, False, False, False, False, False]


def test_cards_lists_and_boards(spark):
    card = {"data": {"cards": [{"mblog": {"text": "<b>a</b> &amp; b", "user": {"screen_name": "Ann"}, "id": "1"}}, 5, {"card_group": [{"mblog": {"text": "c", "bid": "B"}}, {"card_group": [{"mblog": {"text": "d", "id": "3"}}]}]}]}}
    df = spark.createDataFrame([(1, json.dumps(card)), (2, "bad"), (3, None), (4, "[]")], "k int, p string")
    assert sorted(map(tuple, posts.card_posts(df, "p", ["k"]).collect())) == [(1, "a & b", "Ann", "1"), (1, "c", "", "B"), (1, "d", "", "3")]
    lists = [{"items": [{"title": "t", "text": "x", "id": 1}]}, {"data": {"list": [{"data": json.dumps({"description": "y", "id": "2"})}]}}, {"other": []}]
    df = spark.createDataFrame([(i, json.dumps(x)) for i, x in enumerate(lists)], "k int, p string")
    assert sorted(map(tuple, posts.listed_posts(df, "p", ["k"]).collect())) == [(0, 1, "t", "x", "", "1"), (1, 1, "", "y", "", "2")]
    html = '<table><tr class="listitem"><td class="title"><a href="/a?x=1">A <i>b</i></a></td><td class="read">3</td></tr><tr class="listitem"><td class="title">no link</td></tr><tr><td class="title"><a href="/n">n</a></td></tr>'
    df = spark.createDataFrame([(1, html), (2, ""), (3, None)], "k int, p string")
    assert [tuple(r) for r in posts.board_rows(df, "p", "k", "https://b.example/l").collect()] == [(1, 0, "https://b.example/a?x=1", "A b", "", "3", "")]


def test_counts_and_symbols(spark):
    c = [("1.2万", 12000), ("1,234", 1234), ("3k", 3000), ("2亿", 200000000), ("赞", 0), ("", 0), (None, 0), ("10+", 10)]
    df = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(c)], "i int, t string").orderBy("i")
    assert [r[0] for r in df.select(posts.count_of(F.col("t"))).collect()] == [n for _, n in c]
    s = [("700.hk", "", "HK00700"), ("1.SZ", None, "SZ000001"), ("600000", "CN", "SH600000"), ("1", "CN", "SZ000001"), ("700", "HK", "HK00700"), (" abc ", "CN", "ABC"), (None, "CN", ""), ("sh600000", None, "SH600000")]
    df = spark.createDataFrame([(i, t, r) for i, (t, r, _) in enumerate(s)], "i int, t string, r string").orderBy("i")
    assert [r[0] for r in df.select(posts.symbol_of(F.col("t"), F.col("r"))).collect()] == [x for *_, x in s]


def test_dispatch_isolates_bad_payloads(spark):
    good = json.dumps([{"TITLE": "T", "URL": "https://x.example/1"}])
    df = spark.createDataFrame([(1, "govcn", good, AT), (2, "govcn", "{", AT), (3, "odd", good, AT), (4, None, good, AT), (5, "rss", "<rss><a>", AT), (6, "govcn", None, AT)], "k int, kind string, p string, at timestamp")
    items, errors = posts.dispatch(df, "kind", "p", ["k"], "at", ["rss", "govcn"])
    assert [(r.k, r.title) for r in items.collect()] == [(1, "T")]
    assert sorted((r.k, r.error) for r in errors.collect()) == [(2, "not_json"), (3, "unknown_kind"), (4, "unknown_kind"), (5, "malformed"), (6, "not_json")]
    six = posts.first_items(spark.createDataFrame([(1, i) for i in range(6)], "k int, pos int"), ["k"], "pos", 2)
    assert sorted(map(tuple, six.collect())) == [(1, 0), (1, 1)]


def test_field_times_and_month_days(spark):
    rows = [("2026-01-02", "03:04", 1767294240, False), ("2026年1月2日", None, 1767326400, True), ("2026/01/02 03:04:05", "", 1767294245, False), ("2026-02-30", None, None, True), ("soon", "x", None, False), (None, None, None, False)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b, *_) in enumerate(rows)], "i int, d string, h string")
    got = timestamps.field_times(df, F.col("d"), F.col("h"), "Asia/Shanghai").orderBy("i").collect()
    assert [r.sec for r in got] == [s for *_, s, _ in rows] and [r.dated for r in got if r.sec] == [False, True, False]
    cases = [("01-05 10:00", "2026-01-05T02:00"), ("12-31", "2025-12-30T16:00"), ("01-09 09:00", "2026-01-09T01:00"), ("01-12", "2025-01-11T16:00"), ("02-29", None), ("昨天 08:00", "2026-01-06T00:00"), ("13-40", None), ("", None), (None, None)]
    df = spark.createDataFrame([(i, t, AT) for i, (t, _) in enumerate(cases)], "i int, t string, at timestamp")
    out = timestamps.recent_month_day(df, F.col("t"), F.col("at"), "Asia/Shanghai").orderBy("i").collect()
    assert [r.sec and dt.datetime.fromtimestamp(r.sec, dt.timezone.utc).strftime("%Y-%m-%dT%H:%M") for r in out] == [x for _, x in cases]


def test_ingest_health(spark):
    kept = spark.createDataFrame([(1, "a", "old"), (2, "a", "same")], "id int, src string, v string")
    batch = spark.createDataFrame([(1, "a", "new"), (2, "a", "same"), (3, "a", "x"), (3, "a", "x"), (4, "b", None), (5, "b", None), (6, "c", None), (7, "c", "y")], "id int, src string, v string")
    table, rejects, health = ingest.persist(kept, batch, "id", "src", {"no_value": F.col("v").isNull()})
    assert sorted((r.id, r.v) for r in table.collect()) == [(1, "new"), (2, "same"), (3, "x"), (7, "y")] and rejects.count() == 3
    assert sorted(map(tuple, health.select("src", "delivered", "inserted", "updated", "same", "rejected", "fault", "status").collect())) == [("a", 4, 1, 1, 1, 0, None, "ok"), ("b", 2, 0, 0, 0, 2, "no_value", "down"), ("c", 2, 1, 0, 0, 1, "no_value", "degraded")]
    assert ingest.persist(kept, batch.limit(0), "id", "src", {"no_value": F.col("v").isNull()})[2].count() == 0


def test_replay_goes_on_where_it_stopped(spark, tmp_path):
    t, calls = state.VersionedTable(spark, f"file://{tmp_path}/p"), []

    def make(name, bad=False):
        def run():
            calls.append(name)
            if bad:
                raise ValueError("no")
            return 7

        return run

    first = ingest.resume(t, {"a": make("a"), "b": make("b", True), "c": make("c")})
    assert sorted((r.run_key, r.status) for r in first.collect()) == [("a", "ok"), ("b", "failed")]
    again = ingest.resume(state.VersionedTable(spark, f"file://{tmp_path}/p"), {"a": make("a"), "b": make("b"), "c": make("c")})
    assert calls == ["a", "b", "b", "c"] and sorted((r.run_key, r.status, r.attempts, r.n) for r in again.collect()) == [("a", "ok", 1, 7), ("b", "ok", 2, 7), ("c", "ok", 1, 7)]


def test_names(spark):
    t = ["Exclusive: Rerisi Securities and Drotrur Bank agree", "更新：佩塔软件与纳兰埃银行合作", "Faklumbu Monetary Office weighs", "贝巴卡统计局文件", "nothing here", "", None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(t)], "i int, t string").orderBy("i")
    got = df.select(extract.headline_entity(F.col("t")), extract.headline_institution(F.col("t")), extract.looks_like_company(F.col("t"))).collect()
    assert [r[0] for r in got] == ["Rerisi Securities", "佩塔软件", None, None, None, None, None]
    assert [r[1] for r in got] == [None, None, "Faklumbu Monetary Office", "贝巴卡统计局", None, None, None] and got[5][2] is False and got[6][2] is None
    df = spark.createDataFrame([("a", "Wins a bid", None, "s_x", "signal", "mixed", AT, None), ("b", "lol", "", "s", "signal", "mixed", AT, "e"), ("c", "quiet", None, "s", "confirmation", "company", AT, None)], "id string, title string, summary string, source_id string, lane string, coverage_scope string, collected_at timestamp, entity string")
    assert sorted((r.id, r.kind, r.action) for r in classify.classify(df).collect()) == [("a", "contract_order", "order"), ("b", "social_signal", "signal"), ("c", "company_action", "general_update")]
    al = spark.createDataFrame([("company", "z", "AB"), ("company", "z", "AB1"), ("company", "y", "Abcd"), ("company", "x", "ABCD "), ("company", "w", "银行"), ("company", "v", "银"), ("company", None, "long name"), ("company", "u", None)], "entity_type string, canonical_id string, alias string")
    assert sorted((r.canonical_id, r.alias) for r in entities.admitted_aliases(al).collect()) == [("w", "银行"), ("x", "ABCD"), ("z", "AB1")]


def test_state_is_carried_by_shared_articles(spark):
    old = spark.createDataFrame([("a", "mapped"), ("b", "rejected"), ("c", "new")], "event_id string, s string")
    old_links = spark.createDataFrame([("b", "1"), ("b", "2"), ("c", "2"), ("c", "3"), ("c", "3")], "event_id string, article_id string")
    new = spark.createDataFrame([("a",), ("x",), ("y",)], "event_id string")
    new_links = spark.createDataFrame([("x", "1"), ("x", "2"), ("x", "3")], "event_id string, article_id string")
    got = sorted(map(tuple, views.carry_state(old, old_links, new, new_links, ["s"]).collect()))
    assert got == [("a", "a", "mapped"), ("x", "b", "rejected"), ("y", None, None)]
    with pytest.raises(KeyError):
        posts.PARSERS["odd"]
    assert feeds.FEEDS["serpstack"].also and relational.first_of(new, ["event_id"], [F.col("event_id")]).count() == 3
