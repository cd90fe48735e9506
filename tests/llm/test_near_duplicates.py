import itertools
import random

from newsloom.llm import near_duplicates as ND
from newsloom.llm import shingles as S

PLAN = ND.Plan(width=3, threshold=0.5)


def brute(rows, width=3, threshold=0.5):
    sets = {}
    for key, *texts in rows:
        w = S.words("\n".join(t or "" for t in texts))
        sets[key] = {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}
    return {(a, b) for a, b in itertools.combinations(sorted(sets), 2) if sets[a] and sets[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= threshold}


def made(n, seed=1):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(3000)] + list("利滩海岳价格上限")
    rows = []
    for k in range(n):
        if rows and r.random() < 0.4:
            w = r.choice(rows)[2].split()
            for _ in range(r.choice([0, 1, 5, 10])):
                w[r.randrange(len(w))] = r.choice(vocab)
        else:
            w = [r.choice(vocab) for _ in range(r.choice([40, 90, 200]))]
        rows.append((f"a{k:04d}", None if k % 3 else "Title", " ".join(w)))
    return rows


def away(rows, found):
    """Pairs far from the threshold, where sampling of keys can be expected to find all."""
    return {p for p in brute(rows, threshold=0.55)} - found


def test_pairs_equal_brute_force(spark):
    rows = made(400)
    df = spark.createDataFrame(rows + rows[:20], "article_id string, title string, body string")
    got = {tuple(r) for r in ND.similar_pairs(df, "article_id", ["title", "body"], PLAN).collect()}
    assert got <= brute(rows) and not away(rows, got)


def test_hot_keys_go_to_the_second_level(spark):
    plan = ND.Plan(width=3, threshold=0.5, key_cap=3, run_cap=40)
    rows = made(120, 5) + [(f"z{k}", None, " ".join([f"v{i}" for i in range(60)] + [f"own{k}"])) for k in range(90)]
    df = spark.createDataFrame(rows, "article_id string, title string, body string")
    got = {tuple(r) for r in ND.similar_pairs(df, "article_id", ["title", "body"], plan).collect()}
    assert got <= brute(rows)
    assert len(away(rows, got)) <= 0.002 * len(got)


def test_hot_keys_lose_no_candidates(spark):
    r = random.Random(11)
    texts = []
    for k in range(120):  # similar to about 0.55
        texts.append(" ".join(f"v{i}" if i % 60 < 42 else f"v{i}o{k % 40}x{r.randrange(3)}" for i in range(240)))
    df = spark.createDataFrame([(f"a{k}", t) for k, t in enumerate(texts)], "article_id string, body string")

    def pairs(plan):
        classes = ND.signatures(df, "article_id", ["body"], plan).filter("cid is not null").dropDuplicates(["cid"])
        return {tuple(x) for x in ND.candidates(classes, plan).collect()}

    whole = pairs(ND.Plan(width=3, threshold=0.5, key_cap=10**9))
    assert len(whole) > 1000
    for cap in (3, 10):
        assert not whole - pairs(ND.Plan(width=3, threshold=0.5, key_cap=cap))


def test_later_rows_of_a_cut_run_are_hot_too():
    import numpy as np
    import pyarrow as pa

    plan = ND.Plan(run_cap=10, buffer=5)
    left = np.array([3] * 4 + [7] * 33 + [9] * 3, np.int64)
    rest = np.arange(len(left), dtype=np.int64)
    p0 = left << 32 | 1000 + rest
    others = [(5000 + 100 * i + rest) << 32 | 9000 + 100 * i + rest for i in range(ND._packed(plan) - 1)]
    cols = [p0, *others, np.zeros_like(rest), rest]
    batches = [pa.RecordBatch.from_arrays([pa.array(c[i : i + 3]) for c in cols], names=[f"c{k}" for k in range(len(cols))]) for i in range(0, len(left), 3)]
    out = [r for b in ND._collisions(plan, False)(iter(batches)) for r in b.to_pylist()]
    assert {(r["a"], r["hot"]) for r in out} == {(k, 7 << 32) for k in range(4, 37)}


def test_empty_null_and_clashing_columns(spark):
    schema = "article_id string, rid string, cid int, a string, title string, body string"
    empty = spark.createDataFrame([], schema)
    assert ND.similar_pairs(empty, "article_id", ["title", "body"], PLAN).count() == 0
    long = "x y z " * 20000 + "end"
    df = spark.createDataFrame([("1", "r", 1, "a", None, None), ("2", "r", 1, "a", "", ""), ("3", "r", 1, "a", None, "one two"), ("4", None, None, None, None, long), ("5", None, None, None, None, long)], schema)
    assert [tuple(r) for r in ND.similar_pairs(df, "article_id", ["title", "body"], PLAN).collect()] == [("4", "5")]
