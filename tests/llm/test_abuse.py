import random

from newsloom.llm import abuse as A

GOOD = ["shares of {n} gained in late trading", "the board of {n} approved the plan", "workers in {n} accepted the offer", "the plant near {n} reopens in may"]
BAD = ["nobody would miss you at all you worthless clown", "people like you should be thrown out of {n} by force", "你就是个没用的废物早点滚出去"]


def corpus(n, seed):
    r = random.Random(seed)
    rows = []
    for k in range(n):
        lines = [r.choice(GOOD).format(n=f"Name{r.randrange(40)}") + "." for _ in range(4)]
        bad = r.random() < 0.3
        if bad:
            t = r.choice(BAD).format(n=f"Name{r.randrange(40)}")
            lines.insert(r.randrange(4), r.choice([t, t.upper() + "!!", t.replace("o", "0"), "​".join(t)]))
        rows.append((k, "\n".join(lines), bad))
    return rows


def test_held_out_documents(spark):
    rows = corpus(400, 1)
    extra = [(9000, None, False), (9001, "", False), (9002, " \n ", False), (9003, "the board of Name1 approved the plan. " * 4000, False)]
    docs = spark.createDataFrame([(k, t, "s", 1.0) for k, t, _ in rows + extra + rows[:3]], "doc_id bigint, text string, source string, score double")
    labels = spark.createDataFrame([(k, "abusive" if b else "clean") for k, _, b in rows[:200]] + [(5, None), (77777, "abusive")], "doc_id bigint, label string")
    out = A.score(docs, labels, "doc_id", "text", "label", keep=["source"]).collect()
    assert len(out) == len({r.doc_id for r in out}) == 404
    got = {r.doc_id: r for r in out}
    held = rows[200:]
    assert sum(got[k].is_case == b for k, _, b in held) >= 0.97 * len(held)
    assert sum(got[k].is_case == b for k, _, b in rows[:200]) >= 194  # no label is copied
    assert all(got[k].score == 0 and got[k].near is None for k in (9000, 9001, 9002)) and not got[9003].is_case
    rate = A.rates(A.score(docs, labels, "doc_id", "text", "label", keep=["source"]), "source").collect()
    assert rate[0].docs == 404 and rate[0].cases == sum(r.is_case for r in out)


def test_common_wording_of_flagged_documents_is_no_evidence(spark):
    """A line that by chance stands in flagged reviewed documents only, but in many others too."""
    rows = corpus(600, 6)
    ids = {k for k, _, _ in rows[:150]}
    noise = "Qorvex ledger bulletin number seven is out"
    texts = {k: t + (f"\n{noise}" if (k in ids and b and k % 4 == 0) or (k not in ids and not b and k % 3 == 0) else "") for k, t, b in rows}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, "abusive" if b else "clean") for k, _, b in rows[:150]], "doc_id bigint, label string")
    got = {r.doc_id: r.is_case for r in A.score(docs, labels, "doc_id", "text", "label").collect()}
    held = rows[150:]
    assert sum(got[k] == b for k, _, b in held) >= 0.97 * len(held)
    assert A.reliability([(1, 20, 0, 40), (2, 0, 0, 90), (3, 5, 9, 10), (4, 0, 0, 0)], A.Votes()).keys() == {1, 2, 3, 4}
    factor = A.reliability([(1, 20, 0, 40), (2, 0, 0, 90), (3, 5, 9, 10)], A.Votes())
    assert factor[1] == 1 and factor[2] < 0.2 and factor[3] < 0.2 and A.reliability([], A.Votes()) == {}


def test_without_labels_or_documents(spark):
    docs = spark.createDataFrame([(1, "some text"), (2, None)], "doc_id bigint, text string")
    labels = spark.createDataFrame([], "doc_id bigint, label string")
    assert [r.score for r in A.score(docs, labels, "doc_id", "text", "label").collect()] == [0.0, 0.0]
    assert A.score(docs.filter("doc_id > 5"), labels, "doc_id", "text", "label").count() == 0


def test_neighbours_equal_brute_force(monkeypatch):
    import numpy as np

    monkeypatch.setattr(A, "RANGE", 8)
    v = A.Votes(least=0.3, k=5)
    rows = corpus(80, 3)
    ix = A.Index(rows, v)
    reader = A.Reader(ix.terms)
    dense = np.zeros((len(ix.doc), len(ix.idf)), np.float32)
    dense[np.repeat(np.arange(len(ix.doc)), np.diff(ix.at)), ix.flat] = ix.weight
    flat, row, _ = reader.passages([t for _, t, _ in corpus(20, 8)], v)
    met_some = 0
    for p in range(row[-1] + 1):
        terms = np.unique(flat[(row == p) & (flat >= 0)])
        if not len(terms):
            continue
        w = (ix.idf[terms] / np.sqrt((ix.idf[terms] ** 2).sum())).astype(np.float32)
        cos, met = ix.neighbours(terms, w, -1, v, v.k)
        all_cos = dense[:, terms] @ w
        if all_cos[ix.bad].max(initial=0) < v.least:
            assert not len(met)
            continue
        met_some += 1
        want = np.sort(all_cos)[::-1]
        want = want[want >= v.least]
        want = want[: max(v.k, int((want >= want[v.k - 1] - 1e-6).sum()))] if len(want) > v.k else want
        assert len(cos) == len(want) and np.allclose(cos, want, atol=1e-5)
    assert met_some > 5
