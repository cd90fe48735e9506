from newsloom.llm import canonical_names as C
from newsloom.llm import lookalikes as L


def test_classes_are_transitive_and_case_safe():
    counts = {c: 10 for c in "abcdefghijklmnopqrstuvwxyz ABCE,é"} | {"е": 3, "С": 1, "́": 2, "е́": 1, "é": 1, "ｅ": 1, "ﬁ": 1, "​": 5, " ": 90, "，": 2}
    r = L.Rewriter(L.rewriting(counts))
    assert r.rewrite("ｅ е e") == "e e e" and r.rewrite("е​́ é é") == "é é é" and r.rewrite("ﬁ fi") == "fi fi"
    assert r.key("  САB ") == r.key("cab".upper()) == "cab"
    assert len({r.key(x) for x in ("e", "é", "1", "2", "l")}) == 5 and r.key("​  ") == ""


def test_pairs(spark):
    rows = [("a", "Big news", "big news"), ("b", "Big news ", "big news"), ("c", "Big news", "big news"), ("d", "Big news", "bi​g news"), ("e", "Big newѕ", None), ("f", None, None), ("g", "", ""), ("h", "Bíg news", "bíg news"), ("a", "Big news", "big news")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "article_id string, title string, title_norm string, look string")
    got = {tuple(r) for r in L.equal_looking_pairs(df, "article_id", "title", "title_norm").collect()}
    assert got == {("a", "b"), ("b", "c"), ("a", "d"), ("c", "d"), ("b", "d"), ("a", "e"), ("c", "e"), ("b", "e"), ("d", "e")}
    assert L.equal_looking_pairs(df.filter("title = 'zz'"), "article_id", "title", "title_norm").count() == 0


LIST = [
    ("bratokin_textiles", "Bratokin Textiles"), ("bratokin_textiles", "默登玛纺织"), ("bratokin_textiles", "GZGW"),
    ("lavillum_telecom", "Lavillum Telecom"), ("securities_board_hodugok", "Hodugok Securities Board"), ("pharma_ag", "Klekukmu Pharma"),
    ("steel", "伦古科钢铁"), ("bank", "索玛洛银行"), ("bank", "索玛洛"),
]


def test_matches():
    m = C.Matcher(LIST)
    for name, entry in {
        "bratoikn-Textiles": "bratokin_textiles", "shares of  Bratokin Textiles": "bratokin_textiles", "Textiles, Bratokin": "bratokin_textiles", "默登玛纺等": "bratokin_textiles", "默登​玛紡織（集团）": "bratokin_textiles",
        "$gzgw": "bratokin_textiles", "Lavillum Telecommunications AG": "lavillum_telecom", "HODUGOK": "securities_board_hodugok", "Securities Board, Hodugok": "securities_board_hodugok", "Klekukmu-Pharmaceuticals": "pharma_ag",
        "XXXX - Klekumku Pharma": "pharma_ag", "伦古科鋼鐵": "steel", "索玛洛集团": "bank", "Bratokin": "bratokin_textiles",
        "Bratokin Steel": C.UNMATCHED, "索玛洛制药": C.UNMATCHED, "Steel Group": C.UNMATCHED, "多家银行": C.UNMATCHED, "": C.UNMATCHED, " ": C.UNMATCHED, "the group": C.UNMATCHED, "x" * 5000: C.UNMATCHED,
    }.items():
        assert m.match(name) == entry, (name, m.match(name))
    assert m.match(None) == C.UNMATCHED and C.Matcher([]).match("Bratokin") == C.UNMATCHED


def test_map_names(spark):
    ref = spark.createDataFrame([(a, b, "n") for a, b in LIST] + [(None, "x", None), ("e", None, "n")], "canonical_id string, alias string, id string")
    df = spark.createDataFrame([(1, "bratokin textiles", "z"), (2, None, "z"), (2, None, "z")], "id bigint, entity_name string, canonical_id string")
    assert sorted(map(tuple, C.map_names(df, "id", "entity_name", ref, "canonical_id", ["alias"]).collect())) == [(1, "bratokin_textiles"), (2, "unmatched")]
    assert C.map_names(df.filter("id > 5"), "id", "entity_name", ref, "canonical_id", ["alias"]).count() == 0
