import json
import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from siftgrade.functions.text import GENERIC_EN
from siftgrade.operators import classify, engine, predicate, rules

ITEMS = [
    (0, "手机号", "客户/个人/基础身份信息", "S2", "手机号,电话,phone,tel,mobile,number", r"\b1[3-9]\d{9}\b"),
    (1, "身份证号", "客户/个人/基础身份信息/身份标识", "S3", "身份证,身份证号,id,id_number", r"\b[0-9]{17}[0-9Xx]\b"),
]
SCHEMA = "ord int, field_name string, category string, level string, keywords string, regexes string"
CASES = [  # key, table, field, comment, sample -> score, tags, level, rule id, marker, confidence
    ("G1", "t_user", "mobile_phone", "手机号", "13812345678", "5.5", "T-手机号-s2 KW_EN KW_CN VAL_RX", "s2", "U-手机号-s2-H", "手机号", "high"),
    ("G2", "t_user", "PHONE", None, None, "0.5", "T-手机号-s2 KW_EN", "", "", "", "low"),
    ("G3", "t_user", "cust_tel", None, None, "1.0", "T-手机号-s2 KW_EN", "s2", "U-手机号-s2-M", "手机号", "medium"),
    ("G4", "t", "c1", "手机号/身份证", None, "3.0", "T-手机号-s2 KW_CN T-身份证号-s3", "s2", "U-手机号-s2-H", "身份证号", "high"),
    ("G5", "t", "phone_mobile", None, None, "2.0", "T-手机号-s2 KW_EN", "", "", "", "low"),
    ("G7", "t", "id_number", None, None, "2.9", "T-手机号-s2 KW_EN T-身份证号-s3 GEN_EN KW_CN", "s2", "U-手机号-s2-H", "身份证号", "high"),
    ("G8", "t", None, "电话", None, "1.5", "T-手机号-s2 KW_CN", "s2", "U-手机号-s2-M", "手机号", "medium"),
    ("G9", "t", "order_no", "订单", "A1", "0.0", "", "", "", "", "low"),
]
ROLES = {"table": "t", "field_en": "f", "field_cn": "c", "value": "v"}


def run(spark, cases, items=ITEMS, how="expression", **kw):
    rows = spark.createDataFrame([c[:5] for c in cases], "k string, t string, f string, c string, v string")
    score, its = rules.rule_tables(spark.createDataFrame(items, SCHEMA), **kw)
    facts = classify.facts(rows, "k", ROLES)
    out = classify.by_expression(facts, score, its) if how == "expression" else classify.by_join(facts, "k", score, its)
    return {r.k: r for r in out.collect()}


@pytest.mark.parametrize("how", ["expression", "join"])
def test_golden_cases(spark, how):
    got = run(spark, CASES, how=how)
    for k, *_, score, tags, level, rid, marker, conf in CASES:
        r = got[k]
        assert (r.score, r.tags, r.level, r.rule_id, r.marker, r.confidence) == (Decimal(score), tags, level, rid, marker, conf), k
    assert got["G4"].category == "客户/个人/基础身份信息/身份标识"


@pytest.mark.parametrize("how", ["expression", "join"])
def test_level_of_rank_zero_keeps_the_marker(spark, how):
    r = run(spark, [("G6", "t", "x", "手机号电话", None)], [(0, "手机号", "a/b", "S5", ITEMS[0][4], "")], how)["G6"]
    assert (r.score, r.tags, r.level, r.rule_id, r.marker, r.confidence, r.matched) == (Decimal("3.0"), "T-手机号-s5 KW_CN", "", "", "手机号", "low", True)


def test_without_regexes(spark):
    r = run(spark, CASES[:1], drop_regex=True)["G1"]
    assert r.score == Decimal("3.5") and "VAL_RX" not in r.tags and r.confidence == "high"


def test_invalid_regexes_and_empty_rows(spark):
    items = [(0, "a", "x/y", "S1", "", "[,(.+"), (1, None, "x", "S1", "kw", ""), (2, "b", " ", "S1", "kw", "")]
    assert run(spark, [("n", None, None, None, "kw")], items)["n"].tags == ""
    assert run(spark, [], ITEMS) == {}


def scored(row, items):
    """A plain scorer of one row, for comparison."""
    tok = lambda s: " ".join(re.findall("[a-z]+", (s or "").lower()))
    t, f, c, v = (row[i] or "" for i in (1, 2, 3, 4))
    f, c = f.strip(), c.strip() or f.strip()
    score, tags = Decimal(0), []
    for _, field, cat, level, kws, rx in items:
        field, level = field.lower(), level.lower()
        kws = sorted({k.strip() for k in kws.lower().split(",") if k.strip()})
        item = f"T-{field[:8]}-{level}"
        en = [k for k in kws if re.fullmatch("[a-z]+", k)]
        fired = [(k, x, y) for x, y in ((tok(t), tok(f)), (t, f)) for k in en if k in x or k in y]
        hits = [("GEN_EN", "0.2") if k in GENERIC_EN else ("KW_EN", "0.5") for k, _, _ in fired]
        hits += [("KW_CN", "1.5") for k in kws if k not in en and k in c]
        hits += [("VAL_KW", "1.0") for k in kws if k in v]
        hits += [("VAL_RX", "2.0")] if rx and re.search(rx, v) else []
        for tag, w in hits:
            score += Decimal(w)
            tags += [x for x in (item, tag) if x not in tags]
    return score, " ".join(tags)


def test_both_plans_agree_with_a_plain_scorer(spark):
    pick = random.Random(7)
    words = ["phone", "id", "tel", "手机号", "身份证", "x1", "name", "id_number", "PHONE", "电话"]
    text = lambda: pick.choice([None, "", *("_".join(pick.sample(words, pick.randint(1, 3))) for _ in range(6))])
    cases = [(str(i), text(), text(), text(), pick.choice([None, "13812345678", "phone", "电话1"])) for i in range(150)]
    a, b = run(spark, cases), run(spark, cases, how="join")
    for row in cases:
        assert (a[row[0]].score, a[row[0]].tags) == scored(row, ITEMS)
        assert a[row[0]].asDict() == b[row[0]].asDict()


def test_extra_columns_and_split_levels(spark):
    df = spark.createDataFrame([(1, "a/b//c"), (2, None), (3, "")], "tags int, cat string")
    got = [tuple(r)[2:] for r in classify.split_levels(df, "cat").orderBy("tags").collect()]
    assert got == [("a", "b", "c"), ("", "", ""), ("", "", "")]
    assert classify.split_levels(df.limit(0), "cat").columns == ["tags", "cat"]


def test_headers():
    assert classify.bind_headers(["FieldName", "字段注释 ", "x"]) == {"field_en": "FieldName", "field_cn": "字段注释 ", "value": None, "table": None}


def test_conflicts_fold_in_order(spark):
    cases = {
        "ab": [(50, "a"), (60, "b")], "ba": [(60, "a"), (50, "b")], "same": [(50, "a"), (50, "b")],
        "lost": [(50, "a"), (50, None)], "regained": [(50, "a"), (50, ""), (50, "c")],
    }
    rows = [(i, f, "c", "S1", kw, None, None, f"s{i}", p) for i, (f, p, kw) in enumerate((f, p, kw) for f, rs in cases.items() for p, kw in rs)]
    df = spark.createDataFrame(rows, "ord int, field_name string, category string, level string, keywords string, regexes string, citation string, source string, priority int")
    got = {r.field: (r.keywords, r.priority, r.source) for r in rules.resolve_conflicts(df).collect()}
    assert got == {"ab": ("a", 50, "s0"), "ba": ("b", 50, "s3"), "same": ("a,b", 50, "s5"), "lost": ("", 50, "s7"), "regained": ("c", 50, "s10")}


def test_grouped_builders(spark):
    df = spark.createDataFrame([(1, "f", "Cat/A", "S1", "b, a", "x||y"), (2, "g", "cat/a", "s2", "c", ""), (3, "h", "", "", "z", "q")], SCHEMA)
    assert [tuple(r) for r in rules.category_keywords(df).collect()] == [("cat/a", "C-cat/a", "a,b,c")]
    assert [tuple(r)[:4] for r in rules.level_patterns(df).collect()] == [("s1", "R-s1", 2, 2)]


def test_rules_as_json_run_as_predicates(spark):
    score, items = rules.rule_tables(spark.createDataFrame(ITEMS, SCHEMA))
    made = [json.loads(r.rule) for r in rules.rules_json(score, items).orderBy("ord").collect()]
    assert len(made) == score.count() + 2 * 2
    facts = spark.createDataFrame([(2.0, "T-手机号-s2 KW_CN"), (0.9999999, "T-手机号-s2 KW_EN"), (0.9, "")], "score double, hit_tags string")
    decide = [m for m in made if m["actions"][0]["name"] == "set_suggested_category"]
    got = facts.select(*(predicate.compile_tree(m["conditions"], {"score": F.col("score"), "hit_tags": F.col("hit_tags")}) for m in decide[:2])).collect()
    assert [tuple(r) for r in got] == [(True, False), (False, True), (False, False)]


def test_predicates(spark):
    df = spark.createDataFrame([("Ab", 1.0), (None, None), ("", 3.0)], "s string, n double")
    v = {"s": F.col("s"), "n": F.col("n")}
    one = lambda name, op, value=None: [r[0] for r in df.select(predicate.compile_tree({"any": [{"name": name, "operator": op, "value": value}]}, v)).collect()]
    assert one("s", "equal_to_case_insensitive", "aB") == [True, False, False]
    assert one("s", "starts_with", "A") == [True, False, False] and one("s", "ends_with", "b") == [True, False, False]
    assert one("s", "non_empty") == [True, False, False] and one("n", "greater_than", 1) == [False, False, True]
    assert one("n", "less_than_or_equal_to", 1) == [True, False, False]
    nested = {"all": [{"any": [{"name": "s", "operator": "contains", "value": "b"}]}, {"all": [{"name": "n", "operator": "less_than", "value": 2}]}]}
    assert [r[0] for r in df.select(predicate.compile_tree(json.dumps(nested), v)).collect()] == [True, False, False]
    with pytest.raises(ValueError):
        predicate.compile_tree({"all": []}, v)
    with pytest.raises(ValueError):
        predicate.compile_tree({"name": "zz", "operator": "contains", "value": ""}, v)
    assert len(predicate.conditions_of(nested)) == 2
    assert predicate.valid_patterns(spark, ["a", "(", "[x"]) == {"a"}
    assert predicate.metadata(spark).count() == 9 + 7 + 5 + 7


def test_executable_rules_decide_as_the_tables_do(spark, tmp_path):
    score, items = rules.rule_tables(spark.createDataFrame(ITEMS, SCHEMA))
    made = rules.rules_json(score, items).orderBy("ord")
    path = str(tmp_path / "rules.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump([json.loads(r.rule) for r in made.collect()], f)
    rows = spark.createDataFrame([c[:5] for c in CASES], "k string, t string, f string, c string, v string")
    facts = classify.facts(rows, "k", ROLES)
    got = {r.k: r for r in engine.run_rules(facts, engine.load_rules(spark, path)).collect()}
    want = {r.k: r for r in classify.by_expression(facts, score, items).collect()}
    for k, w in want.items():
        for c in ("tags", "category", "level", "rule_id", "marker", "confidence", "matched"):
            assert got[k][c] == w[c], (k, c)
        assert got[k].score == pytest.approx(float(w.score))


def test_hand_written_rules(spark):
    cond = lambda name, op, value: {"any": [{"name": name, "operator": op, "value": value}]}
    act = lambda name, **params: {"name": name, "params": params}
    made = [
        {"conditions": cond("field_name", "contains", "a"), "actions": [act("add_score", value=1.25), act("add_hit", tag="A"), act("append_audit", citation="c", source="s")]},
        {"conditions": cond("score", "greater_than", 1), "actions": [act("add_score", value=0.5), act("add_hit", tag="B")]},
        {"conditions": cond("field_name", "matches_regex", "("), "actions": [act("add_score", value=9)]},
        {"conditions": cond("hit_tags", "contains", "B"), "actions": [act("set_classification", level="S3", rule_id="x-M"), act("set_suggested_category", category="p")]},
        {"conditions": cond("hit_tags", "contains", "A"), "actions": [act("set_classification", level="S1", rule_id="y-H"), act("set_data_marker", marker="m")]},
        {"conditions": cond("category_path", "equal_to", "p"), "actions": [act("set_classification", level="S9", rule_id="z"), act("set_category_rule_id", rule_id="w-H")]},
        {"conditions": cond("field_name", "non_empty", None), "actions": [act("set_suggested_category", category="never run")]},
    ]
    rows = spark.createDataFrame([("1", None, "ab", None, None), ("2", None, "b", None, None)], "k string, t string, f string, c string, v string")
    a, b = engine.run_rules(classify.facts(rows, "k", ROLES), made).orderBy("k").collect()
    assert (a.score, a.tags, a.level, a.rule_id, a.category, a.marker, a.confidence) == (1.75, "A B", "S1", "w-H", "p", "m", "high")
    assert a.matched_rule_ids == ["y-H", "x-M", "z"] and json.loads(a.audits) == {"citation": "c", "source": "s"}
    assert (b.score, b.tags, b.matched, b.confidence) == (0.0, "", False, "low")
    first = engine.run_rules(classify.facts(rows, "k", ROLES), made, stop_first=True).where("k = '1'").first()
    assert first.level == "S1" and first.rule_id == "y-H" and first.category == ""


def test_extraction_and_expressions(spark):
    schema = "doc_ord int, source string, extraction array<struct<path:array<string>,citation:struct<page:int,text:string>,items:array<struct<name:string,level:string,patterns:struct<keywords_cn:array<string>,keywords_en:array<string>,regex:array<string>>>>>>"
    item = lambda n, p: (n, "S1", p)
    docs = [(2, "b", [(["x", "", None, "y"], (1, "t"), [item("f", (["甲"], ["k", "k2"], ["a", "b"])), item("g", None)])]), (1, "a", [(["z"], None, [item("h", (None, ["q"], None))]), (None, None, None)]), (3, "c", None)]
    got = [tuple(r)[1:] for r in rules.flatten_extraction(spark.createDataFrame(docs, schema)).orderBy("ord").collect()]
    assert got == [("h", "z", "S1", "q", "", None, "a", 50), ("f", "x/y", "S1", "甲,k,k2", "a||b", '{"page":1,"text":"t"}', "b", 50), ("g", "x/y", "S1", "", "", '{"page":1,"text":"t"}', "b", 50)]
    row = "ord int, field_name string, category string, level string, keywords string, regexes string, citation string, source string, priority int, condition string, exception string"
    made = [(1, "f", "c", "S1", "", "", "", "", 50, "A", "x"), (2, "f", "c", "S1", "", "", "", "", 50, "b", ""), (3, "F", "c", "S1", "", "", "", "", 50, "a", "y"), (4, "f", "c", "S1", "", "", "", "", 60, "z", "z")]
    out = rules.resolve_conflicts(spark.createDataFrame(made, row)).collect()
    assert [(r.condition, r.exception) for r in out] == [("a OR b", "y")]
    valid = spark.createDataFrame([("a+",), ("(",), (None,), ("(?<!x)y",)], "p string").select(rules.valid_pattern(F.col("p")).alias("v")).collect()
    assert [r.v for r in valid] == [True, False, False, True]


def test_hot_join_and_needles(spark, monkeypatch):
    from siftgrade.operators import match

    left = spark.createDataFrame([(i, "" if i % 3 else f"k{i % 7}") for i in range(3_000)], "i int, k string")
    right = spark.createDataFrame([(f"k{i}", i) for i in range(5)], "k string, v int")
    for how in ("inner", "left"):
        want = sorted(map(str, left.join(right, ["k"], how).select("i", "k", "v").collect()))
        for rows in (200_000, 1):
            assert sorted(map(str, match.hot_join(left, right, ["k"], how, rows).select("i", "k", "v").collect())) == want
    texts = spark.createDataFrame([(1, "abcab"), (2, "水库"), (3, ""), (4, None), (5, "zz")], "i int, t string")
    needles = spark.createDataFrame([(w,) for w in ("ab", "b", "bc", "水库", "库", "", "q")], "needle string")
    want = {1: ["ab", "b", "bc"], 2: ["库", "水库"]}
    assert {r.i: sorted(r.needles) for r in match.contained(texts, ["i"], "t", needles).collect()} == {k: sorted(v) for k, v in want.items()}
    monkeypatch.setattr(match, "NEEDLES", 2)
    got = {}
    for r in match.contained(texts, ["i"], "t", needles).collect():
        got.setdefault(r.i, []).extend(r.needles)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    assert match.contained(texts, ["i"], "t", needles.limit(0)).count() == 0
