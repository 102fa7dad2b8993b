import json

from pyspark.sql import functions as F

from siftgrade.functions import text as T
from siftgrade.operators import evaluate, fragments, labels, nested, retrieval, taxonomy
from siftgrade.plans import guides


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first().y


def test_text_functions(spark):
    assert one(spark, "　 a\n", T.strip) == "a" and one(spark, None, T.norm) == ""
    assert one(spark, "Cust_Tel2No", T.tokens) == "cust tel no"
    assert one(spark, "a\\b / /c", T.normalize_category) == "a/b/c"
    assert one(spark, " a　\n\tb ", T.clean_cell) == "a b"
    assert one(spark, "1.2.3  Scope", T.title_level) == "1.2.3" and one(spark, "1.2.3", T.title_level) == ""
    assert one(spark, "x/y.z/guide.v2.PDF", T.stem) == "guide.v2" and one(spark, "a/b.PDF", T.extension) == "pdf"
    assert one(spark, "a b\\c//", T.class_parts) == ["ab", "c"]
    assert one(spark, "  ", T.blank_to_null) is None


def test_paragraphs(spark):
    lines = ["1 Scope", "aa", "bb", "1.1 Terms", "cc", "", "dd"]
    df = spark.createDataFrame([(1, i, x) for i, x in enumerate(lines)], "d int, ord int, line string")
    got = fragments.paragraphs(df, "d").orderBy("first_ord").collect()
    assert [r.text for r in got] == ["1 Scope", "aa bb", "1.1 Terms", "cc", "dd"]
    assert [r.level for r in got] == ["1", "", "1.1", "", ""] and got[0].type == "title"
    said = fragments.guide_text(fragments.paragraphs(df, "d"), "d", 5).first()
    assert said.guide_text.startswith("1 Scope\n\naa bb") and said.too_long
    assert fragments.paragraphs(df.limit(0), "d").count() == 0


def test_down_fill_and_groups(spark):
    rows = [["维度", "类别", "类别", "系统"], ["路线", "基本", "x", "s1"], ["", "阻断", "y", None], ["", "", "", ""], ["桥", "b", "z"]]
    df = spark.createDataFrame([(1, i, r) for i, r in enumerate(rows)], "t int, o int, cells array<string>")
    long = df.select("t", "o", F.posexplode("cells").alias("c", "v"))
    filled = {(r.o, r.c): r.v for r in fragments.down_fill(long, "t", "o", "c", "v").collect()}
    assert filled[2, 0] == "路线" and filled[2, 3] == "s1" and filled[3, 1] == "阻断"
    got = {r.group: r for r in fragments.row_groups(df, "t", "o", "cells").collect()}
    assert list(got) and got["路线"].rows == ['{"类别":"x","系统":"s1"}'] and got["未命名"].first_ord == 2 and got["桥"].rows == ['{"类别":"z","系统":""}']
    head = spark.createDataFrame([(["字段名 ", "x"],), (["y"],)], "h array<string>")
    assert [r[0] for r in head.select(fragments.is_field_table(F.col("h"))).collect()] == [True, False]


def test_retrieval(spark):
    frags = spark.createDataFrame([(1, "zz", 1), (2, "common", 1), (3, "alpha common", 2), (4, "alpha beta", 2), (5, None, 3)], "frag_ord int, text string, page int")
    paths = spark.createDataFrame([(1, ["alpha", "beta"]), (2, ["none"]), (3, ["zz", "zz", ""])], "path_ord int, tokens array<string>")
    top = retrieval.top_fragments(paths, frags, ["common"], 2)
    assert sorted((r.path_ord, r.rank, r.frag_ord, r.score) for r in top.collect()) == [(1, 1, 3, 2), (1, 2, 4, 2), (2, 1, 2, 1), (2, 2, 3, 1), (3, 1, 1, 1), (3, 2, 2, 1)]
    fall = retrieval.top_fragments(paths.where("path_ord = 2"), frags, [], 2)
    assert sorted((r.rank, r.frag_ord, r.score) for r in fall.collect()) == [(1, 1, 0), (2, 2, 0)]
    groups = spark.createDataFrame([(1, "g"), (2, "g"), (3, "h")], "path_ord int, grp string")
    got = retrieval.group_fragments(top, groups, frags, 3).orderBy("grp", "place").collect()
    assert [(r.grp, r.frag_ord) for r in got] == [("g", 3), ("g", 4), ("g", 2), ("h", 1), ("h", 2)]
    b = spark.createDataFrame([(i, ["a", str(i % 2)]) for i in range(5)], "path_ord int, path array<string>")
    assert [r.batch for r in retrieval.batches(b, 0, 2).orderBy("path_ord").collect()] == [0, 0, 1, 1, 2]
    seeds = spark.createDataFrame([(1, ["a"]), (2, ["a"])], "path_ord int, path array<string>")
    assert [r.seed_ord for r in retrieval.restore_order(spark.createDataFrame([(["a"],), (["q"],)], "path array<string>"), seeds).orderBy(F.asc_nulls_last("seed_ord")).collect()] == [2, None]
    assert retrieval.payload_chars(frags, "page", "text", 29).orderBy("page").first().single is False


def test_payload_sizes_are_those_of_the_whole_payload(spark, tmp_path):
    docs = [("port", '船 "a"\n\\', 3), ("port", "𠀀é", None), ("port", None, 4), ("agro", "x" * 120_000, 1), ("void", "y", 2)]
    node = lambda name, **more: {"level": 1, "name": name, **more}
    levels = [{"code": "S1", "desc": "公开"}, {"code": "S2"}]
    bodies = [(1, "port", {"levels_definition": levels, "tree": [node("A", items=["no"], children=[node("B", items=["i2", "i1"]), node("C")])]}), (2, "port", {"levels_definition": levels[:1], "tree": [node("A", children=[node("B", items=["i3"])])]}), (3, "agro", [node("D")])]
    spark.createDataFrame(docs, "domain string, text string, page int").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, d, json.dumps(b, indent=1)) for i, d, b in bodies] + [(4, "port", '{"levels_definition": [9], "tree": [')], "tax_id long, domain string, body string").write.parquet(f"{tmp_path}/gbt_template.parquet")
    seeds = {
        "port": {"levels": levels + levels[:1], "paths": [{"path": ["A", "B"], "items": ["i1", "i2", "i3"]}, {"path": ["A", "C"]}]},
        "agro": {"levels": [], "paths": [{"path": ["D"]}]},
        "void": {"levels": [], "paths": []},
    }
    said = {d: {"domain": d, "seeds": s, "fragments": [{"text": t, **({} if p is None else {"page": p})} for x, t, p in docs if x == d and t is not None]} for d, s in seeds.items()}
    want = {d: len(json.dumps(p, ensure_ascii=False, separators=(",", ":"))) for d, p in said.items()}
    got = guides.payload_sizes(spark, str(tmp_path)).collect()
    assert {r.domain: r.chars for r in got} == want and {r.domain: r.single for r in got} == {"port": True, "agro": False, "void": True}


def test_trees(spark):
    docs = spark.createDataFrame([(1, '[{"level":1,"name":"X","children":[{"level":2,"name":"Y","items":["b","a"]}]}]'), (2, '[{"level":1,"name":"X","children":[{"level":3,"name":"Y","items":["a","c",""]},{"level":2,"name":"Z"}]}]')], "k int, body string")
    flat = nested.flatten(docs, "k", "body").cache()
    leaf = [(r.doc, r.path, r["items"]) for r in taxonomy.leaves(flat, "k").orderBy("doc", "path_ord").collect()]
    assert leaf == [(1, ["X", "Y"], ["b", "a"]), (2, ["X", "Y"], ["a", "c", ""]), (2, ["X", "Z"], [])]
    tree = taxonomy.merged(*taxonomy.paths_of(flat, "k"))
    assert [(r.path, r.level, r["items"]) for r in tree.orderBy("ord").collect()] == [(["X"], 1, []), (["X", "Y"], 2, ["a", "b", "c"]), (["X", "Z"], 2, [])]
    assert taxonomy.nested_json(tree).first().tree == '[{"level":1,"name":"X","children":[{"level":2,"name":"Y","items":["a","b","c"]},{"level":2,"name":"Z"}]}]'
    paths = spark.createDataFrame([(["a", " ", "b"],), (["a", "c"],), ([],)], "path array<string>")
    assert sorted((r.id, r.parent_id, r.depth) for r in taxonomy.hierarchy(paths).collect()) == [("a", None, 1), ("a/b", "a", 2), ("a/c", "a", 2)]
    assert taxonomy.under(paths, ["a"]).count() == 2 and [r.name for r in taxonomy.distinct_at(paths, 1, ["a"]).orderBy("name").collect()] == [" ", "c"]
    seeds = spark.createDataFrame([(["a"], ["x", "y", " "]), (["b"], ["z"])], "path array<string>, items array<string>")
    edits = spark.createDataFrame([(["a"], "add", "n", None), (["a"], "delete", "x", None), (["a"], "update", "y", "Y")], "path array<string>, op string, item string, to string")
    assert {tuple(r.path): r["items"] for r in taxonomy.reviewed(seeds, edits).collect()} == {("a",): ["Y", "n"], ("b",): ["z"]}
    seg = spark.createDataFrame([(None, "p ", None)], "path array<string>, l1 string, l2 string").select(taxonomy.segments(F.col("path"), [F.col("l1"), F.col("l2")]).alias("s"))
    assert seg.first().s == ["p", ""] and seg.select(taxonomy.tokens_at(F.col("s")).alias("t")).first().t == ["p"]


def test_labels(spark):
    grades = {"S3": "S3", "g-2": "S2", "四级": "S4", "第四级": "S4", "": "", None: "", "x": None, "s 1": "S1"}
    for raw, want in grades.items():
        assert one(spark, raw, labels.grade) == want, raw
    heads = {"字段名（英文）": "fieldname", "表名": "tablename", "是否可为空NULL": "null", "Time": "fieldname", "分类": "classification", "备注 X": "备注x", None: "", "主键": "keyflag"}
    for raw, want in heads.items():
        assert one(spark, raw, labels.header_key) == want, raw
    assert one(spark, "2024医疗卫生指南", labels.domain) == "healthcare" and one(spark, "x", labels.domain) == "general"
    df = spark.createDataFrame([("1", None, "2", "t", "d", None)], "`字段名` string, `Time` string, x string, `数据表名` string, `字段描述` string, `分类` string")
    named = labels.canonical_names(df)
    assert named.columns == ["fieldname", "x", "tablename", "fielddesc", "classification"] and named.first().fieldname == "1"
    row = labels.canonical_rows(named)
    assert row.columns == list(labels.FIELDS) and labels.labelled(row).count() == 0
    assert row.select(labels.record_text().alias("t")).first().t == "t | 1 | 描述:d"
    tax = spark.createDataFrame([("D", "a", "x", 1), ("E", "a", "y", 2), ("E", "b", "x", 3)], "domain string, sub1 string, sub2 string, ord int")
    raw = {"D/a/q": ("D", "a", "q"), "D / z": ("D", "z", None), "q/a": ("D", "a", None), "q\\x": ("E", "b", "x"), "E": ("E", None, None), "y": ("E", "a", "y"), "q": (None, None, None), "1/2/3/4": (None, None, None), None: (None, None, None)}
    got = labels.parse_classification(spark.createDataFrame([(i, k) for i, k in enumerate(raw)], "i int, domain_raw string"), "domain_raw", tax).orderBy("i").collect()
    assert [tuple(r)[2:] for r in got] == list(raw.values())
    cases = [("Mobile", None, None, "手机号(中国内地)"), (None, "qq号", "a@b.cn", "qq"), (None, None, "x a@b.cn", "邮箱地址(中国内地)"), ("n", "c", "13812345678", "手机号(中国内地)"), ("n", "c", "x", None)]
    made = spark.createDataFrame([c[:3] for c in cases], "n string, c string, s string").select(labels.heuristic_labels(F.col("n"), F.col("c"), F.col("s")).alias("l"))
    assert [r.l.marker for r in made.collect()] == [c[3] for c in cases]
    assert one(spark, "S3", labels.level_number) == 3 and one(spark, "S31", labels.level_number) == 0


def test_evaluation(spark):
    df = spark.createDataFrame([("a", "a", "HIGH"), ("a", "b", "high"), (None, "a", "low"), ("b", None, None)], "t string, p string, c string")
    acc = evaluate.accuracies(df, {"m": ("t", "p")}).first()
    assert (acc.accuracy, acc.correct, acc.total) == (0.5, 1, 2)
    assert [(r.bucket, r.accuracy, r.total) for r in evaluate.accuracy_by_confidence(df, "t", "p", "c").orderBy("ord").collect()] == [("high", 0.5, 2), ("medium", 0.0, 0), ("low", 0.0, 0)]
    long = evaluate.confusion(df, "t", "p")
    assert {(r.truth, r.pred): r.n for r in long.collect()} == {("a", "a"): 1, ("a", "b"): 1, ("<NA>", "a"): 1, ("b", "<NA>"): 1}
    assert evaluate.confusion_wide(long, ["a", "b", "<NA>"]).where("truth = 'b'").first()["<NA>"] == 1
    assert {r.metric: r.value for r in evaluate.metrics(df, {"m": ("t", "p")}, "t").collect()} == {"accuracy_m": 0.5, "labelled_rows": 3.0}
    assert evaluate.accuracies(df.limit(0), {"m": ("t", "p")}).first().accuracy == 0.0
    assert {r.name: r.n_null for r in evaluate.profile(df).collect()} == {"t": 1, "p": 1, "c": 1}
    assert evaluate.guess_roles(["字段名", "真值L1"], {"truth": ("真值", "truth"), "pred": ("预测",)}) == {"truth": "真值L1", "pred": None}
    assert evaluate.rows_json(df.limit(1), ["t"], ["p"]).first().row == '{"text":{"t":"a"},"labels":{"p":"a"}}'
    items = spark.createDataFrame([("a", "S1", ["k", "k"]), ("b", "x", ["k"]), (" ", None, None)], "name string, level string, keywords array<string>")
    assert {r["check"]: r.n for r in evaluate.data_checks(items).collect()} == {"bad_level": 1, "repeated_keyword": 1, "empty_name": 1, "shared_keyword": 1}
