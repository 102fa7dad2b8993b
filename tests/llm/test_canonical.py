import random

import numpy as np
from pyspark.sql import functions as F

from siftgrade.llm import canonical

REF = [(1, "港口航运/泊位岸线/泊位靠离排期", ["靠泊班表"]), (2, "港口航运/泊位岸线/岸线占用核准", []), (3, "水务水利/供水管网/SCADA测点清单", None), (4, "文博考古/展览借展/恒湿柜曲线", [""])]
CASES = {
    "泊位靠离排期": 1, " 港口航运/泊位岸线/泊位靠离排期": 1, "靠泊班表（旧）": 1, "泊位岸线>岸线占用核准": 2, "岸线占用核准, 泊位岸线, 港口航运": 2, "岸线占用核准（港口航运）": 2,
    "scada测点清单类": 3, "ＳＣＡＤＡ测点清单": 3, "分类：SCADA测点清单": 3, "5.3 泊位靠离排期": 1, "可能是泊位靠离排期?": 1, "泊位离靠排期": 1, "港口航运/岸线占核准": 2, "文博古考/展览借展/恒柜湿曲线": 4,
    "港口航运": -1, "港口航运/泊位岸线": -1, "泊位岸线类": -1, "打印机墨盒": -1, "-": -1, "港口航运/泊位岸线/食堂菜谱": -1, "x" * 50_000: -1,
}


def plain(a, b):
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        cur = [i]
        for j, y in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (x != y)))
        prev = cur
    return prev[-1]


def test_tree_returns_every_form_within_the_radius():
    pick = random.Random(4)
    word = lambda: "".join(pick.choice("abc水") for _ in range(pick.randint(1, 9)))
    forms = sorted({word() for _ in range(400)})
    tree = canonical.BKTree([(f, i, len(f)) for i, f in enumerate(forms)])
    queries = [word() for _ in range(60)]
    for radius in (0, 1, 3):
        q, n, d = tree.within(queries, np.full(len(queries), radius), chunk=100)
        got = {(queries[a], tree.forms[b]): int(c) for a, b, c in zip(q, n, d)}
        assert got == {(x, f): e for x in queries for f in forms if (e := plain(x, f)) <= radius}
    assert canonical.aligned("abcd", "acbd") == 1 and canonical.aligned("", "ab") == 2


def test_values(spark):
    ref = spark.createDataFrame(REF, "cat_id int, path string, also_called array<string>")
    rows = [(i, v, "p") for i, v in enumerate(CASES)] + [(100, None, "p"), (101, " ", "p"), (102, REF[0][1], "p"), (0, next(iter(CASES)), "p")]
    df = spark.createDataFrame(rows, "id long, typed string, path string")
    got = sorted(map(tuple, canonical.mapped(df, "id", "typed", ref).collect()))
    assert got == sorted([(i, c) for i, c in enumerate(CASES.values())] + [(0, 1)])
    assert canonical.mapped(df.limit(0), "id", "typed", ref).count() == 0
    assert {r.cat_id for r in canonical.mapped(df, "id", "typed", ref.limit(0)).collect()} == {-1}


def test_shards_merge(spark, monkeypatch):
    monkeypatch.setattr(canonical, "SHARD_FORMS", 10)
    ref = spark.createDataFrame(REF, "cat_id int, path string, also_called array<string>")
    df = spark.createDataFrame(list(enumerate(CASES)), "id long, typed string")
    assert {r.id: r.cat_id for r in canonical.mapped(df, "id", "typed", ref).collect()} == dict(enumerate(CASES.values()))


def test_shards_change_no_result(spark, monkeypatch):
    pick = random.Random(8)
    name = lambda: "".join(pick.choice("abcd") for _ in range(pick.randint(4, 6)))
    ref = [(1, "xy/zw/harbour", []), (2, "harbour/zw/quay", []), (3, "p/q/abcdefg", []), (4, "p/q/bacdegf", [])] + [(i, f"{name()}/{name()}/{name()}", [name()]) for i in range(10, 60)]
    upper = [u for _, p, _ in ref for u in p.split("/")]
    values = ["harbour", "harbour", "abcdegf", *upper, *(name() for _ in range(100))]
    refs = spark.createDataFrame(ref, "cat_id int, path string, also_called array<string>")
    rows = [(i, v) for i, v in enumerate(values)] + [(0, "quay"), (0, "quay")]
    df = spark.createDataFrame(rows, "id long, typed string")
    one = sorted(map(tuple, canonical.mapped(df, "id", "typed", refs).collect()))
    monkeypatch.setattr(canonical, "SHARD_FORMS", 150)
    assert sorted(map(tuple, canonical.mapped(df, "id", "typed", refs).collect())) == one
    assert (1, 1) in one and [r for r in one if r[0] == 0] == [(0, 1), (0, 2), (0, 2)]


def test_remarks_are_learned_from_the_values(spark):
    ref = spark.createDataFrame([(i, f"a{i}/b{i}/entry{chr(97 + i) * 6}", None) for i in range(20)], "cat_id int, path string, also_called array<string>")
    name = lambda i: f"entry{chr(97 + i) * 6}"
    rows = [f"maybe {name(i)}" for i in range(12)] + [f"{i}.{i} {name(i)}" for i in range(12)] + [f"{name(i)} (old)" for i in range(12)] + [f"{name(1)}odd"] * 30 + [name(i) for i in range(20)]
    df = spark.createDataFrame(list(enumerate(rows)), "id long, v string")
    forms = canonical.settled_forms(ref)
    got = canonical.learned(df.select(F.col("v").alias("_value")), forms, 1)
    assert got.readings("Maybe: X") == ["maybex", "x"] and got.readings("12.3 x") == ["123x", "x"] and got.readings("7 x (old)") == ["7xold", "xold", "7x", "x"]
    assert got.readings("xodd") == ["xodd"]  # beside one entry only
    assert canonical.learned(df.select(F.col("v").alias("_value")), forms, 3).readings("7 x (old)") == got.readings("7 x (old)")
