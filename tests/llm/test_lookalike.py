import unicodedata

import pytest

from siftgrade.llm import lookalike

CASES = [
    ("ＡＩＳ　１２３", "AIS 123"), ("能源电⼒/水⽂", "能源电力/水文"), ("力更", "力更"), ("仓储­物​流﻿", "仓储物流"),
    ("bó wèi", "bó wèi"), ("façade élément", "façade élément"), ("ΑIЅ/GNSS", "AIS/GNSS"), ("格式YΥҮYΜMDD", "格式YYYYMMDD"),
    ("Grӧße", "Größe"), ("ｅ​́", "é"), ("СА tag", "СА tag"), ("ΡС", "PC"), ("ǘ", "ǘ"), ("ПАО  x", "ПАО  x"),
]
KEPT = ["порт приписки", "β系数，电阻Ω", "温度℃①㎡", "（全角）：！，、。", "Größe façade", "", "ASCII only", "Ω", "TNF β", "ПАО"]


@pytest.fixture(scope="module")
def rewriter():
    return lookalike.Rewriter(*lookalike.rewrites({}))


def test_rewriting(rewriter):
    for text, want in CASES:
        assert rewriter.plain(text) == want, text
        assert rewriter.plain(want) == want
    for text in KEPT:
        assert rewriter.plain(text) == text


def test_classes_are_transitive():
    classes = lookalike.classes()
    a = next(ms for ms in classes.values() if "A" in ms)
    assert {"A", "Ａ", "А", "Α"} <= set(a)
    assert sum(map(len, classes.values())) == len({m for ms in classes.values() for m in ms})


def test_every_composed_letter_comes_back(rewriter):
    for i in range(0xC0, 0x250):
        if unicodedata.normalize("NFC", apart := unicodedata.normalize("NFD", chr(i))) == chr(i) and len(apart) > 1:
            assert rewriter.plain("x" + apart) == "x" + chr(i)


def test_on_tables(spark):
    long = "ｘ" * 100_000 + "y"
    rows = [(i, t, "p") for i, (t, _) in enumerate(CASES)] + [(100, None, "p"), (101, "", "p"), (102, long, "p"), (0, CASES[0][0], "q")] + [(200 + i, t, "p") for i, t in enumerate(KEPT)]
    df = spark.createDataFrame(rows, "id long, text string, plain string")
    got = sorted(map(tuple, lookalike.ordinary(df, "text", ["id"]).collect()))
    want = [(i, w) for i, (t, w) in enumerate(CASES) if t != w] + [(102, "x" * 100_000 + "y"), (0, CASES[0][1])]
    assert got == sorted(want)
    assert lookalike.ordinary(df.limit(0), "text", ["id"]).count() == 0


def test_frequencies_choose_among_ordinary_members(spark):
    """月 and 肉 share a radical: what the corpus writes more often represents it, and neither is rewritten."""
    for common, other in (("月", "肉"), ("肉", "月")):
        df = spark.createDataFrame([(1, "⺼类"), (2, common * 3), (3, other), (4, "⺼")], "id long, t string")
        got = {r.id: r.plain for r in lookalike.ordinary(df, "t", ["id"]).collect()}
        assert got == {1: f"{common}类", 4: common}
    several = [ms for ms in lookalike.classes().values() if {"日", "曰"} <= set(ms)]
    assert several and "⺜" in several[0]


def test_radicals(rewriter):
    assert rewriter.plain("⻔牌⻢达⻉壳") == "门牌马达贝壳"
    for entry in lookalike.RADICALS:
        assert 0x2E80 <= ord(entry[0]) <= 0x2EF3 and all(not 0x2E80 <= ord(c) <= 0x2FDF for c in entry[1:])


def test_frequencies(spark):
    df = spark.createDataFrame([("aab",), (None,), ("",), ("b水",)], "t string")
    assert {chr(r.cp): r.n for r in lookalike.frequencies(df, "t").collect()} == {"a": 2, "b": 2, "水": 1}
