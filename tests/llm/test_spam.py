import random

import numpy as np

from siftgrade.llm import spam


def brute(text, least):
    out = np.zeros(len(text), bool)
    for n in range(least, len(text)):
        at = {}
        for i in range(len(text) - n + 1):
            at.setdefault(text[i : i + n], []).append(i)
        for where in at.values():
            if len(where) > 1:
                for i in where:
                    out[i : i + n] = True
    return out


def codes(text):
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def often(text, least, times):
    """Positions under runs of this length that occur so often, counted plainly."""
    at, out = {}, np.zeros(len(text), bool)
    for i in range(len(text) - least + 1):
        at.setdefault(text[i : i + least], []).append(i)
    for where in at.values():
        for i in where if len(where) >= times else ():
            out[i : i + least] = True
    return out


def test_coverage_against_brute_force():
    pick = random.Random(2)
    for _ in range(300):
        text = "".join(pick.choice("ab水c" if pick.random() < 0.9 else "defghijklm") for _ in range(pick.randint(0, 70)))
        automaton = spam.Automaton(codes(text))
        for least in (2, 3, 5):
            want = brute(text, least)
            assert (spam.covered(automaton.reach(), least) == want).all() and (spam.run_cover(codes(text), least) == want).all()
            for times in (3, 5):
                assert (spam.covered(automaton.reach(times), least) == often(text, least, times)).all() and (spam.run_cover(codes(text), least, times) == often(text, least, times)).all()


SENTENCES = "自第30版目录起，屠宰检验章号一般列为二级，汇聚超过88027条后提升一级，例外情形见附表28。对外共享馈线地点之前，须由数据责任人核对解译用途并留存审批单。"
ENGLISH = "Reviewers should read the sample value first and the time description second, with doubts settled upward. Grade two applies to all of the records in the annex. "
PAGES = {
    "tags": ("".join(f"#锚地{a}#{b}" for a in ("终点", "版本", "图号") for b in ("林班结论", "浮标版本", "药剂备注")), True),
    "goods": (" | ".join(f"pen price best K-{i} ¥{i * 7}" for i in range(30)), True),
    "links": ("\n".join(f"- [叉车数量](http://wox{i}.example.org/imagery?id={i})" for i in range(20)), True),
    "stuffed": ("，".join(f"想了解托盘去向{w}，找托盘去向就来{w}" for w in ("优惠", "现货", "定制", "加盟")), True),
    "stuffed en": (" ".join(f"price cage weight review cage weight {y}." for y in range(2030, 2050)), True),
    "prose": (SENTENCES * 4, False),
    "prose en": (ENGLISH * 4, False),
    "some links": (SENTENCES * 4 + "\n[1] https://a.example/x\n[2] https://a.example/y", False),
    "mostly tags": (SENTENCES + "\n" + "#泊位 #航道 " * 60, True),
    "unpunctuated": ("雨过后厂区的岩芯旁多出261袋未贴签的起点记录纸有人主张照配比处置也有人坚持它更像切图配置争执持续了929个钟头" * 2, False),
    "passage twice": ("两套口径算出的预约结论相差35997谁也说不清哪一套先启用有人主张照变化检测样本处置也有人坚持它更像控制点之记争执持续了479个钟头值班日志显示凌晨142点粮堆曾被短暂借走归还时少了附件" + "\n两套口径算出的预约结论相差35997，\n谁也说不清哪一套先启用，\n有人主张照变化检测样本处置，\n也有人坚持它更像控制点之记" + "\n" + SENTENCES, False),
    "short": ("字段表", False),
}


BACKGROUND = [
    SENTENCES + "有人主张照此处置，也有人坚持它更像是配置的问题，争执持续了很久。记录纸未贴签的，须由起点的责任人在雨后补签。", ENGLISH + "The best of it is that there is a price to be paid in the end, and the rest of them were with us.",
    "目录细则\n" + SENTENCES, "Grading notes\n" + ENGLISH, "浮标版本 锚地终点 托盘去向\n叉车数量 优惠 现货", "price best new hot cage weight review\nseal mine link",
]


def prose(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(BACKGROUND * 5)], "doc_id long, text string")
    return spam.clause_tokens(df, "text")


def test_clause_tokens_are_learned(spark):
    clause = prose(spark)
    token = lambda w: int(spam.Pages([w]).token[0])
    assert {token(w) for w in ("的", "由", "也", "the", "and", "is")} <= set(clause.tolist())
    assert not {token(w) for w in ("托", "盘", "cage", "weight")} & set(clause.tolist())
    again = spam.clause_tokens(spark.createDataFrame([(i, t) for i, t in enumerate(BACKGROUND * 5)], "doc_id long, text string").repartition(7), "text")
    assert (again == clause).all()
    assert len(spam.clause_tokens(spark.createDataFrame([], "text string"), "text")) == 0


def test_pages(spark):
    rows = [(i, t, "x") for i, (t, _) in enumerate(PAGES.values())] + [(100, None, "x"), (101, "", "x"), (None, PAGES["tags"][0], "x"), (0, PAGES["tags"][0], "y"), (102, "#泊位 #航道 " * 40_000, "x"), (103, "\n\n", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, parts string")
    got = sorted(r.doc_id for r in spam.spam(df, "doc_id", "text", prose(spark)).collect())
    assert got == sorted([i for i, (_, want) in enumerate(PAGES.values()) if want] + [0, 102])
    assert spam.spam(df.limit(0), "doc_id", "text").count() == 0


HAN = [chr(c) for c in range(0x4E00, 0x4E00 + 1_500) if chr(c) not in "".join(BACKGROUND)]
PICK = random.Random(5)
WORD = lambda n: "".join(PICK.choice(HAN) for _ in range(n))
STUFFED = {
    "names": ("\n".join(f"{WORD(3)} {PICK.randrange(10**10)} {WORD(2)}" for _ in range(40)), False),
    "figures": ("\n".join(" ".join(str(PICK.randrange(10**5)) for _ in range(6)) for _ in range(30)), False),
    "words": ("，".join(WORD(PICK.randint(2, 5)) for _ in range(100)), False),
    "with function characters": ("，".join(f"由托盘去向的{w}{i}" for i, w in enumerate(["优惠", "现货", "定制", "加盟", "下载", "排名"] * 6)), True),
    "with function words": (". ".join(f"the best price of cage weight is {i}{w}" for i, w in enumerate(["low", "new", "hot"] * 10)), True),
    "half and half": (SENTENCES + "由托盘去向的优惠，由托盘去向的现货，" * 8, True),
}


def test_both_measures_decide(spark):
    """The clause test alone is wrong on each of these pages."""
    clause = prose(spark)
    got = dict(zip(STUFFED, spam.judged([t for t, _ in STUFFED.values()], clause)))
    assert {k: v[0] > spam.MOST_PROSE for k, v in got.items()} == {k: not want for k, (_, want) in STUFFED.items()}
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(STUFFED.values())], "doc_id long, text string")
    assert sorted(r.doc_id for r in spam.spam(df, "doc_id", "text", clause).collect()) == [i for i, (_, want) in enumerate(STUFFED.values()) if want]


def test_sparse_clause_tokens_need_threefold_repetition(spark):
    clause = prose(spark)
    passage = "由".join(WORD(11) for _ in range(12))
    twice, often = spam.judged([passage + "\n" + passage, "\n".join([passage] * 4)], clause)
    assert twice[0] > spam.MOST_PROSE and twice[1] == 0.0
    assert often[1] > spam.MOST_PROSE and often[2] >= spam.LEAST_REPEATED
    none = passage.replace("由", WORD(1))
    assert spam.judged([none + "\n" + none], clause)[0][1] > spam.MOST_PROSE


def test_long_pages_give_the_same(monkeypatch, spark):
    clause = prose(spark)
    texts = [t for t, _ in [*PAGES.values(), *STUFFED.values()]] + ["", "\n", "x"]
    want = spam.judged(texts, clause)
    assert [spam.judged([t], clause)[0] for t in texts] == want  # nor does it matter what stands beside a page
    monkeypatch.setattr(spam, "AUTOMATON_LENGTH", 10)
    assert spam.judged(texts, clause) == want


def test_pages_that_stay_prose_need_no_automaton(monkeypatch, spark):
    clause = prose(spark)
    plain = spam.Automaton
    built = []
    monkeypatch.setattr(spam, "Automaton", lambda sequence: built.append(len(sequence)) or plain(sequence))
    for name, (text, spammy) in PAGES.items():
        built.clear()
        share = spam.judged([text], clause)[0][1]
        assert bool(built) == (share > spam.MOST_PROSE) and (built or not spammy), name
    monkeypatch.setattr(spam, "run_cover", lambda sequence, least, times=2: np.ones(len(sequence), bool))
    built.clear()
    assert spam.judged([SENTENCES * 4], clause)[0][1] <= spam.MOST_PROSE and built  # the automaton decides where runs don't
