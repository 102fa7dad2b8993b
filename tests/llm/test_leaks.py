import random
import re

from siftgrade.llm import leaks


def exact(docs, items):
    bare = lambda t: "".join(c for c in (t or "").casefold() if c.isalnum())
    out = set()
    for i, t in docs:
        t = bare(t)
        for j, u in items:
            u = bare(u)
            if any(t[k : k + leaks.RUN] in u for k in range(len(t) - leaks.RUN + 1)):
                out.add((i, j))
    return sorted(out)


def found(spark, docs, items):
    d = spark.createDataFrame([(*r, "x") for r in docs], "doc_id long, text string, item_id string")
    i = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, doc_id string")
    return sorted(map(tuple, leaks.leaked(d, "doc_id", "text", i, "item_id", "text").collect()))


def corpus(seed):
    pick = random.Random(seed)
    text = lambda n: "".join(pick.choice("abcdefgh水库坝体 ，.") for _ in range(n))
    items = [(j, text(pick.randint(40, 400))) for j in range(40)] + [(100, None), (101, ""), (102, "x" * 49), (103, "ab" * 60)]
    docs = []
    for i in range(150):
        body = text(pick.randint(0, 3_000))
        for _ in range(pick.randint(0, 2)):
            src = pick.choice(items[:40])[1]
            a = pick.randint(0, len(src) - 1)
            part = src[a : a + pick.randint(40, 120)]
            part = re.sub(" ", "\n> ", part).upper() if pick.random() < 0.5 else part
            at = pick.randint(0, len(body))
            body = body[:at] + part + body[at:]
        docs.append((i, body))
    return docs + [(900, None), (901, ""), (902, "AB" * 30), (903, "z" * 500_000 + items[0][1] * 2), (0, docs[0][1])], items


def test_against_brute_force(spark):
    for seed in (1, 2):
        docs, items = corpus(seed)
        want = exact(docs, items)
        assert len(want) > 20 and found(spark, docs, items) == want


def test_a_run_of_just_the_length(spark):
    run = "".join(chr(0x4E00 + i) for i in range(50))
    items = [(1, "前" * 20 + run + "后" * 20), (2, run), (3, run)]
    docs = [(1, "甲" * 349 + run[:49]), (2, "乙" * 333 + run + "丙"), (3, run[1:])]
    assert found(spark, docs, items) == [(2, 1), (2, 2), (2, 3)]


def test_shards_and_empty_tables(spark, monkeypatch):
    docs, items = corpus(3)
    want = found(spark, docs, items)
    monkeypatch.setattr(leaks, "SHARD_CHARS", 2_000)
    assert found(spark, docs, items) == want
    assert found(spark, [], items) == [] and found(spark, docs, []) == []


def test_retrieval_keeps_all_above_threshold():
    docs, items = corpus(5)
    texts = [(j, re.sub(r"[^\w]|_", "", t or "").lower()) for j, t in items]
    index = leaks.Index(texts)
    for n, item in enumerate(index.texts):
        terms = {int(k) for k in leaks.np.searchsorted(index.keys, leaks.grams(item[:120]))}
        score = {}
        for t in terms:
            for i, w in index.post[t]:
                score[i] = score.get(i, 0) + w
        assert sorted(index.retrieve(sorted(terms))) == sorted(i for i, s in score.items() if s >= index.least[i])
