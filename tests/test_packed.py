import json
import random

from siftgrade.operators import packed

Q = {'"': '"', "“": "”", "'": "'", "「": "」"}


def plain_split(s, kind):
    """A character-wise reader of one field, for comparison."""
    s = s.strip()
    if s.startswith("["):
        try:
            return [x.strip() for x in json.loads(s) if isinstance(x, str) and x.strip()]
        except ValueError:
            pass

    def sep(i, quoted):
        if kind == "keywords":
            return int(s[i] in ",，、;；|｜/\n\r\t")
        if s[i : i + 2] in ("||", "｜｜"):
            return 2
        return int(s[i] in "；\n\r" or quoted and s[i] in ",;，、")

    out, cur, i, quoted = [], "", 0, False
    while i < len(s):
        if not cur.strip() and not quoted and s[i] in Q:
            q, c, j, v = s[i], Q[s[i]], i + 1, ""
            while j < len(s):
                if s[j] == c:
                    if q == c and s[j + 1 : j + 2] == c:
                        v += c
                        j += 2
                        continue
                    break
                v += s[j]
                j += 1
            k = j + 1
            while k < len(s) and s[k] == " ":
                k += 1
            if j < len(s) and (k >= len(s) or sep(k, True)):
                out.append(v.strip())
                cur, i, quoted = "", k, True
                continue
        w = sep(i, quoted)
        if w:
            out.append(cur.strip())
            cur, i, quoted = "", i + w, False
            continue
        cur += s[i]
        i += 1
    return [x for x in [*out, cur.strip()] if x]


def split(spark, rows):
    df = spark.createDataFrame(rows, "id long, a string, b string")
    out = {}
    for r in packed.split_packed(df, "id", {"a": "keywords", "b": "expressions"}).collect():
        out.setdefault((r.id, r.fld), {})[r.pos] = r.val
    return {k: [v[i] for i in sorted(v)] for k, v in out.items() if sorted(v) == list(range(1, len(v) + 1))}


def test_named_cases(spark):
    cases = {
        "a,b，c、d;e；f|g/h\ni\tj": list("abcdefghij"),
        " x y , ,x y,": ["x y", "x y"],
        '"a,b",c': ["a,b", "c"],
        '"say ""hi""" ; z': ['say "hi"', "z"],
        "“一、二”、“三”": ["一、二", "三"],
        "'p'、'q|r'、s": ["p", "q|r", "s"],
        '["a, b", "c", ""]': ["a, b", "c"],
        '["\\u4e00", "b"]': ["一", "b"],
        "[a; b]": ["a", "b"],
        'x"y,z': ['x"y', "z"],
        '"open,b': ['"open', "b"],
        "a_b-c d": None, '"a;b"': None, ",;": None, "": None, "  ": None, '["one"]': None,
    }
    got = split(spark, [(i, k, None) for i, k in enumerate(cases)])
    for i, (k, want) in enumerate(cases.items()):
        assert got.get((i, "a")) == want, k


def test_expressions(spark):
    cases = {
        "a|b||c,d": ["a|b", "c,d"], "x；y\r\nz": ["x", "y", "z"], "p｜｜q||": ["p", "q"], '"a,b","c;d"': ["a,b", "c;d"],
        '[ "a||b", "c"]': ["a||b", "c"], '[\n"a||b",\n"c"]': ["a||b", "c"], "['a||b', 'c']": ["a||b", "c"], """[,a/、"'b]""": None,
        '"(?:K||A)1";"z"': ["(?:K||A)1", "z"], '["a||b", "c"]': ["a||b", "c"], "[^,;\\s]{3,9}": None, "[ab](?=、|$)||[1,2]": ["[ab](?=、|$)", "[1,2]"],
    }
    got = split(spark, [(i, None, k) for i, k in enumerate(cases)])
    for i, (k, want) in enumerate(cases.items()):
        assert got.get((i, "b")) == want, k


def test_against_a_plain_reader(spark):
    pick = random.Random(3)
    words = ["鱼塘", "pond_no", "a b", "x-y", '"q,r"', '"s""t"', "“u、v”", ""]
    rows = []
    for i in range(400):
        s = pick.choice([",", "，", "; ", "|", "/", "\n", "、"])
        rows.append((i, "".join(pick.choice(words) + pick.choice([s, s, ", "]) for _ in range(pick.randint(1, 7))), None))
    got = split(spark, rows)
    for i, s, _ in rows:
        want = plain_split(s, "keywords")
        assert got.get((i, "a")) == (want if len(want) > 1 else None), s


def test_edges(spark):
    long = ",".join(f"w{i}" for i in range(30_000))
    quotes = ",".join(['"a,""b"""'] * 3_000)
    got = split(spark, [(1, long, None), (2, quotes, "x" * 200_000), (3, None, None), (4, "d,d", "d,d"), (4, "d,d", None)])
    assert got[1, "a"][-1] == "w29999" and len(got[1, "a"]) == 30_000
    assert got[2, "a"] == ['a,"b"'] * 3_000
    assert (4, "b") not in got
    empty = spark.createDataFrame([], "id long, a string, b string")
    assert packed.split_packed(empty, "id", {"a": "keywords"}).count() == 0
    clash = spark.createDataFrame([(1, "x,y", "k", "w", "m")], "id long, a string, kind string, whole string, mode string")
    assert packed.split_packed(clash, "id", {"a": "keywords"}).count() == 2


def test_salted_rules_give_the_same(spark, monkeypatch):
    rows = [(i, "a,b" if i % 3 else f"a;{i}", None) for i in range(60)]
    want = split(spark, rows)
    monkeypatch.setattr(packed, "BROADCAST_RULES", 0)
    assert split(spark, rows) == want


def test_salted_rules_are_never_broadcast(spark, monkeypatch):
    monkeypatch.setattr(packed, "BROADCAST_RULES", 0)
    df = spark.createDataFrame([(i, "a,b" if i % 3 else f"a;{i}", None) for i in range(60)], "id long, a string, b string")
    out = packed.split_packed(df, "id", {"a": "keywords", "b": "expressions"})
    assert out.count() == 120
    plan = out._jdf.queryExecution().executedPlan()
    out.collect()
    assert "SortMergeJoin" in plan.toString() and "Broadcast" not in plan.toString()


def test_long_fields_are_read_like_short_ones(spark):
    marks = "[,a/、'b;c\"|d，" + "".join(f"{chr(97 + i % 26)}{m}{chr(98 + i % 7)}{m}" for i, m in enumerate(",、'/\";|" * 120))
    rows = [(1, None, "[,a/、'b]{2}"), (2, None, marks + "]{2}"), (3, None, marks + "]"), (4, None, marks + "]；x"), (5, None, '["a,b",' + ",".join(f'"{i}"' for i in range(500)) + "]")]
    got = split(spark, rows)
    assert (1, "b") not in got and (2, "b") not in got and (3, "b") not in got
    assert got[4, "b"] == [marks + "]", "x"] and len(got[5, "b"]) == 501
