import json

from siftgrade.operators import nested


def test_numbering_and_shapes():
    body = {"meta": {"name": "cover"}, "taxonomy": {"tree": [
        {"level": 1, "name": "A", "items": ["i1", {"name": "i2", "grade": "S1"}], "remark": {"name": "no"}, "children": {"level2": "B", "level": 2, "items": "i3", "children": ["C", {"level": 3, "items": None}]}},
        {"name": None, "children": None}]}}
    got = [(r[0], r[1], r[2], r[3], r[4]) for r in nested.records(json.dumps(body))]
    assert got == [(1, 0, "node", "A", "node_named"), (2, 1, "item", "i1", "item_text"), (3, 1, "item", "i2", "item_object"), (4, 1, "node", "B", "node_keyed"), (5, 4, "item", "i3", "item_text"), (6, 4, "node", "C", "node_text"), (7, 4, "node", "", "node_unnamed"), (8, 0, "node", "", "node_unnamed")]


def test_layouts_are_alike():
    tree = [{"level": 1, "name": "A", "children": ["B"]}]
    want = nested.records(json.dumps(tree))
    assert len(want) == 2
    for body in ({"tree": tree}, {"tree": json.dumps(tree)}, {"tree": tree[0]}, {"taxonomy": {"tree": tree}}, {"levels_definition": [{"code": "S1"}], "tree": tree}, tree[0]):
        assert nested.records(json.dumps(body)) == want
    for broken in (None, "", "  ", json.dumps(tree)[:-3], "{}", '{"meta": {"name": "x"}}', "3", "null", "[" * 100_000):
        assert nested.records(broken) == []


def test_tables(spark):
    deep = node = {"level": 1, "name": "n1"}
    for i in range(2, 300):
        node["children"] = [{"level": i, "name": f"n{i}"}]
        node = node["children"][0]
    wide = {"tree": [{"name": "r", "items": [f"i{i}" for i in range(60_000)]}]}
    rows = [(1, json.dumps(deep), "x"), (2, json.dumps(wide), "x"), (3, None, "x"), (1, json.dumps(deep), "y"), (None, json.dumps(deep), "z")]
    df = spark.createDataFrame(rows, "tax_id long, body string, kind string")
    flat = nested.flatten(df, "tax_id", "body").cache()
    assert flat.count() == 2 * 299 + 60_001
    top = nested.united(nested.subtype_tables(flat, "tax_id"), "tax_id")
    assert sorted(map(tuple, top.collect())) == sorted(map(tuple, nested.supertype(flat, "tax_id").collect()))
    assert nested.flatten(df.limit(0), "tax_id", "body").count() == 0


def test_bodies_deeper_than_the_parser(spark):
    deep = '{"name":"n","children":[' * 30_000 + '"leaf"' + "]}" * 30_000
    got = nested.records(deep, paths=False)
    assert len(got) == 30_001 and got[-1][:4] == (30_001, 30_000, "node", "leaf") and got[-1][6] == 30_001
    assert nested.records(json.dumps({"tree": deep}), paths=False) == got
    for broken in (deep[:-1], deep + "x", deep.replace('"leaf"', "leaf"), deep.replace('"leaf"', '"leaf",')):
        assert nested.records(broken, paths=False) == []
    df = spark.createDataFrame([(1, deep)], "tax_id long, body string")
    assert nested.flatten(df, "tax_id", "body", paths=False).count() == 30_001


def test_reader_with_a_stack_reads_as_json_does():
    for text in (' {"a": [1, -2.5e3, true, null, "q\\u4e00\\n"], "b": {}, "c": [], "a": {"d": [[], {}]}} ', "3", '"x"', "[[1],[2]]", "[]"):
        assert nested._stacked(text) == json.loads(text)
    for text in ("", "[1,]", "{,}", '{"a"}', '{"a":1,}', "[1 2]", "01", "[}", "]", '{"a":}', '"x', "[1]]", "tru"):
        try:
            nested._stacked(text)
        except ValueError:
            continue
        raise AssertionError(text)


def test_states_decide_the_variants():
    """One shape is a node or an item by its place; lists without any record, and covers, are not entered."""
    body = {"children": [{"name": "x"}], "items": [{"name": "x"}], "level": 1}
    assert [(r[2], r[4]) for r in nested.records(json.dumps(body))] == [("node", "node_unnamed"), ("item", "item_object"), ("node", "node_named")]
    root, states = nested.run({"tree": json.dumps([{"level1": "a", "children": [3, None]}])})
    assert states[id(root)] == "envelope" and states[id(root["tree"])] == "forest" and states[id(root["tree"][0])] == "node_keyed"
    assert states[id(root["tree"][0]["children"])] is None
    assert nested.records('{"tree": [3]}') == [] == nested.records('{"by": "x"}')


def test_any_number_of_envelopes():
    body = {"tree": [{"name": "A"}]}
    for _ in range(20):
        body = {"taxonomy": body}
    assert [r[3] for r in nested.records(json.dumps(body))] == ["A"]
    text = json.dumps({"tree": [{"name": "A"}]})
    for _ in range(9):
        text = json.dumps({"tree": text})
    assert [r[3] for r in nested.records(text)] == ["A"]
    deep = '{"taxonomy":' * 9_000 + '{"tree":["a"]}' + "}" * 9_000
    assert [r[3] for r in nested.records(deep, paths=False)] == ["a"]


def test_unread_bodies_are_reported(spark):
    rows = [(1, '{"tree": ["a"]}'), (2, None), (3, " "), (4, '{"tree": ["a"'), (5, '{"meta": 1}'), (6, "null")]
    df = spark.createDataFrame(rows, "tax_id long, body string")
    got = nested.unread(df, nested.flatten(df, "tax_id", "body"), "tax_id", "body").collect()
    assert sorted(map(tuple, got)) == [(2, "missing"), (3, "missing"), (4, "broken"), (5, "no tree"), (6, "no tree")]
