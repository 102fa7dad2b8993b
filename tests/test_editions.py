from datetime import datetime

from siftgrade.operators import editions

FILES = "file_id long, series string, exported_at timestamp, header array<string>, name string, prev_id int"
ROWS = "file_id long, row_no int, cells array<struct<v:string,t:string>>, extra string"


def day(n, month=1):
    return datetime(2030, month, n)


def frames(spark, files, rows):
    made = [(f, i, [None if c is None else tuple(c) for c in cs], "x") for f, rs in rows.items() for i, cs in enumerate(rs, 1)]
    return spark.createDataFrame([(*f, "n", 1) for f in files], FILES), spark.createDataFrame(made, ROWS)


def changes(spark, files, rows):
    return sorted(tuple(r) for r in editions.schema_changes(*frames(spark, files, rows)).collect())


def s(*vs):
    return [(v, "s") for v in vs]


def test_every_kind_of_change(spark):
    files = [(1, "w", day(1), ["a", "b ", "c", "e"]), (9, "w", day(3), ["B2", "a", "", "d", "e"]), (4, "w", day(5, 3), ["a", "B2", "d", "e"]), (7, "v", day(2), ["z"])]
    rows = {1: [s("1", "x", "p") + [("5", "s")], s("2", "y", "q") + [("6", "s")]], 9: [s("x", "1", "-", "n") + [("7", "n")], s("y", "2", "-", "m") + [("8", "n"), ][:1]], 4: [s("1", "x", "n", "9")]}
    assert changes(spark, files, rows) == [(4, "retyped", "e", "e"), (9, "added", "", "d"), (9, "removed", "c", ""), (9, "renamed", "b", "B2"), (9, "retyped", "e", "e")]


def test_two_renames_at_once_and_order_of_columns(spark):
    a = [s(f"k{i}", f"v{i}", "Y" if i % 2 else "N") for i in range(8)]
    b = [[r[1], r[2], r[0]] for r in a[1:]]
    files = [(1, "w", day(1), ["key", "val", "flag"]), (2, "w", day(2), ["wert", "jn", "schluessel"])]
    assert changes(spark, files, {1: a, 2: b}) == [(2, "renamed", "flag", "jn"), (2, "renamed", "key", "schluessel"), (2, "renamed", "val", "wert")]


def test_edges(spark):
    assert changes(spark, [], {}) == []
    files = [(1, "w", None, None), (2, "w", day(1), ["a", "a", None, " "]), (3, "w", day(1), []), (5, None, day(9), ["q"])]
    assert changes(spark, files, {2: [[None, ("x", None)]], 99: [s("x")]}) == [(2, "added", "", "a"), (3, "removed", "a", "")]
    # an empty column has no type; ties of type are no change where both editions tie alike
    files = [(1, "w", day(1), ["a", "b"]), (2, "w", day(2), ["a", "b"])]
    assert changes(spark, files, {1: [[("1", "n"), ("x", "s")]], 2: [[None, ("1", "n")], [None, ("y", "s")]]}) == [(2, "retyped", "b", "b")]


def test_unified_follows_renames(spark):
    files = [(i, "w", day(i), ["key", n]) for i, n in ((1, "a"), (2, "b"), (3, "c"), (4, "c"))]
    rows = {i: [[("k1", "s"), ("2030/01/02", "d")], [("k2", "s"), ("7.50", "n") if i == 4 else ("2030-01-03", "d")]] for i in (1, 2, 3, 4)}
    records = editions.unified(*frames(spark, files, rows))
    got = records.collect()
    assert len(got) == 16 and {(r.field, r.type) for r in got} == {("a", "d"), ("key", "s")}
    assert {str(r.day) for r in got if r.file_id == 1 and r.field == "a"} == {"2030-01-02", "2030-01-03"}
    assert [(r.file_id, r.value) for r in got if r.failed] == [(4, "7.50")]
    assert {tuple(r) for r in editions.cast_report(records).collect()} == {("w", "a", "d", 8, 1), ("w", "key", "s", 8, 0)}
    wide = editions.as_columns(records, {"key": "s", "a": "d"}).collect()
    assert len(wide) == 8 and {(r.key, str(r.a)) for r in wide if r.file_id == 2} == {("k1", "2030-01-02"), ("k2", "2030-01-03")}


def test_casts(spark):
    rows = [("n", "-1.5"), ("n", "1d"), ("n", "x"), ("d", "2030-02-30"), ("d", "2030/02/03"), ("b", "FALSE"), ("b", "是"), ("b", "maybe"), ("s", "1")]
    df = spark.createDataFrame(rows, "type string, value string")
    got = [tuple(r) for r in df.select(*editions._typed(df["value"], df["type"])).collect()]
    assert [g[0] for g in got] == [-1.5] + [None] * 8 and [str(g[1]) for g in got] == ["None"] * 4 + ["2030-02-03"] + ["None"] * 4
    assert [g[2] for g in got] == [None] * 5 + [False, True, None, None]


def test_flooding_decides_between_equal_contents(spark):
    """Four flags with equal contents in two groups: only what flows from their groups tells them apart."""
    old, new = ["north.key", "north.on", "south.key", "south.on"], ["p.aa", "p.zz", "q.aa", "q.zz"]
    cells = [s(f"n{i}", "Y" if i % 2 else "N", f"s{i}", "Y" if i % 2 else "N") for i in range(8)]
    files = [(1, "w", day(1), old), (2, "w", day(2), [new[2], new[3], new[0], new[1]])]
    got = changes(spark, files, {1: cells, 2: cells})
    assert got == [(2, "renamed", "north.key", "q.aa"), (2, "renamed", "north.on", "q.zz"), (2, "renamed", "south.key", "p.aa"), (2, "renamed", "south.on", "p.zz")]
    off = editions.correspondences(*frames(spark, files, {1: cells, 2: cells}), passes=0)[1]
    assert ("north.on", "q.zz") not in {(r.old_col, r.new_col) for r in off.collect()}


def test_names_alone_where_contents_are_not_asked_for(spark):
    files = [(1, "w", day(1), ["id", "customer_name", "weight"]), (2, "w", day(2), ["id", "cust_name", "color"])]
    rows = {1: [s("1", "Ann", "5")], 2: [s("1", "Bob", "red")]}
    assert [g[1] for g in changes(spark, files, rows)] == ["added", "added", "removed", "removed"]
    got = editions.correspondences(*frames(spark, files, rows), contents=0)[1].collect()
    assert [(r.old_col, r.new_col) for r in got] == [("customer_name", "cust_name")]


def test_cases_do_not_depend_on_each_other():
    one = ([("a", "s"), ("b", "s")], [("x", "s"), ("y", "n")], [("k", "s", "s")], {("a", "x"): 0.9, ("b", "y"): 0.5})
    two = ([("g.a", "s")], [("h.a", "s"), ("z", "s")], [], {("g.a", "z"): 0.2})
    alone = [editions.flooded([c])[0] for c in (one, two)]
    for a, b in zip(alone, editions.flooded([one, two])):
        assert abs(a - b).max() < 1e-12


def test_previous_edition_over_months(spark):
    files = [(i, "w", day(1 + i % 27, 1 + i % 12), ["a"]) for i in range(40)]
    order = [f[0] for f in sorted(files, key=lambda f: (f[2], f[0]))]
    df, _ = frames(spark, files, {})
    got = {r.file_id: r.prev_id for r in editions.previous_editions(df).collect()}
    assert got == {order[0]: None, **dict(zip(order[1:], order))}
