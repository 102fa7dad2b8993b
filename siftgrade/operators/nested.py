"""Deeply nested templates as flat, typed tables that keep the links between parent and child.

A bottom-up tree automaton gives every object, list and string of a body a state, from its own kind and
keys and from the states below it: text, leaf (an object with hardly more than a name), node_named,
node_keyed, node_unnamed, forest, envelope, other. The run decides everything that follows: which
envelopes are opened, whether a body is a tree at all, whether a list is entered, and, by state and the
place it is found in (below `children` or `items`), which variant a record is of. Each variant is routed
to a table of its own with the fields only it has; all keep the common keys (document, record number,
parent's record number), over which they can be joined or unioned. Parsing and numbering need one whole
body and run in tasks over Arrow batches; there is no shuffle.

Defined cases: null, blank or incomplete bodies give nothing; bodies nested deeper than the JSON parser
goes (some thousand levels) are read with a stack instead, under any number of envelopes; a body without
a tree gives nothing; unread() reports all of these with the reason. Null children and items are none;
remarks, covers and level definitions are no nodes. Paths grow with the square of the depth;
flatten(paths=False) leaves them null.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from json.decoder import scanstring

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import spread

RECORD = "rec_no int, parent_no int, kind string, val string, variant string, level int, depth int, grade string, path array<string>"
_ARROW = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.list_(pa.string())]
#: Variants of records, and the fields that their tables have beside the common keys.
VARIANTS = {
    "node_named": ["val", "level", "depth", "path"],
    "node_keyed": ["val", "level", "depth", "path"],
    "node_unnamed": ["level", "depth", "path"],
    "node_text": ["val", "depth", "path"],
    "item_text": ["val", "depth"],
    "item_object": ["val", "grade", "depth"],
}
#: Keys under which the automaton goes down; JSON text found there is read.
PLACES = ("taxonomy", "tree", "children", "items")
#: The variant of a value by where it is found and its state; others are no records.
AS_NODE = {"text": "node_text", "leaf": "node_named", "node_named": "node_named", "node_keyed": "node_keyed", "node_unnamed": "node_unnamed", "other": "node_unnamed", "envelope": "node_unnamed"}
AS_ITEM = {"text": "item_text"} | dict.fromkeys(("leaf", "node_named", "node_keyed", "node_unnamed", "other", "envelope"), "item_object")
#: States of a body that is a tree, or a forest of trees.
TREES = ("text", "leaf", "node_named", "node_keyed", "node_unnamed", "forest")
#: Records a batch holds at most before it leaves the task.
BATCH = 50_000

_SPACE = re.compile(r"[ \t\n\r]*")
_ATOM = re.compile(r"-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?|true|false|null|NaN|-?Infinity")


def _stacked(text: str):
    """What json.loads returns, read with a stack of open lists and objects, at any depth."""
    at = _SPACE.match(text).end()
    top: list = []
    open_, keys = [top], [None]  # the innermost container is last; a key waits beside an object

    def broken():
        return json.JSONDecodeError("no JSON", text, at)

    def key_at(at: int) -> tuple[str, int]:
        if text[at : at + 1] != '"':
            raise broken()
        key, at = scanstring(text, at + 1, True)
        at = _SPACE.match(text, at).end()
        if text[at : at + 1] != ":":
            raise broken()
        return key, _SPACE.match(text, at + 1).end()

    def put(value) -> None:
        if isinstance(open_[-1], dict):
            open_[-1][keys[-1]] = value
        else:
            open_[-1].append(value)

    while True:  # at the start of a value
        c = text[at : at + 1]
        if c in ("[", "{") and c:
            value = [] if c == "[" else {}
            put(value)
            at = _SPACE.match(text, at + 1).end()
            if text[at : at + 1] == ("]" if c == "[" else "}"):
                at += 1
            else:
                open_.append(value)
                keys.append(None)
                if c == "{":
                    keys[-1], at = key_at(at)
                continue
        elif c == '"':
            value, at = scanstring(text, at + 1, True)
            put(value)
        elif m := _ATOM.match(text, at):
            put(json.loads(m.group()))
            at = m.end()
        else:
            raise broken()
        while True:  # after a value
            at = _SPACE.match(text, at).end()
            if len(open_) == 1:
                if at < len(text):
                    raise broken()
                return top[0]
            c, inside = text[at : at + 1], open_[-1]
            if c == ",":
                at = _SPACE.match(text, at + 1).end()
                if isinstance(inside, dict):
                    keys[-1], at = key_at(at)
                break
            if c != ("}" if isinstance(inside, dict) else "]"):
                raise broken()
            at += 1
            open_.pop()
            keys.pop()


def _loads(text: str):
    try:
        return json.loads(text)
    except RecursionError:
        return _stacked(text)


def _level_key(node: dict) -> str | None:
    """The value of the first levelN key that holds a string; '' if there are only others, None if there are none."""
    found = None
    for key, value in node.items():
        if key.startswith("level") and key[5:].isdigit():
            if isinstance(value, str):
                return value
            found = ""
    return found


def transition(value, below: dict[str, str | None]) -> str | None:
    """The state of a value, from its kind and keys, and from the states of what stands in its PLACES."""
    if isinstance(value, str):
        return "text"
    if isinstance(value, dict):
        if below.get("tree") in TREES or below.get("tree") == "envelope" or below.get("taxonomy") == "envelope":
            return "envelope"
        holds = "children" in value or "items" in value or "level" in value
        keyed = None if holds and isinstance(value.get("name"), str) else _level_key(value)
        if isinstance(value.get("name"), str):
            return "node_named" if holds or keyed is not None else "leaf"
        if keyed:
            return "node_keyed"
        return "node_unnamed" if holds or keyed is not None else "other"
    return None


def run(body) -> tuple[object, dict[int, str | None]]:
    """(body, states): the states of a body's objects and lists by identity, from the bottom up, without recursion.

    JSON text as the body or in one of the PLACES is replaced by what it holds.
    """

    def opened(value):
        while isinstance(value, str) and value.lstrip()[:1] in ("[", "{"):
            try:
                value = _loads(value)
            except ValueError:
                break
        return value

    states: dict[int, str | None] = {}
    of = lambda v: states.get(id(v)) if isinstance(v, (dict, list)) else transition(v, {})
    body = opened(body)
    todo = [(body, False)]
    while todo:
        value, ready = todo.pop()
        if isinstance(value, list):
            if ready:
                states[id(value)] = "forest" if any(of(v) for v in value) else None
                continue
            todo.append((value, True))
            todo += [(v, False) for v in value if isinstance(v, (dict, list))]
        elif isinstance(value, dict):
            if ready:
                states[id(value)] = transition(value, {p: of(value[p]) for p in PLACES if p in value})
                continue
            todo.append((value, True))
            for place in PLACES:
                if place in value:
                    value[place] = inner = opened(value[place])
                    if isinstance(inner, (dict, list)):
                        todo.append((inner, False))
    return body, states


def records(body: str | None, paths: bool = True) -> list[tuple]:
    """The records of one body in order: a node, its items, then each of its children likewise; paths=False leaves path null."""
    if body is None or not body.strip():
        return []
    try:
        root, states = run(_loads(body))
    except ValueError:
        return []
    of = lambda v: states.get(id(v)) if isinstance(v, (dict, list)) else transition(v, {})
    while of(root) == "envelope":
        root = root["tree"] if "tree" in root and of(root["tree"]) else root["taxonomy"]
    if of(root) not in TREES:
        return []
    listed = lambda v: v if isinstance(v, list) else [v]
    out: list[tuple] = []
    todo = [(r, 0, (), 1) for r in reversed(listed(root))]
    while todo:
        node, parent, path, depth = todo.pop()
        variant = AS_NODE.get(of(node))
        if variant is None:
            continue
        no = len(out) + 1
        name = node if variant == "node_text" else node["name"] if variant == "node_named" else _level_key(node) if variant == "node_keyed" else ""
        path = (*path, name) if paths else path
        level = node.get("level") if variant != "node_text" else None
        out.append((no, parent, "node", name, variant, level if type(level) is int and abs(level) < 1 << 31 else None, depth, None, list(path) if paths else None))
        if variant == "node_text":
            continue
        for item in listed(node["items"]) if "items" in node and of(node["items"]) else ():
            kind = AS_ITEM.get(of(item))
            if kind == "item_text":
                out.append((len(out) + 1, no, "item", item, kind, None, depth + 1, None, None))
            elif kind:
                label, grade = item.get("name"), item.get("grade")
                out.append((len(out) + 1, no, "item", label if isinstance(label, str) else "", kind, None, depth + 1, grade if isinstance(grade, str) else None, None))
        if "children" in node and of(node["children"]):
            todo += [(c, no, path, depth + 1) for c in reversed(listed(node["children"]))]
    return out


def flatten(docs: DataFrame, key: str, body: str, paths: bool = True) -> DataFrame:
    """(key, rec_no, parent_no, kind, val, variant, level, depth, grade, path) of every body; paths=False leaves path null."""
    names = ["_key", *(f.split()[0] for f in RECORD.split(", "))]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            owner: list[int] = []
            held: list[tuple] = []

            def leave() -> pa.RecordBatch:
                cols = [pa.array(c, t, from_pandas=False) for c, t in zip(zip(*held), _ARROW)]
                return pa.RecordBatch.from_arrays([b.column(0).take(pa.array(owner)), *cols], names)

            for i, text in enumerate(b.column(1).to_pylist()):
                found = records(text, paths)
                for at in range(0, len(found), BATCH):
                    part = found[at : at + BATCH]
                    held += part
                    owner += [i] * len(part)
                    if len(held) >= BATCH:
                        yield leave()
                        owner, held = [], []
            if held:
                yield leave()

    src = docs.select(F.col(key).alias("_key"), F.col(body).alias("_body")).where("_body is not null and _key is not null")
    src = spread(src)
    kind = src.schema["_key"].dataType.simpleString()
    return src.mapInArrow(task, f"_key {kind}, {RECORD}").withColumnRenamed("_key", key)


def _no_tree(text: str) -> str:
    """`no tree` for complete JSON; raises for other text."""
    _loads(text)
    return "no tree"


def unread(docs: DataFrame, flat: DataFrame, key: str, body: str) -> DataFrame:
    """(key, reason): documents without any record in flat: `missing`, `broken` (no complete JSON) or `no tree`."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            why = []
            for text in b.column(1).to_pylist():
                try:
                    why.append("missing" if text is None or not text.strip() else _no_tree(text))
                except ValueError:
                    why.append("broken")
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(why, pa.string())], ["_key", "reason"])

    src = docs.select(F.col(key).alias("_key"), F.col(body).alias("_body")).where("_key is not null")
    src = src.join(flat.select(F.col(key).alias("_key")).distinct(), "_key", "left_anti").select("_key", "_body")
    kind = src.schema["_key"].dataType.simpleString()
    return src.mapInArrow(task, f"_key {kind}, reason string").withColumnRenamed("_key", key)


def subtype_tables(flat: DataFrame, key: str) -> dict[str, DataFrame]:
    """A table per variant: the common keys and the variant's own fields."""
    return {v: flat.where(F.col("variant") == v).select(key, "rec_no", "parent_no", *fields) for v, fields in VARIANTS.items()}


def supertype(flat: DataFrame, key: str) -> DataFrame:
    """The records of all variants under their common keys, with kind and value."""
    return flat.select(key, "rec_no", "parent_no", "kind", "val")


def united(tables: dict[str, DataFrame], key: str) -> DataFrame:
    """The same from the tables of all variants."""
    out = None
    for variant, t in tables.items():
        val = F.col("val") if "val" in t.columns else F.lit("")
        one = t.select(key, "rec_no", "parent_no", F.lit(variant.split("_")[0]).alias("kind"), val.alias("val"))
        out = one if out is None else out.unionByName(one)
    return out
