"""Condition trees as boolean columns: {"all"|"any": [condition | tree, ...]}, nested at will."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Numbers this near count as equal.
EPSILON = 1e-6


def _number(v) -> float:
    return float(v)


OPERATORS: dict[str, Callable[[Column, object], Column]] = {
    "equal_to": lambda c, v: c == F.lit(v) if isinstance(v, str) else F.abs(c - _number(v)) <= EPSILON,
    "equal_to_case_insensitive": lambda c, v: F.lower(c) == F.lit(str(v).lower()),
    "starts_with": lambda c, v: c.startswith(v),
    "ends_with": lambda c, v: c.endswith(v),
    "contains": lambda c, v: c.contains(v),
    "matches_regex": lambda c, v: c.rlike(v),
    "non_empty": lambda c, v: c != "",
    "greater_than": lambda c, v: c - _number(v) > EPSILON,
    "greater_than_or_equal_to": lambda c, v: c - _number(v) >= -EPSILON,
    "less_than": lambda c, v: F.lit(_number(v)) - c > EPSILON,
    "less_than_or_equal_to": lambda c, v: F.lit(_number(v)) - c >= -EPSILON,
}
TEXT_OPERATORS = ("equal_to", "equal_to_case_insensitive", "starts_with", "ends_with", "contains", "matches_regex", "non_empty")
NUMERIC_OPERATORS = ("equal_to", "greater_than", "greater_than_or_equal_to", "less_than", "less_than_or_equal_to")
#: Variables a rule may test, and actions it may take.
VARIABLES = {"field_name": "text", "field_comment": "text", "table_name": "text", "field_tokens": "text", "table_tokens": "text", "category_path": "text", "value_text": "text", "hit_tags": "text", "score": "numeric"}
ACTIONS = {
    "set_classification": ("level:text", "rule_id:text"),
    "append_audit": ("citation:text", "source:text"),
    "set_suggested_category": ("category:text",),
    "set_category_rule_id": ("rule_id:text",),
    "add_score": ("value:numeric",),
    "add_hit": ("tag:text",),
    "set_data_marker": ("marker:text",),
}


def compile_tree(tree: Mapping | str, variables: Mapping[str, Column]) -> Column:
    """The tree as a column over the named variables; nulls test false. An empty list is an error."""
    if isinstance(tree, str):
        tree = json.loads(tree)
    for word, joined in (("all", lambda a, b: a & b), ("any", lambda a, b: a | b)):
        if word in tree:
            if not tree[word]:
                raise ValueError(f"empty list under {word!r}")
            return reduce(joined, (compile_tree(t, variables) for t in tree[word]))
    if tree["name"] not in variables:
        raise ValueError(f"no variable {tree['name']!r}")
    return F.coalesce(OPERATORS[tree["operator"]](variables[tree["name"]], tree.get("value")), F.lit(False))


def conditions_of(tree: Mapping) -> list[Mapping]:
    """All leaf conditions of a tree, nested ones included."""
    out, todo = [], [tree]
    while todo:
        t = todo.pop()
        below = [*t.get("all", ()), *t.get("any", ())]
        todo += below
        if "name" in t:
            out.append(t)
    return out


def valid_patterns(spark: SparkSession, patterns: list[str]) -> set[str]:
    """Those patterns that the JVM's regular expressions compile."""
    out, compiler = set(), spark._jvm.java.util.regex.Pattern
    for p in dict.fromkeys(patterns):
        try:
            compiler.compile(p)
            out.add(p)
        except Exception:  # noqa: BLE001 - a Java PatternSyntaxException behind the gateway
            continue
    return out


def metadata(spark: SparkSession) -> DataFrame:
    """(kind, name, type, detail): variables, operators and actions for a rule-authoring tool."""
    rows = [("variable", n, t, "") for n, t in VARIABLES.items()]
    rows += [("operator", n, "text", "") for n in TEXT_OPERATORS] + [("operator", n, "numeric", "") for n in NUMERIC_OPERATORS]
    rows += [("action", n, "", ",".join(p)) for n, p in ACTIONS.items()]
    return spark.createDataFrame(rows, "kind string, name string, type string, detail string")
