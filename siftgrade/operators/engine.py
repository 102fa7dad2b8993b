"""Executable rules as they are written: [{"conditions": tree, "actions": [{"name", "params"}]}, ...].

Scoring rules (those that add to the score) run first, then decision rules (those that set a
classification), high-confidence ones before others; a rule that does both runs in both. Rules of a
phase are taken together while none tests what an earlier one of them may change; each such batch is a
projection: the places of the rules that fire, in order, from which the row's state is looked up.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .predicate import ACTIONS, compile_tree, conditions_of, valid_patterns
from .rules import TEXT_VARS, rank

#: The state variables that actions change.
CHANGES = {"add_score": "score", "add_hit": "hit_tags", "set_suggested_category": "category_path"}


def load_rules(spark: SparkSession, path: str) -> list[dict]:
    """Rules from a JSON file with a list, or from a text folder with a rule a line."""
    lines = [r.value for r in spark.read.option("wholetext", str(path.endswith(".json")).lower()).text(path).collect()]
    out: list[dict] = []
    for line in lines:
        got = json.loads(line)
        out += got.get("rules", [got]) if isinstance(got, dict) else got
    return out


def usable(spark: SparkSession, rules: Iterable[Mapping]) -> list[Mapping]:
    """Rules whose patterns all compile and whose actions are known."""
    rules = list(rules)
    patterns = [c["value"] for r in rules for c in conditions_of(r["conditions"]) if c["operator"] == "matches_regex"]
    good = valid_patterns(spark, patterns)
    return [r for r in rules if all(c["operator"] != "matches_regex" or c["value"] in good for c in conditions_of(r["conditions"])) and all(a["name"] in ACTIONS for a in r["actions"])]


def _batches(rules: list[Mapping]) -> Iterable[list[Mapping]]:
    batch: list[Mapping] = []
    changed: set[str] = set()
    for r in rules:
        if batch and changed & {c["name"] for c in conditions_of(r["conditions"])}:
            yield batch
            batch, changed = [], set()
        batch.append(r)
        changed |= {CHANGES[a["name"]] for a in r["actions"] if a["name"] in CHANGES}
    if batch:
        yield batch


def _params(rule: Mapping, action: str, key: str) -> list:
    return [a.get("params", {}).get(key) for a in rule["actions"] if a["name"] == action]


def _looked_up(per_rule: list[list[str]]) -> Column:
    """The strings of the rules that fired, in order."""
    table = F.array(*(F.array(*(F.lit(s) for s in strings)).cast("array<string>") for strings in per_rule))
    return F.flatten(F.transform("_fired", lambda i: F.get(table, i)))


def _step(df: DataFrame, batch: list[Mapping], first_only: bool) -> DataFrame:
    variables = {v: F.col(v) for v in TEXT_VARS} | {"category_path": F.col("category_path"), "score": F.col("score"), "hit_tags": F.array_join("hits", " ")}
    fired = F.filter(F.array(*(F.when(compile_tree(r["conditions"], variables), i) for i, r in enumerate(batch))), lambda i: i.isNotNull())
    df = df.withColumn("_fired", F.when(F.size("matched_rule_ids") == 0, F.slice(fired, 1, 1)).otherwise(F.array().cast("array<int>")) if first_only else fired)
    texts = lambda action, key: _looked_up([[str(v) for v in _params(r, action, key) if v not in (None, "")] for r in batch])
    last = lambda action, key, old: F.coalesce(F.try_element_at(texts(action, key), F.lit(-1)), F.col(old))
    weights = F.array(*(F.lit(sum(float(v or 0) for v in _params(r, "add_score", "value"))) for r in batch))
    ops = [
        [json.dumps(["c", a["params"].get("level") or "", a["params"].get("rule_id") or ""] if a["name"] == "set_classification" else ["r", "", a["params"].get("rule_id") or ""], ensure_ascii=False) for a in r["actions"] if a["name"] in ("set_classification", "set_category_rule_id")]
        for r in batch
    ]
    op = F.transform(_looked_up(ops), lambda o: F.from_json(o, "array<string>"))
    best = F.aggregate(op, F.struct(F.col("level").alias("l"), F.col("rule_id").alias("r")), lambda s, o: F.when(F.get(o, 0) == "r", F.struct(s["l"].alias("l"), F.get(o, 2).alias("r"))).when(rank(F.get(o, 1)) > rank(s["l"]), F.struct(F.get(o, 1).alias("l"), F.get(o, 2).alias("r"))).otherwise(s))
    audits = _looked_up([[json.dumps({"citation": a["params"].get("citation"), "source": a["params"].get("source")}, ensure_ascii=False) for a in r["actions"] if a["name"] == "append_audit"] for r in batch])
    return df.withColumns({
        "_best": best,
        "score": F.aggregate("_fired", F.col("score"), lambda s, i: s + F.get(weights, i)),
        "hits": F.array_union("hits", texts("add_hit", "tag")),
        "category_path": last("set_suggested_category", "category", "category_path"),
        "marker": last("set_data_marker", "marker", "marker"),
        "matched_rule_ids": F.array_union("matched_rule_ids", texts("set_classification", "rule_id")),
        "audits": F.concat("audits", audits),
    }).withColumns({"level": F.col("_best.l"), "rule_id": F.col("_best.r")}).drop("_fired", "_best")


def run_rules(facts: DataFrame, rules: Iterable[Mapping], stop_first: bool = False) -> DataFrame:
    """Fact rows with score, tags, category, level, rule_id, marker, confidence, matched, audits and matched_rule_ids.

    With stop_first only the first decision counts. Low-confidence rows keep marker and tags.
    """
    rules = usable(facts.sparkSession, rules)
    named = lambda r, a: any(x["name"] == a for x in r["actions"])
    high = lambda r: any(str(v or "").endswith("-H") for v in _params(r, "set_classification", "rule_id")[:1])
    scoring = [r for r in rules if named(r, "add_score")]
    deciding = sorted((r for r in rules if named(r, "set_classification")), key=lambda r: not high(r))
    none, empty = F.array().cast("array<string>"), F.lit("")
    df = facts.withColumns({"score": F.lit(0.0), "hits": none, "category_path": empty, "marker": empty, "level": empty, "rule_id": empty, "matched_rule_ids": none, "audits": none})
    for phase, first in ((scoring, False), (deciding, stop_first)):
        for batch in _batches(phase):
            df = _step(df, batch, first)
    conf = F.when(F.col("rule_id").endswith("-H"), "high").when(F.col("rule_id").endswith("-M"), "medium").otherwise("low")
    df = df.withColumn("confidence", conf).withColumn("matched", (F.col("category_path") != "") | (F.col("level") != "") | (F.col("rule_id") != ""))
    sure = lambda c: F.when(F.col("confidence") != "low", F.col(c)).otherwise("")
    out = df.withColumns({"tags": F.array_join("hits", " "), "category": sure("category_path"), "level": sure("level"), "rule_id": sure("rule_id"), "audits": F.array_join("audits", ";")})
    return out.drop("hits", "category_path")
