"""Score catalog rows against rule tables and decide category, level, marker and confidence.

Two plans give the same rows. With few rules everything is one projection: the rules are a constant
array, higher-order functions pick those that fire, and no row moves, so it also runs on streams. With
many, the rows' text variables are unpivoted, their distinct texts meet all keywords in an automaton and
the patterns shard by shard, and what fired is aggregated back per row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank_to_null, strip, tokens
from ..session import BROADCAST_ROWS, checked_broadcast, spread, written
from .match import contained, hot_join
from .rules import TEXT_VARS

#: Conditions up to which the single projection is used.
EXPRESSION_RULES = 2_000
HEADERS = {  # fixed values: header candidates by role
    "field_en": ("字段名", "FieldName", "字段名称", "名称", "英文字段名"),
    "field_cn": ("字段注释", "中文字段名", "中文名称", "字段中文名"),
    "value": ("字段样本", "样本", "数据示例"),
    "table": ("表名", "Table", "表名称"),
}


def bind_headers(columns: list[str]) -> dict[str, str | None]:
    """The column of each role: the first candidate that is there; of equal headers the last."""
    there = {c.strip(): c for c in columns}
    return {role: next((there[c] for c in names if c in there), None) for role, names in HEADERS.items()}


def bound(header: Column) -> Column:
    """The same of an array of headers: a struct of each role's place from 0, -1 where there is none."""
    names = F.transform(header, lambda h: strip(F.coalesce(h, F.lit(""))))
    last = lambda n: F.nullif(F.array_position(F.reverse(names), n), F.lit(0))
    place = lambda ns: F.coalesce(*(F.size(names) - last(n) for n in ns), F.lit(-1)).cast("int")
    return F.struct(*(place(ns).alias(role) for role, ns in HEADERS.items()))


def facts(rows: DataFrame, key: str, roles: dict[str, str | None], sheet: str = "") -> DataFrame:
    """(key, the six text variables) of catalog rows; null and blank are ''."""
    have = lambda role: strip(F.coalesce(F.col(roles[role]).cast("string"), F.lit(""))) if roles.get(role) else F.lit("")
    raw = lambda role, otherwise: F.coalesce(F.col(roles[role]).cast("string"), F.lit(otherwise)) if roles.get(role) else F.lit(otherwise)
    out = spread(rows).select(F.col(key), have("field_en").alias("field_name"), have("field_cn").alias("_cn"), raw("table", sheet).alias("table_name"), raw("value", "").alias("value_text"))
    return out.select(key, tokens("table_name").alias("table_tokens"), tokens("field_name").alias("field_tokens"), "table_name", "field_name", F.coalesce(blank_to_null("_cn"), F.col("field_name")).alias("field_comment"), "value_text")


def _decided(scored: DataFrame, items: Column) -> DataFrame:
    """Adds category, level, rule_id, marker and confidence to rows with score and tags.

    items is an array of structs in rule order.
    """
    has = lambda *t: reduce(lambda a, b: a | b, (F.col("tags").contains(x) for x in t))
    band = F.when(F.col("score") >= 2, F.when(has("VAL_RX", "KW_CN"), "H")).when(F.col("score") >= 1, F.when(has("KW_CN", "KW_EN", "VAL_KW", "VAL_RX"), "M"))
    hit = F.when(F.col("band").isNotNull(), F.filter(items, lambda it: F.col("tags").contains(it["item_tag"])))
    best = F.array_max(F.transform(F.filter("hit", lambda it: it["rank"] > 0), lambda it: F.struct(it["rank"].alias("rank"), (-it["ord"]).alias("ord"), it["level"].alias("level"), it["field"].alias("field"))))
    out = scored.withColumn("band", band).withColumn("hit", hit).withColumn("best", best).withColumn("last", F.try_element_at("hit", F.lit(-1)))
    rid = F.concat(F.lit("U-"), F.substring("best.field", 1, 8), F.lit("-"), F.col("best.level"), F.lit("-"), F.col("band"))
    out = out.withColumn("confidence", F.when(F.col("best").isNull(), "low").when(F.col("band") == "H", "high").otherwise("medium"))
    sure = lambda c: F.when(F.col("confidence") != "low", F.coalesce(c, F.lit(""))).otherwise("")
    return out.withColumns({"category": sure(F.col("last.category")), "level": sure(F.col("best.level")), "rule_id": sure(rid), "marker": F.coalesce("last.field", F.lit("")), "matched": F.col("last").isNotNull()}).drop("band", "hit", "best", "last")


def by_expression(rows: DataFrame, score_rules: DataFrame, items: DataFrame) -> DataFrame:
    """Adds score, tags and the decision to fact rows by one projection; the rule tables are collected."""
    rules = sorted(score_rules.limit(EXPRESSION_RULES + 1).collect(), key=lambda r: r.ord)
    if len(rules) > EXPRESSION_RULES:
        raise ValueError(f"more than {EXPRESSION_RULES} scoring rules; use by_join")
    at = sorted(items.limit(EXPRESSION_RULES + 1).collect(), key=lambda r: r.ord)
    if not rules or not at:
        return _decided(rows.withColumns({"score": F.lit(0).cast("decimal(20,1)"), "tags": F.lit("")}), F.array(F.struct(F.lit(0).alias("ord"), *(F.lit("\0").alias(c) for c in ("field", "category", "level", "item_tag")), F.lit(0).alias("rank"))))

    def fires(r) -> Column:
        test = (lambda v: F.col(v).rlike(r.needle)) if r.is_regex else (lambda v: F.col(v).contains(r.needle))
        return reduce(lambda a, b: a | b, (test(TEXT_VARS[v]) for v in r.vars))

    # tests are written out, so that they are compiled; what follows from a hit is looked up by its place
    hits = F.filter(F.array(*(F.when(fires(r), i) for i, r in enumerate(rules))), lambda h: h.isNotNull())
    weights, tags = F.lit([float(10 * r.weight) for r in rules]), F.lit([f"{r.item_tag}\n{r.tag}" for r in rules])
    out = rows.withColumn("hits", hits)
    out = out.withColumn("score", (F.aggregate("hits", F.lit(0.0), lambda s, h: s + F.get(weights, h)) / 10).cast("decimal(20,1)"))
    named = F.flatten(F.transform("hits", lambda h: F.split(F.get(tags, h), "\n")))
    out = out.withColumn("tags", F.array_join(F.array_distinct(named), " ")).drop("hits")
    listed = F.array(*(F.struct(F.lit(r.ord).alias("ord"), *(F.lit(r[c]).alias(c) for c in ("field", "category", "level", "item_tag")), F.lit(r["rank"]).alias("rank")) for r in at))
    return _decided(out, listed)


def by_join(rows: DataFrame, key: str, score_rules: DataFrame, items: DataFrame) -> DataFrame:
    """The same by joins, for rule tables of any size; key is unique.

    Keywords and patterns are matched with distinct texts only, patterns in broadcast shards; hot texts
    and the many rows without any tag never meet in one task.
    """
    rules = score_rules.select("ord", F.explode("vars").alias("var"), "needle", "is_regex")
    stack = F.explode(F.array(*(F.struct(F.lit(i).alias("var"), F.col(v).alias("txt")) for i, v in enumerate(TEXT_VARS))))
    long = rows.select(key, stack.alias("s")).select(key, "s.var", "s.txt").where("txt <> ''")
    words, patterns = rules.where("not is_regex").drop("is_regex"), written(rules.where("is_regex").drop("is_regex"))
    values = written(long.select("var", "txt").distinct())
    found = contained(values, ["var", "txt"], "txt", words.select("needle")).select("var", "txt", F.explode("needles").alias("needle"))
    fired = found.join(checked_broadcast(words), ["var", "needle"]).select("var", "txt", "ord")
    shards = -(-patterns.count() // BROADCAST_ROWS)
    for s in range(shards):
        part = F.broadcast(patterns.where(F.pmod(F.hash("needle"), F.lit(shards)) == s))
        fired = fired.unionByName(values.join(part, (values["var"] == part["var"]) & F.expr("txt rlike needle")).select(values["var"], "txt", "ord"))
    matched = fired.groupBy("var", "txt").agg(F.collect_set("ord").alias("ords"))  # a text fires no more rules than there are
    per = hot_join(long, written(matched), ["var", "txt"]).select(key, F.explode("ords").alias("ord")).distinct()
    weighed = per.join(checked_broadcast(score_rules.select("ord", "item_tag", "tag", "weight")), "ord")
    per = weighed.groupBy(key).agg(F.sum("weight").alias("score"), F.sort_array(F.collect_list(F.struct("ord", "item_tag", "tag"))).alias("hits"))
    per = written(per.select(key, F.col("score").cast("decimal(20,1)").alias("score"), F.array_join(F.array_distinct(F.flatten(F.transform("hits", lambda r: F.array(r["item_tag"], r["tag"])))), " ").alias("tags")))
    scored = rows.join(per, key, "left").withColumns({"score": F.coalesce("score", F.lit(0).cast("decimal(20,1)")), "tags": F.coalesce("tags", F.lit(""))})
    tagged = per.select("tags").distinct()
    hit = tagged.join(checked_broadcast(items), F.expr("contains(tags, item_tag)")).groupBy("tags").agg(F.sort_array(F.collect_list(F.struct("ord", "field", "category", "level", "item_tag", "rank"))).alias("its"))
    return _decided(hot_join(scored, written(hit), ["tags"], "left"), F.coalesce("its", F.array().cast("array<struct<ord:int,field:string,category:string,level:string,item_tag:string,rank:int>>"))).drop("its")


def split_levels(rows: DataFrame, category: str, depth: int | None = None) -> DataFrame:
    """Adds 1级分类 ... N级分类, as many as the deepest category has, padded with ''."""
    levels = F.filter(F.split(F.coalesce(F.col(category), F.lit("")), "/"), lambda p: p != "")
    if depth is None:
        depth = rows.agg(F.coalesce(F.max(F.size(levels)), F.lit(0))).first()[0]
    return rows.withColumns({f"{i + 1}级分类": F.coalesce(F.get(levels, i), F.lit("")) for i in range(depth)})


def match_ratio(classified: DataFrame) -> DataFrame:
    n = F.count("*")
    return classified.agg(n.alias("total"), F.coalesce(F.sum(F.col("matched").cast("long")), F.lit(0)).alias("matched"), F.coalesce(F.avg(F.col("matched").cast("double")), F.lit(0.0)).alias("ratio"))
