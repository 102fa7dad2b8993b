"""Rule rows to scoring rules: conflict resolution, grouped builders and the rule tables.

A rule row has field_name, category, level, keywords (comma-joined), regexes (joined by ||), citation,
source, priority and its place `ord` in the rule list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import GENERIC_EN, norm, parts

#: The text variables that scoring conditions test, in the order of the fact arrays.
TEXT_VARS = ("table_tokens", "field_tokens", "table_name", "field_name", "field_comment", "value_text")
DEFAULT_PRIORITY = 60


def keyword_list(x: Column) -> Column:
    return F.array_sort(F.array_distinct(parts(norm(x), ",")))


def valid_pattern(x: Column) -> Column:
    """Whether a text compiles as a regular expression of the JVM; null doesn't."""
    return F.try_reflect(F.lit("java.util.regex.Pattern"), F.lit("compile"), x).isNotNull()


def regex_list(x: Column, lower: bool = False) -> Column:
    pieces = F.split(F.coalesce(norm(x) if lower else F.trim(x), F.lit("")), "\\|\\|")
    return F.array_sort(F.array_distinct(F.filter(pieces, lambda p: p != "")))


def resolve_conflicts(rows: DataFrame) -> DataFrame:
    """One row per (field, category): of the lowest priority number, the last row's values.

    Keywords (and regexes) are united over the last rows in a row that have any; a last row without
    them has none. Words are made distinct before they are gathered, so a group carries no more than
    the words of its result. Where there are columns `condition` or `exception`, those of the last rows
    in a row that have any are joined by OR, in the order of the rows and each once.
    """
    expressions = [c for c in ("condition", "exception") if c in rows.columns]
    keyed = rows.select("*", F.concat_ws("|", norm("field_name"), norm("category")).alias("key"), F.coalesce("priority", F.lit(DEFAULT_PRIORITY)).alias("_p"))
    least = keyed.groupBy("key").agg(F.min("_p").alias("_least"), F.min("ord").alias("first_ord"))
    live = keyed.join(least, "key").where("_p = _least")
    live = live.select("*", keyword_list(F.col("keywords")).alias("kw"), regex_list(F.col("regexes"), lower=True).alias("rx"))
    last_empty = live.groupBy("key").agg(
        F.max(F.when(F.size("kw") == 0, F.col("ord"))).alias("kw_gap"),
        F.max(F.when(F.size("rx") == 0, F.col("ord"))).alias("rx_gap"),
        *(F.max(F.when(norm(c) == "", F.col("ord"))).alias(f"{c}_gap") for c in expressions),
    )
    live = live.join(last_empty, "key")

    def united(words: str, gap: str) -> DataFrame:
        after = live.where(F.col(gap).isNull() | (F.col("ord") > F.col(gap)))
        once = after.select("key", F.explode(words).alias("w")).distinct()
        return once.groupBy("key").agg(F.array_sort(F.collect_list("w")).alias(words))

    def joined(expression: str) -> DataFrame:
        gap = f"{expression}_gap"
        after = live.where((F.col(gap).isNull() | (F.col("ord") > F.col(gap))) & (norm(expression) != ""))
        once = after.groupBy("key", norm(expression).alias("e")).agg(F.min("ord").alias("at"))
        listed = F.transform(F.array_sort(F.collect_list(F.struct("at", "e"))), lambda x: x["e"])
        return once.groupBy("key").agg(F.array_join(listed, " OR ").alias(expression))

    scalars = F.max_by(F.struct("field_name", "category", "level", "citation", "source", "_p"), "ord")
    one = live.groupBy("key").agg(F.min("first_ord").alias("ord"), scalars.alias("s"), F.count("*").alias("n_rows"))
    out = one.join(united("kw", "kw_gap"), "key", "left").join(united("rx", "rx_gap"), "key", "left")
    for e in expressions:
        out = out.join(joined(e), "key", "left")
    none = F.array().cast("array<string>")
    out = out.withColumns({"kw": F.coalesce("kw", none), "rx": F.coalesce("rx", none)})
    return out.select("ord", norm("s.field_name").alias("field"), norm("s.category").alias("category"), norm("s.level").alias("level"), F.array_join("kw", ",").alias("keywords"), F.array_join("rx", "||").alias("regexes"), "s.citation", "s.source", F.col("s._p").alias("priority"), "n_rows", *(F.coalesce(e, F.lit("")).alias(e) for e in expressions))


def category_keywords(rows: DataFrame) -> DataFrame:
    """(category, rule_id, keywords): every category's sorted distinct keywords."""
    words = rows.where(norm("category") != "").select(norm("category").alias("category"), F.explode(keyword_list(F.col("keywords"))).alias("kw")).distinct()
    out = words.groupBy("category").agg(F.array_join(F.array_sort(F.collect_list("kw")), ",").alias("keywords"))
    return out.select("category", F.concat(F.lit("C-"), F.substring("category", 1, 10)).alias("rule_id"), "keywords")


def level_patterns(rows: DataFrame) -> DataFrame:
    """(level, rule_id, n_keywords, n_regexes, ...): levels that have both keywords and regexes."""
    named = rows.where(norm("level") != "").select(norm("level").alias("level"), keyword_list(F.col("keywords")).alias("kw"), regex_list(F.col("regexes"), lower=True).alias("rx"))
    both = named.select("level", F.explode(F.concat(F.transform("kw", lambda k: F.struct(F.lit("k").alias("t"), k.alias("v"))), F.transform("rx", lambda k: F.struct(F.lit("r").alias("t"), k.alias("v"))))).alias("e")).select("level", "e.t", "e.v").distinct()
    pick = lambda t: F.array_sort(F.collect_list(F.when(F.col("t") == t, F.col("v"))))
    out = both.groupBy("level").agg(pick("k").alias("kw"), pick("r").alias("rx")).where("size(kw) > 0 and size(rx) > 0")
    return out.select("level", F.concat(F.lit("R-"), "level").alias("rule_id"), F.size("kw").alias("n_keywords"), F.size("rx").alias("n_regexes"), F.array_join("kw", ",").alias("keywords"), F.array_join("rx", "||").alias("regexes"))


def flatten_extraction(documents: DataFrame, priority: int = 50) -> DataFrame:
    """Rule rows of extracted documents(doc_ord, source, extraction).

    extraction is an array of structs of path, citation and items; items have name, level and patterns, a
    struct of keywords_cn, keywords_en and regex. The order of the rows is that of document, place and
    item; a document has fewer than 2**20 places of as many items.
    """
    each = documents.select("doc_ord", "source", F.posexplode("extraction").alias("place", "e"))
    item = each.select("doc_ord", "source", "place", "e.path", "e.citation", F.posexplode("e.items").alias("no", "item"))
    none = F.array().cast("array<string>")
    some = lambda c: F.coalesce(F.col(f"item.patterns.{c}"), none)
    return item.select(
        (F.col("doc_ord").cast("long") * (1 << 40) + F.col("place").cast("long") * (1 << 20) + F.col("no")).alias("ord"),
        F.col("item.name").alias("field_name"),
        F.array_join(F.filter("path", lambda p: F.coalesce(p, F.lit("")) != ""), "/").alias("category"),
        F.col("item.level").alias("level"),
        F.array_join(F.array_union(some("keywords_cn"), some("keywords_en")), ",").alias("keywords"),
        F.array_join(some("regex"), "||").alias("regexes"),
        F.to_json("citation").alias("citation"),
        "source",
        F.lit(priority).alias("priority"),
    )


def rank(level: Column) -> Column:
    """4 for levels that begin with s1 down to 1 for s4; 0 for others."""
    low = F.lower(F.coalesce(level, F.lit("")))
    out = F.lit(0)
    for i in (4, 3, 2, 1):
        out = F.when(low.startswith(f"s{i}"), 5 - i).otherwise(out)
    return out


def rule_tables(combined: DataFrame, drop_regex: bool = False, lower_regex: bool = False) -> tuple[DataFrame, DataFrame]:
    """(score_rules, items) of combined rows(ord, field_name, category, level, keywords, regexes).

    score_rules(ord array, vars array, needle, is_regex, item_tag, tag, weight): the rule fires when any
    of its variables contains (or matches) the needle; patterns that don't compile are left out. items(ord, field, category, level, item_tag,
    rank). Rows without field, category or level are left out.
    """
    base = combined.select("ord", norm("field_name").alias("field"), norm("category").alias("category"), norm("level").alias("level"), keyword_list(F.col("keywords")).alias("kw"), F.filter(regex_list(F.col("regexes"), lower_regex), valid_pattern).alias("rx"))
    base = base.where("field <> '' and category <> '' and level <> ''").withColumn("item_tag", F.concat(F.lit("T-"), F.substring("field", 1, 8), F.lit("-"), F.col("level")))
    english = lambda k: k.rlike("^[a-z]+$")
    generic = lambda k: k.isin(*GENERIC_EN)

    def block(no: int, words: Column, names: tuple[str, ...], tag, weight, is_regex: bool = False) -> Column:
        at = F.array(*(F.lit(TEXT_VARS.index(v)) for v in names))
        return F.transform(words, lambda k, i: F.struct(F.lit(no).alias("block"), i.alias("i"), at.alias("vars"), k.alias("needle"), F.lit(is_regex).alias("is_regex"), tag(k).alias("tag"), weight(k).cast("decimal(10,1)").alias("weight")))

    kw_en, kw_cn = F.filter("kw", english), F.filter("kw", lambda k: ~english(k))
    en_tag = lambda k: F.when(generic(k), "GEN_EN").otherwise("KW_EN")
    en_weight = lambda k: F.when(generic(k), 0.2).otherwise(0.5)
    blocks = [
        block(1, kw_en, ("table_tokens", "field_tokens"), en_tag, en_weight),
        block(2, kw_en, ("table_name", "field_name"), en_tag, en_weight),
        block(3, kw_cn, ("field_comment",), lambda k: F.lit("KW_CN"), lambda k: F.lit(1.5)),
        block(4, F.col("kw"), ("value_text",), lambda k: F.lit("VAL_KW"), lambda k: F.lit(1.0)),
    ]
    if not drop_regex:
        blocks.append(block(5, F.col("rx"), ("value_text",), lambda k: F.lit("VAL_RX"), lambda k: F.lit(2.0), True))
    score = base.select(F.col("ord").alias("item_ord"), "item_tag", F.explode(F.concat(*blocks)).alias("r")).select(F.array("item_ord", "r.block", "r.i").alias("ord"), "r.vars", "r.needle", "r.is_regex", "item_tag", "r.tag", "r.weight")
    items = base.select("ord", "field", "category", "level", "item_tag", rank(F.col("level")).alias("rank"))
    return score, items


def rules_json(score: DataFrame, items: DataFrame) -> DataFrame:
    """(ord, rule): the executable form of every rule as JSON, scoring rules of an item before its decisions."""
    names = F.array(*(F.lit(v) for v in TEXT_VARS))
    text = lambda name, op, value: F.struct(name.alias("name"), F.lit(op).alias("operator"), value.alias("value"))
    tested = F.transform("vars", lambda v: F.struct(F.get(names, v).alias("name"), F.when(F.col("is_regex"), "matches_regex").otherwise("contains").alias("operator"), F.col("needle").alias("value")))
    act = lambda name, key, v: F.to_json(F.struct(F.lit(name).alias("name"), F.struct(v.alias(key)).alias("params")))
    scoring = score.select("ord", F.concat(F.lit('{"conditions":'), F.to_json(F.struct(tested.alias("any"))), F.lit(',"actions":['), F.concat_ws(",", act("add_score", "value", F.col("weight")), act("add_hit", "tag", F.col("item_tag")), act("add_hit", "tag", F.col("tag"))), F.lit("]}")).alias("rule"))
    hit = lambda *tags: F.to_json(F.struct(F.array(*(text(F.lit("hit_tags"), "contains", t) for t in tags)).alias("any")))
    bound = lambda op, v: F.to_json(F.struct(F.lit("score").alias("name"), F.lit(op).alias("operator"), F.lit(v).alias("value")))
    out = scoring
    for no, suffix, bounds, strong in ((6, "H", [("greater_than_or_equal_to", 2.0)], ("VAL_RX", "KW_CN")), (7, "M", [("greater_than_or_equal_to", 1.0), ("less_than", 2.0)], ("KW_CN", "KW_EN", "VAL_KW", "VAL_RX"))):
        tests = F.concat_ws(",", *(bound(o, v) for o, v in bounds), hit(F.col("item_tag")), hit(*(F.lit(t) for t in strong)))
        rid = F.concat(F.lit("U-"), F.substring("field", 1, 8), F.lit("-"), F.col("level"), F.lit(f"-{suffix}"))
        set_level = F.to_json(F.struct(F.lit("set_classification").alias("name"), F.struct(F.col("level").alias("level"), rid.alias("rule_id")).alias("params")))
        acts = F.concat_ws(",", act("set_suggested_category", "category", F.col("category")), set_level, act("set_data_marker", "marker", F.col("field")))
        out = out.unionByName(items.select(F.array(F.col("ord"), F.lit(no), F.lit(0)).alias("ord"), F.concat(F.lit('{"conditions":{"all":['), tests, F.lit(']},"actions":['), acts, F.lit("]}")).alias("rule")))
    return out
