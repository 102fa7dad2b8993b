"""Queries that score, classify and evaluate catalogs, and compile rules."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import blank_to_null
from ..operators import classify, engine, evaluate, labels, predicate, rules
from ..session import table
from . import sql

#: The rule set of the catalog queries: place, item, category, level, keywords, regexes.
CATALOG_ITEMS = [
    (0, "坐标方位", "测绘/位置/坐标", "S3", "坐标,方位,coord,bearing", ""),
    (1, "金额单价", "财务/金额", "S2", "金额,单价,amount,price", r"^\d+\.\d{2}$"),
    (2, "日期时刻", "时间/日期", "S1", "日期,时刻,date,time", r"^\d{4}-\d{2}-\d{2}$"),
    (3, "责任班组", "人员/责任/班组", "S4", "责任,班组,owner,team", ""),
    (4, "编号图号", "标识/编号", "S2", "编号,图号,code,no", r"^[A-Z]\d+[A-Z]\d+$||^\d{6}$"),
    (5, "版本", "标识/版本", "S5", "版本,version", ""),
]
TABLE_ITEMS = [
    (0, "party name", "customer/identity/name", "S3", "c_name,name,customer", r"^Customer#\d{9}$"),
    (1, "segment", "customer/profile", "S2", "segment,mktsegment", ""),
    (2, "priority", "orders/handling", "S1", "priority,URGENT", r"^\d-[A-Z ]+$"),
    (3, "part label", "part/label", "S2", "brand,p_type", r"^Brand#\d+$"),
]
_ITEM = "ord int, field_name string, category string, level string, keywords string, regexes string"
_ROLES = {"table": "tablename", "field_en": "字段名", "field_cn": "字段注释", "value": "字段样本"}
_TABLES = {"customer": ("c_name", "c_mktsegment"), "orders": ("o_orderpriority", "o_orderstatus"), "part": ("p_brand", "p_type"), "supplier": ("s_name",), "nation": ("n_name",)}


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = classify.facts(table(spark, sf_dir, "xlsx_catalog"), "row_id", _ROLES)
    return classify.by_expression(facts, *rules.rule_tables(spark.createDataFrame(CATALOG_ITEMS, _ITEM)))


_OUT = ("score", "tags", "category", "level", "rule_id", "marker", "confidence", "matched")
_FACTS = f"""select row_id, {sql.strip('coalesce("字段名", ' + "'')")} as field_name, coalesce(tablename, '') as table_name,
  coalesce(nullif({sql.strip('"字段注释"')}, ''), {sql.strip('coalesce("字段名", ' + "'')")}) as field_comment, coalesce("字段样本", '') as value_text from xlsx_catalog"""
_CTES = "with " + sql.scored(_FACTS, "row_id", CATALOG_ITEMS)


def classify_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir).select("row_id", *_OUT).withColumn("score", F.col("score").cast("double"))


def classify_catalog_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = classify.facts(table(spark, sf_dir, "xlsx_catalog"), "row_id", _ROLES)
    out = classify.by_join(facts, "row_id", *rules.rule_tables(spark.createDataFrame(CATALOG_ITEMS, _ITEM)))
    return out.select("row_id", *_OUT).withColumn("score", F.col("score").cast("double"))


def classify_by_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog decided by the same rules in their executable form."""
    made = rules.rules_json(*rules.rule_tables(spark.createDataFrame(CATALOG_ITEMS, _ITEM))).orderBy("ord").collect()
    facts = classify.facts(table(spark, sf_dir, "xlsx_catalog"), "row_id", _ROLES)
    return engine.run_rules(facts, [json.loads(r.rule) for r in made]).select("row_id", *_OUT).withColumn("score", F.round("score", 1))


_CLASSIFY = f"{_CTES} select row_id, score::double as score, tags, category, level, rule_id, marker, confidence, matched from decided"


def classify_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of the business tables by their values: (table, field) with scores and confidences."""
    parts = []
    for t, cols in _TABLES.items():
        v = F.explode(F.array(*(F.struct(F.lit(c).alias("f"), F.col(c).alias("v")) for c in cols)))
        parts.append(table(spark, sf_dir, t).select(F.lit(t).alias("t"), v.alias("p")).groupBy("t", "p.f", "p.v").agg(F.count("*").alias("n")))
    values = reduce(DataFrame.unionByName, parts).withColumn("k", F.struct("t", "f", "v", "n"))
    facts = classify.facts(values, "k", {"table": "t", "field_en": "f", "value": "v"})
    out = classify.by_expression(facts, *rules.rule_tables(spark.createDataFrame(TABLE_ITEMS, _ITEM)))
    return out.groupBy("table_name", "field_name", F.col("score").cast("double").alias("score"), "tags", "confidence").agg(F.sum("k.n").alias("n"))


_VALUES = " union all ".join(f"select '{t}' as table_name, '{c}' as field_name, {c} as value_text, count(*) as n from {t} group by {c}" for t, cols in _TABLES.items() for c in cols)
_TABLES_SQL = f"""with given as (select row_number() over () as k, * from ({_VALUES})), {sql.scored("select k, field_name, table_name, field_name as field_comment, coalesce(value_text, '') as value_text from given", "k", TABLE_ITEMS)}
select table_name, field_name, score::double as score, tags, confidence, sum(n)::bigint as n from decided join given using (k) group by all"""


def confidence_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir).groupBy("confidence", "level", "marker").agg(F.count("*").alias("n"))


def match_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.match_ratio(_classified(spark, sf_dir)).select("total", "matched", F.round("ratio", 9).alias("ratio"))


def split_category_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.split_levels(_classified(spark, sf_dir).select("row_id", "category"), "category")


def _rule_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "rule_rows")
    return r.select(F.col("rule_id").alias("ord"), F.col("fieldname").alias("field_name"), "category", "level", F.col("patternkeywords").alias("keywords"), F.col("patternregex").alias("regexes"), "citation", "source", "priority")


def _dynamic_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "dynamic_rules")
    return r.select(F.col("dyn_id").alias("ord"), F.col("fieldname").alias("field_name"), "category", "level", F.col("patternkeywords").alias("keywords"), F.col("patternregex").alias("regexes"), "citation", "source", "priority")


def resolve_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rules.resolve_conflicts(_rule_rows(spark, sf_dir))
    return out.select("ord", "field", "category", "level", "keywords", "regexes", "source", "priority", "n_rows")


_RX = "list_sort(list_distinct(list_filter(string_split({x}, '||'), lambda w: w <> '')))"
_RESOLVE = f"""with base as (select rule_id as o, {sql.norm('fieldname')} as f, {sql.norm('category')} as c, {sql.norm('level')} as l, source, coalesce(priority, 60) as p,
  {sql.words('patternkeywords')} as kw, {_RX.format(x=sql.norm('patternregex'))} as rx from rule_rows),
live as (select *, min(o) over (partition by f || '|' || c) as first_o, min(p) over (partition by f || '|' || c) as least from base),
last as (select *, max(case when len(kw) = 0 then o end) over (partition by f || '|' || c) as kg, max(case when len(rx) = 0 then o end) over (partition by f || '|' || c) as rg from live where p = least)
select min(first_o) as ord, f as field, c as category, arg_max(l, o) as level, arg_max(source, o) as source, min(p)::int as priority, count(*) as n_rows,
  array_to_string(list_sort(list_distinct(flatten(coalesce(list(kw) filter (where kg is null or o > kg), [])))), ',') as keywords,
  array_to_string(list_sort(list_distinct(flatten(coalesce(list(rx) filter (where rg is null or o > rg), [])))), '||') as regexes
from last group by f, c, f || '|' || c"""


def category_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.category_keywords(_rule_rows(spark, sf_dir))


_CATEGORY_KW = f"""select c as category, 'C-' || substring(c, 1, 10) as rule_id, string_agg(distinct w, ',' order by w) as keywords
from (select {sql.norm('category')} as c, unnest({sql.words('patternkeywords')}) as w from rule_rows) where c <> '' group by c"""


def level_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.level_patterns(_rule_rows(spark, sf_dir)).select("level", "rule_id", F.col("n_keywords").cast("long").alias("n_keywords"), F.col("n_regexes").cast("long").alias("n_regexes"))


_LEVELS = f"""with r as (select {sql.norm('level')} as level, {sql.words('patternkeywords')} as kw, {_RX.format(x=sql.norm('patternregex'))} as rx from rule_rows),
k as (select level, count(distinct w) as n_keywords from (select level, unnest(kw) as w from r) group by level),
x as (select level, count(distinct w) as n_regexes from (select level, unnest(rx) as w from r) group by level)
select level, 'R-' || level as rule_id, n_keywords, n_regexes from k join x using (level) where level <> ''"""


def compile_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scoring rules that hand-kept rows expand to, counted and weighed by kind."""
    score, _ = rules.rule_tables(_dynamic_rows(spark, sf_dir))
    return score.groupBy("tag").agg(F.count("*").alias("n"), F.sum("weight").cast("double").alias("weight"))


_COMPILE = f"""with r as (select {sql.norm('fieldname')} as f, {sql.norm('category')} as c, {sql.norm('level')} as l, {sql.words('patternkeywords')} as kw, {_RX.format(x="trim(coalesce(patternregex, ''))")} as rx from dynamic_rules),
w as (select unnest(kw) as w from r where f <> '' and c <> '' and l <> ''),
s as (select case when not regexp_matches(w, '^[a-z]+$') then 'KW_CN' when w in ({", ".join(map(sql.q, sql.GENERIC_EN))}) then 'GEN_EN' else 'KW_EN' end as tag from w),
e as (select tag, case tag when 'KW_CN' then 1 else 2 end as n, case tag when 'KW_CN' then 1.5 when 'GEN_EN' then 0.4 else 1.0 end as wt from s
  union all select 'VAL_KW', 1, 1.0 from w union all select 'VAL_RX', 1, 2.0 from (select unnest(rx) from r where f <> '' and c <> '' and l <> ''))
select tag, sum(n)::bigint as n, sum(wt)::double as weight from e group by tag"""


def rules_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The executable rules of the hand-kept rows as JSON."""
    return rules.rules_json(*rules.rule_tables(_dynamic_rows(spark, sf_dir))).select(F.array_join(F.transform("ord", lambda o: o.cast("string")), ".").alias("ord"), "rule")


def all_rule_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracted and hand-kept rule rows as one list, by source kind and priority."""
    both = _rule_rows(spark, sf_dir).withColumn("kind", F.lit("static")).unionByName(_dynamic_rows(spark, sf_dir).withColumn("kind", F.lit("dynamic")))
    return both.groupBy("kind", F.coalesce("priority", F.lit(rules.DEFAULT_PRIORITY)).alias("priority")).agg(F.count("*").alias("n"), F.countDistinct("field_name").alias("fields"))


_ALL_RULES = """select kind, coalesce(priority, 60)::int as priority, count(*) as n, count(distinct fieldname) as fields from
(select 'static' as kind, priority, fieldname from rule_rows union all select 'dynamic', priority, fieldname from dynamic_rules) group by all"""

_TREE = {"all": [{"any": [{"name": "flag", "operator": "equal_to", "value": "R"}, {"name": "status", "operator": "starts_with", "value": "F"}]}, {"name": "quantity", "operator": "greater_than_or_equal_to", "value": 20}, {"name": "discount", "operator": "less_than", "value": 0.05}]}


def predicate_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    test = predicate.compile_tree(_TREE, {"flag": F.col("l_returnflag"), "status": F.col("l_linestatus"), "quantity": F.col("l_quantity"), "discount": F.col("l_discount")})
    return li.where(test).groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("long")).alias("quantity"))


_PREDICATE = """select l_returnflag, l_linestatus, count(*) as n, sum(l_quantity::bigint)::bigint as quantity from lineitem
where (l_returnflag = 'R' or l_linestatus like 'F%') and l_quantity >= 20 - 1e-6 and 0.05 - l_discount > 1e-6 group by all"""

_PAIRS = {"level": ("truth", "pred")}


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    truth = table(spark, sf_dir, "xlsx_catalog").select("row_id", blank_to_null(labels.grade(F.col("分级"))).alias("truth"))
    return _classified(spark, sf_dir).select("row_id", F.upper(F.nullif(F.col("level"), F.lit(""))).alias("pred"), "confidence", F.nullif(F.col("marker"), F.lit("")).alias("marker")).join(truth, "row_id")


def _judged_local(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same without a join: truth rides along as part of the key."""
    rows = table(spark, sf_dir, "xlsx_catalog").withColumn("at", F.struct("row_id", blank_to_null(labels.grade(F.col("分级"))).alias("truth")))
    out = classify.by_expression(classify.facts(rows, "at", _ROLES), *rules.rule_tables(spark.createDataFrame(CATALOG_ITEMS, _ITEM)))
    return out.select("at.row_id", "at.truth", F.upper(F.nullif(F.col("level"), F.lit(""))).alias("pred"), "confidence", F.nullif(F.col("marker"), F.lit("")).alias("marker"))


def _grade_sql(x: str) -> str:
    s = f"replace(upper({x}), ' ', '')"
    tests = " ".join(f"when contains({s}, 'S{i}') then 'S{i}'" for i in (1, 2, 3, 4))
    more = " ".join(f"when contains({s}, 'G-{i}') or contains({s}, 'G{i}') or contains(upper({x}), '{h}级') then 'S{i}'" for i, h in enumerate("一二三四", 1))
    return f"case when coalesce({x}, '') = '' then '' {tests} {more} end"


_JUDGED = f"""{_CTES}, judged as (select d.row_id, nullif({_grade_sql('"分级"')}, '') as truth, upper(nullif(level, '')) as pred, confidence, nullif(marker, '') as marker from decided d join xlsx_catalog using (row_id))"""
_ACC = "round(coalesce(sum((truth = pred)::int)::double / nullif(count(truth = pred), 0), 0.0), 9) as accuracy, coalesce(sum((truth = pred)::int), 0)::bigint as correct, count(truth = pred) as total"


def accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.accuracies(_judged_local(spark, sf_dir), _PAIRS).withColumn("accuracy", F.round("accuracy", 9))


def accuracy_by_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.accuracy_by_confidence(_judged_local(spark, sf_dir), "truth", "pred", "confidence").withColumn("accuracy", F.round("accuracy", 9))


def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.confusion(_judged_local(spark, sf_dir), "truth", "pred")


def confusion_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.confusion_wide(evaluate.confusion(_judged_local(spark, sf_dir), "truth", "pred"), ["S1", "S2", "S3", "S4", "<NA>"])


def metrics_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.metrics(_judged_local(spark, sf_dir), _PAIRS, "truth").withColumn("value", F.round("value", 9))


def aligned_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Truth and prediction joined from two tables, row by row."""
    j = _judged(spark, sf_dir)
    return j.groupBy("confidence").agg(F.count("*").alias("n"), F.sum(F.coalesce((F.col("truth") == F.col("pred")).cast("long"), F.lit(0))).alias("equal"))


def catalog_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.profile(table(spark, sf_dir, "xlsx_catalog")).select("name", "n_rows", "n_null")


_PROFILE = " union all ".join(f"select '{c}' as name, count(*) as n_rows, count(*) - count(\"{c}\") as n_null from xlsx_catalog" for c in ("row_id", "dbname", "tablename", "字段名", "字段类型", "字段注释", "字段样本", "分类", "分级", "exported_at", "loaded_at"))


def rows_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.rows_json(table(spark, sf_dir, "xlsx_catalog"), ["字段名", "字段注释", "字段样本"], ["分类", "分级"])


def rule_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many hand-kept rules break the rules for extracted items."""
    d = table(spark, sf_dir, "dynamic_rules")
    return evaluate.data_checks(d.select(F.col("fieldname").alias("name"), "level", F.split("patternkeywords", ",").alias("keywords")))


_CHECKS = """select 'bad_level' as "check", count(*) filter (where not regexp_matches(coalesce(level, ''), '^(S[0-9]+(-[0-9]+)?)?$')) as n from dynamic_rules union all
select 'repeated_keyword', count(*) filter (where len(string_split(patternkeywords, ',')) <> len(list_distinct(string_split(patternkeywords, ',')))) from dynamic_rules union all
select 'empty_name', count(*) filter (where trim(coalesce(fieldname, '')) = '') from dynamic_rules union all
select 'shared_keyword', count(*) from (select kw from (select fieldname, unnest(string_split(patternkeywords, ',')) as kw from dynamic_rules) group by kw having count(distinct fieldname) > 1)"""

QUERIES = {
    "rule_checks": rule_checks,
    "classify_catalog": classify_catalog,
    "classify_catalog_join": classify_catalog_join,
    "classify_by_rules": classify_by_rules,
    "classify_tables": classify_tables,
    "confidence_split": confidence_split,
    "match_ratio": match_ratio,
    "split_category_columns": split_category_columns,
    "resolve_conflicts": resolve_conflicts,
    "category_keywords": category_keywords,
    "level_patterns": level_patterns,
    "compile_rules": compile_rules,
    "rules_export": rules_export,
    "all_rule_rows": all_rule_rows,
    "predicate_tree": predicate_tree,
    "accuracy": accuracy,
    "accuracy_by_confidence": accuracy_by_confidence,
    "confusion_matrix": confusion_matrix,
    "confusion_wide": confusion_wide,
    "metrics_union": metrics_union,
    "aligned_evaluation": aligned_evaluation,
    "catalog_profile": catalog_profile,
    "rows_export": rows_export,
}
SQL = {
    "rule_checks": _CHECKS,
    "classify_catalog": _CLASSIFY,
    "classify_catalog_join": _CLASSIFY,
    "classify_by_rules": _CLASSIFY,
    "classify_tables": _TABLES_SQL,
    "confidence_split": f"{_CTES} select confidence, level, marker, count(*) as n from decided group by all",
    "match_ratio": f"{_CTES} select count(*) as total, sum(matched::int)::bigint as matched, round(avg(matched::int), 9) as ratio from decided",
    "split_category_columns": f"""{_CTES} select row_id, category, coalesce(split_part(category, '/', 1), '') as "1级分类", split_part(category, '/', 2) as "2级分类", split_part(category, '/', 3) as "3级分类" from decided""",
    "resolve_conflicts": _RESOLVE,
    "category_keywords": _CATEGORY_KW,
    "level_patterns": _LEVELS,
    "compile_rules": _COMPILE,
    "all_rule_rows": _ALL_RULES,
    "predicate_tree": _PREDICATE,
    "accuracy": f"{_JUDGED} select 'level' as metric, {_ACC} from judged",
    "accuracy_by_confidence": f"{_JUDGED} select ord::int as ord, bucket, coalesce(accuracy, 0.0) as accuracy, coalesce(correct, 0)::bigint as correct, coalesce(total, 0)::bigint as total from (values (0, 'high'), (1, 'medium'), (2, 'low')) b(ord, bucket) left join (select confidence as bucket, {_ACC} from judged group by confidence) using (bucket)",
    "confusion_matrix": f"{_JUDGED} select coalesce(truth, '<NA>') as truth, coalesce(pred, '<NA>') as pred, count(*) as n from judged group by all",
    "confusion_wide": f"""{_JUDGED} select coalesce(truth, '<NA>') as truth, count(*) filter (where pred = 'S1') as "S1", count(*) filter (where pred = 'S2') as "S2", count(*) filter (where pred = 'S3') as "S3", count(*) filter (where pred = 'S4') as "S4", count(*) filter (where pred is null) as "<NA>" from judged group by 1""",
    "metrics_union": f"{_JUDGED} select 'accuracy_level' as metric, round(coalesce(sum((truth = pred)::int)::double / nullif(count(truth = pred), 0), 0.0), 9) as value from judged union all select 'labelled_rows', count(truth)::double from judged",
    "aligned_evaluation": f"{_JUDGED} select confidence, count(*) as n, sum(coalesce((truth = pred)::int, 0))::bigint as equal from judged group by confidence",
    "catalog_profile": _PROFILE,
}
