"""Queries over guide texts, taxonomies, labels and JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import fragments, labels, nested, retrieval, taxonomy
from ..session import table, written
from . import sql

#: Keywords that every path shares when fragments are looked up.
SHARED = ["assets", "keyword", "关键词", "字段", "catalog", "grade"]


def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "xlsx_catalog")
    return c.select("row_id", T.clean_cell("字段注释").alias("comment"), T.tokens("字段名").alias("tokens"), T.normalize_category("分类").alias("category"), T.norm("tablename").alias("tablename"))


_CLEAN = f"""select row_id, {sql.strip("regexp_replace(coalesce(\"字段注释\", ''), '" + sql.Z + "+', ' ', 'g')")} as comment, {sql.tokens('"字段名"')} as tokens,
  coalesce(array_to_string(list_filter(list_transform(string_split(replace("分类", chr(92), '/'), '/'), lambda p: {sql.strip('p')}), lambda p: p <> ''), '/'), '') as category, {sql.norm('tablename')} as tablename from xlsx_catalog"""


def title_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = fragments.text_lines(table(spark, sf_dir, "documents"), "doc_id", "text")
    return lines.select("doc_id", "ord", T.title_level("line").alias("level")).where("level <> ''").withColumn("ord", F.col("ord").cast("long"))


_LINES = f"lines as (select doc_id, i - 1 as ord, line from (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as i from documents where text is not null) where {sql.strip('line')} <> '')"


def paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = fragments.text_lines(table(spark, sf_dir, "documents"), "doc_id", "text")
    return fragments.paragraphs(lines, "doc_id").select("doc_id", F.col("first_ord").cast("long").alias("first_ord"), "text", "level", "type")


_PARAGRAPHS = f"""with {_LINES},
m as (select *, {sql.strip('line')} as t, regexp_extract(line, '^([0-9]+(\\.[0-9]+)*)\\s+', 1) as level from lines),
b as (select *, (level <> '' or coalesce(lag(level) over w <> '', true))::int as brk from m window w as (partition by doc_id order by ord)),
g as (select *, sum(brk) over (partition by doc_id order by ord) as island from b)
select doc_id, min(ord) as first_ord, string_agg(t, ' ' order by ord) as text, arg_min(level, ord) as level, case when arg_min(level, ord) <> '' then 'title' else 'paragraph' end as type from g group by doc_id, island"""


def guide_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = fragments.text_lines(table(spark, sf_dir, "documents"), "doc_id", "text")
    out = fragments.guide_text(fragments.paragraphs(lines, "doc_id"), "doc_id", 4_000)
    return out.select("doc_id", F.md5("guide_text").alias("digest"), F.col("n_chars").cast("long").alias("n_chars"), "too_long")


def pii_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with strongly formatted values, counted by kind."""
    kinds = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "url": r"https?://[A-Za-z0-9./?=_-]+", "ipv4": r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}", "phone": r"1[3-9][0-9]{9}"}
    docs = table(spark, sf_dir, "documents").where("text is not null")
    return docs.agg(*(F.count(F.when(F.col("text").rlike(rx), 1)).alias(k) for k, rx in kinds.items()))


_PII = r"""select count(*) filter (where regexp_matches(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}')) as email, count(*) filter (where regexp_matches(text, 'https?://[A-Za-z0-9./?=_-]+')) as url,
  count(*) filter (where regexp_matches(text, '[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}')) as ipv4, count(*) filter (where regexp_matches(text, '1[3-9][0-9]{9}')) as phone from documents"""


def down_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of each event type, blank where odd, filled from the event before."""
    e = table(spark, sf_dir, "events").select("event_id", "event_type", F.when(F.col("event_id") % 3 == 0, F.col("props")).otherwise("").alias("v"), F.lit("c").alias("c"))
    return fragments.down_fill(e, "event_type", "event_id", "c", "v").select("event_id", "event_type", "v")


_DOWNFILL = """select event_id, event_type, coalesce(last_value(case when event_id % 3 = 0 then nullif(trim(props), '') end ignore nulls) over (partition by event_type order by event_id), '') as v from events"""


def _grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "xlsx_rows").select("file_id", "row_no", F.transform("cells", lambda c: F.coalesce(c["v"], F.lit(""))).alias("cells"))
    heads = table(spark, sf_dir, "xlsx_files").select("file_id", F.lit(0).alias("row_no"), F.col("header").alias("cells"))
    return fragments.grouped_rows(heads.unionByName(rows), "file_id", "row_no", "cells")


def row_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The groups that the rows of every workbook form by their first column."""
    return _grouped(spark, sf_dir).groupBy("file_id", "group").agg(F.min("ord").alias("first_ord"), F.count("*").alias("n_rows"))


def row_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of every workbook as a map from header to value, a row per entry."""
    m = F.from_json("fields", "map<string,string>")
    return _grouped(spark, sf_dir).select("file_id", "ord", F.explode(m).alias("name", "val"))


_C0 = sql.strip("regexp_replace(coalesce(cells[1].v, ''), '" + sql.Z + "+', ' ', 'g')")
_ROW_GROUPS = f"""select file_id, coalesce(nullif({_C0}, ''), '未命名') as "group", min(row_no) as first_ord, count(*) as n_rows from xlsx_rows
where len(list_filter(cells, lambda c: {sql.strip("coalesce(c.v, '')")} <> '')) > 0 group by all"""


def _paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "category_ref").select(F.col("cat_id").alias("path_ord"), T.parts("path", "/").alias("path"))


def _lookup(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    paths = _paths(spark, sf_dir).withColumn("tokens", taxonomy.tokens_at(F.col("path")))
    frags = table(spark, sf_dir, "documents").where("text is not null").select(F.col("doc_id").alias("frag_ord"), "text", "page")
    return paths, frags, retrieval.top_fragments(paths, frags, SHARED, 3)


def fragments_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lookup(spark, sf_dir)[2].select("path_ord", "frag_ord", F.col("score").cast("long").alias("score"), F.col("rank").cast("long").alias("rank"))


_KW = ", ".join(map(sql.q, SHARED))
_TOP = f"""with p as (select cat_id as path_ord, path, list_distinct(list_concat(string_split(path, '/'), [{_KW}])) as kws from category_ref),
f as (select doc_id as frag_ord, text, page from documents where text is not null),
s as (select path_ord, frag_ord, len(list_filter(kws, lambda k: contains(text, k))) as score from p, f),
r as (select *, row_number() over (partition by path_ord order by score desc, frag_ord) as rank from s where score > 0),
topk as (select * from r where rank <= 3)"""


def fragments_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fragments of each branch, every page and opening once."""
    paths, frags, top = _lookup(spark, sf_dir)
    groups = paths.select("path_ord", F.array_join(F.slice("path", 1, 2), "/").alias("grp"))
    return retrieval.group_fragments(top, groups, frags, 12).withColumn("place", F.col("place").cast("long"))


_DEDUP = _TOP + """, g as (select t.*, string_split(path, '/')[1] || '/' || string_split(path, '/')[2] as grp, page, substring(text, 1, 64) as opening from topk t join p using (path_ord) join f using (frag_ord)),
o as (select *, row_number() over (partition by grp, page, opening order by path_ord, rank) as n from g)
select grp, frag_ord, place from (select grp, frag_ord, row_number() over (partition by grp order by path_ord, rank) as place from o where n = 1) where place <= 12"""


def fragments_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths whose own tokens no document holds fall back to the first documents."""
    paths = _paths(spark, sf_dir).withColumn("tokens", F.array(F.concat(F.element_at("path", -1), F.element_at("path", 1))))
    frags = table(spark, sf_dir, "documents").where("text is not null").select(F.col("doc_id").alias("frag_ord"), "text")
    return retrieval.top_fragments(paths, frags, [], 3).select("path_ord", "frag_ord", F.col("score").cast("long").alias("score"), F.col("rank").cast("long").alias("rank"))


_FALLBACK = """with p as (select cat_id as path_ord, string_split(path, '/')[3] || string_split(path, '/')[1] as k from category_ref), f as (select doc_id as frag_ord, text from documents where text is not null),
r as (select path_ord, frag_ord, 1 as score, row_number() over (partition by path_ord order by frag_ord) as rank from p, f where contains(text, k)),
first3 as (select frag_ord, row_number() over (order by frag_ord) as rank from f)
select path_ord, frag_ord, score::bigint as score, rank from r where rank <= 3 union all
select path_ord, frag_ord, 0::bigint, rank from p, first3 where rank <= 3 and path_ord not in (select path_ord from r)"""


def path_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "xlsx_catalog").select(F.col("row_id").alias("path_ord"), T.parts("分类", "/").alias("path")).where("size(path) > 0")
    return retrieval.batches(c, 1, 20).withColumn("batch", F.col("batch").cast("long"))


_BATCHES = f"""with c as (select row_id as path_ord, list_filter(list_transform(string_split("分类", '/'), lambda p: {sql.strip('p')}), lambda p: p <> '') as path from xlsx_catalog where "分类" is not null)
select path_ord, path[1] as bucket, ((row_number() over (partition by path[1] order by path_ord) - 1) // 20)::bigint as batch from c where len(path) > 0"""


def order_restore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog rows under the place of their category in the reference."""
    seeds = table(spark, sf_dir, "category_ref").select("path", F.col("cat_id").alias("path_ord"))
    return retrieval.restore_order(table(spark, sf_dir, "xlsx_catalog").select("row_id", F.col("分类").alias("path")), seeds)


def payload_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Characters a call would carry for the guide texts of each domain, and whether one call can.

    The payload is the domain, the seeds (level definitions, and leaf paths of the merged templates with
    their items) and the texts with their pages.
    """
    at = F.coalesce("domain", F.lit("general")).alias("domain")
    docs = table(spark, sf_dir, "documents").where("text is not null").select(at, F.struct("text", "page").alias("fragment"))
    flat, bodies = _flat(spark, sf_dir), table(spark, sf_dir, "gbt_template").select(F.col("tax_id").alias("doc"), at, "body")
    tree = written(_merged(spark, sf_dir, flat))
    inside = tree.select("grp", F.slice("path", 1, F.size("path") - 1).alias("path")).distinct()
    leaf = tree.join(inside, ["grp", "path"], "left_anti").select(F.col("grp").alias("domain"), F.filter("path", lambda p: p != "").alias("path"), F.when(F.size("items") > 0, F.col("items")).alias("items"))
    paths = leaf.where("size(path) > 0").select("domain", F.struct("path", "items").alias("path"))
    read = bodies.join(flat.select(F.col("tax_id").alias("doc")).distinct(), "doc", "left_semi")
    defined = F.coalesce(F.get_json_object("body", "$.levels_definition"), F.get_json_object("body", "$.taxonomy.levels_definition"))
    levels = read.select("domain", F.regexp_extract(defined, r"(?s)^\[(.*)\]$", 1).alias("level")).where("level <> ''")
    return retrieval.request_chars(docs, paths, levels, "domain").select("domain", "chars", "single")


def hierarchy_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "xlsx_catalog").where("`分类` is not null").select(F.split("分类", "/").alias("path"))
    return taxonomy.hierarchy(c)


_PATHS = f"""paths as (select distinct list_filter(list_transform(string_split("分类", '/'), lambda p: {sql.strip('p')}), lambda p: p <> '') as p from xlsx_catalog where "分类" is not null)"""
_HIERARCHY = f"""with {_PATHS}, n as (select p, unnest(generate_series(1, len(p))) as d from paths where len(p) > 0)
select distinct array_to_string(p[1:d], '/') as id, case when d > 1 then array_to_string(p[1:d-1], '/') end as parent_id, d::int as depth, p[d] as name from n"""


def prefix_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "xlsx_catalog").select("row_id", T.parts("分类", "/").alias("path"))
    return taxonomy.under(c, ["港口航运", "货物装卸"]).select("row_id", F.array_join("path", "/").alias("path"))


def distinct_at_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "xlsx_catalog").select(T.parts("分类", "/").alias("path"))
    return taxonomy.distinct_at(c, 1, ["港口航运"])


_UNDER = f"""with c as (select row_id, list_filter(list_transform(string_split(coalesce("分类", ''), '/'), lambda p: {sql.strip('p')}), lambda p: p <> '') as p from xlsx_catalog)"""


def _flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return written(nested.flatten(table(spark, sf_dir, "gbt_template"), "tax_id", "body"))


def tree_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf paths of every template and the items on them."""
    out = taxonomy.leaves(_flat(spark, sf_dir), "tax_id")
    return out.select("doc", "path_ord", F.array_join("path", "/").alias("path"), F.array_join("items", "|").alias("items"))


def _merged(spark: SparkSession, sf_dir: str, flat: DataFrame | None = None) -> DataFrame:
    nodes, items = taxonomy.paths_of(_flat(spark, sf_dir) if flat is None else flat, "tax_id")
    of = table(spark, sf_dir, "gbt_template").select(F.col("tax_id").alias("doc"), F.coalesce("domain", F.lit("general")).alias("domain"))
    return taxonomy.merged(nodes.join(of, "doc"), items.join(of, "doc"), F.col("domain"))


def tree_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The templates of each domain as one tree, a row per path."""
    return _merged(spark, sf_dir).select("grp", F.array_join("path", "/").alias("path"), "level", F.array_join("items", "|").alias("items"))


def tree_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merged trees written as nested JSON and read again, a row per path."""
    made = written(tree_json(spark, sf_dir))
    nodes, items = taxonomy.paths_of(nested.flatten(made, "grp", "tree"), "grp")
    of = items.groupBy("doc", "path").agg(F.array_join(F.array_sort(F.collect_list("item")), "|").alias("items"))
    return nodes.join(of, ["doc", "path"], "left").select(F.col("doc").alias("grp"), F.array_join("path", "/").alias("path"), "level", F.coalesce("items", F.lit("")).alias("items"))


def tree_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merged tree of each domain as nested JSON."""
    return taxonomy.nested_json(written(_merged(spark, sf_dir)))


def grade_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "xlsx_catalog").select("row_id", labels.grade(F.col("分级")).alias("grade"), labels.level_number(F.col("分级")).alias("level"))


def header_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    heads = table(spark, sf_dir, "xlsx_files").select(F.explode("header").alias("header"))
    return heads.groupBy("header").agg(F.count("*").alias("n")).withColumn("key", labels.header_key(F.col("header")))


def _header_sql(x: str) -> str:
    s = f"replace(replace(replace(lower({sql.strip(x)}), ' ', ''), '（', '('), '）', ')')"
    tests = []
    for key, inside, equal in labels.HEADER_RULES:
        tests.append("when " + " or ".join([f"contains({s}, '{w}')" for w in inside] + [f"{s} = '{w}'" for w in equal]) + f" then '{key}'")
    return f"case {' '.join(tests)} else {s} end"


def compose_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "xlsx_catalog").select("row_id", *(T.strip(F.coalesce(c, F.lit(""))).alias(n) for n, c in _COMPOSED.items()), F.lit("").alias("null"))
    return c.select("row_id", labels.record_text().alias("text"))


_COMPOSED = {"tablename": "tablename", "fieldname": "字段名", "fielddesc": "字段注释", "example": "字段样本", "datatype": "字段类型", "grade": "分级"}
_COMPOSE = "select row_id, concat_ws(' | ', " + ", ".join(f"""case when {sql.strip(f'"{c}"')} <> '' then '{p}' || {sql.strip(f'"{c}"')} end""" for c, p in (("tablename", ""), ("字段名", ""), ("字段注释", "描述:"), ("字段样本", "示例:"), ("字段类型", "类型:"), ("分级", "分级:"))) + ") as text from xlsx_catalog"


def _label_taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.split("path", "/")
    return table(spark, sf_dir, "category_ref").select(F.get(p, 0).alias("domain"), F.get(p, 1).alias("sub1"), F.get(p, 2).alias("sub2"), F.col("cat_id").alias("ord"))


def parse_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "xlsx_catalog").select("row_id", F.col("分类").alias("raw"))
    return labels.parse_classification(rows, "raw", _label_taxonomy(spark, sf_dir)).select("row_id", "domain", "sub1", "sub2")


_PARSE = """with t as (select cat_id as ord, string_split(path, '/')[1] as d, string_split(path, '/')[2] as s1, string_split(path, '/')[3] as s2 from category_ref),
dom as (select distinct d from t), one as (select s1, arg_min(d, ord) as d from t group by s1), two as (select s2, arg_max(d, ord) as d, arg_max(s1, ord) as s1 from t group by s2),
c as (select row_id, list_filter(string_split(replace(replace(coalesce("分类", ''), ' ', ''), chr(92), '/'), '/'), lambda p: p <> '') as p from xlsx_catalog),
e as (select row_id, p, len(p) as n, case len(p) when 2 then p[2] when 1 then p[1] end as b, p[1] as a from c)
select row_id, case when n = 3 then a when n in (1, 2) then coalesce(dom.d, one.d, two.d) end as domain,
  case when n = 3 then p[2] when n = 2 and dom.d is not null then b when n = 1 and dom.d is not null then null when n in (1, 2) and one.s1 is not null then b when n in (1, 2) then two.s1 end as sub1,
  case when n = 3 then p[3] when n in (1, 2) and dom.d is null and one.s1 is null and two.s2 is not null then b end as sub2
from e left join dom on e.a = dom.d left join one on e.b = one.s1 left join two on e.b = two.s2"""


def heuristic_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "xlsx_catalog")
    return c.select("row_id", labels.heuristic_labels(F.col("字段名"), F.col("字段注释"), F.col("字段样本")).alias("l")).select("row_id", "l.l1", "l.l2", "l.l3", "l.marker")


def _labels_sql() -> str:
    w, v = "lower(coalesce(\"字段注释\", '')) || lower(coalesce(\"字段名\", ''))", "lower(coalesce(\"字段样本\", ''))"
    tests = [(" or ".join(f"contains({w}, '{k}')" for k in ws), out) for ws, _, out in labels.LABEL_RULES]
    rx = {0: r"(^|[^0-9])1[3-9][0-9]{9}([^0-9]|$)", 1: labels.LABEL_RULES[1][1], 2: r"\b[0-9]{17}[0-9Xx]\b", 3: r"\border[0-9]+\b"}
    tests += [(f"regexp_matches({v}, '{p}')", labels.LABEL_RULES[i][2]) for i, p in rx.items()]
    cases = lambda pick: "case " + " ".join(f"when {t} then '{pick(o)}'" for t, o in tests) + " end"
    return f"select row_id, {cases(lambda o: labels.PERSONAL)} as l1, {cases(lambda o: o[0])} as l2, {cases(lambda o: o[1])} as l3, {cases(lambda o: o[2])} as marker from xlsx_catalog"


def domain_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = (("depot", "logistics"), ("power", "energy"), ("agro", "agriculture"), ("port", "transportation"))
    t = table(spark, sf_dir, "gbt_template")
    return t.select("tax_id", labels.domain(F.coalesce("source", F.lit("")), names).alias("domain"), labels.domain(F.coalesce("source", F.lit(""))).alias("by_default"), T.stem("source").alias("stem"), T.extension("source").alias("extension"))


_DOMAIN = """select tax_id, case when contains(source, 'depot') then 'logistics' when contains(source, 'power') then 'energy' when contains(source, 'agro') then 'agriculture' when contains(source, 'port') then 'transportation' else 'general' end as domain,
  'general' as by_default, regexp_replace(list_last(string_split(source, '/')), '\\.[^.]*$', '') as stem, lower(regexp_extract(list_last(string_split(source, '/')), '\\.([^.]+)$', 1)) as extension from gbt_template"""


def training_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "xlsx_catalog").select("dbname", "tablename", F.col("字段名").alias("fieldname"), F.col("字段注释").alias("fielddesc"), F.col("字段样本").alias("example"), F.col("字段类型").alias("datatype"), F.col("分类").alias("classification"), F.col("分级").alias("grade"))
    return labels.training_records(labels.canonical_rows(c), F.lit("xlsx_catalog"), _label_taxonomy(spark, sf_dir))


def json_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Citations cut out of free text around them, parsed, and written as JSON again."""
    from ..sources.chat import json_slice as cut

    r = table(spark, sf_dir, "rule_rows").select("rule_id", F.concat(F.lit("reply: "), F.col("citation"), F.lit(" end")).alias("reply"))
    parsed = r.select("rule_id", F.from_json(cut("reply"), "page int, text string").alias("c"))
    return parsed.select("rule_id", "c.page", "c.text", F.get_json_object(F.to_json("c"), "$.page").cast("int").alias("again"))


def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.groupBy("event_type", F.get_json_object("props", "$.k").cast("long").alias("k")).agg(F.count("*").alias("n"))


QUERIES = {
    "clean_text": clean_text, "title_levels": title_levels, "paragraphs": paragraphs, "guide_text": guide_text, "pii_documents": pii_documents,
    "down_fill": down_fill, "row_groups": row_groups, "row_maps": row_maps, "fragments_topk": fragments_topk, "fragments_dedup": fragments_dedup, "fragments_fallback": fragments_fallback,
    "path_batches": path_batches, "order_restore": order_restore, "payload_sizes": payload_sizes, "hierarchy_edges": hierarchy_edges, "prefix_filter": prefix_filter,
    "distinct_at_depth": distinct_at_depth, "tree_paths": tree_paths, "tree_merge": tree_merge, "tree_json": tree_json, "tree_roundtrip": tree_roundtrip, "grade_normalize": grade_normalize,
    "header_normalize": header_normalize, "compose_text": compose_text, "parse_classification": parse_classification, "heuristic_labels": heuristic_labels,
    "domain_detect": domain_detect, "training_records": training_records, "json_slice": json_slice, "json_props": json_props,
}
from .catalog import _grade_sql  # noqa: E402

_TRAINING = f"""select 'xlsx_catalog' as source, {sql.strip("coalesce(dbname, '')")} as dbname, {sql.strip("coalesce(tablename, '')")} as tablename, {sql.strip("coalesce(字段名, '')")} as fieldname, text, domain, sub1, sub2, {_grade_sql(sql.strip("coalesce(分级, '')"))} as grade
from xlsx_catalog join ({_COMPOSE}) using (row_id) join ({_PARSE.replace('"分类"', sql.strip('"分类"'))}) using (row_id)
where ({sql.strip("coalesce(字段名, '')")} <> '' or {sql.strip("coalesce(字段注释, '')")} <> '') and {sql.strip("coalesce(分类, '')")} <> ''"""
_TREE_MERGE = f"""with recursive {sql.TREES},
mnode as (select coalesce(domain, 'general') as grp, path, min(coalesce(t.level, depth)) as level from tnode t join gbt_template using (tax_id) group by all),
mitem as (select coalesce(domain, 'general') as grp, path, array_to_string(list_sort(list_distinct(list(val))), '|') as items from titem join gbt_template using (tax_id) where trim(val) <> '' group by all)
select grp, array_to_string(path, '/') as path, level, coalesce(items, '') as items from mnode left join mitem using (grp, path)"""
SQL = {
    "tree_paths": f"""with recursive {sql.TREES}, own as (select tax_id, up, string_agg(val, '|' order by key) as items from titem group by all)
select n.tax_id as doc, n.rec_no as path_ord, array_to_string(path, '/') as path, coalesce(items, '') as items from tnum n left join own o on n.tax_id = o.tax_id and n.key = o.up
where kind = 'node' and (n.tax_id, n.key) not in (select tax_id, up from tnode)""",
    "tree_merge": _TREE_MERGE,
    "tree_roundtrip": _TREE_MERGE,
    "training_records": _TRAINING,
    "clean_text": _CLEAN,
    "title_levels": f"with {_LINES} select doc_id, ord, regexp_extract(line, '^([0-9]+(\\.[0-9]+)*)\\s+', 1) as level from lines where regexp_matches(line, '^[0-9]+(\\.[0-9]+)*\\s+')",
    "paragraphs": _PARAGRAPHS,
    "guide_text": f"select doc_id, md5(g) as digest, length(g) as n_chars, length(g) > 4000 as too_long from (select doc_id, string_agg(text, chr(10) || chr(10) order by first_ord) as g from ({_PARAGRAPHS}) group by doc_id)",
    "pii_documents": _PII,
    "down_fill": _DOWNFILL,
    "row_groups": _ROW_GROUPS,
    "row_maps": f"""with h as (select file_id, lower({sql.strip("regexp_replace(coalesce(name, ''), '" + sql.Z + "+', ' ', 'g')")}) as name, i from (select file_id, unnest(header) as name, generate_subscripts(header, 1) as i from xlsx_files) where i > 1),
v as (select file_id, row_no, i, {sql.strip("regexp_replace(coalesce(cells[i].v, ''), '" + sql.Z + "+', ' ', 'g')")} as val from (select *, unnest(range(2, 1 + (select max(len(header)) from xlsx_files)::bigint)) as i from xlsx_rows where len(list_filter(cells, lambda c: {sql.strip("coalesce(c.v, '')")} <> '')) > 0))
select file_id, row_no as ord, name, arg_max(val, i) as val from h join v using (file_id, i) group by all""",
    "fragments_topk": _TOP + " select path_ord, frag_ord, score, rank from topk",
    "fragments_dedup": _DEDUP,
    "fragments_fallback": _FALLBACK,
    "path_batches": _BATCHES,
    "order_restore": 'select row_id, "分类" as path, seed_ord from xlsx_catalog left join (select path, max(cat_id) as seed_ord from category_ref group by path) s on "分类" = s.path',
    "payload_sizes": f"""with recursive {sql.TREES},
dom as (select tax_id, coalesce(domain, 'general') as d, body from gbt_template),
pnode as (select distinct d, path from tnode join dom using (tax_id)),
pitem as (select d, path, list_sort(list_distinct(list(val))) as its from titem join dom using (tax_id) where trim(val) <> '' group by all),
pleaf as (select d, list_filter(n.path, lambda p: p <> '') as path, its from pnode n left join pitem using (d, path) where not exists (select 1 from pnode m where m.d = n.d and m.path[1:len(m.path)-1] = n.path)),
paths as (select d, string_agg('{{"path":' || to_json(path) || case when len(its) > 0 then ',"items":' || to_json(its) else '' end || '}}', ',') as j from (select d, path, its from pleaf where len(path) > 0) group by d),
lv as (select d, string_agg(substring(l, 2, length(l) - 2), ',') as j from (select d, coalesce(body::json->'$.levels_definition', body::json->'$.taxonomy.levels_definition')::varchar as l from dom where tax_id in (select tax_id from trec) and json_valid(body)) where length(l) > 2 group by d),
frag as (select coalesce(domain, 'general') as d, string_agg(case when page is null then json_object('text', text) else json_object('text', text, 'page', page) end::varchar, ',') as j from documents where text is not null group by 1),
said as (select d, '{{"domain":' || to_json(d) || ',"seeds":{{"levels":[' || coalesce(lv.j, '') || '],"paths":[' || coalesce(paths.j, '') || ']}},"fragments":[' || frag.j || ']}}' as whole from frag left join paths using (d) left join lv using (d))
select d as domain, length(whole) as chars, length(whole) <= 120000 as single from said""",
    "hierarchy_edges": _HIERARCHY,
    "prefix_filter": f"{_UNDER} select row_id, array_to_string(p, '/') as path from c where p[1:2] = ['港口航运', '货物装卸']",
    "distinct_at_depth": f"{_UNDER} select p[2] as name, count(*) as n_paths from c where p[1] = '港口航运' and p[2] is not null group by 1",
    "grade_normalize": f"select row_id, {_grade_sql(chr(34) + '分级' + chr(34))} as grade, case {sql.norm(chr(34) + '分级' + chr(34))} when 's1' then 1 when 's2' then 2 when 's3' then 3 when 's4' then 4 else 0 end as level from xlsx_catalog",
    "header_normalize": f"select header, count(*) as n, {_header_sql('header')} as key from (select unnest(header) as header from xlsx_files) group by header",
    "compose_text": _COMPOSE,
    "parse_classification": _PARSE,
    "heuristic_labels": _labels_sql(),
    "domain_detect": _DOMAIN,
    "json_slice": "select rule_id, (citation->>'$.page')::int as page, citation->>'$.text' as text, (citation->>'$.page')::int as again from rule_rows",
    "json_props": "select event_type, (props->>'$.k')::bigint as k, count(*) as n from events group by all",
}
