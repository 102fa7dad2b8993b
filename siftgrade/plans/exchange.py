"""Queries through files, requests and rules: what is written is read again and compared with the tables."""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import classify, engine, evaluate, fragments, labels, predicate, retrieval, rules, taxonomy
from ..session import shared_dir, table, written
from ..sources import artifacts, chat, xlsx
from . import catalog, guides, sql


def _folder(spark: SparkSession) -> str:
    return os.path.join(shared_dir(spark), f"files-{uuid.uuid4().hex}")


# ---- workbooks

_REQUIRED = ["字段名", "字段注释", "字段样本"]


def workbook_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every edition written as a workbook and read again under its header, where it has a required column."""
    heads = table(spark, sf_dir, "xlsx_files").select(F.col("file_id").alias("book"), F.lit(1).alias("row_no"), F.col("header").alias("cells"))
    rows = table(spark, sf_dir, "xlsx_rows").select(F.col("file_id").alias("book"), (F.col("row_no") + 1).alias("row_no"), F.transform("cells", lambda c: c["v"]).alias("cells"))
    folder = _folder(spark)
    xlsx.write_workbooks(heads.unionByName(rows), folder).write.format("noop").mode("overwrite").save()
    named = xlsx.with_header(xlsx.read_workbooks(spark, folder), _REQUIRED, candidates=(1,), least=1)
    out = named.select(T.stem("path").cast("long").alias("file_id"), (F.col("row_no") - 1).alias("row_no"), F.explode("fields").alias("name", "val"))
    return out.where("val is not null")


_WORKBOOK = f"""with h as (select file_id, trim(name, ' ') as name, max(i) as i from (select file_id, unnest(header) as name, generate_subscripts(header, 1) as i from xlsx_files) where trim(coalesce(name, ''), ' ') <> '' group by all),
k as (select file_id from h group by file_id having count(*) filter (where name in ({", ".join(map(sql.q, _REQUIRED))})) > 0)
select file_id, row_no, name, v as val from (select r.file_id, row_no, h.name, cells[h.i].v as v from xlsx_rows r join k using (file_id) join h on h.file_id = r.file_id) where v is not null"""


def classified_workbooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The classified catalog as workbooks with a column per category level, read again."""
    out = classify.split_levels(catalog.classify_catalog(spark, sf_dir), "category")
    cols = ["row_id", *(c for c in out.columns if c.endswith("级分类")), "marker", "level", "rule_id", "tags", "confidence"]
    books = max(1, -(-out.count() // 100_000))
    row = out.select(F.pmod(F.col("row_id"), F.lit(books)).alias("book"), (F.floor(F.col("row_id") / books) + 2).alias("row_no"), F.array(*(F.col(c).cast("string") for c in cols)).alias("cells"))
    heads = spark.range(books).select(F.col("id").alias("book"), F.lit(1).cast("long").alias("row_no"), F.array(*map(F.lit, cols)).alias("cells"))
    folder = _folder(spark)
    xlsx.write_workbooks(heads.unionByName(row), folder).write.format("noop").mode("overwrite").save()
    read = xlsx.with_header(xlsx.read_workbooks(spark, folder), cols, candidates=(1,))
    return read.select(*(F.col("fields")[c].alias(c) for c in cols)).withColumn("row_id", F.col("row_id").cast("long"))


_CLASSIFIED = f"""{catalog._CTES} select row_id, split_part(category, '/', 1) as "1级分类", split_part(category, '/', 2) as "2级分类", split_part(category, '/', 3) as "3级分类", marker, level, rule_id, tags, confidence from decided"""


# ---- artifacts


def domain_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fragments written as JSON by domain, all files of one domain read again."""
    docs = table(spark, sf_dir, "documents").select("domain", "doc_id", "page", F.length("text").cast("long").alias("n"))
    folder = _folder(spark)
    artifacts.write_json(docs.where("domain is not null"), folder)
    back = spark.read.option("basePath", folder).schema("doc_id bigint, page int, n bigint, domain string").json(folder)
    lines = artifacts.read_json(spark, os.path.join(folder, "domain=port"), ".json", "doc_id bigint, page int, n bigint", lines=True)
    return back.where("domain <> 'port'").select("domain", "doc_id", "page", "n").unionByName(lines.select(F.lit("port").alias("domain"), "doc_id", "page", "n"))


def domain_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog rows kept by domain, one domain's folder read."""
    docs = table(spark, sf_dir, "documents").select(F.coalesce("domain", F.lit("general")).alias("domain"), "doc_id", "guide_code")
    folder = _folder(spark)
    docs.write.partitionBy("domain").parquet(folder)
    return artifacts.domains(spark, folder, "agro").select("domain", "doc_id", "guide_code")


def guide_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Guide texts kept as files, found by their extension and read by a parser of their bytes."""
    docs = table(spark, sf_dir, "documents").where("text is not null and guide_code is not null")
    folder = _folder(spark)
    docs.select("guide_code", F.to_json(F.struct("doc_id", "text")).alias("line")).write.partitionBy("guide_code").option("maxRecordsPerFile", 500).text(folder)
    found = artifacts.fragments_of(artifacts.guides(spark, folder, ("txt",)), _lines_of)
    return found.select(F.regexp_extract("path", "guide_code=([^/]+)/", 1).alias("guide_code"), F.get_json_object("text", "$.doc_id").cast("long").alias("doc_id"), F.length(F.get_json_object("text", "$.text")).cast("long").alias("n"))


def _lines_of(content: bytes) -> list[dict]:
    return [{"type": "paragraph", "text": line} for line in content.decode().split("\n") if line]


def reviewed_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Levels of extracted rules, replaced by the last one typed by hand for the same name."""
    made = table(spark, sf_dir, "rule_rows").select("rule_id", "fieldname", "level")
    typed = table(spark, sf_dir, "dynamic_rules").where("fieldname is not null").groupBy("fieldname").agg(F.max_by("level", "dyn_id").alias("level"))
    return artifacts.overridden(made, typed, ["fieldname"], "level").select("rule_id", "level")


def dynamic_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hand-kept rules written as CSV and as workbooks and read as rule rows, a missing priority filled in."""
    names = [f.split()[0] for f in artifacts.RULE_SCHEMA.split(", ")]
    rows = table(spark, sf_dir, "dynamic_rules").select(F.col("dyn_id"), *(F.nullif(F.col(n.lower()).cast("string"), F.lit("")).alias(n) for n in names))
    rows = rows.withColumn("Source", F.concat_ws("#", "dyn_id", "Source"))
    folder = _folder(spark)
    rows.where("dyn_id % 2 = 0").drop("dyn_id").write.options(header="true", quote='"', escape='"', ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false").csv(os.path.join(folder, "csv"))
    odd = rows.where("dyn_id % 2 <> 0")
    heads = odd.select(F.pmod("dyn_id", F.lit(64)).alias("book")).distinct().select("book", F.lit(1).cast("long").alias("row_no"), F.array(*map(F.lit, names)).alias("cells"))
    body = odd.select(F.pmod("dyn_id", F.lit(64)).alias("book"), (F.floor(F.col("dyn_id") / 64) + 2).alias("row_no"), F.array(*names).alias("cells"))
    xlsx.write_workbooks(heads.unionByName(body), os.path.join(folder, "books")).write.format("noop").mode("overwrite").save()
    both = artifacts.dynamic_rules(spark, os.path.join(folder, "csv")).unionByName(artifacts.dynamic_workbooks(spark, os.path.join(folder, "books")))
    return both.select(F.col("FieldName").alias("fieldname"), F.col("Category").alias("category"), F.col("Level").alias("level"), F.translate("PatternKeywords", "\r", "").alias("keywords"), F.col("Source").alias("source"), F.col("Priority").alias("priority"))


_DYNAMIC = """select nullif(fieldname, '') as fieldname, nullif(category, '') as category, nullif(level, '') as level, replace(nullif(patternkeywords, ''), chr(13), '') as keywords, concat_ws('#', dyn_id, nullif(source, '')) as source, coalesce(priority, 60)::int as priority from dynamic_rules"""


def report_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluation tables written as a report and read again."""
    judged = written(catalog._judged_local(spark, sf_dir))
    folder = _folder(spark)
    artifacts.write_report({"confusion": evaluate.confusion(judged, "truth", "pred"), "buckets": evaluate.accuracy_by_confidence(judged, "truth", "pred", "confidence").select("bucket", "correct", "total")}, folder)
    read = lambda n, s: spark.read.option("header", "true").schema(s).csv(os.path.join(folder, n))
    a = read("confusion", "truth string, pred string, n long").select(F.lit("confusion").alias("report"), F.concat_ws("|", "truth", "pred").alias("what"), "n")
    return a.unionByName(read("buckets", "bucket string, correct long, total long").select(F.lit("buckets").alias("report"), F.col("bucket").alias("what"), F.col("total").alias("n")))


# ---- requests


def _counted(turns: list) -> str:
    """A client for checks: it counts what a request carries."""
    asked = json.loads(turns[-1]["content"])
    seeds = asked.get("seeds") or {}
    reply = {"domain": asked["domain"], "n_paths": len(seeds.get("paths") or []), "n_fragments": len(asked.get("fragments") or []), "n_chars": sum(len(f["text"]) for f in asked.get("fragments") or []) + len(asked.get("guide_text") or "")}
    return f"Here it is: {json.dumps(reply)} Done."


_REPLY = "domain string, n_paths bigint, n_fragments bigint, n_chars bigint"


def extraction_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A request per group of paths with its fragments, asked of a client that counts them."""
    paths, frags, top = guides._lookup(spark, sf_dir)
    groups = retrieval.batches(paths, 2, 20).select("path_ord", F.concat_ws("#", "bucket", F.col("batch").cast("string")).alias("grp"))
    chosen = retrieval.group_fragments(top, groups, frags, 12)
    asked = retrieval.requests(paths.select("path_ord", "path"), groups, chosen, frags, "general")
    replies = chat.chat(asked.select("grp", chat.messages("Extract the fields.", F.col("payload"), [("{}", "{}")]).alias("messages")), "grp", _counted)
    return chat.parsed(replies, _REPLY).select("grp", "parsed.n_paths", "parsed.n_fragments", "parsed.n_chars", "error")


def taxonomy_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A request per guide text for its taxonomy."""
    docs = table(spark, sf_dir, "documents").where("text is not null")
    payload = F.to_json(F.struct(F.coalesce("domain", F.lit("general")).alias("domain"), F.col("source"), F.col("text").alias("guide_text")))
    replies = chat.chat(docs.select("doc_id", chat.messages("Derive the taxonomy.", payload).alias("messages")), "doc_id", _counted, workers=16)
    return chat.parsed(replies, _REPLY).select("doc_id", "parsed.domain", "parsed.n_chars", "error")


# ---- labels, headers, levels


def label_taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference as nested JSON of labels, read back to rows."""
    return labels.read_taxonomy(labels.taxonomy_json(guides._label_taxonomy(spark, sf_dir)), "body")


def bound_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "xlsx_files").select("file_id", classify.bound(F.col("header")).alias("b")).select("file_id", "b.*")


def _bound_sql() -> str:
    strip = sql.strip("coalesce(x, '')")
    names = f"list_reverse(list_transform(header, lambda x: {strip}))"
    one = lambda ns: "coalesce(" + ", ".join(f"len(header) - nullif(coalesce(list_position({names}, '{n}'), 0), 0)" for n in ns) + ", -1)::int"
    return "select file_id, " + ", ".join(f"{one(ns)} as {role}" for role, ns in classify.HEADERS.items()) + " from xlsx_files"


_GUESSED = {"truth": ("人工", "标注", "级别"), "text": ("注释", "描述", "name"), "label": ("class", "分类", "分级")}


def guessed_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "xlsx_files").select("file_id", evaluate.roles_in(F.col("header"), _GUESSED).alias("r")).select("file_id", "r.*")


def _guessed_sql() -> str:
    one = lambda ws: "(coalesce(" + ", ".join(f"nullif(coalesce(list_position(list_transform(header, lambda x: contains(lower(coalesce(x, '')), '{w}')), true), 0), 0)" for w in ws) + ", 0) - 1)::int"
    return "select file_id, " + ", ".join(f"{one(ws)} as {r}" for r, ws in _GUESSED.items()) + " from xlsx_files"


def field_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which sheets name fields in their header."""
    return table(spark, sf_dir, "xlsx_files").select("file_id", fragments.is_field_table(F.col("header")).alias("is_field_table"))


def taxonomy_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "gbt_template").where("try_parse_json(body) is not null")
    return taxonomy.levels(docs, "tax_id", "body")


def taxonomy_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxonomy.modes(table(spark, sf_dir, "gbt_template"), "domain")


def level_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths given as an array for some categories and as level columns for the others."""
    parts = F.split("path", "/")
    c = table(spark, sf_dir, "category_ref").select("cat_id", F.when(F.col("cat_id") % 2 == 0, parts).alias("p"), *(F.concat(F.lit(" "), F.get(parts, i)).alias(f"level{i + 1}") for i in range(4)))
    segments = taxonomy.segments(F.col("p"), [F.col(f"level{i + 1}") for i in range(4)])
    return c.select("cat_id", F.array_join(segments, "/").alias("segments"), F.array_join(taxonomy.tokens_at(segments, (0, 2, 3)), "/").alias("tokens"))


def reviewed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of the reference after edits by hand: names added, one renamed or one taken away."""
    seeds = table(spark, sf_dir, "category_ref").select("cat_id", "path", F.array_append(F.coalesce("also_called", F.array().cast("array<string>")), F.lit(" ")).alias("items"))
    first = F.get("items", 0)
    edits = seeds.where("size(items) > 1").select("path", F.when(F.col("cat_id") % 3 == 0, "delete").otherwise("update").alias("op"), first.alias("item"), F.concat(first, F.lit("!")).alias("to"))
    typed = table(spark, sf_dir, "dynamic_rules").where("fieldname is not null").select(F.col("category").alias("path"), F.lit("add").alias("op"), F.col("fieldname").alias("item"), F.lit(None).cast("string").alias("to")).distinct()
    return taxonomy.reviewed(seeds.select("path", "items"), edits.unionByName(typed)).select("path", F.array_join(F.array_sort("items"), "|").alias("items"))


_REVIEWED = """with s as (select cat_id, path, coalesce(also_called, []) as a from category_ref),
k as (select path, unnest(case when len(a) = 0 then a when cat_id % 3 = 0 then list_filter(a, lambda x: x <> a[1]) else list_transform(a, lambda x: case when x = a[1] then x || '!' else x end) end) as item from s),
u as (select path, item from k union select category, fieldname from dynamic_rules where fieldname is not null and category in (select path from s))
select path, coalesce(items, '') as items from s left join (select path, string_agg(item, '|' order by item) as items from u where trim(item) <> '' group by path) using (path)"""


def catalog_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five rows of the catalog."""
    return evaluate.preview(table(spark, sf_dir, "xlsx_catalog").select("row_id", "dbname", "tablename"), ["row_id"])


def deepest_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "xlsx_catalog").agg(F.max(F.size(T.parts("分类", "/"))).cast("long").alias("depth"))


def text_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = evaluate.text_accuracy(catalog._judged_local(spark, sf_dir), "truth", "pred")
    return out.withColumn("accuracy", F.round("accuracy", 9))


#: Forms of values that are looked for, apart from those of pii_documents.
_FORMS = {"id18": "[0-9]{17}[0-9Xx]", "order_no": "order[0-9]+", "title": "(?m)^[0-9]+(\\.[0-9]+)*[ \\t]+", "credit_code": "[0-9A-Z]{18}"}


def value_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold an 18-digit number, an order number, a numbered title or a credit code."""
    docs = table(spark, sf_dir, "documents").where("text is not null")
    return docs.agg(*(F.count(F.when(F.col("text").rlike(rx), 1)).alias(k) for k, rx in _FORMS.items()))


def domain_of_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by the first domain of the built-in list that their text names."""
    return table(spark, sf_dir, "documents").groupBy(labels.domain(F.coalesce("text", F.lit(""))).alias("domain")).agg(F.count("*").alias("n"))


_DOMAIN_OF = "select case " + " ".join(f"when contains(text, '{w}') then '{d}'" for w, d in labels.DOMAINS) + " else 'general' end as domain, count(*) as n from documents group by 1"
_EXTRA = {"port": ["泊位", "锚地", "berth"], "agro": ["鱼塘", "粮仓"], "power": ["风机"]}


def domain_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many of its domain's keywords each document holds; the words come from a configuration file."""
    folder = _folder(spark)
    spark.createDataFrame([(json.dumps({"generic": guides.SHARED, "domain_extra": _EXTRA}, ensure_ascii=False),)], "value string").coalesce(1).write.text(folder)
    file = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(folder).select("path").first().path
    words = artifacts.keywords_of(artifacts.config(spark, "keywords", file.removeprefix("file:")), F.col("domain"))
    docs = table(spark, sf_dir, "documents").where("text is not null")
    return docs.select("doc_id", F.size(F.filter(words, lambda w: F.col("text").contains(w))).cast("long").alias("score"))


_DOMAIN_KW = f"""select doc_id, len(list_filter(list_distinct(list_concat([{", ".join(map(sql.q, guides.SHARED))}], case {" ".join(f"when domain = {sql.q(d)} then [{', '.join(map(sql.q, ws))}]" for d, ws in _EXTRA.items())} else [] end)), lambda w: contains(text, w))) as score from documents where text is not null"""


# ---- rules


def flattened_extractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule rows of extracted documents, one made of the rule rows of every source."""
    r = table(spark, sf_dir, "rule_rows").where("source is not null and category is not null")
    kw, rx = T.parts("patternkeywords", ","), rules.regex_list(F.col("patternregex"))
    cn, en = F.filter(kw, lambda k: ~k.rlike("^[a-z]+$")), F.filter(kw, lambda k: k.rlike("^[a-z]+$"))
    patterns = F.struct(cn.alias("keywords_cn"), F.when(F.size(en) > 0, en).alias("keywords_en"), rx.alias("regex"))
    item = F.struct(F.col("fieldname").alias("name"), "level", patterns.alias("patterns"))
    place = F.struct(F.split("category", "/").alias("path"), F.from_json("citation", "page int, text string").alias("citation"), F.array(item).alias("items"))
    docs = r.select(F.col("rule_id").alias("doc_ord"), "source", F.array(place).alias("extraction"))
    out = rules.flatten_extraction(docs)
    return out.select(F.shiftright("ord", 40).alias("rule_id"), "field_name", "category", "level", "keywords", "regexes", "priority")


_FLAT = f"""select rule_id, fieldname as field_name, array_to_string(list_filter(string_split(category, '/'), lambda p: p <> ''), '/') as category, level,
  array_to_string(list_concat(list_filter(k, lambda w: not regexp_matches(w, '^[a-z]+$')), list_filter(k, lambda w: regexp_matches(w, '^[a-z]+$'))), ',') as keywords,
  array_to_string(list_sort(list_distinct(list_filter(string_split(trim(coalesce(patternregex, ''), ' '), '||'), lambda w: w <> ''))), '||') as regexes, 50 as priority
from (select *, (select list(w order by i) from (select w, min(i) as i from (select unnest(ks) as w, generate_subscripts(ks, 1) as i) group by w)) as k from
  (select *, list_filter(list_transform(string_split(coalesce(patternkeywords, ''), ','), lambda w: {sql.strip('w')}), lambda w: w <> '') as ks from rule_rows where source is not null and category is not null))"""


def resolved_expressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conditions and exceptions of rules that meet, joined by OR; a rule's condition names its source here."""
    rows = catalog._rule_rows(spark, sf_dir).withColumns({"condition": F.col("source"), "exception": F.when(F.col("ord") % 2 == 0, F.concat(F.lit("Level="), F.col("level")))})
    return rules.resolve_conflicts(rows).select("ord", "condition", "exception")


_EXPRESSIONS = f"""with base as (select rule_id as o, {sql.norm('fieldname')} || '|' || {sql.norm('category')} as k, coalesce(priority, 60) as p, {sql.norm('source')} as c, case when rule_id % 2 = 0 then coalesce({sql.norm("'Level=' || level")}, '') else '' end as e from rule_rows),
live as (select *, min(o) over (partition by k) as first_o, min(p) over (partition by k) as least from base),
last as (select *, max(case when c = '' then o end) over (partition by k) as cg, max(case when e = '' then o end) over (partition by k) as eg from live where p = least),
cs as (select k, string_agg(c, ' OR ' order by o) as condition from (select k, c, min(o) as o from last where c <> '' and (cg is null or o > cg) group by all) group by k),
es as (select k, string_agg(e, ' OR ' order by o) as exception from (select k, e, min(o) as o from last where e <> '' and (eg is null or o > eg) group by all) group by k)
select first_o as ord, coalesce(condition, '') as condition, coalesce(exception, '') as exception from (select distinct k, first_o from last) left join cs using (k) left join es using (k)"""


def rule_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variables, operators and actions that rules may use, with how often the hand-kept ones do."""
    made = written(catalog.rules_export(spark, sf_dir).select("rule"))
    used = made.select(F.explode(F.concat(F.transform(F.regexp_extract_all("rule", F.lit('"name":"([a-z_]+)"'), F.lit(1)), lambda n: F.struct(F.lit("name").alias("k"), n.alias("name"))), F.transform(F.regexp_extract_all("rule", F.lit('"operator":"([a-z_]+)"'), F.lit(1)), lambda n: F.struct(F.lit("operator").alias("k"), n.alias("name"))))).alias("u")).groupBy("u.k", "u.name").agg(F.count("*").alias("uses"))
    words = predicate.metadata(spark).withColumn("k", F.when(F.col("kind") == "operator", "operator").otherwise("name"))
    return F.broadcast(words).join(used, ["k", "name"], "left").select("kind", "name", "type", F.coalesce("uses", F.lit(0)).alias("uses"))


def decision_trail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which rules decided on a row, in order, and what they left in its audit."""
    made = rules.rules_json(*rules.rule_tables(spark.createDataFrame(catalog.CATALOG_ITEMS, catalog._ITEM))).orderBy("ord").collect()
    found = [json.loads(r.rule) for r in made]
    for r in found:
        named = {a["name"]: a["params"] for a in r["actions"]}
        if "set_classification" in named:
            r["actions"].append({"name": "append_audit", "params": {"citation": named["set_suggested_category"]["category"], "source": named["set_data_marker"]["marker"]}})
    facts = classify.facts(table(spark, sf_dir, "xlsx_catalog"), "row_id", catalog._ROLES)
    every = engine.run_rules(facts, found).select("row_id", F.array_join("matched_rule_ids", ",").alias("ids"), "audits")
    first = engine.run_rules(facts, found, stop_first=True).select("row_id", F.col("level").alias("first_level"), F.col("confidence").alias("first_confidence"), F.col("category").alias("first_category"))
    return every.join(first, "row_id")


_TRAIL = f"""{catalog._CTES}, trail as (select row_id, string_agg('U-' || substring(field, 1, 8) || '-' || level || '-' || band, ',' order by ord) as ids,
  string_agg('{{"citation": "' || category || '", "source": "' || field || '"}}', ';' order by ord) as audits, arg_min(case when rank > 0 then level else '' end, ord) as l, arg_min(category, ord) as c, any_value(band) as b from hits group by row_id)
select row_id, coalesce(ids, '') as ids, coalesce(audits, '') as audits, coalesce(l, '') as first_level, case when coalesce(l, '') = '' then 'low' when b = 'H' then 'high' else 'medium' end as first_confidence, case when coalesce(l, '') = '' then '' else c end as first_category
from per left join trail using (row_id)"""

_GENERIC = ", ".join(map(sql.q, sql.GENERIC_EN))
_RULES_EXPORT = f"""with r as (select dyn_id as o, {sql.norm('fieldname')} as f, {sql.norm('category')} as c, {sql.norm('level')} as l, {sql.words('patternkeywords')} as kw, {catalog._RX.format(x="trim(coalesce(patternregex, ''), ' ')")} as rx from dynamic_rules),
b as (select *, 'T-' || substring(f, 1, 8) || '-' || l as tag, list_filter(kw, lambda w: regexp_matches(w, '^[a-z]+$')) as en, list_filter(kw, lambda w: not regexp_matches(w, '^[a-z]+$')) as cn from r where f <> '' and c <> '' and l <> ''),
x as (select o, tag, 1 as blk, ['table_tokens', 'field_tokens'] as vs, unnest(en) as w, generate_subscripts(en, 1) - 1 as i from b union all select o, tag, 2, ['table_name', 'field_name'], unnest(en), generate_subscripts(en, 1) - 1 from b
  union all select o, tag, 3, ['field_comment'], unnest(cn), generate_subscripts(cn, 1) - 1 from b union all select o, tag, 4, ['value_text'], unnest(kw), generate_subscripts(kw, 1) - 1 from b union all select o, tag, 5, ['value_text'], unnest(rx), generate_subscripts(rx, 1) - 1 from b),
s as (select *, case blk when 3 then 'KW_CN' when 4 then 'VAL_KW' when 5 then 'VAL_RX' else case when w in ({_GENERIC}) then 'GEN_EN' else 'KW_EN' end end as kind from x),
scoring as (select o || '.' || blk || '.' || i as ord, '{{"conditions":{{"any":[' || array_to_string(list_transform(vs, lambda v: '{{"name":"' || v || '","operator":"' || case blk when 5 then 'matches_regex' else 'contains' end || '","value":' || to_json(w) || '}}'), ',') || ']}},"actions":[{{"name":"add_score","params":{{"value":'
  || case kind when 'KW_CN' then '1.5' when 'VAL_KW' then '1.0' when 'VAL_RX' then '2.0' when 'GEN_EN' then '0.2' else '0.5' end || '}}}},{{"name":"add_hit","params":{{"tag":' || to_json(tag) || '}}}},{{"name":"add_hit","params":{{"tag":"' || kind || '"}}}}]}}' as rule from s),
bands(no, suffix, tests, tags) as (values (6, 'H', '{{"name":"score","operator":"greater_than_or_equal_to","value":2.0}}', ['VAL_RX', 'KW_CN']), (7, 'M', '{{"name":"score","operator":"greater_than_or_equal_to","value":1.0}},{{"name":"score","operator":"less_than","value":2.0}}', ['KW_CN', 'KW_EN', 'VAL_KW', 'VAL_RX'])),
decision as (select o || '.' || no || '.0' as ord, '{{"conditions":{{"all":[' || tests || ',{{"any":[{{"name":"hit_tags","operator":"contains","value":' || to_json(tag) || '}}]}},{{"any":[' || array_to_string(list_transform(tags, lambda t: '{{"name":"hit_tags","operator":"contains","value":"' || t || '"}}'), ',') || ']}}]}},"actions":[{{"name":"set_suggested_category","params":{{"category":' || to_json(c)
  || '}}}},{{"name":"set_classification","params":{{"level":' || to_json(l) || ',"rule_id":' || to_json('U-' || substring(f, 1, 8) || '-' || l || '-' || suffix) || '}}}},{{"name":"set_data_marker","params":{{"marker":' || to_json(f) || '}}}}]}}' as rule from b, bands)
select ord, rule from scoring union all select ord, rule from decision"""

QUERIES = {
    "workbook_fields": workbook_fields, "classified_workbooks": classified_workbooks, "domain_artifacts": domain_artifacts, "domain_partitions": domain_partitions,
    "guide_files": guide_files, "reviewed_levels": reviewed_levels, "dynamic_files": dynamic_files, "report_tables": report_tables,
    "extraction_requests": extraction_requests, "taxonomy_requests": taxonomy_requests, "label_taxonomy": label_taxonomy, "bound_headers": bound_headers,
    "guessed_roles": guessed_roles, "field_tables": field_tables, "taxonomy_levels": taxonomy_levels, "taxonomy_modes": taxonomy_modes, "level_paths": level_paths,
    "reviewed_items": reviewed_items, "catalog_preview": catalog_preview, "deepest_path": deepest_path, "text_accuracy": text_accuracy, "value_forms": value_forms,
    "domain_of_texts": domain_of_texts, "domain_keywords": domain_keywords, "flattened_extractions": flattened_extractions, "resolved_expressions": resolved_expressions,
    "rule_vocabulary": rule_vocabulary, "decision_trail": decision_trail,
}
SQL = {
    "workbook_fields": _WORKBOOK,
    "classified_workbooks": _CLASSIFIED,
    "domain_artifacts": "select domain, doc_id, page, length(text) as n from documents where domain is not null",
    "domain_partitions": "select domain, doc_id, guide_code from documents where domain = 'agro'",
    "guide_files": "select guide_code, doc_id, length(text) as n from documents where text is not null and guide_code is not null",
    "reviewed_levels": "select rule_id, coalesce(d.level, r.level) as level from rule_rows r left join (select fieldname, arg_max_null(level, dyn_id) as level from dynamic_rules where fieldname is not null group by 1) d on d.fieldname = r.fieldname",
    "dynamic_files": _DYNAMIC,
    "report_tables": f"{catalog._JUDGED} select 'confusion' as report, coalesce(truth, '<NA>') || '|' || coalesce(pred, '<NA>') as what, count(*) as n from judged group by all union all select 'buckets', b, coalesce(n, 0) from (values ('high'), ('medium'), ('low')) v(b) left join (select confidence as b, count(truth = pred) as n from judged group by 1) using (b)",
    "extraction_requests": guides._DEDUP.replace("select grp, frag_ord, place from (", "select g.grp || '#0' as grp, n_paths, coalesce(n_fragments, 0) as n_fragments, coalesce(n_chars, 0)::bigint as n_chars, null::varchar as error from (select string_split(path, '/')[1] || '/' || string_split(path, '/')[2] as grp, count(*) as n_paths from category_ref group by 1) g left join (select grp, count(*) as n_fragments, sum(length(text)) as n_chars from (select grp, frag_ord, place from (") + ") join f using (frag_ord) group by grp) using (grp)",
    "taxonomy_requests": "select doc_id, coalesce(domain, 'general') as domain, length(text) as n_chars, null::varchar as error from documents where text is not null",
    "label_taxonomy": "select distinct string_split(path, '/')[1] as domain, string_split(path, '/')[2] as sub1, string_split(path, '/')[3] as sub2 from category_ref",
    "bound_headers": _bound_sql(),
    "guessed_roles": _guessed_sql(),
    "field_tables": f"select file_id, list_has_any(list_transform(header, lambda h: {sql.strip('h')}), [{', '.join(map(sql.q, fragments.FIELD_WORDS))}]) as is_field_table from xlsx_files",
    "taxonomy_levels": "select tax_id, l->>'$.code' as code, l->>'$.description' as description from (select tax_id, unnest(json_extract(coalesce(body::json->'$.levels_definition', body::json->'$.taxonomy.levels_definition'), '$[*]')) as l from gbt_template where json_valid(body))",
    "taxonomy_modes": "select domain, count(*) as n, case when count(*) > 1 then 'merged' else 'single' end as mode from gbt_template group by domain",
    "level_paths": "select cat_id, case when cat_id % 2 = 0 then path else path || '/' end as segments, array_to_string(list_filter([s[1], s[3], s[4]], lambda x: x <> ''), '/') as tokens from (select *, string_split(path, '/') as s from category_ref)",
    "reviewed_items": _REVIEWED,
    "catalog_preview": "select row_id, dbname, tablename from xlsx_catalog order by row_id limit 5",
    "deepest_path": f"""select max(len(list_filter(list_transform(string_split("分类", '/'), lambda p: {sql.strip('p')}), lambda p: p <> ''))) as depth from xlsx_catalog""",
    "text_accuracy": f"{catalog._JUDGED} select round(avg((coalesce(truth, 'nan') = coalesce(pred, 'nan'))::int), 9) as accuracy, sum((coalesce(truth, 'nan') = coalesce(pred, 'nan'))::int)::bigint as correct, count(*) as total from judged",
    "value_forms": "select " + ", ".join(f"count(*) filter (where regexp_matches(text, '{rx}')) as {k}" for k, rx in _FORMS.items()) + " from documents",
    "domain_of_texts": _DOMAIN_OF,
    "domain_keywords": _DOMAIN_KW,
    "flattened_extractions": _FLAT,
    "resolved_expressions": _EXPRESSIONS,
    "decision_trail": _TRAIL,
    "rules_export": _RULES_EXPORT,
    "rule_vocabulary": f"with e as ({_RULES_EXPORT}), u as (select 'name' as k, unnest(regexp_extract_all(rule, '\"name\":\"([a-z_]+)\"', 1)) as name from e union all select 'operator', unnest(regexp_extract_all(rule, '\"operator\":\"([a-z_]+)\"', 1)) from e), n as (select k, name, count(*) as uses from u group by all),\nv(kind, name, type) as (values " + ", ".join([f"('variable', '{n}', '{t}')" for n, t in predicate.VARIABLES.items()] + [f"('operator', '{n}', 'text')" for n in predicate.TEXT_OPERATORS] + [f"('operator', '{n}', 'numeric')" for n in predicate.NUMERIC_OPERATORS] + [f"('action', '{n}', '')" for n in predicate.ACTIONS]) + ") select v.kind, v.name, v.type, coalesce(uses, 0) as uses from v left join n on n.name = v.name and n.k = case when v.kind = 'operator' then 'operator' else 'name' end",
    "rows_export": """select json_object('text', json_object('字段名', coalesce("字段名", ''), '字段注释', coalesce("字段注释", ''), '字段样本', coalesce("字段样本", '')), 'labels', json_object('分类', coalesce("分类", ''), '分级', coalesce("分级", '')))::varchar as row from xlsx_catalog""",
}
