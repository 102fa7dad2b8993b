"""Queries of the general preparation operators over the given tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import editions, nested, packed
from ..session import table, written
from .sql import TREES, strip

_FIELDS = {"patternkeywords": "keywords", "patternregex": "expressions"}


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed.split_packed(table(spark, sf_dir, "rule_rows"), "rule_id", _FIELDS).select("rule_id", "fld", "pos", "val")


def p2_dynamic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed.split_packed(table(spark, sf_dir, "dynamic_rules"), "dyn_id", _FIELDS)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return editions.schema_changes(table(spark, sf_dir, "xlsx_files"), table(spark, sf_dir, "xlsx_rows"))


def p3_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All editions as one typed table, a row per cell."""
    return editions.unified(table(spark, sf_dir, "xlsx_files"), table(spark, sf_dir, "xlsx_rows"))


def p3_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells and failed casts of every field of every series."""
    return editions.cast_report(p3_records(spark, sf_dir))


def _records(spark: SparkSession, sf_dir: str, paths: bool = True) -> DataFrame:
    return nested.flatten(table(spark, sf_dir, "gbt_template"), "tax_id", "body", paths)


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.supertype(_records(spark, sf_dir, paths=False), "tax_id")


def p6_item_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items under the full path of the node that owns them: the variants' tables joined over the common keys."""
    tables = nested.subtype_tables(written(_records(spark, sf_dir), "variant"), "tax_id")
    nodes = reduce(DataFrame.unionByName, [t.select("tax_id", F.col("rec_no").alias("parent_no"), F.array_join("path", "/").alias("path")) for v, t in tables.items() if v.startswith("node")])
    items = reduce(DataFrame.unionByName, [t.select("tax_id", "rec_no", "parent_no", "val") for v, t in tables.items() if v.startswith("item")])
    return items.join(nodes, ["tax_id", "parent_no"])


def p6_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many records of each variant the templates of every source have."""
    of = table(spark, sf_dir, "gbt_template").select("tax_id", "domain")
    flat = _records(spark, sf_dir, paths=False).groupBy("tax_id", "variant").agg(F.count("*").alias("n"))
    return flat.join(of, "tax_id").groupBy("domain", "variant").agg(F.sum("n").alias("n"))


def p6_unread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Templates that gave no record, with the reason."""
    docs = table(spark, sf_dir, "gbt_template")
    return nested.unread(docs, _records(spark, sf_dir, paths=False), "tax_id", "body")


QUERIES = {"p2_found": p2_found, "p2_dynamic": p2_dynamic, "p3_found": p3_found, "p3_records": p3_records, "p3_casts": p3_casts, "p6_found": p6_found, "p6_item_paths": p6_item_paths, "p6_variants": p6_variants, "p6_unread": p6_unread}
_NAMED = f"""h as (select file_id, trim_name as name, min(i) as pos from (select file_id, {strip('unnest(header)')} as trim_name, generate_subscripts(header, 1) as i from xlsx_files) where trim_name <> '' group by 1, 2),
s as (select file_id, lag(file_id) over (partition by series order by exported_at nulls first, file_id) as prev_id from xlsx_files where series is not null),
c as (select file_id, i as pos, c.v as v, c.t as t from (select file_id, unnest(cells) as c, generate_subscripts(cells, 1) as i from xlsx_rows) where c.v is not null and c.v <> ''),
ty as (select file_id, pos, arg_min(t, (-n, t)) as type from (select file_id, pos, t, count(*) as n from c where t is not null group by all) group by all),
col as (select h.*, type from h left join ty using (file_id, pos)),
side as (select s.file_id, s.prev_id, n.name as nn, o.name as oname, n.pos as np, o.pos as op, n.type as nt, o.type as ot from s
  join (select file_id, name from h union select s.file_id, h.name from s join h on h.file_id = s.prev_id) k on k.file_id = s.file_id
  left join col n on n.file_id = s.file_id and n.name = k.name left join col o on o.file_id = s.prev_id and o.name = k.name where s.prev_id is not null),
gone as (select file_id, prev_id, oname, op from side where np is null), come as (select file_id, nn, np from side where op is null),
vo as (select g.file_id, oname, v, count(*) as n from gone g join c on c.file_id = g.prev_id and c.pos = g.op group by all),
vn as (select g.file_id, nn, v, count(*) as n from come g join c on c.file_id = g.file_id and c.pos = g.np group by all),
ren as (select file_id, oname, nn from (select vo.file_id, oname, nn, sum(least(vo.n, vn.n)) as b from vo join vn using (file_id, v) group by all)
  join (select file_id, oname, sum(n) as so from vo group by all) using (file_id, oname) join (select file_id, nn, sum(n) as sn from vn group by all) using (file_id, nn) where b / least(so, sn) >= 0.4)"""
_RECORDS = f"""with recursive {_NAMED},
step as (select file_id, nn as name, prev_id, nn as was from side where np is not null and op is not null union all select r.file_id, r.nn, s.prev_id, r.oname from ren r join s using (file_id)),
up as (select file_id, name, pos, file_id as at_id, name as at_name from h union all select u.file_id, u.name, u.pos, t.prev_id, t.was from up u join step t on t.file_id = u.at_id and t.name = u.at_name),
root as (select u.* from up u left join step t on t.file_id = u.at_id and t.name = u.at_name where t.file_id is null),
named as (select f.series, r.file_id, r.pos, case when row_number() over (partition by r.file_id, at_name order by pos) = 1 then at_name else at_name || ' (' || name || ')' end as field from root r join xlsx_files f using (file_id)),
kind as (select series, field, arg_min(t, (-n, t)) as type from (select series, field, t, count(*) as n from c join named using (file_id, pos) where t is not null group by all) group by all),
cell as (select file_id, row_no, unnest(cells) as c, generate_subscripts(cells, 1) as pos from xlsx_rows),
rec as (select n.series, n.file_id, row_no, n.field, coalesce(type, 's') as type, c.v as value,
  case when type = 'n' and regexp_matches(c.v, '^[+-]?[0-9]+(\\.[0-9]+)?$') then try_cast(c.v as double) end as number,
  case when type = 'd' and regexp_matches(c.v, '^[0-9]{{4}}[-/][0-9]{{2}}[-/][0-9]{{2}}$') then try_cast(replace(c.v, '/', '-') as date) end as day,
  case when type = 'b' then case when lower(c.v) in ('true', '1', 'y', 'yes', '是') then true when lower(c.v) in ('false', '0', 'n', 'no', '否') then false end end as truth
  from cell join named n using (file_id, pos) left join kind k on k.series is not distinct from n.series and k.field = n.field where c.v <> ''),
done as (select *, type <> 's' and number is null and day is null and truth is null as failed from rec)"""
_QUOTES = (('"', '"'), ("“", "”"), ("'", "'"), ("「", "」"))


def _packed_sql(kind: str, key: str, col: str, tbl: str) -> str:
    """Values of one field by searches that need no look-around: a quoted value takes its separator along."""
    plain, more = packed.SEPARATORS[kind]
    esc = lambda s: s.replace("\n", "\\n").replace("\r", "\\r").replace("\t", "\\t").replace("|", "\\|")
    inner = lambda q, c: f"(?:[^{q}]|{q}{q})*" if q == c else f"[^{c}]*"
    ends = f"[{esc(plain + more)}]"
    lead = r"\s*" if kind == "keywords" else f"[\\s{esc(plain + more)}]*"
    pattern = "|".join(rf"{lead}{q}{inner(q, c)}{c}\s*(?:{ends}|$)" for q, c in _QUOTES) + f"|[^{esc(plain)}]+"
    lit = lambda s: "'" + s.replace("'", "''") + "'"
    value = "t"
    for q, c in _QUOTES:
        whole = lit(rf"^{lead}{q}({inner(q, c)}){c}\s*{ends}?$")
        got = f"regexp_extract(t, {whole}, 1)"
        got = f"replace({got}, {lit(q + q)}, {lit(q)})" if q == c else got
        value = f"case when regexp_matches(t, {whole}) then {got} else {value} end"
    back = strip(f"replace(replace({value}, '\ufdd0', '||'), '\ufdd1', '｜｜')")
    text = strip(f'"{col}"')
    marked = f"replace(replace({text}, '||', '\ufdd0'), '｜｜', '\ufdd1')"
    listed = f"regexp_matches({text}, '^\\[\\s*\"') and json_valid({text})"
    bare = f"case when {text} like '[%' and {text} like '%]' then substring({marked}, 2, length({marked}) - 2) else {marked} end" if kind == "keywords" else marked
    values = f"case when {listed} then list_transform(({text})::json::varchar[], lambda t: {strip('t')}) else list_transform(regexp_extract_all({bare}, {lit(pattern)}), lambda t: {back}) end"
    kept = f"(select {key}, list_filter({values}, lambda t: t <> '') as vs from {tbl} where \"{col}\" is not null)"
    return f"select {key}, '{col}' as fld, pos::int as pos, val from (select {key}, unnest(vs) as val, generate_subscripts(vs, 1) as pos from {kept} where len(vs) > 1)"


SQL = {
    "p2_found": f"{_packed_sql('keywords', 'rule_id', 'patternkeywords', 'rule_rows')} union all {_packed_sql('expressions', 'rule_id', 'patternregex', 'rule_rows')}",
    "p2_dynamic": f"{_packed_sql('keywords', 'dyn_id', 'patternkeywords', 'dynamic_rules')} union all {_packed_sql('expressions', 'dyn_id', 'patternregex', 'dynamic_rules')}",
    "p6_found": f"with recursive {TREES} select tax_id, rec_no, parent_no, kind, val from trec",
    "p6_item_paths": f"with recursive {TREES} select tax_id, rec_no, parent_no, val, array_to_string(path, '/') as path from trec where kind = 'item'",
    "p6_variants": f"with recursive {TREES} select domain, variant, count(*) as n from trec join gbt_template using (tax_id) group by all",
    "p6_unread": f"with recursive {TREES} select tax_id, case when trim(coalesce(body, '')) = '' then 'missing' when json_valid(body) then 'no tree' else 'broken' end as reason from gbt_template where tax_id not in (select tax_id from trec)",
    "p3_records": f"{_RECORDS} select * from done",
    "p3_casts": f"{_RECORDS} select series, field, type, count(*) as n_cells, count(*) filter (where failed) as n_failed from done group by all",
    "p3_found": f"""with {_NAMED}
select file_id, 'renamed' as drift, oname as old_col, nn as new_col from ren union all
select file_id, 'removed', oname, '' from gone where (file_id, oname) not in (select file_id, oname from ren) union all
select file_id, 'added', '', nn from come where (file_id, nn) not in (select file_id, nn from ren) union all
select file_id, 'retyped', nn, nn from side where np is not null and op is not null and nt <> ot""",
}
