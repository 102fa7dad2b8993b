"""Pieces of the SQL that checks the queries."""

from __future__ import annotations

import re

from ..functions.text import GENERIC_EN

Z = r"[\s\p{Z}\x1c-\x1f]"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{Z}+|{Z}+$', '', 'g')"


def norm(x: str) -> str:
    return f"lower({strip(f'coalesce({x}, {chr(39)}{chr(39)})')})"


def tokens(x: str) -> str:
    return f"trim(regexp_replace(lower(coalesce({x}, '')), '[^a-z]+', ' ', 'g'))"


def words(x: str) -> str:
    """Sorted distinct keywords of a comma-joined list."""
    each = strip("w")
    return f"list_sort(list_distinct(list_filter(list_transform(string_split({norm(x)}, ','), lambda w: {each}), lambda w: w <> '')))"


def q(s: object) -> str:
    return "'" + str(s).replace("'", "''") + "'"


def scored(facts: str, key: str, items: list[tuple]) -> str:
    """CTEs facts, per (key, score, tags) and decided (key, score, tags, category, level, rule_id, marker, confidence, matched).

    facts: a select of key, field_name, table_name, field_comment and value_text.
    items: (ord, field, category, level, keywords, regexes).
    """
    rules, its = [], []
    for no, field, category, level, kws, rx in items:
        field, category, level = field.lower(), category.lower(), level.lower()
        tag = f"T-{field[:8]}-{level}"
        r = 5 - int(level[1]) if level[:1] == "s" and level[1:2] in "1234" else 0
        its.append(f"({no},{q(field)},{q(category)},{q(level)},{q(tag)},{r})")
        ws = sorted({w.strip() for w in kws.lower().split(",") if w.strip()})
        en = [w for w in ws if re.fullmatch("[a-z]+", w)]
        lines = [(b, i, v, w, False, *(("GEN_EN", 0.2) if w in GENERIC_EN else ("KW_EN", 0.5))) for b, vs in ((1, ("table_tokens", "field_tokens")), (2, ("table_name", "field_name"))) for i, w in enumerate(en) for v in vs]
        lines += [(3, i, "field_comment", w, False, "KW_CN", 1.5) for i, w in enumerate(w for w in ws if w not in en)]
        lines += [(4, i, "value_text", w, False, "VAL_KW", 1.0) for i, w in enumerate(ws)]
        lines += [(5, i, "value_text", w, True, "VAL_RX", 2.0) for i, w in enumerate(sorted({x for x in rx.split("||") if x}))]
        rules += [f"({no * 10000 + b * 1000 + i},{q(v)},{q(w)},{str(x).lower()},{q(tag)},{q(t)},{wt}::decimal(10,1))" for b, i, v, w, x, t, wt in lines]
    return f"""facts as ({facts}),
rules(ro, var, needle, is_rx, item_tag, tag, w) as (values {", ".join(rules)}),
items(ord, field, category, level, item_tag, rank) as (values {", ".join(its)}),
vals as (
  select {key}, 'table_tokens' as var, {tokens("table_name")} as txt from facts union all
  select {key}, 'field_tokens', {tokens("field_name")} from facts union all
  select {key}, 'table_name', table_name from facts union all select {key}, 'field_name', field_name from facts union all
  select {key}, 'field_comment', field_comment from facts union all select {key}, 'value_text', value_text from facts),
fired as (select distinct {key}, ro, item_tag, tag, w from vals join rules using (var)
  where case when is_rx then regexp_matches(txt, needle) else contains(txt, needle) end),
tagged as (select {key}, t, min(p) as p from (select {key}, item_tag as t, ro * 2 as p from fired union all select {key}, tag, ro * 2 + 1 from fired) group by all),
said as (select {key}, string_agg(t, ' ' order by p) as tags from tagged group by {key}),
summed as (select {key}, sum(w) as score from fired group by {key}),
per as (select {key}, coalesce(score, 0) as score, coalesce(tags, '') as tags from facts left join summed using ({key}) left join said using ({key})),
banded as (select *, case when score >= 2 then case when contains(tags, 'VAL_RX') or contains(tags, 'KW_CN') then 'H' end
  when score >= 1 then case when contains(tags, 'KW_CN') or contains(tags, 'KW_EN') or contains(tags, 'VAL_KW') or contains(tags, 'VAL_RX') then 'M' end end as band from per),
hits as (select {key}, band, i.* from banded b join items i on b.band is not null and contains(b.tags, i.item_tag)),
picked as (select {key}, arg_max(category, ord) as category, arg_max(field, ord) as marker,
  arg_max(level, rank * 1000 - ord) filter (where rank > 0) as level,
  arg_max('U-' || substring(field, 1, 8) || '-' || level || '-' || band, rank * 1000 - ord) filter (where rank > 0) as rule_id from hits group by {key}),
decided as (select {key}, score, tags, marker is not null as matched, coalesce(marker, '') as marker,
  case when level is null then 'low' when band = 'H' then 'high' else 'medium' end as confidence,
  case when level is null then '' else category end as category, coalesce(level, '') as level, coalesce(rule_id, '') as rule_id
  from banded left join picked using ({key}))"""


def _listed(x: str) -> str:
    """A JSON value as a list: null is none, JSON text is read, anything else but an array is a list of one."""
    read = f"({x}->>'$')::json"
    packed = f"json_type({x}) = 'VARCHAR' and regexp_matches({x}->>'$', '^\\s*[\\[{{]') and json_valid({x}->>'$')"
    return f"""case when {x} is null or json_type({x}) = 'NULL' then []::json[] when json_type({x}) = 'ARRAY' then json_extract({x}, '$[*]')
  when {packed} then case when json_type({read}) = 'ARRAY' then json_extract({read}, '$[*]') else [{read}] end else [{x}] end"""


_LEVELS = "list_filter(json_keys(v), lambda k: regexp_matches(k, '^level[0-9]+$'))"
#: CTEs of the templates' records: tnode (tax_id, key, up, val, level, depth, path, variant), titem (tax_id, key, up, val), trec with numbers.
TREES = f"""tbody as (select tax_id, body::json as j from gbt_template where json_valid(body)),
troot as (select tax_id, case when json_type(j) = 'OBJECT' then coalesce(j->'$.taxonomy.tree', j->'$.tree', j) else j end as r from tbody),
tkept as (select * from troot where json_type(r) in ('ARRAY', 'VARCHAR') or json_type(r) = 'OBJECT' and len(list_filter(json_keys(r), lambda k: k in ('name', 'children', 'items', 'level') or regexp_matches(k, '^level[0-9]+$'))) > 0),
tfirst as (select tax_id, unnest({_listed('r')}) as v, generate_subscripts({_listed('r')}, 1) as i from tkept),
twalk as (select tax_id, v, [i] as key, []::bigint[] as up, []::varchar[] as above, 1 as depth from tfirst where json_type(v) in ('OBJECT', 'VARCHAR') union all
  select tax_id, c, key || [1, i], key, above || [name], depth + 1 from (select w.tax_id, key, above, depth, unnest({_listed("(w.v->'$.children')")}) as c, generate_subscripts({_listed("(w.v->'$.children')")}, 1) as i,
    coalesce(case when json_type(w.v->'$.name') = 'VARCHAR' then w.v->>'$.name' end, json_extract_string(w.v, '$.' || list_filter({_LEVELS.replace('(v)', '(w.v)')}, lambda k: json_type(json_extract(w.v, '$.' || k)) = 'VARCHAR')[1]), '') as name from twalk w where json_type(w.v) = 'OBJECT') where json_type(c) in ('OBJECT', 'VARCHAR')),
tnamed as (select *, case when json_type(v) = 'OBJECT' then json_extract_string(v, '$.' || list_filter({_LEVELS}, lambda k: json_type(json_extract(v, '$.' || k)) = 'VARCHAR')[1]) end as keyed from twalk),
tnode as (select tax_id, v, key, up, depth, case when json_type(v) = 'OBJECT' and json_type(v->'$.level') in ('UBIGINT', 'BIGINT') then (v->>'$.level')::int end as level,
  case when json_type(v) = 'VARCHAR' then v->>'$' when json_type(v->'$.name') = 'VARCHAR' then v->>'$.name' else coalesce(keyed, '') end as val, above || [val] as path,
  case when json_type(v) = 'VARCHAR' then 'node_text' when json_type(v->'$.name') = 'VARCHAR' then 'node_named' when keyed is not null then 'node_keyed' else 'node_unnamed' end as variant from tnamed),
tlist as (select tax_id, key as up, path, unnest({_listed("(v->'$.items')")}) as c, generate_subscripts({_listed("(v->'$.items')")}, 1) as i from tnode where json_type(v) = 'OBJECT'),
titem as (select tax_id, up || [0, i] as key, up, path, case when json_type(c) = 'VARCHAR' then c->>'$' when json_type(c->'$.name') = 'VARCHAR' then c->>'$.name' else '' end as val,
  case when json_type(c) = 'VARCHAR' then 'item_text' else 'item_object' end as variant from tlist where json_type(c) in ('OBJECT', 'VARCHAR')),
tnum as (select *, row_number() over (partition by tax_id order by key)::int as rec_no from (select tax_id, key, up, 'node' as kind, val, variant, path, level, depth from tnode union all select tax_id, key, up, 'item', val, variant, path, null, null from titem)),
trec as (select a.*, coalesce(b.rec_no, 0) as parent_no from tnum a left join tnum b on a.tax_id = b.tax_id and a.up = b.key)"""
