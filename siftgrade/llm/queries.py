"""Queries of the operators in this subpackage over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table
from . import canonical, leaks, ledger, lookalike, mixing, spam

LEDGER_BATCHES = 3


def _rule_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = table(spark, sf_dir, "rule_rows")
    return ledger.keyed(rules, "rule_id", ["fieldname", "category"], ledger.arrival_batches(rules, "ingested_at", LEDGER_BATCHES))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = _rule_keys(spark, sf_dir)
    return ledger.copies(keys, ledger.build(keys, batches=LEDGER_BATCHES)).withColumnRenamed("_id", "rule_id")


def p1_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record once, with its copies."""
    led = ledger.build(_rule_keys(spark, sf_dir), batches=LEDGER_BATCHES)
    kept = led.read().select(F.col("first").alias("rule_id"), "copies")
    return table(spark, sf_dir, "rule_rows").select("rule_id", "fieldname", "category").join(kept, "rule_id")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [("xlsx_catalog", "row_id", "字段注释"), ("rule_rows", "rule_id", "category")]
    texts = None
    for tbl, key, col in parts:
        one = table(spark, sf_dir, tbl).select(F.lit(tbl).alias("tbl"), F.col(key).alias("row_id"), F.col(col).alias("text"))
        texts = one if texts is None else texts.unionByName(one)
    return lookalike.ordinary(texts, "text", ["tbl", "row_id"])


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref = table(spark, sf_dir, "category_ref")
    parts = [("xlsx_catalog", "row_id", "分类"), ("dynamic_rules", "dyn_id", "category")]
    typed = None
    for tbl, key, col in parts:
        one = table(spark, sf_dir, tbl).select(F.struct(F.lit(tbl).alias("tbl"), F.col(key).alias("row_id")).alias("at"), F.col(col).alias("typed"))
        typed = one if typed is None else typed.unionByName(one)
    return canonical.mapped(typed, "at", "typed", ref).select("at.tbl", "at.row_id", "cat_id")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.leaked(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "eval_items"), "item_id", "text")


def _mix(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    tokens = mixing.token_counts(table(spark, sf_dir, "documents"), "doc_id", "text", "source")
    return mixing.mix(tokens, table(spark, sf_dir, "mix_targets"))


def p8_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mix(spark, sf_dir)[0].withColumnRenamed("_key", "doc_id")


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mix(spark, sf_dir)[1]


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spam.spam(table(spark, sf_dir, "documents"), "doc_id", "text").select("doc_id")


QUERIES = {
    "p1_found": p1_found,
    "p1_records": p1_records,
    "p4_found": p4_found,
    "p5_found": p5_found,
    "p7_found": p7_found,
    "p8_mixture": p8_mixture,
    "p8_shares": p8_shares,
    "p9_found": p9_found,
}
_BARE = "regexp_replace(lower({}), '[^\\p{{L}}\\p{{N}}]+', '', 'g')"
_KEYS = f"""k as (select rule_id, fieldname, category, list_sort([{_BARE.format('fieldname')}, {_BARE.format('category')}]) as k from rule_rows
  where regexp_matches(fieldname, '[^\\s\\p{{Z}}]') and regexp_matches(category, '[^\\s\\p{{Z}}]'))"""


def _runs(key: str, tbl: str) -> str:
    bare = f"select {key}, {_BARE.format('text')} as t from {tbl} where text is not null"
    return f"select distinct {key}, substring(t, i, 50) as w from (select {key}, t, unnest(generate_series(1, length(t) - 49)) as i from ({bare}))"


def _confusables() -> tuple[list[tuple[str, str]], list[tuple[str, str]]]:
    """(code forms, look-alike letters) for the check, from the decompositions and names of Unicode, not from the operator's classes.

    Radicals stand for what their own NFKC form says; those of several ideographs don't occur in the tables.
    """
    import unicodedata as u

    ones, letters = [], []
    for i in range(0x80, 0x110000):
        c, apart = chr(i), u.decomposition(chr(i)).split()
        if u.category(c) == "Cf" and not u.name(c, "").startswith(("ARABIC", "SYRIAC", "KAITHI")) or 0xFE00 <= i <= 0xFE0F:
            ones.append((c, ""))
        elif u.category(c) == "Zs":
            ones.append((c, " "))
        elif apart and (apart[0] == "<wide>" and u.name(c).startswith(("FULLWIDTH LATIN", "FULLWIDTH DIGIT")) or u.name(c, "").startswith(("CJK COMPAT", "KANGXI", "CJK RADICAL", "MATHEMATICAL"))):
            one = u.normalize("NFKC", c)
            ones += [(c, one)] if len(one) == 1 else []
    alike = dict(zip("АВСЕНІЈКМОРЅТУҮХԚԜасԁеһіјкӏорԛѕуүхԝΑΒΕΖΗΙΚΜΝΟΡΤΥΧαικνορυχ", "ABCEHIJKMOPSTYYXQWacdehijklopqsyyxwABEZHIKMNOPTYXaikvopux"))
    for i in range(0x370, 0x2000):
        apart = u.normalize("NFD", chr(i))
        to = u.normalize("NFC", alike.get(apart[0], "") + apart[1:])
        if apart[0] in alike and len(to) == 1:
            letters.append((chr(i), to))
    return ones, letters


def _plain_sql(x: str) -> str:
    """Code by code translation, then words, then composed accents; only for texts without other forms to compose."""
    ones, mixed = _confusables()
    kept, gone = [(a, b) for a, b in ones if b], "".join(a for a, b in ones if not b)
    swap = lambda x, ps: f"translate({x}, '{''.join(a for a, _ in ps)}', '{''.join(b for _, b in ps)}')"
    base = swap(f"translate({x}, '{gone}', '')", kept)
    letters = r"A-Za-z\x{C0}-\x{24F}\x{370}-\x{3FF}\x{400}-\x{52F}\x{1E00}-\x{1FFF}\x{300}-\x{36F}"
    latin, greek, cyrillic = r"[A-Za-z\x{C0}-\x{24F}\x{1E00}-\x{1EFF}]", r"[\x{370}-\x{3FF}]", r"[\x{400}-\x{52F}]"
    other = f"(regexp_matches(w, '{latin}') or (regexp_matches(w, '{greek}') and regexp_matches(w, '{cyrillic}')))"
    words = f"regexp_extract_all({base}, '[{letters}]+|[^{letters}]+')"
    return f"nfc_normalize(array_to_string(list_transform({words}, lambda w: case when {other} then {swap('w', mixed)} else w end), ''))"


SQL = {
    "p4_found": f"""select tbl, row_id, plain from (select tbl, row_id, t, {_plain_sql('t')} as plain from
  (select 'xlsx_catalog' as tbl, row_id, "字段注释" as t from xlsx_catalog union all select 'rule_rows', rule_id, category from rule_rows) where t <> '') where plain <> t""",
    "p1_found": f"with {_KEYS} select keep_id, rule_id from (select rule_id, min(rule_id) over (partition by k) as keep_id from k) where rule_id <> keep_id",
    "p1_records": f"with {_KEYS} select first_id as rule_id, fieldname, category, copies from (select *, min(rule_id) over (partition by k) as first_id, count(*) over (partition by k) as copies from k) where rule_id = first_id",
    "p7_found": f"select distinct doc_id, item_id from ({_runs('doc_id', 'documents')}) join ({_runs('item_id', 'eval_items')}) using (w)",
}
