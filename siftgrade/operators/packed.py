"""Split fields that hold several values written together, keeping each value's position.

A field is reduced to its delimiter skeleton: runs of ordinary characters become one x, blanks vanish,
and a repeated unit is kept once. The splitting rule is resolved once per distinct skeleton: whether the
field can hold several values at all, and if so, how it is read: as JSON, by its marks, or by marks and
quotes, with or without brackets around it. Skeletons of single values get no rule, so the join with the
rules (broadcast while they are small, else salted) drops those fields before any value is cut out.
Everything on rows is a built-in expression with a constant pattern.

Defined cases: null, blank and single-valued fields give no row. Values are stripped; empty ones take
no position; repeated ones stay. A JSON list, with whatever white space in it, is read as JSON; other
list brackets around keywords, and around lists of quoted expressions, are taken off. Marks inside
quotes belong to the value, a doubled quote stands for one, a quote that opens inside a value or is
never closed is an ordinary character. Texts of any length are handled whole and alike.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip
from ..session import written

#: Distinct skeletons, and characters of all of them, up to which their rules are broadcast.
BROADCAST_RULES, BROADCAST_CHARS = 100_000, 20_000_000
SALTS = 32
#: Stand for || and its full-width form while a field is cut; Unicode keeps them out of texts.
_DOUBLE = {"||": "\ufdd0", "｜｜": "\ufdd1"}
_QUOTES = {'"': '"', "“": "”", "'": "'", "「": "」"}
_MARKS = ",，、;；|｜/\n\r\t\ufdd0\ufdd1"
#: What separates unquoted values, and what else separates quoted ones, by kind of field.
SEPARATORS = {"keywords": (",，、;；|｜/\n\r\t\ufdd0\ufdd1", ""), "expressions": ("；\n\r\ufdd0\ufdd1", ",;，、")}
_JSON = re.compile(r'\[[\n\r\t]*"')
_QUOTED = "|".join(f"{q}(?:[^{q}]|{q}{q})*{q}" if q == c else f"{q}[^{c}]*{c}" for q, c in _QUOTES.items())
_LISTED = re.compile(rf"\[[\n\r\t]*(?:{_QUOTED})(?:[{_MARKS}]+(?:{_QUOTED}))*[{_MARKS}]*\]")


def skeleton(text: Column) -> Column:
    """The delimiters, quotes and brackets of a text in order; other runs as x, repeated units once."""
    bare = F.translate(text, " \u3000\u00a0", "")
    masked = F.regexp_replace(bare, rf"""[^{_MARKS}"“”'「」\[\]]+""", "x")
    return F.regexp_replace(masked, r"(?s)(.{2,8}?)\1+", "$1")


def rule_of(kind: str, shape: str) -> tuple[str, bool] | None:
    """(reading, brackets) of a skeleton's fields; None if they hold a single value.

    reading is `json` (by marks and quotes where it isn't valid JSON), `quotes` or `marks`; brackets
    tells whether the outer ones are taken off before marks and quotes are looked at.
    """
    plain, quoted = SEPARATORS[kind]
    opened = any(q in shape for q in _QUOTES)
    bracketed = len(shape) > 1 and shape[0] == "[" and shape[-1] == "]"
    if not any(m in shape for m in (plain + quoted if opened or bracketed else plain)):
        return None
    off = bracketed and (kind == "keywords" or _LISTED.fullmatch(shape) is not None)
    return "json" if bracketed and _JSON.match(shape) else "quotes" if opened else "marks", off


def _resolve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        found = [(k, s, *rule) for k, s in zip(b["kind"], b["shape"]) if (rule := rule_of(k, s))]
        yield pd.DataFrame(found, columns=["kind", "shape", "reading", "brackets"])


def rules_of(shapes: DataFrame) -> DataFrame:
    """shapes(kind, shape), one row each -> (kind, shape, reading, brackets) of those that hold several values."""
    return shapes.mapInPandas(_resolve, "kind string, shape string, reading string, brackets boolean")


def _unquoted(piece: Column) -> Column:
    """A piece as a value: without what leads in to a quote, without quotes, doubled ones once."""
    bare = strip(piece)
    lead = rf"[\s,;，、；|｜/{''.join(_DOUBLE.values())}]*+"
    out = bare
    for q, c in _QUOTES.items():
        inner = F.regexp_extract(bare, rf"(?s)^{lead}{q}(.*){c}$", 1)
        inner = F.replace(inner, F.lit(q + q), F.lit(q)) if q == c else inner
        whole = bare.endswith(c) & bare.rlike(rf"(?s)^{lead}{q}[^{c}]*+(?:{c}{c}[^{c}]*+)*+{c}$")
        out = F.when(whole, inner).otherwise(out)
    return out


def _pieces(kind: str, inside: Column) -> tuple[Column, Column]:
    """The pieces of a marked field: cut at its marks, and cut with regard to quotes."""
    plain, quoted = SEPARATORS[kind]
    cut = F.split(F.translate(inside, plain, plain[-1] * len(plain)), plain[-1])
    closed = "|".join(rf"{q}[^{c}]*+(?:{c}{c}[^{c}]*+)*+{c}" if q == c else f"{q}[^{c}]*+{c}" for q, c in _QUOTES.items())
    ends = plain + quoted
    pattern = rf"(?:^|[\s{ends}]*+)(?:{closed})(?=\s*(?:[{ends}]|$))|[^{plain}]+"
    return cut, F.transform(F.regexp_extract_all(inside, F.lit(pattern), F.lit(0)), _unquoted)


def _values(kinds: set[str]) -> Column:
    """The values of a ruled field, empty ones left out."""
    inside = F.when(F.col("brackets"), F.expr("substring(marked, 2, length(marked) - 2)")).otherwise(F.col("marked"))
    read = F.when(F.col("reading") == "json", F.from_json("whole", "array<string>"))
    cut = None
    for kind in sorted(kinds):
        marks, quotes = _pieces(kind, inside)
        one = F.when(F.col("reading") == "marks", marks).otherwise(quotes)
        cut = one if cut is None else F.when(F.col("kind") == kind, one).otherwise(cut)

    def value(v: Column) -> Column:
        for two, one in _DOUBLE.items():
            v = F.replace(v, F.lit(one), F.lit(two))
        return strip(v)

    return F.filter(F.transform(F.coalesce(read, cut), value), lambda v: v.isNotNull() & (v != ""))


def split_packed(rows: DataFrame, key: str, fields: dict[str, str]) -> DataFrame:
    """(key, fld, pos, val): a row for each value of each of the fields that hold two or more.

    fields gives each field's kind, keywords or expressions. Other columns of rows, whatever their
    names, play no part.
    """
    pairs = F.explode(F.array(*(F.struct(F.lit(f).alias("fld"), F.lit(k).alias("kind"), F.col(f).cast("string").alias("whole")) for f, k in fields.items())))
    long = rows.select(F.col(key).alias("_key"), pairs.alias("p")).select("_key", "p.fld", "p.kind", strip("p.whole").alias("whole")).where("whole <> ''")
    marked = F.col("whole")
    for two, one in _DOUBLE.items():
        marked = F.replace(marked, F.lit(two), F.lit(one))
    long = long.withColumn("marked", marked).withColumn("shape", skeleton(F.col("marked")))
    shapes = written(long.groupBy("kind", "shape").agg(F.count("*").alias("_n")))
    size = shapes.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("shape")), F.lit(0)).alias("chars")).first()
    rules = rules_of(shapes.select("kind", "shape"))
    if size.n <= BROADCAST_RULES and size.chars <= BROADCAST_CHARS:
        ruled = long.join(F.broadcast(rules), ["kind", "shape"])
    else:  # one shape may hold a third of the rows; by its file size Spark would broadcast the rules, of which there are SALTS times as many
        salted = rules.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).hint("merge")
        ruled = long.withColumn("salt", F.pmod(F.xxhash64("_key", "fld"), F.lit(SALTS)).cast("int")).join(salted, ["kind", "shape", "salt"])
    # the values stand in an array of one: a plain filter on their number would compute them twice
    several = F.filter(F.array(F.struct(_values(set(fields.values())).alias("values"))), lambda f: F.size(f["values"]) > 1)
    found = ruled.select("_key", "fld", F.inline(several))
    out = found.select(F.col("_key").alias(key), "fld", F.posexplode("values").alias("pos", "val"))
    return out.withColumn("pos", F.col("pos") + 1)
