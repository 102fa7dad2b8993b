"""Files that stages hand on: guides, JSON artifacts by suffix, rule tables, overrides, configuration."""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RULE_SCHEMA = "FieldName string, Category string, Level string, PatternKeywords string, PatternRegex string, Citation string, Source string, Priority int"


def guides(spark: SparkSession, root: str, extensions: tuple[str, ...] = ("pdf", "docx", "doc")) -> DataFrame:
    """(path, name, extension, content) of the guide files in a folder and those below it; other files are not opened."""
    any_case = lambda e: "".join(f"[{c}{c.upper()}]" for c in e)
    pattern = "*.{" + ",".join(any_case(e) for e in extensions) + "}"
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(root)
    ext = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    return files.select("path", F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1).alias("name"), ext.alias("extension"), "content")


def fragments_of(files: DataFrame, parse: Callable[[bytes], list[dict]] | None = None) -> DataFrame:
    """(path, ord, page, type, level, text, rows) of guide files, by a parser of one file's bytes.

    Without a parser PDFs are read by pdfplumber where it is installed. Unreadable files are skipped.
    """
    schema = "path string, ord int, page int, type string, level string, text string, rows array<array<string>>"

    def plumber(content: bytes) -> list[dict]:
        import io

        import pdfplumber

        out = []
        with pdfplumber.open(io.BytesIO(content)) as pdf:
            for no, page in enumerate(pdf.pages, 1):
                out += [{"page": no, "type": "paragraph", "text": line} for line in (page.extract_text() or "").split("\n") if line.strip()]
                out += [{"page": no, "type": "table", "rows": [[c or "" for c in r] for r in t]} for t in page.extract_tables()]
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, content in zip(b["path"], b["content"]):
                try:
                    found = (parse or plumber)(content)
                except ImportError:
                    raise
                except Exception:  # noqa: BLE001 - a parser may raise anything on a broken file
                    continue
                yield pd.DataFrame([(path, i, f.get("page"), f.get("type"), f.get("level", ""), f.get("text"), f.get("rows")) for i, f in enumerate(found)], columns=[c.split()[0] for c in schema.split(", ")])

    return files.select("path", "content").mapInPandas(run, schema)


def read_json(spark: SparkSession, root: str, suffix: str, schema: str | T.StructType, drop_broken: bool = True, lines: bool = False) -> DataFrame:
    """All JSON artifacts under root whose names end in a suffix, one record a file or a line; broken ones are skipped."""
    reader = spark.read.option("multiLine", str(not lines).lower()).option("pathGlobFilter", f"*{suffix}").option("recursiveFileLookup", "true")
    return reader.option("mode", "DROPMALFORMED" if drop_broken else "FAILFAST").schema(schema).json(root)


def domains(spark: SparkSession, root: str, only: str | None = None) -> DataFrame:
    """Partitioned artifacts under root/domain=...; with `only` no other folder is read."""
    out = spark.read.option("basePath", root).parquet(root)
    return out.where(F.col("domain") == only) if only else out


def overridden(generated: DataFrame, reviewed: DataFrame, key: list[str], value: str) -> DataFrame:
    """generated with the reviewed value where there is one, null values not counting."""
    r = reviewed.select(*key, F.col(value).alias("_reviewed"))
    return generated.join(r, key, "left").withColumn(value, F.coalesce("_reviewed", value)).drop("_reviewed")


def dynamic_rules(spark: SparkSession, root: str, priority: int = 60) -> DataFrame:
    """Rule rows kept by hand as CSV files with a header."""
    quoted = {"header": "true", "pathGlobFilter": "*.csv", "multiLine": "true", "quote": '"', "escape": '"'}
    rows = spark.read.options(**quoted).schema(RULE_SCHEMA).csv(root)
    return rows.withColumn("Priority", F.coalesce("Priority", F.lit(priority)))


def dynamic_workbooks(spark: SparkSession, root: str, priority: int = 60) -> DataFrame:
    """The same from workbooks whose first row names the columns."""
    from .xlsx import read_workbooks, with_header

    names = [f.split()[0] for f in RULE_SCHEMA.split(", ")]
    rows = with_header(read_workbooks(spark, root), names, candidates=(1,), least=1)
    one = lambda n: F.col("fields")[n]
    return rows.select(*(one(n).alias(n) for n in names[:-1]), F.coalesce(one("Priority").try_cast("int"), F.lit(priority)).alias("Priority"))


def load_config(env: str, path: str | None, default: dict) -> dict:
    """A JSON configuration: from the file that an environment variable names, else path, else the default."""
    for where in (os.environ.get(env), path):
        if where:
            try:
                with open(where, encoding="utf-8") as f:
                    return {**default, **json.load(f)}
            except (OSError, ValueError):
                continue
    return dict(default)


#: Configurations and their defaults; the words of each domain beside the generic ones are given by a file.
CONFIGS = {
    "keywords": {"generic": [], "domain_extra": {}},
    "params": {"workers": 5, "batch_size": 20, "per_path_frag_limit": 3, "group_frag_limit": 12},
    "grouping": {"group_by_depth": 2, "path_token_depths": [0, 1, 2, 3]},
    "aliases": {},
    "domains": {},
}


def config(spark: SparkSession, name: str, path: str | None = None) -> dict:
    """A named configuration: of the file that the setting siftgrade.config.NAME or the variable SIFTGRADE_NAME names, else path, else its default."""
    setting = spark.conf.get(f"siftgrade.config.{name}", None)
    return load_config(f"SIFTGRADE_{name.upper()}", setting or path, CONFIGS[name])


def keywords_of(keywords: dict, domain: Column) -> Column:
    """The words that all paths of a domain share: the generic ones and the domain's own, each once."""
    words = lambda ws: F.array(*(F.lit(w) for w in dict.fromkeys(ws) if w)).cast("array<string>")
    own = words([])
    for d, ws in keywords.get("domain_extra", {}).items():
        own = F.when(domain == d, words(ws)).otherwise(own)
    return F.array_union(words(keywords.get("generic", [])), own)


def write_json(df: DataFrame, path: str, partition: str | None = "domain") -> None:
    w = df.write.mode("overwrite")
    (w.partitionBy(partition) if partition else w).json(path)


def write_rules(rules: DataFrame, path: str) -> None:
    """Executable rules, a JSON text a line in their order within each file."""
    rules.repartitionByRange("ord").sortWithinPartitions("ord").select("rule").write.mode("overwrite").text(path)


def write_report(tables: dict[str, DataFrame], path: str) -> None:
    """One folder per report table, as CSV with a header."""
    for name, df in tables.items():
        df.write.mode("overwrite").option("header", "true").csv(os.path.join(path, name))
