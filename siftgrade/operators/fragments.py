"""Guide text and tables as fragments: titles, paragraphs, down-filled cells, grouped rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import clean_cell, strip, title_level

UNNAMED = "未命名"
FIELD_WORDS = ("字段名", "定义", "类型", "格式", "示例")  # fixed values


def text_lines(docs: DataFrame, key: str, text: str, drop_blank: bool = True) -> DataFrame:
    """(key, ord, line) of the lines of every text."""
    out = docs.select(F.col(key), F.posexplode(F.split(F.col(text), "\n")).alias("ord", "line"))
    return out.where(strip("line") != "") if drop_blank else out


def paragraphs(lines: DataFrame, key: str) -> DataFrame:
    """(key, first_ord, text, level, type): consecutive lines joined; a title or blank line breaks, a title stands alone."""
    title = title_level("line") != ""
    marked = lines.withColumn("blank", strip("line") == "").withColumn("title", title)
    w = Window.partitionBy(key).orderBy("ord")
    breaks = (F.col("title") | F.col("blank") | F.lag(F.col("title") | F.col("blank")).over(w)).cast("int")
    island = marked.withColumn("island", F.sum(F.coalesce(breaks, F.lit(1))).over(w.rowsBetween(Window.unboundedPreceding, 0))).where(~F.col("blank"))
    parts = F.sort_array(F.collect_list(F.struct("ord", strip("line").alias("t"))))
    out = island.groupBy(key, "island").agg(F.min("ord").alias("first_ord"), F.array_join(F.transform(parts, lambda p: p["t"]), " ").alias("text"), F.max_by(title_level("line"), -F.col("ord")).alias("level"))
    return out.select(key, "first_ord", "text", "level", F.when(F.col("level") != "", "title").otherwise("paragraph").alias("type"))


def guide_text(fragments: DataFrame, key: str, limit: int = 200_000) -> DataFrame:
    """(key, guide_text, n_chars, too_long): titles and paragraphs joined by blank lines."""
    said = F.sort_array(F.collect_list(F.struct("first_ord", "text")))
    out = fragments.where(F.col("type").isin("title", "paragraph")).groupBy(key).agg(F.array_join(F.transform(said, lambda p: p["text"]), "\n\n").alias("guide_text"))
    return out.withColumn("n_chars", F.length("guide_text")).withColumn("too_long", F.col("n_chars") > limit)


def down_fill(cells: DataFrame, table: str, row: str, col: str, value: str, block: int = 1 << 16) -> DataFrame:
    """Cells cleaned, empty ones filled from above in their column, header row included.

    Values run down inside blocks of row numbers and the blocks' last values from block to block, so
    that a long column is not one task's work.
    """
    by = [table, col]
    clean = cells.withColumn(value, F.nullif(clean_cell(value), F.lit(""))).withColumn("_block", F.floor(F.col(row) / block))
    w = Window.partitionBy(*by, "_block").orderBy(row).rowsBetween(Window.unboundedPreceding, 0)
    inside = clean.withColumn("_v", F.last(value, ignorenulls=True).over(w))
    last = clean.groupBy(*by, "_block").agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.col(row))).alias("_last"))
    before = F.last("_last", ignorenulls=True).over(Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    last = last.select(*(F.col(k).alias(f"_{i}") for i, k in enumerate(by)), F.col("_block").alias("_2"), before.alias("_before"))
    same = [inside[k].eqNullSafe(last[f"_{i}"]) for i, k in enumerate([*by, "_block"])]
    out = inside.join(last, same[0] & same[1] & same[2])
    return out.withColumn(value, F.coalesce("_v", "_before", F.lit(""))).drop("_block", "_v", "_before", "_0", "_1", "_2")


def grouped_rows(rows: DataFrame, table: str, ord_col: str, cells: str) -> DataFrame:
    """(table, group, ord, fields): every data row under its first cell, as JSON from header to value.

    The first row is the header, in lower case; rows without any text are skipped; cells beyond the
    header are ignored; of equal headers the last has the value.
    """
    text = rows.select(F.col(table), F.col(ord_col).alias("_o"), F.transform(F.col(cells), clean_cell).alias("_c"))
    head = text.groupBy(table).agg(F.min_by(F.struct("_o", "_c"), "_o").alias("h"))
    data = text.join(head, table).where((F.col("_o") > F.col("h._o")) & F.exists("_c", lambda c: c != ""))
    names = F.transform(F.slice("h._c", 2, F.greatest(F.size("h._c") - 1, F.lit(0))), F.lower)
    values = F.slice("_c", 2, F.greatest(F.size("_c") - 1, F.lit(0)))
    zipped = F.filter(F.arrays_zip(names.alias("k"), values.alias("v")), lambda e: e["k"].isNotNull())
    last = F.filter(zipped, lambda e, i: ~F.exists(F.filter(zipped, lambda x, j: j > i), lambda x: x["k"] == e["k"]))
    fields = F.to_json(F.map_from_entries(F.transform(last, lambda e: F.struct(e["k"], F.coalesce(e["v"], F.lit(""))))))
    return data.select(table, F.coalesce(F.nullif(F.get("_c", 0), F.lit("")), F.lit(UNNAMED)).alias("group"), F.col("_o").alias("ord"), fields.alias("fields"))


def row_groups(rows: DataFrame, table: str, ord_col: str, cells: str) -> DataFrame:
    """(table, group, first_ord, rows): the rows of every group of grouped_rows() in one array, in order."""
    listed = F.transform(F.array_sort(F.collect_list(F.struct("ord", "fields"))), lambda e: e["fields"])
    return grouped_rows(rows, table, ord_col, cells).groupBy(table, "group").agg(F.min("ord").alias("first_ord"), listed.alias("rows"))


def is_field_table(header: Column) -> Column:
    """Whether a header array names fields."""
    return F.arrays_overlap(F.transform(header, lambda h: strip(h)), F.array(*map(F.lit, FIELD_WORDS)))
