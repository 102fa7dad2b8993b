"""Tables whose schema drifts between files: report every change, and read all files as one table.

Editions of a series are compared pairwise in time order. A column is what its header names; its type
is the one most of its non-empty cells have. Columns of one name correspond. For the others similarity
flooding finds the correspondences: the graph of both editions has the schema, groups of columns (what
stands before a separator in their names), columns and types; a pair of columns begins with the
similarity of its contents, names and types, columns that stayed begin with the full score, and scores
flow along the edges until they no longer change. Pairs are then taken one-to-one by their final score,
and an exact check of the contents follows; contents=0 takes alike names for enough.

Value counts, overlaps, joins, lineage and casts are Spark jobs. The fixpoints run in tasks, many pairs
of editions at once in numpy, spread by a hash of the file; a pair of editions is bounded by the widths
of its two headers.

Defined cases: null or blank header names are no columns, of equal names in a header the first counts;
cells beyond the header, null or empty ones are ignored; an empty column has no type and is never
retyped; files without rows take part with their header; ties of type go to the alphabetically first,
ties of time to the smaller file id, ties of score to the larger overlap, then to the smaller names.
Empty tables give empty results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip
from ..session import checked_broadcast, written

#: Share of the smaller column's cells that must be found again for the contents to be the same.
SAME_CONTENTS = 0.4
#: How alike names must be where contents are not asked for.
BY_NAME = 0.5
#: What contents, names and types give to the first score of a pair.
WEIGHTS = (0.6, 0.3, 0.1)
#: Passes of the flooding at most, and the change of scores at which it ends.
PASSES, STILL = 200, 1e-4
_SEPARATOR = re.compile(r"[\s._/·:：-]+|(?<=[a-z])(?=[A-Z])")


def previous_editions(files: DataFrame) -> DataFrame:
    """(file_id, series, prev_id), by exported_at; nulls of time come first, files without series are left out.

    The lag runs inside months and then over the months, so a series with very many editions is not
    one task's work.
    """
    f = files.where("series is not null and file_id is not null").select("file_id", "series", "exported_at", F.date_trunc("month", F.coalesce("exported_at", F.lit("1900-01-01").cast("timestamp"))).alias("month"))
    order = [F.col("exported_at").asc_nulls_first(), F.col("file_id")]
    inside = f.withColumn("prev", F.lag("file_id").over(Window.partitionBy("series", "month").orderBy(*order)))
    last = f.groupBy("series", "month").agg(F.max_by("file_id", F.struct("exported_at", "file_id")).alias("_last"))
    last = last.withColumn("before", F.lag("_last").over(Window.partitionBy("series").orderBy("month"))).select("series", "month", "before")
    return inside.join(last, ["series", "month"]).select("file_id", "series", F.coalesce("prev", "before").alias("prev_id"))


def columns_of(files: DataFrame) -> DataFrame:
    """(file_id, name, pos) of every column of every file."""
    named = files.select("file_id", F.posexplode("header").alias("pos", "name")).withColumn("name", strip("name")).where("name <> ''")
    return named.groupBy("file_id", "name").agg(F.min("pos").alias("pos"))


def _cells(rows: DataFrame) -> DataFrame:
    long = rows.select("file_id", F.posexplode("cells").alias("pos", "cell"))
    return long.select("file_id", "pos", F.col("cell.v").alias("v"), F.col("cell.t").alias("t")).where("v is not null and v <> ''")


def cell_types(rows: DataFrame) -> DataFrame:
    """(file_id, pos, t, n): how many non-empty cells of each type every column has."""
    return _cells(rows).where("t is not null").groupBy("file_id", "pos", "t").agg(F.count("*").alias("n"))


def column_types(rows: DataFrame) -> DataFrame:
    """(file_id, pos, type): the type most non-empty cells have."""
    by = cell_types(rows)
    return by.groupBy("file_id", "pos").agg(F.min_by("t", F.struct(-F.col("n"), "t")).alias("type"))


def _group(name: str) -> str:
    """What stands before the last separator of a name; '' in a flat header."""
    at = [m.start() for m in _SEPARATOR.finditer(name.strip())]
    return name.strip()[: at[-1]].lower() if at else ""


def _grams(name: str) -> set[str]:
    bare = "".join(c for c in name.lower() if c.isalnum())
    return {bare[i : i + 2] for i in range(len(bare) - 1)} | {bare[:1] + "^", bare[-1:] + "$"} if bare else set()


def _alike(a: set[str], b: set[str]) -> float:
    return 2 * len(a & b) / (len(a) + len(b)) if a or b else 1.0


def first_scores(old: list[tuple[str, str]], new: list[tuple[str, str]], overlap: dict[tuple[str, str], float]) -> np.ndarray:
    """The first score of every pair of columns (name, type) of two editions."""
    grams = [_grams(n) for n, _ in new]
    out = np.zeros((len(old), len(new)))
    for i, (a, t) in enumerate(old):
        g = _grams(a)
        for j, (b, u) in enumerate(new):
            out[i, j] = WEIGHTS[0] * overlap.get((a, b), 0.0) + WEIGHTS[1] * _alike(g, grams[j]) + WEIGHTS[2] * (t == u)
    return out


def flooded(cases: list[tuple[list, list, list, dict]], passes: int = PASSES) -> list[np.ndarray]:
    """The final scores of the open column pairs of each case, by similarity flooding over all cases at once.

    A case is (old columns, new columns, columns that stayed, overlap): columns are (name, type), those
    that stayed (name, old type, new type). Every case has a root, its group pairs, type pairs and column
    pairs; a node passes its score on in equal shares per kind of edge. A case rests once its own scores
    are still, so no case depends on the others beside it.
    """
    first, group, kind, at, roots = [], [], [], [], []
    groups: dict[tuple, int] = {}
    kinds: dict[tuple, int] = {}
    own_group, own_kind = [], []
    for n, (old, new, stayed, overlap) in enumerate(cases):
        scores = first_scores(old, new, overlap)
        cols = [(a, b, t, u, scores[i, j]) for i, (a, t) in enumerate(old) for j, (b, u) in enumerate(new)] + [(a, a, t, u, 1.0) for a, t, u in stayed]
        for a, b, t, u, score in cols:
            first.append(score)
            roots.append(n)
            group.append(groups.setdefault((n, _group(a), _group(b)), len(groups)))
            kind.append(kinds.setdefault((n, t, u), len(kinds)))
        at.append(len(old) * len(new))
    if not first:
        return [np.zeros((len(o), len(n))) for o, n, *_ in cases]
    root, group, kind = np.array(roots), np.array(group), np.array(kind)
    own_group, own_kind = np.array([g[0] for g in groups]), np.array([k[0] for k in kinds])
    first_col = np.array(first)
    first_group = np.array([_alike(_grams(a), _grams(b)) for _, a, b in groups])
    first_kind = np.array([1.0 if t == u else 0.1 for _, t, u in kinds])
    per_group, per_kind, per_root = np.bincount(group), np.bincount(kind), np.bincount(own_group, minlength=len(cases)).clip(1)
    col, grp, knd, top = first_col.copy(), first_group.copy(), first_kind.copy(), np.ones(len(cases))
    live = np.ones(len(cases), bool)

    def scaled(x: np.ndarray, of: np.ndarray) -> np.ndarray:
        most = np.zeros(len(cases))
        np.maximum.at(most, of, x)
        return x / np.maximum(most, 1e-12)[of]

    for _ in range(passes):
        c, g, k, r = first_col + col, first_group + grp, first_kind + knd, 1.0 + top
        new_col = scaled(c + g[group] / per_group[group] + k[kind] / per_kind[kind], root)
        new_grp = scaled(g + r[own_group] / per_root[own_group] + np.bincount(group, c, len(groups)), own_group)
        new_knd = scaled(k + np.bincount(kind, c, len(kinds)), own_kind)
        moved = np.zeros(len(cases))
        np.maximum.at(moved, root, np.abs(new_col - col))
        col = np.where(live[root], new_col, col)
        grp, knd = np.where(live[own_group], new_grp, grp), np.where(live[own_kind], new_knd, knd)
        live &= moved >= STILL
        if not live.any():
            break
    starts = np.searchsorted(root, np.arange(len(cases)))
    return [col[s : s + n].reshape(len(o), len(w)) for s, n, (o, w, *_) in zip(starts, at, cases)]


def chosen(old: list, new: list, overlap: dict, scores: np.ndarray, contents: float) -> list[tuple[str, str]]:
    """One-to-one correspondences by score among the pairs that pass the check of contents."""
    fits = [(-scores[i, j], -overlap.get((a, b), 0.0), a, b) for i, (a, _) in enumerate(old) for j, (b, _) in enumerate(new) if (overlap.get((a, b), 0.0) >= contents if contents > 0 else _alike(_grams(a), _grams(b)) >= BY_NAME)]
    left, right, out = set(), set(), []
    for _, _, a, b in sorted(fits):
        if a not in left and b not in right:
            left.add(a)
            right.add(b)
            out.append((a, b))
    return out


def correspondences(files: DataFrame, rows: DataFrame, contents: float = SAME_CONTENTS, passes: int = PASSES) -> tuple[DataFrame, DataFrame]:
    """(sides, renamed): every column of every pair of editions, and the renamed ones.

    sides(file_id, prev_id, name, old_pos, new_pos, old_type, new_type); positions are null on the side
    that lacks the name. renamed(file_id, old_col, new_col). Both are written, so later uses read them.
    """
    steps = previous_editions(files).where("prev_id is not null").select("file_id", "prev_id")
    cols = written(columns_of(files).join(column_types(rows), ["file_id", "pos"], "left"))
    now = cols.join(steps, "file_id").select("file_id", "prev_id", "name", F.lit(None).cast("int").alias("op"), F.col("pos").alias("np"), F.lit(None).cast("string").alias("ot"), F.col("type").alias("nt"))
    was = cols.withColumnRenamed("file_id", "prev_id").join(steps, "prev_id").select("file_id", "prev_id", "name", F.col("pos").alias("op"), F.lit(None).cast("int").alias("np"), F.col("type").alias("ot"), F.lit(None).cast("string").alias("nt"))
    sides = written(now.unionByName(was).groupBy("file_id", "prev_id", "name").agg(F.max("op").alias("old_pos"), F.max("np").alias("new_pos"), F.max("ot").alias("old_type"), F.max("nt").alias("new_type")))
    typed = lambda c: F.coalesce(c, F.lit(""))
    gone, come = F.col("new_pos").isNull(), F.col("old_pos").isNull()
    heads = sides.groupBy("file_id", "prev_id").agg(
        F.array_sort(F.collect_list(F.when(gone, F.struct("name", typed("old_type").alias("type"), F.col("old_pos").alias("pos"))))).alias("old"),
        F.array_sort(F.collect_list(F.when(come, F.struct("name", typed("new_type").alias("type"), F.col("new_pos").alias("pos"))))).alias("new"),
        F.array_sort(F.collect_list(F.when(~gone & ~come, F.struct("name", typed("old_type").alias("old_type"), typed("new_type").alias("new_type"))))).alias("stayed"),
    )
    heads = written(heads.where("size(old) > 0 and size(new) > 0"))  # a row per pair of editions, as wide as their headers
    ends = heads.select("file_id", F.explode(F.concat(F.transform("old", lambda c: F.struct(F.col("prev_id").alias("of"), c["pos"].alias("pos"), c["name"].alias("name"), F.lit(True).alias("was"))), F.transform("new", lambda c: F.struct(F.col("file_id").alias("of"), c["pos"].alias("pos"), c["name"].alias("name"), F.lit(False).alias("was"))))).alias("c")).select("file_id", "c.*")
    asked = checked_broadcast(ends.select(F.col("of"), "pos").distinct())
    cells = _cells(rows).withColumnRenamed("file_id", "of").join(asked, ["of", "pos"], "left_semi")
    counts = written(cells.groupBy("of", "pos", "v").agg(F.count("*").alias("n")))
    values = ends.join(counts, ["of", "pos"])
    sizes = values.groupBy("file_id", "name", "was").agg(F.sum("n").alias("cells"))
    side = lambda df, was, names: df.where("was" if was else "not was").select(*(F.col(a).alias(b) for a, b in names.items()))
    both = side(values, True, {"file_id": "file_id", "v": "v", "name": "old_col", "n": "old_n"}).join(side(values, False, {"file_id": "file_id", "v": "v", "name": "new_col", "n": "new_n"}), ["file_id", "v"])
    both = both.groupBy("file_id", "old_col", "new_col").agg(F.sum(F.least("old_n", "new_n")).alias("both"))
    both = both.join(side(sizes, True, {"file_id": "file_id", "name": "old_col", "cells": "old_cells"}), ["file_id", "old_col"]).join(side(sizes, False, {"file_id": "file_id", "name": "new_col", "cells": "new_cells"}), ["file_id", "new_col"])
    shared = both.groupBy("file_id").agg(F.collect_list(F.struct("old_col", "new_col", (F.col("both") / F.least("old_cells", "new_cells")).alias("overlap"))).alias("overlaps"))
    cases = heads.join(shared, "file_id", "left")

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            pairs = [{(o["old_col"], o["new_col"]): o["overlap"] for o in (os if os is not None else ())} for os in b["overlaps"]]
            sides_ = [([(c["name"], c["type"]) for c in o], [(c["name"], c["type"]) for c in n], [(c["name"], c["old_type"], c["new_type"]) for c in s], p) for o, n, s, p in zip(b["old"], b["new"], b["stayed"], pairs)]
            found = [(f, a, c) for f, case, scores in zip(b["file_id"], sides_, flooded(sides_, passes)) for a, c in chosen(case[0], case[1], case[3], scores, contents)]
            yield pd.DataFrame(found, columns=["file_id", "old_col", "new_col"])

    tasks = max(1, min(10_000, heads.count() // 200))
    renamed = cases.select("file_id", "old", "new", "stayed", "overlaps").repartition(tasks, "file_id").mapInPandas(task, "file_id long, old_col string, new_col string")
    return sides, written(renamed)


def schema_changes(files: DataFrame, rows: DataFrame) -> DataFrame:
    """(file_id, drift, old_col, new_col): a row for every change against the edition before."""
    sides, renamed = correspondences(files, rows)
    gone = sides.where("new_pos is null").join(renamed.select("file_id", F.col("old_col").alias("name")), ["file_id", "name"], "left_anti")
    come = sides.where("old_pos is null").join(renamed.select("file_id", F.col("new_col").alias("name")), ["file_id", "name"], "left_anti")
    typed = sides.where("old_pos is not null and new_pos is not null and old_type <> new_type")
    none = F.lit("")
    return (
        gone.select("file_id", F.lit("removed").alias("drift"), F.col("name").alias("old_col"), none.alias("new_col"))
        .unionByName(come.select("file_id", F.lit("added").alias("drift"), none.alias("old_col"), F.col("name").alias("new_col")))
        .unionByName(renamed.select("file_id", F.lit("renamed").alias("drift"), "old_col", "new_col"))
        .unionByName(typed.select("file_id", F.lit("retyped").alias("drift"), F.col("name").alias("old_col"), F.col("name").alias("new_col")))
    )


def lineage(files: DataFrame, sides: DataFrame, renamed: DataFrame) -> DataFrame:
    """(file_id, name, pos, field, root_id): the column each came from, by pointer doubling over the editions."""
    cols = columns_of(files)
    parent = sides.where("old_pos is not null and new_pos is not null").select("file_id", "name", F.col("prev_id").alias("root_id"), F.col("name").alias("field"))
    moved = renamed.join(sides.select("file_id", "prev_id").distinct(), "file_id").select("file_id", F.col("new_col").alias("name"), F.col("prev_id").alias("root_id"), F.col("old_col").alias("field"))
    now = written(cols.join(parent.unionByName(moved), ["file_id", "name"], "left").select("file_id", "name", "pos", F.coalesce("root_id", "file_id").alias("root_id"), F.coalesce("field", "name").alias("field")))
    for _ in range(40):  # each pass doubles the editions spanned
        up = now.select(F.col("file_id").alias("root_id"), F.col("name").alias("field"), F.col("root_id").alias("up_id"), F.col("field").alias("up"))
        after = written(now.join(up, ["root_id", "field"]).select("file_id", "name", "pos", F.col("up_id").alias("root_id"), F.col("up").alias("field"), (F.col("up_id") != F.col("root_id")).alias("moved")))
        now, more = after.drop("moved"), after.where("moved").limit(1).count()
        if not more:
            break
    return now


def _typed(v: Column, t: Column) -> list[Column]:
    """v as a number, a day and a truth value, each null unless it is of that type and can be read so."""
    number = F.when((t == "n") & v.rlike(r"^[+-]?\d+(\.\d+)?$"), v.try_cast("double"))
    day = F.when((t == "d") & v.rlike(r"^\d{4}[-/]\d{2}[-/]\d{2}$"), F.translate(v, "/", "-").try_cast("date"))
    truth = F.when(t == "b", F.when(F.lower(v).isin("true", "1", "y", "yes", "是"), True).when(F.lower(v).isin("false", "0", "n", "no", "否"), False))
    return [number.alias("number"), day.alias("day"), truth.alias("truth")]


def unified(files: DataFrame, rows: DataFrame) -> DataFrame:
    """(series, file_id, row_no, field, type, value, number, day, truth, failed): all editions as one typed table.

    A row per non-empty cell. field is the first name its column had in the series (a second column of a
    file that began under the same name has its own name added), type the one that most of the field's
    cells have in all editions together, s where none has any. value is the text as it came; the column
    of the type holds what it was cast to, and failed tells that it can't be.
    """
    sides, renamed = correspondences(files, rows)
    named = lineage(files, sides, renamed)
    again = F.row_number().over(Window.partitionBy("file_id", "field").orderBy("pos"))  # as many as a header has columns
    named = named.withColumn("again", again).select("file_id", "pos", F.when(F.col("again") == 1, F.col("field")).otherwise(F.concat("field", F.lit(" ("), "name", F.lit(")"))).alias("field"))
    named = named.join(files.select("file_id", "series"), "file_id")
    by = cell_types(rows).join(named, ["file_id", "pos"]).groupBy("series", "field", "t").agg(F.sum("n").alias("n"))
    kinds = by.groupBy("series", "field").agg(F.min_by("t", F.struct(-F.col("n"), "t")).alias("type"))
    cols = named.join(kinds, ["series", "field"], "left").select("file_id", "pos", "series", "field", F.coalesce("type", F.lit("s")).alias("type"))
    heads = cols.groupBy("file_id", "series").agg(F.collect_list(F.struct("pos", "field", "type")).alias("cols"))
    joined = rows.select("file_id", "row_no", "cells").join(heads, "file_id")
    each = joined.select("series", "file_id", "row_no", "cells", F.explode("cols").alias("c")).select("series", "file_id", "row_no", "c.field", "c.type", F.get("cells", F.col("c.pos"))["v"].alias("value")).where("value <> ''")
    out = each.select("*", *_typed(F.col("value"), F.col("type")))
    return out.withColumn("failed", (F.col("type") != "s") & F.col("number").isNull() & F.col("day").isNull() & F.col("truth").isNull())


def as_columns(records: DataFrame, fields: dict[str, str]) -> DataFrame:
    """unified() with a column per field: fields gives their types, s, n, d or b; a row per file and row number."""
    at = {"s": "value", "n": "number", "d": "day", "b": "truth"}
    return records.groupBy("series", "file_id", "row_no").agg(*(F.max(F.when(F.col("field") == f, F.col(at[t]))).alias(f) for f, t in fields.items()))


def cast_report(records: DataFrame) -> DataFrame:
    """(series, field, type, n_cells, n_failed): how the cells of every field could be cast."""
    return records.groupBy("series", "field", "type").agg(F.count("*").alias("n_cells"), F.count(F.when(F.col("failed"), 1)).alias("n_failed"))
