"""Evaluation of predicted against true labels: accuracies, confusion, coverage, profiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import ratio, strip

BUCKETS = ("high", "medium", "low")


def _accuracy(truth: Column, pred: Column) -> list[Column]:
    both = truth.isNotNull() & pred.isNotNull()
    right = F.coalesce(F.sum(F.when(both & (truth == pred), 1)), F.lit(0))
    total = F.count(F.when(both, 1))
    return [ratio(right.cast("double"), total.cast("double")).alias("accuracy"), right.alias("correct"), total.alias("total")]


def accuracies(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """(metric, accuracy, correct, total): a row per (truth, prediction) pair; one pass over df."""
    wide = df.agg(*(F.struct(*_accuracy(F.col(t), F.col(p))).alias(m) for m, (t, p) in pairs.items()))
    return wide.select(F.explode(F.array(*(F.struct(F.lit(m).alias("metric"), F.col(f"`{m}`.accuracy"), F.col(f"`{m}`.correct"), F.col(f"`{m}`.total")) for m in pairs))).alias("r")).select("r.*")


def text_accuracy(df: DataFrame, truth: str, pred: str, missing: str = "nan") -> DataFrame:
    """(accuracy, correct, total) of two columns compared as stripped texts, nulls being a text of their own."""
    said = lambda c: strip(F.coalesce(F.col(c).cast("string"), F.lit(missing)))
    return df.agg(*_accuracy(said(truth), said(pred)))


def accuracy_by_confidence(df: DataFrame, truth: str, pred: str, confidence: str) -> DataFrame:
    """(bucket, accuracy, correct, total): the buckets in order, also those without rows."""
    spark = df.sparkSession
    want = F.broadcast(spark.createDataFrame(list(enumerate(BUCKETS)), "ord int, bucket string"))
    got = df.groupBy(F.lower(F.col(confidence)).alias("bucket")).agg(*_accuracy(F.col(truth), F.col(pred)))
    return want.join(got, "bucket", "left").select("ord", "bucket", F.coalesce("accuracy", F.lit(0.0)).alias("accuracy"), F.coalesce("correct", F.lit(0)).alias("correct"), F.coalesce("total", F.lit(0)).alias("total"))


def confusion(df: DataFrame, truth: str, pred: str, missing: str = "<NA>") -> DataFrame:
    """(truth, pred, n): the confusion matrix in long form."""
    return df.groupBy(F.coalesce(F.col(truth).cast("string"), F.lit(missing)).alias("truth"), F.coalesce(F.col(pred).cast("string"), F.lit(missing)).alias("pred")).agg(F.count("*").alias("n"))


def confusion_wide(long: DataFrame, preds: list[str]) -> DataFrame:
    """The long form pivoted to a column per prediction, zeros filled in."""
    return long.groupBy("truth").pivot("pred", preds).agg(F.sum("n")).na.fill(0)


def metrics(df: DataFrame, pairs: dict[str, tuple[str, str]], labelled: str) -> DataFrame:
    """(metric, value): accuracies, and the number of rows that are labelled."""
    acc = accuracies(df, pairs).select(F.concat(F.lit("accuracy_"), "metric").alias("metric"), F.col("accuracy").alias("value"))
    return acc.unionByName(df.agg(F.count(labelled).cast("double").alias("value")).select(F.lit("labelled_rows").alias("metric"), "value"))


def profile(df: DataFrame) -> DataFrame:
    """(name, type, n_rows, n_null): shape, names and types of a table; one pass."""
    cols = [f"`{c}`" for c in df.columns]
    wide = df.agg(F.count("*").alias("_n"), *(F.count(c).alias(f"_{i}") for i, c in enumerate(cols)))
    each = [F.struct(F.lit(n).alias("name"), F.lit(t).alias("type"), F.col("_n").alias("n_rows"), (F.col("_n") - F.col(f"_{i}")).alias("n_null")) for i, (n, t) in enumerate(df.dtypes)]
    return wide.select(F.explode(F.array(*each)).alias("r")).select("r.*")


def guess_roles(columns: list[str], roles: dict[str, tuple[str, ...]]) -> dict[str, str | None]:
    """For each role the first column whose name contains one of its words, words in order."""
    return {r: next((c for w in words for c in columns if w.lower() in c.lower()), None) for r, words in roles.items()}


def roles_in(header: Column, roles: dict[str, tuple[str, ...]]) -> Column:
    """The same of an array of names: a struct of each role's place from 0, -1 where there is none."""
    low = F.transform(header, lambda h: F.lower(F.coalesce(h, F.lit(""))))
    place = lambda w: F.array_position(F.transform(low, lambda h: h.contains(w.lower())), True).cast("int")
    first = lambda ws: F.coalesce(*(F.nullif(place(w), F.lit(0)) for w in ws), F.lit(0)) - 1
    return F.struct(*(first(ws).alias(r) for r, ws in roles.items()))


def preview(df: DataFrame, order: list[str], rows: int = 5) -> DataFrame:
    """The first rows of a table in an order."""
    return df.orderBy(*order).limit(rows)


def rows_json(df: DataFrame, texts: list[str], labels: list[str]) -> DataFrame:
    """(row): every row as JSON, its texts and labels apart."""
    part = lambda cs: F.struct(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in cs))
    return df.select(F.to_json(F.struct(part(texts).alias("text"), part(labels).alias("labels"))).alias("row"))


def data_checks(items: DataFrame) -> DataFrame:
    """(check, n): how many of items(name, level, keywords array) break each rule for extracted items."""
    flags = {
        "bad_level": ~F.coalesce("level", F.lit("")).rlike(r"^(S[0-9]+(-[0-9]+)?)?$"),
        "repeated_keyword": F.size(F.coalesce("keywords", F.array())) != F.size(F.array_distinct(F.coalesce("keywords", F.array()))),
        "empty_name": F.coalesce(F.trim("name"), F.lit("")) == "",
    }
    wide = items.agg(*(F.count(F.when(c, 1)).alias(k) for k, c in flags.items()))
    one = wide.select(F.explode(F.array(*(F.struct(F.lit(k).alias("check"), F.col(k).alias("n")) for k in flags))).alias("r")).select("r.*")
    shared = items.select("name", F.explode("keywords").alias("kw")).groupBy("kw").agg(F.countDistinct("name").alias("k")).where("k > 1")
    return reduce(DataFrame.unionByName, [one, shared.agg(F.count("*").alias("n")).select(F.lit("shared_keyword").alias("check"), "n")])
