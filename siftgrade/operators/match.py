"""Which of many needles a text contains, by a multi-pattern automaton, and joins that hot keys can't hold up."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import at_most, written

#: Needles in one automaton (some 100 bytes a character); more are matched shard by shard.
NEEDLES = 200_000
#: Keys with more than this share of the left rows are hot; there can be no more than 1/share.
HOT_SHARE = 1 / 2000


def contained(texts: DataFrame, key: list[str], text: str, needles: DataFrame) -> DataFrame:
    """(*key, needles array): the distinct needles(needle) that each text contains, sorted; texts without any give no row.

    With more needles than one automaton takes, a row per shard that has any.
    """
    needles = written(needles.select("needle").where("needle <> ''").distinct())
    shards = max(1, -(-needles.count() // NEEDLES))
    src = texts.select(*(F.col(k).alias(f"_{i}") for i, k in enumerate(key)), F.col(text).alias("_text")).where("_text <> ''")
    fields = ", ".join(f"_{i} {src.schema[f'_{i}'].dataType.simpleString()}" for i in range(len(key)))
    found = None
    for s in range(shards):
        own = sorted(r.needle for r in needles.where(F.pmod(F.hash("needle"), F.lit(shards)) == s).collect())  # about NEEDLES at most

        def run(batches: Iterator[pd.DataFrame], own: list[str] = own) -> Iterator[pd.DataFrame]:
            import ahocorasick

            automaton = ahocorasick.Automaton()
            for w in own:
                automaton.add_word(w, w)
            automaton.make_automaton()
            for b in batches:
                b["needles"] = [sorted({w for _, w in automaton.iter(t)}) for t in b["_text"]] if own else [[]] * len(b)
                yield b[b["needles"].str.len() > 0].drop(columns="_text")

        one = src.mapInPandas(run, f"{fields}, needles array<string>")
        found = one if found is None else found.unionByName(one)
    return found.select(*(F.col(f"_{i}").alias(k) for i, k in enumerate(key)), "needles")


def hot_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner", rows: int = NEEDLES) -> DataFrame:
    """left joined to right, which has a row per key at most; keys aren't null.

    A small right side is broadcast. Else the hot keys of left are joined by broadcast, with or without a
    match, and only the others are shuffled.
    """
    if at_most(right, rows):
        return left.join(F.broadcast(right), keys, how)
    total = left.count()
    hot = written(left.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > max(1.0, total * HOT_SHARE)).select(*keys))
    warm = left.join(F.broadcast(hot.join(right, keys, how)), keys)  # no more than 1/HOT_SHARE rows
    return warm.unionByName(left.join(F.broadcast(hot), keys, "left_anti").join(right, keys, how))
