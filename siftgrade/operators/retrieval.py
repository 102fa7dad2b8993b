"""The fragments that say most about each taxonomy path, and the batches paths are sent in.

A fragment's score for a path is the number of distinct keywords it contains: the path's own tokens and
keywords that all paths share. All tokens are looked for at once by an automaton over each fragment.
Fragments that hold the same tokens and as many shared keywords have one score for every path, so of
each such kind only the first few are kept before paths are joined; no path meets every fragment.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import spread
from ..sources.chat import extraction_payload
from .match import contained

#: Parts that the fragments of one kind are cut down in before they meet.
PARTS = 64


def top_fragments(paths: DataFrame, fragments: DataFrame, shared: list[str], limit: int = 3) -> DataFrame:
    """(path_ord, frag_ord, score, rank): each path's fragments by score, then order, at most `limit`.

    paths(path_ord, tokens), fragments(frag_ord, text). A path that nothing matches gets the first
    fragments with score 0.
    """
    words = F.array(*(F.lit(w) for w in dict.fromkeys(shared) if w)).cast("array<string>")
    base = spread(fragments).select("frag_ord", "text", F.size(F.filter(words, lambda w: F.coalesce(F.col("text"), F.lit("")).contains(w))).alias("common"))
    own = paths.select("path_ord", F.explode(F.array_distinct(F.filter(F.array_except("tokens", words), lambda t: t != ""))).alias("token"))
    hits = contained(base, ["frag_ord", "common"], "text", own.select(F.col("token").alias("needle")))
    hits = hits.groupBy("frag_ord", "common").agg(F.array_sort(F.flatten(F.collect_list("needles"))).alias("kind"))  # a row per shard of needles at most
    first = lambda df, *by: df.withColumn("_n", F.row_number().over(Window.partitionBy("kind", "common", *by).orderBy("frag_ord"))).where(F.col("_n") <= limit).drop("_n")
    few = first(first(hits.withColumn("_part", F.pmod(F.hash("frag_ord"), F.lit(PARTS))), "_part"))
    mine = own.join(few.select("frag_ord", "common", F.explode("kind").alias("token")), "token").groupBy("path_ord", "frag_ord", "common").agg(F.count("*").alias("own"))
    mine = mine.select("path_ord", "frag_ord", (F.col("own") + F.col("common")).alias("score"))
    best = F.broadcast(base.where("common > 0").orderBy(F.desc("common"), "frag_ord").limit(limit).select("frag_ord", F.col("common").cast("long").alias("score")))  # `limit` rows
    given = paths.select("path_ord").crossJoin(best)
    both = mine.unionByName(given).groupBy("path_ord", "frag_ord").agg(F.max("score").alias("score"))
    ranked = both.withColumn("rank", F.row_number().over(Window.partitionBy("path_ord").orderBy(F.desc("score"), "frag_ord"))).where(F.col("rank") <= limit)
    first = fragments.select("frag_ord").orderBy("frag_ord").limit(limit)
    first = F.broadcast(first.select("frag_ord", F.lit(0).cast("long").alias("score"), F.row_number().over(Window.orderBy("frag_ord")).alias("rank")))  # `limit` rows
    none = paths.select("path_ord").join(ranked.select("path_ord").distinct(), "path_ord", "left_anti").crossJoin(first)
    return ranked.unionByName(none)


def group_fragments(top: DataFrame, groups: DataFrame, fragments: DataFrame, limit: int = 12, extra_key: list[str] | None = None) -> DataFrame:
    """(grp, frag_ord, place): a group's fragments in path order, each page and opening once, at most `limit`.

    groups(path_ord, grp), fragments(frag_ord, page, text).
    """
    keys = ["grp", "page", "opening", *(extra_key or [])]
    f = fragments.select("frag_ord", "page", F.substring(F.coalesce("text", F.lit("")), 1, 64).alias("opening"), *(extra_key or []))
    all_ = top.join(groups, "path_ord").join(f, "frag_ord")
    once = all_.withColumn("n", F.row_number().over(Window.partitionBy(*keys).orderBy("path_ord", "rank"))).where("n = 1")
    return once.withColumn("place", F.row_number().over(Window.partitionBy("grp").orderBy("path_ord", "rank"))).where(F.col("place") <= limit).select("grp", "frag_ord", "place")


def batches(paths: DataFrame, depth: int = 2, size: int = 20, block: int = 1 << 16) -> DataFrame:
    """(path_ord, bucket, batch): paths of a prefix of max(1, depth) segments, in batches of `size`.

    Rows are numbered inside blocks of path_ord and the blocks' counts are summed, so that a bucket with
    very many paths is not one task's work.
    """
    bucket = F.array_join(F.slice("path", 1, max(1, depth)), "/")
    p = paths.select("path_ord", bucket.alias("bucket"), F.floor(F.col("path_ord") / block).alias("_block"))
    inside = F.row_number().over(Window.partitionBy("bucket", "_block").orderBy("path_ord"))
    sums = p.groupBy("bucket", "_block").agg(F.count("*").alias("_n"))
    sums = sums.select("bucket", "_block", (F.sum("_n").over(Window.partitionBy("bucket").orderBy("_block")) - F.col("_n")).alias("_before"))
    out = p.withColumn("_i", inside).join(sums, ["bucket", "_block"])
    return out.select("path_ord", "bucket", F.floor((F.col("_before") + F.col("_i") - 1) / size).alias("batch"))


def restore_order(extracted: DataFrame, seeds: DataFrame) -> DataFrame:
    """extracted with seed_ord, the place of its path among the seeds (of equal paths the last); null if it has none."""
    at = seeds.groupBy("path").agg(F.max("path_ord").alias("seed_ord"))
    return extracted.join(at, "path", "left")


def payload_chars(parts: DataFrame, group: str, column: str, threshold: int = 120_000) -> DataFrame:
    """(group, chars, single): the size of each group's payload, and whether one call can carry it."""
    return parts.groupBy(group).agg(F.sum(F.length(F.to_json(F.struct(column)))).alias("chars")).withColumn("single", F.col("chars") <= threshold)


def request_chars(fragments: DataFrame, paths: DataFrame, levels: DataFrame, group: str, threshold: int = 120_000) -> DataFrame:
    """(group, chars, single): the size of each group's whole extraction payload, and whether one call can carry it.

    fragments(group, fragment struct), paths(group, path struct) and levels(group, level JSON text). An
    array's JSON is as long as its elements with a comma between each two, so the length of what
    chat.extraction_payload writes is summed without gathering a group's texts in a row.
    """
    inner = lambda df, size, name: df.groupBy(group).agg((F.sum(size.cast("long")) + F.count("*") - 1).alias(name))
    out = inner(fragments, F.length(F.to_json("fragment")), "_f")
    for df, size, name in ((paths, F.length(F.to_json("path")), "_p"), (levels, F.length("level"), "_l")):
        out = out.join(inner(df, size, name), group, "left")
    none = F.array().cast("array<string>")
    frame = extraction_payload(F.col(group), F.struct(none.alias("levels"), none.alias("paths")), none)
    chars = F.length(frame) + F.col("_f") + F.coalesce("_p", F.lit(0)) + F.coalesce("_l", F.lit(0))
    return out.select(group, chars.cast("long").alias("chars")).withColumn("single", F.col("chars") <= threshold)


def requests(paths: DataFrame, groups: DataFrame, chosen: DataFrame, fragments: DataFrame, domain: str) -> DataFrame:
    """(grp, payload): one extraction request for every group of paths, with its seeds and fragments.

    paths(path_ord, path), groups(path_ord, grp), chosen(grp, frag_ord, place) of group_fragments(),
    fragments(frag_ord, page, text). A group has as many paths as a batch and no more fragments than
    group_fragments() leaves.
    """
    none = F.array().cast("array<string>")
    seeds = paths.join(groups, "path_ord").groupBy("grp").agg(F.array_sort(F.collect_list(F.struct("path_ord", "path"))).alias("p"))
    given = chosen.join(fragments.select("frag_ord", "page", "text"), "frag_ord").groupBy("grp").agg(F.array_sort(F.collect_list(F.struct("place", "page", "text"))).alias("f"))
    both = seeds.join(given, "grp", "left")
    seed = F.struct(none.alias("levels"), F.transform("p", lambda x: F.struct(x["path"].alias("path"))).alias("paths"))
    texts = F.coalesce(F.transform("f", lambda x: F.struct(x["page"].alias("page"), x["text"].alias("text"))), F.array().cast("array<struct<page:int,text:string>>"))
    return both.select("grp", extraction_payload(F.lit(domain), seed, texts).alias("payload"))
