"""Classification trees as path and edge tables; Spark has no recursive type.

nodes: (doc, ord, path array, level), items: (doc, ord, path array, item); `ord` is the order within the
document. nested.flatten() and paths_of() make them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip


def segments(path: Column | None = None, levels: list[Column] | None = None) -> Column:
    """A path's trimmed segments, from an array or from level columns."""
    whole = path if levels is None else F.array(*levels) if path is None else F.coalesce(path, F.array(*levels))
    return F.transform(whole, lambda s: F.trim(F.coalesce(s, F.lit(""))))


def tokens_at(path: Column, depths: tuple[int, ...] = (0, 1, 2, 3)) -> Column:
    """The non-blank segments at the given depths."""
    there = F.filter(F.array(*(F.lit(d) for d in depths)), lambda d: d < F.size(path))
    return F.filter(F.transform(there, lambda d: F.get(path, d)), lambda t: t != "")


def paths_of(flat: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, items) of nested.flatten()'s records."""
    nodes = flat.where("kind = 'node'").select(F.col(key).alias("doc"), F.col("rec_no").alias("ord"), "path", F.coalesce("level", "depth").alias("level"))
    owner = flat.where("kind = 'node'").select(F.col(key).alias("doc"), F.col("rec_no").alias("parent_no"), "path")
    items = flat.where("kind = 'item'").select(F.col(key).alias("doc"), F.col("rec_no").alias("ord"), "parent_no", F.col("val").alias("item")).join(owner, ["doc", "parent_no"])
    return nodes, items.select("doc", "ord", "path", "item")


def leaves(flat: DataFrame, key: str) -> DataFrame:
    """(doc, path_ord, path, items): nodes without children, in document order; items are [] where there are none."""
    nodes = flat.where("kind = 'node'").select(F.col(key).alias("doc"), "rec_no", "parent_no", "path")
    parents = nodes.select("doc", F.col("parent_no").alias("rec_no")).distinct()
    items = flat.where("kind = 'item'").groupBy(F.col(key).alias("doc"), F.col("parent_no").alias("rec_no")).agg(F.sort_array(F.collect_list(F.struct(F.col("rec_no").alias("o"), F.col("val").alias("v")))).alias("its"))
    leaf = nodes.join(parents, ["doc", "rec_no"], "left_anti").join(items, ["doc", "rec_no"], "left")
    return leaf.select("doc", F.col("rec_no").alias("path_ord"), "path", F.coalesce(F.transform("its", lambda i: i["v"]), F.array().cast("array<string>")).alias("items"))


def merged(nodes: DataFrame, items: DataFrame, group: Column | None = None) -> DataFrame:
    """(grp, path, level, ord, items): the trees of each group as one; nodes of a path become one.

    The level is the smallest, the place the first in order of document, the items are united and sorted.
    """
    g = F.lit("") if group is None else group
    at = nodes.groupBy(g.alias("grp"), "path").agg(F.min("level").alias("level"), F.min(F.struct("doc", "ord")).alias("ord"))
    of = items.where(F.coalesce(F.trim("item"), F.lit("")) != "").select(g.alias("grp"), "path", "item").distinct().groupBy("grp", "path").agg(F.array_sort(F.collect_list("item")).alias("items"))
    return at.join(of, ["grp", "path"], "left").select("grp", "path", "level", "ord", F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def nested_json(tree: DataFrame) -> DataFrame:
    """(grp, tree): each group's merged paths as nested JSON, built from the deepest level up."""
    deepest = tree.agg(F.coalesce(F.max(F.size("path")), F.lit(0))).first()[0]
    below = None
    for depth in range(deepest, 0, -1):
        here = tree.where(F.size("path") == depth)
        if below is None:
            here = here.withColumn("kids", F.lit(None).cast("string"))
        else:
            here = here.join(below, ["grp", "path"], "left")
        has = F.when(F.size("items") > 0, F.concat(F.lit(',"items":'), F.to_json("items")))
        kids = F.when(F.col("kids").isNotNull(), F.concat(F.lit(',"children":['), "kids", F.lit("]")))
        name = F.to_json(F.struct(F.col("level"), F.element_at("path", -1).alias("name")))
        node = F.concat(F.regexp_replace(name, r"\}$", ""), F.coalesce(has, F.lit("")), F.coalesce(kids, F.lit("")), F.lit("}"))
        one = here.select("grp", F.slice("path", 1, depth - 1).alias("path"), F.struct("ord", node.alias("json")).alias("n"))
        below = one.groupBy("grp", "path").agg(F.array_join(F.transform(F.array_sort(F.collect_list("n")), lambda n: n["json"]), ",").alias("kids"))
    if below is None:
        return tree.select("grp", F.lit("").alias("tree")).limit(0)
    return below.select("grp", F.concat(F.lit("["), "kids", F.lit("]")).alias("tree"))


def hierarchy(paths: DataFrame, path: str = "path") -> DataFrame:
    """(id, parent_id, depth, name): every prefix of every path once; blank segments are skipped, roots have no parent."""
    clean = paths.select(F.filter(F.transform(F.col(path), strip), lambda s: s != "").alias("p"))
    prefix = clean.select(F.explode(F.transform(F.filter(F.sequence(F.lit(0), F.size("p")), lambda n: n > 0), lambda n: F.slice("p", 1, n))).alias("p")).distinct()
    return prefix.select(F.array_join("p", "/").alias("id"), F.when(F.size("p") > 1, F.array_join(F.slice("p", 1, F.size("p") - 1), "/")).alias("parent_id"), F.size("p").alias("depth"), F.element_at("p", -1).alias("name"))


def under(paths: DataFrame, prefix: list[str], path: str = "path") -> DataFrame:
    """The paths that begin with a prefix."""
    if not prefix:
        return paths
    return paths.where(F.slice(F.col(path), 1, len(prefix)) == F.array(*map(F.lit, prefix)))


def distinct_at(paths: DataFrame, depth: int, prefix: list[str], path: str = "path") -> DataFrame:
    """(name, n_paths): the names at a depth under a prefix."""
    return under(paths, prefix, path).select(F.get(F.col(path), depth).alias("name")).where("name is not null").groupBy("name").agg(F.count("*").alias("n_paths"))


def reviewed(seeds: DataFrame, edits: DataFrame) -> DataFrame:
    """Seeds(path, items) after edits(path, op, item, to); op is add, update or delete; blank items are dropped."""
    e = edits.groupBy("path").agg(
        F.collect_set(F.when(F.col("op") == "delete", F.col("item"))).alias("gone"),
        F.sort_array(F.collect_list(F.when(F.col("op") == "add", F.col("item")))).alias("more"),
        F.collect_list(F.when(F.col("op") == "update", F.struct("item", "to"))).alias("upd"),
    )
    kept = F.filter("items", lambda i: ~F.array_contains(F.col("gone"), i))
    renamed = F.transform(kept, lambda i: F.coalesce(F.get(F.transform(F.filter("upd", lambda u: u["item"] == i), lambda u: u["to"]), 0), i))
    both = seeds.join(e, "path", "left")
    out = F.when(F.col("gone").isNull(), F.col("items")).otherwise(F.array_union(renamed, F.col("more")))
    return both.select("path", F.filter(out, lambda i: F.trim(i) != "").alias("items"))


def modes(documents: DataFrame, group: str) -> DataFrame:
    """(group, n, mode): whether a group's templates are taken as one merged tree, or a single one as it is."""
    n = documents.groupBy(group).agg(F.count("*").alias("n"))
    return n.select(group, "n", F.when(F.col("n") > 1, "merged").otherwise("single").alias("mode"))


def levels(documents: DataFrame, key: str, body: str) -> DataFrame:
    """(key, code, description): the level definitions of all templates together, none dropped."""
    text = F.coalesce(F.get_json_object(body, "$.levels_definition"), F.get_json_object(body, "$.taxonomy.levels_definition"))
    each = documents.select(key, F.explode(F.from_json(text, "array<struct<code: string, description: string>>")).alias("l"))
    return each.select(key, "l.code", "l.description")
