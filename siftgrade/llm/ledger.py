"""Copies hidden by formatting: an incremental ledger of canonical keys.

The canonical key of a record is made of its fields' letters and digits without regard to case, the
fields in sorted order, so that differences of white space, case, punctuation and field order vanish.
The ledger keeps, per key, the number of copies and the earliest representative, as a table in hash
buckets. A batch is aggregated (partly before its shuffle) and joined by full outer join to the buckets;
because both lie in the same buckets only the batch moves, the ledger doesn't. The result is a new
version; earlier ones are never changed, so a lost executor or a failed batch costs nothing but that
batch's work. Versions are listed in the folder itself: a later process given the same folder goes on
where the last one stopped. Buckets double as the ledger grows. One process at a time may add.

Defined cases: rows with a null or blank field, or a null id, are left out; fields without any letter
or digit count as equal to each other; repeated rows under one id add copies but no found row; an
empty table gives an empty ledger. Columns other than those named play no part.
"""

from __future__ import annotations

import os
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir, written

#: Buckets of a new ledger, and keys in a bucket beyond which their number doubles.
BUCKETS, BUCKET_KEYS = 8, 4_000_000
#: Keys with more than this share of all copies are joined by broadcast; there can be no more than 1/share.
HOT_SHARE = 1 / 2000


def bare(x: Column) -> Column:
    """Letters and digits, case folded."""
    return F.lower(F.upper(F.regexp_replace(x, r"[^\p{L}\p{N}]+", "")))


def keyed(rows: DataFrame, id_col: str, fields: list[str], batch: Column | None = None) -> DataFrame:
    """(_id, _key, _batch) of the rows whose fields are all filled."""
    filled = rows
    for f in fields:
        filled = filled.where(F.col(f).rlike(r"(?U)[^\s\x1c-\x1f]"))
    content = F.array_join(F.array_sort(F.array(*(bare(F.col(f)) for f in fields))), "\x01")
    return filled.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id"), F.unhex(F.md5(content)).alias("_key"), (F.lit(0) if batch is None else batch).cast("int").alias("_batch"))


def counted(keys: DataFrame) -> DataFrame:
    """(_batch, _key, copies, first) of keyed rows."""
    return keys.groupBy("_batch", "_key").agg(F.count("*").alias("copies"), F.min("_id").alias("first"))


class Ledger:
    """Versions of bucketed counts (_key, copies, first) in a folder; the newest is in force."""

    def __init__(self, spark: SparkSession, id_type: str = "bigint", folder: str | None = None) -> None:
        self.spark, self.id_type = spark, id_type
        self.folder = folder or os.path.join(shared_dir(spark), f"ledger-{uuid.uuid4().hex}")
        self.version, self.path, self.buckets, self.keys = 0, None, BUCKETS, 0
        try:
            seen = spark.read.schema("version int, path string, buckets int, n_keys bigint").json(os.path.join(self.folder, "versions", "*"))
            newest = seen.orderBy(F.desc("version")).limit(1).collect()
        except AnalysisException:  # no version yet
            newest = []
        for r in newest:
            self.version, self.path, self.buckets, self.keys = r.version, os.path.join(self.folder, r.path), r.buckets, r.n_keys

    def read(self) -> DataFrame:
        """The version in force, as a table whose buckets Spark knows."""
        if self.path is None:
            return self.spark.createDataFrame([], f"_key binary, copies bigint, first {self.id_type}")
        name = f"ledger_{uuid.uuid5(uuid.NAMESPACE_URL, self.path).hex}"
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (_key BINARY, copies BIGINT, first {self.id_type}) USING parquet CLUSTERED BY (_key) INTO {self.buckets} BUCKETS LOCATION '{self.path}'")
        return self.spark.table(name)

    def add(self, batch: DataFrame) -> None:
        """Add a batch of counts (_key, copies, first), a row per key."""
        if not batch.limit(1).count():
            return
        buckets = self.buckets
        while self.keys > buckets * BUCKET_KEYS:
            buckets *= 2
        batch = batch.select("_key", "copies", "first")
        if self.path is None:
            now = batch.repartition(buckets, "_key")
        else:
            old = self.read().select("_key", F.col("copies").alias("c0"), F.col("first").alias("f0"))
            both = old.join(batch.repartition(self.buckets, "_key"), "_key", "full_outer")
            now = both.select("_key", (F.coalesce("c0", F.lit(0)) + F.coalesce("copies", F.lit(0))).alias("copies"), F.least("f0", "first").alias("first"))
        name = f"v-{self.version + 1:06d}-{uuid.uuid4().hex}"
        path = os.path.join(self.folder, name)
        now.write.format("parquet").bucketBy(buckets, "_key").option("path", path).saveAsTable(f"ledger_{uuid.uuid5(uuid.NAMESPACE_URL, path).hex}")
        keys = self.spark.read.parquet(path).count()
        entry = self.spark.createDataFrame([(self.version + 1, name, buckets, keys)], "version int, path string, buckets int, n_keys bigint")
        entry.coalesce(1).write.json(os.path.join(self.folder, "versions", f"{self.version + 1:06d}"))  # from here on it is in force
        self.version, self.path, self.buckets, self.keys = self.version + 1, path, buckets, keys


def build(keys: DataFrame, id_type: str = "bigint", batches: int = 1, folder: str | None = None) -> Ledger:
    """The ledger in folder, a new one by default, with keyed rows added batch after batch in the order of _batch; the rows are read once."""
    ledger = Ledger(keys.sparkSession, id_type, folder)
    counts = written(counted(keys), "_batch")
    for i in range(batches):
        ledger.add(counts.where(F.col("_batch") == i))
    return ledger


def copies(keys: DataFrame, ledger: Ledger) -> DataFrame:
    """(keep_id, _id) of every row that repeats an earlier one."""
    more = ledger.read().where("copies > 1").select("_key", F.col("first").alias("keep_id"), "copies")
    total = ledger.read().agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    hot = F.broadcast(more.where(F.col("copies") > total * HOT_SHARE).drop("copies"))
    rest = more.where(F.col("copies") <= total * HOT_SHARE).drop("copies")
    hit = keys.select("_id", "_key").join(hot, "_key")
    cold = keys.select("_id", "_key").join(hot.select("_key"), "_key", "left_anti").join(rest, "_key")
    return hit.unionByName(cold).where("_id <> keep_id").select("keep_id", "_id")


def arrival_batches(rows: DataFrame, when: str, batches: int) -> Column:
    """The number of each row's batch if rows arrive by time in so many batches of about one size."""
    at = F.col(when).cast("timestamp").cast("double")
    cuts = rows.agg(F.percentile_approx(at, [i / batches for i in range(1, batches)], 1000)).first()[0] or []
    return sum(((F.coalesce(at, F.lit(float("-inf"))) > c).cast("int") for c in cuts), F.lit(0))
