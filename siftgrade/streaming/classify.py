"""Classification of catalog rows as they arrive: the scoring projection on a stream, without state."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import classify, rules
from ..plans.catalog import _CLASSIFY, _ITEM, _ROLES, CATALOG_ITEMS
from ..session import shared_dir, table


def classify_stream(stream: DataFrame, key: str, roles: dict[str, str | None], score_rules: DataFrame, items: DataFrame) -> DataFrame:
    """A streaming frame of decisions; no shuffle, no state, so it runs in append mode at any rate."""
    return classify.by_expression(classify.facts(stream, key, roles), score_rules, items)


def run_available(spark: SparkSession, source: str, schema, decide, out: str | None = None) -> DataFrame:
    """Run decide(stream) over what lies in a Parquet folder or file until it is used up; returns what was written.

    Progress and results go to the shared folder, so a restarted run goes on where it stopped.
    """
    base = out or os.path.join(shared_dir(spark), f"stream-{uuid.uuid4().hex}")
    folder, name = os.path.split(source.rstrip("/"))
    reader = spark.readStream.schema(schema)
    stream = reader.option("pathGlobFilter", name).parquet(folder) if os.path.isfile(source) else reader.parquet(source)
    result = decide(stream)
    query = result.writeStream.format("parquet").option("path", f"{base}/rows").option("checkpointLocation", f"{base}/progress").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(result.schema).parquet(f"{base}/rows")


def stream_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog classified as a stream."""
    tables = rules.rule_tables(spark.createDataFrame(CATALOG_ITEMS, _ITEM))
    decide = lambda s: classify_stream(s, "row_id", _ROLES, *tables).select("row_id", F.col("score").cast("double").alias("score"), "tags", "category", "level", "rule_id", "marker", "confidence", "matched")
    schema = table(spark, sf_dir, "xlsx_catalog").schema
    return run_available(spark, f"{sf_dir}/xlsx_catalog.parquet", schema, decide)


QUERIES = {"stream_classify": stream_classify}
SQL = {"stream_classify": _CLASSIFY}
