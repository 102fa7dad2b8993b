import os
import random
import subprocess
import sys

from pyspark.sql import functions as F

from siftgrade.llm import ledger

SCHEMA = "rule_id long, fieldname string, category string, copies int, first string, _key string"


def plain(rows):
    bare = lambda s: "".join(c for c in s.casefold() if c.isalnum())
    groups = {}
    for i, f, c, *_ in rows:
        if i is not None and f and c and f.strip() and c.strip():
            groups.setdefault(tuple(sorted((bare(f), bare(c)))), []).append(i)
    return sorted((min(g), i) for g in groups.values() for i in g if i != min(g)), {min(g): len(g) for g in groups.values()}


def found(spark, rows, batches=1, batch=None):
    df = spark.createDataFrame([(*r[:3], 1, "x", "y") for r in rows], SCHEMA)
    keys = ledger.keyed(df, "rule_id", ["fieldname", "category"], batch)
    led = ledger.build(keys, batches=batches)
    return sorted(map(tuple, ledger.copies(keys, led).collect())), {r.first: r.copies for r in led.read().collect()}


def test_formats_places_and_edges(spark):
    rows = [
        (5, "Pond_No", "港口/泊位"), (7, "pond.no", " 港口>泊位。"), (2, "“港口、泊位”", "POND NO"), (9, "no pond", "港口/泊位"),
        (3, None, "x"), (4, " ", "x"), (6, "x", "　"), (8, "--", "x"), (10, "..", "X"), (None, "Pond_No", "港口/泊位"), (11, "Ünï", "a"), (12, "ÜNÏ", "A"), (9, "no pond", "港口/泊位"),
    ]
    pairs, counts = found(spark, rows)
    assert pairs == [(2, 5), (2, 7), (8, 10), (11, 12)]
    assert counts == {2: 3, 9: 2, 8: 2, 11: 2}


def test_empty(spark):
    assert found(spark, []) == ([], {})


def test_batches_give_what_one_pass_gives(spark):
    pick = random.Random(1)
    rows = [(i, pick.choice(["A b", "a-B", "ab", "x1", "Ｘ1", "é"]), pick.choice(["c/d", "C D", "e", "ab"])) for i in range(400)]
    want = plain(rows)
    assert found(spark, rows) == want
    assert found(spark, rows, 3, F.pmod(F.col("rule_id"), F.lit(3))) == want  # later batches hold earlier ids too


def test_a_third_of_all_rows_in_one_key(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"f{i}", "c") for i in range(9_000)] + [(20_000, "f1", "C"), (20_001, "x" * 100_000, "c"), (20_002, "X" * 100_000, "c")]
    pairs, counts = found(spark, rows)
    assert len(pairs) == 2_999 + 2 and (0, 8_997) in pairs and (1, 20_000) in pairs and (20_001, 20_002) in pairs
    assert counts[0] == 3_000


def test_arrival_batches(spark):
    df = spark.createDataFrame([(i, f"2030-01-{1 + i % 28:02d} 00:00:00") for i in range(90)] + [(99, None)], "rule_id long, at string").withColumn("at", F.to_timestamp("at"))
    n = {r[0]: r[1] for r in df.groupBy(ledger.arrival_batches(df, "at", 3).alias("b")).count().collect()}
    assert sorted(n) == [0, 1, 2] and min(n.values()) > 15
    assert df.limit(0).select(ledger.arrival_batches(df.limit(0), "at", 3)).count() == 0


def test_a_later_process_goes_on(spark, tmp_path):
    folder, here = str(tmp_path / "ledger"), os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = f"""
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").config("spark.sql.warehouse.dir", {str(tmp_path / "w1")!r}).config("spark.checkpoint.dir", {str(tmp_path / "c1")!r}).getOrCreate()
from siftgrade.llm import ledger
df = spark.createDataFrame([(5, "A b", "c"), (7, "a-B", "C"), (8, "x", "y")], "rule_id long, fieldname string, category string")
ledger.build(ledger.keyed(df, "rule_id", ["fieldname", "category"]), folder={folder!r})
"""
    subprocess.run([sys.executable, "-c", code], cwd=here, check=True, capture_output=True)
    more = spark.createDataFrame([(2, "ab", "c"), (9, "new", "n")], "rule_id long, fieldname string, category string")
    keys = ledger.keyed(more, "rule_id", ["fieldname", "category"])
    led = ledger.build(keys, folder=folder)
    assert led.version == 2 and {r.first: r.copies for r in led.read().collect()} == {2: 3, 8: 1, 9: 1}
    again = ledger.Ledger(spark, folder=folder)
    assert again.version == 2 and again.keys == 3 and again.read().count() == 3


def test_buckets_grow_and_the_ledger_is_not_shuffled(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ledger, "BUCKET_KEYS", 10)
    rows = [(i, f"f{i % 300}", "c") for i in range(900)]
    df = spark.createDataFrame(rows, "rule_id long, fieldname string, category string")
    keys = ledger.keyed(df, "rule_id", ["fieldname", "category"], F.pmod(F.col("rule_id"), F.lit(3)))
    led = ledger.build(keys, batches=3, folder=str(tmp_path / "l"))
    assert led.buckets == 32 and led.read().where("copies = 3").count() == 300
    batch = ledger.counted(keys).select("_key", "copies", "first").repartition(led.buckets, "_key")
    both = led.read().join(batch, "_key", "full_outer")
    both.write.format("noop").mode("overwrite").save()
    plan = both._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("Scan parquet spark_catalog"):]
    assert "Bucketed: true" in scan and plan.count("Exchange hashpartitioning(_key") == 1
