import base64
import os

import pytest
from pyspark.sql import functions as F

from siftgrade.llm import mixing

TARGETS = "source string, target_share double, max_repeats int"


def tokens(spark, sizes):
    """sizes: tokens of each record by source."""
    rows = [(i * 1000 + s, f"s{s}", n) for s, ns in sizes.items() for i, n in enumerate(ns)]
    df = spark.createDataFrame(rows, "_key long, source string, n_tokens long")
    return df.withColumn("h", F.shiftrightunsigned(F.xxhash64("_key"), 64 - mixing.BITS * mixing.LEVELS))


def run(spark, sizes, targets, size=None):
    mixture, report = mixing.mix(tokens(spark, sizes), spark.createDataFrame(targets, TARGETS), size)
    return mixture.collect(), {r.source: r for r in report.collect()}


def test_shares_are_met_to_the_record(spark):
    sizes = {1: [7] * 3_000, 2: [5, 9] * 200, 3: [11] * 50, 4: [3] * 10}
    m, r = run(spark, sizes, [("s1", 0.6, 1), ("s2", 0.3, 3), ("s3", 0.1, 4), ("s9", 0.5, 2)])
    total = sum(x.n_tokens * x.copies for x in m)
    for s, share in (("s1", 0.6), ("s2", 0.3), ("s3", 0.1)):
        assert abs(r[s].drawn_tokens - share * total) <= 40 and abs(r[s].actual_share - share) < 0.01
        assert r[s].normed_share == pytest.approx(share) and r[s].most_copies <= r[s].max_repeats
    assert (r["s9"].tokens, r["s9"].drawn_tokens, r["s9"].actual_share) == (0, 0, 0.0) and "s4" not in r
    assert r["s3"].most_copies == 4 or r["s2"].most_copies == 3 or r["s1"].drawn_tokens == 21_000
    again, _ = run(spark, sizes, [("s1", 0.6, 1), ("s2", 0.3, 3), ("s3", 0.1, 4), ("s9", 0.5, 2)])
    assert sorted(map(tuple, again)) == sorted(map(tuple, m))


def test_larger_budgets_keep_what_smaller_ones_took(spark):
    sizes = {1: [10] * 500, 2: [10] * 500}
    small, _ = run(spark, sizes, [("s1", 1.0, 1), ("s2", 1.0, 1)], 2_000)
    large, _ = run(spark, sizes, [("s1", 1.0, 1), ("s2", 1.0, 1)], 6_000)
    assert {x._key for x in small} <= {x._key for x in large}
    assert sum(x.n_tokens for x in small) == 2_000 and sum(x.n_tokens for x in large) == 6_000


def test_a_source_that_runs_out(spark):
    _, r = run(spark, {1: [10] * 100, 2: [10] * 5}, [("s1", 0.5, 1), ("s2", 0.5, 2)], 400)
    assert (r["s1"].drawn_tokens, r["s2"].drawn_tokens, r["s2"].most_copies) == (200, 100, 2)


def test_edges(spark):
    m, r = run(spark, {1: []}, [("s1", 0.5, 1), (None, 0.2, 1)])
    assert m == [] and r["s1"].drawn_tokens == 0
    m, r = run(spark, {1: [1_000_000], 2: [1] * 10}, [("s1", None, 1), ("s2", 0.2, None), ("s2", 0.1, 9)])
    assert r["s1"].drawn_tokens == 0 and r["s2"].drawn_tokens == 10
    m, r = run(spark, {1: [10] * 3}, [("s1", -1.0, 1)])
    assert m == []


@pytest.mark.skipif(not os.path.exists(mixing.TOKENIZER), reason="no tokenizer files here")
def test_tokens_of_whole_texts(spark):
    import public_tokenizers
    import tiktoken

    docs = spark.createDataFrame([(1, "hello world", "a"), (2, None, "a"), (3, "", "a"), (4, "x", None), (5, "字" * 250_000, "b"), (6, "hello world\n" * 20_000, "b"), (1, "hello world", "a")], "doc_id long, text string, source string")
    got = mixing.token_counts(docs, "doc_id", "text", "source").collect()
    assert sorted(r._key for r in got) == [1, 1, 5, 6]
    n = {r._key: r.n_tokens for r in got}
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(mixing.TOKENIZER, "rb"))}
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert n[1] == len(coder.encode_ordinary("hello world"))
    assert n[6] == len(coder.encode_ordinary("hello world\n" * 20_000)) and n[5] == len(coder.encode_ordinary("字" * 250_000))
    assert len({r.h for r in got if r._key == 1}) == 1
    assert mixing.token_counts(docs.limit(0), "doc_id", "text", "source").count() == 0
    for gap in (" " * 1_500, "\n" * 1_200, " \t" * 900 + "\u3000", "\x85" * 1_000):
        for text in ("a" + gap + "b", gap, gap + "12", "x," + gap, gap + "é" + gap + ".", "a" + gap + "\x1cb"):
            assert mixing.n_tokens(coder, text) == len(coder.encode_ordinary(text)), text[:3]
    assert mixing.n_tokens(coder, "a" + " " * 3_000_000 + "b") > 1
