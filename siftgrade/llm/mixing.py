"""Mixing sources to target weights by nested hash-threshold histograms.

Sizes are tokens of a public tokenizer over whole texts, counted once and written to the shared folder.
Every record has a fixed 60-bit hash. A source that must give more than it has is used whole several
times; the part beyond is the records whose hash is below a threshold. Thresholds come from histograms:
tokens summed by source and the leading 10 bits, then only the boundary bucket by its next 10 bits, and
so on until that bucket is a single record, so no record is sorted. The running sums over a histogram,
1024 rows a source, are Spark's too; the driver gets one boundary bucket a source and level. A larger
budget keeps all records of a smaller one.

Defined cases: records without text, tokens or source, and of sources without a target, take no part;
targets without records get nothing and are reported; null or negative shares count as 0, null repeats
as 1; of several targets of a source the first by share counts; ties of the hash stay together. Shares
are taken relative to each other over the sources that have records. By default the mixture is as
large as the shares and repeats allow; with a size given, sources that run out are reported with less.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import spread, written

TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
BITS, LEVELS = 10, 6
MAX_SOURCES = 10_000


#: White space runs of this length are encoded apart: the tokenizer's pattern takes all of one but its last character as one match, but can't go through very long ones.
_RUN = re.compile("[\t\n\v\f\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{1000,}")


def n_tokens(coder, text: str) -> int:
    """Tokens of a whole text."""
    n = at = 0
    for m in _RUN.finditer(text):
        end = m.end() if m.end() == len(text) else m.end() - 1
        n += len(coder.encode_ordinary(text[at : m.start()])) + len(coder._encode_single_piece(text[m.start() : end]))
        at = end
    return n + len(coder.encode_ordinary(text[at:] if at else text))


def token_counts(docs: DataFrame, key: str, text: str, source: str, tokenizer: str = TOKENIZER) -> DataFrame:
    """(_key, source, n_tokens, h) of every record that has a text and a source."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import base64

        import public_tokenizers
        import tiktoken

        with open(tokenizer, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        coder = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        for b in batches:
            b["n_tokens"] = [n_tokens(coder, t) for t in b["_text"]]
            yield b[["_key", "source", "n_tokens"]]

    src = docs.select(F.col(key).alias("_key"), F.col(source).alias("source"), F.col(text).alias("_text")).where("_key is not null and source is not null and _text <> ''")
    src = spread(src)
    kind = src.schema["_key"].dataType.simpleString()
    out = src.mapInPandas(count, f"_key {kind}, source string, n_tokens long").where("n_tokens > 0")
    return out.withColumn("h", F.shiftrightunsigned(F.xxhash64("_key"), 64 - BITS * LEVELS))


def thresholds(tokens: DataFrame, budgets: dict[str, float]) -> dict[str, int]:
    """For each source the hash below which its records hold its budget of tokens, to the nearest record."""
    spark = tokens.sparkSession
    left, prefix, out = dict(budgets), dict.fromkeys(budgets, 0), {}
    for level in range(1, LEVELS + 1):
        live = [(s, prefix[s]) for s in left]
        if not live:
            break
        here = F.broadcast(spark.createDataFrame(live, "source string, p long"))
        rest = BITS * (LEVELS - level)
        rows = tokens.join(here, "source").where(F.shiftright("h", rest + BITS) == F.col("p"))
        hist = rows.groupBy("source", F.shiftright("h", rest).alias("b")).agg(F.sum("n_tokens").alias("n"), F.count("*").alias("k"))
        summed = hist.withColumn("upto", F.sum("n").over(Window.partitionBy("source").orderBy("b")))  # at most 2**BITS rows a source
        want = F.broadcast(spark.createDataFrame(list(left.items()), "source string, want double"))
        crossed = summed.join(want, "source").where(F.col("upto") > F.col("want"))
        edge = {r.source: r.m for r in crossed.groupBy("source").agg(F.min_by(F.struct("b", "n", "k", "upto"), "b").alias("m")).collect()}  # one row a source
        for s in list(left):
            if s not in edge:
                out[s] = (prefix[s] + 1) << (rest + BITS)
                del left[s]
                continue
            m, more = edge[s], left[s] - (edge[s].upto - edge[s].n)
            if m.k == 1 or level == LEVELS:  # a single record, or equal hashes: whichever is nearer
                out[s] = (m.b + (m.n - more < more)) << rest
                del left[s]
            else:
                left[s], prefix[s] = more, m.b
    return out


def mix(tokens: DataFrame, targets: DataFrame, size: float | None = None) -> tuple[DataFrame, DataFrame]:
    """(mixture, report) for token_counts and targets(source, target_share, max_repeats).

    mixture(_key, source, n_tokens, copies); report has a row per target with what it could give, what
    it gave and its actual share.
    """
    spark = tokens.sparkSession
    tokens = written(tokens)
    have = tokens.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("records"))
    goals = targets.where("source is not null").groupBy("source").agg(F.max(F.struct(F.greatest(F.coalesce("target_share", F.lit(0.0)), F.lit(0.0)).alias("share"), F.greatest(F.coalesce("max_repeats", F.lit(1)), F.lit(0)).alias("cap"))).alias("g"))
    plan = goals.join(have, "source", "left").select("source", "g.share", "g.cap", F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("records", F.lit(0)).alias("records"))
    rows = plan.limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources have targets")
    able = {r.source: r for r in rows if r.tokens and r.share > 0 and r.cap > 0}
    weight = sum(r.share for r in able.values())
    most = min((r.cap * r.tokens * weight / r.share for r in able.values()), default=0.0)
    total = most if size is None else size
    whole, part = {}, {}
    for s, r in able.items():
        need = min(total * r.share / weight, r.cap * r.tokens)
        whole[s] = int(need // r.tokens)
        part[s] = need - whole[s] * r.tokens
    below = thresholds(tokens, {s: p for s, p in part.items() if p >= 1 and whole[s] < able[s].cap})
    drawn = F.broadcast(spark.createDataFrame([(s, whole[s], below.get(s, 0)) for s in able], "source string, whole int, below long"))
    mixture = tokens.join(drawn, "source").select("_key", "source", "n_tokens", (F.col("whole") + (F.col("h") < F.col("below")).cast("int")).alias("copies")).where("copies > 0")
    used = mixture.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("drawn_tokens"), F.count("*").alias("used_records"), F.max("copies").alias("most_copies"))
    goal_rows = F.broadcast(spark.createDataFrame([(r.source, r.share, r.cap, r.tokens, r.records) for r in rows], "source string, target_share double, max_repeats int, tokens long, records long"))
    report = goal_rows.join(used, "source", "left").na.fill(0, ["drawn_tokens", "used_records", "most_copies"])
    all_drawn = report.agg(F.sum("drawn_tokens").alias("all"), F.sum(F.when(F.col("tokens") > 0, F.col("target_share"))).alias("weights"))
    report = report.crossJoin(F.broadcast(all_drawn))  # one row
    return mixture, report.select("source", "target_share", F.when(F.col("tokens") > 0, F.coalesce(F.try_divide("target_share", "weights"), F.lit(0.0))).otherwise(0.0).alias("normed_share"), "max_repeats", "tokens", "records", "drawn_tokens", "used_records", "most_copies", F.coalesce(F.try_divide(F.col("drawn_tokens"), F.col("all")), F.lit(0.0)).alias("actual_share"))
