"""Evaluation texts that leak into a corpus: every document, with the items it gives away.

Items are indexed by the character grams of their letters and digits, a BM25 posting per gram and item,
in blocks of items with the highest weight of each. Every passage of every document queries the index
by block-max WAND. An item's threshold is the least that any of its runs of RUN characters scores in
it, so a passage that holds such a run always reaches it: retrieval loses nothing, and an exact
comparison of passage and item then keeps the true leaks. The items are a stated query set: the index of
each shard of proven size is built in a task and written to the shared folder; the shards are broadcast
one after the other, each run against all documents; documents never shuffle but for the deduplication
of found pairs. Where items have a separate answer, both are verified and reported; those of this
project have none, so the overlap verified is that of the whole text.

Defined cases: null texts and texts of less than RUN letters and digits match nothing; repeated items
are each reported; a pair is reported once however often it occurs. Texts of any length are queried
whole, in overlapping passages.
"""

from __future__ import annotations

import math
import pickle
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import spread, written

RUN = 50
GRAM, K1, B = 12, 1.2, 0.75
#: Passages in letters and digits; they overlap by at least RUN - 1, so each run is inside one.
PASSAGE, STRIDE = 400, 350
BLOCK = 16
#: Letters and digits of the items in one shard of the index (some 100 bytes each), and shards at most.
SHARD_CHARS, MAX_SHARDS = 1_000_000, 256
_BASE = np.uint64(0x9E3779B97F4A7C15)


def bare(text: Column) -> Column:
    """Letters and digits, case folded."""
    return F.lower(F.upper(F.regexp_replace(text, r"[^\p{L}\p{N}]+", "")))


def grams(text: str) -> np.ndarray:
    """Hashes of all grams of a text, by position."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    n = len(code) - GRAM + 1
    out = np.zeros(max(n, 0), np.uint64)
    for i in range(GRAM if n > 0 else 0):
        out = out * _BASE + code[i : i + n]
    return out ^ (out >> np.uint64(29))


class Index:
    """Inverted index of items with BM25 weights, block maxima and per-item thresholds."""

    def __init__(self, items: list[tuple[object, str]]) -> None:
        items = sorted((i for i in items if len(i[1]) >= RUN), key=lambda i: str(i[0]))
        self.ids, self.texts = [i for i, _ in items], [t for _, t in items]
        n = len(items)
        found = [grams(t) for t in self.texts]
        tf = [Counter(g.tolist()) for g in found]
        df = Counter(g for c in tf for g in c)
        mean = sum(map(len, found)) / max(1, n)
        postings: dict[int, list[tuple[int, float]]] = {}
        least = np.zeros(n)
        for i, (g, c) in enumerate(zip(found, tf)):
            norm = K1 * (1 - B + B * len(g) / mean)
            weight = {h: math.log(1 + (n - df[h] + 0.5) / (df[h] + 0.5)) * k * (K1 + 1) / (k + norm) for h, k in c.items()}
            for h, w in weight.items():
                postings.setdefault(h, []).append((i, w))
            span, hs = RUN - GRAM + 1, g.tolist()
            least[i] = min(sum(weight[h] for h in set(hs[s : s + span])) for s in range(len(hs) - span + 1))
        self.keys = np.array(sorted(postings), np.uint64)
        self.post = [postings[h] for h in self.keys.tolist()]
        self.most = np.array([max(w for _, w in p) for p in self.post])
        self.blocks = []
        for p in self.post:
            tops: dict[int, float] = {}
            for i, w in p:
                tops[i // BLOCK] = max(tops.get(i // BLOCK, 0.0), w)
            self.blocks.append(tops)
        self.least = least - 1e-9
        self.block_least = [float(self.least[b : b + BLOCK].min()) for b in range(0, n, BLOCK)]
        self.lowest = float(self.least.min()) if n else math.inf
        self.sieve = np.zeros(1 << 22, bool)
        self.sieve[(self.keys >> np.uint64(42)).astype(np.int64)] = True

    def retrieve(self, terms: list[int]) -> list[int]:
        """All items that a passage with these terms scores at their threshold or above."""
        cursors = [[self.post[t][0][0], 0, t] for t in terms]
        out = []
        while cursors:
            cursors.sort()
            bound, pivot = 0.0, None
            for k, (_, _, t) in enumerate(cursors):
                bound += self.most[t]
                if bound >= self.lowest:
                    pivot = cursors[k][0]
                    break
            if pivot is None:
                break
            block = pivot // BLOCK
            shallow = sum(self.blocks[t].get(block, 0.0) for i, _, t in cursors if i // BLOCK <= block)
            if shallow < self.block_least[block]:
                target = (block + 1) * BLOCK  # no item of this block can reach its threshold
            else:
                if cursors[0][0] == pivot and sum(self.post[t][at][1] for i, at, t in cursors if i == pivot) >= self.least[pivot]:
                    out.append(pivot)
                target = pivot + 1 if cursors[0][0] == pivot else pivot
            for c in cursors:
                post = self.post[c[2]]
                while c[1] < len(post) and post[c[1]][0] < target:
                    c[1] += 1
                c[0] = post[c[1]][0] if c[1] < len(post) else -1
            cursors = [c for c in cursors if c[0] >= 0]
        return out

    def search(self, texts: list[str]) -> list[tuple[int, int]]:
        """(text, item) of every text that shares a run with an item; all passages of all texts are queried."""
        found: set[tuple[int, int]] = set()
        if not self.ids:
            return []
        for n, text in enumerate(texts):
            if len(text) < RUN:
                continue
            h = grams(text)
            at = np.flatnonzero(self.sieve[(h >> np.uint64(42)).astype(np.int64)])
            if not len(at):
                continue
            term = np.searchsorted(self.keys, h[at])
            term[term == len(self.keys)] = 0
            true = self.keys[term] == h[at]
            at, term = at[true], term[true]
            for start in range(0, max(1, len(text) - RUN + 1), STRIDE):
                low, high = np.searchsorted(at, [start, start + PASSAGE - GRAM + 1])
                if low == high:
                    continue
                terms = np.unique(term[low:high])
                if self.most[terms].sum() < self.lowest:
                    continue
                passage = text[start : start + PASSAGE]
                for item in self.retrieve(terms.tolist()):
                    if (n, item) not in found and shares_run(passage, self.texts[item]):
                        found.add((n, item))
        return sorted(found)


def shares_run(passage: str, item: str) -> bool:
    return any(passage[i : i + RUN] in item for i in range(len(passage) - RUN + 1))


def built(items: DataFrame, shards: int) -> DataFrame:
    """(shard, index): the pickled index of every shard of items(_item, _text), built in tasks."""

    def build(part: pd.DataFrame) -> pd.DataFrame:
        index = Index(list(zip(part["_item"].tolist(), part["_text"].tolist())))
        return pd.DataFrame({"shard": [part["shard"].iat[0]], "index": [pickle.dumps(index)]})

    sharded = items.withColumn("shard", F.pmod(F.xxhash64("_item"), F.lit(shards)).cast("int"))
    return sharded.groupBy("shard").applyInPandas(build, "shard int, index binary")  # about SHARD_CHARS characters a group


def leaked(docs: DataFrame, key: str, text: str, items: DataFrame, item_key: str, item_text: str, item_answer: str | None = None) -> DataFrame:
    """(key, item_key): every document that shares a run of RUN letters and digits with an item.

    With item_answer, the column of the items' answers, there is a third column `answered`: whether the
    document holds the answer too, by letters and digits; null where an item has no answer.
    """
    wanted = items.where(F.col(item_key).isNotNull()).select(F.col(item_key).alias("_item"), bare(F.col(item_text)).alias("_text")).where(F.length("_text") >= RUN)
    chars = wanted.agg(F.coalesce(F.sum(F.length("_text")), F.lit(0))).first()[0]
    shards = max(1, -(-chars // SHARD_CHARS))
    if shards > MAX_SHARDS:
        raise ValueError(f"the items need {shards} shards of the index; {MAX_SHARDS} are allowed")
    src = spread(docs).where(F.col(key).isNotNull()).select(F.col(key).alias("_key"), bare(F.col(text)).alias("_text")).where(F.length("_text") >= RUN)
    kind, item_kind = src.schema["_key"].dataType.simpleString(), wanted.schema["_item"].dataType.simpleString()
    indexes = written(built(wanted, shards))
    found = src.sparkSession.createDataFrame([], f"_key {kind}, _item {item_kind}")
    for s in range(shards):
        own = indexes.where(F.col("shard") == s).select("index").first()
        if own is None:
            continue
        index = docs.sparkSession.sparkContext.broadcast(bytes(own["index"]))  # of about SHARD_CHARS characters

        def run(batches: Iterator[pd.DataFrame], index=index) -> Iterator[pd.DataFrame]:
            here = pickle.loads(index.value)
            for b in batches:
                hits = here.search(b["_text"].tolist())
                yield pd.DataFrame({"_key": [b["_key"].iat[n] for n, _ in hits], "_item": [here.ids[i] for _, i in hits]})

        one = src.mapInPandas(run, f"_key {kind}, _item {item_kind}")
        if shards == 1:
            found = one
        else:  # written at once, so that no more than one shard's broadcast lives
            found = found.unionByName(written(one))
            index.destroy()
    found = found.distinct()
    if item_answer is None:
        return found.select(F.col("_key").alias(key), F.col("_item").alias(item_key))
    answers = items.select(F.col(item_key).alias("_item"), F.nullif(bare(F.col(item_answer)), F.lit("")).alias("_answer"))
    texts = docs.select(F.col(key).alias("_key"), bare(F.col(text)).alias("_text"))
    both = found.join(answers, "_item").join(texts, "_key").groupBy("_key", "_item").agg(F.max(F.col("_text").contains(F.col("_answer"))).alias("answered"))
    return both.select(F.col("_key").alias(key), F.col("_item").alias(item_key), "answered")
