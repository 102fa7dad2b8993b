"""A chat model as a table function: requests as messages, a pluggable client, replies parsed.

The client is any picklable callable(messages) -> str; failures are retried with growing waits, and a
request that keeps failing is reported in `error` instead of being dropped.
"""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import col


class TooManyRequests(Exception):
    """A client raises this when it is told to slow down."""


def messages(system: str, payload: Column, examples: list[tuple[str, str]] = ()) -> Column:
    """array of (role, content): system prompt, example turns, then the payload."""
    fixed = [("system", system)] + [t for q, a in examples for t in (("user", q), ("assistant", a))]
    turn = lambda r, c: F.struct(F.lit(r).alias("role"), c.alias("content"))
    return F.array(*(turn(r, F.lit(c)) for r, c in fixed), turn("user", payload))


def extraction_payload(domain: Column, seeds: Column, fragments: Column) -> Column:
    return F.to_json(F.struct(domain.alias("domain"), seeds.alias("seeds"), fragments.alias("fragments")))


def _ask(client: Callable, turns: list, attempts: int, backoff: float) -> tuple[str | None, str | None]:
    for i in range(attempts):
        try:
            return client(turns), None
        except TooManyRequests as e:
            why, wait = str(e) or "too many requests", backoff * 2**i + random.uniform(0, backoff / 3)
        except Exception as e:  # noqa: BLE001 - whatever a client raises is a failed attempt
            why, wait = f"{type(e).__name__}: {e}", min(1.0, backoff)
        if i + 1 < attempts:
            time.sleep(wait)
    return None, why


def chat(requests: DataFrame, key: str, client: Callable, workers: int = 4, attempts: int = 6, backoff: float = 0.8) -> DataFrame:
    """(key, reply, error) of requests(key, messages); at most `workers` calls run at once."""
    kind = requests.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [_ask(client, [dict(role=m["role"], content=m["content"]) for m in ms], attempts, backoff) for ms in b["messages"]]
            yield pd.DataFrame({"k": b[key], "reply": [r for r, _ in got], "error": [e for _, e in got]})

    out = requests.select(key, "messages").repartition(workers, key).mapInPandas(run, f"k {kind}, reply string, error string")
    return out.withColumnRenamed("k", key)


def json_slice(reply: Column | str) -> Column:
    """From the first { to the last }; null if there is none."""
    return F.nullif(F.regexp_extract(col(reply), r"(?s)\{.*\}", 0), F.lit(""))


def parsed(replies: DataFrame, schema: str) -> DataFrame:
    """replies with `parsed`, and an error where the reply holds no JSON object."""
    out = replies.withColumn("parsed", F.from_json(json_slice("reply"), schema))
    return out.withColumn("error", F.coalesce("error", F.when(json_slice("reply").isNull(), F.lit("no JSON object in the reply"))))
