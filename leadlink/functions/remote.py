"""Vectors from a remote model: batches, retries with backoff, and rows for what failed.

A client is any picklable callable from a list of texts to a list of vectors. What it raises is
tried again if it is a Retryable, a timeout or a lost connection; other errors are not. A batch that
keeps failing gives a row with its error for each text; the job goes on, and its other texts are kept."""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Retryable(Exception):
    """A failure that may pass: a quota, an overload, a server error."""


class WrongCount(Retryable):
    """An answer with more or fewer vectors than texts."""


@dataclass(frozen=True)
class Policy:
    # fixed values of the embedding contract: texts of a request, tries, and seconds of delay
    batch: int = 250
    tries: int = 6
    base: float = 1.5
    jitter: float = 1.5
    longest: float = 90.0
    #: Threads of a task; requests wait for the network, not for a core.
    at_once: int = 1

    def __post_init__(self):
        if self.batch < 1 or self.tries < 1 or self.at_once < 1:
            raise ValueError("batch, tries and at_once must be positive")
        if min(self.base, self.jitter, self.longest) < 0:
            raise ValueError("delays must not be negative")

    def delay(self, failures: int, draw: float) -> float:
        """Seconds to wait after so many failures; draw: from 0 to 1."""
        return min(self.base * 2 ** (failures - 1) + self.jitter * draw, self.longest)


def retryable(e: BaseException) -> bool:
    return isinstance(e, (Retryable, TimeoutError, ConnectionError))


def request(client: Callable, texts: list[str], policy: Policy, sleep: Callable = time.sleep, draw: Callable = random.random) -> tuple[list, int, str | None]:
    """(vectors, calls, error) of one batch. Vectors are null where it failed."""
    for call in range(1, policy.tries + 1):
        try:
            got = client(texts)
            if len(got) != len(texts):
                raise WrongCount(f"{len(texts)} texts gave {len(got)} vectors")
            return list(got), call, None
        except Exception as e:
            if call == policy.tries or not retryable(e):
                return [None] * len(texts), call, f"{type(e).__name__}: {e}"
            sleep(policy.delay(call, draw()))
    raise AssertionError("a policy has one try at least")


def embedded(df: DataFrame, client: Callable, policy: Policy = Policy(), column: str = "text") -> DataFrame:
    """text, v, calls and error for every distinct, filled text of df, trimmed. calls are those of the
    text's batch; v is null where there is an error, and where the model gives none."""
    texts = df.select(F.trim(F.col(column)).alias("text")).where("text <> ''").distinct()

    def run(batches: Iterator) -> Iterator:
        from concurrent.futures import ThreadPoolExecutor

        import pandas as pd

        with ThreadPoolExecutor(policy.at_once) as pool:
            for p in batches:
                parts = [p["text"].iloc[i : i + policy.batch].tolist() for i in range(0, len(p), policy.batch)]
                for part, (v, calls, error) in zip(parts, pool.map(lambda t: request(client, t, policy), parts)):
                    yield pd.DataFrame({"text": part, "v": v, "calls": calls, "error": error})

    return texts.mapInPandas(run, "text string, v array<double>, calls int, error string")


def failures(rows: DataFrame) -> DataFrame:
    """Errors with how many texts they cost, most first."""
    return rows.where("error IS NOT NULL").groupBy("error").agg(F.count(F.lit(1)).alias("texts"), F.max("calls").alias("calls")).orderBy(F.desc("texts"), "error")
