"""What stands between the pipeline and a model: retries, a circuit breaker, a result cache, and a default embedder.

A model is any function from a pandas Series of texts to a Series of results. ``guarded`` runs it once per Arrow batch with
retries behind a breaker that lives as long as its Python worker.
"""

from __future__ import annotations

import time
import zlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from narrata.functions.shipping import ship_package


def back_off(attempt: int, base: float = 2.0, most: float = 60.0, retry_after: float | None = None) -> float:
    """Seconds to wait before the next try; what the server asks for comes first."""
    return retry_after if retry_after is not None else min(most, base * 2**attempt)


@dataclass(frozen=True)
class Breaker:
    """A circuit breaker as a value: each step gives the next one."""

    failures: int = 0
    opened_at: float | None = None
    limit: int = 5
    open_seconds: float = 60.0

    def state(self, now: float) -> str:
        if self.opened_at is None:
            return "closed"
        return "half-open" if now - self.opened_at >= self.open_seconds else "open"

    def after(self, ok: bool, now: float) -> Breaker:
        if ok:
            return Breaker(0, None, self.limit, self.open_seconds)
        failures = self.failures + 1
        opens = failures >= self.limit or self.state(now) == "half-open"
        return Breaker(failures, now if opens else self.opened_at, self.limit, self.open_seconds)


def guarded(model: Callable[[pd.Series], pd.Series], attempts: int = 3, base: float = 2.0, breaker: Breaker = Breaker(), wait: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.monotonic):
    """``model`` with retries; while the breaker is open a batch fails at once, and Spark's task retry takes over."""
    held = [breaker]

    def run(texts: pd.Series) -> pd.Series:
        for attempt in range(attempts):
            if held[0].state(clock()) == "open":
                raise RuntimeError("circuit open")
            try:
                result = model(texts)
            except Exception:
                held[0] = held[0].after(False, clock())
                if attempt == attempts - 1:
                    raise
                wait(back_off(attempt, base))
            else:
                held[0] = held[0].after(True, clock())
                return result
        raise AssertionError("unreachable")

    return run


def cached(docs: DataFrame, text_col: str, compute: Callable[[Column], Column], out: str) -> DataFrame:
    """``docs`` with ``out``, computed once for each different text and joined back by the text's hash."""
    keyed = docs.withColumn("_key", F.md5(text_col))
    once = keyed.groupBy("_key").agg(F.first(text_col).alias("_text")).select("_key", compute(F.col("_text")).alias(out))
    return keyed.join(once, "_key").drop("_key")


def hashed_embedding(size: int = 64):
    """Signed hashed word counts of unit length: a deterministic stand-in for a sentence model."""

    def run(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            v = np.zeros(size)
            for word in (text or "").lower().split():
                h = zlib.crc32(word.encode())
                v[h % size] += 1 if h & (1 << 20) else -1
            n = np.linalg.norm(v)
            out.append(v / n if n else v)
        return pd.Series(out, dtype=object)

    return run


def embedded(df: DataFrame, text: Column, out: str = "embedding", model: Callable[[pd.Series], pd.Series] | None = None) -> DataFrame:
    ship_package(df.sparkSession)
    return df.withColumn(out, F.pandas_udf(model or hashed_embedding(), "array<double>")(text))
