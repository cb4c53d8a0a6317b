"""Results kept across runs: a table keyed by what was asked, in which entries expire."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from narrata.operators.cutting import children, cut, remove


class Cache:
    """Entries (key, value, at) in a folder, appended by hour, so that expired ones are dropped as whole folders.

    An entry counts for ``seconds``; of several for a key, two runs at once say, the latest counts. A crash while entries are
    written leaves none of that run.
    """

    def __init__(self, spark: SparkSession, folder: str, seconds: float, clock: Callable[[], float] = time.time):
        self.spark, self.folder, self.seconds, self.clock = spark, folder, seconds, clock

    def _hours(self) -> dict[int, str]:
        return {int(name[5:]): f"{self.folder}/{name}" for name in children(self.spark, self.folder) if name.startswith("hour=")}

    def entries(self, kind: str) -> DataFrame:
        """key, value of all that has not expired; ``kind``: the value's type."""
        oldest = self.clock() - self.seconds
        paths = [path for hour, path in self._hours().items() if (hour + 1) * 3600 > oldest]
        schema = f"key string, value {kind}, at double"
        paths = [f"{path}/{run}" for path in paths for run in children(self.spark, path) if "_SUCCESS" in children(self.spark, f"{path}/{run}")]
        rows = self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)
        return rows.where(F.col("at") > oldest).groupBy("key").agg(F.max_by("value", "at").alias("value"))

    def through(self, rows: DataFrame, key: str, compute: Callable[[DataFrame], DataFrame], kind: str, out: str) -> DataFrame:
        """``rows`` with ``out``. ``compute`` gets a row of each key that is not held and returns key, value; null keys are not kept."""
        held = cut(self.entries(kind))
        asked = rows.where(F.col(key).isNotNull()).dropDuplicates([key])
        missing = asked.join(held.select(F.col("key").alias(key)), key, "left_anti")
        now = self.clock()
        target = f"{self.folder}/hour={int(now // 3600)}/run={uuid.uuid4().hex}"
        compute(missing).select(F.col("key").cast("string"), F.col("value").cast(kind), F.lit(now).alias("at")).write.parquet(target)
        fresh = self.spark.read.schema(held.schema).parquet(target)
        both = held.unionByName(fresh).select(F.col("key").alias("_cache_key"), F.col("value").alias(out))
        return rows.join(both, F.col(key) == F.col("_cache_key"), "left").drop("_cache_key")

    def clear(self, all_entries: bool = False) -> None:
        """Remove what has expired, or everything."""
        for hour, path in self._hours().items():
            if all_entries or (hour + 1) * 3600 <= self.clock() - self.seconds:
                remove(self.spark, path)
