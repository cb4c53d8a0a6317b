"""Order within hot keys: rows are dealt by ranges of key and order, so a key with a third of all rows spans many tasks.

What lies between the ranges is handed over in tables of a row for each key and range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from narrata.operators.cutting import cut


def dealt(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """``rows`` written by ranges of key and order, with the range's number as ``_range``."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut(rows.repartitionByRange(parts, key, *order).withColumn("_range", F.spark_partition_id()))


def before(rows: DataFrame, key: str, value: str, *order: str) -> DataFrame:
    """``rows`` with ``_before``: the value of the row before it of its key (null for the first)."""
    held = dealt(rows, key, *order)
    place = F.struct(*order)
    ends = held.groupBy("_range", F.col(key).alias("_key")).agg(F.max_by(F.struct(value), place)[value].alias("last"))
    handed = cut(ends.withColumn("_handed", F.lag("last").over(Window.partitionBy("_key").orderBy("_range"))).drop("last").withColumnRenamed("_range", "_of"))
    within = Window.partitionBy("_range", key).orderBy(*order)
    numbered = held.withColumn("_first", F.row_number().over(within) == 1).withColumn("_lag", F.lag(value).over(within))
    joined = numbered.join(handed, (F.col("_range") == F.col("_of")) & F.col(key).eqNullSafe(F.col("_key")), "left")
    return joined.withColumn("_before", F.when(F.col("_first"), F.col("_handed")).otherwise(F.col("_lag"))).drop("_range", "_first", "_lag", "_of", "_key", "_handed")


def nth(rows: DataFrame, key: str, value: str, rank: Column) -> DataFrame:
    """``key``, ``value``: each key's value at a place in its order from 1; ``rank`` may use ``n``, the key's number of rows."""
    held = dealt(rows.select(key, value), key, value)
    counts = held.groupBy("_range", F.col(key).alias("_key")).agg(F.count("*").alias("c"))
    whole = counts.groupBy(F.col("_key").alias("_all")).agg(F.sum("c").alias("n")).withColumn("wanted", rank)
    upto = counts.withColumn("upto", F.sum("c").over(Window.partitionBy("_key").orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)))
    spots = upto.join(whole, F.col("_key").eqNullSafe(F.col("_all"))).where((F.col("wanted") <= F.col("upto")) & (F.col("wanted") > F.col("upto") - F.col("c")))
    spots = cut(spots.select(F.col("_range").alias("_of"), "_key", (F.col("wanted") - F.col("upto") + F.col("c")).alias("_place")))
    inside = held.join(spots, (F.col("_range") == F.col("_of")) & F.col(key).eqNullSafe(F.col("_key")))
    placed = inside.withColumn("_row", F.row_number().over(Window.partitionBy("_range", key).orderBy(value)))
    return placed.where("_row = _place").select(key, value)
