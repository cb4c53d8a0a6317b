"""Reports over batches, mentions, events and calls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from narrata.operators import ranges
from narrata.operators.cutting import cut


def share(part: Column, whole: Column, empty: float = 0.0) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(empty))


def progress(log: DataFrame, total: Column) -> DataFrame:
    """processed, failed, remaining and percent of a batch from its append-only log (document_id, status)."""
    ids = log.groupBy("document_id").agg(F.max(F.when(F.col("status") == "processed", 1).otherwise(0)).alias("ok"))
    counts = ids.agg(F.coalesce(F.sum("ok"), F.lit(0)).alias("processed"), F.coalesce(F.sum(1 - F.col("ok")), F.lit(0)).alias("failed"))
    done = F.col("processed") + F.col("failed")
    return counts.select("processed", "failed", (total - done).alias("remaining"), F.round(100.0 * done / total, 2).alias("percent"))


def intervals(events: DataFrame, key: str, ts: str = "ts", order: str = "event_id") -> DataFrame:
    """Gaps between consecutive times of a key in seconds: count, least, most, mean, upper median, simultaneous and long ones."""
    placed = ranges.before(events.select(key, F.unix_micros(F.col(ts).cast("timestamp")).alias("_at"), F.col(order).alias("_order")), key, "_at", "_at", "_order")
    gaps = cut(placed.select(key, ((F.col("_at") - F.col("_before")) / F.lit(1_000_000.0)).alias("gap")).where("gap IS NOT NULL"))
    counted = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    told = gaps.groupBy(key).agg(
        F.count("*").alias("n_gaps"), F.min("gap").alias("least"), F.max("gap").alias("most"), F.avg("gap").alias("mean"), counted(F.col("gap") < 1).alias("simultaneous"),
        counted(F.col("gap") < 10).alias("short"), counted((F.col("gap") >= 10) & (F.col("gap") < 40)).alias("medium"), counted(F.col("gap") >= 40).alias("long"),
    )
    median = ranges.nth(gaps, key, "gap", F.floor(F.col("n") / 2) + 1).select(F.col(key).alias("_k"), F.col("gap").alias("upper_median"))
    return told.join(median, F.col(key).eqNullSafe(F.col("_k"))).drop("_k").select(key, "n_gaps", "least", "most", "mean", "upper_median", "simultaneous", "short", "medium", "long")


def mention_quality(mentions: DataFrame) -> DataFrame:
    """One row: totals, different texts and forms, deduplication and normalisation rates. A null form is a form of its own."""
    form = F.coalesce(F.col("normalized_form"), F.col("text"))
    null_form = F.max(F.when(F.col("normalized_form").isNull(), 1).otherwise(0))
    totals = mentions.agg(
        F.count("*").alias("total"), F.count_distinct("text").alias("texts"), (F.count_distinct("normalized_form") + null_form).alias("forms"),
        F.sum(F.when(F.col("normalized_form").isNotNull() & (F.col("normalized_form") != F.col("text")), 1).otherwise(0)).cast("long").alias("normalised"),
        F.count_distinct(form).alias("groups"),
    )
    return totals.withColumn("dedup_rate", F.round(100 * (1 - share(F.col("groups"), F.col("total"), 1.0)), 4)).withColumn("normalised_rate", F.round(100 * share(F.col("normalised"), F.col("total")), 4))


def call_rates(calls: DataFrame, key: str) -> DataFrame:
    """Per key: calls, successes, success rate (1 without calls), mean latency. ``calls``: key, ok, latency."""
    return calls.groupBy(key).agg(F.count("*").alias("calls"), F.sum(F.col("ok").cast("long")).alias("successes"), share(F.sum(F.col("ok").cast("long")), F.count("*"), 1.0).alias("success_rate"), F.avg("latency").alias("mean_latency"))
