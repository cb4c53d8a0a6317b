"""Batches that can be resumed: append-only progress, what is left to do, idempotent results, and job states."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from narrata.operators import metrics

#: States of a batch and of a job.
RUNNING, PAUSED, STOPPED, COMPLETED, FAILED = "RUNNING", "PAUSED", "STOPPED", "COMPLETED", "FAILED"
JOB_STATES = {"RETRY": "STARTED", "REVOKED": "FAILURE"}
LOG = "job_id string, batch_id string, kind string, document_id string, status string, at timestamp"


def remaining(docs: DataFrame, done: DataFrame, key: str = "document_id") -> DataFrame:
    """Documents neither processed nor failed; those without id are always left."""
    return docs.join(done.select(key).distinct(), key, "left_anti")


def upsert(old: DataFrame, new: DataFrame, key: str, update: list[str] | None = None) -> DataFrame:
    """``old`` with the rows of ``new``: whole rows, or of known keys only the columns to ``update``; the last of equal keys wins.

    Both have a column ``seq``; both sides are shuffled once, by key.
    """
    names = [c for c in old.columns if c not in (key, "seq")]
    sides = old.withColumn("_new", F.lit(False)).unionByName(new.withColumn("_new", F.lit(True)))
    if update is None:
        last = Window.partitionBy(key).orderBy(F.desc("_new"), F.desc("seq"))
        return sides.withColumn("_r", F.row_number().over(last)).where("_r = 1").drop("_r", "_new")
    pick = lambda c: F.max_by(F.struct(c), F.struct(F.col("_new") if c in update else ~F.col("_new"), F.col("seq")))[c].alias(c)
    return sides.groupBy(key).agg(*[pick(c) for c in names], F.max("seq").alias("seq")).select(*old.columns)


def session_dedup(batch: DataFrame, written: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key that the sink does not have."""
    first = Window.partitionBy(key).orderBy(order)
    return batch.withColumn("_r", F.row_number().over(first)).where("_r = 1").drop("_r").join(written.select(key).distinct(), key, "left_anti")


def job_state(state: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in JOB_STATES.items() for x in pair])
    return F.coalesce(F.try_element_at(names, state), state)


def pressure(gpu: Column, system: Column) -> Column:
    """Memory pressure from two percentages."""
    return F.when((gpu >= 95) | (system >= 90), "critical").when((gpu >= 85) | (system >= 80), "high").when((gpu >= 70) | (system >= 65), "moderate").otherwise("normal")


class Batch:
    """One batch's progress as an append-only Parquet log; every question to it is an aggregate, so no update is ever lost."""

    def __init__(self, spark: SparkSession, folder: str, job_id: str, batch_id: str | None = None):
        self.spark, self.folder, self.job_id, self.batch_id = spark, folder, job_id, batch_id or f"batch_{job_id[:12]}"

    def _append(self, rows: DataFrame) -> None:
        rows.select(*[F.col(f.split()[0]).cast(f.split()[1]) for f in LOG.split(", ")]).write.mode("append").parquet(self.folder)

    def _event(self, kind: str, status: str) -> None:
        one = self.spark.range(1).select(F.lit(self.job_id).alias("job_id"), F.lit(self.batch_id).alias("batch_id"), F.lit(kind).alias("kind"), F.lit(None).alias("document_id"), F.lit(status).alias("status"), F.current_timestamp().alias("at"))
        self._append(one)

    def log(self) -> DataFrame:
        """What the job has noted; nothing before it starts."""
        try:
            rows = self.spark.read.schema(LOG).parquet(self.folder)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            rows = self.spark.createDataFrame([], LOG)
        return rows.where(F.col("job_id") == self.job_id)

    def start(self) -> None:
        self._event("state", RUNNING)

    def pause(self) -> None:
        self._event("state", PAUSED)

    def resume(self) -> None:
        self._event("state", RUNNING)

    def stop(self) -> None:
        self._event("state", STOPPED)

    def complete(self) -> None:
        self._event("state", COMPLETED)

    def fail(self) -> None:
        self._event("state", FAILED)

    def record(self, documents: DataFrame, status: str) -> None:
        """Note documents (document_id) as processed or failed."""
        self._append(documents.select(F.lit(self.job_id).alias("job_id"), F.lit(self.batch_id).alias("batch_id"), F.lit("document").alias("kind"), F.col("document_id"), F.lit(status).alias("status"), F.current_timestamp().alias("at")))

    def commit(self, run: str, documents: DataFrame) -> None:
        """Make a written part count, and note its documents (document_id, status): one file, so both or neither."""
        marker = self.spark.createDataFrame([(run, "written")], "document_id string, status string").withColumn("kind", F.lit("part"))
        rows = documents.select("document_id", "status", F.lit("document").alias("kind")).unionByName(marker)
        self._append(rows.withColumns({"job_id": F.lit(self.job_id), "batch_id": F.lit(self.batch_id), "at": F.current_timestamp()}).coalesce(1))

    def parts(self) -> list[str]:
        """Names of the parts that count."""
        return sorted(r["document_id"] for r in self.log().where("kind = 'part'").select("document_id").distinct().collect())

    def state(self) -> str | None:
        last = self.log().where("kind = 'state'").agg(F.max_by("status", "at").alias("s")).first()
        return last["s"]

    def progress(self, total: int) -> dict:
        row = metrics.progress(self.log().where("kind = 'document'"), F.lit(total)).first()
        return row.asDict() | {"state": self.state()}

    def remaining(self, docs: DataFrame) -> DataFrame:
        return remaining(docs, self.log().where("kind = 'document'"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
