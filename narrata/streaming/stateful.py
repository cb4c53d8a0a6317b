"""Keyed state over streams: a job's documents until its batch can run, and failed messages until their next try is due.

State is small, a few numbers a job and a body a waiting message; documents go straight to a landing table. Every effect of a
micro-batch is written under the micro-batch's number, so one that is repeated after a crash replaces what it wrote before.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from narrata.functions.shipping import ship_package
from narrata.operators.cutting import children, cut, scope
from narrata.streaming import consumer

#: Hours a job's state is kept, and seconds that a completed job waits for documents that are still on their way.
JOB_HOURS, PATIENCE = 24, 600
LANDED = "job_id string, id string, data string, n long, status string"
WAITING = "id string, body string, attempt int, due double"


def _job(patience: float, keep: float):
    """Counts a job's documents and says once that it is ready: when it is completed and all it tells of have come, or
    ``patience`` seconds later; a job that never completes is told as expired after ``keep`` seconds."""

    def step(key: tuple, groups: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen, wanted, since, done = state.get if state.exists else (0, None, None, False)
        told = []
        if state.hasTimedOut:
            if done or since is None:
                if not done:
                    yield pd.DataFrame({"job_id": [key[0]], "id": [None], "data": [None], "n": [seen], "status": ["expired"]})
                state.remove()
                return
        for rows in groups:
            documents = rows[rows["kind"] == "document"]
            seen += len(documents)
            if len(documents) and not done:
                yield pd.DataFrame({"job_id": key[0], "id": documents["id"], "data": documents["data"], "n": 1, "status": "document"})
            for data in rows.loc[rows["kind"] != "document", "data"]:
                try:
                    count = json.loads(data or "{}").get("documents_processed")
                except ValueError:
                    count = None
                since, wanted = since or time.time(), int(count) if count is not None else wanted
        if since is not None and not done and (seen >= (wanted or 0) or state.hasTimedOut or time.time() >= since + patience):
            told, done = [seen], True
        state.update((seen, wanted, since, done))
        left = keep if done or since is None else max(1.0, since + patience - time.time())
        state.setTimeoutDuration(int(1000 * left))
        if told:
            yield pd.DataFrame({"job_id": [key[0]], "id": [None], "data": [None], "n": told, "status": ["ready"]})

    return step


def job_batches(
    messages: DataFrame, run: Callable[[str, DataFrame], None], landing: str, checkpoint: str, patience: float = PATIENCE, keep: float = JOB_HOURS * 3600, every: str | None = None
):
    """Run ``run(job_id, documents)`` once for each job of the stream, when its job.completed and its documents have come.

    ``messages``: parsed and free of duplicates (see ``consumer``): id, type, data. Documents (with data.job_id) are kept in the
    table ``landing``, by micro-batch. ``run`` gets id and data of all of the job's; it is called again if the driver
    dies before the micro-batch is committed, so it has to be idempotent, as ``api.run_batch`` is for one job id. A job without
    documents runs nothing. Returns the started query: until stopped if ``every`` is a trigger interval, else over what is there.
    """
    spark = messages.sparkSession
    ship_package(spark)
    job = F.coalesce(F.get_json_object("data", "$.job_id"), F.get_json_object("data", "$.source_job_id"))
    keyed = messages.select("id", job.alias("job_id"), F.when(consumer.route(F.col("type"), F.col("data")) == "document", "document").when(F.col("type").endswith("job.completed"), "completed").alias("kind"), "data")
    keyed = keyed.where("kind IS NOT NULL AND job_id IS NOT NULL")
    state = "seen long, wanted long, since double, done boolean"
    told = keyed.groupBy("job_id").applyInPandasWithState(_job(patience, keep), LANDED, state, "append", GroupStateTimeout.ProcessingTimeTimeout)

    def batch(rows: DataFrame, number: int) -> None:
        with scope(spark):
            handled(rows, number)

    def handled(rows: DataFrame, number: int) -> None:
        held = cut(rows)
        if held.isEmpty():
            return
        held.where("status = 'document'").select("job_id", "id", "data").write.mode("overwrite").parquet(f"{landing}/batch={number}")
        for row in held.where("status = 'ready' AND n > 0").select("job_id").distinct().collect():
            run(row["job_id"], landed(spark, landing).where(F.col("job_id") == row["job_id"]).select("id", "data"))

    writer = told.writeStream.foreachBatch(batch).outputMode("append").option("checkpointLocation", checkpoint)
    if every:
        return writer.trigger(processingTime=every).start()
    # micro-batches without data, which timeouts ask for again and again, would keep such a run from ending
    name = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        return writer.trigger(availableNow=True).start()
    finally:
        spark.conf.set(name, before)


def landed(spark: SparkSession, landing: str) -> DataFrame:
    """job_id, id, data of all documents that have come, each id once."""
    names = [f"{landing}/{name}" for name in sorted(children(spark, landing)) if name.startswith("batch=")]
    kind = "job_id string, id string, data string"
    rows = spark.read.schema(kind).parquet(*names) if names else spark.createDataFrame([], kind)
    return rows.groupBy("job_id", "id").agg(F.min("data").alias("data"))


def _wait(key: tuple, groups: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Lets messages pass whose time has come and holds the others until then."""
    if state.hasTimedOut:
        body, attempt = state.get
        state.remove()
        yield pd.DataFrame({"id": [key[0]], "body": [body], "attempt": [attempt]})
        return
    for rows in groups:
        for body, attempt, due in zip(rows["body"], rows["attempt"], rows["due"], strict=True):
            left = due - time.time()
            if left <= 0:
                yield pd.DataFrame({"id": [key[0]], "body": [body], "attempt": [int(attempt)]})
            else:
                state.update((body, int(attempt)))
                state.setTimeoutDuration(max(1, int(1000 * left)))


def consume_with_back_off(
    bodies: DataFrame, handle: Callable[[DataFrame], DataFrame], folder: str, consumer_name: str = "narrata", retries: int = consumer.RETRIES, base: float = 2.0, most: float = 300.0, every: str = "1 second"
):
    """Run ``handle`` on the messages of each micro-batch; it returns id, error (null: done) for each.

    A message that fails is tried again in a later micro-batch, after ``base`` · 2^tries seconds, while others pass; after
    ``retries`` of that it becomes a dead letter, as do messages that can't be parsed. Failed messages are written to a folder
    that the same stream reads, and keyed state holds each until it is due. ``folder`` gets state, retry, done and dead.
    Returns the started query, which runs until it is stopped.
    """
    spark = bodies.sparkSession
    ship_package(spark)
    retry = f"{folder}/retry"
    spark.createDataFrame([], WAITING).write.mode("append").json(retry)  # there from the start, as a source has to be
    read = consumer.parsed(bodies).select(F.when(F.col("error").isNull(), F.col("id")).otherwise(F.concat(F.lit("unread:"), F.sha2("body", 256))).alias("id"), "body", F.lit(0).alias("attempt"), F.lit(0.0).alias("due"))
    again = spark.readStream.schema(WAITING).json(f"{retry}/batch=*")
    told = read.unionByName(again.select("id", "body", "attempt", "due")).groupBy("id").applyInPandasWithState(_wait, "id string, body string, attempt int", "body string, attempt int", "append", GroupStateTimeout.ProcessingTimeTimeout)

    def batch(rows: DataFrame, number: int) -> None:
        with scope(spark):
            handled(rows, number)

    def handled(rows: DataFrame, number: int) -> None:
        held = cut(consumer.parsed(rows.withColumnRenamed("id", "key")))
        if held.isEmpty():  # most micro-batches only look for messages that are due
            return
        others = [f"{folder}/done/{n}" for n in children(spark, f"{folder}/done") - {f"batch={number}"}]
        done = spark.read.schema("id string").parquet(*others) if others else spark.createDataFrame([], "id string")
        wanted = held.where("error IS NULL").drop("error").dropDuplicates(["id"]).join(done, "id", "left_anti")
        outcome = cut(wanted.select("id", "body", "attempt").join(handle(wanted).withColumnRenamed("error", "problem"), "id"))
        outcome.where("problem IS NULL").select("id").write.mode("overwrite").parquet(f"{folder}/done/batch={number}")
        tried = F.col("attempt") + 1
        due = F.unix_micros(F.current_timestamp()) / 1e6 + F.least(F.lit(most), F.lit(base) * F.pow(F.lit(2.0), F.col("attempt")))
        failed = outcome.where("problem IS NOT NULL")
        failed.where(F.col("attempt") < retries).select("id", "body", tried.alias("attempt"), due.alias("due")).write.mode("overwrite").json(f"{retry}/batch={number}")
        lost = failed.where(F.col("attempt") >= retries).select("body", F.col("problem").alias("error")).unionByName(held.where("error IS NOT NULL").select("body", "error"))
        lost.select(F.col("body").alias("original_event"), "error", F.current_timestamp().alias("failed_at"), F.lit(consumer_name).alias("consumer")).write.mode("overwrite").parquet(f"{folder}/dead/batch={number}")

    return told.writeStream.foreachBatch(batch).outputMode("append").option("checkpointLocation", f"{folder}/state").trigger(processingTime=every).start()
