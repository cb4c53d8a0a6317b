"""Message consumption with Structured Streaming: parse, filter, deduplicate, route, handle, dead-letter.

Sources are unioned streams of message bodies (files, Kafka, or any Python data source). A message counts as done when its
micro-batch has been handled and its id is in the table of processed ids; replays after a failure are dropped by an anti-join
with what that table got in the last 24 hours, so handling is at least once and effects are once within that time. The table
is parted by day, so a micro-batch reads two days of it however old it is.
"""

from __future__ import annotations

import hashlib
import hmac
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from narrata.operators.cutting import cut, scope

MESSAGE = "specversion string, type string, source string, id string, time timestamp, subject string, datacontenttype string, traceparent string, data string"
DONE = "id string, at timestamp, day date"
IDEMPOTENCY, CROSS_SOURCE, RETRIES = "24 hours", "1 hour", 3
#: Message types that start work.
ROUTES = {"document.cleaned": "document", "job.completed": "batch"}


def body_stream(spark: SparkSession, folder: str, per_trigger: int = 10) -> DataFrame:
    """One message body per line of the files that arrive in a folder."""
    return spark.readStream.option("maxFilesPerTrigger", per_trigger).text(folder).select(F.col("value").alias("body"))


def kafka_stream(spark: SparkSession, servers: str, topic: str, per_trigger: int = 1000) -> DataFrame:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest", "maxOffsetsPerTrigger": str(per_trigger)}
    return spark.readStream.format("kafka").options(**options).load().select(F.col("value").cast("string").alias("body"))


def merged(*streams: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), streams)


def parsed(bodies: DataFrame) -> DataFrame:
    """``bodies`` (with whatever columns) with the message's fields, defaults for absent ones, and ``error`` where type or id is missing."""
    m = bodies.withColumn("m", F.from_json("body", MESSAGE))
    fields = m.select(*bodies.columns, "m.*").withColumn("specversion", F.coalesce("specversion", F.lit("1.0"))).withColumn("datacontenttype", F.coalesce("datacontenttype", F.lit("application/json")))
    problem = F.when(F.coalesce("type", F.lit("")) == "", "no type").when(F.coalesce("id", F.lit("")) == "", "no id")
    return fields.withColumn("error", problem)


def dedup_key() -> Column:
    """What messages of several sources are compared by: the job they tell of, else their id."""
    job = lambda k: F.nullif(F.get_json_object("data", f"$.{k}"), F.lit(""))
    return F.coalesce(job("job_id"), job("source_job_id"), F.col("id"))


def once_per_source(messages: DataFrame) -> DataFrame:
    """Each id once within a day of event time."""
    return messages.withWatermark("time", IDEMPOTENCY).dropDuplicatesWithinWatermark(["id"])


def once_across_sources(messages: DataFrame) -> DataFrame:
    """Each job once within an hour of event time, whichever source tells of it first."""
    return messages.withColumn("dedup_key", dedup_key()).withWatermark("time", CROSS_SOURCE).dropDuplicatesWithinWatermark(["dedup_key"])


def route(kind: Column, data: Column) -> Column:
    """document, batch, empty (a job without documents) or ignored."""
    parts = F.split(kind, r"\.")
    both = F.concat_ws(".", F.try_element_at(parts, F.lit(-2)), F.try_element_at(parts, F.lit(-1)))
    names = F.create_map(*[F.lit(x) for pair in ROUTES.items() for x in pair])
    found = F.coalesce(F.try_element_at(names, both), F.lit("ignored"))
    none = F.coalesce(F.get_json_object(data, "$.documents_processed").cast("long"), F.lit(-1)) == 0
    return F.when((found == "batch") & none, "empty").otherwise(found)


def delivery(signature_ok: Column, kind: Column, ident: Column, seen: Column) -> Column:
    """The answer to a webhook call: 401, 400, duplicate or accepted."""
    missing = (F.coalesce(kind, F.lit("")) == "") | (F.coalesce(ident, F.lit("")) == "")
    return F.when(~signature_ok, "401").when(missing, "400").when(seen, "duplicate").otherwise("accepted")


def signature(secret: bytes, body: bytes) -> str:
    return hmac.new(secret, body, hashlib.sha256).hexdigest()


def signature_ok(secret: bytes, body: bytes, given: str) -> bool:
    return hmac.compare_digest(signature(secret, body), (given or "").removeprefix("sha256="))


def consume(
    bodies: DataFrame, handle: Callable[[DataFrame], DataFrame], processed: str, dead: str, checkpoint: str, consumer: str = "narrata", types: tuple[str, ...] = (), retries: int = RETRIES
):
    """Run ``handle`` on the new messages of each micro-batch; it returns id, error (null: done) for each.

    Messages that fail are tried again, up to ``retries`` times; then, like those that can't be parsed, they become dead
    letters. Returns the started query, which ends when all available input is consumed.
    """
    spark = bodies.sparkSession

    def known() -> DataFrame:
        if not _exists(spark, processed):
            return spark.createDataFrame([], "id string")
        since = F.current_timestamp() - F.expr(f"INTERVAL {IDEMPOTENCY}")
        return spark.read.schema(DONE).parquet(processed).where((F.col("day") >= F.to_date(since)) & (F.col("at") > since)).select("id")

    def batch(rows: DataFrame, _: int) -> None:
        with scope(spark):
            handled(rows)

    def handled(rows: DataFrame) -> None:
        read = parsed(rows)
        wanted = read.where("error IS NULL").where(F.col("type").isin(*types)) if types else read.where("error IS NULL")
        fresh = cut(wanted.dropDuplicates(["id"]).join(known(), "id", "left_anti"))
        todo, failed = fresh, None
        for _attempt in range(retries + 1):
            outcome = cut(handle(todo))
            done = outcome.where("error IS NULL").select("id", F.current_timestamp().alias("at"), F.current_date().alias("day"))
            done.write.mode("append").partitionBy("day").parquet(processed)
            failed = outcome.where("error IS NOT NULL").select("id", F.col("error").alias("problem"))
            if failed.isEmpty():
                failed = None
                break
            todo = cut(todo.join(failed, "id").drop("problem"))
        lost = read.where("error IS NOT NULL").select("body", "error")
        if failed is not None:
            lost = lost.unionByName(fresh.select("id", "body").join(failed, "id").select("body", F.col("problem").alias("error")))
        lost.select(F.col("body").alias("original_event"), "error", F.current_timestamp().alias("failed_at"), F.lit(consumer).alias("consumer")).write.mode("append").parquet(dead)

    return bodies.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
