"""Sinks: JSON lines, tables with upsert, fan-out with isolated failures, registry tables, outbox and dead letters."""

from __future__ import annotations

import urllib.request
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from narrata.functions.text import routing_key
from narrata.operators.cutting import cut, remove
from narrata.operators.jobs import upsert

OUTBOX_KEPT, DEAD_KEPT = 10_000, 1_000


def write_json_lines(df: DataFrame, folder: str, mode: str = "append", compression: str | None = None) -> None:
    """JSON lines, plain or as gzip or bzip2, in a folder of the job."""
    writer = df.write.mode(mode)
    (writer.option("compression", compression) if compression else writer).json(folder)


def upsert_table(spark: SparkSession, folder: str, new: DataFrame, key: str, update: list[str] | None = None) -> DataFrame:
    """Upsert into a Parquet table kept in versions: the next version is written whole before it counts.

    A version counts once its commit marker is there, so a crash leaves the last one as it was; the last two are kept.
    """
    done = _versions(spark, folder)
    old = spark.read.parquet(f"{folder}/v={done[-1]}") if done else new.limit(0)
    ahead = done[-1] + 1 if done else 1
    upsert(old, new, key, update).write.mode("overwrite").parquet(f"{folder}/v={ahead}")
    for gone in done[:-1]:
        remove(spark, f"{folder}/v={gone}")
    return spark.read.parquet(f"{folder}/v={ahead}")


def current_table(spark: SparkSession, folder: str) -> DataFrame | None:
    """The last whole version of an upserted table; none before the first."""
    done = _versions(spark, folder)
    return spark.read.parquet(f"{folder}/v={done[-1]}") if done else None


def _versions(spark: SparkSession, folder: str) -> list[int]:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [s.getPath() for s in system.listStatus(path)] if system.exists(path) else []
    marked = [p for p in found if p.getName().startswith("v=") and system.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted(int(p.getName()[2:]) for p in marked)


def fan_out(df: DataFrame, sinks: dict[str, Callable[[DataFrame], None]]) -> dict[str, str | None]:
    """Write to every sink; one that fails does not stop the others. Name and error (None: written)."""
    held = cut(df)
    result = {}
    for name, write in sinks.items():
        try:
            write(held)
            result[name] = None
        except Exception as e:  # noqa: BLE001 - isolation is the point
            result[name] = f"{type(e).__name__}: {e}"[:500]
    return result


def accepted(result: dict[str, str | None]) -> bool:
    """Written if any sink took it."""
    return any(e is None for e in result.values())


def message(kind: str, source: str, message_id: Column, subject: Column, data: Column, time: Column) -> Column:
    """A CloudEvents 1.0 message; absent fields are left out of its JSON."""
    return F.struct(
        F.lit("1.0").alias("specversion"), F.lit(kind).alias("type"), F.lit(source).alias("source"), message_id.alias("id"), subject.alias("subject"),
        F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("time"), F.lit("application/json").alias("datacontenttype"), data.alias("data"),
    )


def _outbox(rows: DataFrame, kind: str, source: str, data: Column) -> DataFrame:
    """Outbox rows of messages about documents (document_id, job_id, at); the id follows from type, job and document."""
    ident = F.concat(F.lit("evt_"), F.substring(F.md5(F.concat_ws("|", F.lit(kind), "job_id", "document_id")), 1, 12))
    event = message(kind, source, ident, F.concat(F.lit("document/"), F.col("document_id")), data, F.col("at"))
    return rows.select(event.alias("e")).select("e.id", "e.type", "e.subject", routing_key(F.col("e.type")).alias("routing_key"), F.coalesce("e.subject", "e.data.document_id", "e.id").alias("message_key"), F.to_json("e").alias("body"))


def document_processed(docs: DataFrame, source: str = "narrata") -> DataFrame:
    """Outbox rows for processed documents (document_id, job_id, n_events, n_entities, at)."""
    data = F.struct("document_id", "job_id", F.col("n_events").alias("event_count"), F.col("n_entities").alias("entity_count"))
    return _outbox(docs, "document.processed", source, data)


def document_failed(docs: DataFrame, source: str = "narrata") -> DataFrame:
    """Outbox rows for failed documents (document_id, job_id, error_type, error_message, retry_count, at)."""
    return _outbox(docs, "document.failed", source, F.struct("document_id", "job_id", "error_type", "error_message", "retry_count"))


def batch_event(batches: DataFrame, kind: str, source: str = "narrata") -> DataFrame:
    """Outbox rows for batch.started and batch.completed (batch_id, job_id, total, at)."""
    ident = F.concat(F.lit("evt_"), F.substring(F.md5(F.concat_ws("|", F.lit(kind), "job_id", "batch_id")), 1, 12))
    event = message(kind, source, ident, F.concat(F.lit("batch/"), F.col("batch_id")), F.struct("batch_id", "job_id", "total"), F.col("at"))
    return batches.select(event.alias("e")).select("e.id", "e.type", "e.subject", routing_key(F.col("e.type")).alias("routing_key"), F.coalesce("e.subject", "e.id").alias("message_key"), F.to_json("e").alias("body"))


def kept(rows: DataFrame, order: str, most: int = OUTBOX_KEPT) -> DataFrame:
    """The newest rows, as a store with a length limit keeps them: a limit that is the feature."""
    return rows.orderBy(F.desc(order)).limit(most)


def dead_letters(failed: DataFrame, consumer: str) -> DataFrame:
    """Messages that could not be handled (body, error) as the dead-letter table holds them."""
    return failed.select(F.col("body").alias("original_event"), "error", F.current_timestamp().alias("failed_at"), F.lit(consumer).alias("consumer"))


def registry(docs: DataFrame, events: DataFrame, mentions: DataFrame, storylines: DataFrame) -> dict[str, DataFrame]:
    """The metadata registry's tables as projections of the results."""
    jobs = docs.groupBy("job_id").agg(F.count("*").alias("documents"), F.min("at").alias("started_at"), F.max("at").alias("completed_at"))
    return {
        "registry_jobs": jobs,
        "registry_documents": docs.select("document_id", "job_id", F.length("text").cast("long").alias("text_length"), "n_events", "n_entities"),
        "registry_events": events.select("event_id", "document_id", "event_type", F.col("temporal_reference").alias("event_date"), "domain"),
        "registry_entities": mentions.groupBy("document_id", F.coalesce("normalized_form", "text").alias("name"), "type").agg(F.count("*").alias("mention_count"), F.max("confidence").alias("confidence")),
        "registry_storylines": storylines,
    }


def write_registry(tables: dict[str, DataFrame], folder: str, job: str) -> None:
    """A job's rows of each table, written anew."""
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{folder}/{name}/job={job}")


def webhook(url: str, timeout: float = 10.0, post: Callable | None = None) -> Callable[[DataFrame], None]:
    """A sink that posts the column ``body`` of each row; a partition that can't deliver fails, and Spark tries it again."""

    def send(rows) -> None:
        for row in rows:
            if post is not None:
                post(url, row["body"])
            else:
                request = urllib.request.Request(url, row["body"].encode(), {"Content-Type": "application/cloudevents+json"})
                urllib.request.urlopen(request, timeout=timeout).close()

    return lambda df: df.select("body").foreachPartition(send)


def kafka(servers: str, topic: str) -> Callable[[DataFrame], None]:
    """A sink for Kafka, keyed by subject, document or message id."""
    return lambda df: df.selectExpr("message_key AS key", "body AS value").write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def latest(rows: DataFrame, key: str, order: str) -> DataFrame:
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order)))).where("_r = 1").drop("_r")


SINKS: dict[str, Callable] = {"jsonl": write_json_lines, "table": upsert_table, "webhook": webhook, "kafka": kafka}


def available() -> list[str]:
    return sorted(SINKS)
