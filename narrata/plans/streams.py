"""Queries that run the feed as a stream of messages: written as files, read with ``availableNow``, read back as a table."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from narrata.operators.cutting import cut
from narrata.plans.base import Registry, table
from narrata.sources import files
from narrata.streaming import consumer

query = Registry()
QUERIES, ORACLES = query.queries, query.oracles


def _folder(spark) -> str:
    cut(spark.range(1))  # makes sure that a shared folder is set
    return f"{spark.sparkContext.getCheckpointDir()}/stream-{uuid.uuid4().hex}"


def _messages(spark, d, folder: str) -> None:
    """One message per event: every second repeats an id, every ninth lacks a type, every eleventh isn't JSON."""
    data = F.to_json(F.struct(F.concat(F.lit("job_"), (F.col("event_id") / 3).cast("long").cast("string")).alias("job_id")))
    kind = F.when(F.col("event_id") % 9 != 0, F.concat(F.lit("com.x."), "event_type"))
    body = F.struct(kind.alias("type"), F.concat(F.lit("evt_"), (F.col("event_id") / 2).cast("long").cast("string")).alias("id"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("time"), data.alias("data"))
    line = F.when(F.col("event_id") % 11 == 0, F.concat(F.lit("broken "), F.col("event_id").cast("string"))).otherwise(F.to_json(body))
    table(spark, d, "events").select(line.alias("value")).write.text(folder)


def _table_of(stream, folder: str):
    stream.writeStream.format("parquet").option("checkpointLocation", f"{folder}/state").option("path", f"{folder}/out").trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.parquet(f"{folder}/out")


_VALID = "SELECT event_id, 'evt_' || event_id // 2 AS id, 'job_' || event_id // 3 AS job, event_type FROM events WHERE event_id % 9 <> 0 AND event_id % 11 <> 0"


@query(f"SELECT DISTINCT id FROM ({_VALID})")
def q_stream_dedup(spark, d):
    folder = _folder(spark)
    _messages(spark, d, f"{folder}/in")
    rows = consumer.parsed(consumer.body_stream(spark, f"{folder}/in", 1000)).where("error IS NULL")
    return _table_of(consumer.once_per_source(rows).select("id"), folder)


@query(f"SELECT DISTINCT job AS dedup_key FROM ({_VALID})")
def q_stream_cross_source(spark, d):
    folder = _folder(spark)
    _messages(spark, d, f"{folder}/a")
    _messages(spark, d, f"{folder}/b")
    both = consumer.merged(consumer.body_stream(spark, f"{folder}/a", 1000), consumer.body_stream(spark, f"{folder}/b", 1000))
    rows = consumer.parsed(both).where("error IS NULL")
    return _table_of(consumer.once_across_sources(rows).select("dedup_key"), folder)


@query(f"""
SELECT kind, count(*) AS n FROM (
  SELECT 'processed' AS kind FROM (SELECT DISTINCT id FROM ({_VALID}) WHERE CAST(substring(id, 5) AS BIGINT) % 5 <> 0)
  UNION ALL SELECT 'dead: no type' FROM events WHERE event_id % 9 = 0 OR event_id % 11 = 0
  UNION ALL SELECT 'dead: refused' FROM (SELECT DISTINCT id FROM ({_VALID}) WHERE CAST(substring(id, 5) AS BIGINT) % 5 = 0)) GROUP BY kind""")
def q_stream_dlq(spark, d):
    """Handled, refused and unreadable messages; refused ones are tried again before they become dead letters."""
    folder = _folder(spark)
    _messages(spark, d, f"{folder}/in")

    def handle(rows):
        return rows.select("id", F.when(F.substring("id", 5, 20).cast("long") % 5 == 0, F.lit("refused")).alias("error"))

    bodies = consumer.body_stream(spark, f"{folder}/in", 1000)
    consumer.consume(bodies, handle, f"{folder}/processed", f"{folder}/dead", f"{folder}/state", retries=1).awaitTermination()
    done = spark.read.parquet(f"{folder}/processed").select(F.lit("processed").alias("kind"))
    dead = spark.read.parquet(f"{folder}/dead").select(F.concat(F.lit("dead: "), "error").alias("kind"))
    return done.unionByName(dead).groupBy("kind").agg(F.count("*").alias("n"))


@query("""
WITH lines AS (SELECT event_id, event_type AS job, user_id % 7 AS f, event_id % 97 = 5 AS bad FROM events),
first AS (SELECT f, min(event_id) FILTER (bad) AS first FROM lines GROUP BY f)
SELECT event_id, job FROM lines JOIN first USING (f) WHERE first IS NULL OR event_id < first""")
def q_lenient_files(spark, d):
    """Rows of each file before its first bad line: the feed as seven files in order of their events, every 97th line broken."""
    folder = _folder(spark)
    good = F.to_json(F.struct("event_id", F.col("event_type").alias("job")))
    lines = table(spark, d, "events").select((F.col("user_id") % 7).alias("f"), "event_id", F.when(F.col("event_id") % 97 == 5, F.concat(F.lit("broken "), "event_id")).otherwise(good).alias("value"))
    lines.repartitionByRange(7, "f").sortWithinPartitions("f", "event_id").select("f", "value").write.partitionBy("f").text(folder)
    return files.until_first_bad(spark, folder, "event_id long, job string")
