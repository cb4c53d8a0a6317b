"""Queries on batches: what is left, progress, upserts, quality, intervals, states, outbox and registry."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from narrata.functions import text as T
from narrata.operators import extraction, jobs, metrics, resolution
from narrata.plans.base import Registry, table
from narrata.plans.texts import _TAGGED
from narrata.sources import files, sinks
from narrata.streaming import consumer

query = Registry()
QUERIES, ORACLES = query.queries, query.oracles


@query("SELECT doc_id, lang, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def q_remaining(spark, d):
    return jobs.remaining(table(spark, d, "documents").select("doc_id", "lang", "source"), table(spark, d, "labels"), "doc_id")


@query("""
WITH ids AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS ok FROM labels GROUP BY doc_id), n AS (SELECT count(*) AS total FROM documents)
SELECT CAST(sum(ok) AS BIGINT) AS processed, CAST(sum(1 - ok) AS BIGINT) AS failed, CAST(max(total) - count(*) AS BIGINT) AS remaining, round(100.0 * count(*) / max(total), 2)::DOUBLE AS percent FROM ids, n""")
def q_progress(spark, d):
    log = table(spark, d, "labels").select(F.col("doc_id").alias("document_id"), F.when(F.col("quality") == 1, "processed").otherwise("failed").alias("status"))
    total = table(spark, d, "documents").count()
    return metrics.progress(log, F.lit(total)).withColumn("percent", F.col("percent").cast("double"))


@query("""
SELECT d.source, count(*) AS documents, count(l.doc_id) FILTER (l.quality = 1) AS processed, count(l.doc_id) FILTER (l.quality = 0) AS failed, CAST(sum(d.n_chars) AS BIGINT) AS chars,
       round(avg(d.n_chars), 6)::DOUBLE AS mean_chars FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY d.source""")
def q_batch_stats(spark, d):
    rows = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    of = lambda v: F.count(F.when(F.col("quality") == v, 1))
    return rows.groupBy("source").agg(F.count("*").alias("documents"), of(1).alias("processed"), of(0).alias("failed"), F.sum("n_chars").alias("chars"), F.round(F.avg("n_chars"), 6).alias("mean_chars"))


def _versions(spark, d):
    docs = table(spark, d, "documents")
    old = docs.where("doc_id % 3 <> 0").select("doc_id", "lang", "source", F.lit(1).alias("seq"))
    new = docs.where("doc_id % 3 <> 1").select("doc_id", F.lit("xx").alias("lang"), F.concat("source", F.lit("!")).alias("source"), F.lit(2).alias("seq"))
    return old, new


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 1 THEN lang ELSE 'xx' END AS lang, CASE WHEN doc_id % 3 = 1 THEN source ELSE source || '!' END AS source, CASE WHEN doc_id % 3 = 1 THEN 1 ELSE 2 END AS seq FROM documents")
def q_upsert_full(spark, d):
    return jobs.upsert(*_versions(spark, d), "doc_id")


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 1 THEN lang ELSE 'xx' END AS lang, CASE WHEN doc_id % 3 = 0 THEN source || '!' ELSE source END AS source, CASE WHEN doc_id % 3 = 1 THEN 1 ELSE 2 END AS seq FROM documents")
def q_upsert_partial(spark, d):
    return jobs.upsert(*_versions(spark, d), "doc_id", update=["lang"])


@query("""
SELECT key, doc_id FROM (SELECT md5(text) AS key, doc_id, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS r FROM documents WHERE doc_id % 4 <> 0) b
WHERE r = 1 AND NOT EXISTS (SELECT 1 FROM documents w WHERE w.doc_id % 4 = 0 AND md5(w.text) = b.key)""")
def q_session_dedup(spark, d):
    docs = table(spark, d, "documents").select(F.md5("text").alias("key"), "doc_id")
    return jobs.session_dedup(docs.where("doc_id % 4 <> 0"), docs.where("doc_id % 4 = 0"), "key", "doc_id")


@query("""
WITH m AS (SELECT p_name AS text, CASE WHEN p_partkey % 5 > 0 THEN first_value(p_name) OVER (PARTITION BY p_brand, p_type ORDER BY length(p_name) DESC, p_size DESC, p_partkey) END AS f FROM part),
t AS (SELECT count(*) AS total, count(DISTINCT text) AS texts, count(DISTINCT f) + max(CASE WHEN f IS NULL THEN 1 ELSE 0 END) AS forms, count(*) FILTER (f IS NOT NULL AND f <> text) AS normalised, count(DISTINCT coalesce(f, text)) AS groups FROM m)
SELECT *, round(100 * (1 - groups / total), 4)::DOUBLE AS dedup_rate, round(100 * normalised / total, 4)::DOUBLE AS normalised_rate FROM t""")
def q_quality_report(spark, d):
    part = table(spark, d, "part").select(F.col("p_brand").alias("b"), F.col("p_type").alias("t"), F.col("p_partkey").alias("ord"), F.col("p_name").alias("text"), F.col("p_size").alias("confidence"))
    formed = resolution.canonical(part, "b", "t").withColumn("normalized_form", F.when(F.col("ord") % 5 > 0, F.col("normalized_form")))
    return metrics.mention_quality(formed)


@query("""
SELECT type, count(*) AS mentions, count(DISTINCT text) AS texts, count(*) - count(DISTINCT text) AS repeats FROM (""" + _TAGGED + """
SELECT w AS text, type FROM typed WHERE type <> 'MISC') GROUP BY type""")
def q_mention_histogram(spark, d):
    found = extraction.mentions(table(spark, d, "documents").select("doc_id", "text"))
    return found.groupBy("type").agg(F.count("*").alias("mentions"), F.count_distinct("text").alias("texts"), (F.count("*") - F.count_distinct("text")).alias("repeats"))


@query("""
SELECT round(100.0 * count(DISTINCT user_id) FILTER (event_type <> 'error') / count(DISTINCT user_id), 4)::DOUBLE AS coverage, round(100.0 * count(*) FILTER (value > 1) / count(*), 4)::DOUBLE AS triggered,
       round(100.0 * count(*) FILTER (props IS NOT NULL) / count(*), 4)::DOUBLE AS argued,
       round(0.4 * 100.0 * count(DISTINCT user_id) FILTER (event_type <> 'error') / count(DISTINCT user_id) + 0.3 * 100.0 * count(*) FILTER (value > 1) / count(*) + 0.3 * 100.0 * count(*) FILTER (props IS NOT NULL) / count(*), 4)::DOUBLE AS score FROM events""")
def q_event_quality(spark, d):
    pct = lambda part, whole: 100.0 * part / whole
    cover = pct(F.count_distinct(F.when(F.col("event_type") != "error", F.col("user_id"))), F.count_distinct("user_id"))
    triggered, argued = pct(F.count(F.when(F.col("value") > 1, 1)), F.count("*")), pct(F.count("props"), F.count("*"))
    return table(spark, d, "events").agg(cover.alias("c"), triggered.alias("t"), argued.alias("a")).select(
        F.round("c", 4).alias("coverage"), F.round("t", 4).alias("triggered"), F.round("a", 4).alias("argued"), F.round(0.4 * F.col("c") + 0.3 * F.col("t") + 0.3 * F.col("a"), 4).alias("score")
    )


@query("""
WITH g AS (SELECT event_type, (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY event_type ORDER BY ts, event_id))) / 1000000.0 AS gap FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY gap) AS r, count(*) OVER (PARTITION BY event_type) AS n FROM g WHERE gap IS NOT NULL)
SELECT event_type, count(*) AS n_gaps, round(min(gap), 6)::DOUBLE AS least, round(max(gap), 6)::DOUBLE AS most, round(avg(gap), 4)::DOUBLE AS mean, round(max(CASE WHEN r = n // 2 + 1 THEN gap END), 6)::DOUBLE AS upper_median,
       count(*) FILTER (gap < 1) AS simultaneous, count(*) FILTER (gap < 10) AS short, count(*) FILTER (gap >= 10 AND gap < 40) AS medium, count(*) FILTER (gap >= 40) AS long FROM r GROUP BY event_type""")
def q_intervals(spark, d):
    found = metrics.intervals(table(spark, d, "events"), "event_type")
    return found.withColumns({"least": F.round("least", 6), "most": F.round("most", 6), "mean": F.round("mean", 4), "upper_median": F.round("upper_median", 6)})


@query("""
WITH h AS (SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS poll, count(*) AS n FROM events GROUP BY 1), c AS (SELECT poll, CAST(sum(n) OVER (ORDER BY poll) AS BIGINT) AS done FROM h)
SELECT poll, done, round((done - lag(done) OVER (ORDER BY poll)) / 1440.0, 6)::DOUBLE AS per_minute FROM c""")
def q_rolling_rate(spark, d):
    """Documents a minute between polls, from a table with a row per poll."""
    polls = table(spark, d, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("poll")).agg(F.count("*").alias("n"))
    order = Window.orderBy("poll")  # one row per day
    done = polls.select("poll", F.sum("n").over(order).alias("done"))
    return done.withColumn("per_minute", F.round((F.col("done") - F.lag("done").over(order)) / 1440.0, 6))


@query("SELECT event_id, user_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at FROM events ORDER BY ts DESC, event_id DESC LIMIT 10")
def q_top_recent(spark, d):
    return files.latest(table(spark, d, "events"), "ts", ("event_id",), 10).select("event_id", "user_id", "event_type", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"))


@query("""
SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'document' WHEN 1 THEN CASE WHEN user_id % 2 = 0 THEN 'empty' ELSE 'batch' END ELSE 'ignored' END AS route FROM events""")
def q_routing(spark, d):
    kind = F.expr("CASE event_id % 4 WHEN 0 THEN 'com.x.document.cleaned' WHEN 1 THEN 'com.x.job.completed' WHEN 2 THEN 'com.x.job.failed' ELSE concat('x.', event_type) END")
    data = F.to_json(F.struct(F.when(F.col("user_id") % 2 == 0, F.lit(0)).otherwise(F.lit(5)).alias("documents_processed")))
    return table(spark, d, "events").select("event_id", consumer.route(kind, data).alias("route"))


@query("""
SELECT event_id, CASE WHEN event_id % 5 = 0 THEN '401' WHEN event_id % 7 = 0 THEN '400' WHEN event_id % 3 = 0 THEN 'duplicate' ELSE 'accepted' END AS answer FROM events""")
def q_delivery(spark, d):
    kind, ident = F.when(F.col("event_id") % 7 != 0, F.col("event_type")), F.col("event_id").cast("string")
    return table(spark, d, "events").select("event_id", consumer.delivery(F.col("event_id") % 5 != 0, kind, ident, F.col("event_id") % 3 == 0).alias("answer"))


@query("SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'STARTED' WHEN 1 THEN 'FAILURE' WHEN 2 THEN 'SUCCESS' ELSE 'PENDING' END AS state FROM events")
def q_job_state(spark, d):
    given = F.expr("CASE event_id % 4 WHEN 0 THEN 'RETRY' WHEN 1 THEN 'REVOKED' WHEN 2 THEN 'SUCCESS' ELSE 'PENDING' END")
    return table(spark, d, "events").select("event_id", jobs.job_state(given).alias("state"))


@query("""
SELECT event_id, CASE WHEN value >= 95 OR user_id % 100 >= 90 THEN 'critical' WHEN value >= 85 OR user_id % 100 >= 80 THEN 'high' WHEN value >= 70 OR user_id % 100 >= 65 THEN 'moderate' ELSE 'normal' END AS pressure FROM events""")
def q_pressure(spark, d):
    return table(spark, d, "events").select("event_id", jobs.pressure(F.col("value"), F.col("user_id") % 100).alias("pressure"))


def _processed(spark, d):
    docs = table(spark, d, "documents")
    return docs.select(F.col("doc_id").cast("string").alias("document_id"), F.concat(F.lit("job_"), "source").alias("job_id"), "text", (F.col("doc_id") % 4).alias("n_events"), (F.col("doc_id") % 9).alias("n_entities"), F.lit("2024-01-01 00:00:00").cast("timestamp").alias("at"))


@query("""
SELECT 'evt_' || substring(md5('document.processed|job_' || source || '|' || doc_id), 1, 12) AS id, 'document.processed' AS type, 'document/' || doc_id AS subject, 'document.processed' AS routing_key,
       'document/' || doc_id AS message_key, CAST(doc_id % 4 AS BIGINT) AS event_count, 'job_' || source AS job_id FROM documents""")
def q_outbox(spark, d):
    rows = sinks.document_processed(_processed(spark, d))
    return rows.select("id", "type", "subject", "routing_key", "message_key", F.get_json_object("body", "$.data.event_count").cast("long").alias("event_count"), F.get_json_object("body", "$.data.job_id").alias("job_id"))


@query("""
SELECT 'evt_' || substring(md5('document.failed|job_' || source || '|' || doc_id), 1, 12) AS id, 'document.failed' AS type, 'document/' || doc_id AS subject, 'document.failed' AS routing_key,
       'document/' || doc_id AS message_key, 'ValidationError' AS error_type, 'text of ' || length(text) AS error_message, CAST(doc_id % 3 AS BIGINT) AS retry_count FROM documents""")
def q_outbox_failed(spark, d):
    docs = _processed(spark, d).withColumns({"error_type": F.lit("ValidationError"), "error_message": F.concat(F.lit("text of "), F.length("text")), "retry_count": F.col("document_id").cast("long") % 3})
    part = lambda name: F.get_json_object("body", f"$.data.{name}")
    rows = sinks.document_failed(docs)
    return rows.select("id", "type", "subject", "routing_key", "message_key", part("error_type").alias("error_type"), part("error_message").alias("error_message"), part("retry_count").cast("long").alias("retry_count"))


@query("SELECT 'job_' || source AS job_id, count(*) AS documents FROM documents GROUP BY source")
def q_registry_jobs(spark, d):
    return _registry(spark, d)["registry_jobs"].select("job_id", "documents")


@query("SELECT CAST(doc_id AS VARCHAR) AS document_id, 'job_' || source AS job_id, length(text) AS text_length, CAST(doc_id % 4 AS BIGINT) AS n_events, CAST(doc_id % 9 AS BIGINT) AS n_entities FROM documents")
def q_registry_documents(spark, d):
    return _registry(spark, d)["registry_documents"]


@query("SELECT user_id || '_event_' || event_id AS event_id, CAST(user_id AS VARCHAR) AS document_id, event_type, strftime(ts, '%Y-%m-%d') AS event_date, event_type AS domain FROM events")
def q_registry_events(spark, d):
    return _registry(spark, d)["registry_events"]


@query("SELECT p_brand AS document_id, CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE p_type END AS name, p_type AS type, count(*) AS mention_count, max(p_size / 100.0)::DOUBLE AS confidence FROM part GROUP BY 1, 2, 3")
def q_registry_entities(spark, d):
    return _registry(spark, d)["registry_entities"]


@query("SELECT 'batch_storyline_' || user_id AS storyline_id, count(*) AS n_events, count(DISTINCT event_type) AS domains FROM events GROUP BY user_id HAVING count(*) >= 2")
def q_registry_storylines(spark, d):
    return _registry(spark, d)["registry_storylines"]


def _registry(spark, d):
    events = table(spark, d, "events")
    told = events.select(F.concat(F.col("user_id").cast("string"), F.lit("_event_"), F.col("event_id").cast("string")).alias("event_id"), F.col("user_id").cast("string").alias("document_id"), "event_type", F.date_format("ts", "yyyy-MM-dd").alias("temporal_reference"), F.col("event_type").alias("domain"))
    found = table(spark, d, "part").select(F.col("p_brand").alias("document_id"), F.when(F.col("p_partkey") % 2 == 0, F.col("p_name")).alias("normalized_form"), F.col("p_type").alias("text"), F.col("p_type").alias("type"), (F.col("p_size") / 100.0).alias("confidence"))
    lines = events.groupBy(F.concat(F.lit("batch_storyline_"), F.col("user_id").cast("string")).alias("storyline_id")).agg(F.count("*").alias("n_events"), F.count_distinct("event_type").alias("domains")).where("n_events >= 2")
    return sinks.registry(_processed(spark, d), told, found, lines)


@query("""
SELECT event_type, count(*) AS calls, count(*) FILTER (value > 10) AS successes, round(count(*) FILTER (value > 10) / count(*), 6)::DOUBLE AS success_rate, round(avg(value), 6)::DOUBLE AS mean_latency FROM events GROUP BY event_type""")
def q_metrics_rates(spark, d):
    calls = table(spark, d, "events").select("event_type", (F.col("value") > 10).alias("ok"), F.col("value").alias("latency"))
    return metrics.call_rates(calls, "event_type").withColumns({"success_rate": F.round("success_rate", 6), "mean_latency": F.round("mean_latency", 6)})


@query("""
SELECT lang, round(avg(n_chars) FILTER (n_chars > 2000), 4)::DOUBLE AS long_mean, round(avg(n_chars) FILTER (n_chars <= 2000), 4)::DOUBLE AS short_mean,
       round(avg(n_chars) FILTER (n_chars > 2000) / avg(n_chars) FILTER (n_chars <= 2000), 4)::DOUBLE AS ratio FROM documents GROUP BY lang""")
def q_comparison_ratio(spark, d):
    mean = lambda c: F.avg(F.when(c, F.col("n_chars")))
    rows = table(spark, d, "documents").groupBy("lang").agg(mean(F.col("n_chars") > 2000).alias("l"), mean(F.col("n_chars") <= 2000).alias("s"))
    return rows.select("lang", F.round("l", 4).alias("long_mean"), F.round("s", 4).alias("short_mean"), F.round(F.try_divide("l", "s"), 4).alias("ratio"))


@query("""
SELECT d.doc_id, len(string_split(text, ' ')) AS token_count, coalesce(n, 0) AS event_count, coalesce(kinds, '') AS event_types FROM documents d
LEFT JOIN (SELECT user_id, count(*) AS n, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS kinds FROM events GROUP BY user_id) e ON e.user_id = d.doc_id""")
def q_output_contract(spark, d):
    """The nested view of a document with its events, read back as counts."""
    events = table(spark, d, "events").groupBy(F.col("user_id").alias("doc_id")).agg(F.collect_list(F.struct("event_id", "event_type")).alias("events"))
    docs = table(spark, d, "documents").join(events, "doc_id", "left").withColumn("events", F.coalesce("events", F.array().cast("array<struct<event_id:bigint,event_type:string>>")))
    nested = docs.select(F.struct("doc_id", F.struct(F.size(T.tokens(F.col("text"))).cast("long").alias("token_count"), F.size("events").cast("long").alias("event_count")).alias("processing"), "events").alias("doc"))
    return nested.select("doc.doc_id", "doc.processing.token_count", "doc.processing.event_count", F.array_join(F.array_sort(F.array_distinct("doc.events.event_type")), ",").alias("event_types"))
