"""Queries on what services check and look up: input predicates, lookups, finished batches, retention, dependencies, caches."""

from __future__ import annotations

from pyspark.sql import functions as F

from narrata.functions import text as T
from narrata.functions import vectors as V
from narrata.operators import extraction, models, parsing
from narrata.plans.base import Registry, table
from narrata.plans.texts import _TAGGED
from narrata.sources import files, sinks

query = Registry()
QUERIES, ORACLES = query.queries, query.oracles


@query("SELECT doc_id, CASE WHEN trim(text) = '' THEN 'blank' WHEN length(text) > 5000 THEN 'too long' ELSE 'ok' END AS answer FROM documents")
def q_input_predicates(spark, d):
    return table(spark, d, "documents").select("doc_id", T.input_problem(F.col("text"), 5000).alias("answer"))


@query(_TAGGED + "SELECT doc_id, ord, w AS text, type FROM typed WHERE type = 'PER' AND lower(w[1]) = 't'")
def q_mention_lookup(spark, d):
    """Mentions of a type by the first letter of their form."""
    found = extraction.mentions(table(spark, d, "documents").select("doc_id", "text"))
    return found.where((F.col("type") == "PER") & (F.lower(F.substring("text", 1, 1)) == "t")).select("doc_id", F.col("ord").cast("long").alias("ord"), "text", "type")


@query(f"""
SELECT event_id, CASE event_id % 9 WHEN 0 THEN 'nsubj' WHEN 1 THEN 'nsubjpass' WHEN 2 THEN 'dobj' WHEN 3 THEN 'iobj' WHEN 4 THEN 'pobj' WHEN 5 THEN 'agent' WHEN 6 THEN 'attr' END AS relation
FROM events WHERE event_id % 9 < 7 AND user_id % 5 <> 0""")
def q_dependency_filter(spark, d):
    """Relations that are kept; punctuation and white space are not."""
    names = (*extraction.RELATIONS, "punct", "det")
    relation = F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("event_id") % 9 + 1).cast("int"))
    rows = table(spark, d, "events").select("event_id", relation.alias("relation"), F.when(F.col("user_id") % 5 == 0, "PUNCT").otherwise("NOUN").alias("pos"))
    return rows.where(parsing.is_kept(F.col("relation"), F.col("pos"))).select("event_id", "relation")


@query(f"""
SELECT event_id, {extraction.EVENT_TYPES!r}[CAST(event_id % 20 AS INT) + 1] AS event_type, {extraction.ROLES!r}[CAST(event_id % 7 AS INT) + 1] AS role, {extraction.DOMAINS!r}[CAST(event_id % 12 AS INT) + 1] AS domain FROM events""".replace("('", "['").replace("')", "']"))
def q_lookups(spark, d):
    """Event types, roles and domains by number from small broadcast tables."""
    rows = table(spark, d, "events").select("event_id")
    for name, values in (("event_type", extraction.EVENT_TYPES), ("role", extraction.ROLES), ("domain", extraction.DOMAINS)):
        known = spark.createDataFrame(list(enumerate(values)), f"no long, {name} string")
        rows = rows.join(F.broadcast(known), F.col("event_id") % len(values) == F.col("no")).drop("no")
    return rows


@query("""
SELECT DISTINCT source AS batch_id FROM documents WHERE source NOT IN (SELECT source FROM documents d JOIN labels l USING (doc_id) GROUP BY source HAVING min(quality) = 1)""")
def q_open_batches(spark, d):
    """Batches without a finished result: an anti-join with those that are done."""
    docs = table(spark, d, "documents")
    done = docs.join(table(spark, d, "labels"), "doc_id").groupBy("source").agg(F.min("quality").alias("q")).where("q = 1")
    return docs.select("source").distinct().join(done, "source", "left_anti").select(F.col("source").alias("batch_id"))


@query("SELECT event_id, user_id FROM events ORDER BY event_id DESC LIMIT 1000")
def q_dead_letter_retention(spark, d):
    """The newest thousand, as the dead-letter store keeps them."""
    return sinks.kept(table(spark, d, "events").select("event_id", "user_id"), "event_id", sinks.DEAD_KEPT)


@query("""
SELECT event_id, event_type FROM events WHERE 'job_' || user_id % 50 = 'job_7' OR user_id % 50 = 0""")
def q_job_filter(spark, d):
    """Rows of a job, and those that name none."""
    job = F.when(F.col("user_id") % 50 == 0, F.lit("")).otherwise(F.concat(F.lit("job_"), (F.col("user_id") % 50).cast("string")))
    return files.of_job(table(spark, d, "events").withColumn("job_id", job), "job_7").select("event_id", "event_type")


@query("""
SELECT user_id AS doc_id, count(*) AS events, string_agg(event_id, ',' ORDER BY ts DESC, event_id DESC) FILTER (r <= 3) AS latest
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) GROUP BY user_id""")
def q_latest_per_document(spark, d):
    """Counts and the three latest events of each document, from bounded partial lists."""
    from pyspark.sql import Window

    recent = Window.partitionBy("user_id").orderBy(F.desc("ts"), F.desc("event_id"))
    events = table(spark, d, "events")
    top = events.withColumn("r", F.row_number().over(recent)).where("r <= 3").groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct("r", F.col("event_id").cast("string").alias("e"))))["e"].alias("l"))
    return events.groupBy("user_id").agg(F.count("*").alias("events")).join(top, "user_id").select(F.col("user_id").alias("doc_id"), "events", F.array_join("l", ",").alias("latest"))


@query("""
SELECT a.vec_id AS x, b.vec_id AS y, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6)::DOUBLE AS cosine FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""")
def q_cosine(spark, d):
    """Cosine of each vector with the next."""
    rows = table(spark, d, "embeddings").select("vec_id", "embedding").withColumn("n", V.norm(F.col("embedding")))
    pairs = rows.alias("a").join(rows.alias("b"), F.col("b.vec_id") == F.col("a.vec_id") + 1)
    return pairs.select(F.col("a.vec_id").alias("x"), F.col("b.vec_id").alias("y"), F.round(V.cosine(F.col("a.embedding"), F.col("b.embedding"), F.col("a.n"), F.col("b.n")), 6).alias("cosine"))


@query()
def q_embed(spark, d):
    """Hashed word embeddings of unit length, one call per Arrow batch; each different text is embedded once."""
    docs = table(spark, d, "benchmark").select("item_id", "text")
    return models.cached(docs, "text", F.pandas_udf(models.hashed_embedding(), "array<double>"), "embedding").drop("text")


@query("""
SELECT doc_id, md5(text) AS body, 'lang=' || lang || ';source=' || source AS kept FROM documents WHERE lang <> '' AND source <> ''""")
def q_compose(spark, d):
    """Text, and the fields that are passed along."""
    docs = table(spark, d, "documents").where((T.present(F.col("lang")).isNotNull()) & (T.present(F.col("source")).isNotNull()))
    kept = F.create_map(F.lit("lang"), F.col("lang"), F.lit("source"), F.col("source"))
    told = F.array_join(F.transform(F.map_entries(kept), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return docs.select("doc_id", F.md5("text").alias("body"), told.alias("kept"))
