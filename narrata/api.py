"""The library's front door: documents in, linked events, storylines and nested results out; batches that can be resumed."""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Callable
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from narrata.functions import text as T
from narrata.functions.shipping import ship_package
from narrata.operators import extraction, jobs, linking, models, parsing, resolution
from narrata.operators.cutting import children, cut, remove, scope
from narrata.settings import Settings
from narrata.sources import sinks

log = logging.getLogger("narrata")


def prepared(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """document_id, row_id, doc_id, text, context, published, preserved, valid, error; ``docs`` may lack any of the known columns.

    ``row_id`` names a row even where it has no id (then by its content); ``doc_id`` is the id of valid rows and null for others.
    Of rows that repeat an id one is valid, the others are told as repeated.
    """
    have = set(docs.columns)
    get = lambda c, kind="string": F.col(c).cast(kind) if c in have else F.lit(None).cast(kind)
    told = lambda c, kind="string": get(c, kind) if c in settings.documents.context_fields else F.lit(None).cast(kind)
    text = T.truncated(T.first_text(*[get(c) for c in settings.documents.text_fields]), settings.documents.max_text_length)
    context = T.context_string(told("cleaned_title"), told("cleaned_author"), told("cleaned_publication_date"), told("cleaned_excerpt"), told("cleaned_categories", "array<string>"), told("cleaned_tags", "array<string>"))
    ident = T.present(get("document_id"))
    content = F.concat(F.lit("unnamed:"), F.sha2(F.to_json(F.struct(*docs.columns)), 256))
    published = T.normalised_date(F.coalesce(T.present(get("cleaned_publication_date")), T.present(get("temporal_metadata"))))
    preserved = T.preserved({c: F.col(c) for c in settings.documents.preserved_fields if c in have})
    rows = docs.select(ident.alias("document_id"), F.coalesce(ident, content).alias("row_id"), text.alias("text"), context.alias("context"), published.alias("published"), get("job_id").alias("job_id"), preserved.alias("preserved"))
    place = F.row_number().over(Window.partitionBy("row_id").orderBy(F.col("text").isNull(), F.xxhash64("text"), "published"))
    error = F.when(F.col("document_id").isNull(), "no id").when(F.col("place") > 1, "repeated id").when(F.trim(F.coalesce("text", F.lit(""))) == "", "no text")
    rows = rows.withColumn("place", place).withColumn("error", error)
    rows = rows.withColumn("row_id", F.when(F.col("place") > 1, F.concat_ws("#", "row_id", "place")).otherwise(F.col("row_id"))).drop("place")
    return rows.withColumn("valid", F.col("error").isNull()).withColumn("doc_id", F.when(F.col("valid"), F.col("document_id")))


def echo_generator(rows: pd.DataFrame) -> pd.Series:
    """The default generator: each mention in a chunk becomes the agent of a meeting. A model replaces it."""
    out = []
    for text, names in zip(rows["text"], rows["names"], strict=True):
        found = [{"event_type": "contact_meet", "trigger": {"text": n, "start_char": text.find(n), "end_char": text.find(n) + len(n)}, "arguments": [{"role": "agent", "entity": {"text": n}}]} for n in names]
        out.append("```json\n" + json.dumps({"events": found}) + "\n```")
    return pd.Series(out, dtype=object)


def extracted(docs: DataFrame, settings: Settings = Settings(), generator: Callable[[pd.DataFrame], pd.Series] = echo_generator, tagger: extraction.Tagger = extraction.rule_tagger) -> tuple[DataFrame, DataFrame]:
    """Resolved mentions, and events merged over chunks, of prepared documents.

    The generator sees text, names and prompt of each chunk; it is called with the retries and the breaker of ``settings.calls``.
    """
    ship_package(docs.sparkSession)
    valid = docs.where("valid").select("doc_id", "text", "context", "published")
    found = cut(extraction.mentions(valid, "doc_id", "text", settings.extraction.least_confidence, tagger))
    named = cut(resolution.resolved(found).join(found.select("doc_id", "ord", "start_char", "end_char", "context", "entity_id"), ["doc_id", "ord"]))
    chunks = extraction.chunk_rows(valid, "doc_id", "text", settings.extraction.chunk_tokens, settings.extraction.chunk_overlap)
    inside = (F.col("start_char") >= F.col("char_start")) & (F.col("end_char") <= F.col("char_start") + F.length("chunk_text"))
    placed = chunks.join(named.select("doc_id", "start_char", "end_char", F.col("text").alias("name"), F.col("ord").alias("m")), "doc_id", "left")
    per_chunk = placed.groupBy("doc_id", "chunk", "char_start", "chunk_text").agg(F.sort_array(F.collect_list(F.when(inside, F.struct("m", "name"))))["name"].alias("names"))
    asked = per_chunk.join(valid.select("doc_id", F.col("context").alias("known")), "doc_id").withColumn("prompt", extraction.prompt(F.col("chunk_text"), F.lit(None).cast("string"), F.col("known")))
    calls = settings.calls
    safe = models.guarded(generator, calls.attempts, calls.base_seconds, models.Breaker(limit=calls.failures_to_open, open_seconds=calls.open_seconds))

    def generate(texts: pd.Series, names: pd.Series, prompts: pd.Series) -> pd.Series:
        return safe(pd.DataFrame({"text": texts, "names": [list(n) if n is not None else [] for n in names], "prompt": prompts}))

    outputs = asked.select("doc_id", "chunk", "char_start", F.pandas_udf(generate, "string")("chunk_text", "names", "prompt").alias("output"))
    keyed = outputs.withColumn("doc_id", F.struct("doc_id", "chunk", "char_start"))
    events = extraction.parsed_events(keyed.select(F.to_json("doc_id").alias("doc_id"), "output"))
    place = F.from_json("doc_id", "doc_id string, chunk int, char_start long")
    shifted = events.withColumn("p", place).select(
        F.col("p.doc_id").alias("doc_id"), F.col("p.chunk").alias("source_chunk_index"), "idx", "event_type", "trigger", (F.col("start_char") + F.col("p.char_start")).alias("start_char"),
        (F.col("end_char") + F.col("p.char_start")).alias("end_char"), "sentiment", "domain", "confidence", "arguments", (F.col("p.chunk") * 1_000_000 + F.col("idx")).alias("ord"),
    )
    merged = extraction.merged_events(shifted, "doc_id").join(valid.select("doc_id", "published"), "doc_id").withColumn("document_id", F.col("doc_id"))
    names = F.concat_ws("_", "document_id", F.lit("event"), "idx"), F.xxhash64("document_id", "source_chunk_index", "idx")
    return named, cut(merged.withColumn("event_id", names[0]).withColumn("event_uid", names[1]))


def analysed(docs: DataFrame, settings: Settings = Settings(), parser: parsing.Parser = parsing.rule_parser) -> tuple[DataFrame, DataFrame]:
    """Triplets, and the dependency relations of ``settings.extraction.relations``, of prepared documents."""
    sentences = cut(parsing.parsed(docs.where("valid"), "doc_id", "text", parser))
    return parsing.triplets_in(sentences, settings.extraction.least_triplet_confidence), parsing.relations(sentences, settings.extraction.relations)


def linked(events: DataFrame, settings: Settings = Settings(), embedder: Callable[[pd.Series], pd.Series] | None = None, batch_id: str = "batch") -> tuple[DataFrame, DataFrame]:
    """Links between events and their storylines."""
    told = F.filter("arguments", lambda a: a["text"] != "")
    words = extraction.description(F.col("event_type"), F.col("trigger"), told, F.col("domain"), F.col("sentiment"))
    signatures = F.array_distinct(F.transform(told, lambda a: linking.signature(a["text"], a["role"], F.col("domain"))))
    order = F.row_number().over(Window.partitionBy("document_id").orderBy("source_chunk_index", "idx")) + F.pmod(F.xxhash64("document_id"), F.lit(1 << 40)) * (1 << 20)
    ready = models.embedded(events.withColumn("description", words), F.col("description"), model=embedder)
    feed = cut(ready.select(F.col("event_uid").alias("event_id"), order.alias("ord"), "domain", F.try_to_timestamp("published").alias("ts"), "embedding", signatures.alias("signatures"), F.transform(told, lambda a: a["text"]).alias("names")))
    found = cut(linking.links(feed, settings.linking))
    members = linking.storyline_members(feed, found, settings.linking).join(feed.select("event_id", "ord", "domain", "ts"), "event_id")
    entities = feed.select("event_id", "ord", F.posexplode("names").alias("place", "text")).select("event_id", F.struct("ord", "place").alias("ord"), "text")
    return found, linking.profiles(members, entities, prefix=f"{batch_id}_storyline_")


def linked_or_none(events: DataFrame, settings: Settings = Settings(), embedder: Callable[[pd.Series], pd.Series] | None = None, batch_id: str = "batch") -> tuple[DataFrame, DataFrame]:
    """Links and storylines, written; none if ``settings.link_events`` is off or the step fails, so that documents still get their events."""
    if settings.link_events:
        try:
            found, storylines = linked(events, settings, embedder, batch_id)
            return found, cut(storylines)
        except Exception:  # noqa: BLE001 - the documents are worth more than their links
            log.exception("batch %s: events stay unlinked", batch_id)
    found, storylines = linked(events.limit(0), batch_id=batch_id)
    return found, cut(storylines)


def nested(docs: DataFrame, mentions: DataFrame, events: DataFrame, storylines: DataFrame, triplets: DataFrame) -> DataFrame:
    """One row per document with its mentions, triplets and events, storylines assigned: the output contract."""
    of = storylines.select("storyline_id", F.explode("event_ids").alias("event_uid"))
    with_story = events.join(of, "event_uid", "left")
    gathered = lambda rows, *fields: F.sort_array(F.collect_list(F.struct(*fields)))
    per_event = with_story.groupBy("doc_id").agg(gathered(with_story, "source_chunk_index", "idx", "event_id", "event_type", "trigger", "start_char", "end_char", "domain", "sentiment", "storyline_id").alias("events"))
    per_mention = mentions.groupBy("doc_id").agg(gathered(mentions, "ord", "text", "type", "start_char", "end_char", "confidence", "normalized_form", "entity_id").alias("entities"))
    per_triplet = triplets.groupBy("doc_id").agg(gathered(triplets, "sent", "subject", "action", "object", "confidence", "sentence").alias("triplets"))
    rows = docs.join(per_mention, "doc_id", "left").join(per_event, "doc_id", "left").join(per_triplet, "doc_id", "left")
    size = lambda c: F.greatest(F.size(c), F.lit(0))
    counts = F.struct(size("entities").alias("entity_count"), size("events").alias("event_count"), size("triplets").alias("triplet_count"), F.length("text").alias("text_length"))
    return rows.select("document_id", "job_id", "published", "valid", "error", "preserved", "entities", "events", "triplets", counts.alias("processing_metadata"))


def _worked(ready: DataFrame, settings: Settings, plug_ins: dict) -> dict[str, DataFrame]:
    """What documents give by themselves: mentions, events, triplets, relations."""
    mentions, events = extracted(ready, settings, plug_ins.get("generator", echo_generator), plug_ins.get("tagger", extraction.rule_tagger))
    triplets, relations = analysed(ready, settings, plug_ins.get("parser", parsing.rule_parser))
    return {"mentions": mentions, "events": events, "triplets": triplets, "relations": relations}


def run_documents(docs: DataFrame, settings: Settings = Settings(), batch_id: str = "batch", **plug_ins) -> dict[str, DataFrame]:
    """All results of a table of documents: documents (nested), mentions, events, triplets, relations, links, storylines."""
    ready = cut(prepared(docs, settings))
    own = _worked(ready, settings, plug_ins)
    links, storylines = linked_or_none(own["events"], settings, plug_ins.get("embedder"), batch_id)
    return {"documents": nested(ready, own["mentions"], own["events"], storylines, own["triplets"]), **own, "links": links, "storylines": storylines}


#: What is stored part by part, and what is made of all parts at the end.
PARTS, WHOLES = ("prepared", "mentions", "events", "triplets", "relations"), ("documents", "links", "storylines", "outbox")


def _folder(folder: str, name: str, job_id: str) -> str:
    return f"{folder}/{name}/job={quote(job_id, safe='')}"


def stored(spark: SparkSession, folder: str, name: str, job_id: str) -> DataFrame:
    """A table of a job's committed parts."""
    done = jobs.Batch(spark, f"{folder}/log", job_id).parts()
    return spark.read.parquet(*[f"{_folder(folder, name, job_id)}/run={run}" for run in done])


def run_batch(spark: SparkSession, docs: DataFrame, folder: str, job_id: str, settings: Settings = Settings(), chunk_documents: int | None = None, **plug_ins) -> dict:
    """Process what the batch has not done yet and write results; the same batch twice changes nothing.

    Each part of the documents is written under a name of its own and counts from one append to the log on, which notes its
    documents too; what a crash leaves uncommitted is removed by the next run. Events are linked over all committed parts at the
    end of a run, so parts and resumed runs give what one run gives. Between parts a paused or stopped batch ends early.
    """
    batch = jobs.Batch(spark, f"{folder}/log", job_id)
    batch.start()
    total = docs.count()
    if not 0 < total <= settings.documents.max_batch:
        batch.fail()
        raise ValueError(f"a batch has 1 to {settings.documents.max_batch} documents, not {total}")
    done = {f"run={run}" for run in batch.parts()}
    for name in PARTS:
        for run in children(spark, _folder(folder, name, job_id)) - done:
            remove(spark, f"{_folder(folder, name, job_id)}/{run}")
    left = cut(batch.remaining(prepared(docs, settings).withColumn("_id", F.col("document_id")).withColumn("document_id", F.col("row_id"))).withColumn("document_id", F.col("_id")).drop("_id"))
    n = left.count()
    parts = max(1, -(-n // chunk_documents)) if chunk_documents else 1
    split = left.withColumn("_part", F.pmod(F.xxhash64("row_id"), F.lit(parts)))
    early = False
    for part in range(parts if n else 0):
        early = batch.state() in (jobs.PAUSED, jobs.STOPPED)
        if early:
            log.info("batch %s ended early: %s", batch.batch_id, batch.state())
            break
        run, ready = uuid.uuid4().hex, split.where(F.col("_part") == part).drop("_part")
        with scope(spark):
            for name, frame in {"prepared": ready, **_worked(ready, settings, plug_ins)}.items():
                frame.write.mode("overwrite").parquet(f"{_folder(folder, name, job_id)}/run={run}")
        status = F.when(F.col("valid"), "processed").otherwise("failed")
        batch.commit(run, ready.select(F.col("row_id").alias("document_id"), status.alias("status")))
    if batch.parts():
        with scope(spark):
            finish(spark, folder, job_id, settings, **plug_ins)
    if not early:
        batch.complete()
    return batch.progress(total)


def finish(spark: SparkSession, folder: str, job_id: str, settings: Settings = Settings(), **plug_ins) -> None:
    """Link all committed events of a job and write documents, links, storylines, registry tables and outbox; may be repeated."""
    batch = jobs.Batch(spark, f"{folder}/log", job_id)
    ready, mentions, events, triplets = (stored(spark, folder, name, job_id) for name in ("prepared", "mentions", "events", "triplets"))
    links, storylines = linked_or_none(events, settings, plug_ins.get("embedder"), batch.batch_id)
    documents = cut(nested(ready, mentions, events, storylines, triplets).withColumn("job_id", F.coalesce("job_id", F.lit(job_id))))
    told = documents.where("document_id IS NOT NULL").select(
        "document_id", "job_id", "valid", "error", F.col("processing_metadata.event_count").cast("long").alias("n_events"), F.col("processing_metadata.entity_count").cast("long").alias("n_entities"), F.current_timestamp().alias("at")
    )
    failed = told.where("NOT valid").select("document_id", "job_id", F.lit("validation").alias("error_type"), F.col("error").alias("error_message"), F.lit(0).alias("retry_count"), "at")
    over = told.groupBy("job_id").agg(F.count("*").alias("total"), F.max("at").alias("at")).withColumn("batch_id", F.lit(batch.batch_id))
    outbox = sinks.document_processed(told.where("valid")).unionByName(sinks.document_failed(failed)).unionByName(sinks.batch_event(over, "batch.completed"))
    for name, frame in zip(WHOLES, (documents, links, storylines, outbox), strict=True):
        frame.write.mode("overwrite").parquet(_folder(folder, name, job_id))
    texts = ready.where("valid").select("document_id", "text")
    dated = events.withColumn("temporal_reference", F.col("published"))
    tables = sinks.registry(told.where("valid").join(texts, "document_id"), dated, mentions.withColumn("document_id", F.col("doc_id")), storylines)
    sinks.write_registry(tables, f"{folder}/registry", quote(job_id, safe=""))


def job_status(spark: SparkSession, folder: str, job_id: str, total: int) -> dict | None:
    """processed, failed, remaining, percent and state; none for a job that never started."""
    told = jobs.Batch(spark, f"{folder}/log", job_id).progress(total)
    return told if told["state"] is not None else None


def health(checks: dict[str, Callable[[], bool]]) -> dict:
    """degraded if any check fails or raises; each names itself."""
    told = {}
    for name, check in checks.items():
        try:
            told[name] = "ok" if check() else "unavailable"
        except Exception as e:  # noqa: BLE001 - a failing check is the answer
            told[name] = f"error: {e}"
    return {"status": "healthy" if all(v == "ok" for v in told.values()) else "degraded", "services": told}
