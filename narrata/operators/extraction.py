"""Rule-based extraction behind the model interface: mentions, dependency tokens, triplets, chunking, prompts, model output.

The neural models of a deployment are plug-ins: anything that fills the same columns can replace a rule. The rules here
are deterministic, so that every query runs offline; they claim no model quality.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from narrata.functions import text as T
from narrata.functions.arrays import Structs
from narrata.functions.shipping import ship_package

#: The rule tagger: pattern, raw type, confidence; tried in this order at each place.
ISO_DATE = r"[0-9]{4}-[0-9]{2}-[0-9]{2}"
MONEY = r"[$][0-9][0-9,.]*"
NAME = r"[A-Z][a-z]+(?: [A-Z][a-z]+)*"
TAGGER = ((ISO_DATE, "DATE", 0.95), (MONEY, "MONEY", 0.90), (NAME, "NAME", 0.80))
COMPANY_WORDS = ("Inc", "Corp", "Group", "Bank", "University", "Ministry")
LEAST_CONFIDENCE = 0.75
#: From a text to (word, raw type, confidence, place) of what it mentions, in order.
Tagger = Callable[[str], Iterator[tuple[str, str, float, int]]]
#: Relations that are kept, and what counts as subject and object.
RELATIONS = ("nsubj", "nsubjpass", "dobj", "iobj", "pobj", "agent", "attr")
SUBJECTS = ("nsubj", "nsubjpass", "agent", "attr")
OBJECTS = ("dobj", "pobj", "iobj", "obj")


def rule_tagger(text: str) -> Iterator[tuple[str, str, float, int]]:
    """word, raw type, confidence and place of each name, date and sum of money. A model replaces it."""
    for m in _ANY.finditer(text):
        word, kind = m[0], m.lastindex
        if kind == 1:
            yield word, "DATE", 0.95, m.start()
        elif kind == 2:
            yield word, "MONEY", 0.9, m.start()
        elif word.rsplit(" ", 1)[-1] in COMPANY_WORDS:
            yield word, "ORGANIZATION", 0.85, m.start()
        elif " " in word:
            yield word, "B-PERSON", 0.8, m.start()
        else:
            yield word, "MISC", 0.7, m.start()


_ANY = re.compile("|".join(f"({p})" for p, _, _ in TAGGER))
_SPACES = re.compile(r"[ \t\n\x0b\f\r]+")
_RAW = Structs((("ord", "int"), ("word", "string"), ("raw_type", "string"), ("score", "double"), ("start_char", "int"), ("end_char", "int")))
_MENTION = Structs((("ord", "int"), ("text", "string"), ("type", "string"), ("start_char", "int"), ("end_char", "int"), ("confidence", "double"), ("context", "string")))


def _raw_udf(tagger: Tagger):
    """Each text's tagged words, in one pass over it. Blank and null texts have none."""

    def tag(texts: pa.Array) -> pa.Array:
        found = ([] if not (t or "").strip(" ") else [(i, w, kind, score, at, at + len(w)) for i, (w, kind, score, at) in enumerate(tagger(t))] for t in texts.to_pylist())
        return _RAW.array(list(found))

    return F.arrow_udf(tag, _RAW.sql)


def _mention_udf(tagger: Tagger, least: float):
    """Tagged words that are sure enough and of a known type, with their usual type and context. One pass over each text."""

    def usual(raw: str) -> str:
        bare = raw.replace("B-", "").replace("I-", "").upper()
        return T.TYPE_NAMES.get(bare, bare)

    def context(text: str, start: int, end: int, width: int = 50) -> str:
        return _SPACES.sub(" ", f"{text[max(0, start - width) : start]}[{text[start:end]}]{text[end : end + width]}").strip(" ")

    def find(texts: pa.Array) -> pa.Array:
        rows = []
        for text in texts.to_pylist():
            kept = []
            for i, (word, raw, score, at) in enumerate(tagger(text) if (text or "").strip(" ") else ()):
                kind = usual(raw)
                if score >= least and kind in T.ENTITY_TYPES:
                    kept.append((i, word.strip(" "), kind, at, at + len(word), round(score, 4), context(text, at, at + len(word))))
            rows.append(kept)
        return _MENTION.array(rows)

    return F.arrow_udf(find, _MENTION.sql)


def raw_mentions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tagger: Tagger = rule_tagger) -> DataFrame:
    """doc_id, ord (before any filter), word, raw_type, score, start_char, end_char: what a tagger returns."""
    ship_package(docs.sparkSession)
    return docs.select(F.col(id_col).alias("doc_id"), F.explode(_raw_udf(tagger)(F.col(text_col).cast("string"))).alias("m")).select("doc_id", "m.*")


def mentions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST_CONFIDENCE, tagger: Tagger = rule_tagger) -> DataFrame:
    """Tagged, filtered by confidence and type, with context and an entity_id that counts the tagger's own output."""
    ship_package(docs.sparkSession)
    told = docs.select(F.col(id_col).alias("doc_id"), F.explode(_mention_udf(tagger, least)(F.col(text_col).cast("string"))).alias("m"))
    rows = told.select("doc_id", "m.*")
    return rows.withColumn("entity_id", F.concat(F.col("doc_id").cast("string"), F.lit("_entity_"), F.col("ord").cast("string")))


def _starts(texts: pa.Array) -> pa.Array:
    """Where each token of a text begins: a running sum of the lengths before it."""
    rows = [np.cumsum([0, *(len(w) + 1 for w in t.split(" ")[:-1])], dtype=np.int64) if t is not None else None for t in texts.to_pylist()]
    return pa.array(rows, type=pa.list_(pa.int64()))


def _token_starts(text: Column) -> Column:
    return F.arrow_udf(_starts, "array<bigint>")(text)


def token_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, i, word, start_char: a row per token."""
    ship_package(docs.sparkSession)
    text = F.col(text_col).cast("string")
    placed = docs.select(F.col(id_col).alias("doc_id"), F.posexplode(F.arrays_zip(T.tokens(text).alias("w"), _token_starts(text).alias("s"))).alias("i", "t"))
    return placed.select("doc_id", "i", F.col("t.w").alias("word"), F.col("t.s").cast("int").alias("start_char"))


def chunk_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 2048, overlap: int = 256) -> DataFrame:
    """doc_id, chunk, first_token, n_tokens, char_start, chunk_text: windows over tokens; no explode of single tokens."""
    ship_package(docs.sparkSession)
    text = F.col(text_col).cast("string")
    words = docs.select(F.col(id_col).alias("doc_id"), T.tokens(text).alias("words"), _token_starts(text).alias("starts"))
    with_start = F.transform(T.chunks(F.col("words"), size, overlap), lambda c: F.struct(c["first"].alias("first"), c["words"].alias("words"), F.get("starts", c["first"]).alias("start")))
    cut = words.select("doc_id", F.posexplode(with_start).alias("chunk", "c"))
    return cut.select(
        "doc_id", "chunk", F.col("c.first").cast("long").alias("first_token"), F.size("c.words").cast("long").alias("n_tokens"),
        F.col("c.start").alias("char_start"), F.array_join("c.words", " ").alias("chunk_text"),
    )


#: Event types and argument roles.
EVENT_TYPES = (
    "conflict_attack", "conflict_demonstrate", "contact_meet", "contact_phone_write", "justice_arrest", "justice_trial", "justice_convict", "life_die", "life_injure", "movement_transport",
    "personnel_elect", "personnel_start_position", "personnel_end_position", "transaction_transfer_money", "transaction_transfer_ownership", "policy_announce", "policy_implement", "policy_change",
    "agreement_sign", "agreement_negotiate",
)
ROLES = ("agent", "patient", "time", "place", "instrument", "beneficiary", "purpose")
DOMAINS = (
    "geopolitical_conflict", "diplomatic_relations", "economic_policy", "domestic_policy", "elections_politics", "technology_innovation", "social_movements", "environmental_climate", "health_pandemic",
    "legal_judicial", "corporate_business", "cultural_entertainment",
)


def prompt(text: Column, domain: Column, context: Column, types: tuple[str, ...] = EVENT_TYPES, roles: tuple[str, ...] = ROLES) -> Column:
    """What a generating model is asked: the task, the known types and roles, the context if there is any, the text."""
    head = F.concat(F.lit("Extract the main events as JSON.\nDomain: "), F.coalesce(domain, F.lit("any")), F.lit("\nTypes: " + ", ".join(types) + "\nRoles: " + ", ".join(roles)))
    return F.concat_ws("\n", head, F.when(context != "", F.concat(F.lit("Context:\n"), context)), F.lit("Text:"), text)


def first_json(output: str | None) -> str | None:
    """The first whole JSON value of a model's output, without code fences or prose; null if there is none."""
    if not output:
        return None
    starts = [i for i in (output.find("{"), output.find("[")) if i >= 0]
    if not starts:
        return None
    try:
        value, _ = json.JSONDecoder().raw_decode(output, min(starts))
    except ValueError:
        return None
    return json.dumps(value if isinstance(value, dict) and "events" in value else {"events": value if isinstance(value, list) else []})


def _json(outputs: pd.Series) -> pd.Series:
    return outputs.map(first_json)


def _text(v: str, path: str) -> Column:
    return F.expr(f"try_variant_get({v}, '{path}', 'string')")


def parsed_events(outputs: DataFrame, id_col: str = "doc_id", output_col: str = "output", domain_col: str | None = None) -> DataFrame:
    """One row per valid event of a model's output: ids by the item's place, defaults only where a key is absent.

    doc_id, event_id, idx, event_type, trigger, start_char, end_char, sentiment, domain, confidence, arguments (array of
    struct(role, text, type, confidence); those with a confidence out of range are left out), n_arguments.
    """
    ship_package(outputs.sparkSession)
    hint = F.col(domain_col) if domain_col else F.lit(None).cast("string")
    read = outputs.select(F.col(id_col).alias("doc_id"), hint.alias("hint"), F.pandas_udf(_json, "string")(F.col(output_col)).alias("j"))
    items = read.where("j IS NOT NULL").select("doc_id", "hint", F.expr("posexplode(try_variant_get(parse_json(j), '$.events', 'array<variant>'))").alias("idx", "v"))
    absent = lambda path: F.expr(f"try_variant_get(v, '{path}', 'variant') IS NULL")
    args = F.expr("coalesce(try_variant_get(v, '$.arguments', 'array<variant>'), array())")
    confidence = F.coalesce(F.expr("try_variant_get(v, '$.metadata.confidence', 'double')"), F.lit(1.0))
    valid = _text("v", "$.event_type").isNotNull() & _text("v", "$.trigger.text").isNotNull() & confidence.between(0.0, 1.0)
    good = F.filter(args, lambda a: F.coalesce(F.call_function("try_variant_get", a, F.lit("$.confidence"), F.lit("double")), F.lit(1.0)).between(0.0, 1.0))
    told = lambda a, path, default: F.coalesce(F.call_function("try_variant_get", a, F.lit(f"$.{path}"), F.lit("string")), F.call_function("try_variant_get", a, F.lit(f"$.entity.{path}"), F.lit("string")), F.lit(default))
    sure = lambda a: F.coalesce(F.call_function("try_variant_get", a, F.lit("$.confidence"), F.lit("double")), F.lit(1.0))
    arguments = F.transform(good, lambda a: F.struct(told(a, "role", "unknown").alias("role"), told(a, "text", "").alias("text"), told(a, "type", "MISC").alias("type"), sure(a).alias("confidence")))
    return items.where(valid).select(
        "doc_id", F.concat(F.col("doc_id").cast("string"), F.lit("_event_"), F.col("idx").cast("string")).alias("event_id"), F.col("idx").cast("long").alias("idx"),
        _text("v", "$.event_type").alias("event_type"), _text("v", "$.trigger.text").alias("trigger"),
        F.expr("try_variant_get(v, '$.trigger.start_char', 'bigint')").alias("start_char"), F.expr("try_variant_get(v, '$.trigger.end_char', 'bigint')").alias("end_char"),
        F.when(absent("$.metadata.sentiment"), "neutral").otherwise(_text("v", "$.metadata.sentiment")).alias("sentiment"),
        F.when(absent("$.domain"), F.col("hint")).otherwise(_text("v", "$.domain")).alias("domain"), confidence.alias("confidence"), arguments.alias("arguments"), F.size(good).cast("long").alias("n_arguments"),
    )


def merged_events(events: DataFrame, key: str = "doc_id") -> DataFrame:
    """Events seen in overlapping chunks once: of a type, trigger and hundred characters the surest stays, the first on ties.

    ``events``: key, event_type, trigger, start_char, confidence, ord.
    """
    same = Window.partitionBy(key, "event_type", F.lower("trigger"), F.floor(F.col("start_char") / 100)).orderBy(F.desc("confidence"), "ord")
    return events.withColumn("_r", F.row_number().over(same)).where("_r = 1").drop("_r")


def description(kind: Column, trigger: Column, arguments: Column, domain: Column, sentiment: Column) -> Column:
    """An event in words, for embedding; ``arguments``: array of struct(role, text)."""
    roles = F.transform(arguments, lambda a: F.concat(a["role"], F.lit(": "), a["text"]))
    ends = F.filter(F.array(F.concat(F.lit("Domain: "), domain), F.concat(F.lit("Sentiment: "), sentiment)), lambda x: x.isNotNull())
    return F.array_join(F.concat(F.array(F.concat(F.lit("Event type: "), kind), F.concat(F.lit("Trigger: "), trigger)), roles, ends), " | ")
