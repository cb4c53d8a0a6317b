"""Entity resolution: mentions of a document and type that name the same thing, and the form that stands for them.

Grouping is greedy and ordered: each mention not yet placed opens a group and, in one pass, takes later ones like any of its
members so far; that is no transitive closure, so the whole ordered list of a group key is needed in one place. A document's mentions of one type are a
bounded list; repeated comparisons within it are remembered.
"""

from __future__ import annotations

import difflib
import re

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from narrata.functions.shipping import ship_package

LEAST_JACCARD, LEAST_RATIO = 0.5, 0.85


def similar(member: str, candidate: str) -> bool:
    """Equal, one within the other, half of the words shared, or nearly the same letters in order; cheapest test first."""
    a, b = (re.sub(r"\s+", " ", x.lower().strip()) for x in (member, candidate))
    if a == b or a in b or b in a:
        return True
    x, y = ({w for w in re.sub(r"[.,]", " ", s.lower()).replace("'", "").split()} for s in (member, candidate))
    if x and y and len(x & y) / len(x | y) >= LEAST_JACCARD:
        return True
    letters = difflib.SequenceMatcher(None, b, a)
    bounds = letters.real_quick_ratio, letters.quick_ratio  # never below the ratio: lengths, then letters without their order
    return all(bound() >= LEAST_RATIO for bound in bounds) and letters.ratio() >= LEAST_RATIO


def grouped(texts: list[str]) -> list[int]:
    """Group numbers of mentions in their order: a later mention joins the open group if it is like any member so far."""
    numbers, known, last = [-1] * len(texts), {}, 0

    def alike(member: str, candidate: str) -> bool:
        pair = member, candidate
        if pair not in known:
            known[pair] = similar(member, candidate)
        return known[pair]

    for i, seed in enumerate(texts):
        if numbers[i] < 0:
            members = dict.fromkeys([seed])  # different texts of the group, in order
            numbers[i] = last
            for j in range(i + 1, len(texts)):
                if numbers[j] < 0 and any(alike(m, texts[j]) for m in members):
                    numbers[j] = last
                    members[texts[j]] = None
            last += 1
    return numbers


def _run(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("ord", ignore_index=True)
    group["group_no"] = grouped(group["text"].tolist())
    return group[["doc_id", "type", "ord", "text", "confidence", "group_no"]]


def resolved(mentions: DataFrame) -> DataFrame:
    """``mentions`` (doc_id, type, ord, text, confidence) with group_no and normalized_form: the longest, then surest, then first."""
    ship_package(mentions.sparkSession)
    kind = mentions.schema["doc_id"].dataType.simpleString()
    rows = mentions.select("doc_id", "type", F.col("ord").cast("int").alias("ord"), "text", F.col("confidence").cast("double").alias("confidence"))
    numbered = rows.groupBy("doc_id", "type").applyInPandas(_run, f"doc_id {kind}, type string, ord int, text string, confidence double, group_no int")
    return canonical(numbered, "doc_id", "type", "group_no")


def canonical(mentions: DataFrame, *keys: str) -> DataFrame:
    best = F.first("text").over(Window.partitionBy(*keys).orderBy(F.desc(F.length("text")), F.desc("confidence"), "ord"))
    return mentions.withColumn("normalized_form", best)
