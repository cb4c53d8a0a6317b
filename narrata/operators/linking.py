"""Scored links between events, connected components, average-linkage storylines and their profiles.

A pair scores 0.4 for the cosine of its embeddings, 0.3 for the Jaccard similarity of its entity signatures, 0.2 for
closeness in time and 0.1 for the domain; from 0.75 on it is a link. Without a common signature the score can't pass 0.7, so
pairs come from equi-joins on signatures (see ``_signature_pairs``) and no link is lost; other weights fall back to blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from narrata.functions import vectors as V
from narrata.functions.shipping import ship_package
from narrata.functions.text import jaccard
from narrata.operators.cutting import cut
from narrata.operators.graph import components


#: Up to so many different embeddings (about), with so many partners each on average, pairs meet on their embeddings, too.
FEW, PARTNERS = 512, 4


@dataclass(frozen=True)
class Weights:
    semantic: float = 0.4
    entity: float = 0.3
    temporal: float = 0.2
    domain: float = 0.1
    threshold: float = 0.75
    decay_days: float = 7.0


def signature(text: Column, role: Column, domain: Column) -> Column:
    return F.concat_ws("|", F.lower(text), role, F.coalesce(F.nullif(domain, F.lit("")), F.lit("unknown")))


def _score(pairs: DataFrame, w: Weights) -> DataFrame:
    a, b = (lambda c: F.col(f"a.{c}")), (lambda c: F.col(f"b.{c}"))
    semantic = V.cosine(a("embedding"), b("embedding"), a("norm"), b("norm"))
    entity = jaccard(a("signatures"), b("signatures"))
    temporal = V.temporal_proximity(a("ts"), b("ts"), w.decay_days)
    domain = V.domain_similarity(a("domain"), b("domain"))
    scored = pairs.select(
        a("event_id").alias("source_event_id"), b("event_id").alias("target_event_id"), F.lit("coreference").alias("link_type"),
        semantic.alias("semantic_similarity"), entity.alias("entity_overlap"), temporal.alias("temporal_proximity"), domain.alias("domain_similarity"),
    )
    return _totalled(scored, w)


def _totalled(scored: DataFrame, w: Weights) -> DataFrame:
    total = F.col("semantic_similarity") * w.semantic + F.col("entity_overlap") * w.entity + F.col("temporal_proximity") * w.temporal + F.col("domain_similarity") * w.domain
    return scored.withColumn("similarity_score", total)


def _same_story(a: Column, b: Column) -> Column:
    return (a == b) | F.nullif(a, F.lit("")).isNull() | F.nullif(b, F.lit("")).isNull()


def _close_days(w: Weights, overlap: float) -> int | None:
    """Most whole days between two events that can link at this entity overlap; None: any number; -1: none can."""
    least = (w.threshold - w.semantic - w.domain - w.entity * overlap) / w.temporal if w.temporal else 0.0
    return None if least <= 0 else -1 if least > 1 else int(-w.decay_days * math.log(least) + 1e-9)


def _overlap(sizes: list[int]) -> float:
    """Largest Jaccard similarity of two different sets that have some of these sizes."""
    return max((m / n if m < n else (n - 1) / (n + 1) for m in sizes for n in sizes if m <= n), default=0.0)


def _scored(met: DataFrame, w: Weights, entity: Column) -> DataFrame:
    """``met``: pairs of rows l and r in any order; with the cosine in l.cos, or else from the embeddings."""
    first = F.col("l.ord") < F.col("r.ord")
    a, b = (lambda c: F.when(first, F.col(f"l.{c}")).otherwise(F.col(f"r.{c}"))), (lambda c: F.when(first, F.col(f"r.{c}")).otherwise(F.col(f"l.{c}")))
    semantic = F.col("l.cos") if "cos" in met.columns else V.cosine(F.col("l.embedding"), F.col("r.embedding"), F.col("l.norm"), F.col("r.norm"))
    return _totalled(met.select(
        a("event_id").alias("source_event_id"), b("event_id").alias("target_event_id"), F.lit("coreference").alias("link_type"), semantic.alias("semantic_similarity"), entity.alias("entity_overlap"),
        V.temporal_proximity(a("ts"), b("ts"), w.decay_days).alias("temporal_proximity"), V.domain_similarity(F.col("l.domain"), F.col("r.domain")).alias("domain_similarity"),
    ), w)


def _sides(held: DataFrame, w: Weights, different: int):
    """A function from the best overlap of a pair to the two sides of its join, and the columns both have to agree on besides.

    Where embeddings repeat, they are numbered and compared once: a row of the left side is told the numbers whose cosine is high
    enough for a link, so pairs that can't link are never made. Else rows carry their embedding.
    """
    whole = held.withColumn("norm", V.norm(F.col("embedding")))
    if different > FEW or w.semantic <= 0:
        return lambda overlap: (whole, whole, [])
    names = [F.xxhash64(F.lit(seed), F.size("embedding"), "embedding").alias(f"h{seed}") for seed in (0, 1)]
    named = held.select("*", *names)
    kinds = named.groupBy("h0", "h1").agg(F.first("embedding").alias("embedding"))
    kinds = cut(kinds.withColumn("norm", V.norm(F.col("embedding"))).withColumn("c", F.monotonically_increasing_id()))
    numbered = named.join(F.broadcast(kinds.select("h0", "h1", "c")), ["h0", "h1"]).drop("h0", "h1", "embedding")
    x, y = kinds.alias("x"), F.broadcast(kinds).alias("y")
    cosines = cut(x.crossJoin(y).select(F.col("x.c").alias("own"), F.col("y.c").alias("c"), V.cosine(F.col("x.embedding"), F.col("y.embedding"), F.col("x.norm"), F.col("y.norm")).alias("cos")))

    def sides(overlap: float) -> tuple[DataFrame, DataFrame, list[str]]:
        near = cosines.where(F.col("cos") >= (w.threshold - w.entity * overlap - w.temporal - w.domain) / w.semantic - 1e-9)
        if near.count() > PARTNERS * kinds.count():
            return whole, whole, []
        return numbered.withColumnRenamed("c", "own").join(F.broadcast(near), "own").drop("own"), numbered, ["c"]

    return sides


def _signature_pairs(events: DataFrame, w: Weights) -> DataFrame:
    """Pairs with a common signature that can still reach the threshold, scored.

    Events with the same signatures can link at any distance in time and meet on the whole set. Others overlap less, so they
    may have to be close in time: they meet on a signature and the same or the next stretch of days. A pair counts where
    its first common signature is, so none has to be looked for twice, and what moves are events, never pairs.
    """
    held = events.select("event_id", "ord", "domain", "ts", "embedding", F.array_sort(F.array_distinct("signatures")).alias("all")).where(F.size("all") > 0)
    sizes, different = held.agg(F.collect_set(F.size("all")), F.approx_count_distinct(F.xxhash64(F.size("embedding"), "embedding"))).first()
    sides = _sides(held, w, different)
    story = _same_story(F.col("l.domain"), F.col("r.domain"))
    ordered, apart = F.col("l.ord") < F.col("r.ord"), F.col("l.ord") != F.col("r.ord")

    def met(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
        return a.alias("l").join(b.alias("r"), [F.col(f"l.{c}") == F.col(f"r.{c}") for c in on])

    left, right, also = sides(1.0)
    key = F.xxhash64("all").alias("key")  # narrow; equality rests on the sets
    same = met(left.select("*", key), right.select("*", key), ["key", *also]).where(ordered & story & (F.col("l.all") == F.col("r.all")))
    same = _scored(same, w, F.lit(1.0))
    overlap = _overlap(sizes)
    days = _close_days(w, overlap)
    if overlap <= 0 or days == -1:
        return same
    left, right, also = sides(overlap)
    each = F.explode(F.array_distinct(F.transform("all", lambda s: F.xxhash64(s)))).alias("key")
    left, right, on = left.select("*", each), right.select("*", each), ["key", *also]
    common = F.array_intersect("l.all", "r.all")
    differ = story & (F.col("l.all") != F.col("r.all")) & (F.xxhash64(F.get(common, F.lit(0))) == F.col("l.key"))
    entity = F.size(common) / (F.size("l.all") + F.size("r.all") - F.size(common))
    if days is None:
        return same.unionByName(_scored(met(left, right, on).where(ordered & differ), w, entity))
    stretch = F.floor(F.floor(F.unix_seconds("ts") / 86_400) / (days + 1))
    timed = lambda df: df.where("ts IS NOT NULL").withColumn("stretch", stretch)
    later = timed(right).withColumn("at", F.explode(F.array(F.col("stretch"), F.col("stretch") - 1)))
    passed = F.unix_micros("r.ts") - F.unix_micros("l.ts")
    gap = F.abs(F.floor(F.when(ordered, passed).otherwise(-passed) / 86_400_000_000))
    once = F.when(F.col("r.stretch") == F.col("l.stretch"), ordered).otherwise(apart)
    near = met(timed(left).withColumn("at", F.col("stretch")), later, [*on, "at"]).where(once & (gap <= days) & differ)
    out = same.unionByName(_scored(near, w, entity))
    if _unknown_time_links(w, overlap):
        once = F.when(F.col("r.ts").isNull(), ordered).otherwise(apart)
        out = out.unionByName(_scored(met(left.where("ts IS NULL"), right, on).where(once & differ), w, entity))
    return out


def _unknown_time_links(w: Weights, overlap: float) -> bool:
    """Whether two events of different signatures can link if a time is missing, which counts as a closeness of one half."""
    return w.semantic + w.domain + w.entity * overlap + w.temporal * 0.5 >= w.threshold - 1e-9


def scored_pairs(events: DataFrame, w: Weights = Weights()) -> DataFrame:
    """All pairs that can be links, scored. ``events``: event_id, ord, domain, ts, embedding, signatures (array)."""
    if w.semantic + w.temporal + w.domain < w.threshold:
        return _signature_pairs(events, w)
    prepared = events.withColumn("norm", V.norm(F.col("embedding")))
    # weights that link without a common signature: all pairs of a domain, and those without one with all, in blocks
    blocks = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    known = F.nullif(F.col("domain"), F.lit("")).isNotNull()
    whole = F.struct(*prepared.columns)
    a = prepared.where(known).select(F.col("domain").alias("d"), whole.alias("a"))
    b = prepared.where(known).select(F.col("domain").alias("d"), whole.alias("b"))
    inside = a.join(b, "d").where(F.col("a.ord") < F.col("b.ord")).select("a", "b")
    dealt = prepared.select(F.pmod(F.xxhash64("event_id"), F.lit(blocks)).alias("block"), whole.alias("r"))
    loose = prepared.where(~known).select(whole.alias("l"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"))
    cross = loose.join(dealt, "block").where((F.col("l.ord") < F.col("r.ord")) | (F.nullif(F.col("r.domain"), F.lit("")).isNotNull() & (F.col("l.ord") > F.col("r.ord"))))
    later = F.col("l.ord") > F.col("r.ord")
    open_pairs = cross.select(F.when(later, F.col("r")).otherwise(F.col("l")).alias("a"), F.when(later, F.col("l")).otherwise(F.col("r")).alias("b"))
    return _score(inside.unionByName(open_pairs), w)


def links(events: DataFrame, w: Weights = Weights()) -> DataFrame:
    clamp = lambda c: F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col(c))).alias(c)
    scores = ["semantic_similarity", "entity_overlap", "temporal_proximity", "domain_similarity", "similarity_score"]
    return scored_pairs(events, w).where(F.col("similarity_score") >= w.threshold).select("source_event_id", "target_event_id", "link_type", *[clamp(c) for c in scores])


def named_components(found: DataFrame) -> DataFrame:
    """event_id, component: the least event that links reach."""
    return components(found, "source_event_id", "target_event_id").withColumnRenamed("node", "event_id")


def average_linkage(similarity: np.ndarray, cut_at: float) -> np.ndarray:
    """Cluster numbers by average linkage: the two clusters with the highest mean similarity merge while it is above ``cut_at``.

    Each cluster remembers its best partner, so a merge costs about one pass over the clusters instead of all pairs.
    """
    n = len(similarity)
    sums, counts, label = similarity.astype(float), np.ones(n), np.arange(n)
    np.fill_diagonal(sums, -np.inf)
    alive = np.ones(n, dtype=bool)
    mean_of = lambda i: np.where(alive, sums[i] / (counts[i] * counts), -np.inf)
    best, value = np.zeros(n, dtype=int), np.full(n, -np.inf)

    def refresh(i: int) -> None:
        means = mean_of(i)
        best[i] = int(np.argmax(means))
        value[i] = means[best[i]]

    for i in range(n):
        refresh(i)
    while alive.sum() > 1:
        i = int(np.argmax(value))
        if value[i] <= cut_at:
            break
        i, j = min(i, best[i]), max(i, best[i])
        sums[i] += sums[j]
        sums[:, i] += sums[:, j]
        sums[i, i] = -np.inf
        counts[i] += counts[j]
        alive[j], value[j] = False, -np.inf
        label[label == j] = i
        stale = alive & ((best == i) | (best == j))
        stale[i] = True
        for k in np.flatnonzero(stale):
            refresh(k)
        means = mean_of(i)
        better = alive & ((means > value) | ((means == value) & (i < best)))
        better[i] = False
        best[better], value[better] = i, means[better]
    return label


def _cluster(w: Weights):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("ord", ignore_index=True)
        x = np.stack([np.asarray(v, dtype=float) for v in group["embedding"]])
        norm = np.linalg.norm(x, axis=1)
        with np.errstate(divide="ignore", invalid="ignore"):
            semantic = np.nan_to_num((x @ x.T) / np.outer(norm, norm))
        numbers: dict[str, int] = {}
        sets = [{numbers.setdefault(x, len(numbers)) for x in s} for s in group["signatures"]]
        marks = np.zeros((len(sets), max(1, len(numbers))), dtype=np.float32)
        for row, own in zip(marks, sets, strict=True):
            row[list(own)] = 1
        shared, sizes = (marks @ marks.T).astype(float), marks.sum(axis=1, dtype=float)
        entity = shared / np.maximum(1.0, sizes[:, None] + sizes[None, :] - shared)
        ts = group["ts"].astype("datetime64[us]").astype("int64").to_numpy().astype(float)
        missing = group["ts"].isna().to_numpy()
        days = np.abs(np.floor((ts[None, :] - ts[:, None]) / 86_400_000_000))
        days = np.where(np.triu(np.ones_like(days), 1) > 0, days, days.T)
        temporal = np.where(missing[:, None] | missing[None, :], 0.5, np.exp(-days / w.decay_days))
        domain = group["domain"].fillna("").to_numpy()
        known = (domain[:, None] != "") & (domain[None, :] != "")
        same = domain[:, None] == domain[None, :]
        total = w.semantic * semantic + w.entity * entity + w.temporal * temporal + w.domain * np.where(known, same.astype(float), 0.5)
        total = np.where(known & ~same, 0.0, total)
        label = average_linkage(total, w.threshold)
        return pd.DataFrame({"event_id": group["event_id"], "cluster": group["event_id"].to_numpy()[label]})

    return run


def _clustered(w: Weights):
    """Components in a row, as their rows come sorted: each is clustered once its last row was read, whatever batch that is in."""
    one = _cluster(w)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: list[pd.DataFrame] = []
        for batch in batches:
            if batch.empty:
                continue
            ids = batch["component"].to_numpy()
            begins = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1).tolist(), len(ids)]
            done = []
            for start, stop in zip(begins, begins[1:], strict=False):
                part = batch.iloc[start:stop]
                if kept and kept[-1]["component"].iloc[0] != part["component"].iloc[0]:
                    done.append(one(pd.concat(kept) if len(kept) > 1 else kept[0]))
                    kept = []
                kept.append(part)
            if done:
                yield pd.concat(done, ignore_index=True)
        if kept:
            yield one(pd.concat(kept))

    return run


def storyline_members(events: DataFrame, found: DataFrame, w: Weights = Weights()) -> DataFrame:
    """event_id, cluster (its first event): average linkage, run in each component alone, which gives the same clusters.

    Where all events of a component are linked with each other above the threshold, every mean is above it, too, and all merge:
    such a component is one cluster and needs no matrix. The others go through Python many at a time.
    """
    ship_package(events.sparkSession)
    found = cut(found.select("source_event_id", "target_event_id", "similarity_score"))
    named = cut(named_components(found))
    pairs = F.count_if(F.col("similarity_score") > w.threshold + 1e-9)
    inner = found.join(named, F.col("source_event_id") == F.col("event_id")).groupBy("component").agg(pairs.alias("pairs"))
    ranked = events.select("event_id", "ord").join(named, "event_id")
    whole = ranked.groupBy("component").agg(F.count("*").alias("n"), F.min_by("event_id", F.struct("ord", "event_id")).alias("first")).join(inner, "component")
    told = cut(named.join(whole.select("component", "first", (F.col("pairs") == F.expr("n * (n - 1) div 2")).alias("complete")), "component"))
    complete = told.where("complete").select("event_id", F.col("first").alias("cluster"))
    rest = told.where("NOT complete").select("event_id", "component")
    rows = events.join(rest, "event_id").select("component", "event_id", "ord", "domain", "ts", "embedding", "signatures")
    kind = dict(events.dtypes)["event_id"]
    sorted_rows = rows.repartition("component").sortWithinPartitions("component")
    groups = sorted_rows.mapInPandas(_clustered(w), f"event_id {kind}, cluster {kind}")
    groups = groups.withColumn("n", F.count("*").over(Window.partitionBy("cluster"))).where("n >= 2").drop("n")
    return complete.unionByName(groups)


def profiles(members: DataFrame, entities: DataFrame, key: str = "cluster", prefix: str = "storyline_") -> DataFrame:
    """One row per storyline: members, five most frequent entities, domain, span and summary; ties go to the first seen.

    ``members``: key, event_id, ord, domain, ts; ``entities``: event_id, ord (of the mention), text.
    """
    named = members.select(key, "event_id").join(entities, "event_id").groupBy(key, F.lower("text").alias("entity")).agg(F.count("*").alias("n"), F.min("ord").alias("first"))
    ranked = named.withColumn("r", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("n"), "first"))).where("r <= 5")
    top = ranked.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("r", "entity")))["entity"].alias("primary_entities"))
    counted = members.where("domain IS NOT NULL").groupBy(key, "domain").agg(F.count("*").alias("n"), F.min("ord").alias("first"))
    mode = counted.groupBy(key).agg(F.max_by("domain", F.struct("n", -F.col("first"))).alias("domain"))
    body = members.groupBy(key).agg(F.count("*").alias("n_events"), F.sort_array(F.collect_list(F.struct("ord", "event_id")))["event_id"].alias("event_ids"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    body = body.where("n_events >= 2").join(mode, key, "left").join(top, key, "left")
    title = F.coalesce(F.initcap(F.replace(F.col("domain"), F.lit("_"), F.lit(" "))), F.lit("General"))
    summary = F.concat(title, F.lit(" storyline involving "), F.array_join(F.slice("primary_entities", 1, 3), ", "), F.lit(" ("), F.col("n_events").cast("string"), F.lit(" events)"))
    return body.withColumn("storyline_id", F.concat(F.lit(prefix), F.col(key).cast("string"))).withColumn("storyline_summary", summary)


#: Phrases that tell of a cause, in the order they are looked for.
CAUSES = ("because", "due to", "as a result", "led to", "caused", "triggered", "following", "after", "consequently")


def causality(given: Column, sentence: Column) -> Column:
    """The given cause, or the first phrase of the list that the sentence holds."""
    low = F.lower(sentence)
    return F.coalesce(given, *[F.when(F.contains(low, F.lit(c)), F.lit(f"Contains causal indicator: {c}")) for c in CAUSES])
