"""Queries over the event feed: scored links, components, storylines, causes."""

from __future__ import annotations

from pyspark.sql import functions as F

from narrata.functions.text import present
from narrata.operators import linking
from narrata.plans.base import Registry, table

query = Registry()
QUERIES, ORACLES = query.queries, query.oracles
#: The feed's events take turns with this many embeddings.
VECTORS = 16


def feed(spark, d, patient: bool = False):
    """Events as the linker takes them; with ``patient`` a second argument from the properties."""
    agent = linking.signature(F.col("user_id").cast("string"), F.lit("agent"), F.col("event_type"))
    second = linking.signature(F.get_json_object("props", "$.k"), F.lit("patient"), F.col("event_type"))
    vectors = table(spark, d, "embeddings").where(F.col("vec_id") < VECTORS).select(F.col("vec_id").alias("turn"), "embedding")
    events = table(spark, d, "events").withColumn("turn", F.col("event_id") % VECTORS)
    rows = events.join(F.broadcast(vectors), "turn")  # sixteen rows
    return rows.select("event_id", F.col("event_id").alias("ord"), F.col("event_type").alias("domain"), F.col("ts").cast("timestamp").alias("ts"), "embedding", F.array(agent, second) .alias("signatures") if patient else F.array(agent).alias("signatures"))


_SCORES = ("semantic_similarity", "entity_overlap", "temporal_proximity", "domain_similarity", "similarity_score")
_FEED = f"""
e AS (SELECT event_id, user_id, event_type, ts, json_extract_string(props, '$.k') AS k, embedding::DOUBLE[] AS v FROM events JOIN embeddings ON vec_id = event_id % {VECTORS})"""
_SCORED = """
s AS (SELECT x, y, cos, j, exp(-abs(floor((epoch_us(ty) - epoch_us(tx)) / 86400000000.0)) / 7.0) AS t, 1.0 AS dom FROM p),
links AS (SELECT *, 0.4 * cos + 0.3 * j + 0.2 * t + 0.1 * dom AS score FROM s WHERE 0.4 * cos + 0.3 * j + 0.2 * t + 0.1 * dom >= 0.75)"""
_PLAIN = f"""WITH RECURSIVE {_FEED},
p AS (SELECT a.event_id AS x, b.event_id AS y, list_cosine_similarity(a.v, b.v) AS cos, 1.0 AS j, a.ts AS tx, b.ts AS ty FROM e a JOIN e b ON a.user_id = b.user_id AND a.event_type = b.event_type AND a.event_id < b.event_id),
{_SCORED}"""
_OUT = """ SELECT x AS source_event_id, y AS target_event_id, 'coreference' AS link_type, round(greatest(0, cos), 6)::DOUBLE AS semantic_similarity, round(j, 6)::DOUBLE AS entity_overlap,
round(t, 6)::DOUBLE AS temporal_proximity, dom::DOUBLE AS domain_similarity, round(score, 6)::DOUBLE AS similarity_score FROM links"""


def _rounded(df):
    return df.withColumns({c: F.round(c, 6) for c in _SCORES})


@query(_PLAIN + _OUT)
def q_event_links(spark, d):
    return _rounded(linking.links(feed(spark, d)))


@query(f"""WITH {_FEED},
g AS (SELECT *, [user_id || '|agent|' || event_type, k || '|patient|' || event_type] AS sig FROM e), h AS (SELECT event_id, unnest(sig) AS q FROM g),
c AS (SELECT DISTINCT a.event_id AS x, b.event_id AS y FROM h a JOIN h b ON a.q = b.q AND a.event_id < b.event_id),
p AS (SELECT x, y, list_cosine_similarity(a.v, b.v) AS cos, len(list_intersect(a.sig, b.sig)) / len(list_distinct(a.sig || b.sig)) AS j, a.ts AS tx, b.ts AS ty FROM c JOIN g a ON a.event_id = x JOIN g b ON b.event_id = y),
{_SCORED}""" + _OUT)
def q_link_fractional(spark, d):
    return _rounded(linking.links(feed(spark, d, patient=True)))


_COMPONENTS = _PLAIN + """,
edges AS (SELECT x, y FROM links UNION SELECT y, x FROM links), reach(node, other) AS (SELECT x, y FROM edges UNION SELECT r.node, e2.y FROM reach r JOIN edges e2 ON r.other = e2.x),
comp AS (SELECT node AS event_id, min(other) AS component FROM reach GROUP BY node)"""


@query(_COMPONENTS + " SELECT event_id, component FROM comp")
def q_components(spark, d):
    return linking.named_components(linking.links(feed(spark, d)))


@query()
def q_storylines(spark, d):
    """Average linkage in each component; SQL can't express the merging."""
    events = feed(spark, d)
    return linking.storyline_members(events, linking.links(events))


@query(_COMPONENTS + """,
m AS (SELECT comp.component, comp.event_id, event_type, user_id, k, ts FROM comp JOIN e USING (event_id)),
n AS (SELECT component, lower(text) AS entity, count(*) AS n, min(o) AS f FROM (SELECT component, 'User ' || user_id AS text, event_id * 2 AS o FROM m UNION ALL SELECT component, 'K' || CAST(k AS INT) % 3, event_id * 2 + 1 FROM m) GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY component ORDER BY n DESC, f) AS r FROM n),
tops AS (SELECT component, string_agg(entity, ', ' ORDER BY r) FILTER (r <= 5) AS five, string_agg(entity, ', ' ORDER BY r) FILTER (r <= 3) AS three FROM r GROUP BY component),
b AS (SELECT component, count(*) AS n_events, string_agg(event_id, ',' ORDER BY event_id) AS event_ids, min(event_type) AS domain, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_ts, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_ts FROM m GROUP BY component HAVING count(*) >= 2)
SELECT 'storyline_' || b.component AS storyline_id, n_events, event_ids, domain, five AS primary_entities, first_ts, last_ts,
       upper(domain[1]) || domain[2:] || ' storyline involving ' || three || ' (' || n_events || ' events)' AS storyline_summary FROM b JOIN tops USING (component)""")
def q_storyline_profile(spark, d):
    events = feed(spark, d)
    members = linking.named_components(linking.links(events)).join(events, "event_id")
    raw = table(spark, d, "events")
    users = raw.select("event_id", (F.col("event_id") * 2).alias("ord"), F.concat(F.lit("User "), F.col("user_id").cast("string")).alias("text"))
    things = raw.select("event_id", (F.col("event_id") * 2 + 1).alias("ord"), F.concat(F.lit("K"), (F.get_json_object("props", "$.k").cast("int") % 3).cast("string")).alias("text"))
    told = linking.profiles(members, users.unionByName(things), key="component")
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    return told.select("storyline_id", "n_events", F.array_join(F.transform("event_ids", lambda x: x.cast("string")), ",").alias("event_ids"), "domain", F.array_join("primary_entities", ", ").alias("primary_entities"), stamp("first_ts"), stamp("last_ts"), "storyline_summary")


_CAUSE = "CASE " + " ".join(f"WHEN contains(lower(text), '{c}') THEN 'Contains causal indicator: {c}'" for c in linking.CAUSES) + " END"


@query(f"SELECT conv_id, turn, coalesce(CASE WHEN conv_id % 10 = 0 THEN 'given' END, {_CAUSE}) AS causality FROM conversations")
def q_causality(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", linking.causality(F.when(F.col("conv_id") % 10 == 0, F.lit("given")), F.col("text")).alias("causality"))


@query(f"SELECT doc_id, {_CAUSE} AS causality FROM documents")
def q_causality_documents(spark, d):
    return table(spark, d, "documents").select("doc_id", linking.causality(F.lit(None).cast("string"), F.col("text")).alias("causality"))


@query("""
SELECT event_id, user_id, CASE WHEN event_id % 3 = 0 THEN 'unknown' ELSE event_type END AS bucket FROM events WHERE event_id % 3 = 0 OR event_type <> ''""")
def q_domain_buckets(spark, d):
    domain = F.when(F.col("event_id") % 3 != 0, F.col("event_type"))
    return table(spark, d, "events").select("event_id", "user_id", F.coalesce(present(domain), F.lit("unknown")).alias("bucket"))
