"""Queries over documents: fields, mentions, chunks, prompts, model output, triplets, names."""

from __future__ import annotations

from pyspark.sql import functions as F

from narrata.functions import tables
from narrata.functions import text as T
from narrata.operators import extraction, parsing, resolution
from narrata.plans.base import Registry, table

query = Registry()
QUERIES, ORACLES = query.queries, query.oracles


@query("""
SELECT doc_id, md5(coalesce(nullif(CASE WHEN doc_id % 5 > 1 THEN text WHEN doc_id % 5 = 1 THEN '' END, ''), nullif(CASE WHEN doc_id % 3 = 0 THEN source END, ''), nullif(lang, ''))) AS chosen,
       doc_id % 5 > 1 AND text <> '' AS from_first
FROM documents""")
def q_text_fallback(spark, d):
    docs = table(spark, d, "documents")
    first = F.when(F.col("doc_id") % 5 > 1, F.col("text")).when(F.col("doc_id") % 5 == 1, F.lit(""))
    chosen = T.first_text(first, F.when(F.col("doc_id") % 3 == 0, F.col("source")), F.col("lang"))
    return docs.select("doc_id", F.md5(chosen).alias("chosen"), ((F.col("doc_id") % 5 > 1) & (F.col("text") != "")).alias("from_first"))


@query("""
SELECT doc_id, doc_id % 4 <> 0 AND coalesce(nullif(text, ''), '') <> '' AS valid,
       CASE WHEN doc_id % 4 = 0 THEN 'no id' WHEN coalesce(nullif(text, ''), '') = '' THEN 'no text' END AS error
FROM documents""")
def q_validate_documents(spark, d):
    ident = F.when(F.col("doc_id") % 4 != 0, F.col("doc_id").cast("string")).otherwise("")
    error = F.when(ident == "", "no id").when(T.first_text(F.col("text")).isNull(), "no text")
    return table(spark, d, "documents").select("doc_id", error.isNull().alias("valid"), error.alias("error"))


@query("""
SELECT doc_id, concat_ws(chr(10), CASE WHEN lang <> '' THEN 'Title: ' || lang END, CASE WHEN doc_id % 3 = 0 THEN 'Author: ' || source END,
       CASE WHEN doc_id % 2 = 0 THEN 'Published: 2024-01-01' END, 'Categories: ' || lang || ', ' || source,
       'Tags: ' || array_to_string(['t0', 't1', 't2', 't3', 't4'][1:(doc_id % 7)::INT], ', ')) AS context
FROM documents WHERE doc_id % 7 > 0
UNION ALL
SELECT doc_id, concat_ws(chr(10), CASE WHEN lang <> '' THEN 'Title: ' || lang END, CASE WHEN doc_id % 3 = 0 THEN 'Author: ' || source END,
       CASE WHEN doc_id % 2 = 0 THEN 'Published: 2024-01-01' END, 'Categories: ' || lang || ', ' || source) FROM documents WHERE doc_id % 7 = 0""")
def q_context_string(spark, d):
    tags = F.slice(F.array(*[F.lit(f"t{i}") for i in range(6)]), F.lit(1), (F.col("doc_id") % 7).cast("int"))
    author, published = F.when(F.col("doc_id") % 3 == 0, F.col("source")).otherwise(""), F.when(F.col("doc_id") % 2 == 0, F.lit("2024-01-01"))
    context = T.context_string(F.col("lang"), author, published, F.lit(None).cast("string"), F.array("lang", "source"), tags)
    return table(spark, d, "documents").select("doc_id", context.alias("context"))


@query("""
SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 3 = 1 THEN '' ELSE source END AS publisher, doc_id % 3 = 1 OR (doc_id % 3 = 2 AND source IS NOT NULL) AS has_publisher, lang IS NOT NULL AS has_language
FROM documents""")
def q_preserved_fields(spark, d):
    publisher = F.when(F.col("doc_id") % 3 == 1, F.lit("")).when(F.col("doc_id") % 3 == 2, F.col("source"))
    kept = T.preserved({"publisher": publisher, "language": F.col("lang")})
    docs = table(spark, d, "documents").select("doc_id", kept.alias("m"))
    return docs.select("doc_id", F.try_element_at("m", F.lit("publisher")).alias("publisher"), F.map_contains_key("m", "publisher").alias("has_publisher"), F.map_contains_key("m", "language").alias("has_language"))


@query("""
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%dT00:00:00') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') WHEN 2 THEN 'soon' END AS normalised FROM orders""")
def q_date_normalise(spark, d):
    given = F.expr("CASE o_orderkey % 4 WHEN 0 THEN date_format(o_orderdate, 'yyyy-MM-dd') WHEN 1 THEN date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss\") WHEN 2 THEN 'soon' END")
    return table(spark, d, "orders").select("o_orderkey", T.normalised_date(given).alias("normalised"))


@query("SELECT doc_id, md5(substring(text, 1, 500)) AS head, length(substring(text, 1, 500)) AS n FROM documents")
def q_truncate(spark, d):
    head = T.truncated(F.col("text"), 500)
    return table(spark, d, "documents").select("doc_id", F.md5(head).alias("head"), F.length(head).cast("long").alias("n"))


@query("""
SELECT p_partkey, CASE p_partkey % 8 WHEN 0 THEN 'PER' WHEN 1 THEN 'ORG' WHEN 2 THEN 'LOC' WHEN 3 THEN 'MONEY' WHEN 4 THEN 'GPE' WHEN 5 THEN 'MISC' WHEN 6 THEN 'MISC' ELSE upper(p_type) END AS entity_type,
       p_partkey % 8 <> 7 AS allowed FROM part""")
def q_type_normalise(spark, d):
    raw = F.expr("CASE p_partkey % 8 WHEN 0 THEN 'B-PERSON' WHEN 1 THEN 'I-ORGANIZATION' WHEN 2 THEN 'LOCATION' WHEN 3 THEN 'percent' WHEN 4 THEN 'GPE' WHEN 5 THEN 'B-I-MISC' WHEN 6 THEN 'cardinal' ELSE p_type END")
    kind = T.entity_type(raw)
    return table(spark, d, "part").select("p_partkey", kind.alias("entity_type"), kind.isin(*T.ENTITY_TYPES).alias("allowed"))


_TAGGED = f"""
WITH parts AS (SELECT doc_id, string_split_regex(text, '{extraction.ISO_DATE}|{extraction.MONEY}|{extraction.NAME}') AS between,
                      regexp_extract_all(text, '{extraction.ISO_DATE}|{extraction.MONEY}|{extraction.NAME}') AS found FROM documents WHERE trim(text) <> ''),
rows AS (SELECT doc_id, i - 1 AS ord, between[i] AS b, found[i] AS w FROM (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM parts)),
placed AS (SELECT doc_id, ord, w, CAST(sum(length(b) + length(w)) OVER (PARTITION BY doc_id ORDER BY ord) AS BIGINT) AS end_char FROM rows),
typed AS (SELECT *, end_char - length(w) AS start_char,
          CASE WHEN regexp_full_match(w, '{extraction.ISO_DATE}') THEN 'DATE' WHEN w LIKE '$%' THEN 'MONEY'
               WHEN list_contains({list(extraction.COMPANY_WORDS)}, string_split(w, ' ')[-1]) THEN 'ORG' WHEN w LIKE '% %' THEN 'PER' ELSE 'MISC' END AS type FROM placed)
"""


@query(_TAGGED + """
SELECT doc_id, ord, w AS text, type, start_char, end_char, CASE type WHEN 'DATE' THEN 0.95 WHEN 'MONEY' THEN 0.9 WHEN 'ORG' THEN 0.85 ELSE 0.8 END::DOUBLE AS confidence,
       doc_id || '_entity_' || ord AS entity_id FROM typed WHERE type <> 'MISC'""")
def q_mentions(spark, d):
    found = extraction.mentions(table(spark, d, "documents").select("doc_id", "text")).drop("context")
    return found.withColumns({c: F.col(c).cast("long") for c in ("ord", "start_char", "end_char")})


@query("""
WITH spots AS (SELECT doc_id, text, strpos(lower(text), 'the') - 1 AS s FROM documents WHERE strpos(lower(text), 'the') > 0)
SELECT doc_id, trim(regexp_replace(substring(text, greatest(0, s - 50) + 1, s - greatest(0, s - 50)) || '[' || substring(text, s + 1, 3) || ']' ||
       substring(text, s + 4, least(length(text), s + 53) - s - 3), '\\s+', ' ', 'g')) AS context FROM spots""")
def q_context_window(spark, d):
    docs = table(spark, d, "documents").withColumn("s", F.instr(F.lower("text"), "the") - 1).where("s >= 0")
    return docs.select("doc_id", T.context_window(F.col("text"), F.col("s"), F.col("s") + 3).alias("context"))


@query("""
SELECT doc_id, i AS start_char, i + doc_id % 7 - 1 AS end_char, i >= 0 AND i + doc_id % 7 - 1 >= 0 AND doc_id % 7 - 1 > 0 AND i + doc_id % 7 - 1 <= length(text) AS valid
FROM (SELECT doc_id, text, doc_id % 400 - 5 AS i FROM documents)""")
def q_span_validity(spark, d):
    docs = table(spark, d, "documents").withColumn("start_char", F.col("doc_id") % 400 - 5).withColumn("end_char", F.col("start_char") + F.col("doc_id") % 7 - 1)
    return docs.select("doc_id", "start_char", "end_char", T.span_valid(F.col("start_char"), F.col("end_char"), F.length("text")).alias("valid"))


@query("""
WITH words AS (SELECT doc_id, i, w[i] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM (SELECT doc_id, string_split(text, ' ') AS w FROM documents))),
placed AS (SELECT *, coalesce(sum(length(word) + 1) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM words)
SELECT doc_id, count(*) AS n_tokens, CAST(sum(s) AS BIGINT) AS sum_of_starts, CAST(max(s) AS BIGINT) AS last_start FROM placed GROUP BY doc_id""")
def q_tokens_offsets(spark, d):
    rows = extraction.token_rows(table(spark, d, "documents").select("doc_id", "text"))
    return rows.groupBy("doc_id").agg(F.count("*").alias("n_tokens"), F.sum(F.col("start_char").cast("long")).alias("sum_of_starts"), F.max("start_char").cast("long").alias("last_start"))


@query("SELECT doc_id, md5(text) AS cache_key, len(string_split(text, ' ')) AS n_tokens, count(*) OVER (PARTITION BY md5(text)) AS shared FROM documents")
def q_cache_distinct(spark, d):
    """Work is done once per distinct text and joined back, as a result cache does."""
    docs = table(spark, d, "documents").select("doc_id", F.md5("text").alias("cache_key"), "text")
    once = docs.groupBy("cache_key").agg(F.max(F.size(T.tokens(F.col("text"))).cast("long")).alias("n_tokens"), F.count("*").alias("shared"))
    return docs.select("doc_id", "cache_key").join(once, "cache_key")


@query("""
WITH words AS (SELECT doc_id, string_split(text, ' ') AS w FROM documents),
cut AS (SELECT doc_id, w, unnest(range(0, CAST(ceil(greatest(len(w) - 256, 0) / 224.0) AS BIGINT) + 1)) AS chunk FROM words)
SELECT doc_id, chunk, chunk * 224 AS first_token, len(w[chunk * 224 + 1:chunk * 224 + 256]) AS n_tokens,
       CASE WHEN chunk = 0 THEN 0 ELSE length(array_to_string(w[1:chunk * 224], ' ')) + 1 END AS char_start, md5(array_to_string(w[chunk * 224 + 1:chunk * 224 + 256], ' ')) AS chunk_md5
FROM cut""")
def q_chunks(spark, d):
    rows = extraction.chunk_rows(table(spark, d, "documents").select("doc_id", "text"), size=256, overlap=32)
    return rows.select("doc_id", F.col("chunk").cast("long").alias("chunk"), "first_token", "n_tokens", "char_start", F.md5("chunk_text").alias("chunk_md5"))


@query(f"""
SELECT doc_id, md5('Extract the main events as JSON.' || chr(10) || 'Domain: ' || coalesce(CASE WHEN doc_id % 2 = 0 THEN 'economic_policy' END, 'any') || chr(10) ||
       'Types: {", ".join(extraction.EVENT_TYPES)}' || chr(10) || 'Roles: {", ".join(extraction.ROLES)}' || chr(10) || 'Context:' || chr(10) || 'Title: ' || source || chr(10) || 'Text:' || chr(10) || text) AS prompt_md5
FROM documents""")
def q_prompt(spark, d):
    none = F.lit(None).cast("string")
    context = T.context_string(F.col("source"), none, none, none, F.array().cast("array<string>"), F.array().cast("array<string>"))
    made = extraction.prompt(F.col("text"), F.when(F.col("doc_id") % 2 == 0, F.lit("economic_policy")), context)
    return table(spark, d, "documents").select("doc_id", F.md5(made).alias("prompt_md5"))


@query("""
SELECT event_id AS doc_id, event_id || '_event_0' AS event_id, 0 AS idx, event_type, 'k' AS trigger, 0 AS start_char, user_id AS end_char,
       CASE WHEN event_id % 4 = 0 THEN 'neutral' ELSE 'positive' END AS sentiment, CASE WHEN event_id % 4 = 0 THEN 'general' ELSE 'mixed' END AS domain,
       CASE WHEN event_id % 4 = 0 THEN 1.0 ELSE 0.5 END::DOUBLE AS confidence, CASE WHEN event_id % 4 = 0 THEN 1 ELSE 0 END AS n_arguments
FROM events WHERE event_id % 4 < 2""")
def q_parse_output(spark, d):
    """Fenced output, a bare list, prose without JSON, and a confidence out of range."""
    fenced = """concat('Here:\n```json\n{"events": [{"event_type": "', event_type, '", "trigger": {"text": "k", "start_char": 0, "end_char": ', user_id, '}, "arguments": [{"role": "agent"}, {"confidence": 7}]}]}\n``` done')"""
    bare = """concat('[{"event_type": "', event_type, '", "trigger": {"text": "k", "start_char": 0, "end_char": ', user_id, '}, "domain": "mixed", "metadata": {"confidence": 0.5, "sentiment": "positive"}}, 3]')"""
    wrong = """concat('{"events": [{"event_type": "', event_type, '", "trigger": {"text": "k"}, "metadata": {"confidence": 3}}]}')"""
    output = F.expr(f"CASE event_id % 4 WHEN 0 THEN {fenced} WHEN 1 THEN {bare} WHEN 2 THEN 'nothing found' ELSE {wrong} END")
    rows = table(spark, d, "events").select(F.col("event_id").alias("doc_id"), output.alias("output"), F.lit("general").alias("hint"))
    return extraction.parsed_events(rows, domain_col="hint").drop("arguments")


@query("""
SELECT event_id AS doc_id, 0 AS idx, 0 AS place, 'agent' AS role, 'u' || user_id AS text, 'PER' AS type, 0.5::DOUBLE AS confidence FROM events
UNION ALL SELECT event_id, 0, 1, 'unknown', event_type, 'MISC', 1.0::DOUBLE FROM events
UNION ALL SELECT event_id, 1, 0, 'place', '', 'LOC', 1.0::DOUBLE FROM events WHERE event_id % 2 = 0""")
def q_event_arguments(spark, d):
    """Roles, texts and types of arguments, flat or inside an entity, with defaults where keys are absent; one out of range."""
    first = """concat('{"event_type": "a", "trigger": {"text": "k"}, "arguments": [{"role": "agent", "text": "u', user_id, '", "type": "PER", "confidence": 0.5}, {"entity": {"text": "', event_type, '"}}, {"role": "time", "confidence": -1}]}')"""
    second = """CASE WHEN event_id % 2 = 0 THEN ', {"event_type": "b", "trigger": {"text": "k"}, "arguments": [{"role": "place", "type": "LOC"}]}' ELSE ', {"event_type": "b", "trigger": {"text": "k"}}' END"""
    rows = table(spark, d, "events").select(F.col("event_id").alias("doc_id"), F.expr(f"concat('[', {first}, {second}, ']')").alias("output"))
    told = extraction.parsed_events(rows).select("doc_id", "idx", F.posexplode("arguments").alias("place", "a"))
    return told.select("doc_id", "idx", F.col("place").cast("long").alias("place"), "a.*")


_EVENTS = "SELECT user_id AS doc_id, event_id AS ord, event_type, 'T' || event_id % 3 AS trigger, event_id * 7 % 350 AS start_char, value AS confidence FROM events"


@query(f"""
SELECT doc_id, ord, event_type, trigger, start_char FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id, event_type, lower(trigger), floor(start_char / 100) ORDER BY confidence DESC, ord) AS r FROM ({_EVENTS})) WHERE r = 1""")
def q_chunk_merge(spark, d):
    rows = table(spark, d, "events").selectExpr("user_id AS doc_id", "event_id AS ord", "event_type", "concat('T', event_id % 3) AS trigger", "event_id * 7 % 350 AS start_char", "value AS confidence")
    return extraction.merged_events(rows).drop("confidence")


@query("""
SELECT event_id, 'Event type: ' || event_type || ' | Trigger: k | agent: ' || user_id || CASE WHEN event_id % 2 = 0 THEN ' | Domain: ' || event_type ELSE '' END || ' | Sentiment: neutral' AS description FROM events""")
def q_event_description(spark, d):
    args = F.array(F.struct(F.lit("agent").alias("role"), F.col("user_id").cast("string").alias("text")))
    text = extraction.description(F.col("event_type"), F.lit("k"), args, F.when(F.col("event_id") % 2 == 0, F.col("event_type")), F.lit("neutral"))
    return table(spark, d, "events").select("event_id", text.alias("description"))


@query("""
WITH lines AS (SELECT doc_id, i - 1 AS line, string_split(l[i], ' ') AS w FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))),
cut AS (SELECT doc_id, line, g, w[g * 5 + 1:g * 5 + 5] AS w FROM (SELECT *, unnest(range(0, (len(w) + 4) // 5)) AS g FROM lines)),
pairs AS (SELECT doc_id, line, g, w[1] AS s, w[2] AS a, w[3] AS o, 3 AS oi FROM cut WHERE len(w) >= 3 UNION ALL SELECT doc_id, line, g, w[1], w[2], w[5], 5 FROM cut WHERE len(w) >= 5)
SELECT doc_id, line * 1000000 + g AS sent, s AS subject, a AS action, o AS object, round(0.8 - least(0.2, 0.2 * (1 + oi - 2) / 20) + 0.1 + CASE WHEN oi = 3 THEN 0.1 ELSE 0 END, 6)::DOUBLE AS confidence
FROM pairs WHERE s <> '' AND a <> '' AND o <> ''""")
def q_triplets(spark, d):
    """Each five words of a line are a sentence: the second is the verb, the first its subject, the third an object, the fifth one behind a preposition."""
    lines = table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line", "text"))
    words = lines.select("doc_id", "line", F.posexplode(F.split("text", " ", -1)).alias("at", "word"))
    p = F.pmod("at", F.lit(5))
    role = {0: ("NOUN", "nsubj", 2), 1: ("VERB", "ROOT", 2), 2: ("NOUN", "dobj", 2), 3: ("ADP", "prep", 2), 4: ("NOUN", "pobj", 4)}
    pick = lambda k: F.element_at(F.array(*[F.lit(v[k]) for v in role.values()]), p + 1)
    sent = F.col("line").cast("long") * 1_000_000 + F.floor(F.col("at") / 5)
    tokens = words.select("doc_id", sent.alias("sent"), (p + 1).alias("i"), "word", F.lit(0).alias("start_char"), pick(0).alias("pos"), pick(1).alias("dep"), pick(2).alias("head"))
    found = parsing.triplets(tokens)
    return found.select("doc_id", "sent", F.col("subject.text").alias("subject"), F.col("action.text").alias("action"), F.col("object.text").alias("object"), F.round("confidence", 6).alias("confidence"))


@query(ORACLES["q_chunks"])
def q_udtf_chunks(spark, d):
    """The same windows by the table function."""
    tables.register(spark)
    docs = table(spark, d, "documents").select("doc_id", "text")
    return spark.sql("SELECT doc_id, c.chunk, c.first_token, c.n_tokens, c.char_start, md5(c.chunk_text) AS chunk_md5 FROM {docs}, LATERAL narrata_chunks(text, 256, 32) AS c", docs=docs)


@query(ORACLES["q_chunk_merge"])
def q_udtf_merge(spark, d):
    """The same merge by the table function, a partition for each document."""
    tables.register(spark)
    rows = table(spark, d, "events").selectExpr("user_id AS doc_id", "event_id AS ord", "event_type", "concat('T', event_id % 3) AS trigger", "event_id * 7 % 350 AS start_char", "value AS confidence")
    return spark.sql("SELECT doc_id, ord, event_type, trigger, start_char FROM narrata_merged(TABLE({rows}) PARTITION BY doc_id ORDER BY ord)", rows=rows)


@query()
def q_parse(spark, d):
    """Tokens of all documents with part of speech, relation and head."""
    return parsing.token_table(parsing.parsed(table(spark, d, "documents").select("doc_id", "text")))


@query()
def q_document_triplets(spark, d):
    """Who did what to whom in all documents, from the parsed sentences."""
    found = parsing.triplets_in(parsing.parsed(table(spark, d, "documents").select("doc_id", "text")))
    return found.select("doc_id", "sent", F.col("subject.text").alias("subject"), F.col("action.text").alias("action"), F.col("object.text").alias("object"), F.round("confidence", 6).alias("confidence"))


@query("""
WITH names AS (SELECT DISTINCT p_brand, p_name FROM part), split AS (SELECT *, list_distinct(string_split(lower(p_name), ' ')) AS w FROM names),
held AS (SELECT p_brand, p_name, unnest(w) AS e FROM split),
met AS (SELECT DISTINCT a.p_brand, a.p_name AS x, b.p_name AS y FROM held a JOIN held b ON a.p_brand = b.p_brand AND a.e = b.e AND a.p_name < b.p_name)
SELECT m.p_brand, x, y, round(len(list_intersect(a.w, b.w)) / len(list_distinct(a.w || b.w)), 6)::DOUBLE AS jaccard, contains(lower(x), lower(y)) OR contains(lower(y), lower(x)) AS within
FROM met m JOIN split a ON a.p_brand = m.p_brand AND a.p_name = x JOIN split b ON b.p_brand = m.p_brand AND b.p_name = y""")
def q_entity_pairs(spark, d):
    """Different names of a brand that share a word, with the cheap tests of similarity."""
    names = table(spark, d, "part").select("p_brand", "p_name").distinct().withColumn("w", T.name_tokens(F.col("p_name")))
    held = names.select("p_brand", "p_name", "w", F.explode("w").alias("e"))
    met = held.alias("a").join(held.alias("b"), (F.col("a.p_brand") == F.col("b.p_brand")) & (F.col("a.e") == F.col("b.e")) & (F.col("a.p_name") < F.col("b.p_name")))
    x, y = T.normalised_name(F.col("a.p_name")), T.normalised_name(F.col("b.p_name"))
    rows = met.select(F.col("a.p_brand").alias("p_brand"), F.col("a.p_name").alias("x"), F.col("b.p_name").alias("y"), F.round(T.jaccard(F.col("a.w"), F.col("b.w")), 6).alias("jaccard"), T.substring_match(x, y).alias("within"))
    return rows.distinct()


def _brand_mentions(spark, d):
    part = table(spark, d, "part")
    brand = F.regexp_extract("p_brand", "([0-9]+)", 1).cast("long")
    return part.select(brand.alias("doc_id"), F.col("p_type").alias("type"), F.col("p_partkey").cast("int").alias("ord"), F.col("p_name").alias("text"), (F.col("p_size") / 100.0).alias("confidence"))


@query()
def q_entity_groups(spark, d):
    """Greedy ordered groups with Ratcliff-Obershelp similarity; no SQL can say that."""
    return resolution.resolved(_brand_mentions(spark, d))


@query("""
SELECT CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS BIGINT) AS doc_id, p_type AS type, p_partkey AS ord, p_name AS text,
       first_value(p_name) OVER (PARTITION BY p_brand, p_type ORDER BY length(p_name) DESC, p_size DESC, p_partkey) AS normalized_form FROM part""")
def q_canonical(spark, d):
    return resolution.canonical(_brand_mentions(spark, d), "doc_id", "type").drop("confidence").withColumn("ord", F.col("ord").cast("long"))


@query("""
SELECT item_id, CASE item_id % 6 WHEN 0 THEN 104857600 WHEN 1 THEN item_id * 1024 WHEN 2 THEN CAST(item_id * 1.5 * 1048576 AS BIGINT) WHEN 3 THEN item_id WHEN 4 THEN item_id * 1073741824 ELSE 104857600 END AS bytes FROM benchmark""")
def q_size_parse(spark, d):
    given = F.expr("CASE item_id % 6 WHEN 0 THEN '100MB' WHEN 1 THEN concat(item_id, ' kb') WHEN 2 THEN concat(CAST(item_id * 1.5 AS STRING), 'MB') WHEN 3 THEN concat(item_id, 'B') WHEN 4 THEN concat(item_id, 'GB') ELSE 'many' END")
    return table(spark, d, "benchmark").select("item_id", T.size_in_bytes(given).alias("bytes"))


@query("""
SELECT event_id, CASE event_id % 3 WHEN 0 THEN event_type || '.done' WHEN 1 THEN event_type ELSE 'x.' || event_type END AS routing_key FROM events""")
def q_routing_key(spark, d):
    kind = F.expr("CASE event_id % 3 WHEN 0 THEN concat('com.org.', event_type, '.done') WHEN 1 THEN event_type ELSE concat('a.x.', event_type) END")
    return table(spark, d, "events").select("event_id", T.routing_key(kind).alias("routing_key"))
