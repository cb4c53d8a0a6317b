"""Column helpers and operators on small tables, with the cases that are easy to get wrong."""

import datetime as dt
import difflib
import json
import math
import os
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from narrata import api, settings
from narrata.functions import text as T
from narrata.functions import vectors as V
from narrata.operators import cutting, extraction, jobs, linking, metrics, parsing, resolution
from narrata.sources import files, sinks
from narrata.streaming import consumer


def one(spark, column, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()] or [F.lit(1).alias("x")]).select(column.alias("c")).first()["c"]


@pytest.mark.parametrize("raw, want", [("B-PERSON", "PER"), ("I-ORGANIZATION", "ORG"), ("LOCATION", "LOC"), ("GPE", "GPE"), ("percent", "MONEY"), ("B-I-misc", "MISC"), ("thing", "THING")])
def test_entity_type(spark, raw, want):
    assert one(spark, T.entity_type(F.lit(raw))) == want


@pytest.mark.parametrize("start, end, length, ok", [(0, 10, 100, True), (50, 60, 100, True), (-1, 10, 100, False), (0, -5, 100, False), (10, 5, 100, False), (5, 5, 100, False), (0, 150, 100, False)])
def test_span_valid(spark, start, end, length, ok):
    assert one(spark, T.span_valid(F.lit(start), F.lit(end), F.lit(length))) is ok


@pytest.mark.parametrize("given, want", [("100MB", 104857600), ("1 kb", 1024), ("7B", 7), ("2GB", 2 << 30), ("a lot", 104857600), ("", 104857600)])
def test_size(spark, given, want):
    assert one(spark, T.size_in_bytes(F.lit(given))) == want


def test_dates(spark):
    assert one(spark, T.normalised_date(F.lit("2024-03-05"))) == "2024-03-05T00:00:00"
    assert one(spark, T.normalised_date(F.lit("2024-03-05T10:00:00Z"))) == "2024-03-05T10:00:00Z"
    assert one(spark, T.normalised_date(F.lit("yesterday"))) == "yesterday"
    assert one(spark, T.normalised_date(F.lit(None).cast("string"))) is None


def test_days_round_down_before_the_sign_goes(spark):
    a, b = F.lit("2024-01-01 01:00:00").cast("timestamp"), F.lit("2024-01-01 00:00:00").cast("timestamp")
    assert one(spark, V.whole_days(a, b)) == 1
    assert one(spark, V.whole_days(b, a)) == 0
    assert one(spark, V.temporal_proximity(a, F.lit(None).cast("timestamp"))) == 0.5


def test_jaccard_and_names(spark):
    assert one(spark, T.jaccard(T.name_tokens(F.lit("Joe Biden")), T.name_tokens(F.lit("biden, J.")))) == pytest.approx(1 / 3)
    assert one(spark, T.jaccard(F.array().cast("array<string>"), F.array(F.lit("x")))) == 0.0
    assert one(spark, T.substring_match(F.lit(""), F.lit("x"))) is True


def test_context_window(spark):
    assert one(spark, T.context_window(F.lit("aa bb  cc"), F.lit(3), F.lit(5), 2)) == "a [bb]"


def test_chunks_cover_all_tokens(spark):
    docs = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(1000))), (2, ""), (3, "one")], "doc_id long, text string")
    rows = extraction.chunk_rows(docs, size=100, overlap=20).collect()
    long = sorted((r for r in rows if r.doc_id == 1), key=lambda r: r.chunk)
    assert [r.first_token for r in long] == [80 * i for i in range(len(long))]
    assert long[-1].first_token + long[-1].n_tokens == 1000
    text = " ".join(f"w{i}" for i in range(1000))
    assert all(text[r.char_start :].startswith(r.chunk_text) for r in long)
    assert len([r for r in rows if r.doc_id in (2, 3)]) == 2


def test_table_functions(spark):
    """Null and empty outputs, events that are no objects; windows at their edges."""
    from narrata.functions import tables

    tables.register(spark)
    outputs = [(1, '```json\n{"events": [{"event_type": "a", "trigger": {"text": "k"}}, 3, {"trigger": "x"}]}\n```'), (2, None), (3, ""), (4, "no"), (5, "[]")]
    df = spark.createDataFrame(outputs, "id int, output string")
    rows = spark.sql("SELECT id, e.idx, e.event_type, e.trigger FROM {df}, LATERAL narrata_events(output) AS e", df=df).collect()
    assert sorted(map(tuple, rows), key=str) == [(1, 0, "a", "k"), (1, 2, None, None)]
    texts = spark.createDataFrame([(1, "a b c d e"), (2, ""), (3, None), (4, "a  b")], "doc_id long, text string")
    sql = spark.sql("SELECT doc_id, c.* FROM {texts}, LATERAL narrata_chunks(text, 3, 1) AS c", texts=texts).collect()
    own = extraction.chunk_rows(texts.where("text IS NOT NULL"), size=3, overlap=1).selectExpr("doc_id", "cast(chunk AS long)", "first_token", "n_tokens", "char_start", "chunk_text").collect()
    assert sorted(map(tuple, sql)) == sorted(map(tuple, own)) and len(sql) == 4


def test_first_json():
    assert extraction.first_json('x ```json\n{"events": [1]}\n``` y {"z": 2}') == '{"events": [1]}'
    assert extraction.first_json("[1, 2] tail") == '{"events": [1, 2]}'
    assert extraction.first_json("{broken") is None and extraction.first_json("") is None and extraction.first_json(None) is None


def test_mentions_number_the_taggers_own_output(spark):
    docs = spark.createDataFrame([(1, "Today Tim Cook of Acme Corp paid $5 on 2024-01-02.")], "doc_id long, text string")
    rows = {r.text: r for r in extraction.mentions(docs).collect()}
    assert {k: v.type for k, v in rows.items()} == {"Today Tim Cook": "PER", "Acme Corp": "ORG", "$5": "MONEY", "2024-01-02": "DATE"}
    assert rows["$5"].entity_id == "1_entity_2"
    assert all("Today Tim Cook of Acme Corp paid $5 on 2024-01-02."[r.start_char : r.end_char] == r.text for r in rows.values())


def test_triplets_take_all_subjects_with_all_objects(spark):
    tokens = [(1, 0, 0, "Ann", 0, "PROPN", "nsubj", 1), (1, 0, 1, "met", 4, "VERB", "ROOT", 1), (1, 0, 2, "Bob", 8, "PROPN", "dobj", 1), (1, 0, 3, "in", 12, "ADP", "prep", 1), (1, 0, 4, "Rome", 15, "PROPN", "pobj", 3)]
    rows = parsing.triplets(spark.createDataFrame(tokens, "doc_id long, sent int, i int, word string, start_char int, pos string, dep string, head int")).collect()
    assert sorted((r.subject.text, r.object.text) for r in rows) == [("Ann", "Bob"), ("Ann", "Rome")]
    assert all(r.confidence >= 0.7 for r in rows)


def test_similar_names_by_letters():
    """The bounds before the letters' ratio never change what is similar."""
    rng = np.random.default_rng(9)
    names = ["".join(rng.choice(list("abcde "), rng.integers(1, 14))) for _ in range(120)]
    names += [n[:-1] + "x" for n in names[:60]]
    plain = lambda a, b: difflib.SequenceMatcher(None, " ".join(b.lower().split()), " ".join(a.lower().split())).ratio() >= resolution.LEAST_RATIO
    for a in names:
        for b in names:
            assert resolution.similar(a, b) or not plain(a, b)
            x, y = (" ".join(s.split()) for s in (a, b))
            if resolution.similar(a, b) and x and y and not (x in y or y in x):
                words = set(a.split()), set(b.split())
                assert plain(a, b) or len(words[0] & words[1]) / len(words[0] | words[1]) >= resolution.LEAST_JACCARD


def test_grouping_is_no_transitive_closure():
    assert resolution.grouped(["Joe Biden", "Smith", "Joe Biden Smith", "Smith"]) == [0, 1, 0, 0]
    assert resolution.grouped(["President Biden", "Biden", "Trump", "Apple", "Apple Inc"]) == [0, 0, 1, 2, 2]
    assert difflib.SequenceMatcher(None, "tide", "diet").ratio() != difflib.SequenceMatcher(None, "diet", "tide").ratio()


def test_canonical_is_longest_then_surest_then_first(spark):
    rows = [(1, "PER", 0, "Biden", 0.9), (1, "PER", 1, "Joe Biden", 0.8), (1, "PER", 2, "joe biden", 0.8), (1, "ORG", 3, "Acme", 0.9)]
    found = resolution.resolved(spark.createDataFrame(rows, "doc_id long, type string, ord int, text string, confidence double")).collect()
    assert {r.normalized_form for r in found if r.type == "PER"} == {"Joe Biden"}


def test_average_linkage_cuts_strictly():
    s = np.array([[0, 0.9, 0.2], [0.9, 0, 0.2], [0.2, 0.2, 0]])
    assert linking.average_linkage(s, 0.75).tolist() == [0, 0, 2]
    assert linking.average_linkage(np.array([[0, 0.75], [0.75, 0]]), 0.75).tolist() == [0, 1]


def test_general_weights_use_domain_blocks(spark):
    t = datetime(2024, 1, 1)
    rows = [(1, 1, "a", t, [1.0, 0.0], ["x"]), (2, 2, "a", t, [1.0, 0.0], ["y"]), (3, 3, None, t, [1.0, 0.0], ["z"]), (4, 4, "b", t, [1.0, 0.0], ["y"])]
    events = spark.createDataFrame(rows, "event_id long, ord long, domain string, ts timestamp, embedding array<double>, signatures array<string>")
    w = linking.Weights(semantic=0.7, entity=0.0, temporal=0.2, domain=0.1, threshold=0.9)
    pairs = sorted((r.source_event_id, r.target_event_id) for r in linking.links(events, w).collect())
    assert pairs == [(1, 2), (1, 3), (2, 3), (3, 4)]


def test_upserts(spark):
    old = spark.createDataFrame([(1, "a", "x", 1), (2, "b", "y", 1)], "id long, p string, q string, seq int")
    new = spark.createDataFrame([(2, "B", "Y", 2), (3, "c", "z", 2), (2, "BB", "YY", 3)], "id long, p string, q string, seq int")
    assert sorted(tuple(r) for r in jobs.upsert(old, new, "id").collect()) == [(1, "a", "x", 1), (2, "BB", "YY", 3), (3, "c", "z", 2)]
    assert sorted(tuple(r)[:3] for r in jobs.upsert(old, new, "id", ["p"]).collect()) == [(1, "a", "x"), (2, "BB", "y"), (3, "c", "z")]


def test_batch_can_be_resumed(spark, tmp_path):
    docs = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "document_id string")
    batch = jobs.Batch(spark, str(tmp_path / "log"), "job1")
    batch.start()
    batch.record(docs.where("document_id = 'a'"), "processed")
    batch.record(docs.where("document_id = 'a'"), "processed")
    batch.record(docs.where("document_id = 'b'"), "failed")
    assert batch.progress(4) == {"processed": 1, "failed": 1, "remaining": 2, "percent": 50.0, "state": "RUNNING"}
    assert sorted(str(r[0]) for r in batch.remaining(docs).collect()) == ["None", "c"]
    batch.pause()
    assert batch.state() == "PAUSED"


def test_order_within_a_hot_key(spark):
    """One key holds most rows and spans several ranges; ties, null keys and null values; against plain Python."""
    from narrata.operators import ranges

    rng = np.random.default_rng(8)
    rows = [(("hot", "b", None)[0 if i % 10 else i // 10 % 3], int(rng.integers(0, 90)), i) for i in range(1000)]
    df = spark.createDataFrame(rows, "k string, v int, i int").repartition(5)
    of = {k: sorted((v, i) for x, v, i in rows if x == k) for k in ("hot", "b", None)}
    got = {(r.k, r.i): r._before for r in ranges.before(df, "k", "v", "v", "i").collect()}
    assert got == {(k, i): (own[n - 1][0] if n else None) for k, own in of.items() for n, (_, i) in enumerate(own)}
    for rank, want in ((F.floor(F.col("n") / 2) + 1, lambda own: own[len(own) // 2][0]), (F.lit(1), lambda own: own[0][0]), (F.col("n"), lambda own: own[-1][0])):
        assert {r.k: r.v for r in ranges.nth(df, "k", "v", rank).collect()} == {k: want(own) for k, own in of.items()}
    assert ranges.dealt(df, "k", "v").select("_range").distinct().count() > 2 and ranges.nth(df.limit(0), "k", "v", F.lit(1)).count() == 0


def test_upper_median(spark):
    rows = [("a", i, datetime(2024, 1, 1, 0, 0, s)) for i, s in enumerate((0, 1, 3, 7, 15))]
    found = metrics.intervals(spark.createDataFrame(rows, "k string, event_id int, ts timestamp"), "k").first()
    assert (found.n_gaps, found.upper_median, found.least, found.most) == (4, 4.0, 1.0, 8.0)


def test_files_end_at_their_first_bad_line(spark, tmp_path, monkeypatch):
    """Each file by itself, in blocks of several tasks; blank lines, arrays and bare values; a file that is bad from the start."""
    want = set()
    for f in range(6):
        lines = [json.dumps({"document_id": f"{f}-{i}", "cleaned_text": "x" * 50}) for i in range(2000)]
        stop = [2000, 1999, 700, 0, 1, 1500][f]
        if stop < 2000:
            lines[stop] = ["", "{broken", "[1]", "nothing", "7", '{"document_id": "x"'][f]
        lines[10:10] = ["", "  "]
        (tmp_path / f"{f}.jsonl").write_text("\n".join(lines))
        want |= {f"{f}-{i}" for i in range(stop)}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        got = [r.document_id for r in files.until_first_bad(spark, str(tmp_path)).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(got) == len(set(got)) and set(got) == want


def test_scoped_tables_go(spark, tmp_path):
    with cutting.scope(spark):
        held = cutting.cut(spark.range(5))
        paths = held.inputFiles()
        with cutting.scope(spark):
            inner = cutting.cut(spark.range(3)).inputFiles()
        assert held.count() == 5 and not any(os.path.exists(p.removeprefix("file://")) for p in inner)
    assert paths and not any(os.path.exists(p.removeprefix("file://")) for p in paths)
    old = tmp_path / "narrata-old"
    old.mkdir()
    os.utime(old, (0, 0))
    (tmp_path / "narrata-new").mkdir()
    cutting._remove_stale(spark, str(tmp_path))
    assert [p.name for p in tmp_path.iterdir()] == ["narrata-new"]


def test_json_lines(spark, tmp_path):
    path = tmp_path / "processed_1.jsonl"
    path.write_text('{"document_id": "1", "job_id": "j"}\n\n{"document_id": "2", "job_id": "k"}\n{"document_id": "3"}\n')
    assert files.json_lines(spark, str(path)).count() == 3
    assert sorted(r.document_id for r in files.files_of_job(spark, str(tmp_path), "j").collect()) == ["1", "3"]
    (tmp_path / "bad.jsonl").write_text('{"document_id": "1"}\n{oops\n')
    with pytest.raises(Exception):
        files.json_lines(spark, str(tmp_path / "bad.jsonl")).collect()
    good, bad = files.json_lines_lenient(spark, str(tmp_path / "bad.jsonl"))
    assert (good.count(), bad.count()) == (1, 1)


def test_sinks_fail_alone(spark, tmp_path):
    df = spark.range(3)

    def broken(_):
        raise RuntimeError("no")

    result = sinks.fan_out(df, {"jsonl": lambda x: sinks.write_json_lines(x, str(tmp_path / "out"), compression="gzip"), "broken": broken})
    assert result["jsonl"] is None and "no" in result["broken"] and sinks.accepted(result)
    assert spark.read.json(str(tmp_path / "out")).count() == 3
    sinks.upsert_table(spark, str(tmp_path / "t"), df.selectExpr("id", "'a' AS v", "1 AS seq"), "id")
    sinks.upsert_table(spark, str(tmp_path / "t"), df.selectExpr("id + 2 AS id", "'b' AS v", "2 AS seq"), "id")
    assert sorted((r.id, r.v) for r in sinks.current_table(spark, str(tmp_path / "t")).collect()) == [(0, "a"), (1, "a"), (2, "b"), (3, "b"), (4, "b")]


def test_signature():
    given = consumer.signature(b"key", b"body")
    assert consumer.signature_ok(b"key", b"body", "sha256=" + given) and not consumer.signature_ok(b"key", b"body!", given) and not consumer.signature_ok(b"key", b"body", None)


def test_repeated_ids_stay_apart(spark):
    """Two rows of one id: each text's mentions at its own places."""
    docs = spark.createDataFrame([(1, "on 2024-01-02 Ann Lee paid $5"), (1, "x Ann Lee")], "doc_id long, text string")
    got = sorted((r.text, r.start_char, r.context) for r in extraction.mentions(docs).collect())
    assert got == [("$5", 27, "on 2024-01-02 Ann Lee paid [$5]"), ("2024-01-02", 3, "on [2024-01-02] Ann Lee paid $5"), ("Ann Lee", 2, "x [Ann Lee]"), ("Ann Lee", 14, "on 2024-01-02 [Ann Lee] paid $5")]
    assert "Exchange" not in extraction.mentions(docs)._jdf.queryExecution().executedPlan().toString()


def test_token_starts(spark):
    """Running sums over token lengths, at sizes round powers of two."""
    texts = [" ".join("w" * (i % 5) for i in range(n)) for n in (0, 1, 255, 256, 257, 1000)] + ["", " ", "a  b", "\U0001f600 x"]
    rows = extraction.token_rows(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for i, text in enumerate(texts):
        own = sorted((r.i, r.word, r.start_char) for r in rows if r.doc_id == i)
        assert [w for _, w, _ in own] == text.split(" ") and all(text[at : at + len(w)] == w for _, w, at in own)


def test_route_of_one_part(spark):
    rows = spark.createDataFrame([("document", "{}"), ("", "{}"), (None, None), ("com.document.processed", "{}")], "kind string, data string")
    assert [r.r for r in rows.select(consumer.route(F.col("kind"), F.col("data")).alias("r")).collect()][:3] == ["ignored"] * 3


def test_upsert_survives_a_crash(spark, tmp_path):
    """A version without its commit marker doesn't count."""
    folder = str(tmp_path / "t")
    sinks.upsert_table(spark, folder, spark.sql("SELECT 1 AS id, 'a' AS v, 1 AS seq"), "id")
    spark.sql("SELECT 7 AS id, 'half' AS v, 1 AS seq").write.parquet(f"{folder}/v=2")
    (tmp_path / "t" / "v=2" / "_SUCCESS").unlink()
    assert [tuple(r) for r in sinks.current_table(spark, folder).collect()] == [(1, "a", 1)]
    for k in range(3):
        sinks.upsert_table(spark, folder, spark.sql(f"SELECT {k} AS id, 'b' AS v, 2 AS seq"), "id")
    assert sorted(map(tuple, sinks.current_table(spark, folder).collect())) == [(0, "b", 2), (1, "b", 2), (2, "b", 2)]
    assert sinks.current_table(spark, str(tmp_path / "none")) is None


def test_status_of_a_job_that_never_started(spark, tmp_path):
    assert api.job_status(spark, str(tmp_path), "none", 3) is None


def test_settings_from_file(tmp_path):
    path = tmp_path / "s.json"
    path.write_text('{"documents": {"max_batch": "${BATCH:7}"}, "linking": {"threshold": "${T}"}}')
    read = settings.from_file(str(path), {"T": "0.5"})
    assert read.documents.max_batch == 7 and read.linking.threshold == 0.5


def by_pairs(rows, w):
    """All pairs scored by hand: (id, domain, time or None, vector, signatures)."""
    out = set()
    for x in rows:
        for y in rows:
            if x[0] < y[0] and (not x[1] or not y[1] or x[1] == y[1]):
                cos = float(np.dot(x[3], y[3]) / (np.linalg.norm(x[3]) * np.linalg.norm(y[3])))
                a, b = set(x[4]), set(y[4])
                j = len(a & b) / len(a | b) if a and b else 0.0
                t = 0.5 if x[2] is None or y[2] is None else math.exp(-abs((y[2] - x[2]).days) / w.decay_days)
                d = 1.0 if x[1] and y[1] else 0.5
                if w.semantic * cos + w.entity * j + w.temporal * t + w.domain * d >= w.threshold:
                    out.add((x[0], y[0]))
    return out


@pytest.mark.parametrize("w", [linking.Weights(), linking.Weights(threshold=0.62), linking.Weights(entity=0.1, temporal=0.4), linking.Weights(semantic=0.3, temporal=0.3)])
def test_links_against_all_pairs(spark, w):
    """Shared and partly shared signatures, near and far in time, without times or domains: no link is lost or invented."""
    rng = np.random.default_rng(3)
    start = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(150):
        own = [f"s{x}" for x in rng.integers(0, 6, rng.integers(0, 4))]
        when = None if i % 11 == 0 else start + dt.timedelta(hours=int(rng.integers(0, 24 * 20)))
        rows.append((i, (None, "", "a", "b")[int(rng.integers(0, 4))] if i % 3 == 0 else "a", when, [float(x) for x in np.abs(rng.standard_normal(4))], own))
    df = spark.createDataFrame(rows, "event_id long, domain string, ts timestamp, embedding array<double>, signatures array<string>").withColumn("ord", F.col("event_id"))
    found = linking.links(df, w)
    assert {(r.source_event_id, r.target_event_id) for r in found.collect()} == by_pairs(rows, w) and found.count() == len(by_pairs(rows, w))
    assert "CartesianProduct" not in found._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("few", [0, linking.FEW])
def test_no_pair_moves(spark, monkeypatch, few):
    """Repeated embeddings, sets that share some signatures, times that are missing: links by hand; what is shuffled are events, never pairs."""
    monkeypatch.setattr(linking, "FEW", few)
    rng, start = np.random.default_rng(5), dt.datetime(2024, 1, 1)
    turn = [[float(i == k) + 0.3 * (k == 0) for i in range(6)] for k in range(6)]
    rows = [(i, "a", None if i % 13 == 0 else start + dt.timedelta(hours=int(rng.integers(0, 24 * 9))), turn[i % 6], [f"s{x}" for x in rng.integers(0, 5, 1 + i % 3)]) for i in range(160)]
    df = spark.createDataFrame(rows, "event_id long, domain string, ts timestamp, embedding array<double>, signatures array<string>").withColumn("ord", F.col("event_id"))
    w, before = linking.Weights(threshold=0.72), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = linking.links(df, w)
        plan = [(len(x) - len(x.lstrip(" :+-")), x) for x in found._jdf.queryExecution().executedPlan().toString().split("\n")]
        assert sorted((r.source_event_id, r.target_event_id) for r in found.collect()) == sorted(by_pairs(rows, w))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    for k, (depth, line) in enumerate(plan):
        below = next((j for j in range(k + 1, len(plan)) if plan[j][0] <= depth), len(plan))
        assert "Exchange hashpartitioning" not in line or not any("SortMergeJoin" in x for _, x in plan[k + 1 : below])
    assert any("SortMergeJoin" in x for _, x in plan)


def test_average_linkage_as_all_pairs():
    rng = np.random.default_rng(4)
    for n in (2, 5, 20, 40):
        s = rng.random((n, n))
        s = (s + s.T) / 2
        groups = [[i] for i in range(n)]
        while len(groups) > 1:
            mean, i, j = max((np.mean([s[x, y] for x in groups[i] for y in groups[j]]), -i, -j) for i in range(len(groups)) for j in range(i + 1, len(groups)))
            if mean <= 0.55:
                break
            groups[-i] += groups.pop(-j)
        label = linking.average_linkage(s, 0.55)
        assert sorted(map(sorted, groups)) == sorted([int(x) for x in np.flatnonzero(label == g)] for g in set(label))


def test_storylines_of_many_components(spark):
    """Complete components, chains and mixed ones, over batches of a few rows: as average linkage of each component alone, without a call of Python for each."""
    rng, w, start = np.random.default_rng(6), linking.Weights(), dt.datetime(2024, 1, 1)
    rows = [(i, "a", start + dt.timedelta(hours=int(rng.integers(0, 100))), [float(x) for x in rng.standard_normal(3) + 2 * (i % 5 < 3)], [f"s{i % 30}"]) for i in range(240)]
    df = spark.createDataFrame(rows, "event_id long, domain string, ts timestamp, embedding array<double>, signatures array<string>").withColumn("ord", -F.col("event_id"))
    found = linking.links(df, w)
    parts = df.join(linking.named_components(found), "event_id").toPandas().groupby("component")
    links, told = {(r.source_event_id, r.target_event_id) for r in found.collect()}, {}
    complete = [sum(a in set(g["event_id"]) for a, _ in links) == len(g) * (len(g) - 1) // 2 for _, g in parts]
    assert any(complete) and not all(complete)
    for _, group in parts:
        told |= dict(linking._cluster(w)(group).itertuples(index=False))
    sizes = {c: list(told.values()).count(c) for c in told.values()}
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "5")
    try:
        members = linking.storyline_members(df, found, w)
        assert sorted((r.event_id, r.cluster) for r in members.collect()) == sorted((e, c) for e, c in told.items() if sizes[c] >= 2)
        assert "FlatMapGroupsInPandas" not in members._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, before)


def test_processed_ids_count_for_a_day(spark, tmp_path):
    body = '{"type": "document.cleaned", "id": "%s"}'
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("\n".join(body % i for i in ("old", "new", "next")))
    done = spark.sql("SELECT 'old' AS id, current_timestamp() - INTERVAL 25 HOURS AS at UNION ALL SELECT 'new', current_timestamp() - INTERVAL 23 HOURS")
    done.withColumn("day", F.to_date("at")).write.partitionBy("day").parquet(str(tmp_path / "done"))
    handle = lambda rows: rows.select("id", F.lit(None).cast("string").alias("error"))
    consumer.consume(consumer.body_stream(spark, str(tmp_path / "in")), handle, str(tmp_path / "done"), str(tmp_path / "dead"), str(tmp_path / "state")).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "done")).collect()) == ["new", "next", "old", "old"]
