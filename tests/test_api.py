"""End to end: documents to storylines, batches, models' guards, brokers, settings, command line."""

import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from narrata import api, cli, settings
from narrata.operators import models
from narrata.sources import brokers

STORY = "Tim Cook met Angela Merkel in New York on 2024-01-02. Later Tim Cook left."


def documents(spark):
    rows = [("d1", STORY, "", "2024-01-02"), ("d2", "", "On Monday Tim Cook met Angela Merkel again.", "2024-01-03"), ("d3", None, None, None), ("", "text", None, None), ("d4", "Nothing here.", None, "soon")]
    return spark.createDataFrame(rows, "document_id string, cleaned_text string, original_text string, cleaned_publication_date string")


def test_documents_to_storylines(spark):
    out = api.run_documents(documents(spark))
    docs = {r.document_id: r for r in out["documents"].collect()}
    assert len(docs) == 5 and {k for k, r in docs.items() if r.valid} == {"d1", "d2", "d4"}
    assert [m.text for m in docs["d1"].entities] == ["Tim Cook", "Angela Merkel", "New York", "2024-01-02", "Later Tim Cook"]
    assert {m.normalized_form for m in docs["d1"].entities if "Cook" in m.text} == {"Later Tim Cook"}
    assert docs["d1"].processing_metadata.event_count == len(docs["d1"].events) > 0
    assert all(STORY[e.start_char : e.end_char] == e.trigger for e in docs["d1"].events)
    ids = {r.event_uid for r in out["events"].collect()}
    links = out["links"].collect()
    assert links and all(r.source_event_id in ids and r.similarity_score >= 0.75 for r in links)
    lines = out["storylines"].collect()
    assert lines and all(r.n_events >= 2 for r in lines)
    assigned = {e.storyline_id for r in docs.values() for e in r.events or [] if e.storyline_id}
    assert assigned == {r.storyline_id for r in lines}


def test_failing_links_leave_events(spark):
    def broken(texts):
        raise RuntimeError("no model")

    out = api.run_documents(documents(spark), embedder=broken)
    docs = {r.document_id: r for r in out["documents"].collect()}
    assert docs["d1"].events and all(e.storyline_id is None for e in docs["d1"].events)
    assert docs["d1"].preserved["document_id"] == "d1" and out["links"].count() == out["storylines"].count() == 0
    off = api.run_documents(documents(spark), settings.from_dict({"link_events": "false"}))
    assert off["events"].count() == out["events"].count() > 0 and off["storylines"].count() == 0


def test_batch_twice_changes_nothing(spark, tmp_path):
    docs = documents(spark).where("document_id <> ''")
    first = api.run_batch(spark, docs, str(tmp_path), "job-1", chunk_documents=2)
    assert (first["processed"], first["failed"], first["remaining"], first["state"]) == (3, 1, 0, "COMPLETED")
    n = spark.read.parquet(f"{tmp_path}/documents").count()
    api.run_batch(spark, docs, str(tmp_path), "job-1")
    assert spark.read.parquet(f"{tmp_path}/documents").count() == n == 4
    with pytest.raises(ValueError):
        api.run_batch(spark, docs.limit(0), str(tmp_path / "none"), "job-2")
    assert cli.main(["pause", str(tmp_path), "--job", "job-1"]) == 0
    assert api.job_status(spark, str(tmp_path), "job-1", 4)["state"] == "PAUSED"


RESULTS = ("documents", "mentions", "events", "triplets", "relations", "links", "storylines", "outbox")


def told(spark, folder, job):
    """What a job has written, without times and part names."""
    volatile = {"run", "time", "body", "job"}
    rows = {}
    for name in RESULTS:
        df = spark.read.parquet(f"{folder}/{name}/job={job}")
        rows[name] = sorted(str(r) for r in df.select(*sorted(set(df.columns) - volatile)).collect())
    return rows


def test_batch_survives_a_crash_after_each_write(spark, tmp_path, monkeypatch):
    """Null ids, repeated ids and texts; killed at the nth write of any table, then run again: the same as one whole run."""
    from pyspark.sql.readwriter import DataFrameWriter

    rows = [("d1", STORY), ("d2", "On Monday Tim Cook met Angela Merkel in New York on 2024-01-02."), ("d2", STORY), (None, "nameless"), (None, "nameless"), ("d3", " ")]
    docs = spark.createDataFrame(rows, "document_id string, text string")
    cut_down = settings.from_dict({"extraction": {"relations": []}})
    first = api.run_batch(spark, docs, str(tmp_path / "whole"), "j", cut_down)
    assert (first["processed"], first["failed"], first["remaining"]) == (2, 4, 0)
    want = told(spark, tmp_path / "whole", "j")
    assert len(want["documents"]) == len(rows) and want["links"] and want["storylines"] and want["triplets"]
    write = DataFrameWriter.parquet
    for nth in (9, 15):
        folder, calls = str(tmp_path / f"killed{nth}"), []

        def dying(self, path, *a, calls=calls, nth=nth, folder=folder, **k):
            if path.startswith(folder):
                calls.append(path)
                if len(calls) == nth:
                    raise KeyboardInterrupt
            return write(self, path, *a, **k)

        monkeypatch.setattr(DataFrameWriter, "parquet", dying)
        with pytest.raises(KeyboardInterrupt):
            api.run_batch(spark, docs, folder, "j", cut_down, chunk_documents=3)
        monkeypatch.setattr(DataFrameWriter, "parquet", write)
        api.run_batch(spark, docs, folder, "j", cut_down)
        assert told(spark, folder, "j") == want, calls[-1]


def test_parts_link_like_one_run(spark, tmp_path):
    """Events of documents in different parts, and of a run before, are linked; another job in the folder is left alone."""
    docs = documents(spark).where("document_id <> ''")
    api.run_batch(spark, docs, str(tmp_path / "one"), "j")
    api.run_batch(spark, docs, str(tmp_path / "parts"), "j", chunk_documents=2)
    api.run_batch(spark, docs.where("document_id = 'd1'"), str(tmp_path / "later"), "j")
    other = api.run_batch(spark, docs.where("document_id = 'd4'"), str(tmp_path / "later"), "k")
    api.run_batch(spark, docs, str(tmp_path / "later"), "j")
    one = told(spark, tmp_path / "one", "j")
    assert one["links"] and one == told(spark, tmp_path / "parts", "j") == told(spark, tmp_path / "later", "j")
    assert other["processed"] == 1 and len(told(spark, tmp_path / "later", "k")["documents"]) == 1
    names = {r.name for r in spark.read.parquet(f"{tmp_path}/parts/registry/registry_entities").collect()}
    assert "Angela Merkel" in names


def test_breaker():
    b = models.Breaker(limit=2, open_seconds=10)
    b = b.after(False, 0)
    assert b.state(0) == "closed"
    b = b.after(False, 1)
    assert b.state(5) == "open" and b.state(11) == "half-open"
    assert b.after(True, 12).state(12) == "closed" and b.after(False, 12).state(13) == "open"


def test_guarded_model_retries():
    waits, calls = [], []

    def model(x):
        calls.append(1)
        if len(calls) < 3:
            raise OSError
        return x

    assert models.guarded(model, wait=waits.append)(pd.Series(["a"])).tolist() == ["a"]
    assert waits == [2.0, 4.0] and models.back_off(9) == 60.0 and models.back_off(0, retry_after=7) == 7
    with pytest.raises(RuntimeError):
        models.guarded(model, breaker=models.Breaker(opened_at=0.0), clock=lambda: 1.0)(pd.Series(["a"]))


def test_cache_computes_once_per_text(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id int, text string")
    rows = models.cached(df, "text", F.upper, "u").collect()
    assert sorted((r.id, r.u) for r in rows) == [(1, "A"), (2, "A"), (3, "B")]


def feed(options, start, most):
    """A broker with five messages."""
    at = int(start)
    return [json.dumps({"type": "x", "id": str(i)}) for i in range(at, min(5, at + most))], str(min(5, at + most))


def test_broker_source(spark, tmp_path):
    reader = brokers.BrokerReader({"client": "test_api:feed", "batch": "2"})
    rows, after = reader.read(reader.initialOffset())
    assert len(list(rows)) == 2 and after == {"at": "2"} and len(list(reader.readBetweenOffsets({"at": "2"}, {"at": "5"}))) == 3
    assert "broker" in brokers.available()


def test_settings():
    s = settings.from_dict({"linking": {"threshold": 0.8}, "documents": {"text_fields": ["a", "b"]}})
    assert s.linking.threshold == 0.8 and s.documents.text_fields == ("a", "b") and s.calls.attempts == 3
    with pytest.raises(ValueError):
        settings.from_dict({"nope": 1})


def test_health():
    def broken():
        raise OSError("x")

    assert api.health({"a": lambda: True})["status"] == "healthy"
    assert api.health({"a": lambda: True, "b": broken}) == {"status": "degraded", "services": {"a": "ok", "b": "error: x"}}
