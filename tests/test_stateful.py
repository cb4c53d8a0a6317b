"""Jobs that wait for their documents and messages that wait for their next try, over restarts."""

import json
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from narrata.sources import brokers
from narrata.streaming import consumer, stateful


def put(folder, name, *messages):
    folder.mkdir(exist_ok=True)
    (folder / f".{name}").write_text("\n".join(m if isinstance(m, str) else json.dumps(m) for m in messages))
    (folder / f".{name}").rename(folder / name)


def document(job, i):
    return {"type": "document.cleaned", "id": f"{job}-{i}", "time": "2024-01-01T00:00:00Z", "data": {"job_id": job, "document_id": f"{job}-{i}", "text": f"text {i}"}}


def completed(job, n=None, ident=None):
    return {"type": "com.x.job.completed", "id": ident or f"{job}-done", "time": "2024-01-01T00:00:00Z", "data": {"job_id": job} | ({} if n is None else {"documents_processed": n})}


def test_a_job_runs_once_over_restarts(spark, tmp_path):
    """Documents before and after job.completed, a second job.completed, a crash inside the run, an empty job, a job that never ends."""
    came, ran, fail = tmp_path / "in", [], [True]

    def run(job, documents):
        rows = sorted(json.loads(r.data)["document_id"] for r in documents.collect())
        if job == "b" and fail[0]:
            raise RuntimeError("killed")
        ran.append((job, rows))

    def go(patience=600.0):
        messages = consumer.parsed(consumer.body_stream(spark, str(came))).where("error IS NULL")
        query = stateful.job_batches(messages, run, str(tmp_path / "landing"), str(tmp_path / "state"), patience=patience)
        query.awaitTermination()

    put(came, "1", document("a", 0), document("b", 0), completed("a", 2), document("d", 0))
    go()
    assert ran == []
    put(came, "2", document("a", 1), completed("b"), completed("c", 0), "not json")
    with pytest.raises(Exception, match="killed"):
        go()
    fail[0] = False
    go()
    put(came, "3", completed("a", 2, "again"), completed("b", None, "again too"))
    go()
    assert Counter(job for job, _ in ran if job == "b") == {"b": 1} and dict(ran) == {"a": ["a-0", "a-1"], "b": ["b-0"]}
    assert stateful.landed(spark, str(tmp_path / "landing")).count() == 4


def test_failed_messages_wait_while_others_pass(spark, tmp_path):
    """One message fails twice and then works, one always fails, over a restart; nothing is handled twice once done."""
    came, tries = tmp_path / "in", []
    put(came, "1", *({"type": "t", "id": x} for x in ("good", "shaky", "bad")), "no json", {"type": "t"})
    left = {"shaky": 2, "bad": 99}

    def handle(rows):
        out = []
        for r in rows.select("id").collect():
            tries.append((r.id, time.time()))
            left[r.id] = left.get(r.id, 0) - 1
            out.append((r.id, "not yet" if left[r.id] >= 0 else None))
        return spark.createDataFrame(out, "id string, error string")

    def start():
        return stateful.consume_with_back_off(consumer.body_stream(spark, str(came)), handle, str(tmp_path / "work"), retries=2, base=1.0, every="200 milliseconds")

    def until(ready, seconds=120):
        end = time.time() + seconds
        while not ready() and time.time() < end:
            if query.exception():
                raise query.exception()
            time.sleep(0.2)
        assert ready()

    def told(name, column):
        parts = [str(p) for p in (tmp_path / "work" / name).glob("batch=*") if (p / "_SUCCESS").exists()]
        return {r[0] for r in spark.read.parquet(*parts).select(column).collect()} if parts else set()

    query = start()
    until(lambda: sum(i == "shaky" for i, _ in tries) >= 1)
    put(came, "2", {"type": "t", "id": "later"}, {"type": "t", "id": "good"})
    until(lambda: {"good", "later"} <= told("done", "id"))
    query.stop()  # a micro-batch at work is done again after the restart
    before = len(tries)
    query = start()
    until(lambda: "shaky" in told("done", "id") and len(told("dead", "original_event")) == 3)
    query.stop()
    counts = Counter(i for i, _ in tries)
    assert counts["good"] == 1 and counts["shaky"] >= 3 and counts["bad"] >= 3 and not any(i in ("good", "later") for i, _ in tries[before:])
    at = [t for i, t in tries if i == "shaky"]
    assert at[1] - at[0] >= 1.0
    dead = spark.read.parquet(f"{tmp_path}/work/dead")
    assert sorted(r.error for r in dead.collect()) == ["no id", "no type", "not yet"] and dead.where(F.col("original_event").contains("bad")).count() == 1


def test_a_group_reads_partitions_in_tasks_and_claims_after_a_crash(spark, tmp_path):
    """Two partitions, a crash in the sink before the commit, then a restart; a partition that comes later; places are acknowledged."""
    from narrata.functions.shipping import ship_package

    ship_package(spark)
    spark.dataSource.register(brokers.Broker)
    broker = tmp_path / "broker"
    broker.mkdir()
    add = lambda name, *rows: (broker / name).open("a").write("".join(f"{r}\n" for r in rows))
    add("p0.lines", *(f"a{i}" for i in range(5)))
    add("p1.lines", *(f"b{i}" for i in range(3)))
    seen, tasks, fail = [], [], [True]

    def sink(rows, number):
        tasks.append(rows.rdd.getNumPartitions())
        got = [r.body for r in rows.collect()]
        if fail[0]:
            raise RuntimeError("killed")
        seen.extend(got)

    def go():
        source = spark.readStream.format("broker").option("client", "narrata.sources.brokers:FolderBroker").option("folder", str(broker)).option("group", "g").load()
        source.writeStream.foreachBatch(sink).option("checkpointLocation", str(tmp_path / "place")).trigger(availableNow=True).start().awaitTermination()

    with pytest.raises(Exception, match="killed"):
        go()
    fail[0] = False
    go()
    assert sorted(seen) == [f"a{i}" for i in range(5)] + [f"b{i}" for i in range(3)] and tasks[-1] == 2
    add("p1.lines", "b3")
    add("p2.lines", "c0", "c1")
    go()
    assert sorted(seen)[5:] == ["b0", "b1", "b2", "b3", "c0", "c1"] and len(seen) == len(set(seen)) == 11
    assert brokers.FolderBroker({"folder": str(broker), "group": "g"}).group()["p0.lines"] == 5
    again = brokers.GroupReader({"client": "narrata.sources.brokers:FolderBroker", "folder": str(broker), "group": "other"})
    assert [(s.name, s.start, s.end) for s in again.partitions(again.initialOffset(), again.latestOffset())] == [("p0.lines", 0, 5), ("p1.lines", 0, 4), ("p2.lines", 0, 2)]
