"""Caches that expire, and figures of batches and streams."""

import time

import pytest
from pyspark.sql import functions as F

from narrata.operators.caches import Cache
from narrata.streaming import watching


def test_cache_computes_once_until_it_expires(spark, tmp_path):
    now, asked = [1_000_000.0], []

    def compute(rows):
        keys = sorted(r.k for r in rows.collect())
        asked.append(keys)
        return rows.select(F.col("k").alias("key"), F.concat(F.col("k"), F.lit(f"@{len(asked)}")).alias("value"))

    cache = Cache(spark, str(tmp_path / "cache"), 7200, clock=lambda: now[0])
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "id int, k string")
    through = lambda df: {r.id: r.v for r in cache.through(df, "k", compute, "string", "v").collect()}
    assert through(rows) == {1: "a@1", 2: "a@1", 3: "b@1", 4: None} and asked == [["a", "b"]]
    assert through(rows) == {1: "a@1", 2: "a@1", 3: "b@1", 4: None} and asked[-1] == []
    now[0] += 3000
    more = rows.unionByName(spark.createDataFrame([(5, "c")], "id int, k string"))
    assert through(more)[5] == "c@3" and asked[-1] == ["c"]
    now[0] += 5000  # a and b have expired, c has not
    assert through(more) == {1: "a@4", 2: "a@4", 3: "b@4", 4: None, 5: "c@3"} and asked[-1] == ["a", "b"]
    now[0] += 20_000
    cache.clear()
    assert not cache._hours() and cache.entries("string").count() == 0


def test_a_crash_leaves_no_entries(spark, tmp_path):
    def broken(rows):
        return rows.select(F.col("k").alias("key"), F.raise_error(F.lit("no model")).cast("string").alias("value"))

    cache = Cache(spark, str(tmp_path / "cache"), 60)
    rows = spark.createDataFrame([("a",)], "k string")
    with pytest.raises(Exception, match="no model"):
        cache.through(rows, "k", broken, "string", "v")
    whole = cache.through(rows, "k", lambda r: r.select(F.col("k").alias("key"), F.lit("x").alias("value")), "string", "v")
    assert [r.v for r in whole.collect()] == ["x"]


def test_counts_in_the_same_pass(spark, tmp_path):
    rows = spark.range(10).withColumn("k", F.col("id") % 3)
    seen = watching.counted(rows, lambda df: df.write.parquet(str(tmp_path / "a")), largest=F.max("id"))
    kept = watching.counted(rows.dropDuplicates(["k"]), lambda df: df.write.parquet(str(tmp_path / "b")))
    assert seen == {"rows": 10, "largest": 9} and watching.duplicates(seen, kept) == {"seen": 10, "written": 3, "prevented": 7}


def test_watch_a_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("x\ny\nx\n")
    watch = watching.Watch()
    spark.streams.addListener(watch)
    try:
        def go(fail):
            stream = spark.readStream.text(str(tmp_path / "in")).groupBy("value").count()
            sink = lambda rows, n: (_ for _ in ()).throw(RuntimeError("broken sink")) if fail else rows.count()
            query = stream.writeStream.queryName(f"q{fail}").foreachBatch(sink).outputMode("complete").option("checkpointLocation", str(tmp_path / f"s{fail}")).trigger(availableNow=True).start()
            try:
                query.awaitTermination()
            except Exception:  # noqa: BLE001 - the listener tells of it
                assert fail
            return str(query.id)

        good, bad = go(False), go(True)
        for _ in range(100):
            told = watch.figures()
            if told.get(good, {}).get("state") == "ended" and told.get(bad, {}).get("state") == "failed":
                break
            time.sleep(0.1)
        assert told[good]["rows"] == 3 and told[good]["in_state"] == 2 and told[good]["state"] == "ended"
        assert told[bad]["state"] == "failed" and "broken sink" in told[bad]["error"]
    finally:
        spark.streams.removeListener(watch)
