"""Table functions for SQL: windows of a text's tokens, the events in a model's output, and events of overlapping chunks merged.

``register(spark)`` makes them callable: ``SELECT doc_id, c.* FROM documents, LATERAL narrata_chunks(text, 256, 32) AS c`` and
``SELECT * FROM narrata_merged(TABLE(events) PARTITION BY doc_id ORDER BY ord)``. They are defined as ``chunk_rows``,
``first_json`` and ``merged_events`` are.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import Row, SparkSession
from pyspark.sql.functions import udtf

from narrata.functions.shipping import ship_package
from narrata.operators.extraction import first_json


class Chunks:
    def eval(self, text: str, size: int, overlap: int) -> Iterator[tuple]:
        if text is None:
            return
        words, at, step = text.split(" "), 0, size - overlap
        more = max(0, -(-(len(words) - size) // step))
        for chunk in range(more + 1):
            own = words[chunk * step : chunk * step + size]
            yield chunk, chunk * step, len(own), at, " ".join(own)
            at += sum(len(w) + 1 for w in words[chunk * step : (chunk + 1) * step])


class Events:
    def eval(self, output: str) -> Iterator[tuple]:
        found = first_json(output)
        for idx, event in enumerate(json.loads(found)["events"] if found else []):
            if isinstance(event, dict):
                trigger = event.get("trigger") if isinstance(event.get("trigger"), dict) else {}
                yield idx, event.get("event_type"), trigger.get("text"), json.dumps(event)


class Merged:
    """Rows of one document in their order; of a type, trigger and hundred characters the surest stays, the first on ties."""

    def __init__(self):
        self._best: dict[tuple, tuple] = {}

    def eval(self, row: Row) -> None:
        start = row["start_char"]
        key = row["event_type"], row["trigger"].lower() if row["trigger"] is not None else None, start // 100 if start is not None else None
        held = self._best.get(key)
        sure = row["confidence"] if row["confidence"] is not None else float("-inf")
        if held is None or sure > held[0]:
            self._best[key] = sure, (row["doc_id"], row["ord"], row["event_type"], row["trigger"], start, row["confidence"])

    def terminate(self) -> Iterator[tuple]:
        yield from (row for _, row in self._best.values())


def register(spark: SparkSession) -> None:
    ship_package(spark)
    spark.udtf.register("narrata_chunks", udtf(Chunks, returnType="chunk bigint, first_token bigint, n_tokens bigint, char_start bigint, chunk_text string"))
    spark.udtf.register("narrata_events", udtf(Events, returnType="idx bigint, event_type string, trigger string, event string"))
    spark.udtf.register("narrata_merged", udtf(Merged, returnType="doc_id bigint, ord bigint, event_type string, trigger string, start_char bigint, confidence double"))
