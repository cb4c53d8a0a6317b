"""Figures of running work: counts of a batch while it is written, and the progress of streams."""

from __future__ import annotations

import json
import threading
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener


def counted(rows: DataFrame, write: Callable[[DataFrame], None], **figures: Column) -> dict:
    """Write ``rows`` and count them, and ``figures`` (aggregates) of them, in the same pass."""
    seen = Observation()
    write(rows.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(name) for name, c in figures.items()]))
    return dict(seen.get)


def duplicates(seen: dict, kept: dict) -> dict:
    """What deduplication let through and what it prevented."""
    return {"seen": seen["rows"], "written": kept["rows"], "prevented": seen["rows"] - kept["rows"]}


class Watch(StreamingQueryListener):
    """The latest progress of each stream: micro-batch, rows read, rows a second, rows in state, lag behind the source in rows
    where it tells of that, and how it ended. Register it with ``spark.streams.addListener``."""

    def __init__(self):
        self._lock, self._told = threading.Lock(), {}

    def _note(self, ident: str, **figures) -> None:
        with self._lock:
            self._told.setdefault(ident, {"rows": 0, "batches": 0, "state": "running"}).update(figures)

    def onQueryStarted(self, event) -> None:
        self._note(str(event.id), name=event.name, state="running", error=None)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        with self._lock:
            before = self._told.get(str(p.id), {"rows": 0, "batches": 0})
        lag = [int(s.metrics["maxOffsetsBehindLatest"]) for s in p.sources if s.metrics and "maxOffsetsBehindLatest" in s.metrics]
        self._note(
            str(p.id), name=p.name, batch=p.batchId, rows=before["rows"] + (p.numInputRows or 0), batches=before["batches"] + 1, per_second=p.processedRowsPerSecond,
            in_state=sum(o.numRowsTotal for o in p.stateOperators), dropped_late=sum(o.numRowsDroppedByWatermark for o in p.stateOperators), lag=max(lag) if lag else None,
        )

    def onQueryIdle(self, event) -> None:
        self._note(str(event.id), state="idle")

    def onQueryTerminated(self, event) -> None:
        self._note(str(event.id), state="failed" if event.exception else "ended", error=event.exception)

    def figures(self) -> dict[str, dict]:
        with self._lock:
            return json.loads(json.dumps(self._told, default=str))
