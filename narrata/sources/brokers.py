"""Message brokers without a Spark connector as Python data sources: Redis streams, NATS, RabbitMQ, or any reader.

A client is a function (options, start, most) -> (rows, next) that returns message bodies after an offset; it is imported
where it runs, so nothing here needs a broker's library. Offsets live in Spark's streaming checkpoint: what a failed batch
read is read again, which is how pending messages are claimed.
"""

from __future__ import annotations

import importlib
import json
from itertools import islice
from pathlib import Path

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, DataSourceStreamWriter, InputPartition, SimpleDataSourceStreamReader, WriterCommitMessage

BODY = "body string"


def _client(options: dict):
    module, _, name = options["client"].rpartition(":")
    return getattr(importlib.import_module(module), name)


class BrokerReader(SimpleDataSourceStreamReader):
    def __init__(self, options: dict):
        self.options, self.most = options, int(options.get("batch", "10"))

    def initialOffset(self) -> dict:
        return {"at": self.options.get("start", "0")}

    def read(self, start: dict):
        rows, after = _client(self.options)(self.options, start["at"], self.most)
        return iter([(row,) for row in rows]), {"at": after}

    def readBetweenOffsets(self, start: dict, end: dict):
        rows, at = [], start["at"]
        while at != end["at"]:
            found, after = _client(self.options)(self.options, at, self.most)
            rows += [(row,) for row in found]
            if after == at:
                break
            at = after
        return iter(rows)


class Slice(InputPartition):
    def __init__(self, name: str, start: int, end: int):
        self.name, self.start, self.end = name, start, end


class GroupReader(DataSourceStreamReader):
    """A consumer group: each partition of the broker is read where a task runs, from the group's place to the end known.

    The client is a class made from the options with ``partitions() -> names``, ``group() -> {name: place}``, ``ends() -> {name:
    place}``, ``read(name, start, end) -> bodies`` and ``ack({name: place})``. The group's place moves when Spark has committed a
    micro-batch; what a consumer that died had read and not acknowledged lies before Spark's committed offset or after the
    group's place, and either way the next one reads it again: that is its claim.
    """

    def __init__(self, options: dict):
        self.options, self.client = options, None

    def _broker(self):
        if self.client is None:
            self.client = _client(self.options)(self.options)
        return self.client

    def __getstate__(self):
        return {"options": self.options, "client": None}  # connections stay where they are opened

    def initialOffset(self) -> dict:
        return self._broker().group()

    def latestOffset(self) -> dict:
        return self._broker().ends()

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        first = self._broker().group()  # of partitions that are new since
        spans = [Slice(name, start.get(name, first.get(name, 0)), stop) for name, stop in sorted(end.items())]
        return [s for s in spans if s.start < s.end]

    def read(self, partition: Slice):
        for body in self._broker().read(partition.name, partition.start, partition.end):
            yield (body,)

    def commit(self, end: dict) -> None:
        self._broker().ack(end)


class FolderBroker:
    """Partitions as files of lines in a shared folder, a place as a number of lines; the group's places in a file beside them."""

    def __init__(self, options: dict):
        self.folder, self.places = Path(options["folder"]), Path(options["folder"]) / f".{options.get('group', 'narrata')}.json"

    def partitions(self) -> list[str]:
        return sorted(p.name for p in self.folder.glob("*.lines"))

    def ends(self) -> dict[str, int]:
        return {name: sum(1 for _ in (self.folder / name).open(encoding="utf-8")) for name in self.partitions()}

    def group(self) -> dict[str, int]:
        known = json.loads(self.places.read_text()) if self.places.exists() else {}
        return {name: known.get(name, 0) for name in self.partitions()}

    def read(self, name: str, start: int, end: int):
        with (self.folder / name).open(encoding="utf-8") as lines:
            for line in islice(lines, start, end):
                yield line.rstrip("\n")

    def ack(self, end: dict[str, int]) -> None:
        places = self.group() | end
        fresh = self.places.with_suffix(".new")
        fresh.write_text(json.dumps(places))
        fresh.replace(self.places)


class BrokerWriter(DataSourceStreamWriter):
    def __init__(self, options: dict):
        self.options = options

    def write(self, rows) -> WriterCommitMessage:
        send = _client(self.options)
        for row in rows:
            send(self.options, row["body"])
        return WriterCommitMessage()


class Broker(DataSource):
    """``readStream.format("broker").option("client", "module:function")``; the same for ``writeStream`` with a sending function.

    With an option ``group`` the client is a class (see ``GroupReader``) and partitions are read in parallel.
    """

    @classmethod
    def name(cls) -> str:
        return "broker"

    def schema(self) -> str:
        return BODY

    def streamReader(self, schema) -> GroupReader:
        if "group" not in self.options:
            raise NotImplementedError  # Spark then asks for the simple reader
        return GroupReader(dict(self.options))

    def simpleStreamReader(self, schema) -> BrokerReader:
        return BrokerReader(dict(self.options))

    def streamWriter(self, schema, overwrite: bool) -> BrokerWriter:
        return BrokerWriter(dict(self.options))


def redis_stream(options: dict, start: str, most: int) -> tuple[list[str], str]:
    """Bodies after an id of a Redis stream. Needs the redis library."""
    import redis

    found = redis.from_url(options["url"]).xread({options["stream"]: start}, count=most)
    entries = found[0][1] if found else []
    return [fields[b"data"].decode() for _, fields in entries], entries[-1][0].decode() if entries else start


SOURCES = {"jsonl": "files.json_lines", "job files": "files.files_of_job", "jdbc": "files.jdbc_rows", "memory": "files.in_memory", "null": "files.nothing", "broker": "brokers.Broker", "kafka": "consumer.kafka_stream", "landing folder": "consumer.body_stream"}


def available() -> list[str]:
    return sorted(SOURCES)
