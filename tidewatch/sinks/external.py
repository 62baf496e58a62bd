"""Writer for keyed stores outside Spark (K4, K5): a Python data source.

``df.write.format("keyed_put")`` and ``writeStream.format("keyed_put")`` put
``(key, value)`` rows from the executors: one client per partition, batches of
``batch_size`` puts (the reference used 500), nothing through the driver but a
short message per task.  The client works in two phases.  A task stages its
puts under a name of its own; when all tasks of a batch are done the driver
publishes exactly the names it was told, and drops them if the batch fails.  A
task that is killed and repeated leaves a staged name that nobody publishes, and
a batch that is committed already is not published twice.

``FileClient`` is such a client over a mounted folder.  A key-value service or a
search index takes its place by ``client=package.module:Class``.
"""
from __future__ import annotations

import importlib
import json
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage

BATCH_SIZE = 500


class FileClient:
    """Puts as JSON lines in a folder all machines have mounted (``path``)."""

    def __init__(self, options: dict[str, str]):
        self.path = options["path"].removeprefix("file:")

    def open(self) -> str:
        os.makedirs(f"{self.path}/staged", exist_ok=True)
        self.name = uuid.uuid4().hex
        self.out = open(f"{self.path}/staged/{self.name}", "w", encoding="utf-8")
        return self.name

    def put(self, rows: list[dict]) -> None:
        self.out.write("".join(json.dumps(r) + "\n" for r in rows))

    def close(self) -> None:
        self.out.flush()
        os.fsync(self.out.fileno())
        self.out.close()

    def publish(self, batch: str, names: list[str]) -> None:
        """All of a batch's names by one link, which fails if the batch is there."""
        os.makedirs(f"{self.path}/batches", exist_ok=True)
        draft = f"{self.path}/staged/{uuid.uuid4().hex}"
        with open(draft, "w", encoding="utf-8") as f:
            json.dump(names, f)
        try:
            os.link(draft, f"{self.path}/batches/{batch}")
        except FileExistsError:
            self.drop(names)  # a replay of a committed batch
        finally:
            os.remove(draft)

    def drop(self, names: list[str]) -> None:
        for n in names:
            if os.path.exists(f"{self.path}/staged/{n}"):
                os.remove(f"{self.path}/staged/{n}")

    def rows(self) -> Iterator[tuple[int, dict]]:
        """(batch, put) of the published batches, oldest first; later puts of a key win."""
        folder = f"{self.path}/batches"
        for b in sorted(os.listdir(folder), key=int) if os.path.isdir(folder) else []:
            with open(f"{folder}/{b}", encoding="utf-8") as f:
                names = json.load(f)
            for n in names:
                with open(f"{self.path}/staged/{n}", encoding="utf-8") as f:
                    for line in f:
                        yield int(b), json.loads(line)


@dataclass
class Staged(WriterCommitMessage):
    name: str
    rows: int


def _client(options: dict[str, str]):
    module, _, name = options.get("client", f"{__name__}:FileClient").partition(":")
    return getattr(importlib.import_module(module), name)(options)


class _Puts:
    def __init__(self, options: dict[str, str]):
        self.options = dict(options)

    def write(self, iterator: Iterator) -> Staged:
        client, size = _client(self.options), int(self.options.get("batch_size", BATCH_SIZE))
        name, n, buffer = client.open(), 0, []
        try:
            for row in iterator:
                buffer.append(row.asDict(recursive=True))
                if len(buffer) == size:
                    client.put(buffer)
                    n, buffer = n + len(buffer), []
            if buffer:
                client.put(buffer)
            client.close()
        except BaseException:
            client.drop([name])
            raise
        return Staged(name, n + len(buffer))

    def _publish(self, messages: list[Staged | None], batch: str) -> None:
        _client(self.options).publish(batch, [m.name for m in messages if m is not None and m.rows])

    def _drop(self, messages: list[Staged | None]) -> None:
        _client(self.options).drop([m.name for m in messages if m is not None])


class PutWriter(_Puts, DataSourceWriter):
    def commit(self, messages):
        self._publish(messages, self.options.get("batch", "0"))

    def abort(self, messages):
        self._drop(messages)


class PutStreamWriter(_Puts, DataSourceStreamWriter):
    def commit(self, messages, batchId):
        self._publish(messages, str(batchId))

    def abort(self, messages, batchId):
        self._drop(messages)


class KeyedPut(DataSource):
    """Options: path (of ``FileClient``), client, batch_size, and for a batch write the batch's number."""

    @classmethod
    def name(cls) -> str:
        return "keyed_put"

    def writer(self, schema, overwrite):
        return PutWriter(self.options)

    def streamWriter(self, schema, overwrite):
        return PutStreamWriter(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(KeyedPut)


def read_puts(spark: SparkSession, path: str) -> DataFrame:
    """(batch, key, value) of the published batches of ``FileClient``, as a frame:
    staged files join the batch that names them; others are not read."""
    path = path.rstrip("/")
    named = (spark.read.text(f"{path}/batches", wholetext=True)
             .select(F.regexp_extract("_metadata.file_path", "([^/]+)$", 1).cast("long").alias("batch"),
                     F.explode(F.from_json("value", "array<string>")).alias("name")))
    puts = (spark.read.schema("key string, value string").json(f"{path}/staged")
            .select("key", "value", F.regexp_extract("_metadata.file_path", "([^/]+)$", 1).alias("name")))
    return puts.join(named, "name").select("batch", "key", "value")
