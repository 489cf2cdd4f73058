"""Objects (name, content) written to a store, all of a job's or none.

A task puts its objects aside under a name of its own attempt and lists them in a manifest, so that one that fails
midway, or runs twice, leaves nothing under any object's name. When all tasks are done the driver goes through the
manifests, one at a time, and moves each object to its name; a name is replaced as a whole, so a job that runs again
ends in the same objects. When a task fails for good, what the job has put aside goes. Of rows of one name, one
stays.

The store is given: `put(key, data)`, `get(key)`, `move(key, to)` (replacing), `drop(prefix)`; it must pickle.

    register(spark, store)
    objects.write.format("objects").mode("append").save()
"""

from __future__ import annotations

import json
import os
import shutil
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

ASIDE = "_aside"


class Store(Protocol):
    def put(self, key: str, data: bytes) -> None: ...

    def get(self, key: str) -> bytes: ...

    def move(self, key: str, to: str) -> None: ...

    def drop(self, prefix: str) -> None: ...


class FolderStore:
    """A folder that driver and executors share."""

    def __init__(self, root: str):
        self.root = root

    def _path(self, key: str) -> str:
        path = os.path.normpath(os.path.join(self.root, key))
        if os.path.commonpath([path, os.path.normpath(self.root)]) != os.path.normpath(self.root):
            raise ValueError(f"{key} is outside the store")
        return path

    def put(self, key: str, data: bytes) -> None:
        path = self._path(key)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "wb") as f:
            f.write(data)

    def get(self, key: str) -> bytes:
        with open(self._path(key), "rb") as f:
            return f.read()

    def move(self, key: str, to: str) -> None:
        os.makedirs(os.path.dirname(self._path(to)), exist_ok=True)
        os.replace(self._path(key), self._path(to))

    def drop(self, prefix: str) -> None:
        shutil.rmtree(self._path(prefix), ignore_errors=True)


@dataclass
class Put(WriterCommitMessage):
    """What a task has put aside: where its manifest is."""

    manifest: str


class _Writer(DataSourceWriter):
    def __init__(self, store: Store):
        self.store, self.job = store, f"{ASIDE}/{uuid.uuid4().hex}"

    def write(self, rows: Iterator[Row]) -> Put:
        attempt, names = f"{self.job}/{uuid.uuid4().hex}", []
        try:
            for i, r in enumerate(rows):
                if not r["name"] or r["name"].split("/")[0] == ASIDE:
                    raise ValueError(f"not an object's name: {r['name']!r}")
                self.store.put(f"{attempt}/{i}", bytes(r["content"]) if r["content"] is not None else b"")
                names.append(r["name"])
            self.store.put(f"{attempt}/manifest", json.dumps(names).encode())
        except BaseException:
            self.store.drop(attempt)
            raise
        return Put(f"{attempt}/manifest")

    def commit(self, messages: list[Put | None]) -> None:
        for m in messages:
            if m is not None:
                for i, name in enumerate(json.loads(self.store.get(m.manifest))):
                    self.store.move(f"{m.manifest.rsplit('/', 1)[0]}/{i}", name)
        self.store.drop(self.job)

    def abort(self, messages: list[Put | None]) -> None:
        self.store.drop(self.job)


def register(spark: SparkSession, store: Store, name: str = "objects") -> None:
    """Makes `name` a format that rows (name string, content binary) are written to; a null content is empty."""

    class Objects(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return "name string, content binary"

        def writer(self, schema, overwrite: bool) -> DataSourceWriter:
            return _Writer(store)

    spark.dataSource.register(Objects)
