"""Push of keyed lookups into a store outside Spark, as a Python data source.

Every write is a run. A task stages its partition under (run, partition), replacing what an
earlier attempt of it left; only when all tasks are done does the driver publish the run, in
one step. Readers of the store see the published run, so a failed task or job leaves no half rows.

    spark.dataSource.register(KeyedStore)
    df.write.format("keyed_store").mode("append").options(store="package.module.Class", location=…, run=…).save()

A store class is made with its location and offers `stage(run, part, rows)`, `publish(run,
parts)` and `drop(run)`; all three may be repeated. Where it has `begin(run)`, that is called before a
run's tasks start. Rows are (key, value, expires_at).
"""

from __future__ import annotations

import importlib
import json
import os
import tempfile
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from datetime import datetime
from pathlib import Path

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

COLUMNS = ("key", "value", "expires_at")


class FileStore:
    """A store in a folder that all tasks see: a file per partition, a pointer to the published run."""

    def __init__(self, location: str) -> None:
        self.root = Path(location)

    def _dropped(self, run: str) -> Path:
        return self.root / "runs" / run / ".dropped"

    def begin(self, run: str) -> None:
        self._dropped(run).unlink(missing_ok=True)

    def _replace(self, path: Path, lines: Iterable[str], gone: Path | None = None) -> int:
        """Write a file that appears whole or not at all; not at all once there is a file `gone`."""
        path.parent.mkdir(parents=True, exist_ok=True)
        handle, name = tempfile.mkstemp(dir=path.parent, prefix=".part-")
        n = 0
        with os.fdopen(handle, "w", encoding="utf-8") as out:
            for n, line in enumerate(lines, 1):
                out.write(line + "\n")
        if gone and gone.exists():
            os.unlink(name)
            return n
        os.replace(name, path)
        if gone and gone.exists():
            path.unlink(missing_ok=True)
        return n

    def stage(self, run: str, part: int, rows: Iterator[tuple]) -> int:
        return self._replace(self.root / "runs" / run / f"{part}.jsonl", (
            json.dumps([key, value, None if expires is None else expires.isoformat()]) for key, value, expires in rows), self._dropped(run))

    def publish(self, run: str, parts: list[int]) -> None:
        self._replace(self.root / "published.json", [json.dumps({"run": run, "parts": sorted(parts)})])

    def drop(self, run: str) -> None:
        """Forget a run that was not published, also what tasks that still run would stage of it."""
        if self._published().get("run") != run:
            self._dropped(run).parent.mkdir(parents=True, exist_ok=True)
            self._dropped(run).touch()
            for file in (self.root / "runs" / run).glob("*.jsonl"):
                file.unlink(missing_ok=True)

    def _published(self) -> dict:
        pointer = self.root / "published.json"
        return json.loads(pointer.read_text()) if pointer.exists() else {"parts": []}

    def read(self, now: datetime) -> dict[str, str]:
        """Entries of the published run that have not expired."""
        out, published = {}, self._published()
        for part in published["parts"]:
            for line in (self.root / "runs" / published["run"] / f"{part}.jsonl").read_text().splitlines():
                key, value, expires = json.loads(line)
                if expires is None or datetime.fromisoformat(expires) > now:
                    out[key] = value
        return out


def open_store(name: str, location: str):
    module, _, cls = name.rpartition(".")
    return getattr(importlib.import_module(module), cls)(location)


@dataclass
class Staged(WriterCommitMessage):
    part: int
    rows: int


class KeyedWriter(DataSourceWriter):
    def __init__(self, options: dict[str, str], schema: StructType) -> None:
        missing = [o for o in ("store", "location", "run") if not options.get(o)]
        if missing or not set(COLUMNS) <= set(schema.names):
            raise ValueError(f"options {missing} or columns {sorted(set(COLUMNS) - set(schema.names))} are missing")
        self.name, self.location, self.run = options["store"], options["location"], options["run"]
        begin = getattr(open_store(self.name, self.location), "begin", None)
        if begin:
            begin(self.run)

    def write(self, iterator) -> Staged:
        part = TaskContext.get().partitionId()
        rows = ((r["key"], r["value"], r["expires_at"]) for r in iterator)
        return Staged(part, open_store(self.name, self.location).stage(self.run, part, rows))

    def commit(self, messages: list[Staged]) -> None:
        open_store(self.name, self.location).publish(self.run, [m.part for m in messages if m is not None])

    def abort(self, messages: list[Staged]) -> None:
        open_store(self.name, self.location).drop(self.run)


class KeyedStore(DataSource):
    """Registered as `keyed_store`; write-only."""

    @classmethod
    def name(cls) -> str:
        return "keyed_store"

    def schema(self) -> str:
        return "key string, value string, expires_at timestamp"

    def writer(self, schema: StructType, overwrite: bool) -> KeyedWriter:
        return KeyedWriter(self.options, schema)


def push_lookup(lookup: DataFrame, store: str, location: str, run: str) -> None:
    """Publish `lookup` (key, value, expires_at) as the store's content; a repeated run replaces itself."""
    lookup.sparkSession.dataSource.register(KeyedStore)
    lookup.select(*COLUMNS).write.format("keyed_store").mode("append").options(store=store, location=location, run=run).save()
