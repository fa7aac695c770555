"""Tables on shared storage that change together: data written aside, and a log of manifests that says what counts.

A commit writes its rows to folders of their own and then publishes a manifest, by creating the file of the next version, which
must not be there. Readers take the manifest of the last version. What was written aside by a run that was cut off is in no manifest, so
nobody sees it, and the run that comes after it neither jams nor doubles. Two writers race for one version: the loser looks
at what the winner did. It goes on if its own premises still hold (its batch is not in yet, and the parts it replaces are those it
read) and is void if not.

A table's rows are in entries: one folder each, either whole or by keys (its rows' date, load and so on). A key counts where it was
written last, so that a batch rewrites its own keys only. Keys are text and one directory each.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from portflow.sources.folders import create_if_absent, file_system, names_in, read_text

#: Manifests that stay behind the last one, for readers that still have theirs.
KEPT = 20


@dataclass(frozen=True)
class Staged:
    """Rows written aside. keys: None for a whole entry; owners: where each key was when it was read; replaces: whole entries that this one stands for."""

    table: str
    folder: str
    keys: tuple[str, ...] | None = None
    empty: tuple[str, ...] = ()
    owners: dict[str, str | None] = field(default_factory=dict)
    replaces: tuple[str, ...] = ()
    level: int = 0


class Manifest:
    """What counts at one version."""

    def __init__(self, version: int, tables: dict, batches: dict):
        self.version, self.tables, self.batches = version, tables, batches

    def entries(self, table: str) -> list[dict]:
        return self.tables.get(table, [])

    def owners(self, table: str) -> dict[str, tuple[str, bool]]:
        """Key -> (folder, whether it has rows)."""
        return {k: (e["folder"], rows) for e in self.entries(table) for name, rows in (("keys", True), ("empty", False)) for k in e.get(name) or ()}

    def has(self, stream: str, batch: int) -> bool:
        return any(low <= batch <= high for low, high in self.batches.get(stream, []))

    def with_batch(self, stream: str, batch: int) -> dict:
        """Batches as ranges, so that a stream whose batches come in order takes one range."""
        ranges: list[list[int]] = []
        for low, high in sorted([*self.batches.get(stream, []), [batch, batch]]):
            if ranges and low <= ranges[-1][1] + 1:
                ranges[-1][1] = max(high, ranges[-1][1])
            else:
                ranges.append([low, high])
        return self.batches | {stream: ranges}

    def after(self, staged: Iterable[Staged]) -> dict | None:
        """The tables with what is staged, or None if a premise no longer holds."""
        tables = dict(self.tables)
        for s in staged:
            entries = tables.get(s.table, [])
            if s.keys is None:
                if not set(s.replaces) <= {e["folder"] for e in entries}:
                    return None
                entries = [e for e in entries if e["folder"] not in s.replaces]
                tables[s.table] = [*entries, {"folder": s.folder, "level": s.level}]
                continue
            now = Manifest(0, tables, {}).owners(s.table)
            if any((now[k][0] if k in now else None) != owner for k, owner in s.owners.items()):
                return None
            mine = {*s.keys, *s.empty}
            rest = [{**e, **{n: [k for k in e.get(n) or () if k not in mine] for n in ("keys", "empty")}} for e in entries]
            tables[s.table] = [e for e in rest if e["keys"] or e["empty"]] + [{"folder": s.folder, "keys": list(s.keys), "empty": list(s.empty)}]
        return tables


class Store:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # ------------------------------------------------------------ manifests

    def manifest(self) -> Manifest:
        while True:
            names = [n for n in names_in(self.spark, f"{self.path}/log") if n.endswith(".json") and n[0] not in "._"]
            if not names:
                return Manifest(0, {}, {})
            text = read_text(self.spark, f"{self.path}/log/{max(names)}")
            if text is not None:  # else it went between the list and the look
                found = json.loads(text)
                return Manifest(found["version"], found["tables"], found["batches"])

    def publish(self, staged: Iterable[Staged], stream: str | None = None, batch: int | None = None) -> bool:
        """Whether it counts now. False: the batch counted before, or a premise fell."""
        staged = list(staged)
        while True:
            now = self.manifest()
            there = {e["folder"] for entries in now.tables.values() for e in entries}
            if staged and {s.folder for s in staged} <= there:  # published by a call whose answer was lost
                return True
            if stream is not None and now.has(stream, batch):
                return False
            tables = now.after(staged)
            if tables is None:
                return False
            batches = now.batches if stream is None else now.with_batch(stream, batch)
            text = json.dumps({"version": now.version + 1, "tables": tables, "batches": batches})
            if create_if_absent(self.spark, f"{self.path}/log/{now.version + 1:020d}.json", text):
                return True

    def vacuum(self, kept: int = KEPT) -> int:
        """Removes manifests before the last `kept` and the folders that none of these names, those of writers at work too: for quiet hours. Tells how many folders went."""
        fs, log = file_system(self.spark, f"{self.path}/log")
        names = sorted(n for n in names_in(self.spark, f"{self.path}/log") if n.endswith(".json"))
        live: set[str] = set()
        for n in names[-kept:]:
            live |= {e["folder"] for entries in json.loads(read_text(self.spark, f"{self.path}/log/{n}"))["tables"].values() for e in entries}
        for n in names[:-kept]:
            fs.delete(file_system(self.spark, f"{self.path}/log/{n}")[1], False)
        dead = [n for n in names_in(self.spark, f"{self.path}/data", folders=True) if n.startswith("w=") and n[2:] not in live]
        for n in dead:
            fs.delete(file_system(self.spark, f"{self.path}/data/{n}")[1], True)
        return len(dead)

    # ------------------------------------------------------------ rows

    def stage(self, table: str, rows: DataFrame, key: Column | None = None, owners: dict[str, str | None] | None = None, asked: Iterable[str] = (), replaces: Iterable[str] = (), level: int = 0) -> Staged:
        """Writes rows aside, by key if there is one. owners: premises on keys; asked: keys that this entry answers for, with rows or without."""
        folder = uuid.uuid4().hex
        target = f"{self.path}/data/w={folder}"
        if key is None:
            rows.write.parquet(target)
            return Staged(table, folder, replaces=tuple(replaces), level=level)
        rows.withColumn("key", key).hint("rebalance", "key").write.partitionBy("key").parquet(target)  # a key of many rows is split, small ones share a task
        keys = tuple(sorted(n[4:] for n in names_in(self.spark, target, folders=True) if n.startswith("key=")))
        return Staged(table, folder, keys, tuple(sorted(set(asked) - set(keys))), owners or {})

    @contextmanager
    def aside(self, rows: DataFrame) -> Iterator[DataFrame]:
        """rows written once for a step that reads them several times, and removed after it: they are in no manifest, and those of a lost driver go with `vacuum`."""
        path = f"{self.path}/data/w={uuid.uuid4().hex}"
        try:
            rows.write.parquet(path)
            yield self.spark.read.schema(rows.schema).parquet(path)
        finally:
            fs, folder = file_system(self.spark, path)
            fs.delete(folder, True)

    def read(self, table: str, schema: str, manifest: Manifest | None = None, keys: Iterable[str] | None = None, folders: Iterable[str] | None = None) -> DataFrame:
        """A table's rows; of some keys or entries only, if these are given: other directories are not even listed."""
        m = manifest or self.manifest()
        asked, data = None if keys is None else set(keys), f"{self.path}/data"
        whole = [e["folder"] for e in m.entries(table) if "keys" not in e and (folders is None or e["folder"] in folders)] if keys is None else []
        paths = [f"{data}/w={f}" for f in whole] + [f"{data}/w={f}/key={k}" for k, (f, rows) in sorted(m.owners(table).items()) if rows and (asked is None or k in asked)]
        if not paths:
            return self.spark.createDataFrame([], schema)
        found = self.spark.read.schema(f"{schema}, w string, key string").option("basePath", data).parquet(*paths)
        return found.drop("w", "key")

    # ------------------------------------------------------------ tiers

    def merge_tiers(self, table: str, schema: str, fanout: int = 4, merged: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> int:
        """Whole entries merged as they gather: `fanout` of one level become one of the next, so that n appends leave at most (fanout - 1) * log(n) entries.

        merged: what becomes of the rows of several entries (duplicates that no reader tells apart may go). Readers see the old entries or the
        new one. Returns the number of merges.
        """
        done = 0
        while True:
            m = self.manifest()
            levels: dict[int, list[str]] = {}
            for e in m.entries(table):
                if "keys" not in e:
                    levels.setdefault(e["level"], []).append(e["folder"])
            full = next((k for k in sorted(levels) if len(levels[k]) >= fanout), None)
            if full is None:
                return done
            some = levels[full][:fanout]
            rows = merged(self.read(table, schema, m, folders=some))
            done += self.publish([self.stage(table, rows, replaces=some, level=full + 1)])
