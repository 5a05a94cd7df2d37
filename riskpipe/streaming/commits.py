"""Which loads of a table folder count: one small commit file for each.

A load writes its rows into folders ``load=<name>`` of a table, beside those of other loads, and
counts from the moment its commit file appears, which a rename makes in one step.  Readers
list the commit folder once and read only loads that count, so they see a load whole or not at
all, a load that failed half-way is never read, and no writer waits for another.

* ``add=<load>``: the load is added.  The name says everything; the file is empty.
* ``swap=<number>=<load>``: the load takes the place of those that the file lists, as a compaction
  or a repeated load does.  The file also lists the batches that were ever loaded into
  what it replaces, and batches whose rows in an older load no longer count.
* ``logged=<load>``: the load's changes were handed on (see ``ingest``).

A load's name is its batch id, with an attempt behind a dot where a batch was loaded again.
Names of folders and files are all that the driver reads, and the few swap files.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds; none if there is no such folder.  One metadata call."""
    p, fs = _fs(spark, path)
    return [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []


def batch_of(load: str) -> str:
    return load.split(".")[0]


@dataclass
class State:
    """What a commit folder says at one moment."""
    live: set[str] = field(default_factory=set)
    replaced: set[str] = field(default_factory=set)              # may still be read by those who resolved earlier
    batches: set[str] = field(default_factory=set)               # ever committed
    dropped: dict[str, set[str]] = field(default_factory=dict)   # of a live load, batches that count no longer
    logged: set[str] = field(default_factory=set)
    swaps: int = 0

    def counts(self) -> Column:
        """Condition on the columns ``load`` and ``batch_id`` of a table's rows."""
        out = F.col("load").isin(sorted(self.live))
        for load, batches in self.dropped.items():
            out = out & ~((F.col("load") == load) & F.col("batch_id").isin([int(b) for b in sorted(batches)]))
        return out


class Commits:
    """The commit folder of one table, or of tables that are published together."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _create(self, name: str, body: str = "") -> None:
        """Make a file appear with its contents, in one step."""
        hidden, fs = _fs(self.spark, f"{self.path}/_{uuid.uuid4().hex}")
        out = fs.create(hidden, True)
        if body:
            out.write(body.encode())
        out.close()
        final, _ = _fs(self.spark, f"{self.path}/{name}")
        if not fs.rename(hidden, final):
            fs.delete(hidden, False)
            if not fs.exists(final):
                raise OSError(f"could not commit {self.path}/{name}")

    def _read(self, name: str) -> dict:
        p, fs = _fs(self.spark, f"{self.path}/{name}")
        stream = fs.open(p)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def state(self) -> State:
        s = State()
        names = _names(self.spark, self.path)
        s.live = {n[4:] for n in names if n.startswith("add=")}
        s.logged = {n[7:] for n in names if n.startswith("logged=")}
        s.batches = {batch_of(x) for x in s.live}
        for name in sorted(n for n in names if n.startswith("swap=")):
            _, number, load = name.split("=", 2)
            body = self._read(name)
            s.swaps = int(number)
            s.replaced |= set(body["replaces"])
            s.batches |= set(body["batches"]) | {batch_of(load)}
            s.live.add(load)
            for of, batches in body["dropped"].items():
                s.dropped.setdefault(of, set()).update(batches)
        s.live -= s.replaced
        s.dropped = {of: b for of, b in s.dropped.items() if of in s.live}
        return s

    def add(self, load: str) -> None:
        self._create(f"add={load}")

    def swap(self, load: str, state: State, replaces: set[str], batches: set[str] = frozenset(), dropped: dict[str, set[str]] | None = None) -> None:
        """``load`` for ``replaces``.  ``state``: what the new load was made from; a swap since then is an error."""
        if self.state().swaps != state.swaps:
            raise RuntimeError(f"{self.path} was rewritten meanwhile; start again")
        body = {"replaces": sorted(replaces), "batches": sorted(batches), "dropped": {k: sorted(v) for k, v in (dropped or {}).items()}}
        self._create(f"swap={state.swaps + 1:012d}={load}", json.dumps(body))

    def log(self, load: str) -> None:
        self._create(f"logged={load}")


def remove(spark: SparkSession, table: str, loads: set[str], depth: int = 1) -> None:
    """Delete the folders of ``loads`` in a table whose folders ``load=`` lie ``depth`` levels down."""
    for name in _names(spark, table):
        if depth and "=" in name and not name.startswith("load="):
            remove(spark, f"{table}/{name}", loads, depth - 1)
        elif name.startswith("load=") and name[5:] in loads:
            p, fs = _fs(spark, f"{table}/{name}")
            fs.delete(p, True)


def read(spark: SparkSession, table: str, schema, state: State, buckets: list[int] | None = None) -> DataFrame | None:
    """Rows of the live loads of a table partitioned by (bucket, load), of some buckets' folders only if given.

    Only these folders are listed, so the listing grows with what is asked for, not with the table."""
    if not state.live:
        return None
    paths = [table]
    if buckets is not None:
        there = set(_names(spark, table))
        paths = [f"{table}/bucket={b}" for b in sorted(set(buckets)) if f"bucket={b}" in there]
        if not paths:
            return None
    return spark.read.schema(schema).option("basePath", table).parquet(*paths).where(state.counts())
