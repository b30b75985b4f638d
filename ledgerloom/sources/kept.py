"""Kept tables: readers see whole committed states, and a merge rewrites only the buckets that its source touches.

Rows lie in buckets by a hash of the table's keys, one folder per run and bucket. A state (a marker of ``commits``) names the
folders of each bucket. Whatever changes the table writes new folders beside the old ones and then commits a state; so a plan
may read the table that it replaces, readers keep the state they began with, and an aborted run leaves files that no state
names. Writers do not lock: who finds that another run has committed takes the next number, after computing its part again
if the other run changed a bucket that it had read."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.sources.commits import CommitConflict, Commits
from ledgerloom.sources.durable import CODEC
from ledgerloom.sources.schemas import empty

BUCKET = "_bucket"
Change = Callable[[DataFrame], DataFrame]


class KeptTable:
    """A table in a folder. ``schema``, ``keys`` and ``buckets`` are given when it is made, later they are read from its state.

    ``buckets`` should make a bucket some hundred MB: a source of few keys then rewrites few of them. Without keys all rows
    are one bucket, and the table can be replaced and appended to."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | None = None, keys: Sequence[str] = (), buckets: int = 64, attempts: int = 8) -> None:
        self.spark, self.path, self.attempts = spark, path.rstrip("/"), attempts
        self.commits = Commits(spark, f"{self.path}/states")
        n, state = self.state()
        if state:
            self.keys, self.buckets = state["keys"], state["buckets"]
        else:
            self.keys, self.buckets = list(keys), buckets if keys else 1
        self._new = {"schema": schema.jsonValue() if schema else None, "keys": self.keys, "buckets": self.buckets, "parts": {}}

    # --- states -----------------------------------------------------------------------------

    def state(self) -> tuple[int, dict]:
        n = self.commits.newest()
        return n, self.commits.read(n)

    def _known(self) -> tuple[int, dict]:
        n, state = self.state()
        return n, state or self._new

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int") if self.keys else F.lit(0)

    def folders(self, buckets: Iterable[int] | None = None) -> list[str]:
        """The folders of the current state, or of some buckets of it."""
        parts = self._known()[1]["parts"]
        chosen = parts if buckets is None else [str(b) for b in buckets]
        return [f"{self.path}/{run}/{BUCKET}={b}" for b in chosen for run in parts.get(b, [])]

    def _rows(self, state: dict, buckets: Iterable[int] | None = None) -> DataFrame:
        if state["schema"] is None:
            raise ValueError(f"{self.path} has no rows yet and was given no schema")
        schema = T.StructType.fromJson(state["schema"])
        chosen = state["parts"] if buckets is None else [str(b) for b in buckets]
        places = [f"{self.path}/{run}/{BUCKET}={b}" for b in chosen for run in state["parts"].get(b, [])]
        return self.spark.read.schema(schema).parquet(*places) if places else empty(self.spark, schema)

    def read(self, n: int | None = None) -> DataFrame:
        """The rows of the current state, or of an earlier one."""
        return self._rows(self._known()[1] if n is None else self.commits.read(n) or self._new)

    # --- changes ----------------------------------------------------------------------------

    def _write(self, rows: DataFrame) -> tuple[str, set[str]]:
        """Store rows under a new name; the name and the buckets that got rows. Rebalancing keeps files of a bucket few and
        splits a bucket that is too large for a task."""
        run = f"rows-{uuid.uuid4()}"
        rows.withColumn(BUCKET, self.bucket()).hint("rebalance", BUCKET).write.option("compression", CODEC).partitionBy(BUCKET).parquet(f"{self.path}/{run}")
        jvm = self.spark._jvm
        folder = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{run}")
        names = (s.getPath().getName() for s in folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(folder))
        return run, {x.partition("=")[2] for x in names if x.startswith(f"{BUCKET}=")}

    def replace(self, rows: DataFrame | Change) -> int:
        """Make ``rows`` the whole table, or what a function makes of the current rows. The new schema may differ but
        must have the keys. Returns the number of the state."""
        for _ in range(self.attempts):
            n, state = self._known()
            new = rows(self._rows(state)) if callable(rows) else rows
            if not set(self.keys) <= set(new.columns):
                raise ValueError(f"the rows lack the table's keys {self.keys}")
            run, written = self._write(new)
            if self.commits.take(n + 1, {**state, "schema": new.schema.jsonValue(), "parts": {b: [run] for b in sorted(written)}}):
                return n + 1
        raise CommitConflict(self.path)

    def append(self, rows: DataFrame) -> int:
        """Add rows (columns by name, in the table's types). Appends do not get in each other's way."""
        n, state = self._known()
        schema = T.StructType.fromJson(state["schema"]) if state["schema"] else rows.schema
        run, written = self._write(rows.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields]))
        for _ in range(self.attempts):
            parts = {b: [*state["parts"].get(b, []), *([run] if b in written else [])] for b in {*state["parts"], *written}}
            if self.commits.take(n + 1, {**state, "schema": schema.jsonValue(), "parts": parts}):
                return n + 1
            n, state = self._known()
        raise CommitConflict(self.path)

    def merge(self, keys: DataFrame, change: Change) -> int:
        """Change the rows of the buckets that ``keys`` (the table's key columns of a source) fall into.

        ``change`` gets the rows of these buckets and returns all that they hold afterwards. Other buckets are neither read
        nor written. One number per touched bucket goes to the driver."""
        if not self.keys:
            raise ValueError("a merge needs a table with keys")
        for _ in range(self.attempts):
            n, state = self._known()
            types = {f.name: f.dataType for f in T.StructType.fromJson(state["schema"]).fields}
            typed = keys.select(*[F.col(k).cast(types[k]).alias(k) for k in self.keys])
            touched = sorted(str(r["b"]) for r in typed.select(self.bucket().alias("b")).distinct().collect())
            if not touched:
                return n
            run, written = self._write(change(self._rows(state, touched)))
            if not written <= set(touched):
                raise ValueError("a merge may return only rows whose keys are in the touched buckets")
            before = {b: state["parts"].get(b, []) for b in touched}
            while all(state["parts"].get(b, []) == before[b] for b in touched):
                parts = {**state["parts"], **{b: [run] if b in written else [] for b in touched}}
                if self.commits.take(n + 1, {**state, "parts": {b: runs for b, runs in parts.items() if runs}}):
                    return n + 1
                n, state = self._known()  # another run was first; if it changed other buckets, ours still hold
        raise CommitConflict(self.path)


class NumberRange:
    """Persistent numbering: the greatest number given out is a committed mark, and each load reserves its own range above
    it. So no load looks through its target for the greatest key, and loads at the same time get different numbers."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.commits = Commits(spark, path)

    def greatest(self) -> int:
        return self.commits.read(self.commits.newest()).get("upto", 0)

    def reserve(self, count: int) -> int:
        """The first of ``count`` numbers that nobody else gets. Numbers of a load that fails are left out."""
        while True:
            n = self.commits.newest()
            upto = self.commits.read(n).get("upto", 0)
            if self.commits.take(n + 1, {"upto": upto + count}):
                return upto + 1
