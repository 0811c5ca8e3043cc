"""Tables and table sets as plain Parquet folders behind a small table of what is current.

Data is written with the DataFrame writer into folders that nothing else uses; then one row
for each folder that is new is appended to the table ``current``, in one file, which Spark's
committer makes visible as a whole. Whatever stops a write before that leaves the former
state in place, and a reader always sees a whole one. Data folders without a readable table
``current`` are an error and never taken for an empty table.

A keyed table is laid out in parts by a hash of its key, as many as its rows need at
``PART_ROWS`` a part, and a part is written in as many files as its bytes need, so tasks follow
the data: an upsert joins and rewrites the parts that hold changed keys, and a table that has outgrown its parts is dealt anew with its next upsert. A
whole rewrite starts a new generation; the one before it is kept, older ones go.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of a part, about; a table with more than twice as many a part is dealt anew.
PART_ROWS = 1_000_000
CURRENT = "generation long, commit long, writer string, n_parts int, name string, path string, n_rows long, schema string"


@dataclass
class State:
    """What is current: paths and row counts by part or table name."""

    generation: int
    commit: int
    n_parts: int
    paths: dict[str, str]
    rows: dict[str, int]
    schemas: dict[str, T.StructType]


class Current:
    """The table of what is current under one root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._known: tuple[list[tuple], State | None] | None = None  # files of the table, and what they say

    def _list(self, folder: str) -> list:
        """What stands in a folder below the root; nothing where it does not exist."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{folder}" if folder else self.root)
        fs = path.getFileSystem(conf)
        return list(fs.listStatus(path)) if fs.exists(path) else []

    def _files(self, folder: str) -> list[str]:
        return [s.getPath().getName() for s in self._list(folder)]

    def state(self) -> State | None:
        """The newest state; ``None`` where nothing was ever written."""
        files = sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in self._list("current") if s.getPath().getName().endswith(".parquet"))
        if self._known and self._known[0] == files:
            return self._known[1]
        self._known = files, self._read(files)
        return self._known[1]

    def _read(self, files: list[tuple]) -> State | None:
        if not files:
            if "current" in self._files("") and self._files("data"):
                raise RuntimeError(f"{self.root} holds data but no readable table of what is current")
            return None
        newest = F.struct("commit", "writer", "n_parts", "path", "n_rows", "schema")
        rows = (self.spark.read.schema(CURRENT).parquet(f"{self.root}/current").groupBy("generation", "name")
                .agg(F.max_by(newest, F.struct("commit", "writer")).alias("r"))
                .select("generation", "name", "r.*").collect())  # a row per part
        last = max(r.generation for r in rows)
        rows = [r for r in rows if r.generation == last]
        commit = max(r.commit for r in rows)
        if len({r.writer for r in rows if r.commit == commit}) > 1:
            raise RuntimeError(f"{self.root}: commit {commit} was made by two writers")
        rows = [r for r in rows if r.path]
        return State(last, commit, max((r.n_parts for r in rows), default=1), {r.name: r.path for r in rows}, {r.name: r.n_rows for r in rows},
                     {r.name: T.StructType.fromJson(json.loads(r.schema)) for r in rows})

    def size(self, folder: str) -> int:
        """Bytes of the files below a folder."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{folder}")
        return path.getFileSystem(conf).getContentSummary(path).getLength()

    def append(self, state: State | None, placed: dict[str, tuple[str, int]], schemas: dict[str, str], n_parts: int, whole: bool) -> None:
        """Make ``placed`` (name: path, rows) current; a ``whole`` one is a generation of its own."""
        commit = (state.commit if state else 0) + 1
        generation = commit if whole or not state else state.generation
        writer = uuid.uuid4().hex
        rows = [(generation, commit, writer, n_parts, name, path, n, schemas[name]) for name, (path, n) in placed.items()]
        self.spark.createDataFrame(rows, CURRENT).coalesce(1).write.mode("append").parquet(f"{self.root}/current")

    def drop_before(self, keep: Sequence[State | None]) -> None:
        """Delete data folders that no state of ``keep`` names."""
        named = {p.split("/")[1] for s in keep if s for p in s.paths.values()}
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in self._files("data"):
            if name not in named:
                path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/data/{name}")
                path.getFileSystem(conf).delete(path, True)


class VersionedTable:
    """A keyed table whose upserts rewrite only the parts that hold changed keys."""

    def __init__(self, spark: SparkSession, root: str, pk: Sequence[str] = (), part_rows: int | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.pk, self.part_rows = list(pk), part_rows or PART_ROWS
        self.current = Current(spark, root)
        self.written_bytes = 0  # by this object so far

    def exists(self) -> bool:
        return self.current.state() is not None

    def schema(self) -> T.StructType | None:
        s = self.current.state()
        return next(iter(s.schemas.values())) if s else None

    def _read(self, state: State, parts: set[str] | None = None) -> DataFrame:
        schema = next(iter(state.schemas.values()))
        paths = [f"{self.root}/{p}" for name, p in state.paths.items() if p.endswith(f"part={name}") and (parts is None or name in parts)]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def read(self) -> DataFrame | None:
        s = self.current.state()
        return None if s is None else self._read(s)

    def _part(self, n: int):
        return F.pmod(F.xxhash64(*self.pk), F.lit(n)) if self.pk else F.lit(0).cast("long")

    def _write(self, df: DataFrame, n: int) -> dict[str, tuple[str, int]]:
        """Write rows by part; path and row count of every part that has rows."""
        folder = f"data/{uuid.uuid4().hex}"
        keyed = df.withColumn("part", self._part(n))
        # a part is written by as many tasks as its bytes need: rows may be long texts
        (keyed.hint("rebalance", F.col("part")) if self.pk else keyed).write.partitionBy("part").parquet(f"{self.root}/{folder}")
        self.written_bytes += self.current.size(folder)
        written = self.spark.read.schema(T.StructType([T.StructField("part", T.LongType())])).parquet(f"{self.root}/{folder}")
        return {str(r["part"]): (f"{folder}/part={r['part']}", r["count"]) for r in written.groupBy("part").count().collect()}

    def _commit(self, state: State | None, schema: T.StructType, placed: dict[str, tuple[str, int]], n: int, whole: bool) -> None:
        # a table without rows has no part, but a schema
        placed = placed or {"": ("data/none", 0)}
        self.current.append(state, placed, dict.fromkeys(placed, schema.json()), n, whole)

    def replace(self, df: DataFrame) -> None:
        """Make ``df`` the whole table, in as many parts as its rows need."""
        state = self.current.state()
        n = max(1, -(-df.count() // self.part_rows)) if self.pk else 1
        self._commit(state, df.schema, self._write(df, n), n, whole=True)
        self.current.drop_before([state, self.current.state()])

    def merge(self, changes: DataFrame, combine) -> DataFrame:
        """``combine(old, changes)`` in the touched parts only; all others keep their files.

        Columns the table does not know are dropped and types follow the table, so a
        changed source schema cannot move a key to another part. A replay merges
        the same changes again; ``combine`` must be idempotent.
        """
        if not self.pk:
            raise ValueError("a table without a key can only be replaced")
        state = self.current.state()
        if state is None:
            self.replace(combine(None, changes))
            return self.read()
        schema = next(iter(state.schemas.values()))
        have = set(changes.columns)
        changes = changes.select(*[F.col(f.name).cast(f.dataType) for f in schema if f.name in have])
        if sum(state.rows.values()) > 2 * state.n_parts * self.part_rows:
            self.replace(combine(self._read(state), changes).select(*schema.fieldNames()))
            return self.read()
        touched = {str(r[0]) for r in changes.select(self._part(state.n_parts)).distinct().collect()}  # at most the parts
        if touched:
            merged = combine(self._read(state, touched), changes).select(*schema.fieldNames())
            self._commit(state, schema, self._write(merged, state.n_parts), state.n_parts, whole=False)
        return self.read()


class Snapshot:
    """A set of tables that changes as one: every table of a run becomes current at once."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.current = Current(spark, root)

    def publish(self, tables: dict[str, DataFrame], carry: Sequence[str] = ()) -> None:
        """Write all tables, then swap them in at once. ``carry`` names tables that stay as the
        former snapshot has them (derived ones that a full refresh must not lose)."""
        state = self.current.state()
        missing = [c for c in carry if state and c not in state.paths]
        if missing:
            raise ValueError(f"nothing to carry over for {missing}")
        folder = f"data/{uuid.uuid4().hex}"
        for name, df in tables.items():
            df.write.parquet(f"{self.root}/{folder}/{name}")
        placed = {name: (f"{folder}/{name}", 0) for name in tables}
        schemas = {name: df.schema.json() for name, df in tables.items()}
        for c in carry:
            if state and c not in tables:
                placed[c], schemas[c] = (state.paths[c], 0), state.schemas[c].json()
        self.current.append(state, placed, schemas, 1, whole=True)
        self.current.drop_before([state, self.current.state()])

    def read(self, name: str) -> DataFrame | None:
        state = self.current.state()
        if not state or name not in state.paths:
            return None
        return self.spark.read.schema(state.schemas[name]).parquet(f"{self.root}/{state.paths[name]}")
