"""Keyed tables that are changed, not rewritten.

Rows lie in buckets by the hash of their key. A commit writes the changed rows of the buckets it touches as a new folder and
publishes a log entry; reading takes the latest row of each key, and only buckets with changes are merged for that. ``compact``
makes one folder of a bucket's many. Everything is read through the log: a folder no entry names is of no version.

A log entry holds the whole state (for each bucket the folders it is made of), so the newest is enough and no history is
scanned. It is renamed into place under the next number, which fails if another writer was first (``LostRace``): nothing of the
loser is visible, and it may read again and retry. Renaming without overwriting is atomic on HDFS; a store without such a rename
needs its own commit service.
"""

from __future__ import annotations

import json
import uuid
from collections import defaultdict
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from shelfwise.session import cut_lineage

BUCKETS = 256
BUCKET, VERSION, GONE = "__bucket", "__version", "__gone"


class LostRace(RuntimeError):
    """Another writer committed the version first."""


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names inside a folder; none if it does not exist."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return [found.getPath().getName() for found in store.listStatus(at)] if store.exists(at) else []


def publish(spark: SparkSession, folder: str, name: str, text: str) -> None:
    """Create ``folder/name`` with ``text``, whole or not at all; ``LostRace`` if it exists."""
    fs = spark._jvm.org.apache.hadoop.fs
    draft, final = fs.Path(f"{folder}/.{uuid.uuid4().hex}"), fs.Path(f"{folder}/{name}")
    context = fs.FileContext.getFileContext(final.toUri(), spark._jsc.hadoopConfiguration())
    store = final.getFileSystem(spark._jsc.hadoopConfiguration())
    out = store.create(draft, False)
    out.write(bytearray(text, "utf-8"))
    out.close()
    plain = spark.sparkContext._gateway.new_array(fs.Options.Rename, 1)
    plain[0] = fs.Options.Rename.NONE
    try:
        context.rename(draft, final, plain)
    except Py4JJavaError as error:
        store.delete(draft, False)
        if "FileAlreadyExistsException" in str(error.java_exception):
            raise LostRace(f"{folder}/{name} is taken") from error
        raise


def read_text(spark: SparkSession, path: str) -> str:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = at.getFileSystem(spark._jsc.hadoopConfiguration()).open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _comparable(rows: DataFrame) -> Column:
    """A row as one value that can be compared; entries of a map have no order."""
    return F.struct(*[F.array_sort(F.map_entries(c)) if t.startswith("map") else F.col(c) for c, t in rows.dtypes])


@dataclass(frozen=True)
class State:
    """A version of a table: the folders each bucket is made of, oldest first."""

    version: int
    key: str
    buckets: int
    columns: str
    folders: dict[int, list[str]]

    def text(self) -> str:
        return json.dumps({"key": self.key, "buckets": self.buckets, "columns": self.columns, "folders": self.folders})


class KeyedTable:
    """A table of one row per key under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    @classmethod
    def create(cls, rows: DataFrame, root: str, key: str, buckets: int = BUCKETS) -> KeyedTable:
        """A new table of ``rows`` (unique on ``key``, which is not null)."""
        table = cls(rows.sparkSession, root)
        state = State(0, key, buckets, rows.schema.json(), {})
        table._commit(state, rows.withColumn(GONE, F.lit(False)))
        return table

    def state(self) -> State:
        newest = max(n for n in folder_names(self.spark, f"{self.root}/log") if not n.startswith("."))
        held = json.loads(read_text(self.spark, f"{self.root}/log/{newest}"))
        return State(int(newest.split(".")[0]), held["key"], held["buckets"], held["columns"], {int(b): f for b, f in held["folders"].items()})

    def bucket(self, state: State, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(state.buckets)).cast("int")

    def read(self, state: State | None = None, buckets: Iterable[int] | None = None) -> DataFrame:
        """The rows of a version (default: the newest), or those of some buckets; other buckets' files are not opened."""
        state = state or self.state()
        wanted = state.folders if buckets is None else {b: state.folders[b] for b in buckets if b in state.folders}
        plain = self._rows(state, {b: f for b, f in wanted.items() if len(f) == 1})
        changed = self._rows(state, {b: f for b, f in wanted.items() if len(f) > 1})
        names = T.StructType.fromJson(json.loads(state.columns)).names
        whole = F.struct(*names, GONE)
        latest = changed.groupBy(F.col(state.key).alias("__key")).agg(F.max_by(whole, VERSION).alias("__row")).select("__row.*")
        return plain.select(*names, GONE).unionByName(latest).filter(~F.col(GONE)).drop(GONE)

    def _rows(self, state: State, folders: dict[int, list[str]]) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(state.columns)).add(GONE, T.BooleanType()).add(VERSION, T.LongType())
        paths = [f"{self.root}/data/{folder}/{BUCKET}={bucket}" for bucket, held in folders.items() for folder in held]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def buckets_of(self, keys: DataFrame, state: State) -> list[int]:
        """Buckets that hold the keys (column named as the table's key): at most as many as the table has."""
        return sorted(r[0] for r in keys.select(self.bucket(state, F.col(state.key)).alias("b")).distinct().collect())

    def lookup(self, keys: DataFrame, state: State | None = None) -> DataFrame:
        """Rows of the table with one of ``keys``."""
        state = state or self.state()
        own = keys.select(state.key).filter(F.col(state.key).isNotNull()).distinct()
        return self.read(state, self.buckets_of(own, state)).join(own, state.key, "left_semi")

    def _commit(self, state: State, changes: DataFrame, replaced: bool = False) -> list[int]:
        """Write rows and publish the version after ``state``; gives the buckets touched."""
        version = state.version + 1
        folder = f"{version:012d}-{uuid.uuid4().hex[:12]}"
        bucketed = changes.withColumn(VERSION, F.lit(version).cast("long")).withColumn(BUCKET, self.bucket(state, F.col(state.key)))
        bucketed.repartition(F.col(BUCKET)).write.partitionBy(BUCKET).parquet(f"{self.root}/data/{folder}")
        touched = sorted(int(n.split("=")[1]) for n in folder_names(self.spark, f"{self.root}/data/{folder}") if n.startswith(BUCKET))
        folders = {**state.folders, **{b: [*([] if replaced else state.folders.get(b, [])), folder] for b in touched}}
        publish(self.spark, f"{self.root}/log", f"{version:012d}.json", State(version, state.key, state.buckets, state.columns, folders).text())
        return touched

    def commit(self, changes: DataFrame, base: State) -> list[int]:
        """Publish changed rows (``__gone`` true deletes) as the version after ``base``; ``LostRace`` if that is taken."""
        rows = changes if GONE in changes.columns else changes.withColumn(GONE, F.lit(False))
        return self._commit(base, rows)

    def merge(self, incoming: DataFrame, rule: Callable[[DataFrame, DataFrame], DataFrame]) -> tuple[DataFrame, list[int]]:
        """Change the rows of the incoming keys by ``rule(rows held, incoming)``, which gives their rows after it.

        Only buckets of incoming keys are read, and only rows that differ are written; a second run with the same input
        writes nothing. Gives the changed rows and the buckets touched.
        """
        state = self.state()
        held = cut_lineage(self.lookup(incoming, state))
        after = rule(held, incoming).select(*held.columns)
        before = held.select(F.col(state.key), _comparable(held).alias("__was"))
        changed = after.withColumn("__is", _comparable(after)).join(before, state.key, "left").filter(~F.col("__is").eqNullSafe(F.col("__was")))
        changed = cut_lineage(changed.drop("__is", "__was"))
        if changed.isEmpty():
            return changed, []
        return changed, self.commit(changed, state)

    def compact(self, most: int = 1) -> list[int]:
        """Make one folder of each bucket that is made of more than ``most``; gives these buckets."""
        state = self.state()
        worn = [b for b, folders in state.folders.items() if len(folders) > most]
        if not worn:
            return []
        rows = self.read(state, worn).withColumn(GONE, F.lit(False))
        self._commit(State(state.version, state.key, state.buckets, state.columns, {b: f for b, f in state.folders.items() if b not in worn}), rows, True)
        return worn

    def layout(self) -> dict[int, int]:
        """Folders of each bucket."""
        return {b: len(f) for b, f in self.state().folders.items()}


def folders_by_version(state: State) -> dict[int, list[int]]:
    """Buckets each version still supplies rows for."""
    out: dict[int, list[int]] = defaultdict(list)
    for bucket, folders in state.folders.items():
        for folder in folders:
            out[int(folder.split("-")[0])].append(bucket)
    return dict(out)
