"""Intermediate tables on storage that every executor can reach.

Every step that is read more than once, and every ranking round, is written as a
table. That cuts the lineage, and an executor lost later costs only a re-read.
"""

from __future__ import annotations

import atexit
import itertools
import json
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql.types import StructType

ROWS_PER_PARTITION = 2_000_000
# Run tables are in a database of their own: what a killed session leaves is found there.
DATABASE = "linktide_scratch"


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of the session; a machine-local one only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    configured = configured or spark.sparkContext.getCheckpointDir()
    local = spark.sparkContext.master.startswith("local")
    if configured and (local or not configured.startswith("file:")):
        return configured.rstrip("/")
    if not local:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="linktide-")


@contextmanager
def settings(spark: SparkSession, values: dict[str, object]):
    """Session settings for the actions run inside the block."""
    before = {key: spark.conf.get(key) for key in values}
    for key, value in values.items():
        spark.conf.set(key, str(value))
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def shuffle_partitions(spark: SparkSession, partitions: int):
    return settings(spark, {"spark.sql.shuffle.partitions": partitions})


def string_partitions(spark: SparkSession, rows: int) -> int:
    """Shuffle partitions for rows of a few strings: the session's number, or more where
    a partition would outgrow a task's memory. Adaptive execution merges small ones.
    """
    configured = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(configured, -(-rows // ROWS_PER_PARTITION))


def sorted_lists(spark: SparkSession):
    """Lists put together inside the block are put together in sorted rows, one key at a time.

    A hash table would hold the lists of 128 keys, and then turn to sorting what is left.
    """
    return settings(spark, {"spark.sql.execution.useObjectHashAggregateExec": "false"})


class Scratch:
    """One run's own folder (and catalog tables) below the shared root.

    DataFrames returned by ``save`` and ``save_bucketed`` read from that folder,
    so call ``close`` (or leave the ``with`` block) only after using them. What is
    still open when Python exits is closed then. With ``keep`` only the catalog tables go:
    the files stay for a later session to ``reopen``.
    """

    def __init__(self, spark: SparkSession, root: str | None = None, keep: bool = False):
        self.spark = spark
        self.keep = keep
        self.run_id = uuid.uuid4().hex[:12]
        self.folder = f"{(root or scratch_root(spark)).rstrip('/')}/linktide-{self.run_id}"
        self._serial = itertools.count()
        self._tables: list[str] = []
        self._stored: list[tuple[DataFrame, str, str]] = []
        self._facts: list[tuple[DataFrame, dict]] = []
        context = spark.sparkContext
        self._jvm_path = context._jvm.org.apache.hadoop.fs.Path
        self._path = self._jvm_path(self.folder)
        self._file_system = self._path.getFileSystem(context._jsc.hadoopConfiguration())
        atexit.register(self.close)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *exc) -> None:
        self.close()

    def path(self, name: str) -> str:
        return f"{self.folder}/{next(self._serial):03d}_{name}"

    def save(
        self, df: DataFrame, name: str, metrics: dict[str, Column] | None = None
    ) -> tuple[DataFrame, dict]:
        """Write ``df``; return the stored table and the aggregates seen on the way."""
        path = self.path(name)
        df, seen = _observed(df, metrics)
        df.write.parquet(path)
        stored = self.spark.read.schema(df.schema).parquet(path)
        self._facts.append((stored, {"path": path, "schema": df.schema.json()}))
        return stored, seen.get if seen else {}

    def facts(self, stored: DataFrame) -> dict:
        """What ``reopen`` needs to read a stored table in another session."""
        return next(facts for df, facts in self._facts if df is stored)

    def reopen(self, facts: dict) -> DataFrame:
        """The stored table of these facts, whichever session has written it."""
        schema = StructType.fromJson(json.loads(facts["schema"]))
        if "buckets" not in facts:
            stored = self.spark.read.schema(schema).parquet(facts["path"])
        else:
            table = self._create(schema, facts["path"], facts["key"], facts["buckets"])
            stored = self.spark.table(table)
            self._stored.append((stored, table, facts["path"]))
        self._facts.append((stored, facts))
        return stored

    def _create(self, schema: StructType, path: str, key: str, buckets: int) -> str:
        """A catalog table over a folder of hash-bucketed files."""
        table = f"linktide_{self.run_id}_{next(self._serial):03d}_{path.rsplit('/', 1)[1]}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        location = path.replace("'", "\\'")
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{DATABASE}`")
        table = f"{DATABASE}.{table}"
        self.spark.sql(
            f"CREATE TABLE {table} ({columns}) USING parquet "
            f"CLUSTERED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{location}'"
        )
        self._tables.append(table)
        return table

    def save_bucketed(
        self,
        df: DataFrame,
        name: str,
        key: str,
        buckets: int,
        metrics: dict[str, Column] | None = None,
    ) -> tuple[DataFrame, dict]:
        """Like ``save``, hash-bucketed by ``key``: joins on it need no exchange.

        ``df`` should arrive hash-partitioned by ``key``, so that each task writes
        whole buckets.
        """
        path = self.path(name)
        table = self._create(df.schema, path, key, buckets)
        df, seen = _observed(df, metrics)
        # A task writes few buckets: keeping their files open saves sorting by bucket.
        with settings(self.spark, {"spark.sql.maxConcurrentOutputFileWriters": 8}):
            df.write.insertInto(table)
        stored = self.spark.table(table)
        self._stored.append((stored, table, path))
        facts = {"path": path, "schema": df.schema.json(), "key": key, "buckets": buckets}
        self._facts.append((stored, facts))
        return stored, seen.get if seen else {}

    def drop_bucketed(self, df: DataFrame) -> None:
        """Drop a table that ``save_bucketed`` returned, once nothing reads it any more."""
        for entry in [e for e in self._stored if e[0] is df]:
            _, table, path = entry
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
            self._tables.remove(table)
            self._stored.remove(entry)
            self._file_system.delete(self._jvm_path(path), True)

    def close(self) -> None:
        """Drop this run's tables and its own uniquely named folder."""
        atexit.unregister(self.close)
        if self.spark.sparkContext._jsc is None:  # the session has been stopped
            return
        while self._tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._tables.pop()}")
        if not self.keep:
            self._file_system.delete(self._path, True)


def _observed(df: DataFrame, metrics: dict[str, Column] | None):
    if not metrics:
        return df, None
    seen = Observation()
    return df.observe(seen, *[column.alias(name) for name, column in metrics.items()]), seen
