"""Results in folders of their own, published by one small pointer.

A version is written beside the one that readers use, and becomes theirs when the pointer is
put in place by a rename: nobody meets half a run, and a run that fails changes nothing.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

POINTER = "CURRENT"
VERSIONS = "versions"


def _hadoop(spark: SparkSession, path: str):
    context = spark.sparkContext
    fs = context._jvm.org.apache.hadoop.fs
    path = fs.Path(path)
    return fs, path.getFileSystem(context._jsc.hadoopConfiguration()), path


def _pointer(spark: SparkSession, out: str) -> dict | None:
    _, system, path = _hadoop(spark, f"{out}/{POINTER}")
    if not system.exists(path):
        return None
    stream = system.open(path)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)


def new_version(out: str) -> str:
    """A folder for one run's results, which no reader knows of yet."""
    return f"{out.rstrip('/')}/{VERSIONS}/{uuid.uuid4().hex[:12]}"


def drop_version(spark: SparkSession, folder: str) -> None:
    _, system, path = _hadoop(spark, folder)
    system.delete(path, True)


def publish(spark: SparkSession, out: str, folder: str, keep: int = 2) -> None:
    """Make ``folder`` the results of ``out``. The last ``keep`` versions stay, so that
    readers of the one before can end; older ones go once the pointer has moved."""
    out, name = out.rstrip("/"), folder.rstrip("/").rsplit("/", 1)[1]
    before = _pointer(spark, out) or {"versions": []}
    versions = [name, *[v for v in before["versions"] if v != name]]
    fs, system, draft = _hadoop(spark, f"{out}/.{POINTER}-{uuid.uuid4().hex}")
    stream = system.create(draft)
    stream.write(bytearray(json.dumps({"current": name, "versions": versions[:keep]}).encode()))
    stream.close()
    context = spark.sparkContext
    overwrite = context._gateway.new_array(getattr(context._jvm, "org.apache.hadoop.fs.Options$Rename"), 1)
    overwrite[0] = fs.Options.Rename.OVERWRITE
    draft, final = (system.makeQualified(p) for p in (draft, fs.Path(f"{out}/{POINTER}")))
    files = fs.FileContext.getFileContext(draft.toUri(), context._jsc.hadoopConfiguration())
    files.rename(draft, final, overwrite)
    for old in versions[keep:]:
        drop_version(spark, f"{out}/{VERSIONS}/{old}")


def published(spark: SparkSession, out: str) -> str:
    """The folder of the results that ``out`` points to; fails if none are published."""
    found = _pointer(spark, out.rstrip("/"))
    if found is None:
        raise FileNotFoundError(f"no results are published at {out}")
    return f"{out.rstrip('/')}/{VERSIONS}/{found['current']}"
