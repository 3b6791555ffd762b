"""A journal of finished steps, so that a run whose driver died can be gone on with."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

from linktide.scratch import Scratch


class Journal:
    """One small file per finished step below ``folder``, and the run's stored steps there.

    A record is put in place by a rename once its step is stored whole, so a step either
    counts or is done again; what an unfinished step has left is never read. ``settings``
    say what the steps hang on: a journal of other settings is refused.
    """

    def __init__(self, spark: SparkSession, folder: str, settings: dict | None = None):
        self.spark, self.folder = spark, folder.rstrip("/")
        context = spark.sparkContext
        self._jvm = context._jvm
        self._file_system = self._path("").getFileSystem(context._jsc.hadoopConfiguration())
        settings = json.loads(json.dumps(settings or {}))
        found = self.read("settings")
        if found is None:
            self.write("settings", settings)
        elif found != settings:
            raise ValueError(f"{folder} is the journal of another run: {found}, not {settings}")

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def scratch(self) -> Scratch:
        """A folder for steps that stays until the journal is removed."""
        return Scratch(self.spark, f"{self.folder}/steps", keep=True)

    def read(self, step: str) -> dict | None:
        path = self._path(f"{step}.json")
        if not self._file_system.exists(path):
            return None
        stream = self._file_system.open(path)
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def write(self, step: str, facts: dict) -> None:
        draft, final = self._path(f".{step}-{uuid.uuid4().hex}"), self._path(f"{step}.json")
        stream = self._file_system.create(draft)
        stream.write(bytearray(json.dumps(facts).encode()))
        stream.close()
        self._file_system.delete(final, False)
        if not self._file_system.rename(draft, final):
            raise OSError(f"could not put {final} in place")

    def forget(self, step: str) -> None:
        """Take a record away; do so before its data goes."""
        self._file_system.delete(self._path(f"{step}.json"), False)

    def remove(self) -> None:
        """Drop the journal and all steps stored in its folder."""
        self._file_system.delete(self._path(""), True)
