"""Finished stages of a job chain, so that a restart goes on where it ended."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Sequence

from pyspark.sql import SparkSession


class Manifest:
    """A file per finished stage under ``root``: what it was made of and what
    it returned. A stage is skipped if its inputs (path, length and time of
    every file), its settings and its outputs' success marks are as they were.

    The file is written after the stage and renamed into place, so a driver
    lost at any moment leaves either none or a whole one. A stage that was
    under way runs again; all stages overwrite their outputs.
    """

    def __init__(self, spark: SparkSession, root: str, enabled: bool = True):
        self.spark, self.root, self.enabled = spark, root.rstrip("/"), enabled

    def _path(self, path: str):
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop, hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def files(self, pattern: str) -> list[list]:
        """Path, length and time of every file at or below the glob."""
        path, fs = self._path(pattern)
        found = []
        for match in fs.globStatus(path) or []:
            below = fs.listFiles(match.getPath(), True)
            while below.hasNext():
                f = below.next()
                found.append([f.getPath().toString(), f.getLen(), f.getModificationTime()])
        return sorted(found)

    def _read(self, stage: str) -> dict:
        path, fs = self._path(f"{self.root}/{stage}.json")
        if not fs.exists(path):
            return {}
        stream = fs.open(path)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    def _write(self, stage: str, entry: dict) -> None:
        (path, fs), (part, _) = self._path(f"{self.root}/{stage}.json"), self._path(f"{self.root}/_{stage}.part")
        stream = fs.create(part, True)
        stream.write(bytearray(json.dumps(entry).encode()))
        stream.close()
        fs.delete(path, False)
        if not fs.rename(part, path):
            raise OSError(f"could not write the manifest of {stage}")

    def run(self, stage: str, inputs: Sequence[str], outputs: Sequence[str], settings: object, work: Callable[[], dict]) -> dict:
        """What ``work`` returns (values that JSON holds), now or when it was
        last run on the same inputs with the same settings."""
        if not self.enabled:
            return work()
        made_of = json.dumps([[self.files(i) for i in inputs], repr(settings)])
        key = hashlib.sha256(made_of.encode()).hexdigest()
        saved = self._read(stage)
        if saved.get("key") == key and all(fs.exists(p) for p, fs in (self._path(f"{o}/_SUCCESS") for o in outputs)):
            return saved["values"]
        values = work()
        self._write(stage, {"key": key, "outputs": list(outputs), "values": values})
        return values
