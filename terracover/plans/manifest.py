"""What each stage read and left, so that a rerun can skip what is still fresh.

One JSON file a stage, written under another name and renamed, by Hadoop's file system; a stage that fails has none.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

#: Seconds by which an output may seem older than its input (clocks of different machines).
SLACK = 60.0


class Store:
    """Files of a session's stores."""

    def __init__(self, spark: SparkSession):
        self.spark, self.conf = spark, spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.conf), p

    def status(self, path: str) -> dict | None:
        """Files, bytes and the newest change (seconds) of a file or folder; None if it is not there."""
        fs, p = self._at(path)
        if not fs.exists(p):
            return None
        files = size = newest = 0
        each = fs.listFiles(p, True)
        while each.hasNext():
            own = each.next()
            if not own.getPath().getName().startswith("."):
                files, size, newest = files + 1, size + own.getLen(), max(newest, own.getModificationTime())
        return {"files": files, "bytes": size, "newest": newest / 1000}

    def put(self, path: str, text: str) -> None:
        """Write a small file at once or not at all."""
        fs, p = self._at(path)
        _, part = self._at(f"{path}.{uuid.uuid4().hex}.part")
        out = fs.create(part, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        fs.delete(p, False)
        if not fs.rename(part, p):
            raise OSError(f"{path} could not be put in place")

    def get(self, path: str) -> str | None:
        fs, p = self._at(path)
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def remove(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)


def is_stale(spark: SparkSession, derived: str, source: str, slack: float = SLACK) -> bool:
    """C6 in any store: whether a derived file is missing, or older than its source by more than the slack."""
    store = Store(spark)
    own, other = store.status(derived), store.status(source)
    return own is None or other is not None and own["newest"] < other["newest"] - slack


@dataclass
class Manifest:
    spark: SparkSession
    folder: str

    def __post_init__(self):
        self.store = Store(self.spark)

    def _path(self, number: int) -> str:
        return f"{self.folder}/stage-{number}.json"

    def fresh(self, number: int, inputs: list[str], outputs: list[str]) -> bool:
        """Whether the stage ended, its inputs and outputs are as it saw them, and no output is older than an input."""
        text = self.store.get(self._path(number))
        if text is None:
            return False
        kept = json.loads(text)
        now = [{p: self.store.status(p) for p in paths} for paths in (inputs, outputs)]
        if [kept["inputs"], kept["outputs"]] != now or None in now[1].values():
            return False
        newest = max((s["newest"] for s in now[0].values() if s), default=0)
        return all(s["newest"] >= newest - SLACK for s in now[1].values())

    def begin(self, number: int) -> None:
        self.store.remove(self._path(number))

    def end(self, number: int, title: str, seconds: float, inputs: list[str], outputs: list[str], rows: int) -> None:
        kept = {"number": number, "title": title, "seconds": round(seconds, 3), "rows": rows, "inputs": {p: self.store.status(p) for p in inputs}, "outputs": {p: self.store.status(p) for p in outputs}}
        self.store.put(self._path(number), json.dumps(kept))

    def table(self) -> DataFrame:
        """number, title, seconds and rows of the stages that ended."""
        return self.spark.read.schema("number int, title string, seconds double, rows long").json(f"{self.folder}/stage-*.json")
