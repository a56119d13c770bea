"""Files fetched by executors (S8, S10, S11): retried, checked, put in place whole; what fails is a row, not an error."""

from __future__ import annotations

import io
import json
import time
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.tables import STATE_CODES
from .files import stored
from .stores import file_system

TRIES = 4
WAIT = 1.5
TIMEOUT = 60.0
STEP = 1 << 20


class NoRetry(Exception):
    """An answer that no further try will mend."""


def check_any(fs: pafs.FileSystem, path: str) -> None:
    if not fs.get_file_info(path).size:
        raise ValueError("the file is empty")


def check_zip(fs: pafs.FileSystem, path: str) -> None:
    """Not empty, a ZIP, and all members whole."""
    check_any(fs, path)
    with fs.open_input_file(path) as f:
        try:
            with zipfile.ZipFile(f) as z:
                broken = z.testzip()
        except (zipfile.BadZipFile, pa.ArrowInvalid) as e:  # the latter where it is too short for its end to be looked for
            raise ValueError("the file is no ZIP") from e
    if broken:
        raise ValueError(f"member {broken} is damaged")


def check_features(fs: pafs.FileSystem, path: str) -> None:
    """A FeatureCollection with features."""
    check_any(fs, path)
    with fs.open_input_file(path) as f:
        read = json.load(io.TextIOWrapper(f, "utf-8"))
    if not isinstance(read, dict) or read.get("type") != "FeatureCollection" or not read.get("features"):
        raise ValueError("the file is no FeatureCollection with features")


CHECKS: dict[str, Callable[[pafs.FileSystem, str], None]] = {"any": check_any, "zip": check_zip, "features": check_features}


#: Addresses that urllib opens; any other is a path or an address of a store.
_URLLIB = ("http:", "https:", "ftp:", "file:", "data:")


def _download(url: str, fs: pafs.FileSystem, path: str, timeout: float) -> None:
    import urllib.error
    import urllib.request

    if not url.lower().startswith(_URLLIB):
        store, own = file_system(url)
        with store.open_input_stream(own) as source, fs.open_output_stream(path) as out:
            while chunk := source.read(STEP):
                out.write(chunk)
        return
    try:
        with urllib.request.urlopen(url, timeout=timeout) as answer, fs.open_output_stream(path) as out:
            want, got = answer.headers.get("Content-Length"), 0
            while chunk := answer.read(STEP):
                out.write(chunk)
                got += len(chunk)
    except urllib.error.HTTPError as e:
        text = f"the server answered {e.code}"
        raise (OSError(text) if e.code == 429 or e.code >= 500 else NoRetry(text)) from e
    if want is not None and got != int(want):
        raise OSError(f"{got} of {want} bytes came")


def fetch(url: str, target: str, check: str = "any", tries: int = TRIES, wait: float = WAIT, timeout: float = TIMEOUT) -> dict:
    """Fetch one file under its target, if no valid copy is there: status (cached, fetched or failed), tries, bytes, error.

    It is written under another name and moved into place once it passes the check, so that a target is always whole.
    """
    fs, path = file_system(target)
    test = CHECKS[check]

    def size() -> int:
        return fs.get_file_info(path).size or 0

    try:
        if fs.get_file_info(path).type == pafs.FileType.File:
            test(fs, path)
            return {"status": "cached", "tries": 0, "bytes": size(), "error": None}
    except Exception:  # a copy that is not valid is fetched anew
        pass
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    error = ""
    for k in range(1, tries + 1):
        part = f"{path}.{uuid.uuid4().hex}.part"
        try:
            _download(url, fs, part, timeout)
            test(fs, part)
            fs.move(part, path)
            return {"status": "fetched", "tries": k, "bytes": size(), "error": None}
        except Exception as e:
            error = f"{type(e).__name__}: {e}"
            if fs.get_file_info(part).type == pafs.FileType.File:
                fs.delete_file(part)
            if isinstance(e, NoRetry):
                break
            if k < tries:
                time.sleep(wait * 2 ** (k - 1))
    return {"status": "failed", "tries": k, "bytes": 0, "error": error}


def fetch_all(requests: DataFrame, tasks: int, tries: int = TRIES, wait: float = WAIT, timeout: float = TIMEOUT) -> DataFrame:
    """requests (url, target, check) with status, tries, bytes and error of each, dealt to so many tasks.

    The answers are written down, so reading the result again fetches nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                found = row | fetch(row["url"], row["target"], row["check"] or "any", tries, wait, timeout)
                yield pa.RecordBatch.from_pylist([found], schema=pa.schema([(c, pa.int64() if c in ("tries", "bytes") else pa.string()) for c in found]))

    rows = requests.select("url", "target", F.col("check").cast("string")).repartition(tasks)
    return stored(rows.mapInArrow(run, "url string, target string, check string, status string, tries long, bytes long, error string"), "fetched")


def state_requests(spark: SparkSession, states: list[str], template: str, folder: str, suffix: str, check: str) -> DataFrame:
    """A request for each state; {uf} and {code} in the template stand for the state and its number."""
    rows = [(template.format(uf=s, code=STATE_CODES[s]), f"{folder.rstrip('/')}/{s}{suffix}", check) for s in states]
    return spark.createDataFrame(rows, "url string, target string, check string")


def require_all(fetched: DataFrame) -> list[str]:
    """The targets of a fetch of which nothing failed; else an error that names up to five that did (one row a file)."""
    if failed := fetched.where("status = 'failed'").orderBy("target").limit(5).collect():
        raise OSError("; ".join(f"{r['url']}: {r['error']}" for r in failed))
    return sorted(r["target"] for r in fetched.select("target").collect())
