"""Parquet and GeoParquet scans, sinks, cached fetches and byte-exact text files."""

from __future__ import annotations

import glob
import os
import tempfile
import time
import uuid
import zipfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geometry import from_wkb, to_wkb
from ..schema import WORK_COLUMNS, require_columns
from .geoparquet import GeoParquetSink, geometry_column
from .stores import file_system

def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share (spark.checkpoint.dir); a temporary one only in a local session without it."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="shared-tables-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder.rstrip('/')}/files/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df, written to the shared folder and read back, which cuts its lineage and fixes row numbers made in it."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove tables made by stored() that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._stored_at)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def read_points(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """S2."""
    return require_columns(spark.read.parquet(path), columns, path)


def write_table(df: DataFrame, path: str) -> None:
    """K1."""
    df.write.mode("overwrite").parquet(path)


def write_geocoded(df: DataFrame, path: str) -> None:
    """K3: without the working columns."""
    write_table(df.drop(*WORK_COLUMNS), path)


def write_geo(df: DataFrame, path: str) -> None:
    """K2: geometry as WKB; every file's footer declares it and its reference system."""
    df.sparkSession.dataSource.register(GeoParquetSink)
    df.withColumn("geometry", to_wkb(F.col("geometry"))).write.format("geoparquet").mode("overwrite").save(path)


def read_geo(spark: SparkSession, path: str, columns: list[str] = ()) -> DataFrame:
    """S3: a GeoParquet table of any writer; the reference system must be longitude and latitude."""
    own = geometry_column(spark, path)
    df = require_columns(spark.read.parquet(path).withColumnRenamed(own, "geometry"), [*columns, "geometry"], path)
    return df.withColumn("geometry", F.when(F.col("geometry").isNotNull(), from_wkb(F.col("geometry"))))


def export(df: DataFrame, path: str) -> None:
    """K4: Parquet or, by any other suffix, CSV in parts with a header each."""
    if path.endswith(".parquet"):
        write_table(df, path)
    else:
        df.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)


def write_features(df: DataFrame, path: str) -> None:
    """K7: one GeoJSON feature a line, from (properties struct, geometry JSON text)."""
    df.select(F.concat(F.lit('{"type":"Feature","properties":'), F.to_json("properties"), F.lit(',"geometry":'), F.col("geometry_json"), F.lit("}")).alias("value")).write.mode("overwrite").text(path)


def payload(encoded: DataFrame, dictionaries: dict[str, DataFrame], path: str) -> None:
    """K6: the encoded points as JSON lines and one small table a dictionary, for a page to load."""
    encoded.repartitionByRange("_pos").sortWithinPartitions("_pos").write.mode("overwrite").json(f"{path}/points")
    for name, table in dictionaries.items():
        table.orderBy("code").coalesce(1).write.mode("overwrite").json(f"{path}/{name}")


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """K8: path and text of whole files, no newline translated."""
    return spark.read.format("binaryFile").load(path).select("path", F.decode("content", "UTF-8").alias("text"))


def write_texts(df: DataFrame, folder: str) -> None:
    """K8: every row's text as a file of its name, by executors; put in place whole, no newline translated."""

    def run(batches):
        fs, root = file_system(folder)
        fs.create_dir(root, recursive=True)
        for b in batches:
            for name, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                part = f"{root}/.{name}.{uuid.uuid4().hex}"
                with fs.open_output_stream(part) as out:
                    out.write(text or b"")
                fs.move(part, f"{root}/{name}")
            yield b.select([0]).slice(0, 0)

    rows = df.select(F.col("name").cast("string"), F.encode("text", "UTF-8").alias("text"))
    rows.mapInArrow(run, "name string").write.format("noop").mode("overwrite").save()


def write_text(path: str, text: str) -> None:
    """K8."""
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path, "wb") as f:
        f.write(text.encode())


def is_zip(path: str) -> bool:
    return os.path.getsize(path) > 0 and zipfile.is_zipfile(path)


class CertificateError(Exception):
    """A failure that no retry mends."""


def ensure_cached(path: str, fetch: Callable[[str], None], valid: Callable[[str], bool] = lambda p: os.path.getsize(p) > 0, tries: int = 4, wait: float = 5.0, sleep=time.sleep) -> str:
    """A valid local copy, fetched to a temporary name and renamed; waits double between tries."""
    if os.path.exists(path) and valid(path):
        return path
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    part = f"{path}.part"
    for k in range(tries):
        try:
            fetch(part)
            if not valid(part):
                raise ValueError(f"{path}: what was fetched is not valid")
            os.replace(part, path)
            return path
        except CertificateError:
            raise
        except Exception:
            for p in glob.glob(glob.escape(part)):
                os.remove(p)
            if k == tries - 1:
                raise
            sleep(wait * 2**k)
    raise AssertionError
