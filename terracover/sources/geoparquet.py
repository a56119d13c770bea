"""GeoParquet: a sink that puts the `geo` key into every footer, and what a file's footer declares (S3, K2).

The sink is a data source of its own (`format("geoparquet")`): each task writes one Parquet file, with the geometry
types it has seen in the footer (see stores.PartsWriter for the commit). Files are read by Spark's own Parquet reader;
only the footers are looked at here, through Hadoop's file system.
"""

from __future__ import annotations

import itertools
import json
import struct
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource
from pyspark.sql.types import StructType

from .stores import PartsWriter

#: The reference system of longitude and latitude as the format's specification spells it.
CRS84 = {
    "$schema": "https://proj.org/schemas/v0.5/projjson.schema.json",
    "type": "GeographicCRS",
    "name": "WGS 84 longitude-latitude",
    "datum": {"type": "GeodeticReferenceFrame", "name": "World Geodetic System 1984", "ellipsoid": {"name": "WGS 84", "semi_major_axis": 6378137, "inverse_flattening": 298.257223563}},
    "coordinate_system": {
        "subtype": "ellipsoidal",
        "axis": [{"name": "Geodetic longitude", "abbreviation": "Lon", "direction": "east", "unit": "degree"}, {"name": "Geodetic latitude", "abbreviation": "Lat", "direction": "north", "unit": "degree"}],
    },
    "id": {"authority": "OGC", "code": "CRS84"},
}
LON_LAT = {("OGC", "CRS84"), ("EPSG", "4326")}
#: Type codes of well-known binary.
KINDS = {1: "Point", 2: "LineString", 3: "Polygon", 4: "MultiPoint", 5: "MultiLineString", 6: "MultiPolygon", 7: "GeometryCollection"}


def kind_of(blob: bytes) -> str:
    return KINDS[struct.unpack_from("<I" if blob[0] else ">I", blob, 1)[0]]


def declaration(column: str, kinds: set[str]) -> str:
    return json.dumps({"version": "1.0.0", "primary_column": column, "columns": {column: {"encoding": "WKB", "geometry_types": sorted(kinds), "crs": CRS84}}})


class GeoParquetWriter(PartsWriter):
    suffix = ".parquet"

    def __init__(self, path: str, column: str, schema: StructType, overwrite: bool):
        super().__init__(path, schema, overwrite)
        self.column = column

    def parts(self, batches: Iterator[pa.RecordBatch], open_file) -> None:
        first, kinds = next(batches), set()
        with open_file() as file, pq.ParquetWriter(file, first.schema, compression="zstd") as out:
            for batch in itertools.chain([first], batches):
                kinds |= {kind_of(b) for b in batch.column(self.column).to_pylist() if b is not None}
                out.write_batch(batch)
            out.add_key_value_metadata({"geo": declaration(self.column, kinds)})


class GeoParquetSink(DataSource):
    """Options: path, and column (the geometry as well-known binary, default geometry)."""

    @classmethod
    def name(cls) -> str:
        return "geoparquet"

    def writer(self, schema: StructType, overwrite: bool) -> GeoParquetWriter:
        return GeoParquetWriter(self.options["path"], self.options.get("column", "geometry"), schema, overwrite)


def geometry_column(spark: SparkSession, path: str) -> str:
    """The primary geometry column that every file of a table declares; each must be WKB in longitude and latitude."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def footer(uri: str) -> str:
        file = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri)), conf)
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(file)
        try:
            return reader.getFooter().getFileMetaData().getKeyValueMetaData().get("geo")
        finally:
            reader.close()

    uris = spark.read.parquet(path).inputFiles()
    with ThreadPoolExecutor(8) as pool:
        declared = set(pool.map(footer, uris))
    columns = {_checked(text, path) for text in declared}
    if len(columns) != 1:
        raise ValueError(f"{path} declares several geometry columns: {', '.join(sorted(columns))}" if columns else f"{path} has no files")
    return columns.pop()


def _checked(text: str | None, path: str) -> str:
    try:
        geo = json.loads(text)
        column = geo["primary_column"]
        own = geo["columns"][column]
    except (TypeError, ValueError, KeyError) as e:
        raise ValueError(f"{path} declares no geometry in its footers") from e
    if own.get("encoding") != "WKB":
        raise ValueError(f"{path}: unsupported encoding {own.get('encoding')}")
    crs = own.get("crs", CRS84)  # left out, it is longitude and latitude
    if crs is None:
        raise ValueError(f"{path} declares no reference system")
    name = crs.get("id", {}) if isinstance(crs, dict) else {}
    if (name.get("authority"), str(name.get("code"))) not in LON_LAT:
        raise ValueError(f"{path}: unsupported reference system {name or crs}")
    return column
