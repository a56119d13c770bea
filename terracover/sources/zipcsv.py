"""CSV members of ZIP files (S7, E13): `spark.read.format("zipcsv")`, projected to the schema's columns, as text.

One partition for each (archive, member); a member is read as a stream of Arrow batches of bounded size. Read by
read_addresses(), comparisons with constants, IN lists, prefixes and null tests are pushed into the scan, so rows that
they reject never reach the JVM.
Options: path (files or folders by comma), sep (default ;), columns (by comma), pushdown (true: take filters over, which
needs the session's setting PUSHDOWN), counts (a folder into which every scan puts the rows that it read and kept).
`df.write.format("zipcsv")` writes a folder of archives, one member each; all columns must be text.
Empty text and a missing value are both written as nothing and read as null.
"""

from __future__ import annotations

import io
import json
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv as pv
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition, IsNotNull, IsNull, Not, StringStartsWith

from ..schema import ADDRESS_COLUMNS
from .stores import PartsWriter, file_system, listed

#: Bytes that Arrow parses at once; it reads several such blocks ahead, so they are small. A longer line gets larger ones.
BLOCK = 1 << 20
LONGEST = 256 << 20
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


class Member(InputPartition):
    def __init__(self, path: str, name: str):
        self.path, self.name = path, name


class ZipCsvSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "zipcsv"

    def columns(self) -> list[str]:
        own = self.options.get("columns")
        return [c.strip() for c in own.split(",")] if own else ADDRESS_COLUMNS

    def schema(self) -> str:
        return ", ".join(f"`{c}` string" for c in self.columns())

    def reader(self, schema) -> ZipCsvReader:
        kind = FilteredReader if self.options.get("pushdown") == "true" else ZipCsvReader
        return kind(listed(self.options["path"], ".zip"), [f.name for f in schema.fields], self.options.get("sep", ";"), self.options.get("counts"))

    def writer(self, schema, overwrite: bool) -> ZipCsvWriter:
        return ZipCsvWriter(self.options["path"], schema, overwrite, self.options.get("sep", ";"))


class ZipCsvReader(DataSourceReader):
    def __init__(self, paths: list[str], columns: list[str], sep: str, counts: str | None):
        self.paths, self.names, self.sep, self.counts = paths, columns, sep, counts
        self.tests: list[tuple] = []

    def partitions(self) -> list[Member]:
        out = []
        for p in self.paths:
            fs, path = file_system(p)
            with fs.open_input_file(path) as f, zipfile.ZipFile(f) as z:
                members = [n for n in z.namelist() if n.lower().endswith(".csv")]
            if not members:
                raise ValueError(f"{p} holds no CSV file")
            out += [Member(p, n) for n in members]
        return out

    def read(self, partition: Member) -> Iterator[pa.RecordBatch]:
        read = kept = 0
        for batch in self._batches(partition):
            own = batch if not self.tests else batch.filter(self._mask(batch))
            read, kept = read + batch.num_rows, kept + own.num_rows
            if own.num_rows:
                yield own
        if self.counts:
            fs, folder = file_system(self.counts)
            fs.create_dir(folder, recursive=True)
            with fs.open_output_stream(f"{folder}/{uuid.uuid4().hex}.json") as out:
                out.write(json.dumps({"archive": partition.path.rsplit("/", 1)[-1], "member": partition.name, "read": read, "kept": kept}).encode())

    def _batches(self, partition: Member) -> Iterator[pa.RecordBatch]:
        fs, path = file_system(partition.path)
        types = {c: pa.string() for c in self.names}
        convert = pv.ConvertOptions(column_types=types, include_columns=self.names, strings_can_be_null=True, null_values=[""], quoted_strings_can_be_null=True)
        block, done = BLOCK, 0
        while True:
            before = done  # rows that smaller blocks have given
            try:
                with fs.open_input_file(path) as file, zipfile.ZipFile(file) as z, z.open(partition.name) as f:
                    for batch in pv.open_csv(f, pv.ReadOptions(block_size=block, use_threads=False), pv.ParseOptions(delimiter=self.sep), convert):
                        skipped = min(before, batch.num_rows)
                        before -= skipped
                        done += batch.num_rows - skipped
                        yield batch.slice(skipped)
                return
            except pa.ArrowInvalid as e:
                if "block size" not in str(e) or block >= LONGEST:
                    raise
                block *= 16

    def _mask(self, batch: pa.RecordBatch) -> pa.Array:
        mask = None
        for kind, column, value, wanted in self.tests:
            own = batch.column(column)
            if kind == "null":
                test = own.is_null() if wanted else own.is_valid()
            elif kind == "in":
                test = pc.is_in(own, pa.array([v for v in value if v is not None], pa.string()))
            else:
                test = pc.fill_null(pc.starts_with(own, value), False)
            mask = test if mask is None else pc.and_(mask, test)
        return mask


class FilteredReader(ZipCsvReader):
    """Takes over the filters that the scan can decide; Spark asks for the setting PUSHDOWN before it hands any over."""

    def pushFilters(self, filters):
        for f in filters:
            test = self._test(f)
            if test:
                self.tests.append(test)
            else:
                yield f

    @staticmethod
    def _test(f) -> tuple | None:
        """(kind, column, value, wanted), if the scan can decide the filter."""
        wanted = True
        if isinstance(f, Not):
            f, wanted = f.child, False
            if not isinstance(f, (IsNull, IsNotNull)):  # a null passes neither the test nor its opposite
                return None
        if len(f.attribute) != 1:
            return None
        if isinstance(f, (IsNull, IsNotNull)):
            return "null", f.attribute[0], None, isinstance(f, IsNull) == wanted
        if isinstance(f, In):
            return "in", f.attribute[0], tuple(f.value), True
        if isinstance(f, EqualTo):
            return "in", f.attribute[0], (f.value,), True
        if isinstance(f, StringStartsWith):
            return "starts", f.attribute[0], f.value, True
        return None


class ZipCsvWriter(PartsWriter):
    suffix = ".zip"

    def __init__(self, path: str, schema, overwrite: bool, sep: str):
        super().__init__(path, schema, overwrite)
        self.sep = sep

    def parts(self, batches: Iterator[pa.RecordBatch], open_file) -> None:
        first = next(batches)
        with open_file() as file, zipfile.ZipFile(_Forward(file), "w", zipfile.ZIP_DEFLATED) as z, z.open("part.csv", "w", force_zip64=True) as member:
            out = pv.CSVWriter(member, first.schema, write_options=pv.WriteOptions(delimiter=self.sep, quoting_style="needed"))
            out.write_batch(first)
            for batch in batches:
                out.write_batch(batch)
            out.close()


class _Forward(io.RawIOBase):
    """An output stream that zipfile may not seek in."""

    def __init__(self, out):
        self.out = out

    def writable(self) -> bool:
        return True

    def write(self, data) -> int:
        self.out.write(data)
        return len(data)


def read_addresses(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """The address files, with filters pushed into the scan."""
    spark.dataSource.register(ZipCsvSource)
    spark.conf.set(PUSHDOWN, "true")  # filters reach the scan of a Python source only with this setting
    reader = spark.read.format("zipcsv").option("path", path).option("pushdown", "true")
    for name, value in options.items():
        reader = reader.option(name, value)
    return reader.load()
