"""Files that Python workers read and write in any store they reach without the JVM, and a commit protocol for parts."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql.datasource import DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or address (file, hdfs, s3, gs, ...), and the path in it."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(path)


def listed(paths: str, suffix: str) -> list[str]:
    """Files by comma, or those of a folder that end in suffix, by name."""
    out = []
    for path in paths.split(","):
        fs, root = file_system(path.strip())
        if fs.get_file_info(root).type != pafs.FileType.Directory:
            out.append(path.strip())
            continue
        names = sorted(f.base_name for f in fs.get_file_info(pafs.FileSelector(root)) if f.base_name.lower().endswith(suffix))
        out += [f"{path.strip().rstrip('/')}/{name}" for name in names]
    return out


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class PartsWriter(DataSourceArrowWriter):
    """A folder of part files: each task writes its own under a temporary folder, the commit moves those of the tasks
    that succeeded into place, and an abort removes them.

    Subclasses say in parts() how batches become files. A table without rows gets one file.
    """

    suffix = ""

    def __init__(self, path: str, schema: StructType, overwrite: bool):
        self.path, self.schema, self.overwrite = path, schema, overwrite
        self.temporary = f"_temporary/{uuid.uuid4().hex}"

    def parts(self, batches: Iterator[pa.RecordBatch], open_file) -> None:
        """Write all batches; open_file() gives a new part to write bytes to."""
        raise NotImplementedError

    def write(self, iterator) -> Written:
        first = next(iterator, None)
        return Written([] if first is None else self._written(first, iterator))

    def _written(self, first: pa.RecordBatch, rest: Iterator[pa.RecordBatch]) -> list[str]:
        fs, root = file_system(self.path)
        fs.create_dir(f"{root}/{self.temporary}", recursive=True)
        names: list[str] = []

        def open_file():
            names.append(f"part-{uuid.uuid4().hex}{self.suffix}")
            return fs.open_output_stream(f"{root}/{self.temporary}/{names[-1]}")

        def batches():
            yield first
            yield from rest

        self.parts(batches(), open_file)
        return names

    def commit(self, messages) -> None:
        from pyspark.sql.pandas.types import to_arrow_schema

        fs, root = file_system(self.path)
        names = [n for m in messages if m is not None for n in m.names]
        names = names or self._written(pa.RecordBatch.from_pylist([], schema=to_arrow_schema(self.schema)), iter(()))
        if self.overwrite:
            for f in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True)):
                if f.base_name != "_temporary":
                    (fs.delete_dir if f.type == pafs.FileType.Directory else fs.delete_file)(f.path)
        for name in names:
            fs.move(f"{root}/{self.temporary}/{name}", f"{root}/{name}")
        fs.open_output_stream(f"{root}/_SUCCESS").close()
        self._clear(fs, root)

    def abort(self, messages) -> None:
        self._clear(*file_system(self.path))

    def _clear(self, fs: pafs.FileSystem, root: str) -> None:
        for folder in (self.temporary, "_temporary"):  # the second only if no other writer is at work
            own = f"{root}/{folder}"
            if fs.get_file_info(own).type == pafs.FileType.Directory and (folder == self.temporary or not fs.get_file_info(pafs.FileSelector(own))):
                fs.delete_dir(own)
