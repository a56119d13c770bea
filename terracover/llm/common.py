"""Helpers shared by the training-data operators: shared-folder tables and numpy text kernels.

The kernels work on one bounded chunk of documents at a time: the UTF-8 bytes of all texts of the
chunk lie in one uint8 array, and words, lines and windows are found with array operations.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

U64 = np.uint64
CHUNK_BYTES = 2_000_000
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share; a temporary one only where a local session names none."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="shared-tables-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/tables/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write df to the shared folder and read it back, which cuts the lineage.

    Spark removes the shuffle files of the write when it ends: only the table is read from there on.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.option("compression", codec).parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._table_path = path
    return out


def drop_table(df: DataFrame) -> None:
    """Remove a table written by materialize() that nothing reads any more."""
    remove_path(df.sparkSession, getattr(df, "_table_path", None))


def remove_path(spark: SparkSession, path: str | None) -> None:
    if path:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# ---------------------------------------------------------------- chunks of texts


@dataclass
class Chunk:
    """Some documents: ids, row numbers in their batch, and their bytes in one array.

    Document d holds bytes [off[d], off[d+1] - 1) of buf; the byte after each is a newline put
    there as a separator, so that no word reaches over two documents. A piece of a long text is a
    chunk of its own, with the place of its first byte in the text, and whether it is the last piece.
    """

    rows: np.ndarray
    off: np.ndarray
    buf: np.ndarray
    base: int = 0
    last: bool = True

    @property
    def n(self) -> int:
        return len(self.rows)


def binary_column(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """A text column as one large_binary array without nulls (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
        column = column.cast(pa.large_binary())
    elif not pa.types.is_large_binary(column.type):
        column = column.cast(pa.large_string()).cast(pa.large_binary())
    return column.fill_null(b"") if column.null_count else column


def chunks_of(column: pa.Array, limit: int = CHUNK_BYTES, overlap: int | None = None) -> Iterator[Chunk]:
    """Cut a text column into chunks of at most about limit bytes, or of one longer text.

    With an overlap, a longer text comes in pieces of limit bytes, each with so many bytes of the next.
    """
    arr = binary_column(column)
    n = len(arr)
    if not n:
        return
    offsets = np.frombuffer(arr.buffers()[1], dtype=np.int64)[arr.offset : arr.offset + n + 1]
    data = np.frombuffer(arr.buffers()[2], dtype=np.uint8) if arr.buffers()[2] is not None and arr.buffers()[2].size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        lens = np.diff(offsets[at : to + 1])
        if overlap is not None and lens[0] > limit + overlap:
            for base in range(0, int(lens[0]) - overlap, limit):
                own = data[offsets[at] + base : min(offsets[at] + base + limit + overlap, offsets[to])]
                yield Chunk(np.arange(at, to), np.array([0, len(own) + 1]), np.append(own, np.uint8(10)), base, base + limit + overlap >= lens[0])
            at = to
            continue
        off = np.zeros(to - at + 1, np.int64)
        np.cumsum(lens + 1, out=off[1:])
        buf = np.full(int(off[-1]), 10, np.uint8)
        if to - at == 1:
            buf[:-1] = data[offsets[at] : offsets[to]]
        else:
            keep = np.ones(len(buf), bool)
            keep[off[1:] - 1] = False
            buf[keep] = data[offsets[at] : offsets[to]]
        yield Chunk(np.arange(at, to), off, buf)
        at = to


SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def word_bounds(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of [^\\x20\\x09-\\x0D] in buf (which ends with a space)."""
    word = ~SPACE[buf]
    edge = np.flatnonzero(word[1:] != word[:-1]) + 1
    if len(buf) and word[0]:
        edge = np.concatenate(([0], edge))
    return edge[0::2], edge[1::2]


_rng = np.random.Generator(np.random.PCG64(20240229))
BYTE_CODE = _rng.integers(1, 2**64, 256, dtype=U64)
BASE = int(_rng.integers(1, 2**63, dtype=U64)) * 2 + 1
BASE_INV = pow(BASE, -1, 2**64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(12, int(n - 1).bit_length())
        have = np.full(size, base & (2**64 - 1), U64)
        have[0] = 1
        np.cumprod(have, out=have)
        if size > 1 << 23:
            return have[:n]
        _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (splitmix finalizer)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """Prefix sums of code(byte) * BASE**position; differences hash any stretch of buf."""
    out = np.zeros(len(buf) + 1, U64)
    np.cumsum(BYTE_CODE[buf] * powers(BASE, len(buf)), out=out[1:])
    return out


def stretch_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of buf[start:end] that depend on the bytes only."""
    h = (prefix[end] - prefix[start]) * powers(BASE_INV, len(prefix))[start]
    return mix(h + (end - start).astype(U64) * U64(0x9E3779B97F4A7C15))


def window_hash(values: np.ndarray, width: int) -> np.ndarray:
    """Hashes of each run of width consecutive values, for every start 0 .. n - width."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, U64)
    prefix = np.zeros(len(values) + 1, U64)
    np.cumsum(values * powers(BASE, len(values)), out=prefix[1:])
    return mix((prefix[width:] - prefix[:-width]) * powers(BASE_INV, n) + U64(width))


def window_hashes(values: np.ndarray, width: int, step: int = 250_000) -> np.ndarray:
    """window_hash in steps, so that a long run of values needs little more than its hashes."""
    parts = [window_hash(values[a : a + step + width - 1], width) for a in range(0, len(values) - width + 1, step)]
    return np.concatenate(parts) if parts else np.zeros(0, U64)


def word_hashes(buf: np.ndarray, off: np.ndarray, piece: int = 500_000) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word of a chunk's bytes, and its document.

    The bytes are gone through in pieces that end behind a space; only one longer word makes a longer piece.
    """
    space = SPACE[buf]
    words, docs = [np.zeros(0, U64)], [np.zeros(0, np.int32)]
    at = 0
    while at < len(buf):
        to = min(at + piece, len(buf))
        to += int(space[to - 1 :].argmax())  # a chunk ends with a newline
        own = buf[at:to]
        starts, ends = word_bounds(own)
        words.append(stretch_hash(prefix_hash(own), starts, ends))
        docs.append(doc_of(starts + at, off).astype(np.int32))
        at = to
    return np.concatenate(words), np.concatenate(docs)


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    """A-Z to a-z; every other byte stays."""
    return np.where((buf >= 65) & (buf <= 90), buf | 32, buf)


def doc_of(starts: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Which document of a chunk each position lies in."""
    return np.searchsorted(off, starts, side="right") - 1


def ragged(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Indices start .. start + len - 1 of every stretch, one after another."""
    total = int(lens.sum())
    if not total:
        return np.zeros(0, np.int64)
    at = np.cumsum(lens) - lens
    return np.repeat(starts - at, lens) + np.arange(total)


def to_arrow(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) if not isinstance(columns[f.name], pa.Array) else columns[f.name] for f in schema], schema=schema)


# ---------------------------------------------------------------- one bounded membership filter

#: Bits of the largest membership filter (16 MiB), whatever the input size. Beyond the load at which
#: it is selective it only lets more rows through to the exact join behind it.
FILTER_BITS = 1 << 27


def key_filter(keys: DataFrame, column: str, expected: int) -> np.ndarray:
    """A bit set over hashed 64-bit keys, built by the executors and joined on the driver.

    Size: a power of two near 16 bits a key, 1 MiB at least and FILTER_BITS at most, so what is broadcast is bounded.
    """
    bits = 1 << min(FILTER_BITS.bit_length() - 1, max(23, int(16 * max(1, expected) - 1).bit_length()))
    parts = min(256, max(1, expected // 200_000 + 1))
    page = 4096

    def build(batches):
        have = np.zeros(bits // 8, np.uint8)
        for b in batches:
            at = filter_slot(b.column(0).to_numpy(zero_copy_only=False).view(U64), bits)
            np.bitwise_or.at(have, at >> 3, (1 << (at & 7)).astype(np.uint8))
        pages = have.reshape(-1, page)
        used = np.flatnonzero(pages.any(axis=1))
        yield pa.record_batch({"page": pa.array(used.astype(np.int32)), "blob": pa.array([pages[k].tobytes() for k in used], pa.binary())})

    def merge(batches):
        pages: dict[int, np.ndarray] = {}  # at most those of the filter
        for b in batches:
            for k, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                own = np.frombuffer(blob, np.uint8)
                pages[k] = pages[k] | own if k in pages else own
        yield pa.record_batch({"page": pa.array(list(pages), pa.int32()), "blob": pa.array([p.tobytes() for p in pages.values()], pa.binary())})

    out = np.zeros((bits // 8 // page, page), np.uint8)
    built = keys.select(column).coalesce(parts).mapInArrow(build, "page int, blob binary")
    rows = built.repartition(min(parts, 16), "page").mapInArrow(merge, "page int, blob binary").toArrow()
    for k, blob in zip(rows["page"].to_pylist(), rows["blob"].to_pylist(), strict=True):
        out[k] |= np.frombuffer(blob, np.uint8)
    return out.ravel()


def filter_slot(keys: np.ndarray, bits: int) -> np.ndarray:
    return (mix(keys) & U64(bits - 1)).astype(np.int64)


def maybe_in(have: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = filter_slot(keys, len(have) * 8)
    return (have[at >> 3] >> (at & 7)) & 1 == 1
