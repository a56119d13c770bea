"""Token-ID output in a byte-aligned variable-length format (operator 2).

Format: a folder with three Parquet tables.
  ranks   (rank, id)                         ids by falling corpus frequency, ties by id
  shards  (shard, start, n_docs, n_tokens)   one row for each range of doc_id, in order
  data    (shard, doc_id, seq, start, n_tokens, control, bytes)
`bytes` holds the frequency rank of each id in one to four little-endian bytes; `control` holds, two
bits an id and four ids a byte, the byte count less one. The two are separate, so that a reader finds
all lengths with one table lookup (256 x 4) and all values with one gather.
Documents lie in ascending doc_id order: shard by shard, and by `seq` in a shard.

Passes: (1) encode every whole text once and store the ids; (2) count ids over the corpus; (3) recode
to ranks, range-partition by (doc_id, row number) at splitters drawn in proportion to size, and write. The
rank table is bounded by the vocabulary; SAMPLES keys a shard reach the driver.

Defined results: null or empty text holds the end id only; null doc_id sorts first; repeated doc_ids
are kept, in any order among themselves, and may lie on several shards; an empty table gives an empty
folder of the same schema; other columns are not written. A very long text is encoded in one call and
needs about 60 bytes of memory for each of its bytes.
"""

from __future__ import annotations

import json
import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BYTE_CODE, U64, Chunk, chunks_of, doc_of, drop_table, materialize, mix, new_path, ragged, read_table, shuffle_partitions

END_ID = 2
#: Slots of a worker's piece table (16 bytes each); when half are taken it forgets them all.
PIECE_SLOTS = 1 << 22
SHARD_BYTES = 64 << 20
SAMPLES = 16


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# ---------------------------------------------------------------- encoding with the library

class PieceTable:
    """Ids of the pieces a worker has met, in an open-addressing numpy table, with all bytes of each piece.

    A piece is looked up by a 64-bit hash and accepted only if length, leading space and bytes agree.
    """

    def __init__(self, slots: int):
        self.slots = slots
        self.forget()

    def forget(self) -> None:
        self.key, self.index = np.zeros(self.slots, U64), np.full(self.slots, -1, np.int32)
        self.starts, self.lens, self.size, self.raw_at = (np.zeros(1024, np.int64) for _ in range(4))
        self.low, self.high = np.zeros(1024, U64), np.zeros(1024, U64)
        self.flat, self.raw = np.zeros(8192, np.uint32), np.zeros(8192, np.uint8)
        self.n = self.n_flat = self.n_raw = 0

    def find(self, key: np.ndarray) -> np.ndarray:
        """The number of the piece with each key, or -1."""
        out = np.full(len(key), -1, np.int64)
        todo, slot = np.arange(len(key)), (key & U64(self.slots - 1)).astype(np.int64)
        while len(todo):
            index = self.index[slot]
            hit = (self.key[slot] == key[todo]) & (index >= 0)
            out[todo[hit]] = index[hit]
            go = ~hit & (index >= 0)
            todo, slot = todo[go], (slot[go] + 1) & (self.slots - 1)
        return out

    def same(self, which: np.ndarray, p: Pieces) -> np.ndarray:
        """Whether the pieces are, byte for byte, those that the table holds under which."""
        ok = (which >= 0) & (self.size[which] == p.size) & (self.low[which] == p.low) & (self.high[which] == p.high)
        long = np.flatnonzero(ok & (p.bytes_in > 16))
        n = p.bytes_in[long]
        differ = p.buf[ragged(p.at[long], n)] != self.raw[ragged(self.raw_at[which[long]], n)]
        if differ.any():
            ok[np.repeat(long, n)[differ]] = False
        return ok

    def add(self, p: Pieces, own: np.ndarray, ids: np.ndarray, lens: np.ndarray) -> None:
        """Put in the pieces own of p, which have distinct keys; ids holds the ids of one after another."""
        n, m = self.n + len(own), self.n_flat + len(ids)
        long = np.where(p.bytes_in[own] > 16, p.bytes_in[own], 0)
        z = self.n_raw + int(long.sum())
        for name, need in (("starts", n), ("lens", n), ("size", n), ("raw_at", n), ("low", n), ("high", n), ("flat", m), ("raw", z)):
            have = getattr(self, name)
            if need > len(have):
                setattr(self, name, np.concatenate((have, np.zeros(need + need // 2 - len(have), have.dtype))))
        self.starts[self.n : n] = self.n_flat + np.cumsum(lens) - lens
        self.lens[self.n : n], self.size[self.n : n], self.low[self.n : n], self.high[self.n : n] = lens, p.size[own], p.low[own], p.high[own]
        self.raw_at[self.n : n] = self.n_raw + np.cumsum(long) - long
        self.raw[self.n_raw : z] = p.buf[ragged(p.at[own], long)]
        self.flat[self.n_flat : m] = ids
        key = p.key[own]
        todo, slot = np.arange(len(key)), (key & U64(self.slots - 1)).astype(np.int64)
        while len(todo):
            first = np.zeros(len(todo), bool)
            first[np.unique(slot, return_index=True)[1]] = True
            put = first & (self.index[slot] < 0)
            to, at = todo[put], slot[put]
            self.key[at], self.index[at] = key[to], self.n + to
            todo, slot = todo[~put], (slot[~put] + 1) & (self.slots - 1)
        self.n, self.n_flat, self.n_raw = n, m, z


_LEAD = np.array([(1 << 8 * k) - 1 for k in range(9)], U64)


class Pieces:
    """Pieces buf[at:end], with or without a space before: their first 16 bytes as two numbers, and a hash."""

    def __init__(self, buf: np.ndarray, at: np.ndarray, end: np.ndarray, spaced: np.ndarray):
        self.buf, self.at, self.bytes_in = buf, at, end - at
        self.size = 2 * self.bytes_in + spaced
        padded = np.concatenate((buf, np.zeros(16, np.uint8)))
        word = np.ndarray((len(buf) + 9,), "<u8", padded.data, strides=(1,))
        self.low = word[at] & _LEAD[np.minimum(self.bytes_in, 8)]
        self.high = word[at + 8] & _LEAD[np.clip(self.bytes_in - 8, 0, 8)]
        self.key = mix(self.low ^ mix(self.high + self.size.astype(U64) * U64(0x9FB21C651E98DF25)))
        long = np.flatnonzero(self.bytes_in > 16)
        if len(long):
            n = self.bytes_in[long]
            first = np.cumsum(n) - n
            place = np.arange(int(n.sum())) - np.repeat(first, n)
            self.key[long] = mix(self.key[long] + np.add.reduceat(BYTE_CODE[buf[ragged(at[long], n)]] * mix(place.astype(U64)), first))


def _flags(values: bytes | range) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(values)] = True
    return out


_LETTER = _flags(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
_MARK = _flags(b".,")
_SOLID = _flags(range(0x21, 0x7F))
#: What may not follow a space at a cut: white space, or a first byte that white space may begin with.
_UNSURE = _flags([*range(0x21), 0xC2, 0xE1, 0xE2, 0xE3])


class PieceEncoder:
    """The tokenizers library, called once for each distinct piece of text that a worker meets.

    Texts are cut only where the vocabulary's pre-tokenizer always cuts: before a space that a non-space
    follows, around a single newline between printable ASCII characters, and before a full stop or comma
    between an ASCII letter and such a cut. No merge reaches over those cuts, so the ids of a text are
    the ids of its pieces. A piece is known again by all its bytes; hashes only find it. Texts with other
    white space at a cut, that may hold the string of a special token, or of which two pieces share a hash,
    go to the library whole, and so do all texts if the file's normaliser or pre-tokenizer is another one.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        rule = spec["pre_tokenizer"] or {}
        self.cuts = spec["normalizer"] is None and (rule.get("type"), rule.get("add_prefix_space"), rule.get("use_regex")) == ("ByteLevel", False, True)
        special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = [t for t in special if t]
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.bytes_of = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(size)], np.int64)
        self.table = PieceTable(PIECE_SLOTS)

    def library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, c: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the documents of a chunk, one after another, and how many each has."""
        buf, off = c.buf, c.off
        size = np.diff(off) - 1
        whole = np.full(c.n, not self.cuts)
        space = np.flatnonzero(buf == 32)
        unsure = space[_UNSURE[buf[space + 1]]]
        whole[doc_of(unsure, off)] = True
        whole[doc_of(off[:-1][(buf[off[:-1]] == 32) & (size > 0)], off)] = True
        for t in self.special:
            lead = np.flatnonzero(buf[:-1] == t[0])
            whole[doc_of(lead[buf[lead + 1] == t[1]] if len(t) > 1 else lead, off)] = True
        newline = np.flatnonzero(buf == 10)[:-1]
        newline = newline[(newline > 0) & _SOLID[buf[newline - 1]] & _SOLID[buf[newline + 1]]]
        newline = newline[~np.isin(newline, off[1:] - 1)]
        cut = np.zeros(len(buf) + 1, bool)
        cut[space], cut[newline], cut[off[1:] - 1] = True, True, True
        mark = np.flatnonzero(_MARK[buf])
        mark = mark[mark > 0]
        mark = mark[_LETTER[buf[mark - 1]] & cut[mark + 1]]
        begin = off[:-1][size > 0]
        # kinds: 0 behind nothing, 1 behind a space, 2 starts a text
        at = np.concatenate((begin, space + 1, newline, newline + 1, mark))
        kind = np.concatenate((np.full(len(begin), 2), np.ones(len(space), np.int64), np.zeros(2 * len(newline) + len(mark), np.int64)))
        order = np.argsort(at, kind="stable")
        at, kind = at[order], kind[order]
        doc = doc_of(at, off)
        good = ~whole[doc] if len(at) else np.zeros(0, bool)
        end = np.append(at[1:] - (kind[1:] == 1), 0)
        end = np.minimum(np.where(np.append(doc[1:] != doc[:-1], True), off[doc + 1] - 1, end), off[doc + 1] - 1) if len(at) else at
        at, kind, doc, end = at[good], (kind[good] == 1).astype(np.int64), doc[good], end[good]
        which = self.numbers(buf, at, end, kind)
        if (which < 0).any():
            whole[doc[which < 0]] = True
            which, doc = which[~whole[doc]], doc[~whole[doc]]
        lens = self.table.lens[which]
        ids = self.table.flat[ragged(self.table.starts[which], lens)]
        counts = np.bincount(doc, weights=lens, minlength=c.n).astype(np.int64)
        if whole.any():
            odd = np.flatnonzero(whole)
            found = self.library([buf[off[d] : off[d + 1] - 1].tobytes().decode() for d in odd])
            parts = np.split(ids, np.cumsum(counts)[:-1])
            for d, f in zip(odd.tolist(), found, strict=True):
                parts[d] = np.array(f, np.uint32)
                counts[d] = len(f)
            ids = np.concatenate(parts)
        return ids, counts

    def numbers(self, buf: np.ndarray, at: np.ndarray, end: np.ndarray, spaced: np.ndarray) -> np.ndarray:
        """Numbers in the table of the pieces buf[at:end], or -1 for one whose hash another piece has; unknown ones are learnt."""
        if self.table.n > PIECE_SLOTS // 2:
            self.table.forget()
        p = Pieces(buf, at, end, spaced)
        which = self.table.find(p.key)
        missing = np.flatnonzero(which < 0)
        if len(missing):
            new = missing[np.unique(p.key[missing], return_index=True)[1]]
            ids, lens = self.learn([buf[a:e].tobytes().decode() for a, e in zip(at[new].tolist(), end[new].tolist(), strict=True)], spaced[new].tolist())
            self.table.add(p, new, ids, lens)
            which[missing] = self.table.find(p.key[missing])
        return np.where(self.table.same(which, p), which, -1)

    def learn(self, pieces: list[str], spaced: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces from the library: plain ones go in long lines, cut again by the bytes of their tokens."""
        found: list = [None] * len(pieces)
        lines: dict[int, list[int]] = {0: [], 1: []}
        for k, (p, s) in enumerate(zip(pieces, spaced, strict=True)):
            if p and "!" <= p[0] <= "~" and "!" <= p[-1] <= "~" and len(p.split()) == 1 or s and p.isalpha():
                lines[s].append(k)
        for s, own in lines.items():
            for k in range(0, len(own), 2000):
                part = own[k : k + 2000]
                text = "".join(" " + pieces[i] for i in part) if s else "".join(pieces[i] + "\n" for i in part)[:-1]
                ids = np.array(self.library([text])[0], np.uint32)
                ends = np.cumsum(np.fromiter((len(pieces[i].encode()) + 1 for i in part), np.int64, len(part))) - (0 if s else 1)
                to = (np.searchsorted(np.cumsum(self.bytes_of[ids]), ends) + 1).tolist()
                begin = 0
                for i, e in zip(part, to, strict=True):
                    found[i] = ids[begin:e]
                    begin = e + (1 - s)  # the newline's id
        rest = [k for k, f in enumerate(found) if f is None]
        for k, f in zip(rest, self.library([(" " if spaced[k] else "") + pieces[k] for k in rest]), strict=True):
            found[k] = np.array(f, np.uint32)
        return np.concatenate(found), np.fromiter(map(len, found), np.int64, len(found))


_loaded: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    if path not in _loaded:
        _loaded[path] = PieceEncoder(path)
    return _loaded[path]


def encode_documents(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """doc_id, r (row number), and the ids of each whole text with the end id, as little-endian 16- or 32-bit integers."""
    from tokenizers import Tokenizer

    wide = max(Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True) - 1, end_id) > 0xFFFF
    kind = "<u4" if wide else "<u2"

    def run(batches):
        enc = encoder(path)
        for b in batches:
            for c in chunks_of(b.column(1), 1_000_000):
                ids, counts = enc.encode(c)
                out = np.full(len(ids) + c.n, end_id, kind)
                ends = np.cumsum(counts + 1)
                own = np.ones(len(out), bool)
                own[ends - 1] = False
                out[own] = ids
                width = out.itemsize
                offsets = pa.py_buffer(np.concatenate(([0], ends * width)).astype(np.int32))
                blobs = pa.Array.from_buffers(pa.binary(), c.n, [None, offsets, pa.py_buffer(out)])
                yield pa.record_batch({"doc_id": b.column(0).slice(int(c.rows[0]), c.n), "r": b.column(2).slice(int(c.rows[0]), c.n), "ids": blobs})

    out = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.monotonically_increasing_id()).mapInArrow(run, "doc_id long, r long, ids binary")
    return out.withMetadata("ids", {"width": 4 if wide else 2})


# ---------------------------------------------------------------- the variable-length code

#: Byte counts of the four ids of every control byte.
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.int64) + 1
_MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    values = values.astype("<u4")
    extra = (values > 0xFF).astype(np.uint8)
    extra += values > 0xFFFF
    extra += values > 0xFFFFFF
    code = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    code[: len(values)] = extra
    code = code.reshape(-1, 4)
    control = code[:, 0] | code[:, 1] << 2 | code[:, 2] << 4 | code[:, 3] << 6
    grid = values.view(np.uint8).reshape(-1, 4)
    return control.tobytes(), grid[np.arange(4) <= extra[:, None]].tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    lens = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    at = np.cumsum(lens) - lens
    padded = np.zeros(len(data) + 3, np.uint32)
    padded[: len(data)] = np.frombuffer(data, np.uint8)
    word = padded[at] | padded[at + 1] << np.uint32(8) | padded[at + 2] << np.uint32(16) | padded[at + 3] << np.uint32(24)
    return word & _MASKS[lens]


# ---------------------------------------------------------------- writing and reading


def count_ids(encoded: DataFrame, kind: str) -> np.ndarray:
    """How often each id occurs in the corpus (one value for each id up to the largest)."""

    def run(batches):
        total = np.zeros(0, np.int64)
        for b in batches:
            for blob in b.column(0):
                own = np.bincount(np.frombuffer(blob.as_buffer(), kind), minlength=len(total))
                own[: len(total)] += total
                total = own
        used = np.flatnonzero(total)
        yield pa.record_batch({"id": pa.array(used, pa.int64()), "n": pa.array(total[used], pa.int64())})

    rows = encoded.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(int(rows["id"].max()) + 1 if len(rows) else 0, np.int64)
    counts[rows["id"]] = rows["n"]
    return counts


def _range_keys(doc_id: pa.Array, r: pa.Array) -> np.ndarray:
    """Byte strings that order like (doc_id, r), null first."""
    pair = np.stack([doc_id.fill_null(-(2**63)).to_numpy(), r.to_numpy()], axis=1).astype(np.int64)
    return (pair.view(U64) ^ U64(1 << 63)).astype(">u8").view("S16").ravel()


def write_tokens(docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID, shard_bytes: int = SHARD_BYTES) -> None:
    """Encode docs (doc_id, text) and write them under path in the module's format."""
    spark = docs.sparkSession
    encoded = encode_documents(docs, tokenizer, end_id)
    kind = f"<u{encoded.schema['ids'].metadata['width']}"
    encoded = materialize(encoded, "token-ids")
    counts = count_ids(encoded, kind)
    by_rank = np.lexsort((np.arange(len(counts)), -counts))
    by_rank = by_rank[counts[by_rank] > 0].astype(np.uint32)
    rank_of = np.zeros(len(counts), np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank))
    total = int(counts.sum()) * 3 // 2
    n_shards = max(shuffle_partitions(spark), total // shard_bytes)
    chance = F.octet_length("ids") * F.lit(1.5 * SAMPLES / max(1, total)) * n_shards
    drawn = encoded.where(F.shiftrightunsigned(F.xxhash64("doc_id", "r"), 11) / F.lit(float(2**53)) < chance).select("doc_id", "r").toArrow()
    drawn = np.sort(_range_keys(drawn["doc_id"], drawn["r"]))
    bounds = np.unique(drawn[np.arange(1, n_shards) * len(drawn) // n_shards]) if len(drawn) else drawn

    def recode(batches):
        for b in batches:
            shard = np.searchsorted(bounds, _range_keys(b.column(0), b.column(1)), side="right")
            n, control, data = [], [], []
            for blob in b.column(2):
                own = rank_of[np.frombuffer(blob.as_buffer(), kind)]
                c, d = pack(own)
                n.append(len(own))
                control.append(c)
                data.append(d)
            yield pa.record_batch({"shard": pa.array(shard, pa.int32()), "doc_id": b.column(0), "r": b.column(1), "n_tokens": pa.array(n, pa.int64()), "control": pa.array(control, pa.binary()), "bytes": pa.array(data, pa.binary())})

    def place(batches):
        shard = seq = start = 0
        for b in batches:
            own = b.column(0).to_numpy()
            if not len(own):
                continue
            n = b.column(2).to_numpy()
            if seq and own[0] != shard:
                seq = start = 0
            shard = own[0]
            new = np.flatnonzero(np.concatenate(([False], own[1:] != own[:-1])))  # shards that share a task
            pos, begin = seq + np.arange(len(own)), start + np.cumsum(n) - n
            for k in new:
                pos[k:] -= pos[k]
                begin[k:] -= begin[k]
            shard, seq, start = own[-1], int(pos[-1]) + 1, int(begin[-1] + n[-1])
            yield pa.record_batch({"shard": b.column(0), "doc_id": b.column(1), "seq": pa.array(pos), "start": pa.array(begin), "n_tokens": b.column(2), "control": b.column(3), "bytes": b.column(4)})

    recoded = encoded.mapInArrow(recode, "shard int, doc_id long, r long, n_tokens long, control binary, bytes binary")
    ordered = recoded.repartitionById(len(bounds) + 1, F.col("shard")).sortWithinPartitions("shard", "doc_id", "r").drop("r")
    placed = ordered.mapInArrow(place, "shard int, doc_id long, seq long, start long, n_tokens long, control binary, bytes binary")
    placed.write.option("compression", "zstd").parquet(f"{path}/data")
    spark.createDataFrame([(k, int(i)) for k, i in enumerate(by_rank)], "rank int, id long").coalesce(1).write.parquet(f"{path}/ranks")
    sums = spark.read.parquet(f"{path}/data").groupBy("shard").agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).orderBy("shard").collect()
    before, rows = 0, []
    for s in sums:  # one row a shard
        rows.append((s["shard"], before, s["n_docs"], s["n_tokens"]))
        before += s["n_tokens"]
    spark.createDataFrame(rows, "shard int, start long, n_docs long, n_tokens long").coalesce(1).write.parquet(f"{path}/shards")
    drop_table(encoded)


def read_tokens(spark: SparkSession, path: str, decode) -> DataFrame:
    """doc_id, start (of the corpus), n_tokens and decode(ids) -> long for every document under path."""
    ranks = spark.read.parquet(f"{path}/ranks").toPandas()  # bounded by the vocabulary
    by_rank = np.zeros(len(ranks), np.uint32)
    by_rank[ranks["rank"]] = ranks["id"]

    def run(batches):
        for b in batches:
            n = b.column(3).to_pylist()
            out = [decode(by_rank[unpack(c.as_buffer(), d.as_buffer(), k)]) for c, d, k in zip(b.column(4), b.column(5), n, strict=True)]
            yield pa.record_batch({"shard": b.column(0), "doc_id": b.column(1), "start": b.column(2), "n_tokens": b.column(3), "value": pa.array(out, pa.int64())})

    data = spark.read.parquet(f"{path}/data").select("shard", "doc_id", "start", "n_tokens", "control", "bytes")
    rows = data.mapInArrow(run, "shard int, doc_id long, start long, n_tokens long, value long")
    shards = spark.read.parquet(f"{path}/shards").select("shard", F.col("start").alias("before"))
    return rows.join(shards, "shard").select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "value")


def ids_crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def op2_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "tokens")
    write_tokens(read_table(spark, sf_dir, "documents"), vocabulary_path(), path)
    return read_tokens(spark, path, ids_crc32).withColumnRenamed("value", "ids_crc32")
