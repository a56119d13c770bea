"""Cross-tokenizer alignment (operator 13).

Each text, with a space before it, is encoded by two tokenizers: A, a byte-level vocabulary of the tokenizers
library, and B, a sentencepiece model. Byte offsets at which tokens of both end cut a text into groups; every
A token is linked with every B token of its group. A pair of ids counts the documents that hold it linked.

  1. align: ends of tokens by cumulative sums of their byte lengths, common cuts by intersect1d, the group of
     a token by searchsorted, links by repeating each A token for the B tokens of its group, all documents of a
     chunk at once. What is kept of a document: its numbers, a digest of its groups, and its distinct pairs with
     how often each occurs (groups of more than WIDE links are expanded by distinct ids only);
  2. count: a task adds up its pairs, then a shuffle by (pair, salt) and one by pair add up the tasks;
  3. judge: the best count of an A id is at most one row an id (bounded by the vocabulary, so it is broadcast). The
     HOT_PAIRS most frequent pairs, a table of bounded size, go to the tasks that hold the documents' pairs;
     pairs beyond it are joined by a shuffle and added up by document. Every pair is judged by one of the two.

Encoding: A by the piece table of the token writer, whose ids equal the library's. B is cut before a space that
stands between other characters: no piece of the model holds a space behind another character (checked when it is
loaded, else texts go whole), so no merge reaches over such a cut and the ids of a text are those of its units;
a worker remembers units by all their bytes.

Defined results: a null or empty text, and one whose joined token bytes by A or B differ from space and text, has
no tokens: zeros and an empty digest; the strings of special tokens are plain text; repeated rows and doc_ids,
null ones too, count and are returned each; an empty table gives no rows; other columns are ignored. A text over
PIECE bytes is aligned in pieces, cut at a space between printable ASCII characters, where both tokenizers cut.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import byte_symbols
from .common import Chunk, chunks_of, doc_of, drop_table, materialize, ragged, read_table
from .tokens import PieceEncoder, PieceTable, vocabulary_path

PIECE = 1_000_000
#: Links of a group beyond which distinct ids are paired instead of tokens.
WIDE = 4096
SALTS = 16
HOT_PAIRS = 1 << 20
#: Slots of a worker's piece tables; when half are taken they are emptied.
SLOTS = 1 << 21
#: Pairs a counting task holds before it adds them up or puts them out.
HELD = 4_000_000


# ---------------------------------------------------------------- the two tokenizers


class _Bounded(PieceEncoder):
    def numbers(self, buf: np.ndarray, at: np.ndarray, end: np.ndarray, spaced: np.ndarray) -> np.ndarray:
        if self.table.n > SLOTS // 2:
            self.table.forget()
        return super().numbers(buf, at, end, spaced)


class ByteTokens(_Bounded):
    """Tokenizer A. Chunks hold 'a ' before every text; its token 'a' is taken off again."""

    def __init__(self, path: str):
        super().__init__(path)
        self.tokenizer.encode_special_tokens = True
        self.table = PieceTable(SLOTS)
        as_byte = {s: b for b, s in enumerate(byte_symbols())}
        names = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size(with_added_tokens=True))]
        self.token_bytes = [bytes(as_byte[c] for c in t) if all(c in as_byte for c in t) else t.encode() for t in names]
        if len(self.library(["a"])[0]) != 1:
            raise ValueError("the vocabulary has no token for the letter a")

    def spaced(self, c: Chunk) -> tuple[np.ndarray, np.ndarray]:
        ids, counts = self.encode(c)
        own = np.ones(len(ids), bool)
        own[np.cumsum(counts) - counts] = False
        return ids[own], counts - 1


class UnitTokens(_Bounded):
    """Tokenizer B: a sentencepiece model that puts a space before its input."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.table = PieceTable(SLOTS)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.cuts = not any("▁" in p.lstrip("▁") for p in pieces) and self.model.encode("a b") == [*self.model.encode("a"), *self.model.encode("b")]
        self.token_bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]

    def learn(self, pieces: list[str], spaced: list[int]) -> tuple[np.ndarray, np.ndarray]:
        found = self.model.encode(pieces, num_threads=1)
        lens = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((i for f in found for i in f), np.uint32, int(lens.sum())), lens

    def spaced(self, c: Chunk) -> tuple[np.ndarray, np.ndarray]:
        buf, off = c.buf, c.off
        begin, stop = off[:-1] + 2, off[1:] - 1
        some = stop > begin
        space = np.flatnonzero(buf == 32)
        if self.cuts:  # U+2581 is a space to the model, so no cut beside what may be one
            before, after = buf[space - 1], buf[space + 1]
            space = space[(before != 32) & (before != 0x81) & (after != 32) & (after != 0xE2)]
            doc = doc_of(space, off)
            space = space[(space > begin[doc]) & (space + 1 < stop[doc])]
        else:
            space = space[:0]
        at = np.sort(np.concatenate((begin[some], space + 1)))
        doc = doc_of(at, off)
        last = np.append(doc[1:] != doc[:-1], True) if len(at) else np.zeros(0, bool)
        end = np.where(last, stop[doc], np.append(at[1:], 0) - 1) if len(at) else at
        which = self.numbers(buf, at, end, np.ones(len(at), np.int64))
        odd = np.zeros(c.n, bool)
        odd[doc[which < 0]] = True
        which, doc = which[~odd[doc]], doc[~odd[doc]]
        lens = self.table.lens[which]
        ids = self.table.flat[ragged(self.table.starts[which], lens)]
        counts = np.bincount(doc, weights=lens, minlength=c.n).astype(np.int64)
        if odd.any():
            parts = np.split(ids, np.cumsum(counts)[:-1])
            for d in np.flatnonzero(odd).tolist():
                parts[d] = np.array(self.model.encode(buf[begin[d] : stop[d]].tobytes().decode()), np.uint32)
                counts[d] = len(parts[d])
            ids = np.concatenate(parts)
        return ids, counts


class TokenBytes:
    """The bytes of every token, one after another, and the decimal digits of its id."""

    def __init__(self, tokens: list[bytes]):
        self.lens = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.at = np.cumsum(self.lens) - self.lens
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return self.flat[ragged(self.at[ids], self.lens[ids])]


# ---------------------------------------------------------------- alignment of a chunk


@dataclass
class Aligned:
    """The documents of a chunk: numbers of each, the line of its groups, and its distinct pairs."""

    good: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    lines: list[bytes]
    pairs: list[np.ndarray]
    times: list[np.ndarray]


class Aligner:
    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = ByteTokens(a_path), UnitTokens(b_path)
        self.a_bytes, self.b_bytes = TokenBytes(self.a.token_bytes), TokenBytes(self.b.token_bytes)
        self.n_b = len(self.b.token_bytes)
        names = [str(i).encode() for i in range(max(len(self.a.token_bytes), self.n_b))]
        self.digits = np.zeros((len(names), len(names[-1]) + 1), np.uint8)
        self.shown = np.zeros(self.digits.shape, bool)
        for i, name in enumerate(names):
            self.digits[i, : len(name)] = list(name)
            self.shown[i, : len(name)] = True
        self.shown[:, -1] = True  # the separator

    def align(self, c: Chunk) -> Aligned:
        """Tokens of all documents of a chunk, and what they link."""
        off = c.off + 2 * np.arange(c.n + 1)
        buf = np.full(int(off[-1]), 10, np.uint8)
        text = np.ones(len(buf), bool)
        text[off[:-1]] = text[off[:-1] + 1] = False
        buf[text] = c.buf
        buf[off[:-1]], buf[off[:-1] + 1] = 97, 32
        wide = Chunk(c.rows, off, buf)
        (a, n_a), (b, n_b) = self.a.spaced(wide), self.b.spaced(wide)
        size = np.diff(off) - 2  # the space and the text
        good = size > 1
        for ids, n, table in ((a, n_a, self.a_bytes), (b, n_b, self.b_bytes)):
            good &= self._equal(ids, n, table, wide, size)
        a, b = a[np.repeat(good, n_a)].astype(np.int64), b[np.repeat(good, n_b)].astype(np.int64)
        n_a, n_b, size = n_a * good, n_b * good, size * good

        ends_a, ends_b = np.cumsum(self.a_bytes.lens[a]), np.cumsum(self.b_bytes.lens[b])
        cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_a, group_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
        in_a, in_b = np.bincount(group_a, minlength=len(cuts)), np.bincount(group_b, minlength=len(cuts))
        doc = np.searchsorted(np.cumsum(size), cuts)  # of each group
        links = in_a * in_b
        pairs, times, at = self._links(a, b, group_a, group_b, in_a, in_b, doc, c.n)
        return Aligned(good, n_a, n_b, np.bincount(doc, minlength=c.n), _by_doc(doc, links, c.n), self._lines(a, b, group_a, group_b, in_a, in_b, n_a, n_b), np.split(pairs, at), np.split(times, at))

    @staticmethod
    def _equal(ids: np.ndarray, n: np.ndarray, table: TokenBytes, c: Chunk, size: np.ndarray) -> np.ndarray:
        """Whether the joined tokens of each document are a space and its text."""
        doc = np.repeat(np.arange(c.n), n)
        ok = _by_doc(doc, table.lens[ids], c.n) == size
        joined = table.joined(ids[ok[doc]])
        want = c.buf[ragged(c.off[:-1][ok] + 1, size[ok])]
        if not np.array_equal(joined, want):
            ok[np.repeat(np.flatnonzero(ok), size[ok])[joined != want]] = False
        return ok

    def _links(self, a, b, group_a, group_b, in_a, in_b, doc, n) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct pairs (a * n_b + b) of every document in order, how often each occurs, and where documents begin."""
        span = len(self.a.token_bytes) * self.n_b
        narrow = in_a * in_b <= WIDE
        first_a, first_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
        keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        own = np.flatnonzero(narrow[group_a])
        reps = in_b[group_a[own]]
        other = b[ragged(first_b[group_a[own]], reps)]
        k, m = np.unique(np.repeat(doc[group_a[own]] * span + a[own] * self.n_b, reps) + other, return_counts=True)
        keys.append(k)
        counts.append(m)
        for g in np.flatnonzero(~narrow).tolist():
            left, m_left = np.unique(a[first_a[g] : first_a[g] + in_a[g]], return_counts=True)
            right, m_right = np.unique(b[first_b[g] : first_b[g] + in_b[g]], return_counts=True)
            keys.append((doc[g] * span + left[:, None] * self.n_b + right).ravel())
            counts.append((m_left[:, None] * m_right).ravel())
        key, count = np.concatenate(keys), np.concatenate(counts)
        if len(keys) > 2:
            key, back = np.unique(key, return_inverse=True)
            count = np.bincount(back, weights=count).astype(np.int64)
        return key % span, count, np.searchsorted(key, np.arange(1, n) * span)

    def _lines(self, a, b, group_a, group_b, in_a, in_b, n_a, n_b) -> list[bytes]:
        """'a1,a2|b1;a3|b2,b3' of every document."""
        before_a, before_b = np.cumsum(in_a), np.cumsum(in_b) - in_b
        ids, marks = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), 44, np.uint8)
        at_a, at_b = np.arange(len(a)) + before_b[group_a], np.arange(len(b)) + before_a[group_b]
        ids[at_a], ids[at_b] = a, b
        marks[before_a + before_b - 1] = 124
        marks[before_a + before_b + in_b - 1] = 59
        grid = self.digits[ids]
        grid[:, -1] = marks
        shown = self.shown[ids]
        raw = grid[shown].tobytes()
        ends = np.cumsum(shown.sum(axis=1))
        stops = np.concatenate(([0], ends))[np.cumsum(n_a + n_b)].tolist()
        return [raw[x : y - 1] if y > x else b"" for x, y in zip([0, *stops[:-1]], stops, strict=True)]


def _by_doc(doc: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(doc, weights=weights, minlength=n).astype(np.int64)


_SOLID = np.zeros(256, bool)
_SOLID[0x21:0x7F] = True


def pieces_of(c: Chunk, limit: int = PIECE) -> Iterator[Chunk]:
    """A chunk as it is, or a long text cut at single spaces between printable ASCII characters, which are left out."""
    if c.n > 1 or len(c.buf) <= 2 * limit:
        yield c
        return
    space = np.flatnonzero(c.buf[:-1] == 32)
    space = space[(space > 0) & _SOLID[c.buf[space - 1]] & _SOLID[c.buf[space + 1]]]
    at = 0
    while at < len(c.buf):
        k = int(np.searchsorted(space, at + limit))
        to = int(space[k]) if k < len(space) else len(c.buf) - 1
        yield Chunk(c.rows, np.array([0, to - at + 1]), np.append(c.buf[at:to], np.uint8(10)))
        at = to + 1


_loaded: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    if (a_path, b_path) not in _loaded:
        _loaded[a_path, b_path] = Aligner(a_path, b_path)
    return _loaded[a_path, b_path]


ALIGNED = "doc_id long, r long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary"


def align_documents(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """ALIGNED for every row; r is its number, pairs holds a * (ids of B) + b and times how often, 32 bits each."""

    def run(batches):
        own = aligner(a_path, b_path)
        for b in batches:
            for c in chunks_of(b.column(1), PIECE):
                parts = [own.align(p) for p in pieces_of(c)]
                x = parts[0]
                if len(parts) > 1:
                    x = _joined(parts)
                sha = [hashlib.sha256(line).hexdigest() if ok else "" for ok, line in zip(x.good.tolist(), x.lines, strict=True)]
                numbers = [pa.array(v * x.good) for v in (x.n_a, x.n_b, x.n_groups, x.n_links)]
                blobs = [pa.array([v.astype("<u4").tobytes() for v in values], pa.binary()) for values in (x.pairs, x.times)]
                at = int(c.rows[0])
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, c.n), b.column(2).slice(at, c.n), *numbers, pa.array(sha), *blobs], [f.split()[0] for f in ALIGNED.split(", ")])

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")), F.monotonically_increasing_id())
    return rows.mapInArrow(run, ALIGNED)


def _joined(parts: list[Aligned]) -> Aligned:
    """The pieces of one text as one document."""
    good = np.array([all(p.good.all() for p in parts)])
    if not good[0]:
        zero = np.zeros(1, np.int64)
        return Aligned(good, zero, zero, zero, zero, [b""], [zero[:0]], [zero[:0]])
    pair, back = np.unique(np.concatenate([p.pairs[0] for p in parts]), return_inverse=True)
    times = np.bincount(back, weights=np.concatenate([p.times[0] for p in parts])).astype(np.int64)
    sums = [sum(getattr(p, k) for p in parts) for k in ("n_a", "n_b", "n_groups", "n_links")]
    return Aligned(good, *sums, [b";".join(p.lines[0] for p in parts)], [pair], [times])


# ---------------------------------------------------------------- counts of the corpus


def pair_counts(aligned: DataFrame, n_b: int) -> DataFrame:
    """(pair, n, best): the documents that hold each pair linked, and whether no pair of its A id has more."""

    def add_up(batches):
        held: list[np.ndarray] = []
        known, count, waiting = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        for b in batches:
            for blob in b.column(0):
                held.append(np.frombuffer(blob.as_buffer(), "<u4"))
                waiting += len(held[-1])
                if waiting > HELD:
                    known, count = _added(known, count, held)
                    held, waiting = [], 0
                    if len(known) > HELD:
                        yield pa.record_batch({"pair": known, "n": count})
                        known, count = known[:0], count[:0]
        known, count = _added(known, count, held)
        yield pa.record_batch({"pair": known, "n": count})

    rows = aligned.select("pairs").mapInArrow(add_up, "pair long, n long").withColumn("salt", F.spark_partition_id() % SALTS)
    counts = rows.groupBy("pair", "salt").agg(F.sum("n").alias("n")).groupBy("pair").agg(F.sum("n").alias("n"))
    counts = materialize(counts, "align-counts")
    a = F.expr(f"pair div {n_b}").alias("a")
    top = counts.groupBy(a).agg(F.max("n").alias("most"))  # at most one row an id of A
    judged = counts.withColumn("a", a).join(F.broadcast(top), "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    judged = materialize(judged, "align-judged")
    drop_table(counts)
    return judged


def _added(known: np.ndarray, count: np.ndarray, held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not held:
        return known, count
    new, n = np.unique(np.concatenate(held), return_counts=True)
    both, back = np.unique(np.concatenate((known, new.astype(np.int64))), return_inverse=True)
    return both, np.bincount(back, weights=np.concatenate((count, n)), minlength=len(both)).astype(np.int64)


def hot_pairs(judged: DataFrame, most: int = HOT_PAIRS) -> tuple[DataFrame, int]:
    """The most frequent pairs, not more than most, and the least count that all of them have."""
    level = F.floor(F.log2("n") * 4).cast("int")
    sizes = sorted(((r["level"], r["k"]) for r in judged.groupBy(level.alias("level")).agg(F.count("*").alias("k")).collect()), reverse=True)  # at most 256 rows
    total, least = 0, None
    for k, n in sizes:
        total += n
        if total > most:
            break
        least = k
    return judged.where(level >= least if least is not None else F.lit(False)), total


def judge(aligned: DataFrame, judged: DataFrame, most: int = HOT_PAIRS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    hot = hot_pairs(judged, most)[0].toArrow().sort_by("pair")  # at most HOT_PAIRS rows
    pair, count, best = (hot[c].to_numpy() for c in ("pair", "n", "best"))
    best = best.astype(bool)

    def parts(b: pa.RecordBatch):
        n = np.array([len(x) // 4 for x in b.column(1).to_pylist()], np.int64)
        own, times = (np.frombuffer(b"".join(b.column(k).to_pylist()), "<u4").astype(np.int64) for k in (1, 2))
        at = np.minimum(np.searchsorted(pair, own), max(0, len(pair) - 1))
        known = pair[at] == own if len(pair) else np.zeros(len(own), bool)
        return np.repeat(np.arange(len(n)), n), own, times, at, known

    def add_up(batches):
        for b in _small(batches):
            row, _, times, at, known = parts(b)
            row, times, at = row[known], times[known], at[known]
            sums = [np.zeros(b.num_rows, np.int64) for _ in range(2)]
            np.add.at(sums[0], row, times * best[at] if len(pair) else times)
            np.add.at(sums[1], row, times * count[at] if len(pair) else times)
            yield pa.record_batch({"r": b.column(0), "best_hot": sums[0], "sum_hot": sums[1]})

    def others(batches):
        for b in _small(batches):
            row, own, times, _, known = parts(b)
            yield pa.record_batch({"r": b.column(0).take(pa.array(row[~known])), "pair": own[~known], "times": times[~known]})

    slim = aligned.select("r", "pairs", "times")
    cold = slim.mapInArrow(others, "r long, pair long, times long").join(judged, "pair")
    cold = cold.groupBy("r").agg(F.sum(F.col("times") * F.col("best").cast("long")).alias("best_cold"), F.sum(F.col("times") * F.col("n")).alias("sum_cold"))
    sums = slim.mapInArrow(add_up, "r long, best_hot long, sum_hot long").join(cold, "r", "left")
    sums = sums.select("r", (F.col("best_hot") + F.coalesce("best_cold", F.lit(0))).alias("n_best"), (F.col("sum_hot") + F.coalesce("sum_cold", F.lit(0))).alias("count_sum"))
    return aligned.drop("pairs", "times").join(sums, "r").select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def _small(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def cross_alignment(docs: DataFrame, a_path: str, b_path: str, most: int = HOT_PAIRS) -> tuple[DataFrame, DataFrame]:
    """The documents' numbers (judge), and (a, b, n, best) of all pairs of ids that are linked anywhere."""
    import sentencepiece

    n_b = sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
    aligned = materialize(align_documents(docs, a_path, b_path), "align-documents")
    judged = pair_counts(aligned, n_b)
    return judge(aligned, judged, most), judged.select(F.expr(f"CAST(pair div {n_b} AS INT)").alias("a"), F.expr(f"CAST(pair % {n_b} AS INT)").alias("b"), "n", "best")


def op13_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_alignment(read_table(spark, sf_dir, "documents"), vocabulary_path(), vocabulary_path("piece_bpe_32k.model"))[0]
