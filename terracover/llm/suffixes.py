"""Suffix-array dedup with sampled splitters (operator 9).

Removes every byte under a WINDOW-byte string that also starts in a document of a smaller doc_id.

Only suffixes that can be shared are sorted. Every window has one anchor, the GRAM-byte string in it of
the least hash (winnowing); equal windows have equal anchors at the same place.
  1. scan: size, digest and winnowed anchors of each whole text; equal texts are settled by the digest;
  2. anchors meet by hash range, packed as arrays; those of two or more different texts recur. An anchor
     that two texts of a chunk share is known to recur there and travels once for the chunk, so a hot
     anchor is aggregated before the shuffle;
  3. the suffixes at recurring anchors (with the bytes before them that their windows reach) are
     range-partitioned at sampled splitters, by the bytes from the anchor on, then by those before it,
     then by a key of the document, so that any number of alike suffixes can be divided;
  4. each bucket sorts its suffixes by multikey quicksort, rightwards and leftwards from the anchor;
     common-prefix lengths of neighbours in the two orders tell which windows are equal, and the least
     doc_id of each set of equal windows marks the others;
  5. across boundaries: a set of equal windows whose bytes from the anchor on are a prefix of a splitter
     beside its bucket may go on in other buckets. Of each such set the records of its least doc_id (the
     others are marked already) are compared by the bytes of the window with those of all buckets.
Bytes decide which windows are equal; hashes (64 bits for anchors, 128 for whole texts) find what to sort.
Nothing is capped, and no size changes the way a suffix goes.

Defined results: null or empty text has no bytes; a null doc_id counts as the smallest; rows with one
doc_id never remove each other's bytes, and repeated rows are returned each; texts under WINDOW bytes
stay whole; an empty table gives no rows; other columns are ignored. Very long texts are taken in
pieces of CHUNK bytes that overlap by a window, in every step the same; a worker holds the text and
one flag a byte besides.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BASE_INV, U64, Chunk, chunks_of, doc_of, drop_table, materialize, mix, powers, prefix_hash, ragged, read_table, shuffle_partitions, stretch_hash
from .phrases import LEAST_ID, NOTHING, copies_of, holders, identified, in_doc, winnow

WINDOW = 50
GRAM = 20
REACH = WINDOW - GRAM  # how far a window may start before its anchor
SPAN = REACH + WINDOW
CHUNK = 400_000
#: Bytes of text behind one hash range of anchors, and suffix records behind one sorted bucket.
RANGE_BYTES = 64 << 20
BUCKET_RECORDS = 200_000
#: Documents and suffixes that splitters are drawn from, at least, and suffixes a bucket.
SAMPLE_DOCS, SAMPLE_SUFFIXES, SAMPLE_EACH = 4_000, 100_000, 16
#: Records whose bytes are gathered at once.
RECORDS_AT_ONCE = 50_000
KEY = f"S{SPAN + 8}"


def pieces_of(column: pa.Array, chunk: int):
    """Chunks of texts and pieces of long texts; every window lies in one of them whole, by its start."""
    return chunks_of(column, chunk, WINDOW - 1)


def gram_hash(buf: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the width bytes at every position of buf."""
    n = len(buf) - width + 1
    if n <= 0:
        return np.zeros(0, U64)
    prefix = prefix_hash(buf)
    return mix((prefix[width:] - prefix[:-width]) * powers(BASE_INV, n))


def anchored(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The starts of all windows of a chunk, the anchor of each, and the hash of the string at every position."""
    grams = gram_hash(chunk.buf, GRAM)
    anchor = winnow(grams, REACH + 1)
    lens = np.maximum(np.diff(chunk.off) - 1 - (WINDOW - 1), 0)
    starts = np.repeat(chunk.off[:-1] - (np.cumsum(lens) - lens), lens) + np.arange(int(lens.sum()))
    return starts, anchor[starts] if len(starts) else starts, grams


def scan_bytes(rows: DataFrame) -> DataFrame:
    """doc_id, did, th, n (bytes) and sha of every text."""
    own = F.col("text").cast("binary")
    return rows.select("doc_id", "did", "th", F.length(own).cast("long").alias("n"), F.sha2(own, 256).alias("sha"))


def recurring_anchors(rows: DataFrame, n_ranges: int, chunk: int = CHUNK) -> DataFrame:
    """(th, grams): the recurring anchors of a text (in parts)."""
    shift = U64(64 - 20)
    bound = (np.arange(1, n_ranges, dtype=U64) * U64(1 << 20)) // U64(n_ranges)

    def emit(batches):
        for b in batches:
            ths = np.frombuffer(b"".join(b.column(0).to_pylist()), "<u8").reshape(-1, 2)
            for c in pieces_of(b.column(1), chunk):
                starts, anchor, grams = anchored(c)
                at = np.unique(anchor)
                if not len(at):
                    continue
                texts, text_of = np.unique(ths[c.rows], axis=0, return_inverse=True)
                # least hashes crowd near zero: scrambled again, they fill the ranges evenly
                g, t = mix(grams[at]), text_of.ravel()[doc_of(at, c.off)]
                order = np.lexsort((t, g))
                g, t = g[order], t[order]
                new = np.concatenate(([True], (g[1:] != g[:-1]) | (t[1:] != t[:-1])))
                g, t = g[new], t[new]
                first = np.concatenate(([True], g[1:] != g[:-1]))
                many = np.diff(np.append(np.flatnonzero(first), len(g)))
                known = np.repeat(many > 1, many)
                parts, kinds, gs, rest, ns = [], [], [], [], []
                if known.any():
                    k_t, k_g = t[known], g[known]
                    order = np.argsort(k_t, kind="stable")
                    k_t, k_g = k_t[order], k_g[order]
                    cut = np.concatenate(([0], np.flatnonzero(k_t[1:] != k_t[:-1]) + 1, [len(k_t)]))
                    for a, e in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                        parts.append(int(texts[k_t[a], 0] % U64(n_ranges)))
                        kinds.append(1)
                        gs.append(k_g[a:e].tobytes())
                        rest.append(texts[k_t[a]].tobytes())
                        ns.append(b"")
                g, t, many = g[first], t[first], (many > 1).astype(np.uint8)
                part = np.searchsorted(bound, g >> shift, side="right")  # g is sorted, and so is part
                cut = np.concatenate(([0], np.flatnonzero(part[1:] != part[:-1]) + 1, [len(part)]))
                for a, e in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                    own, which = np.unique(t[a:e], return_inverse=True)
                    parts.append(int(part[a]))
                    kinds.append(0)
                    gs.append(g[a:e].tobytes())
                    rest.append(texts[own].tobytes())
                    ns.append(which.astype("<u4").tobytes() + many[a:e].tobytes())
                yield pa.record_batch({"part": pa.array(parts, pa.int32()), "kind": pa.array(kinds, pa.int32()), "grams": pa.array(gs, pa.binary()), "ths": pa.array(rest, pa.binary()), "ns": pa.array(ns, pa.binary())})

    def meet(batches):
        gs, ts, ns = [], [], []
        for b in batches:
            kinds = b.column(1).to_pylist()
            passed = [k for k, x in enumerate(kinds) if x == 1]
            if passed:
                yield pa.record_batch({"th": b.column(3).take(pa.array(passed)), "grams": b.column(2).take(pa.array(passed))})
            for k, x in enumerate(kinds):
                if x == 0:
                    g, rest = np.frombuffer(b.column(2)[k].as_py(), U64), b.column(4)[k].as_py()
                    gs.append(g)
                    ts.append(np.frombuffer(b.column(3)[k].as_py(), "<u8").reshape(-1, 2)[np.frombuffer(rest, "<u4", len(g))])
                    ns.append(np.frombuffer(rest, np.uint8, len(g), 4 * len(g)))
        if not gs:
            return
        g, t, many = np.concatenate(gs), np.concatenate(ts), np.concatenate(ns)
        del gs, ts, ns
        order = np.argsort(g, kind="stable")
        g, t, many = g[order], t[order], many[order]
        first = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1])))
        size = np.diff(np.append(first, len(g)))
        again = np.maximum.reduceat(many, first) > 0
        for k in range(2):
            again |= np.minimum.reduceat(t[:, k], first) != np.maximum.reduceat(t[:, k], first)
        take = np.repeat(again, size) & (many == 0)  # those of many texts were passed on by their chunk
        g, t = g[take], t[take]
        if not len(g):
            return
        order = np.lexsort((t[:, 1], t[:, 0]))
        g, t = g[order], t[order]
        cut = np.concatenate(([0], np.flatnonzero((t[1:] != t[:-1]).any(axis=1)) + 1, [len(t)]))
        step = 4096
        for k in range(0, len(cut) - 1, step):
            c = cut[k : k + step + 1].tolist()
            yield pa.record_batch({"th": pa.array([t[a].tobytes() for a in c[:-1]], pa.binary()), "grams": pa.array([g[a:e].tobytes() for a, e in zip(c[:-1], c[1:], strict=True)], pa.binary())})

    emitted = rows.select("th", "text").mapInArrow(emit, "part int, kind int, grams binary, ths binary, ns binary")
    return emitted.repartitionById(n_ranges, F.col("part")).mapInArrow(meet, "th binary, grams binary")


def records_of(c: Chunk, wanted: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchors in wanted (scrambled hashes), with the first and last window start of each, and all hashes of the chunk."""
    starts, anchor, grams = anchored(c)
    if not len(starts):
        return starts, starts, starts, grams
    first = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
    last = np.append(first[1:], len(anchor)) - 1
    at = anchor[first]
    take = np.isin(mix(grams[at]), wanted)
    return at[take], starts[first[take]], starts[last[take]], grams


def distinct_records(c: Chunk, at: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first of the records of a document that have the same bytes and windows, and which of them each record is.

    Periodic text has one record a byte, but only as many different ones as its period is long.
    """
    key = stretch_hash(prefix_hash(c.buf), lo, hi + WINDOW) + (at - lo).astype(U64) * U64(0x9E3779B97F4A7C15)
    _, first, which = np.unique(in_doc(key, doc_of(at, c.off)), return_index=True, return_inverse=True)
    order = np.argsort(first)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return first[order], place[which]


def _wanted(lists: pa.Array, rows: np.ndarray) -> np.ndarray:
    blobs = [x for r in rows for x in lists[int(r)].as_py()]
    return np.unique(np.frombuffer(b"".join(blobs), U64))


def contexts(c: Chunk, at: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """For each record WINDOW bytes from the anchor on, then REACH bytes before it, nearest first; zero outside its windows."""
    pos = at[:, None] + np.concatenate((np.arange(WINDOW), -1 - np.arange(REACH)))
    return np.where((pos >= lo[:, None]) & (pos < hi[:, None] + WINDOW), c.buf[np.clip(pos, 0, len(c.buf) - 1)], 0).astype(np.uint8)


def split_keys(context: np.ndarray, uid: np.ndarray) -> np.ndarray:
    """What records are range-partitioned by: their context and a key of the document."""
    salt = mix(uid.astype(U64)).astype(">u8").view(np.uint8).reshape(-1, 8)
    return np.ascontiguousarray(np.concatenate((context, salt), axis=1)).view(KEY).ravel()


def record_parts(c: Chunk, wanted: np.ndarray):
    """The distinct records of a chunk, RECORDS_AT_ONCE at a time: at, lo, hi and context."""
    at, lo, hi, _ = records_of(c, wanted)
    first, _ = distinct_records(c, at, lo, hi)
    for k in range(0, len(first), RECORDS_AT_ONCE):
        own = first[k : k + RECORDS_AT_ONCE]
        yield at[own], lo[own], hi[own], contexts(c, at[own], lo[own], hi[own])


def suffix_records(held: DataFrame, splitters: np.ndarray, chunk: int = CHUNK) -> DataFrame:
    """(bucket, uid, did, at, least, most, context) at every recurring anchor.

    least and most: the distances of the window starts from the anchor.
    """

    def run(batches):
        for b in batches:
            uids = b.column(0).to_numpy()
            for c in pieces_of(b.column(2), chunk):
                for at, lo, hi, context in record_parts(c, _wanted(b.column(3), c.rows)):
                    d = doc_of(at, c.off)
                    rows = pa.array(c.rows[d])
                    bucket = np.searchsorted(splitters, split_keys(context, uids[c.rows[d]]), side="right") if len(splitters) else np.zeros(len(at), np.int64)
                    fixed = pa.Array.from_buffers(pa.binary(SPAN), len(at), [None, pa.py_buffer(context.tobytes())]).cast(pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(bucket.astype(np.int32)), b.column(0).take(rows), b.column(1).take(rows), pa.array((c.base + at - c.off[d]).astype(np.int64)), pa.array((at - hi).astype(np.int32)), pa.array((at - lo).astype(np.int32)), fixed], ["bucket", "uid", "did", "at", "least", "most", "context"])

    return held.select("uid", "did", "text", "grams").mapInArrow(run, "bucket int, uid long, did long, at long, least int, most int, context binary")


def sample_splitters(held: DataFrame, n_held: int, n_records: int, n_buckets: int, chunk: int = CHUNK) -> np.ndarray:
    """Splitters of n_buckets ranges: quantiles of the keys of sampled suffixes."""
    wanted = max(SAMPLE_SUFFIXES, SAMPLE_EACH * n_buckets)
    every = max(1, n_held // max(SAMPLE_DOCS, n_buckets))
    step = max(1, n_records // every // wanted)

    def run(batches):
        for b in batches:
            uids = b.column(0).to_numpy()
            for c in pieces_of(b.column(1), chunk):
                for at, _, _, context in record_parts(c, _wanted(b.column(2), c.rows)):
                    own = split_keys(context, uids[c.rows[doc_of(at, c.off)]])[step // 2 :: step]
                    yield pa.record_batch({"key": pa.array([x.ljust(SPAN + 8, b"\0") for x in own.tolist()], pa.binary())})

    drawn = held.where(F.pmod(F.xxhash64("uid"), F.lit(every)) == 0).select("uid", "text", "grams").mapInArrow(run, "key binary").toArrow()["key"].to_pylist()
    keys = np.sort(np.array(drawn, dtype=KEY))
    if not len(keys):
        return keys
    return np.unique(keys[np.arange(1, n_buckets) * len(keys) // n_buckets])


def multikey_quicksort(keys: np.ndarray) -> np.ndarray:
    """The order of the rows of keys (n, columns), by three-way partitions around pivots, all open segments at once.

    A segment is divided by its median of three in its own column; the middle part goes on to the next
    column, the outer parts stay in it. Equal rows keep their order.
    """
    n, columns = keys.shape
    order = np.arange(n)
    begin, size, column = np.array([0]), np.array([n]), np.array([0])
    while True:
        more = (size > 1) & (column < columns)
        begin, size, column = begin[more], size[more], column[more]
        if not len(begin):
            return order
        at = ragged(begin, size)
        seg = np.repeat(np.arange(len(size)), size)
        own = order[at]
        value = keys[own, column[seg]]
        first = np.cumsum(size) - size
        low, mid, high = value[first], value[first + size // 2], value[first + size - 1]
        pivot = np.maximum(np.minimum(low, mid), np.minimum(np.maximum(low, mid), high))[seg]
        less, same = value < pivot, value == pivot
        n_less, n_same = np.add.reduceat(less, first, dtype=np.int64), np.add.reduceat(same, first, dtype=np.int64)
        place = np.empty(len(at), np.int64)
        for flags, shift in ((less, np.zeros_like(size)), (same, n_less), (~less & ~same, n_less + n_same)):
            rank = np.cumsum(flags) - flags
            place[flags] = (rank - (rank[first] - shift - begin)[seg])[flags]
        order[place] = own
        begin = np.concatenate((begin, begin + n_less, begin + n_less + n_same))
        column = np.concatenate((column, column + 1, column))
        size = np.concatenate((n_less, n_same, size - n_less - n_same))


def prefix_classes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order of byte rows, and how many leading bytes each shares with the one before (the first: -1)."""
    m, width = data.shape
    padded = np.zeros((m, -(-width // 8) * 8), np.uint8)
    padded[:, :width] = data
    order = multikey_quicksort(padded.view(">u8").astype(U64))
    own = data[order]
    differ = own[1:] != own[:-1]
    return order, np.concatenate(([-1], np.where(differ.any(axis=1), differ.argmax(axis=1), width)))


def _shared(data: np.ndarray, splitter: bytes | None) -> np.ndarray:
    """How many bytes from the anchor on each record shares with a splitter (none: -1)."""
    if splitter is None:
        return np.full(len(data), -1)
    differ = data[:, :WINDOW] != np.frombuffer(splitter.ljust(SPAN + 8, b"\0"), np.uint8)[:WINDOW]
    return np.where(differ.any(axis=1), differ.argmax(axis=1), WINDOW)


def mark_bucket(did: np.ndarray, least: np.ndarray, most: np.ndarray, context: np.ndarray, below: bytes | None = None, above: bytes | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each record a bit mask: bit k if the window k bytes before the anchor is held by a smaller did too.

    Then the records and the k of the windows that other buckets may hold: those of the least did of their
    set, one where that is LEAST_ID. below and above are the splitters beside the bucket.
    """
    right, right_lcp = prefix_classes(context[:, :WINDOW])
    left, left_lcp = prefix_classes(context[:, WINDOW:])
    reach = np.maximum(_shared(context, below), _shared(context, above))
    marks = np.zeros(len(did), np.int64)
    r_class, l_class = np.empty(len(did), np.int64), np.empty(len(did), np.int64)
    open_at, open_k = [], []
    for k in range(REACH + 1):
        own = np.flatnonzero((least <= k) & (k <= most))
        if not len(own):
            continue
        r_class[right] = np.cumsum(right_lcp < WINDOW - k)
        l_class[left] = np.cumsum(left_lcp < k)
        key = r_class[own] * (len(did) + 1) + l_class[own]
        order = np.argsort(key, kind="stable")
        own, key = own[order], key[order]
        first = np.concatenate(([True], key[1:] != key[:-1]))
        each = np.cumsum(first) - 1
        smallest = np.minimum.reduceat(did[own], np.flatnonzero(first))[each]
        later = did[own] > smallest
        marks[own[later]] |= 1 << k
        edge = ~later & (reach[own] >= WINDOW - k)
        if edge.any():
            lone = np.zeros(len(own), bool)
            lone[np.flatnonzero(edge)[np.unique(each[edge], return_index=True)[1]]] = True
            edge &= lone | (smallest != LEAST_ID)
            open_at.append(own[edge])
            open_k.append(np.full(len(open_at[-1]), k))
    empty = np.zeros(0, np.int64)
    return marks, np.concatenate([empty, *open_at]), np.concatenate([empty, *open_k])


def sorted_marks(records: DataFrame, n_buckets: int, splitters: np.ndarray) -> DataFrame:
    """(uid, at, mask, did, window): records with windows that a smaller did of their bucket shares (window null), and
    records of the windows (mask has one bit) that are still to be compared with those of other buckets."""
    ends = [None, *(x for x in splitters.tolist()), None]

    def run(batches):
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        t = pa.Table.from_batches(parts).combine_chunks()
        del parts
        bucket, uid, did, at, least, most = (t[n].to_numpy() for n in ("bucket", "uid", "did", "at", "least", "most"))
        blob = t["context"].combine_chunks().cast(pa.large_binary())
        data = np.frombuffer(blob.buffers()[2], np.uint8)[: t.num_rows * SPAN].reshape(-1, SPAN)
        for k in np.unique(bucket).tolist():  # one, where the buckets have a task each
            own = np.flatnonzero(bucket == k)
            context = data[own]
            marks, rec, shift = mark_bucket(did[own], least[own], most[own], context, ends[k], ends[k + 1])
            hit = np.flatnonzero(marks)
            if len(hit):
                none = pa.nulls(len(hit), pa.binary())
                yield pa.record_batch({"uid": pa.array(uid[own[hit]]), "at": pa.array(at[own[hit]]), "mask": pa.array(marks[hit]), "did": pa.array(did[own[hit]]), "window": none})
            for a in range(0, len(rec), RECORDS_AT_ONCE):
                r, s = rec[a : a + RECORDS_AT_ONCE], shift[a : a + RECORDS_AT_ONCE]
                pos = np.arange(WINDOW) - s[:, None]
                window = context[r[:, None], np.where(pos >= 0, pos, WINDOW - 1 - pos)]
                fixed = pa.Array.from_buffers(pa.binary(WINDOW), len(r), [None, pa.py_buffer(np.ascontiguousarray(window).tobytes())]).cast(pa.binary())
                yield pa.record_batch({"uid": pa.array(uid[own[r]]), "at": pa.array(at[own[r]]), "mask": pa.array(np.left_shift(1, s)), "did": pa.array(did[own[r]]), "window": fixed})

    return records.repartitionById(n_buckets, F.col("bucket")).mapInArrow(run, "uid long, at long, mask long, did long, window binary")


def across_boundaries(marks: DataFrame) -> DataFrame:
    """(uid, at, mask): the open windows of sorted_marks() that a smaller did of another bucket holds."""
    windows = marks.where("window is not null")
    least = windows.groupBy("window").agg(F.min("did").alias("lo"), F.max("did").alias("hi")).where("lo < hi").select("window", "lo")
    least = materialize(least, "suffix-least")  # a plain table, so that Spark can split a hot window
    return windows.join(least, "window").where("did > lo").select("uid", "at", "mask")


def remove_bytes(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(did, th, n_removed, n_spans, kept). rows: did, th, text, grams, marks (array of struct at, mask).

    A mark stands for all records of its document (of its piece, if it is long) that are alike.
    """

    def covered(c: Chunk, at: np.ndarray, mask: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Which bytes of a chunk lie under marked windows; at: places of marks in the chunk."""
        cover = np.zeros(len(c.buf) + 1, np.int32)
        rec, lo, hi, _ = records_of(c, wanted)
        first, which = distinct_records(c, rec, lo, hi)
        masks = np.zeros(len(first), np.int64)
        np.bitwise_or.at(masks, which[np.searchsorted(rec, at)], mask)
        masks = masks[which]
        for bit in range(REACH + 1):
            s = rec[(masks >> bit) & 1 == 1] - bit
            np.add.at(cover, s, 1)
            np.add.at(cover, s + WINDOW, -1)
        return np.cumsum(cover[:-1]) > 0

    def finished(buf: np.ndarray, off: np.ndarray, gone: np.ndarray) -> tuple[list, list, list]:
        edge = gone.copy()
        edge[1:] &= ~gone[:-1]
        total, spans, kept = [], [], []
        for a, e in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
            own = gone[a : e - 1]
            total.append(int(own.sum()))
            spans.append(int(edge[a : e - 1].sum()))
            kept.append(buf[a : e - 1][~own].tobytes())
        return total, spans, kept

    def run(batches):
        for b in batches:
            gone, text = [], []
            for c in pieces_of(b.column(2), chunk):
                wanted = _wanted(b.column(3), c.rows)
                own = [b.column(4)[int(r)].values for r in c.rows]
                at = np.concatenate([np.asarray(x.field(0), np.int64) + c.off[k] for k, x in enumerate(own)]) - c.base
                mask = np.concatenate([np.asarray(x.field(1), np.int64) for x in own])
                if c.base or not c.last:  # marks of this piece: those whose record is in it
                    rec = records_of(c, wanted)
                    near = np.flatnonzero((at >= 0) & (at < len(c.buf)))
                    near = near[np.isin(at[near], rec[0])]
                    part = covered(c, at[near], mask[near], wanted)
                    have = WINDOW - 1 if c.base else 0
                    if have:
                        gone[-1][-have:] |= part[:have]
                    gone.append(part[have:-1])
                    text.append(c.buf[have:-1])
                    if not c.last:
                        continue
                    buf, flags, off = np.concatenate((*text, [np.uint8(10)])), np.concatenate((*gone, [False])), np.array([0, sum(map(len, text)) + 1])
                    gone, text = [], []
                else:
                    buf, flags, off = c.buf, covered(c, at, mask, wanted), c.off
                total, spans, kept = finished(buf, off, flags)
                a = int(c.rows[0])
                yield pa.RecordBatch.from_arrays([b.column(0).slice(a, c.n), b.column(1).slice(a, c.n), pa.array(total, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())], ["did", "th", "n_removed", "n_spans", "kept"])

    return rows.select("did", "th", "text", "grams", "marks").mapInArrow(run, "did long, th binary, n_removed long, n_spans long, kept binary")


def dedup_suffixes(docs: DataFrame, bucket_records: int = BUCKET_RECORDS, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """(verdicts, changed): doc_id, did, th, n, sha, copy for every row; and did, th, n_removed, n_spans,
    kept for the distinct rows, other than whole copies, of which bytes were removed."""
    spark = docs.sparkSession
    rows = identified(docs)
    scanned = materialize(scan_bytes(rows), "suffix-scan")
    copies = materialize(copies_of(scanned), "suffix-copies")
    verdicts = scanned.join(copies, "sha", "left").withColumn("copy", F.coalesce(F.col("did") > F.col("rep"), F.lit(False)) & (F.col("n") >= WINDOW)).drop("rep")
    size = scanned.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    n_ranges = int(max(shuffle_partitions(spark), size // RANGE_BYTES))
    found = materialize(recurring_anchors(rows, n_ranges, chunk), "suffix-anchors")
    reps = scanned.groupBy("th").agg(F.min("did").alias("did"))
    n_grams = F.sum(F.octet_length("grams") / 8).cast("long").alias("n_grams")
    keys = found.groupBy("th").agg(F.collect_list("grams").alias("grams"), n_grams).join(reps, "th")
    keys = materialize(keys.withColumn("uid", F.monotonically_increasing_id()), "suffix-holders")
    drop_table(found)
    n_held, n_records = keys.agg(F.count("*"), F.coalesce(F.sum("n_grams"), F.lit(0))).first()
    held = materialize(holders(rows, keys.drop("n_grams"), n_held), "suffix-texts")
    drop_table(keys)
    n_buckets = int(max(shuffle_partitions(spark), n_records // bucket_records))
    splitters = sample_splitters(held, n_held, n_records, n_buckets, chunk)
    marks = materialize(sorted_marks(suffix_records(held, splitters, chunk), n_buckets, splitters), "suffix-marks")
    marks = marks.where("window is null").select("uid", "at", "mask").union(across_boundaries(marks))
    marked = marks.groupBy("uid").agg(F.collect_list(F.struct("at", "mask")).alias("marks"))
    return verdicts, remove_bytes(held.join(marked, "uid"), chunk)


def op9_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts, changed = dedup_suffixes(read_table(spark, sf_dir, "documents"))
    changed = changed.select("did", "th", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
    rows = verdicts.join(changed, ["did", "th"], "left")
    copy = F.col("copy")

    def value(whole, name):
        return F.when(copy, whole).otherwise(F.coalesce(name, F.lit(0))).cast("long").alias(name)

    return rows.select("doc_id", F.col("n").alias("n_bytes"), value(F.col("n"), "n_removed"), value(F.lit(1), "n_spans"), F.when(copy, F.lit(NOTHING)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"))
