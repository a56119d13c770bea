"""MinHash near-dedup (operator 3).

Texts are lower-cased (A-Z) and cut into words; a document's set holds its distinct word shingles (with
fewer words than a shingle, the whole sequence as one; without words, nothing). Documents whose sets
have a Jaccard similarity of at least THRESHOLD percent are linked; components of links are returned.

  1. scan: set size, an order-free key of the set (128 bits), and N_HASH universal-hash minima of every
     whole text; equal sets share their key and are one node from here on, whatever their number;
  2. banding: BANDS bands of ROWS minima; a bucket holds the nodes that agree in a band. A pair at the
     threshold misses all bands with a chance of (1 - 0.8**5)**32 = 3e-6;
  3. every bucket pairs its members with one pivot only, its least node, so that alike nodes have few. Pairs are
     verified on their signatures (a pair at the threshold fails with a chance below 1e-6); of the pivots that
     a node passes with, the most alike one is verified on the full sets of both whole texts;
  4. links become components by alternating large-star and small-star; a node's least neighbour is written
     before it is joined back, so that Spark can split the edges of a hub;
  5. buckets that still hold several components are compared block against block: the members outside
     the bucket's largest component with all members of other components, where their set sizes can reach
     the threshold (blocks hold one class of sizes and meet their own and the next class). A task tests a
     pair of blocks on signatures and then on the full sets, each pair in the first bucket it shares only
     (told by the bucket keys themselves), and puts out the links; those are verified on the full texts like
     the others. Of two components one link in a task is enough. No link is lost to the pivots,
     no list of all pairs leaves a task, and blocks of about BLOCK members and BLOCK_BYTES bound every task: of a set
     of more than SET_LIMIT shingles only those of the least hashes are in its block, at most SET_LIMIT in the mean.
     Such a pair is looked at further if the shares agree within MARGIN deviations of the threshold (one at the
     threshold fails with a chance of 1e-9), and spares others only if it is as far above it.

Defined results: null or empty text has an empty set, is its own component and linked with nothing; a
null doc_id never names a component (component_id is null if all ids of it are); rows with one doc_id
are separate rows of the result; an empty table gives no rows; other columns are ignored. A very long
text is hashed in pieces that end behind a space.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import U64, Chunk, chunks_of, drop_table, lower_ascii, materialize, mix, read_table, window_hash, window_hashes, word_hashes
from .phrases import holders, identified, keyed_rows

SHINGLE = 5
THRESHOLD = 80
BANDS = 32
ROWS = 5
N_HASH = BANDS * ROWS
#: Least number of equal minima of a pair that is looked at further: the mean at the threshold less 5.5 deviations.
LEAST_EQUAL = 100
BLOCK = 128
BLOCK_BYTES = 8 << 20
#: Shingles of a set that a block holds, and how many deviations apart an estimate from fewer than all may be.
SET_LIMIT = 1 << 16
MARGIN = 6.0
CHUNK = 500_000

_rng = np.random.Generator(np.random.PCG64(77001))
MULTIPLIER = _rng.integers(1, 2**63, N_HASH, dtype=U64) * U64(2) + U64(1)
ADDEND = _rng.integers(1, 2**64, N_HASH, dtype=U64)


def shingle_sets(c: Chunk, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of the documents of a chunk, and the document of each, in order."""
    words, doc = word_hashes(lower_ascii(c.buf), c.off)
    n = np.bincount(doc, minlength=c.n)
    shingle = window_hashes(words, width)
    if c.n == 1 and n[0] >= width:  # one text, which may be long: no index arrays
        h = np.unique(shingle)
        return h, np.zeros(len(h), np.int32)
    own = np.flatnonzero(doc[width - 1 :] == doc[: len(shingle)])
    h, d = shingle[own], doc[own]
    short = np.flatnonzero((n > 0) & (n < width))
    if len(short):
        first = np.cumsum(n) - n
        extra = np.array([window_hash(words[first[k] : first[k] + n[k]], int(n[k]))[0] for k in short], U64)
        h, d = np.concatenate((h, extra)), np.concatenate((d, short))
    order = np.lexsort((h, d))
    h, d = h[order], d[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    return h[new], d[new]


def signatures(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(documents, N_HASH) minima of (a * h + b) >> 32; first: where each document's hashes begin."""
    out = np.empty((len(first), N_HASH), np.uint32)
    value = np.empty_like(h)
    for j in range(N_HASH):
        np.multiply(h, MULTIPLIER[j], out=value)
        value += ADDEND[j]
        out[:, j] = np.minimum.reduceat(value, first) >> U64(32)
    return out


def scan_sets(rows: DataFrame, width: int) -> DataFrame:
    """doc_id, did, th, n (set size), key (of the set, null if empty) and sig of every text."""

    def run(batches):
        for b in batches:
            for c in chunks_of(b.column(3), CHUNK):
                h, d = shingle_sets(c, width)
                n = np.bincount(d, minlength=c.n)
                full = np.flatnonzero(n)
                key, sig = [None] * c.n, [None] * c.n
                if len(full):
                    first = np.searchsorted(d, full)
                    sums = np.stack([np.add.reduceat(mix(h ^ U64(salt)), first) for salt in (0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)], axis=1)
                    for k, x, s in zip(full.tolist(), sums, signatures(h, first), strict=True):
                        key[k], sig[k] = x.tobytes(), s.tobytes()
                a = int(c.rows[0])
                yield pa.RecordBatch.from_arrays([*(b.column(k).slice(a, c.n) for k in range(3)), pa.array(n, pa.int64()), pa.array(key, pa.binary()), pa.array(sig, pa.binary())], ["doc_id", "did", "th", "n", "key", "sig"])

    return rows.select("doc_id", "did", "th", "text").mapInArrow(run, "doc_id long, did long, th binary, n long, key binary, sig binary")


def band_keys(sig: np.ndarray) -> np.ndarray:
    """(documents, BANDS) bucket keys of full signatures."""
    rows = sig.astype(U64).reshape(-1, BANDS, ROWS)
    key = np.broadcast_to(np.arange(BANDS, dtype=U64) * U64(0x9E3779B97F4A7C15), rows.shape[:2])
    for k in range(ROWS):
        key = mix(key ^ rows[:, :, k])
    return key


def band_rows(nodes: DataFrame) -> DataFrame:
    """(bucket, band, node): one row a band."""

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            key = band_keys(_signature_rows(b.column(1)))
            band = np.tile(np.arange(BANDS, dtype=np.int32), b.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array(key.ravel().view(np.int64)), pa.array(band), b.column(0).take(pa.array(np.repeat(np.arange(b.num_rows), BANDS)))], ["bucket", "band", "node"])

    return nodes.select("node", "sig").mapInArrow(run, "bucket long, band int, node long")


def _signature_rows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, N_HASH)


def signature_pairs(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(a, b, equal): the pairs whose signatures agree in at least LEAST_EQUAL minima."""

    def run(batches):
        for b in batches:
            if b.num_rows:
                equal = (_signature_rows(b.column(2)) == _signature_rows(b.column(3))).sum(axis=1)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(equal, pa.int32())], ["a", "b", "equal"]).filter(pa.array(equal >= LEAST_EQUAL))

    own = nodes.select("node", "sig")
    joined = pairs.join(own.toDF("b", "sig_b"), "b").join(own.toDF("a", "sig_a"), "a")
    return joined.select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long, equal int")


def linked_pairs(pairs: DataFrame, texts: DataFrame, width: int, threshold: int) -> DataFrame:
    """The pairs whose full sets reach the threshold: 100 * common >= threshold * union."""

    def run(batches):
        for b in batches:
            at = 0
            size = np.array([len(x) for x in b.column(2).to_pylist()], np.int64) + np.array([len(x) for x in b.column(3).to_pylist()], np.int64)
            part = (np.cumsum(size) - 1) // 2_000_000
            for stop in [*(np.flatnonzero(np.diff(part)) + 1).tolist(), b.num_rows]:
                n = stop - at
                if n <= 0:
                    continue
                (ha, da), (hb, db) = (_all_sets(b.column(k).slice(at, n), width) for k in (2, 3))
                na, nb = np.bincount(da, minlength=n), np.bincount(db, minlength=n)
                h, d = np.concatenate((ha, hb)), np.concatenate((da, db))
                order = np.lexsort((h, d))
                h, d = h[order], d[order]
                common = np.bincount(d[1:][(h[1:] == h[:-1]) & (d[1:] == d[:-1])], minlength=n)
                ok = (common > 0) & (100 * common >= threshold * (na + nb - common))
                yield b.slice(at, n).filter(pa.array(ok)).select([0, 1])
                at = stop

    joined = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b").join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    return joined.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def _all_sets(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    parts = [(h, c.rows[d]) for c in chunks_of(column, CHUNK) for h, d in [shingle_sets(c, width)]]
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


# ---------------------------------------------------------------- components


def large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u")).toDF("u", "v")
    least = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "star-least")
    out = materialize(both.where("v > u").join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")), "star")
    drop_table(least)
    return out


def small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    least = materialize(down.groupBy("u").agg(F.min("v").alias("m")), "star-least")
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    out = materialize(moved.union(least.select("u", F.col("m").alias("v"))).distinct(), "star")
    drop_table(least)
    return out


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): the least node of the component of every node that has an edge, comp itself left out.

    edges: u, v. Alternates large-star and small-star until the edges no longer change.
    """
    before, known = None, materialize(edges.where("u <> v").distinct(), "star")
    while True:
        state = known.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before or not state[0]:
            return known.select(F.col("u").alias("node"), F.col("v").alias("comp"))
        before, large = state, large_star(known)
        drop_table(known)
        known = small_star(large)
        drop_table(large)


def with_component(members: DataFrame, labels: DataFrame) -> DataFrame:
    return members.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))


def merge_links(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The components of labels joined by new links (a, b)."""
    a = links.join(labels.toDF("a", "ca"), "a", "left").select("b", F.coalesce("ca", "a").alias("u"))
    edges = a.join(labels.toDF("b", "cb"), "b", "left").select("u", F.coalesce("cb", "b").alias("v"))
    return components(edges.union(labels.toDF("u", "v")))


def halvings(n: np.ndarray) -> np.ndarray:
    """How many times a set of n shingles is halved until at most SET_LIMIT are left."""
    return np.ceil(np.log2(np.maximum(n, SET_LIMIT) / SET_LIMIT)).astype(np.int64)


def least_hashes(ordered: np.ndarray, times: int) -> np.ndarray:
    """The hashes of a set, in order, that lie in the first 2**-times of all values."""
    return ordered[: np.searchsorted(ordered, U64(1 << (64 - times)))] if times else ordered


def compact_sets(texts: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """(node, n, sig8, keys, set64): set size, low bytes of the minima, bucket keys, and sorted shingle hashes (of long sets the least ones)."""

    def run(batches):
        for b in batches:
            for c in chunks_of(b.column(1), CHUNK):
                h, d = shingle_sets(c, width)
                n = np.bincount(d, minlength=c.n)
                ends = np.cumsum(n).tolist()
                sets = [least_hashes(h[e - k : e], s).tobytes() for e, k, s in zip(ends, n.tolist(), halvings(n).tolist(), strict=True)]
                a = int(c.rows[0])
                full = _signature_rows(b.column(2).slice(a, c.n))
                sig, keys = (full & 0xFF).astype(np.uint8), band_keys(full)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(a, c.n), pa.array(n, pa.int64()), pa.array([x.tobytes() for x in sig], pa.binary()), pa.array([x.tobytes() for x in keys], pa.binary()), pa.array(sets, pa.binary())], ["node", "n", "sig8", "keys", "set64"])

    return texts.join(nodes.select("node", "sig"), "node").select("node", "text", "sig").mapInArrow(run, "node long, n long, sig8 binary, keys binary, set64 binary")


def block_links(opened: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """(a, b): likely links between different components of a bucket.

    opened: bucket, band, node, n, comp, main (the bucket's largest component). Sizes of two sets that reach the
    threshold lie in one class or in two that follow each other.
    """
    rows = opened.withColumn("res", F.col("comp") != F.col("main"))
    rows = rows.withColumn("size", F.floor(F.log("n") / F.lit(math.log(100 / threshold))).cast("int"))
    counts = rows.groupBy("bucket", "res", "size").agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.sum(F.least("n", F.lit(SET_LIMIT))) * 8 / BLOCK_BYTES)).cast("int").alias("blocks"))
    counts = materialize(counts, "minhash-counts")
    rows = rows.join(counts, ["bucket", "res", "size"]).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.join(sets.drop("n"), "node")  # sets last: they are shuffled to their blocks only
    blocks = rows.groupBy("bucket", "band", "res", "size", "block").agg(F.collect_list(F.struct("node", "comp", "n", "sig8", "keys", "set64")).alias("own"))
    blocks = materialize(blocks, "minhash-blocks")
    left = counts.where("res").select("bucket", "size", "blocks", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    left = left.withColumn("size_b", F.explode(F.array(F.col("size") - 1, F.col("size"), F.col("size") + 1)))
    other = counts.select("bucket", F.col("res").alias("res_b"), F.col("size").alias("size_b"), F.col("blocks").alias("blocks_b"))
    pairs = left.join(other, ["bucket", "size_b"]).withColumn("block_b", F.explode(F.sequence(F.lit(0), F.col("blocks_b") - 1)))
    pairs = pairs.where("NOT res_b OR size < size_b OR size = size_b AND block <= block_b").select("bucket", "size", "block", "res_b", "size_b", "block_b")
    pairs = pairs.join(blocks.where("res").drop("res"), ["bucket", "size", "block"])
    other = blocks.select("bucket", F.col("res").alias("res_b"), F.col("size").alias("size_b"), F.col("block").alias("block_b"), F.col("own").alias("own_b"))
    pairs = pairs.join(other, ["bucket", "res_b", "size_b", "block_b"])

    def run(batches):
        for b in batches:
            for r in range(b.num_rows):
                a, o = _pair_blocks(b.column(2)[r].values, b.column(3)[r].values, b.column(0)[r].as_py(), b.column(1)[r].as_py(), threshold)
                if len(a):
                    yield pa.record_batch({"a": pa.array(np.minimum(a, o)), "b": pa.array(np.maximum(a, o))})

    links = pairs.select("band", (F.col("res_b") & (F.col("size") == F.col("size_b")) & (F.col("block") == F.col("block_b"))).alias("same"), "own", "own_b").mapInArrow(run, "a long, b long").distinct()
    links = materialize(links, "minhash-pairs")
    drop_table(blocks)
    drop_table(counts)
    return links


def _pair_blocks(own: pa.StructArray, other: pa.StructArray, band: int, same_block: bool, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between two blocks of a bucket; of several between two components, one is enough."""
    node, comp, n = (own.field(k).to_numpy() for k in range(3))
    node_o, comp_o, n_o = (other.field(k).to_numpy() for k in range(3))
    sig, sig_o = (np.frombuffer(b"".join(x.field(3).to_pylist()), np.uint8).reshape(-1, N_HASH) for x in (own, other))
    keys, keys_o = (np.frombuffer(b"".join(x.field(4).to_pylist()), U64).reshape(-1, BANDS) for x in (own, other))
    sets = [np.frombuffer(x, U64) for x in own.field(5).to_pylist()]
    sets_o = [np.frombuffer(x, U64) for x in other.field(5).to_pylist()]
    half, half_o = halvings(n), halvings(n_o)
    linked: set[tuple[int, int]] = set()
    out_a, out_b = [], []
    for k in range(len(node)):
        go = (comp_o != comp[k]) & (100 * np.minimum(n_o, n[k]) >= threshold * np.maximum(n_o, n[k]))
        if same_block:
            go &= node_o > node[k]
        go = np.flatnonzero(go)
        if not len(go):
            continue
        go = go[(sig_o[go] == sig[k]).sum(axis=1) >= LEAST_EQUAL]
        if len(go):
            go = go[(keys_o[go] == keys[k]).argmax(axis=1) == band]
        go = np.array([g for g in go.tolist() if (int(comp[k]), int(comp_o[g])) not in linked], np.int64)
        times = np.maximum(half[k], half_o[go])
        for t in np.unique(times).tolist():
            mine, some = least_hashes(sets[k], t), go[times == t].tolist()
            theirs = [least_hashes(sets_o[g], t) for g in some]
            ends = np.cumsum([len(x) for x in theirs])
            every = np.concatenate(theirs)
            found = np.concatenate(([0], np.cumsum(mine[np.minimum(np.searchsorted(mine, every), len(mine) - 1)] == every)))
            common = found[ends] - found[np.concatenate(([0], ends[:-1]))]
            union = len(mine) + np.diff(ends, prepend=0) - common
            margin = MARGIN * np.sqrt(threshold * (100 - threshold) * union) if t else 0
            hit, sure = (100 * common >= threshold * union + m for m in (-margin, margin))
            for g, h, sure_h in zip(some, hit.tolist(), sure.tolist(), strict=True):
                key = (int(comp[k]), int(comp_o[g]))
                if h and key not in linked:
                    out_a.append(node[k])
                    out_b.append(node_o[g])
                    if sure_h:
                        linked.add(key)
    return np.array(out_a, np.int64), np.array(out_b, np.int64)


def near_duplicates(docs: DataFrame, width: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, did, th, n, comp_did, comp_th: the first (did, th) of each row's component."""
    rows = identified(docs)
    scanned = materialize(scan_sets(rows, width), "minhash-scan")
    nodes = scanned.where("key is not null").groupBy("key").agg(F.min(F.struct("did", "th")).alias("rep"), F.first("n").alias("n"), F.first("sig").alias("sig")).select(F.monotonically_increasing_id().alias("node"), "key", "rep.did", "rep.th", "n", "sig")
    nodes = materialize(nodes, "minhash-nodes")
    slim = materialize(scanned.drop("sig").join(nodes.select("key", "node"), "key", "left").drop("key"), "minhash-slim")
    drop_table(scanned)
    bands = band_rows(nodes)
    buckets = bands.groupBy("bucket").agg(F.min("node").alias("pivot"), F.max("node").alias("_last")).where("pivot < _last").drop("_last")
    members = materialize(bands.join(buckets, "bucket"), "minhash-members")
    met = materialize(members.select("node").distinct().join(nodes.drop("key"), "node"), "minhash-met")
    drop_table(nodes)
    texts = materialize(holders(rows, met.select("did", "th", "node"), met.count()).select("node", "text"), "minhash-texts")

    first = members.where("node <> pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct()
    alike = materialize(signature_pairs(first, met).groupBy("a").agg(F.max_by("b", "equal").alias("b")), "minhash-alike")
    links = materialize(linked_pairs(alike, texts, width, threshold), "minhash-links")
    labels = components(links.toDF("u", "v"))
    drop_table(links)
    placed = with_component(members.drop("pivot"), labels)
    sizes = placed.groupBy("bucket", "comp").agg(F.count("*").alias("k"))
    main = sizes.groupBy("bucket").agg(F.max_by("comp", F.struct("k", "comp")).alias("main"), F.sum("k").alias("m"), F.max("k").alias("most")).where("m > most").select("bucket", "main")
    opened = materialize(placed.join(main, "bucket").join(met.select("node", "n"), "node"), "minhash-open")
    drop_table(members)
    drop_table(alike)
    sets = compact_sets(texts.join(opened.select("node").distinct(), "node", "left_semi"), met, width)
    pairs = block_links(opened, sets, threshold)
    drop_table(opened)
    links = materialize(linked_pairs(pairs, texts, width, threshold), "minhash-links")
    labels = merge_links(labels, links)
    for table in (links, pairs, texts, met):
        drop_table(table)
    placed = slim.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    firsts = placed.where("comp is not null").groupBy("comp").agg(F.min(F.struct("did", "th")).alias("first"), F.min("doc_id").alias("least"))
    firsts = materialize(firsts, "minhash-firsts")  # a plain table, so that Spark can split a hot component in the join
    return placed.join(firsts, "comp", "left").select("doc_id", "did", "th", "n", F.coalesce("first.did", "did").alias("comp_did"), F.coalesce("first.th", "th").alias("comp_th"), F.when(F.col("comp").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))


def keep_one(docs: DataFrame, width: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """docs without all but one document of each component (the one of the least doc_id), once each."""
    first = near_duplicates(docs, width, threshold).where("did = comp_did and th = comp_th").select("did", "th").distinct()
    return keyed_rows(docs).join(first, ["did", "th"], "left_semi").dropDuplicates(["did", "th"]).select("row.*")


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = near_duplicates(read_table(spark, sf_dir, "documents"), 4)
    return rows.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
