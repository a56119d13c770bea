"""N-gram Jaccard join by T-occurrence search (operator 12).

Texts are lower-cased (A-Z) and cut into words; a document's set holds its distinct word shingles (with fewer words
than a shingle, the whole sequence as one; without words, nothing). Documents whose sets have a Jaccard similarity of
at least THRESHOLD percent are linked; the components of links are returned. The search is exact.

A set of n shingles shares at least T = ceil(n * THRESHOLD / 100) with any set it is linked with. In one order of all
shingles, rare ones first, two linked sets therefore share c of their first n - T + c shingles, their heads, where c is
SHARED percent of the smaller one. A passage that two texts have in common gives them too few common heads.

  1. order: shingles that occur at least LEAST times among WINDOW shingles of a task are counted, and of these the
     HOT_SHINGLES most counted (a table of bounded size) come last, by the logarithm of their count; all others come
     first, by hash. Any order gives the same result;
  2. scan: set size, an order-free key of the set (128 bits) and the head of every whole text. Equal sets are one node;
  3. lists: the nodes of every shingle that is in two heads. The least node of a list leads it, and every node asks for
     the leader of most of its lists, if these are half of c;
  4. search: the sets asked for are dealt to blocks of about BLOCK shingles, each an inverted index, and the asking
     nodes go to the blocks, QUERIES a task. DivideSkip answers: the lists of the query's shingles are divided into a
     few long ones and short ones; the short ones are merged by a heap that skips all documents that cannot reach
     T less the weight of the long lists; those that do are looked up in the long lists by binary search, and are
     retained if the overlap is reached. Lists with the same documents are merged once, with their number as weight;
  5. links become components. Lists that still hold several components are searched again: nodes outside the list's
     largest component ask all blocks with which they share, in such lists, c / 2 heads of other components' nodes of a
     like set size (of all lists that two nodes share, one of the two is outside in half at least). Blocks
     are made of nodes of one list, so a list of k nodes is asked for in k / (nodes a block) blocks. A task puts out
     the links that join components not joined by its earlier ones, fewer than it has rows. No two linked components
     stay apart, and no list of pairs is put out.

Shingles are known by 64-bit hashes. Defined results: null or empty text has an empty set, is its own component and
linked with nothing; a null doc_id never names a component (component_id is null if all ids of it are); rows with
one doc_id are separate rows; an empty table gives no rows; other columns are ignored. A very long text is hashed in
pieces (8 bytes of memory a shingle, some copies of it) and is a block of its own.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import U64, chunks_of, drop_table, key_filter, materialize, maybe_in, mix, ragged, read_table
from .neardup import CHUNK, components, merge_links, shingle_sets, with_component
from .phrases import holders, identified

SHINGLE = 5
THRESHOLD = 80
#: Percent of a set that its head is longer than the shortest that shares one shingle.
SHARED = 10
LEAST = 4
WINDOW = 2_000_000
HOT_SHINGLES = 1 << 20
BLOCK = 100_000
QUERIES = 256
#: DivideSkip's cost factor: the long lists weigh T / (MU * log2(longest list) + 1) at most.
MU = 0.01


# ---------------------------------------------------------------- the order of shingles


def frequent_shingles(rows: DataFrame, width: int, most: int = HOT_SHINGLES) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, in order, and classes of frequent shingles: at most so many."""

    def run(batches):
        held: list[np.ndarray] = []
        waiting = 0
        for b in batches:
            for c in chunks_of(b.column(0), CHUNK):
                h, _ = shingle_sets(c, width)
                held.append(h)
                waiting += len(h)
                if waiting >= WINDOW:
                    yield _repeated(held)
                    held, waiting = [], 0
        yield _repeated(held)

    counts = rows.select("text").mapInArrow(run, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    counts = materialize(counts, "overlap-frequent")
    level = F.floor(F.log2("n") * 4).cast("int")
    sizes = sorted(((r["level"], r["k"]) for r in counts.groupBy(level.alias("level")).agg(F.count("*").alias("k")).collect()), reverse=True)  # at most 256 rows
    total, least = 0, None
    for k, n in sizes:
        total += n
        if total > most:
            break
        least = k
    hot = counts.where(level >= least if least is not None else F.lit(False)).select("shingle", level.alias("level")).toArrow()
    drop_table(counts)
    h = hot["shingle"].to_numpy().view(U64)
    order = np.argsort(h)
    return h[order], (hot["level"].to_numpy()[order] + 1).astype(np.uint8)


def _repeated(held: list[np.ndarray]) -> pa.RecordBatch:
    h, n = np.unique(np.concatenate([np.zeros(0, U64), *held]), return_counts=True)
    many = n >= LEAST
    return pa.record_batch({"shingle": h[many].view(np.int64), "n": n[many].astype(np.int64)})


def scan_heads(rows: DataFrame, width: int, threshold: int, hot: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """doc_id, did, th, n (set size), key (of the set, null if empty) and head of every text."""
    known, level = hot

    def run(batches):
        for b in batches:
            for c in chunks_of(b.column(3), CHUNK):
                h, d = shingle_sets(c, width)
                n = np.bincount(d, minlength=c.n)
                full = np.flatnonzero(n)
                key, heads = [None] * c.n, [None] * c.n
                if len(full):
                    first = np.searchsorted(d, full)
                    sums = np.stack([np.add.reduceat(mix(h ^ U64(salt)), first) for salt in (0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)], axis=1)
                    rank = np.zeros(len(h), np.uint8)
                    if len(known):
                        at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                        rank = np.where(known[at] == h, level[at], 0).astype(np.uint8)
                    order = np.lexsort((h, rank, d))
                    size = n[full] - -(-threshold * n[full] // 100) - (-SHARED * n[full] // 100)
                    own = h[order[ragged(first, size)]]
                    ends = np.cumsum(size).tolist()
                    for k, s, e, z in zip(full.tolist(), sums, ends, size.tolist(), strict=True):
                        key[k], heads[k] = s.tobytes(), own[e - z : e].tobytes()
                a = int(c.rows[0])
                yield pa.RecordBatch.from_arrays([*(b.column(k).slice(a, c.n) for k in range(3)), pa.array(n, pa.int64()), pa.array(key, pa.binary()), pa.array(heads, pa.binary())], ["doc_id", "did", "th", "n", "key", "head"])

    return rows.select("doc_id", "did", "th", "text").mapInArrow(run, "doc_id long, did long, th binary, n long, key binary, head binary")


def head_rows(nodes: DataFrame, among: np.ndarray | None = None) -> DataFrame:
    """(shingle, node, n): a row for each shingle of a head (that the filter may hold)."""

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                blobs = part.column(2).to_pylist()
                sizes = np.array([len(x) // 8 for x in blobs], np.int64)
                h, row = np.frombuffer(b"".join(blobs), U64), np.repeat(np.arange(len(sizes)), sizes)
                if among is not None:
                    own = maybe_in(among, h)
                    h, row = h[own], row[own]
                row = pa.array(row)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), part.column(0).take(row), part.column(1).take(row)], ["shingle", "node", "n"])

    return nodes.select("node", "n", "head").mapInArrow(run, "shingle long, node long, n long")


# ---------------------------------------------------------------- DivideSkip


def merge_skip(lists: list[list[int]], weights: list[int], need: int) -> list[tuple[int, int]]:
    """(document, weight) of documents whose lists weigh at least need, by a heap over sorted lists."""
    out: list[tuple[int, int]] = []
    heap = [(x[0], i, 0) for i, x in enumerate(lists)]
    heapq.heapify(heap)
    while heap:
        top, weight, taken = heap[0][0], 0, []
        while heap and heap[0][0] == top:
            taken.append(heapq.heappop(heap))
            weight += weights[taken[-1][1]]
        if weight >= need:
            out.append((top, weight))
            to = top + 1
        else:  # documents before the next one are in lists that weigh too little
            while heap and weight + weights[heap[0][1]] < need:
                taken.append(heapq.heappop(heap))
                weight += weights[taken[-1][1]]
            if not heap:
                break
            to = max(top + 1, heap[0][0])
        for _, i, at in taken:
            at = bisect_left(lists[i], to, at)
            if at < len(lists[i]):
                heapq.heappush(heap, (lists[i][at], i, at))
    return out


class Inverted:
    """The inverted lists of a block of sets."""

    def __init__(self, h: np.ndarray, doc: np.ndarray, node: np.ndarray, comp: np.ndarray):
        self.node, self.comp, self.size = node, comp, np.bincount(doc, minlength=len(node))
        order = np.lexsort((doc, h))
        h, self.post = h[order], doc[order]
        self.vocabulary, start, lens = np.unique(h, return_index=True, return_counts=True)
        sums = np.add.reduceat(mix(self.post.astype(U64) + U64(1)), start) if len(h) else np.zeros(0, U64)
        _, first, self.kind = np.unique(sums, return_index=True, return_inverse=True)
        same = np.array_equal(lens, lens[first][self.kind]) and np.array_equal(self.post, self.post[ragged(start[first][self.kind], lens)])
        if not same:  # two lists that differ share a sum
            first, self.kind = np.arange(len(start)), np.arange(len(start))
        self.start, self.lens = start[first], lens[first]
        self.as_list: dict[int, list[int]] = {}

    def list_of(self, kind: int) -> list[int]:
        if kind not in self.as_list:
            self.as_list[kind] = self.post[self.start[kind] : self.start[kind] + self.lens[kind]].tolist()
        return self.as_list[kind]

    def search(self, own: np.ndarray, comp: int, threshold: int) -> np.ndarray:
        """The documents of other components that are linked with the set own."""
        n = len(own)
        least = -(-threshold * n // 100)
        at = np.minimum(np.searchsorted(self.vocabulary, own), len(self.vocabulary) - 1)
        kinds, weight = np.unique(self.kind[at[self.vocabulary[at] == own]], return_counts=True)
        if weight.sum() < least:
            return np.zeros(0, np.int64)
        lens = self.lens[kinds]
        order = np.argsort(-lens, kind="stable")
        kinds, weight, lens = kinds[order], weight[order], lens[order]
        total = np.cumsum(weight)
        n_long = int(np.searchsorted(total, min(least - 1, least / (MU * math.log2(max(2, lens[0])) + 1)), side="right"))
        need = least - (int(total[n_long - 1]) if n_long else 0)
        short = [self.list_of(k) for k in kinds[n_long:].tolist()]
        found = merge_skip(short, weight[n_long:].tolist(), need)
        if not found:
            return np.zeros(0, np.int64)
        doc, common = np.array(found, np.int64).T
        ok = (self.comp[doc] != comp) & (100 * np.minimum(self.size[doc], n) >= threshold * np.maximum(self.size[doc], n))
        doc, common = doc[ok], common[ok]
        for k, w in zip(kinds[:n_long].tolist(), weight[:n_long].tolist(), strict=True):
            own_list = self.post[self.start[k] : self.start[k] + self.lens[k]]
            place = np.minimum(np.searchsorted(own_list, doc), len(own_list) - 1)
            common = common + w * (own_list[place] == doc)
        return doc[100 * common >= threshold * (self.size[doc] + n - common)]


def root_of(above: dict[int, int], comp: int) -> int:
    """The component that comp has become part of."""
    while comp in above:
        above[comp], comp = above.get(above[comp], above[comp]), above[comp]
    return comp


def search_blocks(index: DataFrame, asked: DataFrame, texts: DataFrame, width: int, threshold: int) -> DataFrame:
    """(a, b): links found between asking nodes and nodes of the blocks they ask.

    Of the links of a task, only those come out that join two components which no earlier one has joined, so they are
    fewer than its rows.

    index: block, node, comp. asked: block, node, comp. texts: node, text.
    """
    tasks = asked.groupBy("block").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("tasks"))
    tasks = materialize(tasks, "overlap-tasks")
    held = index.join(tasks, "block").withColumn("task", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1))).withColumn("asks", F.lit(False))
    asking = asked.join(tasks, "block").withColumn("task", F.pmod(F.xxhash64("node"), F.col("tasks")).cast("int")).withColumn("asks", F.lit(True))
    rows = held.select("block", "task", "asks", "node", "comp").union(asking.select("block", "task", "asks", "node", "comp")).join(texts, "node")
    rows = rows.select("block", "task", "asks", "node", "comp", "text").repartition("block", "task").sortWithinPartitions("block", "task", "asks")

    def run(batches):
        at, sets, inverted, above = None, [], None, {}
        for b in batches:
            block, task, asks, node, comp = (b.column(k).to_numpy(zero_copy_only=False) for k in range(5))
            text, out = b.column(5), []
            edge = np.flatnonzero((block[1:] != block[:-1]) | (task[1:] != task[:-1]) | (asks[1:] != asks[:-1])) + 1
            for lo, hi in zip([0, *edge.tolist()], [*edge.tolist(), len(block)], strict=True):
                if lo == hi:
                    continue
                if at != (block[lo], task[lo]):
                    at, sets, inverted, above = (block[lo], task[lo]), [], None, {}
                for c in chunks_of(text.slice(lo, hi - lo), CHUNK):
                    h, d = shingle_sets(c, width)
                    rows = lo + c.rows
                    if not asks[lo]:
                        sets.append((h, d, node[rows], comp[rows]))
                        continue
                    if inverted is None:
                        inverted, sets = _inverted(sets), []
                    bounds = np.searchsorted(d, np.arange(c.n + 1))
                    for k, r in enumerate(rows.tolist()):
                        own = root_of(above, int(comp[r]))
                        for x in inverted.search(h[bounds[k] : bounds[k + 1]], own, threshold).tolist():
                            if inverted.comp[x] != own:  # not joined by another link of this task
                                above[int(inverted.comp[x])] = own
                                inverted.comp[inverted.comp == inverted.comp[x]] = own
                                out.append((int(node[r]), int(inverted.node[x])))
            if out:
                a, o = np.array(out, np.int64).T
                yield pa.record_batch({"a": np.minimum(a, o), "b": np.maximum(a, o)})

    links = materialize(rows.mapInArrow(run, "a long, b long").distinct(), "overlap-links")
    drop_table(tasks)
    return links


def _inverted(sets: list[tuple]) -> Inverted:
    base = np.cumsum([0, *(len(s[2]) for s in sets[:-1])])
    return Inverted(np.concatenate([s[0] for s in sets]), np.concatenate([s[1] + k for s, k in zip(sets, base, strict=True)]), np.concatenate([s[2] for s in sets]), np.concatenate([s[3] for s in sets]))


# ---------------------------------------------------------------- the join


def leaders_asked(members: DataFrame, met: DataFrame, threshold: int) -> tuple[DataFrame, DataFrame]:
    """Blocks of leaders, and the nodes that ask for them. members: shingle, node, n, leader."""
    shared = members.where("node <> leader").groupBy("node", "n", "leader").agg(F.count("*").alias("k"))
    near = F.expr(f"100 * least(n, leader_n) >= {threshold} * greatest(n, leader_n) AND 200 * k >= {SHARED} * n")
    shared = shared.join(met.select(F.col("node").alias("leader"), F.col("n").alias("leader_n")), "leader").where(near)
    pairs = materialize(shared.groupBy("node").agg(F.max_by("leader", F.struct("k", "leader")).alias("leader")), "overlap-pairs")
    leaders = pairs.select(F.col("leader").alias("node")).distinct().join(met, "node")
    blocks = max(1, -(-(leaders.agg(F.sum("n")).first()[0] or 0) // BLOCK))
    block = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks))
    return leaders.select(block("node").alias("block"), "node", F.col("node").alias("comp")), pairs.select(block("leader").alias("block"), "node", F.col("node").alias("comp")).distinct()


def open_asked(members: DataFrame, labels: DataFrame, threshold: int) -> tuple[DataFrame, DataFrame]:
    """Blocks of the nodes of lists with several components, and the nodes that ask for them."""
    placed = with_component(members.select("shingle", "node", "n"), labels)
    sizes = placed.groupBy("shingle", "comp").agg(F.count("*").alias("k"))
    main = sizes.groupBy("shingle").agg(F.max_by("comp", F.struct("k", "comp")).alias("main"), F.sum("k").alias("m"), F.max("k").alias("most")).where("m > most").drop("most")
    like = F.floor(F.log("n") / F.lit(math.log(100 / threshold))).cast("int")
    opened = materialize(placed.join(main, "shingle").withColumn("size", like), "overlap-open")
    homes = opened.groupBy("node", "comp", "n", "size").agg(F.max_by("shingle", F.struct("m", "shingle")).alias("home"))
    parts = materialize(homes.groupBy("home", "size").agg(F.ceil(F.sum("n") / BLOCK).alias("parts")), "overlap-parts")
    index = homes.join(parts, ["home", "size"]).select("node", "comp", F.xxhash64("home", "size", F.pmod(F.xxhash64("node"), F.col("parts"))).alias("block"))
    index = materialize(index, "overlap-index")
    entries = opened.join(index.select("node", "block"), "node").groupBy("shingle", F.col("size").alias("size_b"), "block").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    shared = opened.where("comp <> main").join(entries, "shingle").where("abs(size - size_b) <= 1 AND (lo <> comp OR hi <> comp)").groupBy("block", "node", "comp", "n").agg(F.count("*").alias("k"))
    # c of the smallest set that may be linked; in half of the lists that two nodes share, one of the two is outside the largest component
    asked = materialize(shared.where(f"2 * k >= ceil({SHARED} * ceil({threshold} * n / 100) / 100)").select("block", "node", "comp"), "overlap-asked")
    drop_table(opened)
    drop_table(parts)
    return index.join(asked.select("block").distinct(), "block", "left_semi"), asked


def overlap_components(docs: DataFrame, width: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, n (set size) and component_id of every row."""
    rows = identified(docs)
    scanned = materialize(scan_heads(rows, width, threshold, frequent_shingles(rows, width)), "overlap-scan")
    nodes = scanned.where("key is not null").groupBy("key").agg(F.min(F.struct("did", "th")).alias("rep"), F.first("n").alias("n"), F.first("head").alias("head")).select(F.monotonically_increasing_id().alias("node"), "key", "rep.did", "rep.th", "n", "head")
    nodes = materialize(nodes, "overlap-nodes")
    slim = materialize(scanned.drop("head").join(nodes.select("key", "node"), "key", "left").select("doc_id", "n", "node"), "overlap-slim")
    drop_table(scanned)
    lists = head_rows(nodes).select("shingle", "node").groupBy("shingle").agg(F.min("node").alias("leader"), F.max("node").alias("last")).where("leader < last")
    lists = materialize(lists.select("shingle", "leader"), "overlap-lists")
    among = key_filter(lists, "shingle", lists.count())
    members = materialize(head_rows(nodes, among).join(lists, "shingle"), "overlap-members")
    drop_table(lists)
    met = materialize(members.select("node").distinct().join(nodes.drop("key", "head"), "node"), "overlap-met")
    drop_table(nodes)
    texts = materialize(holders(rows, met.select("did", "th", "node"), met.count()).select("node", "text"), "overlap-texts")

    index, asked = leaders_asked(members, met, threshold)
    labels = components(search_blocks(index, asked, texts, width, threshold).toDF("u", "v"))
    index, asked = open_asked(members, labels, threshold)
    labels = merge_links(labels, search_blocks(index, asked, texts, width, threshold))
    for table in (members, met, texts):
        drop_table(table)
    placed = slim.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    least = materialize(placed.where("comp is not null").groupBy("comp").agg(F.min("doc_id").alias("least")), "overlap-least")
    return placed.join(least, "comp", "left").select("doc_id", "n", F.when(F.col("comp").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))


def op12_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap_components(read_table(spark, sf_dir, "documents"), 4, 85).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
