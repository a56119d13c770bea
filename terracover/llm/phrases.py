"""Substring dedup with repeated-phrase automata (operator 10).

A window is WINDOW consecutive words. Every window has one phrase of PHRASE words whose hash is the
least of all phrases in it (winnowing), so two equal windows always share such a phrase.
  1. scan: each whole text gives its word count, the digest of its words and its winnowed phrases;
     texts with the same words as a text of a smaller doc_id are settled by the digest alone;
  2. confirm: a phrase recurs if two documents of different ids hold it (counted over all documents).
     Confirmed phrases are dealt to shards of about SHARD_PHRASES, phrases that the same documents hold
     to the same shard (by the least key of their holders), and read off the texts as words;
  3. locate: for each shard one Aho-Corasick automaton over words is compiled (pyahocorasick), and all
     documents that hold a confirmed phrase of the shard are streamed through it, about SHARD_BYTES a
     task; so a phrase that a third of all documents hold is searched by many tasks. Only where an automaton
     finds a phrase are the windows that it is the least phrase of hashed (96 bits);
  4. compare: the least doc_id of each window is found by an aggregation with map-side combining, and
     joined back; words of windows that start in a smaller doc_id too are removed.
A document without a confirmed phrase shares no window (winnowing), so it is routed to no shard; nothing is
dropped or capped. Hot phrases and windows meet in aggregations and in joins that Spark may split.

Defined results: null or empty text has no words; a null doc_id counts as the smallest; rows with the
same doc_id never remove each other's words, and repeated rows are returned each; texts under WINDOW
words stay whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, U64, Chunk, chunks_of, doc_of, drop_table, key_filter, materialize, maybe_in, mix, prefix_hash, read_table, stretch_hash, window_hash, word_bounds

WINDOW = 50
PHRASE = 8
#: Phrases of one automaton, and bytes of documents that one task streams through it.
SHARD_PHRASES = 50_000
SHARD_BYTES = 8_000_000
LEAST_ID = -(2**63)
NOTHING = hashlib.sha256(b"").hexdigest()


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every width consecutive values, by doubling."""
    have, size = values, 1
    while size * 2 <= width:
        have = np.minimum(have[:-size], have[size:])
        size *= 2
    return np.minimum(have[: len(have) - (width - size)], have[width - size :]) if width > size else have


_POS_BITS = 28


def winnow(grams: np.ndarray, width: int) -> np.ndarray:
    """For each start of width consecutive grams, the position of the gram with the least hash (ties: leftmost)."""
    if len(grams) < width:
        return np.zeros(0, np.int64)
    mask = U64((1 << _POS_BITS) - 1)
    if len(grams) >= 1 << _POS_BITS:  # one enormous text: halves that overlap
        half = len(grams) // 2
        return np.concatenate((winnow(grams[: half + width - 1], width), winnow(grams[half:], width) + half))
    packed = (grams & ~mask) | np.arange(len(grams), dtype=U64)
    return (sliding_least(packed, width) & mask).astype(np.int64)


def in_doc(key: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """A hash of a key inside its document of a chunk."""
    return mix(key + doc.astype(U64) * U64(0xD6E8FEB86659FD93))


def words_of(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends, documents and hashes of the words of a chunk."""
    starts, ends = word_bounds(chunk.buf)
    return starts, ends, doc_of(starts, chunk.off), stretch_hash(prefix_hash(chunk.buf), starts, ends)


def joined_words(chunk: Chunk, starts: np.ndarray, ends: np.ndarray, doc: np.ndarray, keep: np.ndarray | None = None) -> list[bytes]:
    """The (kept) words of each document, joined by one space."""
    if keep is not None:
        starts, ends, doc = starts[keep], ends[keep], doc[keep]
    flag = np.zeros(len(chunk.buf) + 1, np.int8)
    np.add.at(flag, starts, 1)
    np.add.at(flag, ends + 1, -1)  # the byte behind a word too
    mask = np.cumsum(flag[:-1]) > 0
    out = chunk.buf[mask]
    out[SPACE[out]] = 32
    sizes = np.bincount(doc, weights=(ends - starts + 1), minlength=chunk.n).astype(np.int64)
    at = np.concatenate(([0], np.cumsum(sizes)))
    raw = out.tobytes()
    return [raw[a : b - 1] if b > a else b"" for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def identified(docs: DataFrame) -> DataFrame:
    """doc_id, its comparable form, a key of the text, and the text."""
    own = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST_ID)).alias("did"), F.unhex(F.md5(own)).alias("th"), own.alias("text"))


def keyed_rows(docs: DataFrame) -> DataFrame:
    """row (a struct of all columns, so that no name can clash), did and th."""
    own = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST_ID)).alias("did"), F.unhex(F.md5(own)).alias("th"))


def scan_words(rows: DataFrame) -> DataFrame:
    """doc_id, did, th, n, sha and the distinct winnowed phrases of every text."""

    def run(batches):
        for b in batches:
            for c in chunks_of(b.column(3)):
                starts, ends, doc, wh = words_of(c)
                n = np.bincount(doc, minlength=c.n)
                phrase = window_hash(wh, PHRASE)
                least = winnow(phrase, WINDOW - PHRASE + 1)
                whole = np.flatnonzero(doc[WINDOW - 1 :] == doc[: len(least)]) if len(least) else np.zeros(0, np.int64)
                at = np.unique(least[whole])
                own, sizes = phrase[at], np.bincount(doc[at], minlength=c.n)
                ends_at = np.cumsum(sizes).tolist()
                blobs = [np.unique(own[e - k : e]).tobytes() for e, k in zip(ends_at, sizes.tolist(), strict=True)]
                sha = [hashlib.sha256(j).hexdigest() for j in joined_words(c, starts, ends, doc)]
                a = int(c.rows[0])
                yield pa.RecordBatch.from_arrays([b.column(0).slice(a, c.n), b.column(1).slice(a, c.n), b.column(2).slice(a, c.n), pa.array(n, pa.int64()), pa.array(sha), pa.array(blobs, pa.binary())], ["doc_id", "did", "th", "n", "sha", "phrases"])

    return rows.mapInArrow(run, "doc_id long, did long, th binary, n long, sha string, phrases binary")


def unpacked(rows: DataFrame, blob: str, name: str) -> DataFrame:
    """(did, th, name): a row for each 64-bit value of a binary column."""

    def run(batches):
        for b in batches:
            sizes = np.array([len(x) // 8 for x in b.column(2).to_pylist()], np.int64)
            values = np.frombuffer(b"".join(b.column(2).to_pylist()), np.int64)
            at = np.repeat(np.arange(len(sizes)), sizes)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), b.column(1).take(pa.array(at)), pa.array(values)], ["did", "th", name])

    return rows.select("did", "th", blob).mapInArrow(run, f"did long, th binary, {name} long")


def copies_of(scanned: DataFrame) -> DataFrame:
    """sha and the least did of texts that more than one id has."""
    return scanned.groupBy("sha").agg(F.min("did").alias("rep"), F.max("did").alias("last")).where("last > rep").select("sha", "rep")


def recurring(marks: DataFrame, name: str) -> DataFrame:
    """The marks that at least two ids have, and the least key of the rows that hold each."""
    key = F.xxhash64("did", "th").alias("key")
    return marks.select("did", name, key).groupBy(name).agg(F.min("did").alias("lo"), F.max("did").alias("hi"), F.min("key").alias("key")).where("lo < hi").select(name, "key")


def sharded(known: DataFrame) -> DataFrame:
    """(phrase, shard): about SHARD_PHRASES phrases a shard; those of one key together, unless they are more."""
    n_shards = max(1, -(-known.count() // SHARD_PHRASES))
    parts = known.groupBy("key").agg(F.ceil(F.count("*") / SHARD_PHRASES).alias("parts")).where("parts > 1")
    parts = materialize(parts, "phrase-parts")  # at most phrases / SHARD_PHRASES rows
    known = known.join(parts, "key", "left").withColumn("part", F.pmod(F.xxhash64("phrase"), F.coalesce("parts", F.lit(1))))
    return known.select("phrase", F.pmod(F.xxhash64("key", "part"), F.lit(n_shards)).cast("int").alias("shard"))


def holders(rows: DataFrame, keys: DataFrame, n_keys: int) -> DataFrame:
    """The rows whose (did, th) is among keys; a bounded filter keeps most texts out of the shuffle."""
    bits = key_filter(keys.select(F.xxhash64("did", "th").alias("k")), "k", n_keys)

    def run(batches):
        for b in batches:
            yield b.filter(pa.array(maybe_in(bits, b.column(0).to_numpy().view(U64)))).select(list(range(1, b.num_columns)))

    ddl = "did long, th binary, text string"
    likely = rows.select(F.xxhash64("did", "th").alias("k"), "did", "th", "text").mapInArrow(run, ddl).dropDuplicates(["did", "th"])
    return likely.join(keys, ["did", "th"])


def phrase_words(held: DataFrame) -> DataFrame:
    """(shard, words): the confirmed phrases of every shard, once each, read off the texts that hold them.

    held: text, phrases (array of struct phrase, shard).
    """

    def run(batches):
        for b in batches:
            lists = b.column(1)
            for c in chunks_of(b.column(0)):
                starts, ends, doc, wh = words_of(c)
                phrase = window_hash(wh, PHRASE)
                own = [lists[int(r)].values for r in c.rows]
                wanted = np.concatenate([np.asarray(x.field(0), np.int64) for x in own]).view(U64)
                shard = np.concatenate([np.asarray(x.field(1), np.int32) for x in own])
                wanted, first = np.unique(wanted, return_index=True)
                shard = shard[first]
                inside = np.flatnonzero(doc[PHRASE - 1 :] == doc[: len(phrase)])
                at = inside[np.isin(phrase[inside], wanted)]
                at = at[np.unique(phrase[at], return_index=True)[1]]
                shard = shard[np.searchsorted(wanted, phrase[at])]
                raw = c.buf.tobytes()
                words = [b" ".join(raw[s:e].split()) for s, e in zip(starts[at].tolist(), ends[at + PHRASE - 1].tolist(), strict=True)]
                yield pa.record_batch({"shard": pa.array(shard), "words": pa.array(words, pa.binary())})

    return held.select("text", "phrases").mapInArrow(run, "shard int, words binary").distinct()


class Automaton:
    """Finds phrases of words in texts. Words are numbered by the phrases, all others share one number.

    A number is written as three symbols, each from an alphabet of its own, so that a node has few children (which are
    searched one after another) and a match can begin at a word only.
    """

    def __init__(self, phrases: list[bytes]):
        import ahocorasick

        words = dict.fromkeys(w for p in phrases for w in p.split())
        base = math.ceil((len(words) + 1) ** (1 / 3)) + 1
        self.code = {w: self._symbols(k, base) for k, w in enumerate(words, 1)}
        self.other = self._symbols(0, base)
        self.found = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for p in phrases:
            self.found.add_word("".join([self.code[w] for w in p.split()]), 1)
        self.found.make_automaton()

    @staticmethod
    def _symbols(number: int, base: int) -> str:
        return chr(1 + number // base**2) + chr(1 + base + number // base % base) + chr(1 + 2 * base + number % base)

    def places(self, text: bytes) -> list[int]:
        """The numbers of the words of a text at which a phrase starts."""
        get, other = self.code.get, self.other
        return [end // 3 - PHRASE + 1 for end, _ in self.found.iter("".join([get(w, other) for w in text.split()]))]


def windows_in(docs: pa.Table, phrases: list[bytes]) -> pa.Table:
    """The windows around the phrases of one shard; docs: uid, did, text."""
    automaton, out = Automaton(phrases), []
    text = docs["text"].combine_chunks()
    for c in chunks_of(text):
        _, _, doc, wh = words_of(c)
        if len(wh) < WINDOW:
            continue
        sizes = np.bincount(doc, minlength=c.n)
        base = np.cumsum(sizes) - sizes
        hit = np.zeros(len(wh), bool)
        for d in np.flatnonzero(sizes >= WINDOW).tolist():
            hit[base[d] + np.array(automaton.places(c.buf[c.off[d] : c.off[d + 1] - 1].tobytes()), np.int64)] = True
        least = winnow(window_hash(wh, PHRASE), WINDOW - PHRASE + 1)
        at = np.flatnonzero(hit[least] & (doc[WINDOW - 1 :] == doc[: len(least)]))
        d, w1 = doc[at], window_hash(wh, WINDOW)[at]
        # of equal windows of a document (periodic text) the first stands for all
        one = np.unique(in_doc(w1, d), return_index=True)[1]
        at, d, w1 = at[one], d[one], w1[one]
        w2 = window_hash(mix(wh ^ U64(0xA0761D6478BD642F)), WINDOW)[at]
        rows = pa.array(c.rows[d])
        out.append(pa.table({"w1": w1.view(np.int64), "w2": (w2 >> U64(32)).astype(np.uint32).view(np.int32), "uid": docs["uid"].take(rows), "did": docs["did"].take(rows), "pos": (at - base[d]).astype(np.int32)}))
    return pa.concat_tables(out) if out else WINDOWS.empty_table()


WINDOWS = pa.schema([("w1", pa.int64()), ("w2", pa.int32()), ("uid", pa.int64()), ("did", pa.int64()), ("pos", pa.int32())])


def locate_windows(held: DataFrame, phrases: DataFrame) -> DataFrame:
    """(w1, w2, uid, did, pos): the different windows around all occurrences of the confirmed phrases.

    held: uid, did, text, n_bytes, phrases (array of struct phrase, shard). phrases: phrase_words() of it.
    """
    routed = held.select("uid", "did", "n_bytes", F.explode(F.array_distinct("phrases.shard")).alias("shard"), "text")
    tasks = routed.groupBy("shard").agg(F.ceil(F.sum("n_bytes") / SHARD_BYTES).cast("int").alias("tasks"))
    tasks = materialize(tasks, "phrase-tasks")  # one row a shard
    left = routed.join(tasks, "shard").select("shard", F.pmod(F.xxhash64("uid"), F.col("tasks")).alias("task"), "uid", "did", "text")
    right = phrases.join(tasks, "shard").select("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tasks").cast("long") - 1)).alias("task"), "words")

    def run(docs: pa.Table, own: pa.Table) -> pa.Table:
        return windows_in(docs, own["words"].to_pylist()).cast(WINDOWS)

    return left.groupBy("shard", "task").cogroup(right.groupBy("shard", "task")).applyInArrow(run, "w1 long, w2 int, uid long, did long, pos int")


def later_windows(windows: DataFrame) -> DataFrame:
    """uid and the starts of windows that a smaller did holds too."""
    least = windows.groupBy("w1", "w2").agg(F.min("did").alias("lo"), F.max("did").alias("hi")).where("lo < hi").select("w1", "w2", "lo")
    least = materialize(least, "phrase-least")  # so that the join below reads plain shuffles, which Spark can split
    return windows.join(least, ["w1", "w2"]).where("did > lo").groupBy("uid").agg(F.collect_list("pos").alias("starts"))


def remove_words(rows: DataFrame) -> DataFrame:
    """(did, th, n_removed, kept): texts without the words under windows. rows: did, th, text, starts."""

    def run(batches):
        for b in batches:
            for c in chunks_of(b.column(2)):
                starts, ends, doc, wh = words_of(c)
                sizes = np.bincount(doc, minlength=c.n)
                base = np.cumsum(sizes) - sizes
                s = np.concatenate([np.asarray(b.column(3)[int(r)].values, np.int64) + base[k] for k, r in enumerate(c.rows)])
                whole = window_hash(wh, WINDOW)
                own = in_doc(whole, doc[: len(whole)])
                s = np.flatnonzero((doc[WINDOW - 1 :] == doc[: len(whole)]) & np.isin(own, own[s]))  # with all windows like them
                cover = np.zeros(len(starts) + 1, np.int64)
                np.add.at(cover, s, 1)
                np.add.at(cover, s + WINDOW, -1)
                keep = np.cumsum(cover[:-1]) == 0
                kept = joined_words(c, starts, ends, doc, keep)
                a = int(c.rows[0])
                yield pa.RecordBatch.from_arrays([b.column(0).slice(a, c.n), b.column(1).slice(a, c.n), pa.array(np.bincount(doc[~keep], minlength=c.n)), pa.array(kept, pa.binary()).cast(pa.string())], ["did", "th", "n_removed", "kept"])

    return rows.select("did", "th", "text", "starts").mapInArrow(run, "did long, th binary, n_removed long, kept string")


def dedup_phrases(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(verdicts, changed): doc_id, did, th, n, sha, copy for every row; and did, th, n_removed, kept for
    the distinct rows, other than whole copies, of which words were removed."""
    rows = identified(docs)
    scanned = materialize(scan_words(rows), "phrase-scan")
    copies = materialize(copies_of(scanned), "phrase-copies")
    verdicts = scanned.join(copies, "sha", "left").withColumn("copy", F.coalesce(F.col("did") > F.col("rep"), F.lit(False)) & (F.col("n") >= WINDOW))
    marks = unpacked(verdicts.where(~F.col("copy") & (F.octet_length("phrases") > 0)), "phrases", "phrase")
    known = materialize(recurring(marks, "phrase"), "phrase-recurring")
    shards = materialize(sharded(known), "phrase-shards")  # a plain table, so that Spark can split hot phrases
    drop_table(known)
    both = marks.join(shards, "phrase").groupBy("did", "th").agg(F.collect_set(F.struct("phrase", "shard")).alias("phrases"))
    both = materialize(both.withColumn("uid", F.monotonically_increasing_id()), "phrase-holders")
    drop_table(shards)
    held = materialize(holders(rows, both, both.count()).withColumn("n_bytes", F.octet_length("text").cast("long")), "phrase-texts")
    drop_table(both)
    phrases = materialize(phrase_words(held), "phrase-words")
    windows = materialize(locate_windows(held, phrases), "phrase-windows")
    drop_table(phrases)
    changed = remove_words(held.join(later_windows(windows), "uid"))
    return verdicts.drop("phrases", "rep"), changed


def op10_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts, changed = dedup_phrases(read_table(spark, sf_dir, "documents"))
    changed = changed.select("did", "th", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
    rows = verdicts.join(changed, ["did", "th"], "left")
    copy = F.col("copy")
    return rows.select("doc_id", F.col("n").alias("n_words"), F.when(copy, F.col("n")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"), F.when(copy, F.lit(NOTHING)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"))
