"""Benchmark decontamination by template canonicalisation (operator 1).

Every text becomes a sequence of canonical tokens: words in lower case without outer punctuation, where
numbers, quantities, units behind numbers, and names (capitalised inside a sentence) are replaced by typed
placeholders. Windows of WINDOW tokens of the benchmark items are hash-joined with the windows of all
documents. A document holds an item if at least COVERAGE of the item's windows occur in it and the slots
agree: the fillers of equal item slots must be equal in the document too, for at least AGREEMENT of them.
So an item with other numbers, names or units is found, and a mere likeness of form is not.
Coverage and agreement are judged for each occurrence, so that a second copy with other fillers hides
nothing: hits of one shift (place in the document less place in the item), hits of near shifts (a copy
with words added or left out), and all hits of the document (a copy in parts far from each other). The
item is reported if any of them passes, with the figures of the one that has most windows.

Every window is also joined by a second key, its words without regard to case (A-Z and the accented
letters below U+0100) and without placeholders, so a verbatim copy is found in any case and wherever a
capital makes a name of a word. A copy with other fillers and other case at once is not found. Windows
poor in literals (lists of numbers or names) and items of fewer than MIN_TOKENS tokens have this key
only. Such windows count for coverage where an item has no others, and in excerpts: a run of EXCERPT successive
windows (EXCERPT + WINDOW - 1 tokens) whose slots agree is reported whatever share of the item it is.

The windows of documents pass a membership filter of bounded size built from the benchmark's windows
before the join; beyond its capacity the filter only lets more rows into the join.

Defined results: null or empty texts hold nothing; items under WINDOW tokens are
one window of their own length, an item without tokens matches nothing; repeated items match each; a null
doc_id or item_id is carried; an empty table on either side gives no rows; other columns are ignored.
A very long text is taken in pieces that end behind a space (a longer word makes a longer piece), so a worker
needs little more than three times its bytes; benchmark items are taken whole.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SPACE, U64, Chunk, chunks_of, doc_of, drop_table, key_filter, lower_ascii, materialize, maybe_in, mix, prefix_hash, read_table, stretch_hash, window_hash, word_bounds
from .phrases import identified, in_doc, keyed_rows

WINDOW = 10
MIN_TOKENS = 5
#: A window of placeholders needs so many literal tokens (half of a shorter one); others are joined by their words only.
MIN_LITERAL = 5
COVERAGE = 0.5
AGREEMENT = 0.8
#: Occurrences of an item are apart if their shifts differ by more than this, and by more than half of its windows.
GAP = WINDOW // 2
#: A contiguous excerpt of so many windows is reported.
EXCERPT = 11
#: Sets the keys of words apart from those of placeholders.
EXACT = U64(0x65786163745F6B65)
CHUNK = 500_000

#: Unit words that follow a number.
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g kg t lb lbs oz pound pounds ton tons ml l liter liters litre litres gallon gallons "
    "s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years mph kmh c f k degrees percent pct "
    "dollar dollars cent cents euro euros usd eur gbp w kw watt watts v volt volts j joule joules hz khz mhz ghz kb mb gb tb"
).split()


def _flags(values) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(values)] = True
    return out


_DIGIT = _flags(b"0123456789")
_PLAIN = _flags([*b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", *range(0x80, 256)])
_NUMERIC = _flags(b"0123456789.,:/%+-$")
_STOP = _flags(b".!?:;\"")
NUMBER, QUANTITY, UNIT, NAME = (U64(x) for x in (0x6E756D, 0x717479, 0x756E69, 0x6E616D))


def _hash_words(words: list[str]) -> np.ndarray:
    c = next(chunks_of(pa.array([" ".join(words)])))
    starts, ends = word_bounds(c.buf)
    return np.sort(stretch_hash(prefix_hash(c.buf), starts, ends))


UNIT_HASHES = _hash_words(UNITS)


def canonical(c: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes, filler hashes, which tokens are placeholders, and the document of each token."""
    starts, ends = word_bounds(c.buf)
    plain = _PLAIN[c.buf]
    # outer punctuation off: first and last plain byte of each word
    at = np.flatnonzero(plain)
    a = np.searchsorted(at, starts)
    b = np.searchsorted(at, ends)
    keep = b > a
    raw_end = ends[keep]
    word_start = starts[keep]
    first, last = at[a[keep]], at[b[keep] - 1] + 1
    buf = lower_ascii(c.buf)
    lead = np.flatnonzero(buf[:-1] == 0xC3) + 1
    lead = lead[(buf[lead] >= 0x80) & (buf[lead] <= 0x9E)]
    upper = (c.buf >= 65) & (c.buf <= 90)
    upper[lead - 1] = True
    buf[lead] += 0x20
    doc = doc_of(first, c.off)
    word = stretch_hash(prefix_hash(buf), first, last)

    def count(flags):
        total = np.concatenate(([0], np.cumsum(flags)))
        return total[last] - total[first]

    digits = count(_DIGIT[c.buf])
    number = (digits > 0) & (count(_NUMERIC[c.buf]) == last - first)
    quantity = ~number & _DIGIT[c.buf[first]]
    unit = np.zeros(len(first), bool)
    near = number[:-1] & (doc[1:] == doc[:-1])
    pos = np.minimum(np.searchsorted(UNIT_HASHES, word), len(UNIT_HASHES) - 1)
    unit[1:] = near & (UNIT_HASHES[pos] == word)[1:]
    lines = np.concatenate(([0], np.cumsum(c.buf == 10)))
    opens = np.ones(len(first), bool)  # a sentence
    opens[1:] = (doc[1:] != doc[:-1]) | (lines[word_start[1:]] != lines[word_start[:-1]]) | _STOP[c.buf[raw_end[:-1] - 1]] | (first[1:] > word_start[1:])
    name = upper[first] & ~opens & ~number & ~quantity & ~unit
    token = word.copy()
    for flags, value in ((number, NUMBER), (quantity, QUANTITY), (unit, UNIT), (name, NAME)):
        token[flags] = mix(np.array([value], U64))[0]
    return token, word, number | quantity | unit | name, doc


def token_pieces(c: Chunk, piece: int = CHUNK):
    """canonical() of a chunk and the place of its first token; of a long text in pieces, each behind the last WINDOW - 1 tokens before it."""
    if c.n > 1 or len(c.buf) <= 2 * piece:
        yield canonical(c), 0
        return
    space = SPACE[c.buf]
    at = low = base = 0  # low: where the last token before the piece begins, which decides on its first
    before = 0
    tail = (np.zeros(0, U64), np.zeros(0, U64), np.zeros(0, bool))
    while at < len(c.buf):
        to = min(at + piece, len(c.buf))
        to += int(space[to - 1 :].argmax())  # a chunk ends with a newline
        own = canonical(Chunk(c.rows, np.array([0, to - low]), c.buf[low:to]))
        tokens = tuple(np.concatenate((x, y[before:])) for x, y in zip(tail, own, strict=False))
        n = len(tokens[0])
        yield (*tokens, np.zeros(n, np.int64)), base
        drop = max(0, n - WINDOW + 1)
        tail, base = tuple(x[drop:] for x in tokens), base + drop
        plain = np.flatnonzero(_PLAIN[c.buf[low:to]])
        if len(plain):
            gaps = np.flatnonzero(space[low : low + plain[-1]])
            before, low = 1, low + (int(gaps[-1]) + 1 if len(gaps) else 0)
        at = to


def rich_windows(slot: np.ndarray, width: int) -> np.ndarray:
    """Which windows have literal tokens enough to be told by their form."""
    literal = np.concatenate(([0], np.cumsum(~slot)))
    rich = literal[width:] - literal[:-width] >= min(MIN_LITERAL, (width + 1) // 2)
    return rich if width >= MIN_TOKENS else np.zeros(len(rich), bool)


def windows_of(tokens: tuple[np.ndarray, ...], n: int, width: int, exact: bool, wanted: np.ndarray | None = None):
    """Hash, document, place in the document, and filler hashes (0: literal) of the windows of one width, and which are rich.

    tokens: canonical() of n documents. exact: all windows, keyed on the words; else the rich windows,
    keyed on placeholders.
    """
    token, word, slot, doc = tokens
    h = window_hash(word if exact else token, width)
    if not len(h):
        return h, doc[:0], doc[:0], np.zeros((0, width), U64), np.zeros(0, bool)
    rich = rich_windows(slot, width)
    at = np.flatnonzero((doc[width - 1 :] == doc[: len(h)]) & (exact | rich))
    h = h[at] ^ U64(width) ^ (EXACT if exact else U64(0))
    if wanted is not None:
        hit = maybe_in(wanted, h)
        at, h = at[hit], h[hit]
    first = np.searchsorted(doc, np.arange(n))
    fill = np.where(slot[at[:, None] + np.arange(width)], word[at[:, None] + np.arange(width)], U64(0)) if len(at) else np.zeros((0, width), U64)
    return h, doc[at], at - first[doc[at]], fill, rich[at]


def item_windows(items: DataFrame) -> DataFrame:
    """(w, item, item_id, pos, n_windows, counted, width, fill) of every item; item numbers repeated rows apart.

    counted: the windows that coverage is a share of, n_windows in all: the rich ones, or all if none is rich.
    """

    def run(batches):
        for b in batches:
            for c in chunks_of(b.column(2), CHUNK):
                tokens = canonical(c)
                n = np.bincount(tokens[3], minlength=c.n)
                for width in range(1, WINDOW + 1):
                    both = [windows_of(tokens, c.n, width, exact) for exact in (False, True)]
                    h, d, pos, rich = (np.concatenate([x[k] for x in both]) for k in (0, 1, 2, 4))
                    fill = np.concatenate([x[3] for x in both])
                    own = (n[d] == width) | (width == WINDOW) & (n[d] > WINDOW)
                    h, d, pos, fill, rich = h[own], d[own], pos[own], fill[own], rich[own]
                    if len(h):
                        n_rich = np.bincount(np.unique(np.stack((d, pos))[:, rich], axis=1)[0], minlength=c.n)[d]
                        total = np.where(n_rich > 0, n_rich, n[d] - width + 1)
                        rows = pa.array(c.rows[d])
                        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), b.column(0).take(rows), b.column(1).take(rows), pa.array(pos), pa.array(total), pa.array(rich | (n_rich == 0)), pa.array(np.full(len(h), width), pa.int32()), _lists(fill)], ["w", "item", "item_id", "pos", "n_windows", "counted", "width", "fill"])

    rows = items.select(F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")))
    return rows.mapInArrow(run, "w long, item long, item_id long, pos long, n_windows long, counted boolean, width int, fill array<long>")


def _lists(fill: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(fill) + 1) * fill.shape[1], pa.int32()), pa.array(fill.ravel().view(np.int64)))


def document_windows(rows: DataFrame, wanted: np.ndarray, widths: list[int]) -> DataFrame:
    """(w, doc_id, did, th, at, fill_d) of the document windows that the filter lets through; at: place in the document.

    Windows keyed on their words have no fill_d, since it is the item's. Where a window is a whole item, one
    of alike ones in a document is enough.
    """

    def run(batches):
        for b in batches:
            for c in chunks_of(b.column(3), CHUNK):
                for tokens, base in token_pieces(c):
                    for width, exact in itertools.product(widths, (False, True)):
                        h, d, place, fill, _ = windows_of(tokens, c.n, width, exact, wanted)
                        if exact:
                            fill = fill[:, :0]
                            if width < WINDOW:
                                one = np.unique(in_doc(h, d), return_index=True)[1]
                                h, d, place, fill = h[one], d[one], place[one], fill[one]
                        if len(h):
                            own = pa.array(c.rows[d])
                            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), *(b.column(k).take(own) for k in range(3)), pa.array(place + base), _lists(fill)], ["w", "doc_id", "did", "th", "at", "fill_d"])

    return rows.select("doc_id", "did", "th", "text").mapInArrow(run, "w long, doc_id long, did long, th binary, at long, fill_d array<long>")


def with_occurrences(hits: DataFrame) -> DataFrame:
    """A row for each hit and group of hits (level, part, run) it belongs to: the document, near shifts, one shift, and excerpts."""
    key = ["did", "th", "item"]
    hits = hits.withColumn("shift", F.col("at") - F.col("pos"))
    by_shift = Window.partitionBy(*key).orderBy("shift")
    apart = F.col("shift") - F.lag("shift").over(by_shift) > F.greatest(F.lit(GAP), F.expr("n_windows div 2"))
    hits = hits.withColumn("apart", F.coalesce(apart.cast("long"), F.lit(0))).withColumn("near", F.sum("apart").over(by_shift))
    one_shift = Window.partitionBy(*key, "shift")
    hits = hits.withColumn("run", F.col("pos") - F.row_number().over(one_shift.orderBy("pos")))
    hits = hits.withColumn("successive", F.count("*").over(Window.partitionBy(*key, "shift", "run")))
    # alike windows of the document count once in the document's own group
    hits = hits.withColumn("first", F.row_number().over(Window.partitionBy(*key, "pos", "fill_d").orderBy("at")) == 1)

    def group(level: int, part: Column, when: Column, run: Column | None = None) -> Column:
        return F.when(when, F.struct(F.lit(level).alias("level"), part.alias("part"), (F.lit(0).cast("long") if run is None else run).alias("run")))

    groups = F.array(group(0, F.lit(0).cast("long"), F.col("first")), group(1, F.col("near"), F.lit(True)), group(2, F.col("shift"), F.lit(True)), group(3, F.col("shift"), F.col("successive") >= EXCERPT, F.col("run")))
    return hits.withColumn("g", F.explode(F.array_compact(groups))).drop("shift", "apart", "near", "first", "run", "successive").select("*", "g.level", "g.part", "g.run").drop("g")


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, agreement: float = AGREEMENT) -> DataFrame:
    """doc_id, did, th, item_id, n_matched, n_windows, coverage, slot_agreement, same_fillers of each (text, item) found."""
    items = materialize(item_windows(benchmark), "item-windows")
    widths = [r["width"] for r in items.select("width").distinct().collect()]  # at most WINDOW
    wanted = key_filter(items, "w", items.count())
    found = document_windows(identified(docs), wanted, widths).dropDuplicates(["w", "did", "th", "at"])
    hits = found.join(items, "w").select("doc_id", "did", "th", "item", "item_id", "pos", "at", "n_windows", "counted", "fill", F.when(F.size("fill_d") == 0, F.col("fill")).otherwise(F.col("fill_d")).alias("fill_d"))
    hits = materialize(hits.dropDuplicates(["did", "th", "item", "pos", "at"]), "window-hits")
    drop_table(items)
    groups = materialize(with_occurrences(hits), "window-groups")
    drop_table(hits)
    hits = groups
    key = ["did", "th", "item", "level", "part", "run"]
    covered = hits.groupBy(*key).agg(F.first("doc_id").alias("doc_id"), F.first("item_id").alias("item_id"), F.count_distinct(F.when(F.col("counted"), F.col("pos"))).alias("n_matched"), F.first("n_windows").alias("n_windows"))
    covered = covered.withColumn("coverage", F.col("n_matched") / F.col("n_windows")).where((F.col("coverage") >= coverage) | (F.col("level") == 3))
    slots = hits.select(*key, F.explode(F.arrays_zip("fill", "fill_d")).alias("s")).where("s.fill <> 0").groupBy(*key, "s.fill", "s.fill_d").agg(F.count("*").alias("k"))
    agree = slots.groupBy(*key, "fill").agg(F.max("k").alias("top"), F.sum("k").alias("all"), F.sum(F.when(F.col("fill") == F.col("fill_d"), F.col("k")).otherwise(0)).alias("same"))
    agree = agree.groupBy(*key).agg((F.sum("top") / F.sum("all")).alias("slot_agreement"), (F.sum("same") == F.sum("all")).alias("same_fillers"))
    rows = covered.join(agree, key, "left").withColumn("slot_agreement", F.coalesce("slot_agreement", F.lit(1.0))).withColumn("same_fillers", F.coalesce("same_fillers", F.lit(True)))
    rows = rows.where(F.col("slot_agreement") >= agreement)
    out = ["doc_id", "item_id", "n_matched", "n_windows", "coverage", "slot_agreement", "same_fillers"]
    best = rows.groupBy("did", "th", "item").agg(F.max_by(F.struct(*out), F.struct("n_matched", "same_fillers", "slot_agreement")).alias("best"))
    return best.select("best.doc_id", "did", "th", *(f"best.{c}" for c in out[1:]))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the rows that hold a benchmark item."""
    bad = contaminated(docs, benchmark).select("did", "th").distinct()
    return keyed_rows(docs).join(bad, ["did", "th"], "left_anti").select("row.*")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", "item_id", "n_matched", "n_windows", "coverage", "slot_agreement", "same_fillers")
