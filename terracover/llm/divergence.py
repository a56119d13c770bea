"""Source divergence audit (operator 11).

Which terms make a source differ from its language, and how far any two sources of a language lie apart.
Terms are runs of ASCII letters and non-ASCII characters, A-Z lower-cased. A language keeps the terms that
at least MIN_DOCS of its documents hold. A source and a language give each kept term the whole number
p = 1 + floor(SCALE * (count + 2) / (N + 2 V)): count its occurrences there, N their sum over kept terms,
V the number of kept terms; the divergence of p and q is floor((p - q)**2 / (p + q)).

  1. sketch: every task fills a count-min sketch of document frequencies (DEPTH rows of SKETCH_CELLS cells
     that stop at MIN_DOCS, so the sum of two sketches loses nothing); executors merge them page by page. A
     cell never underestimates, so a term whose least cell is below MIN_DOCS cannot be kept;
  2. count: the texts are scanned again, impossible terms are dropped before anything is shuffled, and the
     survivors are counted exactly, by their bytes, first in the chunk, then in the task, then by key;
  3. sparse pair joins: only (source, term) rows with a count are joined. With z the p of an absent term,
     the sum over all V terms is V f(zA, zB), plus f(pA, zB) - f(zA, zB) for each term of A, the same for
     B, plus a correction for each term of both; the second part needs only how many terms of A have
     which count, the third is an equi-join on the term, summed up as it is made.

The sketch holds DEPTH * SKETCH_CELLS bytes (16 MiB) whatever the input; beyond some 10 million rare terms it
lets more terms through to the exact count and changes no result. A term's rows in a join are its sources.

Defined results: null text, lang and source read as ''; a text without terms still makes its group occur;
repeated rows count each; ties in value are ranked by the bytes of the item; a language without kept terms
has pairs of value 0 and no term rows; an empty table gives no rows; other columns are ignored. A very long
text is scanned in pieces that end behind a term, so memory follows its distinct terms.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import U64, Chunk, chunks_of, doc_of, drop_table, lower_ascii, materialize, mix, prefix_hash, read_table, stretch_hash

MIN_DOCS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000
DEPTH = 4
SKETCH_CELLS = 1 << 22
PAGE = 1 << 14
PIECE = 1_000_000

LETTER = np.zeros(256, bool)
LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_SALT = np.random.Generator(np.random.PCG64(110911)).integers(1, 2**64, DEPTH, dtype=U64)


# ---------------------------------------------------------------- terms of a chunk


def _terms(buf: np.ndarray, off: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct terms of some documents, and (document, term, occurrences) of every pair that occurs."""
    is_letter = LETTER[buf]
    edge = np.flatnonzero(is_letter[1:] != is_letter[:-1]) + 1
    if is_letter[0]:
        edge = np.concatenate(([0], edge))
    starts, ends = edge[0::2], edge[1::2]  # a chunk ends with a newline
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    letters = lower_ascii(buf[is_letter])
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    coded = words.dictionary_encode()
    n_terms = max(1, len(coded.dictionary))
    pair, n = np.unique(doc_of(starts, off) * n_terms + coded.indices.to_numpy().astype(np.int64), return_counts=True)
    return coded.dictionary, pair // n_terms, pair % n_terms, n


def terms_of(c: Chunk) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """_terms of a chunk; a long text is taken in pieces that end behind a term."""
    if c.n > 1 or len(c.buf) <= 2 * PIECE:
        return _terms(c.buf, c.off)
    found: list[pa.Array] = []
    counts: list[np.ndarray] = []
    at = 0
    while at < len(c.buf):
        to = min(at + PIECE, len(c.buf))
        to += int(np.argmin(LETTER[c.buf[to - 1 :]]))
        terms, _, term, n = _terms(c.buf[at:to], np.array([0, to - at]))
        found.append(terms.take(pa.array(term)))
        counts.append(n)
        at = to
    coded = pa.concat_arrays(found).dictionary_encode()
    total = np.bincount(coded.indices.to_numpy(), weights=np.concatenate(counts), minlength=len(coded.dictionary)).astype(np.int64)
    return coded.dictionary, np.zeros(len(total), np.int64), np.arange(len(total)), total


def term_hash(terms: pa.Array) -> np.ndarray:
    offsets = np.frombuffer(terms.buffers()[1], np.int64)[terms.offset : terms.offset + len(terms) + 1]
    buf = np.frombuffer(terms.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if len(terms) else np.zeros(0, np.uint8)
    return stretch_hash(prefix_hash(buf), offsets[:-1] - offsets[0], offsets[1:] - offsets[0])


def lang_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """For each chunk: its rows' (group code, groups), terms, hashes, and df and occurrences by (lang, term) and by (group, term).

    Columns of the batches: lang, source, text.
    """
    for b in batches:
        groups = pa.StructArray.from_arrays([b.column(0), b.column(1)], ["lang", "source"])
        lang = b.column(0).dictionary_encode()
        names = np.array([mix(term_hash(pa.array([x or b""], pa.large_binary())))[0] for x in lang.dictionary.cast(pa.binary()).to_pylist()], U64)
        lang = lang.indices.to_numpy()
        for c in chunks_of(b.column(2)):
            terms, doc, term, n = terms_of(c)
            yield groups, lang[c.rows], names, terms, doc, term, n, c


def slots(terms: np.ndarray, lang: np.ndarray, row: int, cells: int) -> np.ndarray:
    return (mix(mix(terms ^ lang) + _SALT[row]) & U64(cells - 1)).astype(np.int64)


def _sums(key: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sum of their weights."""
    own, inverse = np.unique(key, return_inverse=True)
    return own, np.bincount(inverse, weights=weight, minlength=len(own)).astype(np.int64)


# ---------------------------------------------------------------- the sketch


def document_sketch(rows: DataFrame, cells: int = SKETCH_CELLS, least: int = MIN_DOCS) -> np.ndarray:
    """(DEPTH, cells) document frequencies by (lang, term), never too small up to least, where they stop."""
    page = min(PAGE, cells)

    def fill(batches):
        have = np.zeros((DEPTH, cells), np.uint8)
        for _, lang, names, terms, doc, term, _, _ in lang_terms(batches):
            hashes = term_hash(terms)
            key, df = _sums(lang[doc].astype(np.int64) * max(1, len(terms)) + term, np.ones(len(doc)))
            h, g = hashes[key % max(1, len(terms))], names[key // max(1, len(terms))]
            for k in range(DEPTH):
                at, add = _sums(slots(h, g, k, cells), df)
                have[k, at] = np.minimum(least, have[k, at] + add)
        yield _pages(have.reshape(-1, page))

    def merge(batches):
        pages: dict[int, np.ndarray] = {}  # at most those of the sketch
        for b in batches:
            for k, at, n in zip(b.column(0).to_pylist(), b.column(1), b.column(2), strict=True):
                own = pages.setdefault(k, np.zeros(page, np.uint8))
                at = np.frombuffer(at.as_buffer(), "<u2")
                own[at] = np.minimum(least, own[at] + np.frombuffer(n.as_buffer(), np.uint8))
        yield _pages(np.stack(list(pages.values())), list(pages)) if pages else _pages(np.zeros((0, page), np.uint8))

    ddl = "page int, at binary, n binary"
    out = np.zeros((DEPTH * cells // page, page), np.uint8)
    merged = rows.mapInArrow(fill, ddl).repartition(16, "page").mapInArrow(merge, ddl).toArrow()
    for k, at, n in zip(merged["page"].to_pylist(), merged["at"], merged["n"], strict=True):
        out[k, np.frombuffer(at.as_buffer(), "<u2")] = np.frombuffer(n.as_buffer(), np.uint8)
    return out.reshape(DEPTH, cells)


def _pages(have: np.ndarray, names: list[int] | None = None) -> pa.RecordBatch:
    """The cells in use of every page: their places and values."""
    used = np.flatnonzero(have.any(axis=1)).tolist()
    at = [np.flatnonzero(have[k]) for k in used]
    return pa.record_batch({"page": pa.array([names[k] if names else k for k in used], pa.int32()), "at": pa.array([x.astype("<u2").tobytes() for x in at], pa.binary()), "n": pa.array([have[k][x].tobytes() for k, x in zip(used, at, strict=True)], pa.binary())})


# ---------------------------------------------------------------- exact counts


def count_terms(rows: DataFrame, sketch: np.ndarray, least: int = MIN_DOCS) -> DataFrame:
    """(lang, source, term, df, n) of all terms that the sketch does not rule out."""
    cells = sketch.shape[1]

    def run(batches):
        for groups, lang, names, terms, doc, term, n, c in lang_terms(batches):
            width = max(1, len(terms))
            hashes = term_hash(terms)
            key, back = np.unique(lang[doc].astype(np.int64) * width + term, return_inverse=True)
            ok = np.ones(len(key), bool)
            for k in range(DEPTH):
                ok &= sketch[k, slots(hashes[key % width], names[key // width], k, cells)] >= least
            own = ok[back]
            doc, term, n = doc[own], term[own], n[own]
            part = groups.take(pa.array(c.rows))
            coded = pa.array([f"{len(x or '')}:{x or ''}{y or ''}" for x, y in zip(part.field(0).to_pylist(), part.field(1).to_pylist(), strict=True)], pa.large_string()).dictionary_encode()
            code = coded.indices.to_numpy().astype(np.int64)
            first = np.unique(code, return_index=True)[1]
            pair, back = np.unique(code[doc] * width + term, return_inverse=True)
            df = np.bincount(back, minlength=len(pair))
            total = np.bincount(back, weights=n, minlength=len(pair)).astype(np.int64)
            group = pa.array(first[pair // width])
            yield pa.RecordBatch.from_arrays([part.field(0).take(group), part.field(1).take(group), terms.take(pa.array(pair % width)).cast(pa.binary()).cast(pa.string()), pa.array(df, pa.int64()), pa.array(total, pa.int64())], ["lang", "source", "term", "df", "n"])

    found = rows.mapInArrow(run, "lang string, source string, term string, df long, n long")
    return found.groupBy("lang", "source", "term").agg(F.sum("df").alias("df"), F.sum("n").alias("n"))


def share(count: str, total: str, terms: str) -> F.Column:
    """p of a count; the product may pass 64 bits, the quotient cannot."""
    return F.expr(f"1 + CAST((CAST({SCALE} AS DECIMAL(10,0)) * CAST({count} + 2 AS DECIMAL(19,0))) div CAST({total} + 2 * {terms} AS DECIMAL(19,0)) AS BIGINT)")


def divergence(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q}) div ({p} + {q}))"


def audit(docs: DataFrame, least: int = MIN_DOCS, top: int = TOP_TERMS, cells: int = SKETCH_CELLS) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank."""
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    occurring = rows.select("lang", "source").distinct()
    sketch = document_sketch(rows, cells, least)
    counts = materialize(count_terms(rows, sketch, least), "divergence-counts")
    kept = materialize(counts.groupBy("lang", "term").agg(F.sum("df").alias("df"), F.sum("n").alias("total")).where(F.col("df") >= least).drop("df"), "divergence-kept")
    held = counts.join(kept, ["lang", "term"])
    totals = held.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("total").alias("whole"))
    groups = occurring.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["size", "terms", "whole"])
    groups = materialize(groups.withColumn("z", F.when(F.col("terms") > 0, share("CAST(0 AS BIGINT)", "size", "terms")).otherwise(F.lit(0))), "divergence-groups")
    placed = held.join(groups, ["lang", "source"])
    placed = materialize(placed.select("lang", "source", "term", "n", "z", share("n", "size", "terms").alias("p"), share("total", "whole", "terms").alias("q")), "divergence-terms")
    drop_table(counts)
    drop_table(kept)

    from_lang = placed.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr(divergence("p", "q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    best = from_lang.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)

    # the three parts of the sum, by (lang, a, b): all terms absent, terms of one, terms of both
    one, other = groups.select("lang", F.col("source").alias("a"), "terms", F.col("z").alias("za")), groups.select("lang", F.col("source").alias("b"), F.col("z").alias("zb"))
    absent = one.join(other, "lang").where("a <> b").select("lang", "a", "b", F.expr(f"CASE WHEN terms > 0 THEN terms * {divergence('za', 'zb')} ELSE 0L END").alias("value"))
    levels = placed.groupBy("lang", F.col("source").alias("a"), F.col("z").alias("za"), "p").agg(F.count("*").alias("k"))
    single = levels.join(other, "lang").where("a <> b").select("lang", "a", "b", F.expr(f"k * ({divergence('p', 'zb')} - {divergence('za', 'zb')})").alias("value")).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    single = single.union(single.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    left, right = placed.select("lang", "term", F.col("source").alias("a"), F.col("p").alias("pa"), F.col("z").alias("za")), placed.select("lang", "term", F.col("source").alias("b"), F.col("p").alias("pb"), F.col("z").alias("zb"))
    correction = f"{divergence('pa', 'pb')} - {divergence('pa', 'zb')} - {divergence('za', 'pb')} + {divergence('za', 'zb')}"
    both = left.join(right, ["lang", "term"]).where("a < b").select("lang", "a", "b", F.expr(correction).alias("value")).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = both.union(both.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    pairs = absent.union(single).union(both).groupBy("lang", F.col("a").alias("source"), F.col("b").alias("item")).agg(F.sum("value").alias("value"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn("rank", F.row_number().over(order))
    return best.union(pairs)


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(read_table(spark, sf_dir, "documents"))
