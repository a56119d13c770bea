"""Quality rules with risk-controlled thresholds (operator 5).

Every rule rejects a document whose score reaches a cutoff. Cutoffs are chosen for each stratum (the
document's language) from labelled good documents held out for that purpose, for all rules together: STEPS
vectors of cutoffs, fixed beforehand and each stricter than the last, are tested from the mildest on. A vector
is safe if an exact binomial test rules out, at the corrected level, that the rules together reject more than
FALSE_REJECTION of the good documents of the stratum; testing stops at the first that is not (fixed-sequence
testing, so all vectors before it are safe at once). Of the safe ones the mildest is taken that rejects as many
labelled bad documents as the strictest does (the strictest, if there are no bad labels). The level is divided
over those strata that have labels enough to pass at all (Bonferroni; how many labels there are says
nothing about scores). With confidence 1 - CONFIDENCE_LOSS all strata together, the rules reject at most
FALSE_REJECTION of the good documents of every stratum that the base rule leaves. A stratum with too few
labels gets no cutoffs (149 good ones suffice for one stratum, 217 for four). The base rule has no such
bound: it rejects good documents that are short or repeat themselves.

Defined results: null text has no words (and fails the base rule); a null stratum is a stratum; a
document labelled twice is good only if every label says so; rows that repeat a doc_id are one trial of
their stratum; labels of absent documents, null labels and extra columns are ignored; an empty table
gives no rows. A text of more than twice CHUNK_BYTES is taken in pieces that end behind a space (a longer word makes a
longer piece); a worker holds its bytes and two hashes a word.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import BASE, BASE_INV, CHUNK_BYTES, SPACE, U64, Chunk, chunks_of, doc_of, materialize, mix, prefix_hash, read_table, stretch_hash, window_hash, window_hashes, word_bounds
from .phrases import LEAST_ID, keyed_rows

FALSE_REJECTION = 0.02
CONFIDENCE_LOSS = 0.05
MIN_WORDS = 50
STEPS = 12
#: Cutoff tables of up to so many strata are broadcast; beyond that Spark chooses the join.
BROADCAST_STRATA = 10_000

METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
METRICS_DDL = "doc_id long, stratum string, th binary, " + ", ".join(f"{m} long" for m in METRICS)

#: Score expression and cutoffs of each rule, from the mildest to the strictest (a score >= cutoff is rejected).
RULES: dict[str, tuple[str, list[float]]] = {
    "symbols": ("n_symbols / n_words", [3.0, 2.0, 1.5, 1.0, 0.75, 0.5, 0.35, 0.25, 0.15, 0.1, 0.06, 0.04]),
    "dup_lines": ("n_dup_lines / n_lines", [0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2]),
    "long_words": ("word_chars / n_words", [40.0, 30.0, 25.0, 20.0, 17.0, 15.0, 13.0, 12.0, 11.0, 10.0]),
    "short_words": ("-word_chars / n_words", [-1.2, -1.5, -1.8, -2.0, -2.3, -2.6, -3.0, -3.3]),
    "repeats": ("n_repeat_words / n_words", [0.5, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1]),
}
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def metrics_of(chunk: Chunk) -> dict[str, np.ndarray]:
    """The metrics of every document of a chunk."""
    buf, off, n = chunk.buf, chunk.off, chunk.n
    space = SPACE[buf]

    def per_doc(flags: np.ndarray) -> np.ndarray:
        total = np.zeros(len(buf) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return total[off[1:]] - total[off[:-1]]

    starts, ends = word_bounds(buf)
    doc = doc_of(starts, off)
    out = {"n_words": np.bincount(doc, minlength=n), "word_chars": per_doc(~space & ((buf & 0xC0) != 0x80)), "n_symbols": per_doc(_SYMBOL[buf])}
    prefix = prefix_hash(buf)
    # lines with a word, equal to an earlier line
    line_end = np.flatnonzero(buf == 10)
    line_start = np.concatenate(([0], line_end[:-1] + 1)) if len(line_end) else line_end
    has = np.searchsorted(starts, line_end) > np.searchsorted(starts, line_start)
    line_start, line_end = line_start[has], line_end[has]
    line_doc = doc_of(line_start, off)
    key = _in_doc(stretch_hash(prefix, line_start, line_end), line_doc)
    order = np.argsort(key, kind="stable")
    again = np.flatnonzero(key[order][1:] == key[order][:-1]) + 1
    out["n_dup_lines"] = np.bincount(line_doc[order[again]], minlength=n)
    out["n_lines"] = np.bincount(line_doc, minlength=n)
    # words inside 3-word windows that the text holds twice or more
    marked = np.zeros(len(starts), bool)
    if len(starts) >= 3:
        window = window_hash(stretch_hash(prefix, starts, ends), 3)
        own = np.flatnonzero(doc[2:] == doc[:-2])
        key = _in_doc(window[own], doc[own])
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(own), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        for k in range(3):
            marked[own[twice] + k] = True
    out["n_repeat_words"] = np.bincount(doc[marked], minlength=n)
    return out


def long_metrics(c: Chunk, piece: int = 500_000) -> dict[str, np.ndarray]:
    """metrics_of() one long text, in pieces that end behind a space."""
    space, ring = SPACE[c.buf], 1 << 64
    n_words = word_chars = n_symbols = at = 0
    words, lines = [np.zeros(0, U64)], [np.zeros(0, U64)]
    raw, length, filled = 0, 0, False  # of the line that goes on: sum of its codes, bytes, whether it has a word
    while at < len(c.buf):
        to = min(at + piece, len(c.buf))
        to += int(space[to - 1 :].argmax())  # a chunk ends with a newline
        own = c.buf[at:to]
        starts, ends = word_bounds(own)
        prefix = prefix_hash(own)
        words.append(stretch_hash(prefix, starts, ends))
        n_words += len(starts)
        word_chars += int((~space[at:to] & ((own & 0xC0) != 0x80)).sum())
        n_symbols += int(_SYMBOL[own].sum())
        line_end, rest = np.flatnonzero(own == 10), 0
        if len(line_end):
            line_start = np.concatenate(([0], line_end[:-1] + 1))
            has = np.searchsorted(starts, line_end) > np.searchsorted(starts, line_start)
            key = stretch_hash(prefix, line_start, line_end)
            if length:
                whole = raw + pow(BASE, length, ring) * int(prefix[line_end[0]]) + (length + int(line_end[0])) * 0x9E3779B97F4A7C15
                key[0] = mix(np.array([whole % ring], U64))[0]
                has[0] |= filled
            lines.append(key[has])
            rest, raw, length, filled = int(line_end[-1]) + 1, 0, 0, False
        left = (int(prefix[-1]) - int(prefix[rest])) * pow(BASE_INV, rest, ring)
        raw = (raw + pow(BASE, length, ring) * left) % ring
        length += len(own) - rest
        filled |= bool(len(starts)) and int(starts[-1]) >= rest
        at = to
    line = np.concatenate(lines)
    window = window_hashes(np.concatenate(words), 3)
    del words, lines
    again = np.sort(window)
    again = np.unique(again[1:][again[1:] == again[:-1]])
    marked = np.zeros(n_words, bool)
    for a in range(0, len(window) if len(again) else 0, piece):
        own = window[a : a + piece]
        hit = a + np.flatnonzero(again[np.minimum(np.searchsorted(again, own), len(again) - 1)] == own)
        for k in range(3):
            marked[hit + k] = True
    found = (n_words, word_chars, n_symbols, len(line) - len(np.unique(line)), int(marked.sum()), len(line))
    return {m: np.array([x]) for m, x in zip(METRICS, found, strict=True)}


def _in_doc(key: np.ndarray, doc: np.ndarray) -> np.ndarray:
    return mix(key + doc.astype(U64) * U64(0xD6E8FEB86659FD93))


def document_metrics(docs: DataFrame, stratum: str = "lang") -> DataFrame:
    """doc_id, stratum, th (a key of the text) and METRICS of every whole text."""

    def run(batches):
        for b in batches:
            for c in chunks_of(b.column(3)):
                m = metrics_of(c) if c.n > 1 or len(c.buf) <= 2 * CHUNK_BYTES else long_metrics(c)
                at, n = int(c.rows[0]), c.n
                yield pa.RecordBatch.from_arrays([*(b.column(k).slice(at, n) for k in range(3)), *(pa.array(m[k], pa.int64()) for k in METRICS)], ["doc_id", "stratum", "th", *METRICS])

    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long"), stratum_of(docs, stratum).alias("stratum"), F.unhex(F.md5(F.coalesce(text, F.lit("")))).alias("th"), text).mapInArrow(run, METRICS_DDL)


def stratum_of(docs: DataFrame, stratum: str = "lang", prefix: str = "") -> Column:
    return F.col(f"{prefix}{stratum}").cast("string") if stratum in docs.columns else F.lit(None).cast("string")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def score(rule: str) -> Column:
    """A rule's score; a document without words or lines scores lowest."""
    return F.coalesce(F.expr(f"try_divide({RULES[rule][0].replace(' / ', ', ')})"), F.lit(-1e300))


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial(n, p): the regularised incomplete beta function I(1 - p; n - k, k + 1), by continued fraction."""
    if k >= n:
        return 1.0
    if k < 0:
        return 0.0
    a, b, x = n - k, k + 1, 1.0 - p
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(p))
    if x < (a + 1) / (a + b + 2):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, p) / b


def _beta_fraction(a: int, b: int, x: float) -> float:
    """The continued fraction of the incomplete beta function, by the modified Lentz method."""
    tiny = 1e-300
    c, d = 1.0, 1.0 / (1.0 - (a + b) * x / (a + 1) or tiny)
    out = d
    for m in range(1, 100_000):
        for top in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 / (1.0 + top * d or tiny)
            c = 1.0 + top / c or tiny
            out *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return out


def cutoffs_at(step: int) -> dict[str, int]:
    """How many of its cutoffs each rule has gone through at a step of the path."""
    return {r: step * len(cuts) // STEPS for r, (_, cuts) in RULES.items()}


def first_step(rule: str) -> Column:
    """The first step of the path at which a rule rejects a document, STEPS + 1 if none does."""
    cuts = RULES[rule][1]
    first = [next(s for s in range(1, STEPS + 1) if cutoffs_at(s)[rule] > k) for k in range(len(cuts))]
    return F.coalesce(*(F.when(score(rule) >= c, F.lit(s)) for c, s in zip(cuts, first, strict=True)), F.lit(STEPS + 1))


def fit_cutoffs(metrics: DataFrame, labels: DataFrame, false_rejection: float = FALSE_REJECTION, loss: float = CONFIDENCE_LOSS) -> DataFrame:
    """stratum and one cutoff column per rule (null: the rule stays off in that stratum)."""
    judged = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int").alias("quality")).where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    held = metrics.where(~base_failed()).join(judged, "doc_id")
    # rows that repeat an id are one trial, rejected where any of them is
    trials = held.groupBy("stratum", "doc_id", "quality").agg(F.min(F.least(*(first_step(r) for r in RULES))).alias("step"))
    counts = materialize(trials.groupBy("stratum", (F.col("quality") == 1).alias("good"), "step").agg(F.count("*").alias("n")), "quality-counts")
    # the most strata of which each could pass with no rejection at the level divided by their number
    sizes = counts.where("good").groupBy("stratum").agg(F.sum("n").alias("n"))
    ranked = sizes.withColumn("m", F.row_number().over(Window.orderBy(F.desc("n"), "stratum")))  # a row a stratum
    able = F.pow(F.lit(1.0 - false_rejection), F.col("n")) <= F.lit(loss) / F.col("m")
    n_able = ranked.where(able).agg(F.max("m")).first()[0] or 0
    able = ranked.where(F.col("m") <= n_able).select(F.col("stratum").alias("_s"))
    level = loss / max(1, n_able)

    def choose(pdf):
        import pandas as pd

        good, bad = (pdf[pdf["good"] == g].groupby("step")["n"].sum().reindex(range(1, STEPS + 2), fill_value=0).cumsum() for g in (True, False))
        n, safe = int(good.iloc[-1]), 0
        while safe < STEPS and binomial_tail(int(good[safe + 1]), n, false_rejection) <= level:
            safe += 1
        if safe and bad.iloc[-1]:
            safe = next((s for s in range(1, safe + 1) if bad[s] == bad[safe]), safe) if bad[safe] else 0
        gone = cutoffs_at(safe)
        return pd.DataFrame({"stratum": [pdf["stratum"].iloc[0]]} | {r: [cuts[gone[r] - 1] if gone[r] else None] for r, (_, cuts) in RULES.items()})

    own = counts.join(able, F.col("stratum").eqNullSafe(F.col("_s")), "left_semi")
    return own.groupBy("stratum").applyInPandas(choose, "stratum string, " + ", ".join(f"{r} double" for r in RULES))


def apply_cutoffs(metrics: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """metrics with base_failed and kept."""
    cutoffs = cutoffs.select(F.col("stratum").alias("_stratum"), *(F.col(r).alias(f"_{r}") for r in RULES))
    if cutoffs.limit(BROADCAST_STRATA + 1).count() <= BROADCAST_STRATA:
        cutoffs = F.broadcast(cutoffs)
    rows = metrics.join(cutoffs, F.col("stratum").eqNullSafe(F.col("_stratum")), "left")
    rejected = F.lit(False)
    for r in RULES:
        rejected = rejected | F.coalesce(score(r) >= F.col(f"_{r}"), F.lit(False))
    rows = rows.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & ~rejected)
    return rows.drop("_stratum", *(f"_{r}" for r in RULES))


def quality_verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    metrics = materialize(document_metrics(docs), "quality-metrics")
    cutoffs = materialize(fit_cutoffs(metrics, labels), "quality-cutoffs")
    return apply_cutoffs(metrics, cutoffs)


def filter_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that the rules keep, with the columns of docs; each row is judged by its own text and stratum."""
    rejected = quality_verdicts(docs, labels).where(~F.col("kept")).select(F.coalesce("doc_id", F.lit(LEAST_ID)).alias("did"), "th", F.col("stratum").alias("_stratum")).distinct()
    rows = keyed_rows(docs).withColumn("stratum", stratum_of(docs, prefix="row."))
    same = (rows["did"] == rejected["did"]) & (rows["th"] == rejected["th"]) & rows["stratum"].eqNullSafe(rejected["_stratum"])
    return rows.join(rejected, same, "left_anti").select("row.*")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = quality_verdicts(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return verdicts.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "stratum", "n_lines")
