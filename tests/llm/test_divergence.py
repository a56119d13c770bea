"""The divergence audit against brute force."""

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from terracover.llm import divergence
from terracover.llm.common import chunks_of

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, term string, n long, size string, df long"


def lowered(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


def brute(rows, least, top):
    rows = [(lang or "", source or "", TERM.findall(lowered(text))) for text, lang, source in rows]
    out = collections.Counter()
    for lang in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == lang]
        df = collections.Counter(t for _, _, terms in own for t in set(terms))
        kept = sorted(t for t, n in df.items() if n >= least)
        count = {s: collections.Counter(t for _, x, terms in own if x == s for t in terms if df[t] >= least) for s in {r[1] for r in own}}
        whole = collections.Counter(t for _, _, terms in own for t in terms if df[t] >= least)
        p = lambda c, t: 1 + 1_000_000_000 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept))  # noqa: B023, E731
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s, c in count.items():
            pairs = [(sum(f(p(c, t), p(d, t)) for t in kept), x) for x, d in count.items() if x != s]
            terms = [(f(p(c, t), p(whole, t)), t) for t in kept if c[t] and p(c, t) > p(whole, t)]
            for part, found in (("pair", pairs), ("term", terms)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))
                out.update((lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(ranked[: None if part == "pair" else top]))
    return out


def awkward():
    r = random.Random(2)
    words = ["the", "The", "été", "ÉTÉ", "naïve", "x", "中文", "a1b", "it's", "don-t", "[tag]", "ß", "Z", "é́", "co_op", " ", "👍"]
    rows = [(None, "en", "s0"), ("", "en", "s1"), ("123 ...", "xx", None), (None, None, None), ("word", "xx", "q"), ("a\0b \x7f c", "en", "s2")]
    for k in range(260):
        own = words + [f"only{'abcdefg'[k % 7]}"] * 3 + ["rare" + "".join(r.choice("pqr") for _ in range(4))]
        rows.append((" ".join(r.choice(own) for _ in range(r.randint(1, 40))), r.choice(["en", "en", "fr", None, ""]), r.choice(["s0", "s0", "s1", "s2", "été", None])))
    return rows + rows[-9:]


@pytest.mark.parametrize(("least", "cells"), [(10, divergence.SKETCH_CELLS), (10, 64), (1, 1 << 16), (10**6, 1 << 12)])
def test_equal_to_brute_force(spark, least, cells):
    rows = awkward()
    docs = spark.createDataFrame([(k, *x, "t", 1, "s", 2) for k, x in enumerate(rows)], SCHEMA).repartition(5)
    least = min(least, 250)
    got = collections.Counter((x["lang"], x["source"], x["part"], x["item"], x["value"], x["rank"]) for x in divergence.audit(docs, least, 10, cells).collect())
    assert got == brute(rows, least, 10)


def test_sketch_never_underestimates(spark):
    rows = [(t, lang or "", "") for t, lang, _ in awkward()]
    docs = spark.createDataFrame(rows, "text string, lang string, source string").selectExpr("lang", "source", "coalesce(text, '') text").repartition(7)
    df = collections.Counter((lang, t) for text, lang, _ in rows for t in set(TERM.findall(lowered(text))))
    for cells in (16, 1 << 12):
        sketch = divergence.document_sketch(docs, cells)
        keys = list(df)
        h = divergence.term_hash(pa.array([t.encode() for _, t in keys], pa.large_binary()))
        g = np.concatenate([divergence.mix(divergence.term_hash(pa.array([lang.encode()], pa.large_binary()))) for lang, _ in keys])
        found = np.min([sketch[k, divergence.slots(h, g, k, cells)] for k in range(divergence.DEPTH)], axis=0)
        assert all(f >= min(df[x], divergence.MIN_DOCS) for x, f in zip(keys, found.tolist(), strict=True))


def test_large_counts_stay_exact(spark):
    row = spark.range(1).selectExpr("CAST(4000000000000000000 AS BIGINT) n", "CAST(4500000000000000000 AS BIGINT) size", "CAST(1000000000 AS BIGINT) terms")
    assert row.select(divergence.share("n", "size", "terms").alias("p")).first()["p"] == 1 + 10**9 * (4 * 10**18 + 2) // (45 * 10**17 + 2 * 10**9)


def test_a_long_text_in_pieces_equals_the_whole(monkeypatch):
    r = random.Random(1)
    text = " ".join(r.choice(["One", "two", "été", "x" * 50, "…"]) for _ in range(5000))
    chunk = next(iter(chunks_of(pa.array([text]))))
    whole = dict(zip(*(lambda t, _, k, n: (t.take(pa.array(k)).to_pylist(), n.tolist()))(*divergence.terms_of(chunk)), strict=True))
    monkeypatch.setattr(divergence, "PIECE", 400)
    parts = dict(zip(*(lambda t, _, k, n: (t.take(pa.array(k)).to_pylist(), n.tolist()))(*divergence.terms_of(chunk)), strict=True))
    assert whole == parts == {k.encode(): n for k, n in collections.Counter(TERM.findall(lowered(text))).items()}


def test_empty_table(spark):
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).count() == 0
