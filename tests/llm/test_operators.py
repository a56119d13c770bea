"""The training-data operators against brute force, on texts chosen to be awkward."""

import collections
import hashlib
import math
import random
import re
import time
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F

from terracover.llm import bpe, chat, decontaminate, neardup, phrases, pii, quality, sharding, suffixes, tokens
from terracover.llm.common import chunks_of, new_path, prefix_hash, stretch_hash, window_hash, window_hashes, word_bounds, word_hashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LEAST = -(2**63)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, did string, th string, n string, row string, spans string, masked string, stratum string, size string"


def make_texts() -> list:
    r = random.Random(11)
    vocabulary = ["".join(r.choice("abcdeé") for _ in range(r.randint(1, 7))) for _ in range(300)]

    def prose(n):
        return " ".join(r.choice(vocabulary) + r.choice(["", "", "", ".", ",", "\n"]) for _ in range(n))

    base, passage = prose(260), prose(70)
    words = base.split(" ")
    texts = [None, "", "   \n\t ", "word", "two words", "a b c", base, base, base.upper()]
    for k in range(14):  # near copies
        own = list(words)
        for j in r.sample(range(len(own)), k):
            own[j] = "changed"
        texts.append(" ".join(own))
    for _ in range(8):  # a passage inside other prose
        texts.append(prose(r.randint(5, 60)) + " " + passage + " " + prose(r.randint(0, 60)))
    texts += ["Is onhe. " * 90, "Is onhe. " * 70 + "x", "é" * 300, "é" * 120, "x" * 100_000, prose(3000), " nbsp em ﬁ İΣΣ 中文 👍🏽", "<|endoftext|> a <|startoftext|>b </s>[INST]", "\0 \0\0 nul", "tab\tand\r\nlines\n\n\nlines\nlines"]
    texts += [prose(r.randint(1, 120)) for _ in range(25)]
    return texts


TEXTS = make_texts()
DOCS = [(None if k == 5 else 40 if k == 41 else k, t) for k, t in enumerate(TEXTS)] + [(9, TEXTS[9])] * 2


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(d, t, "en" if k % 3 else None, "s", None if t is None else len(t), "x", "y", "z", "r", "s", "m", "q", "v") for k, (d, t) in enumerate(DOCS)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def by_row(rows, *columns):
    return collections.Counter(tuple(r[c] for c in columns) for r in rows)


# ---------------------------------------------------------------- 8 and 2: tokens


def test_bpe_equals_the_library(docs, empty):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.vocabulary_path())
    want = collections.Counter()
    for d, t in DOCS:
        e = library.encode(t or "", add_special_tokens=False)
        want[d, len(e.ids), hashlib.sha256(np.array(e.ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(e.ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    assert by_row(bpe.bpe_digest(docs, bpe.vocabulary_path()).collect(), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want
    assert bpe.bpe_digest(empty, bpe.vocabulary_path()).count() == 0
    out = bpe.bpe_decode(bpe.bpe_encode(docs.where("doc_id = 6"), bpe.vocabulary_path()), bpe.vocabulary_path()).first()
    assert out.decoded == library.decode(library.encode(out.text, add_special_tokens=False).ids, skip_special_tokens=False)


def test_bpe_fuzz_and_cuts():
    from tokenizers import Tokenizer

    own, library, r = bpe.WordBpe(bpe.vocabulary_path()), Tokenizer.from_file(bpe.vocabulary_path()), random.Random(3)
    parts = ["a", "the", "ing", "ß", "Σ", "é", " ", "\u0085", "\x1c", "'s", "'ll", "1", "٣", "½", "中", "😀", "<|endoftext|>", "<|", "aaaa", "\0", "Å", "ǅ", "-", "\n"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 25))) for _ in range(3000)]
    ids, lens = own.encode(texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(lens)[:-1])] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    bytes_of = {s: k for k, s in enumerate(bpe.byte_symbols())}
    for t in own.tokens[:49406:7]:
        raw = [bytes_of[c] for c in t.removesuffix("</w>")]
        assert not any(own.cut[a, b] for a, b in zip(raw, raw[1:], strict=False))


def test_bpe_equals_the_library_on_every_code_point(monkeypatch):
    from tokenizers import Tokenizer

    own, library, r = bpe.WordBpe(bpe.vocabulary_path()), Tokenizer.from_file(bpe.vocabulary_path()), random.Random(9)
    points = [chr(c) for c in range(0x32000) if not 0xD800 <= c < 0xE000]
    texts = [f"a{c}b {c}1{c}" for c in points]
    texts += ["".join(r.choice([" ", "a", "'s", "1", *r.sample(points, 6)]) for _ in range(r.randint(0, 25))) for _ in range(20_000)]
    got = own.encode_each(texts)
    for k in range(0, len(texts), 5000):
        for e, t in zip(library.encode_batch(texts[k : k + 5000], add_special_tokens=False), texts[k : k + 5000], strict=True):
            assert next(got).tolist() == e.ids, [t, *map(hex, map(ord, t))]
    monkeypatch.setattr(bpe, "PIECE_CHARS", 40)  # pieces of long texts
    long = " ".join(texts[70_000:70_300]) + " <|endoftext|>\t" + "x" * 200
    ids = library.encode(long, add_special_tokens=False).ids
    assert [x.tolist() for x in own.encode_each([None, long, "", long])] == [[], ids, [], ids]
    assert own.decode_digest(np.array(ids)) == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_token_file(spark, docs, empty):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokens.vocabulary_path())
    path = new_path(spark, "test")
    tokens.write_tokens(docs, tokens.vocabulary_path(), path, shard_bytes=5000)
    rows = tokens.read_tokens(spark, path, tokens.ids_crc32).collect()
    ids = {id(t): library.encode(t or "", add_special_tokens=False).ids + [2] for _, t in DOCS}
    assert by_row(rows, "doc_id", "n_tokens", "value") == collections.Counter((d, len(ids[id(t)]), zlib.crc32(np.array(ids[id(t)], "<u4").tobytes())) for d, t in DOCS)
    at = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    order = [LEAST if r.doc_id is None else r.doc_id for r in sorted(rows, key=lambda r: r.start)]
    assert order == sorted(order)
    path = new_path(spark, "test")
    tokens.write_tokens(empty, tokens.vocabulary_path(), path)
    assert tokens.read_tokens(spark, path, tokens.ids_crc32).count() == 0


def test_hot_doc_ids_lie_on_several_shards(spark):
    path = new_path(spark, "test")
    df = spark.range(900).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.lit("the same text in all rows").alias("text"))
    tokens.write_tokens(df, tokens.vocabulary_path(), path, shard_bytes=200)
    sizes = [r["count"] for r in spark.read.parquet(f"{path}/data").groupBy("shard").count().collect()]
    assert len(sizes) > 20 and max(sizes) < 150
    rows = sorted(tokens.read_tokens(spark, path, tokens.ids_crc32).collect(), key=lambda r: r.start)
    ids = [LEAST if r.doc_id is None else r.doc_id for r in rows]
    assert ids == sorted(ids) and len(rows) == 900 and [r.start for r in rows] == [k * rows[0].n_tokens for k in range(900)]


def test_token_code_round_trip():
    r = np.random.default_rng(1)
    for n in (0, 1, 3, 4, 5, 1000):
        v = (r.integers(0, 2**32, n) >> r.integers(0, 32, n)).astype(np.uint32)
        assert (tokens.unpack(*tokens.pack(v), n) == v).all()


def test_pieces_equal_the_library():
    r, enc = random.Random(4), tokens.PieceEncoder(tokens.vocabulary_path())
    parts = ["a", "the", "é", " ", " ", "  ", " the", "\n", "\n\n", " ", "　", "\x1f", "'s", "12", "中", "<|endoftext|>", "<|", "\0", ",", ".", "a,", "x.\n", "é.", "\r", "-"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 20))) for _ in range(5000)] + [None]
    at = 0
    want = enc.library([t or "" for t in texts])
    for c in chunks_of(pa.array(texts), 20_000):
        ids, counts = enc.encode(c)
        for own in np.split(ids, np.cumsum(counts)[:-1]):
            assert own.tolist() == want[at], texts[at]
            at += 1


def test_pieces_of_one_hash_and_other_files(monkeypatch):
    """Pieces are known by their bytes: with a hash of two values the ids stay right; without cuts too."""
    enc, r = tokens.PieceEncoder(tokens.vocabulary_path()), random.Random(2)
    texts = [" ".join(r.choice(["alpha", "alphb", "bet", "gamma,", "x"]) for _ in range(9)) for _ in range(200)]
    want = enc.library(texts)
    texts += [" ".join(r.choice(["incomprehensibilities", "incomprehensibilitied", "x" * 30, "x" * 29 + "y"]) for _ in range(9)) for _ in range(50)]
    want = enc.library(texts)
    monkeypatch.setattr(tokens, "mix", lambda x: x % np.uint64(2))
    for cuts in (True, False):
        enc = tokens.PieceEncoder(tokens.vocabulary_path())
        enc.cuts &= cuts
        ids, counts = enc.encode(next(chunks_of(pa.array(texts))))
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == want
    other = tokens.PieceEncoder(bpe.vocabulary_path())
    assert not other.cuts and other.encode(next(chunks_of(pa.array(["Two Words"]))))[0].tolist() == other.library(["Two Words"])[0]


# ---------------------------------------------------------------- 3: near duplicates


def shingles(text, width):
    w = (text or "").encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))).split()
    return frozenset(tuple(w[k : k + width]) for k in range(len(w) - width + 1)) or frozenset([tuple(w)] if w else [])


@pytest.mark.parametrize("width", [4, 5])
def test_near_duplicates(docs, empty, width):
    sets = [shingles(t, width) for _, t in DOCS]
    comp = list(range(len(DOCS)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                comp = [comp[j] if c == comp[i] else c for c in comp]
    want = collections.Counter()
    for k, (d, _) in enumerate(DOCS):
        ids = [DOCS[j][0] for j in range(len(DOCS)) if comp[j] == comp[k] and DOCS[j][0] is not None]
        want[d, len(sets[k]), min(ids) if sets[k] and ids else d] += 1
    rows = neardup.near_duplicates(docs, width).collect()
    assert by_row(rows, "doc_id", "n", "component_id") == want
    kept = neardup.keep_one(docs, width)
    assert kept.columns == docs.columns
    singles = sum(1 for k in set(comp) if sets[k] or comp.count(k) == 1)
    assert kept.count() == len({c if sets[k] else ("empty", DOCS[k]) for k, c in enumerate(comp)}), singles
    assert neardup.near_duplicates(empty, width).count() == 0 and neardup.keep_one(empty, width).count() == 0


def test_words_in_pieces():
    """Words hashed piece by piece are those of the whole bytes, words longer than a piece among them."""
    r = random.Random(5)
    texts = [None, "", "a", " \n", "a b c d"] + [" ".join(r.choice(["x", "Yy", "zé z", "w" * r.randint(1, 50)]) for _ in range(r.randint(0, 60))) for _ in range(100)]
    for c in chunks_of(pa.array(texts), 2000):
        starts, ends = word_bounds(c.buf)
        whole = stretch_hash(prefix_hash(c.buf), starts, ends)
        for piece in (1, 7, 100):
            words, doc = word_hashes(c.buf, c.off, piece)
            assert words.tolist() == whole.tolist() and doc.tolist() == (np.searchsorted(c.off, starts, side="right") - 1).tolist()
            assert window_hashes(words, 5, piece).tolist() == window_hash(words, 5).tolist()


def test_long_text_needs_few_times_its_bytes():
    text = pa.array([" ".join(map(str, range(1_000_000)))])
    tracemalloc.start()
    h, _ = neardup.shingle_sets(next(chunks_of(text)), 5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(h) == 999_996 and peak < 10 * len(text[0].as_py())


def test_blocks_find_every_link(spark, monkeypatch):
    """A group of near copies of near copies, with blocks so small that many pairs of blocks meet."""
    monkeypatch.setattr(neardup, "BLOCK", 3)
    r, texts = random.Random(8), []
    own = [f"w{r.randint(0, 10**6)}" for _ in range(120)]
    for _ in range(60):
        own = list(own)
        for j in r.sample(range(len(own)), 2):
            own[j] = f"w{r.randint(0, 10**6)}"
        texts.append(" ".join(own))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [shingles(t, 4) for t in texts]
    comp = list(range(len(texts)))
    for i in range(len(sets)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                comp = [min(comp[i], comp[j]) if c in (comp[i], comp[j]) else c for c in comp]
    assert [r.component_id for r in neardup.near_duplicates(df, 4).orderBy("doc_id").collect()] == comp


def test_blocks_own_a_pair_by_its_bucket(spark):
    """A band that agrees in the low bytes only comes before the first band that two nodes share."""
    words = [f"w{k}" for k in range(60)]
    texts = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words + ["tail"]))], "node long, text string")
    sig = np.arange(neardup.N_HASH, dtype=np.uint32)
    other = sig.copy()
    other[0] += 256
    nodes = spark.createDataFrame([(1, bytearray(sig.tobytes())), (2, bytearray(other.tobytes()))], "node long, sig binary")
    bands = neardup.band_rows(nodes)
    opened = bands.join(bands.groupBy("bucket").count().where("count = 2"), "bucket").select("bucket", "band", "node", F.col("node").alias("comp"), F.lit(1).cast("long").alias("main"), F.when(F.col("node") == 1, 57).otherwise(58).cast("long").alias("n"))
    assert {r.band for r in opened.collect()} == set(range(1, neardup.BANDS))
    links = neardup.block_links(opened, neardup.compact_sets(texts, nodes, 4), 80)
    assert [tuple(r) for r in links.collect()] == [(1, 2)]


def test_hub_edges_are_not_dealt_by_the_hub(spark):
    """Large-star joins the least neighbours back without a shuffle of all edges by a hub (here by broadcast of a small table)."""
    edges = [(k, 10**6 if k % 2 else k + 1) for k in range(3000)]
    labels = dict(neardup.components(spark.createDataFrame(edges, "u long, v long")).collect())
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for u, v in edges:
        a, b = root(u), root(v)
        parent[max(a, b)] = min(a, b)
    assert labels == {x: root(x) for x in parent if root(x) != x}


def test_stars(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 200 + k) for k in range(50)] + [(7, 7)]
    labels = dict(neardup.components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert labels == {**{k: 0 for k in range(1, 41)}, **{200 + k: 100 for k in range(50)}}


# ---------------------------------------------------------------- 4: shards


def test_shards(docs, empty, spark):
    rows = sharding.shard(docs, range_rows=10).collect()
    assert by_row(rows, "doc_id", "size", "text_crc32") == collections.Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in DOCS)
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 8
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard(empty).count() == 0
    many = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("same text")).otherwise(F.repeat(F.lit("x"), (F.col("id") % 50).cast("int"))).alias("text"))
    sizes = [r.b for r in sharding.shard(many, range_rows=100).groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert len(sizes) == 8 and max(sizes) - min(sizes) <= 2 * 51
    alike = spark.range(4000).select(F.when(F.col("id") % 2 == 0, 7).cast("long").alias("doc_id"), F.lit("same text").alias("text"))
    keys = sharding.materialize(sharding.keyed(alike), "test")
    _, counts = sharding.split_ranges(keys, range_rows=100)
    assert max(c["n"] for c in counts) <= 200 and sum(c["n"] for c in counts) == 4000  # rows that are alike in all are divided too
    slots = collections.defaultdict(list)
    for r in sharding.shard(alike, range_rows=100).collect():
        slots[r.shard].append(r.slot)
    assert len(slots) == 8 and all(sorted(s) == list(range(500)) for s in slots.values())


def test_written_shards(docs, spark):
    path = new_path(spark, "shards")
    distinct = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    sharding.write_shards(distinct, sharding.shard(distinct), path, 8)
    assert spark.read.parquet(path).count() == distinct.count()


# ---------------------------------------------------------------- 5: quality


def brute_metrics(t):
    t = t or ""
    w, seen, dups, lines = WORD.findall(t), set(), 0, 0
    for line in t.split("\n"):
        if WORD.search(line):
            lines += 1
            dups += line in seen
        seen.add(line)
    grams = collections.Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    marked = {k + j for k in range(len(w) - 2) if grams[tuple(w[k : k + 3])] > 1 for j in range(3)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dups, len(marked), lines


def test_metrics(docs, empty):
    rows = quality.document_metrics(docs).collect()
    assert by_row(rows, "doc_id", *quality.METRICS) == collections.Counter((d, *brute_metrics(t)) for d, t in DOCS)
    assert quality.document_metrics(empty).count() == 0


def test_binomial_tail():
    assert abs(quality.binomial_tail(1, 3, 0.5) - 0.5) < 1e-12 and quality.binomial_tail(3, 3, 0.1) == 1.0
    assert abs(quality.binomial_tail(0, 100, 0.02) - 0.98**100) < 1e-12
    for n, p in ((1, 0.3), (40, 0.004), (3000, 0.004), (700, 0.5)):
        total = 0.0
        for k in range(n):
            total += math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p))
            assert abs(quality.binomial_tail(k, n, p) - total) < 1e-9
    assert 0 < quality.binomial_tail(3_990_000, 10**9, 0.004) < 1e-6 < quality.binomial_tail(3_999_000, 10**9, 0.004)


def brute_verdicts(rows, labels):
    """(doc_id, base_failed, kept) of (doc_id, text, lang) rows, by the docstring's rules in plain Python."""
    good = {}
    for d, q in labels:
        if d is not None and q is not None:
            good[d] = min(q, good.get(d, 1))
    scored, held = [], {}
    for d, t, lang in rows:
        w, chars, symbols, dups, repeats, lines = brute_metrics(t)
        part = lambda x, y: x / y if y else -1e300
        scores = {"symbols": part(symbols, w), "dup_lines": part(dups, lines), "long_words": part(chars, w), "short_words": part(-chars, w), "repeats": part(repeats, w)}
        failed = w < 50 or 100 * repeats > 50 * w
        scored.append((d, lang, failed, scores))
        if d in good and not failed:
            held.setdefault(lang, ({}, {}))[good[d]].setdefault(d, []).append(scores)
    sizes = sorted((len(g) for _, g in held.values()), reverse=True)
    able = max((m for m, n in enumerate(sizes, 1) if 0.98**n <= 0.05 / m), default=0)
    least = sizes[able - 1] if able else math.inf
    cutoff = {}
    for lang, (bad, fine) in held.items():
        if len(fine) < least:
            continue
        safe = []
        for step in range(1, quality.STEPS + 1):
            own = {r: cuts[step * len(cuts) // quality.STEPS - 1] for r, (_, cuts) in quality.RULES.items() if step * len(cuts) // quality.STEPS}
            rejects = lambda docs: sum(any(s[r] >= c for s in trial for r, c in own.items()) for trial in docs.values())  # noqa: B023
            k, n, p = rejects(fine), len(fine), 0.02
            tail = sum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)) for i in range(k + 1))
            if tail > 0.05 / able:
                break
            safe.append((rejects(bad), own))
        if safe and bad and not safe[-1][0]:
            continue
        chosen = next((own for k, own in safe if k == safe[-1][0]), {}) if bad else safe[-1][1] if safe else {}
        cutoff |= {(lang, r): c for r, c in chosen.items()}
    return collections.Counter((d, failed, not failed and not any(s[r] >= cutoff.get((lang, r), math.inf) for r in s)) for d, lang, failed, s in scored), cutoff


def test_cutoffs_and_verdicts_by_brute_force(spark):
    r = random.Random(3)

    def text(junk):
        words = ["".join(r.choice("abcdefgh") for _ in range(r.randint(1, 12))) + "#" * (r.random() < junk) for _ in range(r.randint(40, 90))]
        if r.random() < junk:
            words += words[:10] * r.randint(1, 6)
        return "".join(w + r.choice(["\n", " ", " ", " "]) for w in words) + "\nsame line" * (r.randint(0, 9) if r.random() < junk else 0)

    rows = [(k, text(0.01 if k % 9 else 0.6), ["en", "en", "en", "de", None][k % 5 % 4 + (k % 50 == 4)]) for k in range(4500)]
    rows += [rows[0]] * 40 + [(0, text(0.9), "en")] + [(None, text(0.1), "en"), (4, None, "de")]  # repeated rows are one trial
    labels = [(k, int(k % 9 > 0)) for k in range(4400)] + [(1, 0), (3, None), (None, 1), (10**6, 1)]
    want, cutoff = brute_verdicts(rows, labels)
    assert len({lang for lang, _ in cutoff}) >= 2 and any(c != quality.RULES[r][1][-1] for (_, r), c in cutoff.items())
    got = quality.quality_verdicts(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4), spark.createDataFrame(labels, "doc_id long, quality int"))
    assert by_row(got.collect(), "doc_id", "base_failed", "kept") == want


def test_cutoffs_keep_good_documents(spark, docs, empty):
    good = [(k, " ".join(f"w{k}x{j}" for j in range(60)), "en") for k in range(3000)]
    bad = [(10_000 + k, " ".join(f"#w{k}x{j}*" for j in range(60)), "en") for k in range(300)]
    few = [(20_000 + k, " ".join(f"#w{k}x{j}*" for j in range(60)), "de") for k in range(20)]
    df = spark.createDataFrame(good + bad + few, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, 1, 0) for k, _, _ in good] + [(k, 0, 0) for k, _, _ in bad] + [(0, 1, 0), (None, 1, 0), (5, None, 0), (999_999, 1, 1)], "doc_id long, quality int, toxic int")
    verdicts = {r.doc_id: r.kept for r in quality.quality_verdicts(df, labels).collect()}
    assert sum(not verdicts[k] for k, _, _ in good) <= 0.02 * len(good) and not any(verdicts[k] for k, _, _ in bad)
    assert all(verdicts[k] for k, _, _ in few)  # too few labels: no cutoff
    kept = quality.filter_documents(docs, labels)
    assert kept.columns == docs.columns and quality.filter_documents(empty, labels).count() == 0
    assert quality.quality_verdicts(docs, labels.limit(0)).count() == len(DOCS)


def test_cutoffs_have_power_and_keep_their_bound(spark):
    """On the driver's tables: strata with labels enough have cutoffs, which good labels bear out."""
    for sf, least in (("sf0.01", {"en"}), ("sf0.1", {"en", "de", "es", "fr"})):
        docs, labels = (spark.read.parquet(f"/root/testdata/{sf}/{t}.parquet") for t in ("documents", "labels"))
        rows = quality.quality_verdicts(docs, labels).where("NOT base_failed").join(labels.groupBy("doc_id").agg(F.min("quality").alias("quality")), "doc_id")
        by = {(x["stratum"], x["quality"]): (x["n"], x["gone"]) for x in rows.groupBy("stratum", "quality").agg(F.count("*").alias("n"), F.count_if(~F.col("kept")).alias("gone")).collect()}
        assert {s for (s, q), (_, gone) in by.items() if q == 0 and gone} >= least
        assert all(gone <= 0.02 * n for (_, q), (n, gone) in by.items() if q == 1)
        assert all(by[s, 0][1] >= 0.9 * by[s, 0][0] for s in least)


def test_a_rejection_holds_for_its_own_text(spark):
    clean, short = " ".join(f"w{k}" for k in range(60)), "too short"
    rows = [(None, clean, "en"), (None, short, "en"), (7, clean, "en"), (7, short, None), (8, None, "en"), (8, clean, None), (9, short, "de")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(7, 1)], "doc_id long, quality int")
    assert sorted(tuple(map(str, r)) for r in quality.filter_documents(df, labels).collect()) == sorted(tuple(map(str, r)) for r in rows if r[1] == clean)
    assert quality.filter_documents(df.drop("lang"), labels).count() == 3


# ---------------------------------------------------------------- 6: chat


@pytest.mark.parametrize("piece", [2_000_000, 100])
def test_chat(spark, piece):
    r = random.Random(5)
    parts = ["<", "\\", "s>", "/s>", "<s>", "</s>", "[", "INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "\n", "␊", "␀", "␁", "é", " "]
    turns = [(c, k, r.choice(["user", "assistant", "system", None, "odd\nrole<s>"]), None if r.random() < 0.1 else "".join(r.choice(parts) for _ in range(r.randint(0, 9)))) for c in range(40) for k in range(r.randint(1, 9))]
    turns += [(77, k, "assistant", "x" * 50) for k in range(3000)] + [(None, 0, "user", "no id"), (3, 0, "user", "again"), (3, 0, "user", "again")]
    df = spark.createDataFrame([(*t, "e") for t in turns], "conv_id long, turn long, role string, text string, segment string").repartition(4)
    path = new_path(spark, "chat")
    chat.write_chat(df, path, piece)
    written = spark.read.parquet(path)
    rows = {x.conv_id: x for x in chat.chat_digest(written).collect()}
    groups = collections.defaultdict(list)
    for c, k, role, text in turns:
        groups[c].append((k, role or "", text or "", role is not None, text is not None))
    assert set(rows) == set(groups)
    for c, own in groups.items():
        own.sort(key=lambda x: (x[0], x[3], x[1], x[4], x[2]))
        loss = "".join(t for _, role, t, _, _ in own if role == "assistant")
        x = rows[c]
        assert (x.n_turns, x.loss_chars) == (len(own), len(loss))
        assert x.turns_sha256 == hashlib.sha256("".join(f"{role}\n{t}\n" for _, role, t, _, _ in own).encode()).hexdigest()
        assert x.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    per = {r.conv_id: r["count"] for r in written.groupBy("conv_id").count().collect()}
    assert (piece > 100) == (per[77] == 1) and (piece == 100 or written.count() < len(turns) / 5)  # rows are not turns: the marks are
    back = collections.defaultdict(list)
    for r in sorted(chat.read_turns(written).collect(), key=lambda r: (r.seq, r.place)):
        back[r.conv_id].append((r.role, r.text))
    for c, own in groups.items():
        assert back[c] == [(role, t) for _, role, t, _, _ in own]
    for s in written.select("text").collect():
        inside = s.text.split("</s>\n")
        assert inside[-1] == "" and not any(re.search(r"</?s>|\[/?INST\]|<</?SYS>>", x[3:]) or x[:3] != "<s>" for x in inside[:-1])
    assert chat.chat_digest(chat.format_chat(df.limit(0))).count() == 0


# ---------------------------------------------------------------- 7: personal data


FORMS = [("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")), ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")), ("card", re.compile(r"[0-9]([\x20-]?[0-9])+")), ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"))]


def passes(kind, m):
    d = [int(c) for c in m if c.isdigit()]
    if kind == "ip":
        return all(int(x) <= 255 for x in m.split("."))
    if kind == "card":
        return 14 <= len(d) <= 19 and sum(x if k % 2 == 0 else 2 * x - 9 * (x > 4) for k, x in enumerate(d[::-1])) % 10 == 0
    return kind == "email" or 10 <= len(d) <= 15


def base(t):
    return sorted((m.start(), k, m.end(), kind) for k, (kind, form) in enumerate(FORMS) for m in form.finditer(t or "") if passes(kind, m[0]))


def test_base_spans(spark, docs, empty):
    r = random.Random(6)
    parts = ["a@b.c", "@", ".", "a", "-", "+", "1", "23", "4539 1488 0343 6467", "4539148803436467", " ", "10.0.0.1", "256.1.1.1", "000255.1.2.3", "+1 (736) 555-2678", "+49", "é", "😀", "x%y@z-w.q.r+s@t.u", "(", ")", "\n"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 14))) for _ in range(2500)] + ["1" * 50_000, "a." * 20_000, "1.2." * 9000, "a@" + "b." * 9000 + "c"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: [(s.s, s.k, s.e) for s in x.base] for x in pii.all_spans(df).collect()}
    for k, t in enumerate(texts):
        assert got[k] == [x[:3] for x in base(t)], t[:200]
    assert pii.all_spans(docs).count() == len(DOCS) and pii.all_spans(empty).count() == 0
    masked = {x.doc_id: x.text for x in pii.redact(df).collect()}
    assert not any("a@b.c" in t for t in masked.values()) and masked[len(texts) - 1] == "[EMAIL]"
    out = pii.redact(docs)
    assert out.columns == docs.columns and by_row(out.collect(), "doc_id", "text") == collections.Counter(DOCS)


def brute_instances(t):
    """Seeds and unlabelled instances of a text, with their patterns."""
    seeds = base(t)
    token = regex.compile(r"(?<![\p{L}\p{N}])(?<![\p{L}\p{N}][-._/])[\p{L}\p{N}]+(?:[-._/][\p{L}\p{N}]+)*")
    loose = [(m.start(), 4, m.end(), "id") for m in token.finditer(t) if sum(c in "0123456789" for c in m[0]) >= 4]
    loose = [x for x in loose if not any(s < x[2] and x[0] < e for s, _, e, _ in seeds)]
    units = [(m.start(), m.end(), m[0].lower()) for m in regex.finditer(r"[\p{L}\p{N}]+[:=#]?", t)]
    out = []
    for s, k, e, _ in sorted(seeds + loose):
        w = []
        if not any((s2, k2) < (s, k) and e2 > s for s2, k2, e2, _ in seeds):
            before, behind = [u for u in units if u[1] <= s], [u for u in units if u[0] >= e]
            inside = any(a < s < b for a, b, _ in units if b > s)
            if before and not inside:
                w.append("L" + before[-1][2])
                if len(before) > 1:
                    w.append("B" + before[-2][2] + " " + before[-1][2])
            if behind and behind[0][0] > e:
                w.append("R" + behind[0][2])
        out.append((s, k, e, t[s:e], sorted(w)))
    return out, [u[2] for u in units]


def brute_spans(texts):
    """All spans of each text, by the same bootstrapping in plain Python."""
    both = [brute_instances(t or "") for t in texts]
    edges = collections.Counter((w, f) for found, _ in both for *_, f, ws in found for w in ws)
    count = collections.Counter(c + x for _, u in both for c, xs in (("L", u), ("R", u), ("B", [f"{a} {b}" for a, b in zip(u, u[1:], strict=False)])) for x in xs)
    known = {f for found, _ in both for _, k, _, f, _ in found if k < 4}
    for _ in range(pii.ROUNDS):
        hits, support = collections.Counter(), collections.Counter()
        for (w, f), n in edges.items():
            if f in known:
                hits[w] += n
                support[w] += 1
        precise = {w: min(0.99, hits[w] / count[w]) for w in hits if support[w] >= 5 and hits[w] / count[w] >= 0.5}
        miss = collections.defaultdict(lambda: 1.0)
        for w, f in edges:
            if w in precise:
                miss[f] *= 1 - precise[w]
        known |= {f for f, p in miss.items() if 1 - p >= 0.5}
    return [",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e, f, _ in found if k < 4 or f in known) for found, _ in both]


def test_spans_by_brute_force(spark):
    r = random.Random(12)
    labels = ["passport: ", "passport:", "Tel. ", "call (", "ref #", "id=", "see ", "Passport number ", "mail ", "the "]
    values = [lambda: f"u{r.randint(0, 99)}@x.org", lambda: f"+49 30 {r.randint(10**6, 10**7)}", lambda: f"X{r.randint(10**6, 10**7)}-Q", lambda: str(r.randint(1000, 9999)), lambda: "10.0.0.1", lambda: "word", lambda: "AB12-34.567"]
    texts = [" ".join(r.choice(labels) + r.choice(values)() + r.choice(["", ")", " expires", ".", "\n"]) for _ in range(r.randint(0, 12))) for _ in range(400)]
    texts += ["codes: X1234567 Y2345678 Z3456789", "😀 passport:é1234é", "A--B--1234 a/b.1234", None, "", "x" * 100 + " X7654321"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {x.doc_id: x.s for x in pii.all_spans(df).select("doc_id", pii.span_text("spans").alias("s")).collect()}
    want = brute_spans(texts)
    assert "id:" in "".join(want)
    for k, t in enumerate(texts):
        assert got[k] == want[k], t
    redacted = {x.doc_id: x.text for x in pii.redact(df).collect()}
    for k, t in enumerate(texts):
        out, at = "", 0
        for kind, s, e in (x.split(":") for x in want[k].split(",") if x):
            if int(s) >= at:
                out += t[at : int(s)] + f"[{kind.upper()}]"
            at = max(at, int(e))
        assert redacted[k] == (None if t is None else out + t[at:])


def test_patterns_find_unseen_identifiers(spark):
    rows = [(k, f"some prose then passport: +49 30 1234567{k} and more") for k in range(10, 30)]
    rows += [(100, "bring passport:X1234567-Q now"), (101, "part number X1234567 here"), (102, "passport: none")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    spans = {x.doc_id: x.s for x in pii.all_spans(df).select("doc_id", pii.span_text("spans").alias("s")).collect()}
    assert spans[100] == "id:15:25" and spans[101] == "" and spans[102] == "" and spans[10].startswith("phone:")
    assert "[ID]" in pii.redact(df).where("doc_id = 100").first().text


def test_many_matches_in_a_text(spark, monkeypatch):
    """Time is about linear in the matches of a text; patterns joined behind the count give the same spans."""
    def run(n):
        df = spark.createDataFrame([(1, " ".join(f"no {k:07d}" for k in range(n))), (2, " ".join(f"mail a{k}@b.org" for k in range(n // 5)))], "doc_id long, text string")
        begin = time.time()
        rows = {x.doc_id: x.n for x in pii.all_spans(df).select("doc_id", F.size("spans").alias("n")).collect()}
        masked = {x.doc_id: x.text for x in pii.redact(df).collect()}
        assert rows == {1: 0, 2: n // 5} and masked[2] == " ".join(["mail [EMAIL]"] * (n // 5))
        return time.time() - begin

    monkeypatch.setattr(pii, "BROADCAST_PATTERNS", 0)
    run(1000)
    assert run(100_000) < 60


# ---------------------------------------------------------------- 9 and 10: substrings


def removed(units, starts_seen, did, width):
    gone = [False] * len(units)
    for k in range(len(units) - width + 1):
        if starts_seen[tuple(units[k : k + width])] < did:
            gone[k : k + width] = [True] * width
    return gone


def first_ids(split, width):
    seen = {}
    for d, t in DOCS:
        u, did = split(t), LEAST if d is None else d
        for k in range(len(u) - width + 1):
            key = tuple(u[k : k + width])
            seen[key] = min(seen.get(key, 2**63), did)
    return seen


@pytest.mark.parametrize("bucket, chunk", [(200_000, 400_000), (40, 3_000)])
def test_bytes(spark, docs, empty, bucket, chunk):
    """All rows, in one bucket a task, and with so many splitters and pieces that windows lie on both sides of them."""

    def split(t):
        return (t or "").encode()

    seen = first_ids(split, 50)
    verdicts, changed = suffixes.dedup_suffixes(docs, bucket, chunk)
    kept = {(x.did, bytes(x.th)): x for x in changed.collect()}
    rows = {(x.did, bytes(x.th)): x for x in verdicts.collect()}
    assert verdicts.count() == len(DOCS)
    for d, t in DOCS:
        did, raw = LEAST if d is None else d, (t or "").encode()
        th = hashlib.md5(raw).digest()
        gone = removed(raw, seen, did, 50)
        want = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        if rows[did, th].copy:
            assert want == b""
        elif (did, th) in kept:
            x = kept[did, th]
            assert bytes(x.kept) == want and x.n_removed == sum(gone) and x.n_spans == sum(g and not h for g, h in zip(gone, [False, *gone], strict=False)), (d, (t or "")[:80])
        else:
            assert raw == want, (d, (t or "")[:80])
    assert suffixes.dedup_suffixes(empty)[0].count() == 0


def test_multikey_quicksort():
    r = np.random.default_rng(5)
    for n, top in ((0, 3), (1, 3), (500, 2), (3000, 4), (2000, 2**60)):
        keys = r.integers(0, top, (n, 4), dtype=np.uint64)
        assert (suffixes.multikey_quicksort(keys) == np.lexsort(keys.T[::-1])).all()


def test_hot_suffixes_are_divided(spark):
    """One passage in all documents: its suffixes lie in many buckets, none overfull, and are compared across them."""
    passage = " ".join(f"word{k}" for k in range(30))
    df = spark.createDataFrame([(k, f"{k * 7919 % 1000:03d} {passage} {k}") for k in range(1000)], "doc_id long, text string").repartition(4)
    rows = phrases.identified(df).withColumn("uid", F.monotonically_increasing_id()).withColumn("grams", F.lit(None).cast("array<binary>"))
    grams = suffixes.recurring_anchors(rows, 4).groupBy("th").agg(F.collect_list("grams").alias("grams"))
    held = suffixes.materialize(rows.drop("grams").join(grams, "th").select("did", "th", "text", "grams", "uid"), "test")
    n = suffixes.suffix_records(held, np.zeros(0, suffixes.KEY)).count()
    splitters = suffixes.sample_splitters(held, 1000, n, 16)
    sizes = [x["count"] for x in suffixes.suffix_records(held, splitters).groupBy("bucket").count().collect()]
    assert len(sizes) == 16 and max(sizes) < n / 8
    changed = {x.did: x.n_removed for x in suffixes.dedup_suffixes(df, 500)[1].collect()}
    assert 0 not in changed and len(changed) == 999 and min(changed.values()) >= len(passage) + 2


@pytest.mark.parametrize("size", [50_000, 7])
def test_words(spark, docs, empty, monkeypatch, size):
    monkeypatch.setattr(phrases, "SHARD_PHRASES", size)
    monkeypatch.setattr(phrases, "SHARD_BYTES", size * 100)
    def split(t):
        return WORD.findall(t or "")

    seen = first_ids(split, 50)
    verdicts, changed = phrases.dedup_phrases(docs)
    kept = {(x.did, bytes(x.th)): x.kept for x in changed.collect()}
    th = {t or "": hashlib.md5((t or "").encode()).digest() for _, t in DOCS}
    rows = {(x.did, bytes(x.th)): x for x in verdicts.collect()}
    for d, t in DOCS:
        did, w = LEAST if d is None else d, split(t)
        own = rows[did, th[t or ""]]
        want = " ".join(x for x, g in zip(w, removed(w, seen, did, 50), strict=True) if not g)
        assert ("" if own.copy else kept.get((did, own.th), " ".join(w))) == want, (d, (t or "")[:80])
        assert own.n == len(w)
    assert phrases.dedup_phrases(empty)[0].count() == 0


def test_automata_alone_place_the_windows(spark, monkeypatch):
    rows = [(k, " ".join(f"own{k}x{j}" for j in range(20)) + " " + " ".join(f"shared{j}" for j in range(60))) for k in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {x.did: x.n_removed for x in phrases.dedup_phrases(df)[1].collect()} == {1: 60, 2: 60, 3: 60}
    table, own = pa.table({"uid": [5], "did": [1], "text": pa.array([rows[1][1]], pa.large_string())}), [b" ".join(rows[1][1].encode().split()[k : k + 8]) for k in range(73)]
    assert sorted(phrases.windows_in(table, own)["pos"].to_pylist()) == list(range(31))
    assert phrases.windows_in(table, [b"not any of the phrases of the text"]).num_rows == 0
    assert phrases.Automaton(own[:1]).places(b"own1x0 " + rows[1][1].encode()) == [1]


# ---------------------------------------------------------------- 1: decontamination


def test_decontamination(spark, docs, empty):
    filler = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor"
    item = "Yesterday the farmer told Maria that 12 sheep crossed the river in 35 minutes, and Maria then paid 7 euros for the ferry back home to Lisbon."
    same = item.replace("Maria", "Tomas").replace("12", "40").replace("35", "20").replace("Lisbon", "Porto").replace("euros", "dollars")
    mixed = item.replace("told Maria", "told Tomas").replace("and Maria", "and Petra")
    rows = [(1, f"{filler} {item} {filler}"), (2, f"{filler} {item.upper().lower()}"), (3, same), (4, filler), (5, " ".join(item.split()[:8])), (6, None), (7, ""), (8, item), (8, item), (9, mixed)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item_id", F.lit("x"))
    bench = spark.createDataFrame([(10, item), (11, None), (12, ""), (13, "two words"), (14, "seven tokens make one short item here")], "item_id long, text string")
    found = {(x.doc_id, x.item_id): x for x in decontaminate.contaminated(df, bench, agreement=0.95).collect()}
    assert {(1, 10), (3, 10), (8, 10)} <= set(found) and not {4, 5, 6, 7, 9} & {d for d, _ in found}
    assert found[1, 10].same_fillers and not found[3, 10].same_fillers and found[3, 10].slot_agreement == 1.0
    short = spark.createDataFrame([(1, "before it all. seven tokens make one short item here and after")], "doc_id long, text string")
    assert decontaminate.contaminated(short, bench).count() == 1
    assert decontaminate.remove_contaminated(df, bench).where("doc_id in (1, 3, 8)").count() == 0
    assert decontaminate.contaminated(empty, bench).count() == 0 and decontaminate.contaminated(docs, bench.limit(0)).count() == 0
    assert decontaminate.remove_contaminated(docs, bench.limit(0)).columns == docs.columns


def findings(spark, texts, items):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(x.doc_id, x.item_id): x for x in decontaminate.contaminated(df, bench).collect()}


SHEEP = "Yesterday the farmer told Maria that 12 sheep crossed the river in 35 minutes, and Maria then paid 7 euros for the ferry back home to Lisbon."
GOATS = SHEEP.replace("Maria", "Tomas").replace("12", "40").replace("35", "20").replace("Lisbon", "Porto").replace("7", "9")


def test_each_occurrence_is_judged(spark):
    found = findings(spark, [f"{SHEEP} Some words lie between. {GOATS}", SHEEP], [SHEEP, GOATS])
    assert {(0, 0), (0, 1)} <= set(found) and all(found[0, k].same_fillers and found[0, k].coverage == 1.0 for k in (0, 1))


def test_poor_and_short_items_and_excerpts(spark):
    sums = "12 + 30 = 42, 17 + 5 = 22, 81 + 9 = 90, 4 + 4 = 8, 6 + 1 = 7"
    long = " ".join(f"word{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(59))
    texts = [f"here it is: {sums} and more", f"He said Blue whale calf again", f"x y z {' '.join(long.split()[20:50])} x y z", sums.replace("42", "43").replace("90", "91"), " ".join(long.split()[20:35])]
    found = findings(spark, texts, [sums, "blue whale calf", long])
    assert set(found) == {(0, 0), (1, 1), (2, 2)} and found[2, 2].n_matched == 21


def test_verbatim_copies_in_any_case(spark):
    short = "Rivers carry sand and stones down into the sea"
    found = findings(spark, [SHEEP.upper(), f"and {SHEEP.lower()}", f"We read that {short} every year", SHEEP.upper().replace("SHEEP", "GOATS AND COWS")], [SHEEP, short])
    assert set(found) == {(0, 0), (1, 0), (2, 1), (3, 0)} and all(x.same_fillers for x in found.values())
    assert {found[k].coverage for k in [(0, 0), (1, 0), (2, 1)]} == {1.0}


def brute_tokens(t):
    """(token, word, placeholder or not) of a text, from its characters."""
    out, before, place = [], None, 0
    for m in re.finditer(r"[^\x20\t-\r]+", t or ""):
        raw = m.group()
        plain = [k for k, ch in enumerate(raw) if ch.isascii() and ch.isalnum() or not ch.isascii()]
        if not plain:
            continue
        core = raw[plain[0] : plain[-1] + 1]
        capital = "A" <= core[0] <= "Z" or "\xc0" <= core[0] <= "\xde"
        word = "".join(chr(ord(ch) + 32) if "A" <= ch <= "Z" or "\xc0" <= ch <= "\xde" else ch for ch in core)
        opens = before is None or "\n" in t[place : m.start()] or before[-1] in '.!?:;"' or plain[0] > 0
        number = bool(re.fullmatch(r"[0-9.,:/%+$-]+", core)) and any("0" <= ch <= "9" for ch in core)
        if number:
            kind = "NUMBER"
        elif "0" <= core[0] <= "9":
            kind = "QUANTITY"
        elif out and out[-1][0] == "NUMBER" and word in decontaminate.UNITS:
            kind = "UNIT"
        else:
            kind = "NAME" if capital and not opens else None
        out.append((kind or word, word, kind is not None))
        before, place = raw, m.start()
    return out


def brute_windows(tokens, width):
    """place, key of form (None: poor in literals), key of words, and fillers by place in the window."""
    for p in range(len(tokens) - width + 1):
        own = tokens[p : p + width]
        literal = sum(not slot for _, _, slot in own)
        rich = width >= decontaminate.MIN_TOKENS and literal >= min(decontaminate.MIN_LITERAL, (width + 1) // 2)
        yield p, tuple((x, slot) for x, _, slot in own) if rich else None, tuple(w for _, w, _ in own), [(k, w) for k, (_, w, slot) in enumerate(own) if slot]


def brute_finding(doc, item):
    """The best occurrence of an item in a text, or None."""
    size = min(len(item), decontaminate.WINDOW)
    if not size:
        return None
    own, theirs = list(brute_windows(item, size)), list(brute_windows(doc, size))
    rich = sum(form is not None for _, form, _, _ in own)
    total = rich or len(own)
    hits = []
    for pos, form, words, fill in own:
        equal = [at for at, _, w, _ in theirs if w == words]
        equal = equal[:1] if size < decontaminate.WINDOW else equal  # the same whole item again says nothing new
        for at, f, _, fill_d in theirs:
            if at in equal or form is not None and f == form:
                pairs = tuple((a, a if at in equal else b) for (_, a), (_, b) in zip(fill, fill if at in equal else fill_d))
                hits.append((pos, at, form is not None or not rich, pairs))
    groups, near, last = collections.defaultdict(list), 0, None
    seen = set()
    for pos, at, counted, pairs in sorted(hits, key=lambda h: h[1]):
        if (pos, pairs) not in seen:
            groups["text", 0].append((pos, counted, pairs))
        seen.add((pos, pairs))
    by_shift = collections.defaultdict(list)
    for pos, at, counted, pairs in hits:
        by_shift[at - pos].append((pos, counted, pairs))
    for shift in sorted(by_shift):
        near += last is not None and shift - last > max(decontaminate.GAP, total // 2)
        last = shift
        groups["near", near] += by_shift[shift]
        groups["shift", shift] += by_shift[shift]
        run = []
        for hit in sorted(by_shift[shift]) + [(10**9, False, ())]:
            if run and hit[0] != run[-1][0] + 1:
                if len(run) >= decontaminate.EXCERPT:
                    groups["excerpt", shift, run[0][0]] = run
                run = []
            run.append(hit)
    best = None
    for (kind, *_), rows in groups.items():
        matched = len({pos for pos, counted, _ in rows if counted})
        if matched / total < decontaminate.COVERAGE and kind != "excerpt":
            continue
        slots = collections.defaultdict(collections.Counter)
        for _, _, pairs in rows:
            for a, b in pairs:
                slots[a][b] += 1
        count = sum(sum(c.values()) for c in slots.values())
        agreement = sum(max(c.values()) for c in slots.values()) / count if count else 1.0
        if agreement >= decontaminate.AGREEMENT:
            best = max(best or (-1,), (matched, all(set(c) == {a} for a, c in slots.items()), round(agreement, 9)))
    return best and (best[0], total, *best[1:])


def test_decontamination_by_brute_force(spark):
    r = random.Random(11)
    plain = "river stone market bread carries under seven against ÉTUDE paid the of and with slowly km red".split()
    slots = ["12", "3.5", "40%", "7kg", "15 km", "9 minutes", "Maria", "Tomas", "Lisbon,", "Élan"]

    def some(n, poor=0.25):
        return [r.choice(slots) if r.random() < poor else r.choice(plain) + r.choice(["", "", "", ",", ".", "\n"]) for _ in range(n)]

    items = [" ".join(some(n, poor)) for n, poor in [(1, 0), (3, 0.3), (5, 0), (7, 0.2), (10, 0.2), (11, 0.9), (14, 0.3), (20, 0.2), (30, 0.8), (45, 0.1), (60, 0.3)]]
    items += [items[6], "", None, "-- ..."]
    texts = [None, "", "?", *items[:11]]
    for _ in range(110):
        parts = some(r.randrange(12))
        for _ in range(r.randrange(1, 4)):
            words = r.choice(items[:11]).split(" ")
            a = r.randrange(len(words))
            words = words if r.random() < 0.5 else words[a : a + r.randrange(1, 40)]
            change = {s: r.choice(slots) for s in slots}
            how = r.random()
            if how < 0.35:
                words = [change.get(w, w) for w in words]
            elif how < 0.5:
                words = [r.choice(slots) if w in slots else w for w in words]
            elif how < 0.6:
                words = [w.upper() for w in words]
            elif how < 0.7:
                words.insert(r.randrange(len(words) + 1), "new")
            parts += words + some(r.randrange(8))
        texts.append(" ".join(parts))
    rows = [(None if k % 40 == 39 else k, t) for k, t in enumerate(texts)]
    rows += rows[::9]
    got = decontaminate.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()
    shown = collections.Counter((x.doc_id, x.item_id, x.n_matched, x.n_windows, x.same_fillers, round(x.slot_agreement, 9)) for x in got)
    wanted = collections.Counter()
    tokens = [brute_tokens(t) for t in items]
    for did, t in set(rows):
        doc = brute_tokens(t)
        for k, item in enumerate(tokens):
            found = brute_finding(doc, item)
            if found:
                wanted[(did, k, *found)] += 1
    assert shown == wanted
    assert len(wanted) > 150 and len({k for _, k, *_ in wanted}) == 12 and any(not x[4] for x in wanted) and any(x[2] < x[3] for x in wanted)
