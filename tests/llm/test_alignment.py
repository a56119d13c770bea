"""Cross-tokenizer alignment against both libraries and brute force, on awkward texts."""

import collections
import hashlib
import random

import numpy as np
import pytest

from terracover.llm import align
from terracover.llm.bpe import byte_symbols
from terracover.llm.common import chunks_of
from terracover.llm.tokens import vocabulary_path

A, B = vocabulary_path(), vocabulary_path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, n_a long, pairs string, r string"


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def tokens(text, libraries):
    """[(id, bytes)] of both tokenizers, or nothing."""
    a, b = libraries
    if not text:
        return [], []
    as_byte = {s: k for k, s in enumerate(byte_symbols())}
    left = [(i, bytes(as_byte[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    right = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
    want = (" " + text).encode()
    return (left, right) if b"".join(x for _, x in left) == want == b"".join(x for _, x in right) else ([], [])


def brute(texts, libraries):
    """For each text: n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    found, held = [], collections.Counter()
    for text in texts:
        left, right = tokens(text, libraries)
        ends = [list(np.cumsum([len(x) for _, x in side])) for side in (left, right)]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups, begin = [], 0
        for cut in cuts:
            groups.append([[i for (i, _), e in zip(side, own, strict=True) if begin < e <= cut] for side, own in zip((left, right), ends, strict=True)])
            begin = cut
        links = collections.Counter((x, y) for p, q in groups for x in p for y in q)
        held.update(set(links))
        line = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        found.append((len(left), len(right), len(groups), links, hashlib.sha256(line.encode()).hexdigest() if groups else ""))
    most = collections.Counter()
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    return [(a, b, g, sum(links.values()), sum(m for p, m in links.items() if held[p] == most[p[0]]), sum(m * held[p] for p, m in links.items()), sha) for a, b, g, links, sha in found], held, most


def awkward():
    r = random.Random(5)
    bits = ["a", "word", " ", "  ", "\n", "\t", "é", "é", "中文", "👍🏽", "▁", "▁ x", "<0x41>", "<|endoftext|>", "<s>", "</s>", "ﬁ", "\0", "'s", "12345", "...", "“q”", " ", "İ", "ह", " ", "-", "<unk>"]
    texts = [None, "", " ", "  ", "x", " x", "x ", "a  b", "▁a", "a▁ b", "a \n b", "<|endoftext|> b", "é" * 90, "ab" * 300, "x" * 5000, "中" * 200]
    texts += ["".join(r.choice(bits) for _ in range(r.randint(1, 40))) for _ in range(400)]
    texts += [" ".join(r.choice(["the", "cat", "Über", "straße", "n'est", "3.14", "sat,", "on."]) for _ in range(r.randint(1, 60))) for _ in range(60)]
    return texts + texts[-5:]


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("most", [align.HOT_PAIRS, 40, 0])
def test_equal_to_brute_force(spark, libraries, most):
    texts = awkward()
    rows = [(None if k % 97 == 3 else k // 2, t, 1, "x", "y") for k, t in enumerate(texts)]
    out, pairs = align.cross_alignment(spark.createDataFrame(rows, SCHEMA).repartition(5), A, B, most)
    want, held, top = brute(texts, libraries)
    got = collections.Counter((x["doc_id"], *(x[c] for c in COLUMNS)) for x in out.collect())
    assert got == collections.Counter((d[0], *w) for d, w in zip(rows, want, strict=True))
    assert {((x["a"], x["b"]), x["n"], x["best"]) for x in pairs.collect()} == {(p, n, n == top[p[0]]) for p, n in held.items()}


def test_empty_table(spark):
    out, pairs = align.cross_alignment(spark.createDataFrame([], SCHEMA), A, B)
    assert out.count() == 0 and pairs.count() == 0
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_a_long_text_in_pieces_equals_the_whole(libraries, monkeypatch):
    import pyarrow as pa

    r = random.Random(3)
    text = " ".join(r.choice(["plain", "words", "é", "two  spaces", "a\nline", "中文", "end."]) for _ in range(3000))
    own = align.Aligner(A, B)
    for value in (text, "x" * 30_000, "▁ " + text):
        chunk = next(iter(chunks_of(pa.array([value]))))
        parts = list(align.pieces_of(chunk, 500))
        assert len(parts) > 3 or " " not in value
        joined, whole = align._joined([own.align(p) for p in parts]), own.align(chunk)
        assert joined.lines == whole.lines and joined.good.tolist() == whole.good.tolist()
        assert np.array_equal(joined.pairs[0], whole.pairs[0]) and np.array_equal(joined.times[0], whole.times[0])
        assert [x.tolist() for x in (joined.n_a, joined.n_groups, joined.n_links)] == [(x * whole.good).tolist() for x in (whole.n_a, whole.n_groups, whole.n_links)]


def test_wide_groups_are_paired_by_distinct_ids(monkeypatch):
    import pyarrow as pa

    chunk = next(iter(chunks_of(pa.array(["ab " * 50, "中文👍🏽é" * 40, "word"]))))
    own = align.Aligner(A, B)
    usual = own.align(chunk)
    monkeypatch.setattr(align, "WIDE", 1)
    other = own.align(chunk)
    assert all(np.array_equal(x, y) for x, y in zip(usual.pairs + usual.times, other.pairs + other.times, strict=True))


def test_driver_table(spark, libraries):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    want, _, _ = brute([x["text"] for x in rows], libraries)
    got = {x["doc_id"]: tuple(x[c] for c in COLUMNS) for x in align.op13_align(spark, "/root/testdata/sf0.001").collect()}
    assert got == {x["doc_id"]: w for x, w in zip(rows, want, strict=True)}
