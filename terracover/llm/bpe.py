"""BPE encoding and decoding with forced boundaries (operator 8).

Method: two byte symbols that stand side by side inside no vocabulary token can never be merged into
one token, so every such pair in a word marks a certain cut. Words are cut there, the fragments are
encoded independently (all fragments of a chunk at once, merge by merge, in numpy), and their ids are
concatenated. Only the last fragment of a word carries the word end.

Words come from the normaliser and the pre-tokenizer of the vocabulary file itself, run by the tokenizers
library on runs without ASCII white space (no word and no composed letter reaches over such white
space), so every code point is classed as the library classes it. A worker remembers the ids of runs.

Defined results: null or empty text gives no ids and the empty string; the strings of the special
tokens inside a text become their ids; repeated rows and equal doc_ids are encoded each, in their own
row; an empty table gives no rows; other columns pass through. A very long text is encoded in pieces of
PIECE_CHARS, cut at white space, so memory is bounded by the batch of texts, its ids, and about 100 bytes
for each byte of its longest run without white space.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import U64, mix, ragged, read_table

#: Distinct runs whose ids a worker keeps between batches; at the limit it forgets them all.
RUN_MEMORY = 400_000
#: Runs that go to the pre-tokenizer in one call.
RUNS_AT_ONCE = 2_000
PIECE_CHARS = 1_000_000
TEXTS_AT_ONCE = 400


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself if printable, else 256, 257, ..."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return [chr(b) if b in set(shown) else chr(256 + rest.index(b)) for b in range(256)]


class WordBpe:
    """The vocabulary of one tokenizer file as numpy tables; built once per Python worker."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        library = Tokenizer.from_file(path)
        self.normalize, self.pre_tokenize = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        plain = "".join(map(chr, range(33, 127)))
        if self.normalize(plain) != plain.lower():
            raise ValueError("the file's normaliser does more to ASCII letters than to lower-case them")
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.suffix = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.tokens = [""] * size
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        self.split_special = re.compile("(" + "|".join(re.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")")
        symbols = byte_symbols()
        self.mid = np.array([vocab[s] for s in symbols], np.int64)
        self.last = np.array([vocab[s + self.suffix] for s in symbols], np.int64)
        # pairs of bytes that some token holds side by side
        as_byte = {s: b for b, s in enumerate(symbols)}
        self.byte_of = np.zeros(512, np.uint8)
        self.byte_of[[ord(c) for c in symbols]] = np.arange(256)
        joined = np.zeros((256, 256), bool)
        for token in vocab:
            raw = np.array([as_byte[c] for c in token.removesuffix(self.suffix)], np.int64)
            joined[raw[:-1], raw[1:]] = True
        self.cut = ~joined
        # merge table: open addressing over the packed pair of ids
        left = np.array([vocab[a] for a, b in model["merges"]], np.int64)
        right = np.array([vocab[b] for a, b in model["merges"]], np.int64)
        made = np.array([vocab[a + b] for a, b in model["merges"]], np.int64)
        self.bits = int(len(left) * 8 - 1).bit_length()
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.rank = np.zeros(1 << self.bits, np.int32)
        self.made = np.zeros(1 << self.bits, np.int32)
        key, rank = left << 20 | right, np.arange(len(left))
        slot = self._slot(key)
        self.probes = 0
        while len(key):
            self.probes += 1
            free = self.keys[slot] < 0
            first = np.zeros(len(key), bool)
            first[np.unique(slot, return_index=True)[1]] = True
            put = free & first
            self.keys[slot[put]], self.rank[slot[put]], self.made[slot[put]] = key[put], rank[put], made[rank[put]]
            key, rank, slot = key[~put], rank[~put], (slot[~put] + 1) & ((1 << self.bits) - 1)
        self.known: dict[bytes, int] = {}
        self.forget()

    def forget(self) -> None:
        self.known.clear()
        self.starts, self.lens, self.flat = np.zeros(1024, np.int64), np.zeros(1024, np.int64), np.zeros(8192, np.uint32)
        self.n_runs = self.n_flat = 0

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (mix(key.astype(U64)) >> U64(64 - self.bits)).astype(np.int64)

    def find_pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge ranks and resulting ids of pairs; rank 2**30 where there is no merge."""
        key = left << 20 | right
        slot = self._slot(key)
        rank, made = np.full(len(key), 1 << 30, np.int32), np.zeros(len(key), np.int32)
        todo = np.arange(len(key))
        for _ in range(self.probes):
            have = self.keys[slot]
            hit = have == key[todo]
            rank[todo[hit]], made[todo[hit]] = self.rank[slot[hit]], self.made[slot[hit]]
            go = ~hit & (have >= 0)
            if not go.any():
                break
            todo, slot = todo[go], (slot[go] + 1) & ((1 << self.bits) - 1)
        return rank, made

    def words_of(self, runs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bytes of the words of all runs, how many bytes each word has, and how many words each run has."""
        texts = [r.lower().decode() if r.isascii() else self.normalize(r.decode()) for r in runs]
        words: list[str] = []
        counts = np.zeros(len(runs), np.int64)
        for k in range(0, len(texts), RUNS_AT_ONCE):
            part = texts[k : k + RUNS_AT_ONCE]
            found = self.pre_tokenize("\n".join(part))
            ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1)
            begin = np.fromiter((at[0] for _, at in found), np.int64, len(found))
            counts[k : k + len(part)] = np.bincount(np.searchsorted(ends, begin, side="right"), minlength=len(part))
            words += [w for w, _ in found]
        data = self.byte_of[np.frombuffer("".join(words).encode("utf-16-le"), "<u2")]
        return data.astype(np.int64), np.fromiter(map(len, words), np.int64, len(words)), counts

    def encode_words(self, data: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one array, and how many each word has."""
        if not len(lens):
            return np.zeros(0, np.uint32), lens
        ends = np.cumsum(lens)
        ids = self.mid[data]
        ids[ends - 1] = self.last[data[ends - 1]]
        new = np.ones(len(data), bool)  # starts of fragments: words, and behind certain cuts
        new[1:] = self.cut[data[:-1], data[1:]]
        new[ends[:-1]] = True
        fragment = np.cumsum(new) - 1
        word = np.repeat(np.arange(len(lens)), lens)
        done_ids, done_at, at = [], [], np.arange(len(data))
        while len(ids):
            same = fragment[1:] == fragment[:-1]
            rank = np.full(len(ids), 1 << 30, np.int32)
            made = np.zeros(len(ids), np.int32)
            pair = np.flatnonzero(same)
            rank[pair], made[pair] = self.find_pairs(ids[pair], ids[pair + 1])
            starts = np.flatnonzero(np.concatenate(([True], ~same)))
            best = np.minimum.reduceat(rank, starts)
            size = np.diff(np.append(starts, len(ids)))
            each = np.repeat(best, size)
            over = each == 1 << 30  # nothing left to merge in this fragment
            done_ids.append(ids[over])
            done_at.append(at[over])
            take = (rank == each) & ~over
            # of touching candidates (a a a) the 1st, 3rd, ... of a run merge, left to right
            if take.any():
                t = np.flatnonzero(take)
                run = np.concatenate(([True], np.diff(t) > 1))
                first = np.flatnonzero(run)
                order = np.arange(len(t)) - np.repeat(first, np.diff(np.append(first, len(t))))
                t = t[order % 2 == 0]
                ids[t] = made[t]
                stay = ~over
                stay[t + 1] = False
            else:
                stay = ~over
            ids, at, fragment = ids[stay], at[stay], fragment[stay]
        done_ids, done_at = np.concatenate(done_ids), np.concatenate(done_at)
        order = np.argsort(done_at)
        return done_ids[order].astype(np.uint32), np.bincount(word[done_at], minlength=len(lens))

    def runs_of(self, text: str) -> list[bytes]:
        """The runs of a text without ASCII white space; the strings of special tokens are runs of their own, behind a space."""
        if "<|" not in text or len(parts := self.split_special.split(text)) == 1:
            return text.encode().split()
        runs: list[bytes] = []
        for k, part in enumerate(parts):
            runs += [b" " + part.encode()] if k % 2 else part.encode().split()
        return runs

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and how many each text has."""
        lists = [self.runs_of(t) for t in texts]
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        runs = [r for own in lists for r in own]
        if self.n_runs > RUN_MEMORY:
            self.forget()
        if new := [r for r in dict.fromkeys(runs) if r not in self.known]:
            plain, special = [r for r in new if r[0] != 32], [r for r in new if r[0] == 32]
            data, size, words = self.words_of(plain)
            ids, lens = self.encode_words(data, size)
            total = np.concatenate(([0], np.cumsum(lens)))
            lens = np.diff(total[np.concatenate(([0], np.cumsum(words)))])
            ids = np.concatenate((ids, np.array([self.special[r[1:].decode()] for r in special], np.uint32)))
            self.remember(plain + special, ids, np.concatenate((lens, np.ones(len(special), np.int64))))
        which = np.fromiter(map(self.known.__getitem__, runs), np.int64, len(runs))
        lens = self.lens[which]
        ids = self.flat[ragged(self.starts[which], lens)]
        ends = np.concatenate(([0], np.cumsum(lens)))
        bounds = np.concatenate(([0], np.cumsum(counts)))
        return ids, np.diff(ends[bounds])

    def remember(self, runs: list[bytes], ids: np.ndarray, lens: np.ndarray) -> None:
        n, m = self.n_runs + len(runs), self.n_flat + len(ids)
        if n > len(self.lens):
            self.starts, self.lens = (np.concatenate((x, np.zeros(2 * n - len(x), np.int64))) for x in (self.starts, self.lens))
        if m > len(self.flat):
            self.flat = np.concatenate((self.flat, np.zeros(2 * m - len(self.flat), np.uint32)))
        self.starts[self.n_runs : n] = self.n_flat + np.cumsum(lens) - lens
        self.lens[self.n_runs : n] = lens
        self.flat[self.n_flat : m] = ids
        for k, r in enumerate(runs, self.n_runs):
            self.known[r] = k
        self.n_runs, self.n_flat = n, m

    def encode_each(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """The ids of each text (null: none), many short texts or one piece of a long text at a time."""
        have: list[np.ndarray] = []
        for part in _parts(texts):
            ids, lens = self.encode([t for t, _ in part])
            ends = np.cumsum(lens).tolist()
            for (_, last), e, n in zip(part, ends, lens.tolist(), strict=True):
                have.append(ids[e - n : e])
                if last:
                    yield np.concatenate(have).astype("<u4", copy=False) if len(have) > 1 else have[0].astype("<u4", copy=False)
                    have = []

    def decode(self, ids: np.ndarray) -> str:
        tokens = self.tokens
        return " ".join([tokens[i] for i in ids.tolist()])

    def decode_digest(self, ids: np.ndarray) -> str:
        """SHA-256 of the decoded text in UTF-8, decoded a stretch at a time."""
        digest = hashlib.sha256()
        for k in range(0, len(ids), PIECE_CHARS):
            digest.update(((" " if k else "") + self.decode(ids[k : k + PIECE_CHARS])).encode())
        return digest.hexdigest()


_loaded: dict[str, WordBpe] = {}


def load(path: str) -> WordBpe:
    if path not in _loaded:
        _loaded[path] = WordBpe(path)
    return _loaded[path]


def bpe_encode(docs: DataFrame, path: str, text: str = "text", out: str = "token_ids") -> DataFrame:
    """docs with a binary column of little-endian unsigned 32-bit ids of each whole text."""

    @F.pandas_udf("binary")
    def encode(texts):
        import pandas as pd

        return pd.Series([ids.tobytes() for ids in load(path).encode_each(texts.tolist())], dtype=object)

    return docs.withColumn(out, encode(F.col(text)))


def bpe_decode(docs: DataFrame, path: str, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """docs with the decoded text of a binary id column (the tokens of this vocabulary joined by one space)."""

    @F.pandas_udf("string")
    def decode(blobs):
        import pandas as pd

        bpe = load(path)
        return pd.Series([bpe.decode(np.frombuffer(b or b"", "<u4")) for b in blobs], dtype=object)

    return docs.withColumn(out, decode(F.col(ids)))


_WHITE = re.compile("[ \t-\r]")


def _parts(texts: list[str | None]) -> Iterator[list[tuple[str, bool]]]:
    """(piece, whether it ends its text) of at most TEXTS_AT_ONCE texts and about PIECE_CHARS characters; null is empty."""
    part: list[tuple[str, bool]] = []
    size = 0
    for text in texts:
        text, at = text or "", 0
        while True:
            cut = _WHITE.search(text, at + PIECE_CHARS)
            end = cut.start() if cut else len(text)
            if part and (len(part) >= TEXTS_AT_ONCE or size + end - at > PIECE_CHARS):
                yield part
                part, size = [], 0
            part.append((text[at:end], cut is None))
            size += end - at
            at = end
            if cut is None:
                break
    if part:
        yield part


DIGEST = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()), ("token_ids", pa.binary())])


def bpe_digest(docs: DataFrame, path: str, keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encodes, decodes the ids again, and digests both.

    One pass in Arrow batches, so that decoded texts do not travel between processes; keep_ids adds
    token_ids (little-endian unsigned 32-bit).
    """
    names = DIGEST.names if keep_ids else DIGEST.names[:-1]

    def run(batches):
        bpe = load(path)
        for b in batches:
            doc_ids, out, size = b.column(0).to_pylist(), {n: [] for n in names}, 0
            for doc_id, ids in zip(doc_ids, bpe.encode_each(b.column(1).to_pylist()), strict=True):
                raw = ids.tobytes()
                out["doc_id"].append(doc_id)
                out["n_tokens"].append(len(ids))
                out["ids_sha256"].append(hashlib.sha256(raw).hexdigest())
                out["decoded_sha256"].append(bpe.decode_digest(ids))
                if keep_ids:
                    out["token_ids"].append(raw)
                size += len(raw)
                if size > 16 * PIECE_CHARS:
                    yield pa.RecordBatch.from_pydict(out, schema=pa.schema([DIGEST.field(n) for n in names]))
                    out, size = {n: [] for n in names}, 0
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([DIGEST.field(n) for n in names]))

    ddl = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", token_ids binary" if keep_ids else "")
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, ddl)


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digest(read_table(spark, sf_dir, "documents"), vocabulary_path())
