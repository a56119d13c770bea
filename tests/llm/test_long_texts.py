"""Long texts in pieces, and long sets by their least hashes, against the ways that take them whole."""

import numpy as np
import pyarrow as pa
import pytest

from terracover.llm import decontaminate, neardup, quality
from terracover.llm.common import U64, chunks_of

PARTS = ["12", "km", "-", "--", "London", "Ápril", "the", "end.", "a|b", "$5", "x", "…", "\n", "\n\n", "\t", "  ", "mile"]


def texts(seed: int, n: int = 60) -> list[str]:
    rng = np.random.default_rng(seed)
    out = ["", "\n", "word", "- - -\n" * 40, "a\n" * 60, "one two three " * 30, "x" * 300, " 12 - - \n - - - - - - - - - km"]
    return out + [" ".join(rng.choice(PARTS, int(rng.integers(1, 120))).tolist()) for _ in range(n)]


@pytest.mark.parametrize("piece", [1, 7, 40])
def test_long_metrics(piece):
    for text in texts(1):
        c = next(chunks_of(pa.array([text])))
        whole, pieces = quality.metrics_of(c), quality.long_metrics(c, piece)
        assert {m: int(whole[m][0]) for m in quality.METRICS} == {m: int(pieces[m][0]) for m in quality.METRICS}, text


@pytest.mark.parametrize("piece", [1, 7, 40])
def test_token_pieces(piece):
    def windows(tokens, base, width, exact):
        h, _, place, fill, rich = decontaminate.windows_of(tokens, 1, width, exact)
        return set(zip(h.tolist(), (place + base).tolist(), map(tuple, fill.tolist()), rich.tolist(), strict=True))

    for text in texts(2):
        c = next(chunks_of(pa.array([text])))
        for width in (1, 3, decontaminate.WINDOW):
            for exact in (False, True):
                whole = windows(decontaminate.canonical(c), 0, width, exact)
                pieces = set().union(*(windows(t, base, width, exact) for t, base in decontaminate.token_pieces(c, piece)))
                assert pieces == whole, text


def block(sets: list[np.ndarray], comps: list[int], first: int) -> pa.StructArray:
    h = [np.sort(s) for s in sets]
    sig = neardup.signatures(np.concatenate(h), np.cumsum([0] + [len(x) for x in h[:-1]]))
    columns = {
        "node": pa.array(range(first, first + len(h)), pa.int64()),
        "comp": pa.array(comps, pa.int64()),
        "n": pa.array([len(x) for x in h], pa.int64()),
        "sig8": pa.array([(s & 0xFF).astype(np.uint8).tobytes() for s in sig], pa.binary()),
        "keys": pa.array([np.zeros(neardup.BANDS, U64).tobytes()] * len(h), pa.binary()),
        "set64": pa.array([neardup.least_hashes(x, int(neardup.halvings(np.array([len(x)]))[0])).tobytes() for x in h], pa.binary()),
    }
    return pa.StructArray.from_arrays(list(columns.values()), list(columns))


def sharing(rng, base: np.ndarray, similarity: float) -> np.ndarray:
    """A set of the size of base and of the similarity given."""
    common = round(2 * len(base) * similarity / (1 + similarity))
    return np.concatenate((base[:common], rng.integers(0, 2**64, len(base) - common, dtype=U64)))


def test_long_sets_are_linked_by_their_least_hashes(monkeypatch):
    monkeypatch.setattr(neardup, "SET_LIMIT", 4096)
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**64, 60_000, dtype=U64)
    own = block([base], [1], 1)
    assert max(len(x) for x in own.field("set64").to_pylist()) <= 8 * 4096 * 1.1
    other = block([sharing(rng, base, s) for s in (0.9, 0.86, 0.801, 0.8, 0.5)], [11, 12, 13, 14, 15], 11)
    a, b = neardup._pair_blocks(own, other, 0, False, 80)
    assert set(a.tolist()) == {1} and {11, 12, 13, 14} == set(b.tolist())
    # a pair near the threshold spares no other of the same components, one far above it does
    near = block([sharing(rng, base, s) for s in (0.8, 0.8)], [11, 11], 11)
    assert neardup._pair_blocks(own, near, 0, False, 80)[1].tolist() == [11, 12]
    far = block([sharing(rng, base, s) for s in (0.95, 0.95)], [11, 11], 11)
    assert neardup._pair_blocks(own, far, 0, False, 80)[1].tolist() == [11]


def test_short_sets_are_compared_whole():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**64, 900, dtype=U64)
    exact = np.concatenate((base[:800], rng.integers(0, 2**64, 100, dtype=U64)))  # 800 of 1000: at the threshold
    below = np.concatenate((base[:799], rng.integers(0, 2**64, 101, dtype=U64)))
    own = block([base], [1], 1)
    assert neardup._pair_blocks(own, block([exact, below], [11, 12], 11), 0, False, 80)[1].tolist() == [11]
