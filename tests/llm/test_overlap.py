"""The Jaccard join against brute force: DivideSkip on random lists, components on awkward texts."""

import collections
import random

import numpy as np
import pytest

from terracover.llm import overlap
from terracover.llm.common import U64

SCHEMA = "doc_id long, text string, n long, node string, comp string, leader string"


def test_merge_skip_equals_counting():
    r = random.Random(4)
    for _ in range(400):
        lists = [sorted(r.sample(range(30), r.randint(1, 12))) for _ in range(r.randint(1, 9))]
        weights = [r.randint(1, 4) for _ in lists]
        need = r.randint(1, sum(weights))
        total = collections.Counter()
        for own, w in zip(lists, weights, strict=True):
            total.update(dict.fromkeys(own, w))
        assert sorted(overlap.merge_skip(lists, weights, need)) == sorted((d, w) for d, w in total.items() if w >= need)


@pytest.mark.parametrize("threshold", [50, 80, 85, 100])
def test_search_equals_comparing_all(threshold):
    r = random.Random(threshold)
    sets = []
    for _ in range(12):
        base = r.sample(range(1, 2000), r.randint(1, 60))
        sets += [sorted({x if r.random() < 0.95 else r.randint(1, 2000) for x in base} | set(range(3000, 3000 + r.choice([0, 0, 20])))) for _ in range(r.randint(1, 8))]
    h, d = np.concatenate([np.array(s, U64) for s in sets]), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    comp = np.array([k // 3 for k in range(len(sets))])
    block = overlap.Inverted(h, d, np.arange(len(sets)), comp)
    for k, own in enumerate(sets):
        want = [j for j, s in enumerate(sets) if comp[j] != comp[k] and 100 * len(set(s) & set(own)) >= threshold * len(set(s) | set(own))]
        assert sorted(block.search(np.array(own, U64), int(comp[k]), threshold).tolist()) == want


def brute(rows, width, threshold):
    """(doc_id, set size, component_id) of every row."""
    sets = []
    for _, text in rows:
        lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
        words = [w for w in lowered.replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
        sets.append({tuple(words[k : k + width]) for k in range(len(words) - width + 1)} if len(words) >= width else {tuple(words)} if words else set())
    above = list(range(len(rows)))

    def root(k):
        while above[k] != k:
            k = above[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
                above[root(a)] = root(b)
    least = collections.defaultdict(list)
    for k, (d, _) in enumerate(rows):
        least[root(k)].append(d)
    return collections.Counter((d, len(sets[k]), d if not sets[k] else min((x for x in least[root(k)] if x is not None), default=None)) for k, (d, _) in enumerate(rows))


def awkward():
    r = random.Random(8)
    vocabulary = ["".join(r.choice("abcdeé") for _ in range(r.randint(2, 6))) for _ in range(400)]
    prose = lambda n: [r.choice(vocabulary) for _ in range(n)]
    texts = [None, "", " \n\t ", "word", "Word", "two words", "two  Words", "a b c d", "A\nB c D", "a b c d e"]
    for size in (40, 90, 300):  # chains of near copies, each changed a little from the last
        own = prose(size)
        for _ in range(14):
            texts.append(" ".join(own))
            own = list(own)
            own[r.randrange(size)] = r.choice(vocabulary)
    stamp = prose(60)  # one template, other fillers: some pairs are linked, most are not
    for _ in range(40):
        texts.append(" ".join(stamp + prose(r.choice([1, 3, 9, 14, 20]))))
    for _ in range(30):  # a passage inside other prose
        texts.append(" ".join(prose(r.randint(1, 80)) + stamp[:25] + prose(r.randint(0, 80))))
    texts += [" ".join(prose(r.randint(1, 60))) for _ in range(30)]
    texts += r.sample(texts, 20) + [" ".join(prose(20_000))] * 2
    return texts


@pytest.mark.parametrize(("width", "threshold", "small"), [(4, 85, False), (4, 85, True), (5, 80, True), (1, 60, True)])
def test_components_equal_brute_force(spark, monkeypatch, width, threshold, small):
    if small:  # many blocks and tasks, and an order with classes
        for name, value in (("BLOCK", 300), ("QUERIES", 3), ("WINDOW", 3000), ("HOT_SHINGLES", 60)):
            monkeypatch.setattr(overlap, name, value)
    texts = awkward()
    if small:
        texts = texts[:-2]
    rows = [(None if k % 31 == 4 else k // 2 if k % 5 == 0 else k, t) for k, t in enumerate(texts)]
    docs = spark.createDataFrame([(*x, 0, "a", "b", "c") for x in rows], SCHEMA).repartition(6)
    got = collections.Counter((x["doc_id"], x["n"], x["component_id"]) for x in overlap.overlap_components(docs, width, threshold).collect())
    assert got == brute(rows, width, threshold)


def test_a_group_of_near_copies_gives_fewer_links_than_rows(spark):
    r = random.Random(2)
    base = [r.randrange(1000) for _ in range(200)]
    texts = [" ".join(f"w{w if j != k else -k}" for j, w in enumerate(base)) for k in range(40)]  # all of them linked, none equal
    index = spark.createDataFrame([(0, k, k) for k in range(30)], "block long, node long, comp long")
    asked = spark.createDataFrame([(0, k, k) for k in range(40)], "block long, node long, comp long")
    links = overlap.search_blocks(index, asked, spark.createDataFrame(list(enumerate(texts)), "node long, text string"), 4, 85).collect()
    above = {}
    for a, b in links:
        assert (p := overlap.root_of(above, a)) != (q := overlap.root_of(above, b))
        above[p] = q
    assert len(links) == 39


def test_empty_table(spark):
    assert overlap.overlap_components(spark.createDataFrame([], SCHEMA)).count() == 0
