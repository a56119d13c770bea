"""The pipeline's stages one after another against brute force, and the driver's registry."""

import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from terracover.llm import bpe

from .test_operators import base, brute_metrics, shingles


def make_tables(spark, folder):
    r = random.Random(21)

    def prose(n):
        return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 8))) for _ in range(n))

    texts = [prose(r.randint(55, 150)) for _ in range(40)]
    benchmark = [prose(30), prose(8)]
    texts += [texts[3], texts[4] + " tail", " ".join(texts[5].split()[:-1]), prose(60) + " " + benchmark[0] + " " + prose(9), prose(20), None, "", "x " * 200]
    texts += [f"{prose(60)} mail a.b@c.de or +49 (30) 123-4567 card 4539 1488 0343 6467 at 10.0.0.1 {prose(5)}"]
    rows = [(k, t, "en", "s", None if t is None else len(t)) for k, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(k, 1, 0) for k in range(20)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(enumerate(benchmark)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return texts, benchmark


def mask(t):
    out, at = [], 0
    for s, k, e, _ in base(t):
        if s >= at:
            out += [t[at:s], ["[EMAIL]", "[IP]", "[CARD]", "[PHONE]"][k]]
        at = max(at, e)
    return "".join(out) + t[at:]


def test_stages(spark, tmp_path):
    from tokenizers import Tokenizer

    folder = f"file://{tmp_path}"
    texts, benchmark = make_tables(spark, folder)
    kept = {}
    for k, t in enumerate(texts):
        n, *_, repeats, _ = brute_metrics(t)
        if n >= 50 and 100 * repeats <= 50 * n:
            kept[k] = t
    firsts = {}
    for k, t in kept.items():
        own = shingles(t, 5)
        if not any(100 * len(own & shingles(o, 5)) >= 80 * len(own | shingles(o, 5)) for o in firsts.values()):
            firsts[k] = t
    clean = {k: mask(t) for k, t in firsts.items() if benchmark[0] not in t}
    assert 0 < len(clean) < len(firsts) < len(kept) < len(texts)
    library = Tokenizer.from_file(bpe.vocabulary_path())
    want = collections.Counter()
    for k, t in clean.items():
        ids = library.encode(t, add_special_tokens=False).ids
        want[k, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()] += 1
    rows = corpus_pipeline.run(spark, folder).collect()
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_sha256) for r in rows) == want


def test_every_stage_keeps_the_columns(spark, tmp_path):
    folder = f"file://{tmp_path}"
    make_tables(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumns({"did": F.lit(1), "row": F.lit("r"), "spans": F.lit(None).cast("string")})
    for own in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, own, folder)
            assert out.columns == docs.columns and out.count() <= own.count(), name


def test_registry():
    names = entry.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10 and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names) and [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "decontamination", "personal_data", "bpe"]


def test_missing_folders_leave_the_rest(monkeypatch):
    find = entry.importlib.util.find_spec
    monkeypatch.setattr(entry.importlib.util, "find_spec", lambda n, *a: None if n.startswith("terracover.llm") or n == "corpus_pipeline" else find(n, *a))
    assert not any(n.startswith("op") or n == "pipeline" for n in entry.queries()) and "coverage_by_unit" in entry.queries()
    with pytest.raises(KeyError):
        entry.queries()["pipeline"]
