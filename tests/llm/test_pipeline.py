"""The pipeline against its stages' definitions, on a small set of tables with planted cases."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from doorstep.llm import decontamination, simhash
from doorstep.llm.tables import DOCUMENT_COLUMNS


@pytest.fixture
def tables(spark, tmp_path):
    rng = random.Random(6)
    words = [f"word{i}" for i in range(3000)]
    make = lambda n: " ".join(rng.choices(words, k=n))
    items = [(i, make(30) + ". " + make(8) + ".") for i in range(6)]
    docs = {i: make(rng.randint(60, 200)) for i in range(40)}
    docs[50] = docs[3]
    docs[51] = docs[4] + " " + "tail"
    docs[52] = make(60) + " " + items[2][1] + " " + make(40)
    docs[53] = "too short"
    docs[54] = "again and again " * 40
    docs[55] = None
    rows = [(i, t, "en", f"s{i % 3}" if i != 7 else None, len(t or "")) for i, t in docs.items()]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path), docs, items


def brute_kept(docs, items):
    """Ids that the three filtering stages leave."""
    def fails(text):
        w = (text or "").split()
        windows = [tuple(w[j : j + 3]) for j in range(len(w) - 2)]
        covered = {k for j, x in enumerate(windows) if windows.count(x) > 1 for k in range(j, j + 3)}
        return len(w) < 50 or 100 * len(covered) > 50 * len(w)

    kept = {i: t for i, t in docs.items() if not fails(t)}
    prints = {i: simhash.fingerprint(t) for i, t in kept.items()}
    near = lambda a, b: ((prints[a] ^ prints[b]) & (2**64 - 1)).bit_count() <= 4
    kept = {i: t for i, t in kept.items() if not any(j < i and near(i, j) for j in kept)}
    shingles = [decontamination.shingles(decontamination.terms(t)) for _, t in items]
    holds = lambda t: any(len(s & decontamination.shingles(decontamination.terms(t))) >= 0.8 * len(s) for s in shingles)
    return {i: t for i, t in kept.items() if not holds(t)}


def test_stages_and_result(spark, tables):
    folder, docs, items = tables
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "simhash near-dedup", "benchmark decontamination", "source mix", "token files",
    ]
    table = spark.read.parquet(f"{folder}/documents.parquet")
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        result = stage(spark, table, folder)
        result.write.parquet(f"{folder}/stage{number}")
        if number < 4:
            assert result.columns == DOCUMENT_COLUMNS, name
        table = spark.read.parquet(f"{folder}/stage{number}")
        if number == 2:
            assert {r.doc_id: r.text for r in table.collect()} == brute_kept(docs, items)
            assert {50, 52, 53, 54, 55}.isdisjoint({r.doc_id for r in table.collect()})
    mixed = spark.read.parquet(f"{folder}/stage3").collect()
    encode = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).encode
    want = Counter()
    for r in mixed:
        ids = encode(r.text, add_special_tokens=False).ids + [2]
        want[r.doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    rows = sorted(table.collect(), key=lambda r: r.start)
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == want
    assert [r.start for r in rows] == np.cumsum([0, *[r.n_tokens for r in rows]]).tolist()[:-1]
    total = sum(len(t.split()) for t in brute_kept(docs, items).values())
    assert abs(sum(len(r.text.split()) for r in mixed) - 1.5 * total) < 0.03 * total


def test_run(spark, tables):
    folder, docs, _ = tables
    result = corpus_pipeline.run(spark, folder)
    assert result.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and result.count() > 20
    again = corpus_pipeline.run(spark, folder)
    assert sorted(map(tuple, result.collect())) == sorted(map(tuple, again.collect()))


def test_empty_tables_go_through_all_stages(spark, small, tmp_path):
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{small}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
