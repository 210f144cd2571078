import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from doorstep.llm import token_files, wavelet

PATH = public_tokenizers.path("word_bpe_49k.json")


@given(st.lists(st.integers(0, 70000), max_size=1500))
@settings(max_examples=40, deadline=None)
def test_wavelet(values):
    w = wavelet.Wavelet.build(np.array(values, np.uint32))
    assert w.decode().tolist() == values
    rng = random.Random(1)
    for i in rng.sample(range(len(values)), min(20, len(values))):
        v = values[i]
        assert w.access(i) == v
        places = [j for j, x in enumerate(values) if x == v]
        assert w.count(v) == len(places) and w.count(v, 3, i + 1) == sum(3 <= j <= i for j in places)
        assert [w.locate(v, k) for k in range(len(places))] == places
    assert w.count(70001) == 0 and w.count(1 << 20) == 0
    with pytest.raises(IndexError):
        w.locate(70001, 0)


def test_file_round_trip():
    values = np.array([5, 2, 70000, 2], np.uint32)
    ids, lengths, w = wavelet.load(wavelet.dump([None, 3, 3], [1, 1, 2], values))
    assert ids == [None, 3, 3] and lengths.tolist() == [1, 1, 2] and w.decode().tolist() == values.tolist()
    with pytest.raises(ValueError):
        wavelet.load(b"something else")


TEXTS = [
    "", None, " \n", "Hello, World! it's 42", "a\x00b \x00 c", "x <|endoftext|> y<|startoftext|>z", "é é ́x",
    "nb sp　w \x1c\x85 q", "日本語 テキスト", "'s 't don't", "many   spaces\t\tand\x0blines\x0c\r\n", "😀😀 İI ß",
]


@given(st.lists(st.one_of(st.sampled_from(TEXTS), st.text(max_size=30)), max_size=8))
@settings(max_examples=60, deadline=None)
def test_words_encode_like_texts(texts):
    plain = Tokenizer.from_file(PATH)
    got = [np.frombuffer(x, "<u4").tolist() for x in token_files.encoder(PATH).encode(texts)]
    assert got == [plain.encode(t or "", add_special_tokens=False).ids for t in texts]


def brute(rows):
    plain, start, out = Tokenizer.from_file(PATH), 0, []
    for doc_id, text in rows:
        ids = plain.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("file_ids", [1 << 20, 40])
def test_rows(spark, docs, tmp_path, file_ids):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choices(["alpha", "beta!", "Gamma", "42"], k=rng.randint(0, 40)))) for i in range(-5, 60)]
    rows += [(100, "w " * 5000)] + [(200 + i, t) for i, t in enumerate(TEXTS)]
    df = docs(*rng.sample(rows, len(rows))).repartition(3).selectExpr("*", "1 as h", "2 as path")
    manifest = token_files.write_tokens(df, PATH, str(tmp_path / "tokens"), file_ids=file_ids)
    got = [tuple(r) for r in token_files.read_tokens(manifest).collect()]
    assert sorted(got, key=lambda r: r[1]) == brute(rows)
    assert all(p.suffix == ".wvm" for p in (tmp_path / "tokens").iterdir())


def test_nulls_ties_and_no_rows(docs):
    df = docs((1, "b"), (None, "a"), (1, "b"), (1, "c d"))
    got = sorted(token_files.token_rows(df, PATH).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, 1, 1, 1] and [r.n_tokens for r in got][0] == 2
    assert token_files.token_rows(df.limit(0), PATH).count() == 0
