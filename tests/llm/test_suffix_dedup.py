import hashlib
import random

import numpy as np
import pytest

from doorstep.llm import suffix_dedup as sd


def brute(rows, length=100):
    """Rows of (doc_id, n_bytes, n_removed, n_spans, sha256) by the definition."""
    order = sorted({(r[0] is not None, r[0] or 0, _uid(r), r[1] or "") for r in rows})
    seen, result = set(), {}
    for known, doc_id, uid, text in order:
        data = text.encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - length + 1):
            window = data[i : i + length]
            if window in seen:
                gone[i : i + length] = True
            seen.add(window)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        result[known, doc_id, text] = (len(data), int(gone.sum()), int(spans), hashlib.sha256(kept).hexdigest())
    return sorted(((r[0], *result[r[0] is not None, r[0] or 0, r[1] or ""]) for r in rows), key=repr)


_uids: dict = {}


def _uid(row):
    return _uids[row[0], row[1] or ""]


@pytest.fixture
def check(spark, docs):
    def run(rows, hot=None, partitions=4):
        df = docs(*rows).repartition(partitions)
        _uids.clear()
        _uids.update({(r.doc_id, r.body): r.uid for r in sd.keyed(df).collect()})
        got = sorted((tuple(r) for r in sd.dedup_digests(df).collect()), key=repr)
        assert got == brute(rows)
        return got

    return run


def corpus(seed, n=60):
    rng = random.Random(seed)
    syllables = ["the", "on", "er", "ti", " ", "\n", "é", "an", ". "]
    make = lambda k: "".join(rng.choice(syllables) for _ in range(k))
    passages = [make(rng.randint(30, 200)) for _ in range(8)]
    texts = []
    for _ in range(n):
        kind = rng.random()
        if kind < 0.2 and texts:
            text = rng.choice(texts)
        elif kind < 0.5 and texts:
            text = list(rng.choice(texts))
            for _ in range(rng.randint(1, 4)):
                if text:
                    text[rng.randrange(len(text))] = rng.choice("xyz")
            text = "".join(text)
        else:
            text = make(rng.randint(0, 150)) + rng.choice(passages) + make(rng.randint(0, 60)) + rng.choice(passages)
        texts.append(text)
    return [(rng.randrange(10_000), t) for t in texts]


@pytest.mark.parametrize("seed", [1, 2])
def test_by_brute_force(check, seed):
    got = check(corpus(seed))
    assert sum(r[2] for r in got) > 1000


def test_edges(check, spark, docs):
    rng = random.Random(7)
    passage = "".join(rng.choice("abcdef ") for _ in range(150))
    rows = [
        (1, passage), (1, passage), (1, passage + " other"), (None, passage[10:120]), (2, None), (3, ""), (4, "short"),
        (5, "a" * 700), (6, "ab" * 300), (7, "x" * 99), (8, "x" * 99 + "y"), (9, passage[:99]), (10, passage[3:103]),
        (-4, "é" * 120 + "z"), (11, "-" + "é" * 60), (12, passage + passage + passage[:60]), (13, "q" * 100),
    ]
    check(rows)
    df = docs(*rows).selectExpr("*", "1 as uid", "2 as body", "3 as kept")
    assert sd.dedup(df.limit(0)).count() == 0
    whole = {r.doc_id: bytes(r.kept) for r in sd.dedup(df).collect()}
    assert whole[10] == b"" and whole[9] == passage[:99].encode() and whole[2] == b""


def test_hot_anchors(check, monkeypatch):
    """A passage among many different neighbours, through the Spark rounds."""
    monkeypatch.setattr(sd, "HOT", 3)
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 90)))
    line = "this line stands in very many documents of the corpus, with something else on either side of it, always."
    rows = [(i, f"{word()} {line} {word()}") for i in range(40)] + [(99, line)]
    got = check(rows)
    assert sum(r[2] > 100 for r in got) >= 39


def test_small_batches(check, monkeypatch):
    monkeypatch.setattr(sd, "BATCH_WINDOWS", 50)
    monkeypatch.setattr(sd, "BATCH_BYTES", 400)
    check(corpus(3, 40), partitions=2)


def test_edges_of_tasks():
    """What tasks leave open is settled as if one task had sorted all rows."""
    rng = random.Random(11)
    for _ in range(400):
        rows = sorted({(rng.randint(1, 3), rng.randint(1, 2), 0, 0, rng.randint(0, 9), 1) for _ in range(rng.randint(1, 12))})
        want_repeat = {r for k, r in enumerate(rows) if k and rows[k - 1][:2] == r[:2]}
        firsts = [r for r in rows if r not in want_repeat]
        want_first = {r for r in firsts if sum(f[0] == r[0] for f in firsts) > 1}
        cuts = sorted(rng.sample(range(len(rows) + 1), min(len(rows), rng.randint(0, 4))))
        edges, repeats, given = [], set(), set()
        for piece, (i, j) in enumerate(zip([0, *cuts], [*cuts, len(rows)])):
            part = rows[i:j]
            if not part:
                continue
            own = [r for k, r in enumerate(part) if not k or part[k - 1][:2] != r[:2]]
            repeats |= set(part) - set(own)
            mixed = {r for r in own if sum(f[0] == r[0] for f in own) > 1}
            given |= mixed - {part[0]}
            if part[0] in mixed:
                edges.append((sd.HEAD, piece, *part[0]))
            edges.append((sd.LAST, piece, *part[0]))
            edges.append((sd.LAST, piece, *own[-1][:5], -1 if own[-1] in mixed else own[-1][5]))
        for kind, *row in sd.settle_edges(edges):
            (repeats if kind == sd.REPEAT else given).add(tuple(row))
        assert repeats == want_repeat and given == want_first
