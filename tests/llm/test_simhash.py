import random
from itertools import product

import numpy as np
import pytest
import xxhash

from doorstep.llm import graph, simhash


def brute_print(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        lower = lower.replace(space, " ")
    words = [w for w in lower.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(s.encode(), 42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints):
    """Least id reachable through prints at four bits or fewer, by repeated relabelling."""
    label = dict(prints and {i: i for i in prints})
    changed = True
    while changed:
        changed = False
        for (a, x), (b, y) in product(prints.items(), repeat=2):
            if (x ^ y).bit_count() <= 4 and label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
    return label


TEXTS = ["", None, " \t", "one", "One two", "a b c d", "A b  c\td e", "ÀB Éa x\x0by z\x1c q r " * 9]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint(text):
    assert simhash.fingerprint(text) & (2**64 - 1) == brute_print(text)


def test_first_hash_is_sparks(spark):
    from pyspark.sql import functions as F

    got = spark.range(1).select(F.xxhash64(F.lit("a b c d")).alias("h")).first().h
    assert simhash.fingerprint("a b c d") == got


def test_groups_by_brute_force(docs):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    texts = [[rng.choice(words) for _ in range(rng.randint(30, 90))] for _ in range(25)]
    for base in list(texts):
        for _ in range(4):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(copy)
    rows = [(100 - i, " ".join(t)) for i, t in enumerate(texts)] + [(500, ""), (501, None)]
    got = {r.doc_id: r for r in simhash.near_duplicates(docs(*rows)).collect()}
    prints = {i: brute_print(t) for i, t in rows}
    label = brute_groups(prints)
    assert {i: int(r.fingerprint, 16) for i, r in got.items()} == prints
    assert {i: r.component_id for i, r in got.items()} == label
    assert len(set(label.values())) < len(rows) - 20


def test_links_of_planted_distances(spark):
    rng = random.Random(8)
    base = [rng.getrandbits(64) for _ in range(200)]
    prints = set(base)
    for x in base:
        y = x
        for b in rng.sample(range(64), 4):
            y ^= 1 << b
        prints.add(y)
        z = x
        for b in rng.sample(range(64), 5):
            z ^= 1 << b
        prints.add(z)
    signed = [(x - 2**64 if x >> 63 else x,) for x in prints]
    found = graph.components(simhash.links(spark.createDataFrame(signed, "fp long"), 4))
    got = {r.node & (2**64 - 1): r.label for r in found.collect()}
    want = brute_groups({x: x for x in prints})
    linked = [x for x in prints if any(want[x] == want[y] for y in prints if y != x)]
    assert set(got) == set(linked)
    assert len({got[x] for x in linked}) == len({want[x] for x in linked})


@pytest.mark.parametrize("n", [10, 10**5, 10**7, 10**9])
def test_thresholds_cover_every_pair(n):
    share = np.full(64, 0.5)
    gram = np.outer(share, share) * n
    np.fill_diagonal(gram, share * n)
    groups = simhash.plan_groups(n, gram, 4)
    assert sum(g.threshold + 1 for g in groups) == 5
    bits = [b for g in groups for b in g.bits]
    assert len(bits) == len(set(bits))


def test_correlated_bits_share_a_group():
    rng = np.random.default_rng(1)
    bits = rng.integers(0, 2, (5000, 64))
    bits[:, 40:56] = bits[:, 3:4]
    gram = (bits.T @ bits).astype(float)
    share = np.diag(gram) / 5000
    spread = np.sqrt(share * (1 - share))
    parts = simhash._correlated(np.abs(gram / 5000 - np.outer(share, share)) / np.outer(spread, spread), 3)
    home = next(p for p in parts if 3 in p)
    assert sum(b in home for b in range(40, 56)) >= 15


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(0, 40)] + [(900, i) for i in range(100, 400)] + [(7, 7)]
    got = {r.node: r.label for r in graph.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert {got[i] for i in range(41)} == {0} and {got[i] for i in [900, *range(100, 400)]} == {100}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_keep_one(docs):
    text = " ".join(f"w{i}" for i in range(80))
    other = " ".join(f"v{i}" for i in range(80))
    df = docs((5, text), (3, text), (3, text), (9, other), (None, text), (None, other + " x"), (None, "alone"), (None, "alone"))
    kept = simhash.keep_one(df.selectExpr("*", "1 as row", "2 as fp", "3 as nth"))
    assert kept.columns == [*df.columns, "row", "fp", "nth"]
    assert sorted((r.doc_id, r.text[:5]) for r in kept.where("doc_id is not null").collect()) == [(3, "w0 w1"), (9, "v0 v1")]
    assert [r.text for r in kept.where("doc_id is null").collect()] == ["alone"]
    assert simhash.keep_one(df.limit(0)).count() == 0


def test_no_and_one_fingerprint(docs):
    assert simhash.plan_groups(0, np.zeros((64, 64)), 4) == simhash.plan_groups(1, np.zeros((64, 64)), 4) == []
    assert simhash.near_duplicates(docs().limit(0)).count() == 0
    assert [r.component_id for r in simhash.near_duplicates(docs((7, "a b"), (4, "a b"))).collect()] == [4, 4]
