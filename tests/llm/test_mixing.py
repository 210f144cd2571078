import random
from collections import Counter, defaultdict
from fractions import Fraction

import pytest

from doorstep.llm import mixing


def brute_quota(targets: dict, seats: int) -> dict:
    held = Counter()
    for _ in range(seats):
        best = max(sorted(targets), key=lambda p: Fraction(targets[p]) / (2 * held[p] + 1))
        held[best] += 1
    return {p: held[p] for p in targets}


def brute_targets(sizes: dict, mix) -> dict:
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mix.weights[i % len(mix.weights)] for i, s in enumerate(order)}
    total, fixed = mix.share * sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        left = total - sum(fixed.values())
        level = left / sum(weight[s] for s in free) if free else 0
        over = [s for s in free if weight[s] * level > mix.cap * sizes[s]]
        if not over:
            return {**fixed, **{s: weight[s] * level for s in free}}
        fixed.update({s: mix.cap * sizes[s] for s in over})


def test_apportionment_by_single_seats(spark):
    rng = random.Random(9)
    rows, seats = [], []
    for g in range(12):
        targets = {p: float(rng.choice([0, 1, 5, 40, 300, 5000])) * rng.choice([1, 1, 0.37]) for p in range(rng.randint(1, 9))}
        if g == 3:
            targets = {p: 7.0 for p in range(5)}
        rows += [(g, p, t, 10**9) for p, t in targets.items()]
        seats.append((g, rng.choice([0, 1, 2, 13, 200]) if sum(targets.values()) else 0))
    got = mixing.apportion(
        spark.createDataFrame(rows, "group int, party long, target double, most long"),
        spark.createDataFrame(seats, "group int, seats long"),
    )
    quotas = defaultdict(dict)
    for r in got.collect():
        quotas[r.group][r.party] = r.quota
    for g, n in seats:
        want = brute_quota({p: t for h, p, t, _ in rows if h == g}, n) if n else None
        assert quotas[g] == (want or {p: 0 for h, p, *_ in rows if h == g}), g


@pytest.fixture
def corpus(docs):
    rng = random.Random(4)
    rows = []
    for k, source in enumerate(["b", "a", None, "zé", "Z", "hot"]):
        for i in range(120 if source == "hot" else 25):
            rows.append((1000 * k + i, " ".join(f"w{j}" for j in range(rng.choice([0, 3, 40, 200]))), source))
    return rows, docs(*rows, (None, "x y\tz", "a"), (7, None, "a"), (5, "", "empty"))


def test_mix(corpus, docs):
    mix = mixing.Mix(shard_words=2000)
    rows, df = corpus
    df = df.selectExpr("*", "1 as size", "2 as shard", "3 as rank")
    got = mixing.mix_sources(df, mix).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, mixing.mix_sources(df.repartition(5), mix).collect()))
    source_of = {(r.doc_id, r.text): r.source for r in df.collect()}
    sizes, taken = Counter(), Counter()
    by_row = [(r.source, len((r.text or "").split())) for r in df.collect()]
    for source, n in by_row:
        sizes[source] += n
    assert len(got) == len(by_row) and source_of
    want = brute_targets(sizes, mix)
    target_of = defaultdict(set)
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        target_of[r.target].add(r.source_size)
        taken[round(r.target, 6)] += r.taken
    assert sorted({round(r.target, 6) for r in got}) == sorted({round(t, 6) for t in want.values()})
    for s, t in want.items():
        assert abs(taken[round(t, 6)] - t) <= 40 + 0.02 * t, s


def test_documents_of_the_mix(corpus):
    mix = mixing.Mix(shard_words=2000)
    rows, df = corpus
    df = df.where("doc_id is not null and doc_id <> 7 and coalesce(source, '') <> 'empty'")
    taken = {r.doc_id: r.taken for r in mixing.mix_sources(df, mix).collect()}
    text_of = {r.doc_id: r.text for r in df.collect()}
    words = Counter()
    for r in mixing.mixed_documents(df, mix).collect():
        assert r.text.strip() and r.text in text_of[r.doc_id] and r.n_chars == len(r.text)
        words[r.doc_id] += len(r.text.split())
    assert words == Counter({d: n for d, n in taken.items() if n})
    assert mixing.mixed_documents(df, mix).columns == df.columns


def test_edges(docs):
    assert mixing.mix_sources(docs((1, "a")).limit(0)).count() == 0
    got = mixing.mix_sources(docs((1, None), (1, ""))).collect()
    assert [(r.size, r.source_size, r.target, r.taken) for r in got] == [(0, 0, 0.0, 0)] * 2
    one = mixing.mix_sources(docs((1, "a b c"))).collect()
    assert [(r.size, r.target) for r in one] == [(3, 4.5)]


def test_repeated_rows_are_spread_and_taken_whole(docs):
    """Rows without an id and rows that repeat one go to many shards; the mix holds what all of them take, once."""
    mix = mixing.Mix(shard_words=400)
    same = [(None, "a b c d e f g h", "hot")] * 300 + [(4, "p q r s", "hot")] * 9
    other = [(4, f"x{i} y{i} z{i}", "hot") for i in range(40)] + [(9, "k l m", "b"), (9, "k l m", None)]
    df = docs(*same, *other)
    planned = mixing.plan(df, mix).collect()
    assert len(planned) == len(same) + len(other)
    taken, found = Counter(), Counter()
    for r in planned:
        taken[r.doc_id, r.source] += r.rounds * r["size"] + sum(x.length for x in r.runs or [])
    for r in mixing.mixed_documents(df, mix).collect():
        found[r.doc_id, r.source] += len(r.text.split())
        assert r.doc_id != 4 or r.text.split()[0][0] in "pqrsxyz"
    assert found == taken and taken[None, "hot"] > 0
    shards = mixing.shard_sizes(df, mix).collect()
    assert len(shards) > 5 and max(r.shard_size for r in shards) < 4 * mix.shard_words
