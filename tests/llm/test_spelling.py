import random
import re
import zlib
from collections import Counter

import pytest

from doorstep.llm import spelling
from doorstep.llm.oracles import ORACLES
from doorstep.llm.queries import all_queries
from duck import rows as duck_rows, same


def brute_words(rows):
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}


def distance_one(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words):
    form, near = {}, {}
    for w in words:
        near[w] = [x for x in words if distance_one(w, x)]
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 2 * words[w] else None
    out = {}
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (w, form[w], root, n, len(near[w]), words.get(form[w]))
    return out


def random_words(seed, n, letters="abcàÿ"):
    rng = random.Random(seed)
    words = ["".join(rng.choices(letters, k=rng.randint(4, 8))) for _ in range(n)]
    for w in list(words):
        for _ in range(2):
            at = rng.randrange(len(w))
            words.append(rng.choice([w[:at] + w[at + 1 :], w[:at] + rng.choice(letters) + w[at + 1 :], w[:at] + rng.choice(letters) + w[at:]]))
    return words


def test_matches_sql(spark, small):
    name = "op11_spelling_variants"
    same(all_queries()[name](spark, small), duck_rows(ORACLES[name], small))


@pytest.mark.parametrize("block_words", [7, 50_000])
def test_documents_by_brute_force(spark, docs, block_words):
    rng = random.Random(1)
    words = random_words(2, 250)
    weights = [1 / (1 + k % 40) ** 2 for k in range(len(words))]
    seps = [" ", ".", "1", "\n", "×", "Ж", "😀", "-", "÷"]
    rows = [(None, None), (None, ""), (3, "x" * 3)]
    for i in range(200):
        picked = rng.choices(words, weights, k=40)
        rows.append((i % 150 or None, "".join(rng.choice([w, w.upper(), w.title()]) + rng.choice(seps) for w in picked)))
    rows += [(900, " ".join(["verylongword" * 3000, "verylongword" * 3000 + "s"] * 2))] * 2
    df = docs(*rows).selectExpr("*", "1 as word", "2 as n", "3 as form")
    want = brute(brute_words(rows))
    got = {r.word: tuple(r) for r in spelling.spelling_variants(df, block_words=block_words).collect()}
    assert got == want
    assert sum(r[1] is not None for r in got.values()) > 10 and any(r[1] != r[2] and r[1] for r in got.values())


def test_large_leaves(spark):
    rng = random.Random(3)
    words = {"".join(rng.sample("aabbccdd", 8)) for _ in range(900)}
    words |= {w[:3] + "a" + w[3:] for w in list(words)[:300]} | {w[:5] + w[6:] for w in list(words)[300:500]}
    rows = [(w, 1 + i % 9) for i, w in enumerate(sorted(words))]
    table = spark.createDataFrame(rows, "word string, n long")
    pairs = spelling.near_pairs(table, dict.fromkeys("abcd", 0) | {"d": 15}, block_words=400).collect()
    met = Counter(frozenset((r.word, r.other)) for r in pairs)
    assert set(met.values()) == {1}
    ordered = [w for w, _ in rows]
    assert set(met) == {frozenset((a, b)) for i, a in enumerate(ordered) for b in ordered[i + 1 :] if distance_one(a, b)}
    n = dict(rows)
    assert all((n[r.word], n[r.other]) == (r.n, r.other_n) for r in pairs)


def test_chains(spark):
    rows = [(f"w{i}", f"w{i + 1}" if i < 37 else None) for i in range(38)] + [("alone", None)]
    got = {r.of: r.root for r in spelling.roots(spark.createDataFrame(rows, "word string, form string")).collect()}
    assert got == {f"w{i}": "w37" for i in range(37)}


def test_empty(docs):
    assert spelling.spelling_variants(docs().limit(0)).count() == 0
    assert spelling.spelling_variants(docs((1, None), (2, "a b c"), (2, "a b c"))).count() == 0
