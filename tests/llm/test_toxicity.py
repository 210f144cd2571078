import random

import pytest
from hypothesis import given, settings, strategies as st

from doorstep.llm import levenshtein, toxicity


def distance(a, b):
    """Edits, a neighbouring pair in turned order being one."""
    d = {(i, j): i + j for i in range(len(a) + 1) for j in range(len(b) + 1) if not i or not j}
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            d[i, j] = min(d[i - 1, j - 1] + (x != y), d[i, j - 1] + 1, d[i - 1, j] + 1)
            if i > 1 and j > 1 and x == b[j - 2] and y == a[i - 2]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


def turned(a, b):
    return any(a[:k] + a[k + 1] + a[k] + a[k + 2 :] == b for k in range(len(a) - 1))


def brute_distance(entry, is_stem, word):
    """Edits from the entry to the word, or to its start; None if more than the entry allows."""
    starts = [word[:k] for k in range(len(word) + 1)] if is_stem else [word]
    if entry in starts:
        return 0
    if len(entry) < 4 or len(entry) < 5 and word[0] != entry[0]:
        return None
    if is_stem and len(entry) < 5:
        return 1 if any(turned(entry, s) for s in starts) else None
    return 1 if min(distance(entry, s) for s in starts) == 1 else None


words = st.text("abcé", min_size=0, max_size=9)
stems_of = words.filter(lambda w: len(w) > 3)


@given(st.lists(words.filter(len), max_size=6), st.lists(stems_of, max_size=4), st.lists(words, max_size=30))
@settings(max_examples=300, deadline=None)
def test_automaton_by_brute_force(terms, stems, tried):
    trie = levenshtein.Trie(terms, stems)
    for w in tried:
        near = []
        for entries, is_stem in ((terms, False), (stems, True)):
            for e in entries if w else []:
                d = brute_distance(e, is_stem, w)
                if d is not None:
                    near.append((d, is_stem, e))
        want = min(near, default=None)
        assert trie.find(w) == (want and (want[2], want[1], want[0])), (terms, stems, w)


@pytest.mark.parametrize("word", ["skum", "scuum", "scm", "sucm", "idoit", "idito", "stupdi", "sutpid", "loweers"])
def test_short_and_turned(word):
    assert levenshtein.Trie(["scum", "idiot", "stupid"], ["lower"]).find(word)[2] == 1


@pytest.mark.parametrize("word", ["slump", "drum", "cum", "scams", "ass", "sas", "idio", "stpudi"])
def test_too_far(word):
    assert levenshtein.Trie(["scum", "ss"], ["dump"]).find(word) is None


def test_quotation_and_abuse():
    lexicon = toxicity.Lexicon(["idiot", "moron"], ["lowei"])
    f = lambda t: dict(zip(toxicity.FEATURES, toxicity.features(t, lexicon)))
    assert f("You IDIOT, you mor0n! loweichen")["exact"] == 1 and 0 < f("you mor0n")["near"] < 1
    assert f("a loweichen b")["stem"] == 1 and f("idiot moron")["beside"] > 0
    for quote in ('He was "an idiot" to them', "they called me an idiot today", "“idiot”"):
        assert (f(quote)["exact"], f(quote)["quoted"]) == (0, 1), quote
    assert f('idiot "fine" you')["exact"] == 1
    assert f(None)["bias"] == 1 and sum(f("").values()) == 1
    harmless = toxicity.Lexicon(["moron"], [], frozenset(["maron"]))
    assert harmless.match("maron") is None and harmless.match("moran") is not None


def accuracy(df, labels):
    got = {r.doc_id: r for r in df.collect()}
    held = [(got[i].predicted, y) for i, y in labels if got[i].held_out]
    caught = [p for p, y in held if y]
    return sum(p == y for p, y in held) / len(held), sum(caught) / max(1, len(caught)), held


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels)
    labelled = [(r.doc_id, r.toxic) for r in labels.collect()]
    scored = toxicity.score_documents(docs.join(labels.select("doc_id"), "doc_id", "left_semi"), model)
    right, caught, held = accuracy(scored, labelled)
    # Some toxic labels are on junk texts without any word of the lexicon.
    assert right > 0.985 and caught > 0.9 and sum(y for _, y in held) > 40
    assert sum(p for p, y in held if not y) <= 0.012 * len(held)


def test_misspelled_terms_and_edges(spark, docs):
    rng = random.Random(3)
    plain = [f"word{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(800):
        text = rng.choices(plain, k=40)
        toxic = i % 4 == 0
        if toxic:
            for _ in range(2):
                text[rng.randrange(40)] = rng.choice(["horrid", "wicked", "beastly"])
        rows.append((i, " ".join(text)))
        labels.append((i, None, int(toxic)))
    df, lab = docs(*rows), spark.createDataFrame(labels + [(None, 1, 1), (5, 1, None)], "doc_id long, quality int, toxic int")
    model = toxicity.train(df, lab)
    new = docs((1, "word1 word2 horr1d word3 wiked word9"), (1, "word5 " * 5000 + "beastly"), (None, None), (2, ""), (3, "word7 word8"))
    new = new.selectExpr("*", "1 as score", "2 as toxic")
    got = [(r.doc_id, r.predicted) for r in toxicity.score_documents(new, model).collect()]
    assert got == [(1, 1), (1, 1), (None, 0), (2, 0), (3, 0)]
    assert toxicity.score_documents(new.limit(0), model).count() == 0
    empty = toxicity.train(df.limit(0), lab.limit(0))
    assert not empty.lexicon.terms and toxicity.score_documents(new, empty).count() == 5


@pytest.mark.parametrize("i", [0, 1, 12345])
def test_fold(docs, i):
    import zlib

    got = toxicity.score_documents(docs((i, "x")), toxicity.Model(toxicity.Lexicon(), toxicity.PRIOR)).first()
    assert got.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= got.score <= 1
