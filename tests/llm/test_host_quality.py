from doorstep.llm import host_quality
from doorstep.llm.oracles import ORACLES
from doorstep.llm.queries import all_queries
from duck import rows as duck_rows, same

CLEAN = " ".join(f"word{i}" for i in range(60))


def judged(df):
    return {r.doc_id: r for r in host_quality.judge(df).collect()}


def test_matches_sql(spark, small):
    name = "op7_host_quality"
    same(all_queries()[name](spark, small), duck_rows(ORACLES[name], small))


def test_measures(docs):
    text = "a b c x a b c\n\n  \na#b <c>\na#b <c>\n\ta#b <c>\n" + CLEAN
    got = judged(docs((1, text), (2, None), (3, ""), (4, "\t \x0b"), (None, "one  two")))
    assert (got[1].n_words, got[1].n_symbols, got[1].n_dup_lines) == (73, 9, 1)
    # Both runs of "a b c" and the three lines' words; the windows across them occur twice as well.
    assert got[1].n_repeat_words == 12
    assert got[1].word_chars == len("".join(text.split()))
    for empty in (2, 3, 4):
        assert got[empty][1:6] == (0, 0, 0, 0, 0) and got[empty].base_failed
    assert got[None].n_words == 2


def test_repeats_by_brute_force(docs):
    import random

    rng = random.Random(5)
    texts = [(i, " ".join(rng.choice("abcd") for _ in range(rng.randint(0, 60)))) for i in range(60)]
    got = judged(docs(*texts))
    for i, text in texts:
        words = text.split()
        windows = [tuple(words[j : j + 3]) for j in range(len(words) - 2)]
        covered = {k for j, w in enumerate(windows) if windows.count(w) > 1 for k in range(j, j + 3)}
        assert got[i].n_repeat_words == len(covered)


def test_hosts(docs):
    junk = " ".join(f"w{i}###" for i in range(60))
    bad = [(i, junk, "bad") for i in range(400)] + [(900, CLEAN, "bad")]
    good = [(1000 + i, CLEAN, "good") for i in range(400)] + [(1900, junk, "good")]
    got = judged(docs(*bad, *good, (2000, CLEAN, None), (2001, junk, "one-off"), (2002, "short", None)))
    assert not got[900].kept, "a rejected host loses its clean documents"
    assert got[1000].kept and got[1900].kept, "a trusted host keeps one that fails a soft rule"
    assert got[2000].kept and not got[2002].kept
    # One failing document does not get its host rejected by itself: the rate is shrunk.
    rates = host_quality.host_rates(
        host_quality.failures(host_quality.measure(docs(*bad, *good, (1, junk, "one-off"))), host_quality.HostRules())
    )
    rate = {r.host: r.symbols_rate for r in rates.collect()}
    assert 0.4 < rate["one-off"] < 1 and rate["good"] < 0.01


def test_edges(spark, docs):
    assert host_quality.judge(docs().limit(0)).count() == 0
    twice = docs((1, CLEAN), (1, CLEAN)).selectExpr("*", "1 as host", "2 as words", "3 as kept_id")
    assert host_quality.judge(twice).count() == 2
    kept = host_quality.keep_documents(twice)
    assert kept.columns == twice.columns and kept.count() == 2
    long_text = " ".join(str(i) for i in range(200_000)) + " 5 6 7"
    assert judged(docs((1, long_text)))[1].n_repeat_words == 6


def test_repeats_are_counted_by_their_words_whatever_the_hash(docs, monkeypatch):
    import random

    from pyspark.sql import functions as F

    rng = random.Random(3)
    texts = [" ".join(rng.choices("a b c d e f g h".split(), k=n)) for n in (0, 2, 3, 4, 5, 30, 120, 300)]
    want = {}
    for k, text in enumerate(texts):
        tokens = text.split()
        windows = [tuple(tokens[i : i + 3]) for i in range(len(tokens) - 2)]
        again = {i for i, w in enumerate(windows) if windows.count(w) > 1}
        want[k] = len({i + j for i in again for j in range(3)})
    df = docs(*enumerate(texts))

    def counted():
        return {r.doc_id: r.n_repeat_words for r in host_quality.measure(df).collect()}

    assert counted() == want
    full = F.xxhash64
    monkeypatch.setattr(F, "xxhash64", lambda *cols: F.pmod(full(*cols), F.lit(5)))
    assert counted() == want
