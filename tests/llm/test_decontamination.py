import random
from collections import Counter

import pytest

from doorstep.llm import decontamination as d


def item_scores(index, query):
    """Scores of all items by their definition."""
    total = Counter()
    for t in query:
        for i, s in zip(index.items[t], index.scores[t]):
            total[int(i)] += float(s)
    return total


@pytest.fixture(scope="module")
def index():
    rng = random.Random(2)
    vocabulary = [f"w{int(rng.paretovariate(0.7))}" for _ in range(4000)]
    return d.ItemIndex([(i, " ".join(rng.choices(vocabulary, k=rng.randint(6, 60)))) for i in range(150)])


@pytest.mark.parametrize("threshold", [0.05, 0.2, 0.6])
def test_wand_finds_all_above_the_threshold(index, threshold):
    rng = random.Random(4)
    for _ in range(60):
        query = set(rng.sample(range(len(index.terms)), 40))
        if rng.random() < 0.5:
            query |= {index.terms[t] for t in rng.choice(index.words)[:20]}
        want = {i: s for i, s in item_scores(index, query).items() if s >= threshold}
        assert dict(index.search(query, threshold)) == pytest.approx(want)


def test_own_score_is_one(index):
    for k in range(0, 150, 10):
        assert dict(index.search({index.terms[t] for t in index.words[k]}, 0.99))[k] == pytest.approx(1)


def test_screen_loses_nothing(index):
    rng = random.Random(6)
    texts = []
    for _ in range(80):
        words = [f"w{int(rng.paretovariate(0.7))}" for _ in range(rng.randint(0, 400))]
        at = rng.randint(0, len(words))
        item = [t.decode() for t in rng.choice(index.words)]
        texts.append(" ".join(words[:at] + item + words[at:]))
    want = set()
    for k, text in enumerate(texts):
        tokens = d.terms(text)
        for at in range(-index.step, len(tokens), index.step):
            window = tokens[max(0, at) : at + 2 * index.step]
            query = {index.terms[t] for t in window if t in index.terms}
            want |= {(k, i) for i, s in item_scores(index, query).items() if s >= 0.6}
    got = d.matches(index, texts, 0.6, 0.0)
    assert {(k, index.ids[i]) for k, i in want} == set(got) and len(want) >= 80


def test_question_and_answer():
    assert d.question_and_answer("One two? Three.\nFour five.") == ("One two? Three.", "Four five.")
    assert d.question_and_answer("only one") == ("only one", "only one")
    assert d.question_and_answer(None) == ("", "")


def test_pairs_by_brute_force(spark, docs):
    rng = random.Random(1)
    words = [f"t{i}" for i in range(500)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(12, 50))) + ". " + " ".join(rng.choices(words, k=5)) + ".") for i in range(30)]
    items += [(40, None), (41, ""), (42, items[3][1]), (43, " ".join(rng.choices(words, k=700)))]
    texts = []
    for i in range(60):
        body = rng.choices(words, k=rng.randint(0, 300))
        if i % 3:
            at = rng.randint(0, len(body))
            body[at:at] = items[rng.randrange(30)][1].upper().split()
        texts.append((i, " ".join(body)))
    texts += [(60, None), (61, ""), (62, "x " * 9000 + items[0][1] + " y" * 9000), (63, items[43 - 10][1])]
    texts += [texts[1], (64, items[5][1].rsplit(". ", 1)[0] + " and another ending altogether here.")]
    got = {
        (r.doc_id, r.item_id)
        for r in d.contaminated(docs(*texts), spark.createDataFrame(items, "item_id long, text string")).collect()
    }
    want = set()
    for i, text in texts:
        stand, seen = d.shingles(d.terms(text)), Counter(d.terms(text))
        for item, body in items:
            own = d.shingles(d.terms(body))
            parts = [Counter(d.terms(p)) for p in d.question_and_answer(body)]
            if d.terms(body) and len(own & stand) >= 0.8 * len(own) and all(d._share(p, seen) >= 0.8 for p in parts):
                want.add((i, item))
    assert got == want and len(want) > 40 and (64, 5) not in got


def test_edges(spark, docs):
    items = spark.createDataFrame([(1, "some question is asked here? yes")], "item_id long, text string")
    df = docs((1, "before some question is asked here? yes after"), (2, "fine"), (None, None))
    df = df.selectExpr("*", "7 as item_id", "8 as score")
    assert [r.doc_id for r in d.keep_clean(df, items).collect()] in ([2, None], [None, 2])
    assert d.keep_clean(df, items).columns == df.columns
    assert d.contaminated(df.limit(0), items).count() == 0
    assert d.contaminated(df, items.limit(0)).count() == 0


@pytest.mark.parametrize("answer", ["yes", "yes sir", "a short one", "only four words here"])
def test_short_answers_and_questions_may_have_a_word_altered(answer):
    long = " ".join(f"w{i}" for i in range(40))
    altered = " ".join([*answer.split()[:-1], "altered"])
    items = [(1, f"{long}? {answer}."), (2, f"{answer}? {long}x.")]
    index = d.ItemIndex(items)
    texts = [f"before {long}? {altered}. after", f"{'other ' + answer.partition(' ')[2]}? {long}x."]
    got = d.matches(index, texts, 0.6, 0.8)
    assert {(0, 1), (1, 2)} <= set(got) and all(m.overlap >= 0.8 for m in got.values())


def test_a_short_answer_lacks_one_word_at_most():
    long = " ".join(f"w{i}" for i in range(40))
    index = d.ItemIndex([(1, f"{long}? three words here.")])
    assert not d.matches(index, [f"{long}? three others now.", f"{long}"], 0.6, 0.8)


def test_scores_are_those_of_the_whole_benchmark_and_parts_are_bounded(spark, docs, monkeypatch):
    rng = random.Random(9)
    words = [f"t{int(rng.paretovariate(0.6))}" for _ in range(600)]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([20, 40, 90, 300])))) for i in range(24)]
    items += items[:1] * 200
    table = spark.createDataFrame(items, "item_id long, text string")
    texts = docs(*[(k, " ".join(text.split()[: 1 + 9 * len(text.split()) // 10])) for k, text in items[:24]])
    whole = d.ItemIndex(sorted(set(items)))
    sizes = []

    def recorded(docs, index, *limits, search=d._search):
        sizes.append(len(index.ids))
        return search(docs, index, *limits)

    monkeypatch.setattr(d, "BLOCK_WORDS", 200)
    monkeypatch.setattr(d, "_search", recorded)
    got = {r.doc_id: r.score for r in d.contaminated(texts, table).where("doc_id = item_id").collect()}
    assert sum(sizes) == 24 and len(sizes) > 6
    assert len(got) == 24
    for k, text in items[:24]:
        kept = d.terms(text)[: 1 + 9 * len(text.split()) // 10]
        query = {whole.terms[t] for t in kept}
        assert got[k] == pytest.approx(item_scores(whole, query)[whole.ids.index(k)])


def edits_by_table(item, tokens):
    """Least word edits of the item into any stretch, by the whole table of distances."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for word in tokens:
        new = [0]
        for k, own in enumerate(item):
            new.append(min(row[k] + (own != word), row[k + 1] + 1, new[k] + 1))
        row = new
        best = min(best, row[-1])
    return best


def test_fewest_edits_by_brute_force():
    rng = random.Random(12)
    for _ in range(400):
        item = [b"%d" % rng.randrange(6) for _ in range(rng.randint(1, 70))]
        tokens = [b"%d" % rng.randrange(6) for _ in range(rng.randint(0, 90))]
        if rng.random() < 0.5:
            at = rng.randint(0, len(tokens))
            tokens[at:at] = [w for w in item if rng.random() > 0.1]
        assert d.fewest_edits(item, tokens)[0] == edits_by_table(item, tokens)
    item = b"a b c d e f".split()
    assert d.fewest_edits(item, b"x a b q d e f y a b".split()) == (1, 7)
    assert d.fewest_edits(item, []) == (6, 0)


def altered(rng, words, text, n, how):
    """The text with ``n`` words at random places replaced, left out or preceded by others."""
    tokens = text.split()
    for at in sorted(rng.sample(range(len(tokens)), n), reverse=True):
        # The last word of a sentence keeps its mark.
        mark = tokens[at][-1] if tokens[at][-1] in "?." else ""
        other = rng.choice(words) + mark
        tokens[at : at + 1] = {"replaced": [other], "left out": [mark][: bool(mark)], "put in": [rng.choice(words), tokens[at]]}[how]
    return " ".join(tokens)


@pytest.mark.parametrize("how", ["replaced", "left out", "put in"])
def test_recall_of_altered_copies(how):
    rng = random.Random(21)
    words = [f"t{int(rng.paretovariate(0.5)) % 5000}" for _ in range(3000)]
    items = []
    for i in range(120):
        asked = rng.choices(words, k=rng.randint(10, 50))
        items.append((i, " ".join(asked) + "? " + " ".join(rng.choices(words, k=rng.randint(5, 9))) + "."))
    index = d.ItemIndex(items)
    for n, least in ((1, 0.98), (2, 0.9)):
        texts = []
        for _, text in items:
            pads = [" ".join(rng.choices(words, k=80)) for _ in range(2)]
            texts.append(f"{pads[0]} {altered(rng, words, text, n, how)} {pads[1]}")
        got = set(d.matches(index, texts, 0.6, 0.8))
        assert len({k for k, i in got if k == i}) >= least * len(items), (how, n)
        assert not {(k, i) for k, i in got if k != i}


def test_too_much_altered_and_out_of_order_is_no_copy():
    long = [f"w{i}" for i in range(30)]
    index = d.ItemIndex([(1, f"{' '.join(long)}? the answer has six words."), (2, "just four short words")])
    rng = random.Random(5)
    shuffled = rng.sample(long, 30)
    far = [w if i % 3 else "x" for i, w in enumerate(long)]
    texts = [
        f"{' '.join(shuffled)}? the answer has six words.",
        f"{' '.join(far)}? the answer has six words.",
        # The question is there, the answer is another one.
        f"{' '.join(long)}? something else is said here.",
        "just four long words",
    ]
    assert not d.matches(index, texts, 0.6, 0.8)
