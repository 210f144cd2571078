import hashlib
import math
import random
import re
from collections import defaultdict

import pytest

from doorstep.llm import pii
from doorstep.llm.oracles import ORACLES
from doorstep.llm.queries import all_queries
from duck import rows as duck_rows, same

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind != "phone" or 9 <= len(digits) <= 15


def base_spans(text):
    return [
        (kind, m.start(), m.end())
        for kind, pattern in PATTERNS.items()
        for m in re.finditer(pattern, text)
        if valid(kind, m[0])
    ]


def brute_row(doc_id, text, terms=()):
    base = base_spans(text or "")
    named = [":".join(map(str, s)) for s in base]
    more = [f"term:{m.start()}:{m.end()}" for m in re.finditer(r"[^\W\d_]+", text or "") if m[0].lower() in terms]
    counts = [sum(s[0] == k for s in base) for k in PATTERNS]
    return (doc_id, *counts, hashlib.sha256(",".join(named).encode()).hexdigest(), ",".join(named + more))


def card(rng, n):
    digits = [str(rng.randrange(10)) for _ in range(n - 1)]
    return next("".join(digits) + str(c) for c in range(10) if luhn("".join(digits) + str(c)))


def random_texts(seed, n):
    rng = random.Random(seed)
    atoms = [
        "a@b.c", "a.b+c@d-e.f.g_h@i.j", "x@y", "@", "..", "1.2.3.4", "256.1.1.1", "01.002.3.255.7.8.9.1", "1.2.3", "+1 (132) 555-1352",
        "+12", "+1234567890123456", "+ 1", "é", "😀", " ", " ", "\n", "-", "4", "12 34-5", "0000000000000", "word", "_", "%", "\x85",
    ]
    atoms += [card(rng, k) for k in range(12, 21)] + [" ".join(re.findall("....", card(rng, 16)))]
    return ["".join(rng.choices(atoms, k=rng.randint(0, 30))) for _ in range(n)]


def test_matches_sql(spark, small):
    name = "op12_pii"
    same(all_queries()[name](spark, small), duck_rows(ORACLES[name], small))


def test_base_spans_by_brute_force(docs):
    rows = [(i % 190 or None, t) for i, t in enumerate(random_texts(1, 250))]
    rows += [(7, None), (8, ""), (9, "a@b.cc"), (9, "a@b.cc"), (None, "a@b.cc"), (None, "a@b.cc")]
    df = docs(*rows).selectExpr("*", "1 as key", "2 as kind", "3 as body", "4 as spots")
    got = sorted((tuple(r) for r in pii.personal_data(df).collect()), key=repr)
    assert got == sorted((brute_row(*r) for r in rows), key=repr)


def test_very_long_texts(docs):
    texts = {
        1: "a" * 300_000,
        2: "1" * 200_000 + ".",
        3: "1 " * 100_000,
        4: "a@b" + ".c" * 100_000,
        5: "+1" + "-" * 200_000,
        6: "x@y.z 1.2.3.4 +1 (132) 555-1352\n" * 3000,
    }
    got = {r.doc_id: tuple(r) for r in pii.personal_data(docs(*texts.items())).collect()}
    assert got[6] == brute_row(6, texts[6])
    assert {i: r[-1] for i, r in got.items() if i != 6} == {1: "", 2: "", 3: "", 4: f"email:0:{len(texts[4])}", 5: ""}


@pytest.fixture
def told(docs):
    """Documents in which some words go with one address, some with many things."""
    rng = random.Random(4)
    common = [f"common{'abcdefghij'[i]}" for i in range(10)]
    make = lambda n: " ".join(rng.choices(common, k=n))
    rows = [(i, make(30)) for i in range(400)]
    for i in range(6):
        rows.append((1000 + i, f"{make(9)} Zephyrine writes from zeph@mail.example.com often {make(6 + i)}"))
    rows.append((1100, f"{make(5)} ZEPHYRINE came {make(5)}"))
    # Copies of one text are one text: its words disclose nothing.
    rows += [(1200 + i, f"{make(0)}quixotic plan by solo@mail.example.com {'commona ' * 9}") for i in range(20)]
    return rows, docs(*rows)


def test_terms_by_brute_force(told):
    rows, df = told
    texts = {t for _, t in rows}
    near, whole, held = defaultdict(set), defaultdict(set), defaultdict(set)
    for t in texts:
        for w in re.findall(r"[^\W\d_]+", t.lower()):
            held[w].add(t)
        for kind, start, end in base_spans(t):
            entity = (kind, t[start:end].lower())
            whole[entity].add(t)
            for w in (re.findall(r"[^\W\d_]+", t[:start])[-5:] + re.findall(r"[^\W\d_]+", t[end:])[:5]):
                if len(w) >= 4:
                    near[entity, w.lower()].add(t)
    n, terms = len(texts), set()
    for (entity, w), both in near.items():
        if len(both) >= 3 and len(whole[entity]) >= 3:
            share = math.log(n * len(both) / (len(held[w]) * len(whole[entity]))) / math.log(n / len(whole[entity]))
            if share >= 0.9:
                terms.add(w)
    assert "zephyrine" in terms and not terms & {"quixotic", "commona"}
    got = sorted(tuple(r) for r in pii.personal_data(df).collect())
    assert got == sorted(brute_row(*r, terms) for r in rows)
    assert any(r[0] == 1100 and "term:" in r[-1] for r in got)
    clean = {r.doc_id: r.text for r in pii.sanitised(df).collect()}
    assert "zeph" not in clean[1000].lower() and "[EMAIL]" in clean[1000] and "ZEPHYRINE" not in clean[1100]
    assert all(clean[i] == t for i, t in rows if i < 400)


def test_sanitised_text(docs):
    rows = [(1, "é 😀 mail a@1.2.3.4 now"), (2, None), (3, "clean"), (None, "+1 (132) 555-1352"), (None, "+1 (132) 555-1352")]
    df = docs(*rows).selectExpr("*", "1 as key", "2 as cuts", "3 as row")
    clean = pii.sanitised(df)
    assert clean.columns == df.columns
    got = sorted(((r.doc_id, r.text) for r in clean.collect()), key=repr)
    assert got == sorted([(1, "é 😀 mail [EMAIL] now"), (2, None), (3, "clean"), (None, "[PHONE]"), (None, "[PHONE]")], key=repr)


def test_empty_and_native(docs, spark, small):
    assert pii.personal_data(docs().limit(0)).count() == 0
    plan = pii.personal_data(docs((1, "a@b.c")))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
