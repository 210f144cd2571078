from collections import defaultdict

from pyspark.sql import functions as F

from doorstep.llm import line_spread
from doorstep.llm.oracles import ORACLES
from doorstep.llm.queries import all_queries
from duck import rows as duck_rows, same


def test_matches_sql(spark, small):
    name = "op4_line_spread"
    want = duck_rows(ORACLES[name], small)
    assert sum(r["n_removed"] for r in want) > 0
    same(all_queries()[name](spark, small), want)


def corpus():
    rows = []
    for i in range(40):
        lines = [f"own line {i}", " shared by all\t", f"shared by {i % 4}", f"of {i % 6} sites", "", "  "]
        rows.append((i, "\n".join(lines), f"site{i % 12}" if i % 12 else None))
    # A line repeated on one site, and one on exactly the threshold, with copies.
    rows += [(100 + i, "one site only\none site only", "site1") for i in range(30)]
    rows += [(200 + i, "on five", f"site{i % 5 + 1}") for i in range(15)]
    rows += [(300 + i, "on four", f"site{i % 4 + 1}") for i in range(15)]
    return rows + [(400, None, "x"), (401, "", None), (None, "shared by all", "x"), (200, "on five", "site1")]


def brute(rows, least=5):
    sites = defaultdict(set)
    for _, text, site in rows:
        for line in (text or "").split("\n"):
            sites[line.strip()].add(site)
    out = []
    for doc, text, _ in rows:
        lines = [x.strip() for x in (text or "").split("\n") if x.strip()]
        gone = [x for x in lines if len(sites[x]) >= least]
        out.append((doc, len(lines), len(gone), sum(map(len, gone))))
    return sorted(out, key=repr)


def test_by_brute_force(docs):
    rows = corpus()
    df = docs(*rows).repartition(4).selectExpr("*", "1 as row", "2 as h", "3 as lines")
    assert sorted((tuple(r) for r in line_spread.line_counts(df).collect()), key=repr) == brute(rows)
    assert line_spread.line_counts(df.limit(0)).count() == 0


def test_near_the_threshold_counts_are_exact(docs):
    hashed = line_spread.hashed_lines(docs(*corpus()))
    found = {r.sites: r.exact for r in line_spread.boilerplate(hashed).collect()}
    assert found[5] and not found[13]


def test_cleaned_text(docs):
    rows = [r for r in corpus() if r[0] not in (None, 200)]
    df = docs(*rows)
    got = {r.doc_id: r for r in line_spread.clean_documents(df).collect()}
    assert line_spread.clean_documents(df).columns == df.columns and len(got) == len(rows)
    assert got[1].text == "own line 1\nshared by 1\nof 1 sites\n\n  ".replace("shared by 1\n", "shared by 1\n")
    assert got[400].text is None and got[201].text == "" and got[201].n_chars == 0 and got[300].text == "on four"


def test_counts_come_from_the_cleaned_texts(docs, monkeypatch):
    rows = corpus()
    cut = line_spread._cut
    monkeypatch.setattr(line_spread, "_cut", lambda d, s: cut(d, s).withColumn("cleaned", F.lit("")))
    got = {(r.n_lines, r.n_removed) for r in line_spread.line_counts(docs(*rows)).collect()}
    assert got and all(n == gone for n, gone in got)


def test_every_line_gets_a_sketch(docs, monkeypatch):
    hashed = line_spread.hashed_lines(docs(*corpus()))
    plans, settled = {}, line_spread.settled

    def watched(df, label):
        plans[label] = df._jdf.queryExecution().optimizedPlan().toString()
        return settled(df, label)

    monkeypatch.setattr(line_spread, "settled", watched)
    line_spread.boilerplate(hashed).count()
    # No plainer count decides beforehand which lines are sketched.
    assert set(plans) == {"line-spread", "boilerplate"} and "Join" not in plans["line-spread"]


def test_a_long_text_and_rows_without_an_id(docs):
    long = "\n".join(f"line {i}" for i in range(30_000))
    rows = [(None, f"{long}\nown {i}", f"s{i}") for i in range(6)]
    got = line_spread.line_counts(docs(*rows)).collect()
    assert sorted(tuple(r)[:3] for r in got) == [(None, 30_001, 30_000)] * 6
    cleaned = [r.text for r in line_spread.clean_documents(docs(*rows)).collect()]
    assert sorted(cleaned) == [f"own {i}" for i in range(6)]
