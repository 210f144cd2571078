"""Personal data by patterns, and terms that disclose it by what the corpus tells of them. Built-in functions only.

Base spans are the matches of four patterns that pass their kind's test. The values found are the protected
entities. A term (a run of letters, in lower case) that stands within ``window`` words of an entity is in its context.
With counts over the distinct texts of the whole corpus, N of them,

    IC(entity) = ln(N / texts of the entity)
    PMI(term, entity) = ln(N * texts with both in context / (texts of the term * texts of the entity))

the term discloses the share PMI / IC of the entity's information. From ``generalise`` on, the term is a span in
every text that holds it, as whoever knows the corpus infers the entity from it: it is replaced by the kind of
what it discloses, and from ``remove`` on it is left out. What is seen in fewer than ``support`` texts is no evidence.

Contexts are linear in the text: a match takes words from the stretches between its kind's matches only. Positions are
running sums over the stretches and matches of one text. Copies of a text count once, so that a page copied
a thousand times does not make its words disclose.

Rows with equal ``doc_id`` and text are worked out once and each get the result. Null: a null text is empty, a null
``doc_id`` is a value like any other. Overlapping spans of different kinds all count; sanitised texts replace their union.
Empty tables give no rows. Extra columns are ignored, and kept in sanitised documents.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from doorstep.llm.tables import settled

#: The kinds of base spans in their order. A match of ``[0-9][0-9 -]*`` and the like never gives
#: characters back, which possessive quantifiers say. A pattern that starts with a repeated class starts only where
#: the class or the last match ends, so that long runs are read once; the matches are the same.
EMAIL_CHARS = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{EMAIL_CHARS})){EMAIL_CHARS}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
KINDS = tuple(PATTERNS)
TERM = "term"
LETTERS = r"\p{L}+"
NAMES = (*KINDS, TERM)


@dataclass(frozen=True)
class Disclosure:
    #: Words on each side of an entity, and the letters of a term at least.
    window: int = 5
    letters: int = 4
    #: Distinct texts that hold an entity, and a term in its context, at least.
    support: int = 3
    generalise: float = 0.9
    remove: float = 0.97


def _matches(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _valid_ip(value: Column) -> Column:
    def small(part: Column) -> Column:
        digits = F.ltrim(part, F.lit("0"))
        return F.when(F.length(digits) > 3, False).otherwise(F.coalesce(digits.try_cast("int"), F.lit(0)) <= 255)

    return F.forall(F.split(value, r"\."), small)


def _valid_card(value: Column) -> Column:
    digits = F.translate(value, " -", "")

    def add(total: Column, at: Column) -> Column:
        digit = F.substring(digits, -at, F.lit(1)).cast("int")
        doubled = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return total + F.when(at % 2 == 0, doubled).otherwise(digit)

    luhn = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0
    return F.when(F.length(digits).between(13, 19), luhn).otherwise(False)


VALID = {
    "email": lambda v: F.lit(True),
    "ip": _valid_ip,
    "card": _valid_card,
    "phone": lambda v: F.length(F.translate(v, "+ ().-", "")).between(9, 15),
}
ENTITY = {
    "email": F.lower,
    "ip": lambda v: v,
    "card": lambda v: F.translate(v, " -", ""),
    "phone": lambda v: F.translate(v, "+ ().-", ""),
}


def _body(docs: DataFrame) -> DataFrame:
    """doc_id, body (never null) and its key."""
    bodies = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("body"))
    return bodies.withColumn("key", F.sha2("body", 256))


def _kind_spots(kind: str, number: int, window: int) -> Column:
    """Every match of one kind with the length of the stretch before it and the words around it."""
    matches, gaps = F.col(f"{kind}_matches"), F.col(f"{kind}_gaps")

    def words(stretch: Column) -> Column:
        return F.transform(_matches(stretch, LETTERS), F.lower)

    def spot(value: Column, i: Column) -> Column:
        before, after = words(F.get(gaps, i)), words(F.get(gaps, i + 1))
        near = F.concat(F.slice(F.reverse(before), 1, window), F.slice(after, 1, window))
        ok = VALID[kind](value)
        return F.struct(
            F.lit(number).alias("kind"),
            i.alias("place"),
            F.length(F.get(gaps, i)).alias("gap"),
            F.length(value).alias("size"),
            ok.alias("ok"),
            F.when(ok, ENTITY[kind](value)).alias("entity"),
            F.when(ok, near).alias("near"),
        )

    return F.transform(matches, spot)


def spots(docs: DataFrame, window: int) -> DataFrame:
    """doc_id, key and all pattern matches of every row."""
    body = F.col("body")
    here = {"email": body.contains("@"), "phone": body.contains("+")}
    found = _body(docs)
    none = F.array().cast("array<string>")
    for kind, pattern in PATTERNS.items():
        matches = _matches(body, pattern)
        found = found.withColumn(f"{kind}_matches", F.when(here[kind], matches).otherwise(none) if kind in here else matches)
    for kind, pattern in PATTERNS.items():
        gaps = F.when(F.size(f"{kind}_matches") > 0, F.split(body, pattern, -1))
        found = found.withColumn(f"{kind}_gaps", gaps)
    lists = [_kind_spots(kind, k, window) for k, kind in enumerate(KINDS)]
    return found.select("doc_id", "key", F.concat(*lists).alias("spots"))


def base_spans(rows: DataFrame) -> DataFrame:
    """doc_id, key, kind, start, end, entity and near of every span that passes its test, once for equal rows."""
    each = rows.where(F.exists("spots", lambda s: s["ok"])).select("doc_id", "key", F.explode("spots").alias("s"))
    each = each.select("doc_id", "key", "s.*").distinct()
    order = Window.partitionBy("doc_id", "key", "kind").orderBy("place")
    passed = F.sum(F.col("gap") + F.col("size")).over(order)
    return (
        each.withColumn("end", passed)
        .where("ok")
        .select("doc_id", "key", "kind", (F.col("end") - F.col("size")).alias("start"), "end", "entity", "near")
    )


def context_terms(spans: DataFrame, n_texts: int, rule: Disclosure) -> DataFrame:
    """kind, entity, term, n_entity and n_both: distinct texts with the entity, and with the term in its context.

    A term is in at least as many texts as it is in the contexts of any entities. What disclosed too little if it
    were in those alone, as common words do, is left out here, before the corpus is asked.
    """
    entity = ["kind", "entity"]
    near = spans.select(*entity, "key", F.explode("near").alias("term")).where(F.length("term") >= rule.letters)
    texts = near.select("term", "key").distinct().groupBy("term").agg(F.count("*").alias("n_term"))
    whole = spans.groupBy(*entity).agg(F.countDistinct("key").alias("n_entity")).where(F.col("n_entity") >= rule.support)
    both = near.distinct().groupBy(*entity, "term").agg(F.count("*").alias("n_both")).where(F.col("n_both") >= rule.support)
    at_most = both.join(whole, entity).join(texts, "term").withColumn("at_most", disclosure(n_texts))
    # A hair below the threshold: the same sum may round differently when n_term is larger.
    return at_most.where(F.col("at_most") >= rule.generalise - 1e-9).drop("n_term", "at_most")


def disclosure(n_texts: int) -> Column:
    """The share of an entity's information that a term gives away; null for an entity that is in every text."""
    bits = F.log(n_texts * F.col("n_both") / (F.col("n_term") * F.col("n_entity")))
    return F.when(F.col("n_entity") < n_texts, bits / F.log(n_texts / F.col("n_entity")))


def _held_terms(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """doc_id, key and term of every document and each of ``terms`` (term) that it holds."""
    words = F.array_distinct(F.transform(F.array_distinct(_matches(F.col("body"), LETTERS)), F.lower))
    return _body(docs).select("doc_id", "key", F.explode(words).alias("term")).join(terms, "term")


def disclosing_terms(docs: DataFrame, rows: DataFrame, spans: DataFrame, rule: Disclosure) -> tuple[DataFrame, DataFrame]:
    """Terms with their disclosure and the kind of what they disclose most of, and the documents that hold them."""
    n_texts = rows.select("key").distinct().count()
    candidates = settled(context_terms(spans, n_texts, rule), "context-terms")
    held = settled(_held_terms(docs, candidates.select("term").distinct()), "held-terms")
    n_terms = held.select("key", "term").distinct().groupBy("term").agg(F.count("*").alias("n_term"))
    each = candidates.join(n_terms, "term").withColumn("disclosure", disclosure(n_texts)).where(F.col("disclosure") >= rule.generalise)
    most = each.groupBy("term").agg(
        F.max("disclosure").alias("disclosure"),
        F.min_by("kind", F.struct((-F.col("disclosure")).alias("less"), F.col("kind"), F.col("entity"))).alias("reveals"),
    )
    most = settled(most, "disclosing-terms")
    return most, held.join(most, "term")


def term_spans(docs: DataFrame, held: DataFrame) -> DataFrame:
    """doc_id, key, start, end, disclosure and reveals of every place of a disclosing term."""
    keys = held.select(F.col("doc_id").alias("of"), F.col("key").alias("same")).distinct()
    bodies = _body(docs)
    bodies = bodies.join(keys, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("key") == F.col("same")), "left_semi")
    # Equal rows have equal places; only their numbers are exploded, not the text.
    placed = (
        bodies.withColumn("runs", _matches(F.col("body"), LETTERS))
        .withColumn("gaps", F.split("body", LETTERS, -1))
        .select(
            "doc_id",
            "key",
            F.posexplode(F.transform("runs", lambda w, i: F.struct(F.lower(w).alias("term"), F.length(w).alias("size"), F.length(F.get("gaps", i)).alias("gap")))),
        )
        .select("doc_id", "key", "pos", "col.*")
        .distinct()
    )
    order = Window.partitionBy("doc_id", "key").orderBy("pos")
    placed = placed.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(order))
    wanted = held.select("term", "disclosure", "reveals").distinct()
    return placed.join(wanted, "term").select(
        "doc_id", "key", (F.col("end") - F.col("size")).alias("start"), "end", "disclosure", "reveals"
    )


SPAN = ("doc_id", "key", "kind", "start", "end", "label")


def all_spans(docs: DataFrame, rule: Disclosure = Disclosure()) -> tuple[DataFrame, DataFrame]:
    """The rows with their keys, and every span with its kind and what replaces it."""
    rows = settled(spots(docs, rule.window), "pii-rows")
    base = settled(base_spans(rows), "pii-spans")
    _, held = disclosing_terms(docs, rows, base, rule)
    terms = term_spans(docs, held)
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    near = F.array(*[F.lit(f"[NEAR {k.upper()}]") for k in KINDS])
    base = base.withColumn("label", F.get(names, "kind")).select(*SPAN)
    label = F.when(F.col("disclosure") >= rule.remove, "").otherwise(F.get(near, "reveals"))
    terms = terms.withColumns({"kind": F.lit(len(KINDS)), "label": label}).select(*SPAN)
    return rows.select("doc_id", "key"), settled(base.unionByName(terms), "pii-all-spans")


def _joined(spans: Column) -> Column:
    name = F.array(*[F.lit(n) for n in NAMES])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def personal_data(docs: DataFrame, rule: Disclosure = Disclosure()) -> DataFrame:
    """Counts of base spans, their digest and all spans of every row."""
    rows, spans = all_spans(docs, rule)
    one = F.sort_array(F.collect_list(F.struct("kind", "start", "end")))
    found = spans.groupBy(F.col("doc_id").alias("of"), F.col("key").alias("same")).agg(one.alias("spans"))
    met = rows.join(found, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("key") == F.col("same")), "left")
    met = met.withColumn("spans", F.coalesce("spans", F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>")))
    number = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] < len(KINDS))
    return met.select(
        "doc_id",
        *[number(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)],
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )


def sanitised(docs: DataFrame, rule: Disclosure = Disclosure()) -> DataFrame:
    """The documents with their own columns, personal data replaced by its kind and disclosing terms by what they disclose."""
    _, spans = all_spans(docs, rule)
    order = Window.partitionBy("doc_id", "key").orderBy("start", F.desc("end"), "kind")
    before = F.coalesce(F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # Of overlapping spans the first gives the label; the others only take what sticks out.
    cuts = spans.withColumn("before", before).where("end > before")
    cut = F.struct(
        F.greatest("start", "before").alias("start"),
        F.col("end"),
        F.when(F.col("start") >= F.col("before"), F.col("label")).otherwise("").alias("label"),
    )
    cuts = cuts.groupBy(F.col("doc_id").alias("of"), F.col("key").alias("same")).agg(F.sort_array(F.collect_list(cut)).alias("cuts"))
    rows = docs.select(F.struct("*").alias("row"), "doc_id", F.coalesce("text", F.lit("")).alias("body"))
    rows = rows.withColumn("key", F.sha2("body", 256))
    met = rows.join(cuts, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("key") == F.col("same")), "left")

    def kept(c: Column, i: Column) -> Column:
        start = F.when(i == 0, F.lit(0)).otherwise(F.get("cuts", i - 1)["end"])
        return F.concat(F.substring(F.col("body"), (start + 1).cast("int"), (c["start"] - start).cast("int")), c["label"])

    rest = F.substring(F.col("body"), (F.element_at("cuts", -1)["end"] + 1).cast("int"), F.length("body"))
    clean = F.concat(F.array_join(F.transform("cuts", kept), ""), rest)
    text = F.when(F.col("cuts").isNull(), F.col("row.text")).otherwise(clean)
    return met.select(*[text.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])
