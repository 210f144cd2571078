"""Main text of web pages: the contiguous run of a page with the highest score.

A page is a sequence of tags and stretches of text. A stretch scores its number of words times the weight
of where it stands, a tag scores a negative weight of its own; a linear scan finds the run with the highest
sum. Weights are log odds learned from all pages that label their content themselves, by an ``article`` or
``main`` element: how often words in such a place, or such a tag, are inside against outside. What a
place is called (``footer``, ``class="content"``) is the prior, so pages without labels and names never seen
are judged as well.

Within the run, elements that are no part of an article by their name (menus, forms, adverts, reader
comments and the like) are left out. A class, id or role names such an element as a whole or by its last part
(``cookie-notice``, not ``comments-open``, ``menu-page-content`` or ``no-sidebar``); it never leaves out ``html``,
``body``, ``main``, ``article`` or what holds the page's own ``main`` or ``article``. The rest is given as blocks:
character references decoded, white space turned into one space, blocks joined by an empty line.

A null or empty html has empty text; ``page_id`` and ``url`` pass through, nulls included. Repeated rows
each get a row. An empty table gives no rows. Extra columns are ignored. The first of equal runs is taken.
"""

import html
import math
import re
from collections import ChainMap, defaultdict
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from doorstep.llm.tables import settled

#: Elements whose content is no text of the page.
RAW = ("script", "style", "noscript", "template", "textarea", "title", "svg", "iframe", "object")
#: Elements that are never part of an article.
ASIDE = {"nav", "footer", "aside", "form", "button", "select", "menu", "dialog", "head", *RAW}
#: Words in a class or id that name such an element, and those that name content.
ASIDE_NAMES = set(
    "ad ads advert advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist cookie "
    "cookies consent disqus disclaimer footer form header login masthead menu nav navbar navigation newsletter "
    "notice notices pagination popup promo promoted promotion recommended related replies reply respond search "
    "share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar widget".split()
)
#: Names of headers, which are part of an article inside of it.
HEADER_NAMES = {"header", "masthead"}
#: First parts of a class that tell of the page's layout instead of naming the element.
STATES = set("has hide no not show with without".split())
CONTENT_NAMES = set("article body content entry main post story text".split())
LABELS = {"article", "main"}
#: Elements that no class or id makes an aside.
FRAMES = {"html", "body", *LABELS}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set(
    "address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hr html legend li main nav ol option p pre section summary table tbody tfoot thead tr "
    "ul".split()
)
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: A start tag of the key ends an open element of the value.
ENDS = {"p": {"p"}, "li": {"li", "p"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}} | {
    b: {"p"} for b in BLOCKS - {"li", "p", "tr", "body", "html"}
}
#: Places whose counts go to all tasks, the most frequent ones; pages meet the others by a join.
PLACES = 5000

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|title|svg|iframe|object)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>",
    re.S | re.I,
)
_NAME = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_PART = re.compile(r"[a-z0-9]+")
_LABEL = re.compile(r"<(?:article|main)\b", re.I)


@dataclass
class Element:
    tag: str
    place: str
    aside: bool
    inside: bool


@dataclass
class Stretch:
    """A tag, or a stretch of text with the place it stands in."""

    place: str
    text: str | None = None
    words: int = 0
    aside: bool = False
    inside: bool = False
    nested: bool = False
    breaks: bool = False
    space: bool = False


def _names(attributes: str) -> tuple[list[str], set[str]]:
    """All parts of an element's class, id and role, and the names its classes give it: their last parts."""
    found, given = [], set()
    for value in _NAME.findall(attributes):
        for token in value.strip("\"'").lower().split():
            parts = _PART.findall(token)
            found += parts
            named = [p for p in parts if not p.isdigit()]
            if named and (len(named) == 1 or named[0] not in STATES):
                given.add(named[-1])
    return found, given


def _holders(tokens: list[re.Match]) -> set[int]:
    """Numbers of the start tags whose elements hold a ``main`` or ``article`` that is in no other one."""
    holders: set[int] = set()
    stack = [Element("html", "html", False, False)]
    numbers = [-1]
    for k, m in enumerate(tokens):
        tag = (m[3] or "").lower()
        if not tag:
            continue
        _close(stack, {tag} if m[2] else ENDS.get(tag, set()), whole=bool(m[2]))
        del numbers[len(stack) :]
        if not m[2] and tag not in VOID and not m[4].rstrip().endswith("/"):
            inside = stack[-1].inside
            if tag in LABELS and not inside:
                holders.update(numbers)
            stack.append(Element(tag, tag, False, inside or tag in LABELS))
            numbers.append(k)
    return holders


def stretches(page: str | None) -> Iterator[Stretch]:
    """The tags and texts of a page in order. Comments, scripts and the like do not appear."""
    page = page or ""
    stack: list[Element] = [Element("html", "html", False, False)]
    at = 0
    tokens = list(_TOKEN.finditer(page))
    holders = _holders(tokens) if _LABEL.search(page) else set()
    for k, m in enumerate(tokens):
        if m.start() > at:
            yield _text(page[at : m.start()], stack[-1])
        at = m.end()
        tag = (m[3] or "").lower()
        if not tag:
            continue
        if not m[2]:
            names, given = _names(m[4])
            _close(stack, ENDS.get(tag, set()), whole=False)
            up = stack[-1]
            aside = up.aside or tag in ASIDE or (tag == "header" and not up.inside)
            if not aside and tag not in FRAMES and k not in holders:
                aside = bool(given & (ASIDE_NAMES - HEADER_NAMES if up.inside else ASIDE_NAMES))
            inside = up.inside or tag in LABELS
            own = f"{tag}.{names[0]}" if names else tag
            # Inline elements other than links stand where their parent stands.
            place = own if tag in BLOCKS or tag == "a" or names else up.place
            if tag in BLOCKS and up.aside and not names and tag not in ASIDE:
                place = f"aside {tag}"
            spaced = tag in ("br", "td", "th", "img")
            yield Stretch(
                own, aside=aside, inside=inside, nested=up.aside, breaks=tag in BLOCKS, space=spaced
            )
            if tag not in VOID and not m[4].rstrip().endswith("/"):
                stack.append(Element(tag, place, aside, inside))
        else:
            up = stack[-1]
            _close(stack, {tag}, whole=True)
            yield Stretch(
                f"/{tag}",
                aside=up.aside,
                inside=up.inside,
                nested=up.aside,
                breaks=tag in BLOCKS,
                space=tag in ("td", "th"),
            )
    if at < len(page):
        yield _text(page[at:], stack[-1])


def _text(raw: str, up: Element) -> Stretch:
    text = html.unescape(raw)
    return Stretch(up.place, text, len(text.split()), up.aside, up.inside)


def _close(stack: list[Element], tags: set[str], whole: bool) -> None:
    """End the innermost open element of ``tags``; unless ``whole``, not beyond another block."""
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].tag in tags:
            del stack[k:]
            return
        if not whole and stack[k].tag in BLOCKS:
            return


@dataclass(frozen=True)
class Weights:
    """Counts inside and outside of labelled content, by place of words and by tag."""

    words: Mapping[str, tuple[int, int]] = field(default_factory=dict)
    tags: Mapping[str, tuple[int, int]] = field(default_factory=dict)

    def beside(self, own: "Weights") -> "Weights":
        """These weights with those of other places."""
        if not own.words and not own.tags:
            return self
        return Weights(ChainMap(own.words, self.words), ChainMap(own.tags, self.tags))

    def word(self, place: str, aside: bool) -> float:
        """Positive; close to zero where words are seldom content."""
        inside, outside = self.words.get(place, (0, 0))
        with_prior, against = _prior(place, aside)
        return min(4.0, max(0.001, math.log((inside + with_prior) / (outside + against))))

    def tag(self, part: "Stretch") -> float:
        """Negative; small for tags that are common in content, and inside what is left out anyway."""
        if part.nested:
            return -0.05
        place, aside = part.place, part.aside
        inside, outside = self.tags.get(place, (0, 0))
        with_prior, against = _prior(place.lstrip("/"), aside)
        return -min(2.0, max(0.05, math.log((outside + against) / (inside + with_prior)) + 1.0))


def _prior(place: str, aside: bool) -> tuple[float, float]:
    """Pseudo-counts for and against content."""
    parts = set(re.split(r"[ .]", place))
    if aside:
        return 1.0, 60.0
    if parts & (CONTENT_NAMES | LABELS | {"p", "blockquote", "pre"} | HEADINGS):
        return 20.0, 1.0
    return 3.0, 1.0


def best_run(parts: list[Stretch], weights: Weights) -> tuple[int, int]:
    """Start and end of the run with the highest score; an empty run if nothing scores above zero."""
    best, found = 0.0, (0, 0)
    total, start = 0.0, 0
    for k, part in enumerate(parts):
        if total <= 0:
            total, start = 0.0, k
        if part.text is None:
            total += weights.tag(part)
        elif part.words:
            total += part.words * weights.word(part.place, part.aside)
        if total > best:
            best, found = total, (start, k + 1)
    return found


def main_text(page: str | None, weights: Weights = Weights()) -> str:
    """The main text of one page."""
    parts = list(stretches(page))
    start, end = best_run(parts, weights)
    blocks, held = [], []
    for part in parts[start:end]:
        if part.breaks:
            blocks.append("".join(held))
            held = []
        elif part.text is None:
            held += [" "] * part.space
        elif not part.aside:
            held.append(part.text)
    blocks.append("".join(held))
    tidy = (" ".join(b.split()) for b in blocks)
    return "\n\n".join(b for b in tidy if b)


def learn(pages: DataFrame) -> DataFrame:
    """Counts by kind and place (is_word, place, inside, outside) of all pages with an ``article`` or ``main``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[bool, str], list[int]] = defaultdict(lambda: [0, 0])
        for batch in batches:
            for page in batch.column(0):
                for part in stretches(page.as_py()):
                    if part.text is None:
                        seen[False, part.place][not part.inside] += 1
                    elif part.words:
                        seen[True, part.place][not part.inside] += part.words
            if len(seen) > 20 * PLACES:
                yield _counts(seen)
                seen.clear()
        if seen:
            yield _counts(seen)

    labelled = pages.where(F.lower("html").rlike("<(article|main)\\b")).select("html")
    return (
        labelled.mapInArrow(count, "is_word boolean, place string, inside long, outside long")
        .groupBy("is_word", "place")
        .agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
    )


def _counts(seen: dict) -> pa.RecordBatch:
    rows = [(w, p, a, b) for (w, p), (a, b) in seen.items()]
    return pa.record_batch([pa.array(c) for c in zip(*rows)], ["is_word", "place", "inside", "outside"])


def _weights(rows) -> Weights:
    by_kind: tuple[dict, dict] = {}, {}
    for r in rows:
        by_kind[not r["is_word"]][r["place"]] = (r["inside"], r["outside"])
    return Weights(*by_kind)


def _common_and_rest(counts: DataFrame) -> tuple[Weights, DataFrame | None]:
    """The weights of at most ``PLACES`` most frequent places, and the counts of all others, if there are any."""
    total = F.col("inside") + F.col("outside")
    top = counts.select(total.alias("total")).orderBy(F.desc("total")).limit(PLACES + 1).collect()
    if len(top) <= PLACES:
        return _weights(counts.collect()), None
    least = top[-1].total
    return _weights(counts.where(total > least).collect()), counts.where(total <= least)


def _with_rest(pages: DataFrame, common: Weights, rest: DataFrame) -> DataFrame:
    """The pages with the counts of those of their own places that are not common.

    Equal pages have equal places, so they meet their counts by a digest of the html.
    """

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: set[tuple[str, bool, str]] = set()
            for key, page in zip(batch.column(0).to_pylist(), batch.column(1)):
                for part in stretches(page.as_py()):
                    if part.place not in (common.tags if part.text is None else common.words):
                        rows.add((key, part.text is not None, part.place))
            if rows:
                yield pa.record_batch([pa.array(c) for c in zip(*rows)], ["key", "is_word", "place"])

    # Pages without html have no places; their keys only spread them.
    keyed = pages.withColumn(
        "key", F.coalesce(F.sha2("html", 256), F.xxhash64("page_id", "url").cast("string"))
    )
    wanted = keyed.select("key", "html").where("html IS NOT NULL")
    wanted = wanted.mapInArrow(places, "key string, is_word boolean, place string").distinct()
    found = F.collect_list(F.struct("is_word", "place", "inside", "outside"))
    own = wanted.join(rest, ["is_word", "place"]).groupBy("key").agg(found.alias("counts"))
    return keyed.join(own, "key", "left").select("page_id", "url", "html", "counts")


def extract(pages: DataFrame, weights: Weights | None = None) -> DataFrame:
    """page_id, url, text and n_chars of every page; weights are learned from the pages unless given.

    The most frequent places go to all tasks; a page meets the counts of its other places by a join.
    """
    pages = pages.select("page_id", "url", "html")
    rest = None
    if weights is None:
        common, rest = _common_and_rest(settled(learn(pages), "places"))
    else:
        common = weights
    if rest is not None:
        pages = _with_rest(pages, common, rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                owns = part.column(3).to_pylist() if part.num_columns > 3 else [None] * part.num_rows
                texts = [
                    main_text(page.as_py(), common.beside(_weights(own or [])))
                    for page, own in zip(part.column(2), owns)
                ]
                yield pa.record_batch(
                    [*part.columns[:2], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )

    return pages.mapInArrow(run, "page_id long, url string, text string, n_chars long")
