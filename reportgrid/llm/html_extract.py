"""The main text of a page, as the best-scoring contiguous region.

A page is read as a sequence of tags and texts. Each tag costs; each text scores its number of words times a
weight that depends on the block it stands in: the log-odds of lying inside the main region, as counted on pages whose
markup tells that region (``article`` or ``main``), backed off from the block with its container to the block's
tag. A block whose class, id or role has a boilerplate word among others ("site-footer") is backed off to what the words of such
blocks taught. One linear scan finds the contiguous region with the largest sum. Texts of the region that stand in
boilerplate blocks are left out of it, the rest is written as one line per block. Boilerplate blocks are those of the tags in
``BOILERPLATE``, and those with a class, id or role that is made of words in ``NAMES`` only. Such names say nothing of the page's body, of
``main``, of what holds a ``main`` or half of the page's words, nor of the largest ``article``; of other articles only single words do.

The weights are fitted on ``SAMPLE_PAGES`` such pages with the smallest hashes of their addresses; there are as many as kinds of
blocks in these pages. All pages are read whole.

Defined results: a null or empty page, or one without words, gives an empty text; without any labelled page the weights
come from the names of the blocks alone; repeated rows get the same answer each; ties go to the first region, and
within it to the longest; all columns but the page's id, url and html are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled pages that the weights are fitted on, at most.
SAMPLE_PAGES = 2000
#: Words that the prior of a block's weight counts for.
PRIOR_WORDS = 20.0
#: What a tag costs.
TAG_COST = 0.05
#: What a word of a boilerplate block costs.
BOILERPLATE_COST = -1.0
#: Weights stay within these bounds.
MOST = 4.0

# Fixed values of the language: elements by what they do to the text around them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template noscript textarea title svg iframe select head".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br canvas cite code data del dfn em font i img ins kbd label mark math mfrac mi mn mo mover mroot mrow "
    "ms msqrt mstyle msub msubsup msup mtext munder object q rp rt ruby s samp semantics small span strike strong sub sup time tt u var "
    "wbr".split()
)
#: Elements that never belong to the main text, and words that say so in a class, id or role: fixed values.
BOILERPLATE = frozenset("nav header footer aside form menu button dialog fieldset".split())
NAMES = frozenset(
    "ad ads advert adverts advertisement aside banner breadcrumb breadcrumbs byline comment comments cookie cookies disqus footer "
    "form header login masthead menu nav navbar navigation newsletter notice notices pager pagination popup promo promoted "
    "related reply replies share sharing sidebar signup social sponsor sponsored subscribe toc toolbar widget".split()
)
MAIN = frozenset(["article", "main"])

TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)",
    re.S,
)
ATTR = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
SPACE = re.compile(r"\s+")


class Place:
    """An open element: how its texts are called, and whether they are boilerplate by name or in the main region.

    Whether a name counts depends on the whole page, so ``bad`` and ``hint`` are set by ``decide``.
    """

    __slots__ = ("tag", "kind", "coarse", "bad", "main", "block", "inside", "words", "holds_main", "tagged", "named", "hints", "hint")

    def __init__(self, tag: str, attrs: str, inside: Place | None):
        names = [x for m in ATTR.finditer(attrs) for x in SPACE.split((m[1] or m[2] or m[3] or "").lower().strip())] if attrs else []
        parts = [{p for p in re.split(r"[^a-z]+", n) if p} for n in names]
        self.tag = tag
        self.main = (inside is not None and inside.main) or tag in MAIN
        self.inside, self.words, self.holds_main = inside, 0, tag == "main"
        self.tagged = tag in BOILERPLATE and not (tag == "header" and inside is not None and inside.main)
        self.named = any(p and p <= NAMES and (tag != "article" or len(p) == 1) for p in parts)
        self.hints = sorted({p for x in parts if not x <= NAMES for p in x & NAMES}) if parts else []
        self.bad, self.hint = False, ()
        self.block = tag not in INLINE
        if self.block or inside is None:
            label = tag + "".join("." + n for n in sorted(set(names))[:3])
            self.kind = f"{label}|{inside.tag if inside else ''}"
            self.coarse = tag
        else:
            self.kind, self.coarse = inside.kind, inside.coarse


def decide(places: list[Place]) -> None:
    """Which elements of a page, given in order, are boilerplate, and which name parts hint at it."""
    for place in reversed(places):
        if place.inside is not None:
            place.inside.words += place.words
            place.inside.holds_main |= place.holds_main
    whole = places[0].words
    largest: Place | None = None
    # the largest article is known once what holds the articles is decided; it is exempt itself
    for last in (False, True):
        for place in places:
            inside = place.inside
            minor = 2 * place.words < whole and not place.holds_main and place.tag not in ("html", "body") and place is not largest
            article = place.tag == "article" and not last
            place.bad = (inside is not None and inside.bad) or place.tagged or (place.named and minor and not article)
            place.hint = inside.hint if inside is not None else ()
            if place.hints and minor:
                place.hint = tuple(sorted({*place.hint, *place.hints}))
        if last or not any(p.named and p.tag == "article" for p in places):
            return
        articles = [p for p in places if p.tag == "article" and not p.bad]
        largest = max(articles, key=lambda p: p.words, default=None)


def walk(page: str) -> list[tuple[str, object, Place]]:
    """("text", text, place) and ("block" or "inline", tag, place) in page order."""
    places = [Place("", "", None)]
    found = list(_walk(page, places))
    for kind, what, place in found:
        if kind == "text":
            place.words += words_in(what)
    decide(places)
    return found


def _walk(page: str, places: list[Place]) -> Iterator[tuple[str, object, Place]]:
    """The same before names are decided on; adds the elements to ``places``."""
    stack = places[:1]
    open_ = Counter()  # how many elements of a tag are open
    blocks: list[int] = []  # where in the stack the blocks are
    at, n = 0, len(page)

    def close(depth: int) -> None:
        open_.subtract(place.tag for place in stack[depth:])
        del stack[depth:]
        while blocks and blocks[-1] >= depth:
            blocks.pop()

    while at < n:
        found = TOKEN.search(page, at)
        start = found.start() if found else n
        if start > at:
            yield "text", page[at:start], stack[-1]
        if not found:
            return
        at = found.end()
        tag = (found["tag"] or "").lower()
        if not tag:
            continue
        if found["close"]:
            if open_[tag] > 0:  # what is walked over is closed
                close(next(k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag))
            yield ("inline" if tag in INLINE else "block"), tag, stack[-1]
            continue
        if tag in RAW and not found["attrs"].rstrip().endswith("/"):
            if tag != "head":
                end = re.compile(rf"</{tag}\b[^>]*(?:>|$)", re.I).search(page, at)
                at = end.end() if end else n
            yield "block", tag, stack[-1]
            continue
        if tag not in INLINE and tag not in VOID:
            # a block closes a paragraph that is still open, and what stands open in it; an item closes the item before
            closes = ("p", "h1", "h2", "h3", "h4", "h5", "h6") if tag != "li" else ("p", "li")
            if blocks and stack[blocks[-1]].tag in closes:
                close(blocks[-1])
        place = Place(tag, found["attrs"], stack[-1])
        places.append(place)
        yield ("inline" if tag in INLINE else "block"), tag, place
        if tag not in VOID and not found["attrs"].rstrip().endswith("/"):
            open_[tag] += 1
            if place.block:
                blocks.append(len(stack))
            stack.append(place)


def words_in(text: str) -> int:
    return len(text.split())


def count_blocks(page: str | None, seen: Counter) -> None:
    """Adds how many words of each kind of block lie in the main region and outside it."""
    for kind, what, place in walk(page or ""):
        if kind == "text" and (n := words_in(what)):
            for name in (place.kind, place.coarse, *("~" + x for x in place.hint)):
                seen[name, place.main and not place.bad] += n


def weights(counts: dict[tuple[str, bool], int]) -> dict[str, float]:
    """Log-odds by kind of block, the finer ones drawn towards their tag's."""
    total = {side: sum(n for (k, s), n in counts.items() if s == side and "|" not in k and k[:1] != "~") for side in (True, False)}
    if not total[True] or not total[False]:
        return {}
    prior = total[True] / (total[True] + total[False])
    shares: dict[str, float] = {}
    for fine in (False, True):
        for name in {k for k, _ in counts if ("|" in k) == fine}:
            inside, outside = counts.get((name, True), 0), counts.get((name, False), 0)
            tag = re.split(r"[.|]", name)[0]
            mean = shares.get(tag, prior) if fine else prior
            shares[name] = (inside + PRIOR_WORDS * mean) / (inside + outside + PRIOR_WORDS)
    return {k: max(-MOST, min(MOST, math.log(s / (1 - s)) if 0 < s < 1 else MOST * (2 * s - 1))) for k, s in shares.items()}


def weight_of(place: Place, known: dict[str, float]) -> float:
    if place.bad:
        return 0.0 if place.main else BOILERPLATE_COST  # inside a marked region it is left out, but parts nothing
    if place.main:
        return MOST
    found = known.get(place.kind)
    if found is not None:
        return found
    if place.hint:
        return min(known.get("~" + x, BOILERPLATE_COST) for x in place.hint)
    return known.get(place.coarse, 1.0)


def main_text(page: str | None, known: dict[str, float]) -> str:
    """The lines of the best region."""
    steps = [(kind, what, place, weight_of(place, known) if kind == "text" else 0.0) for kind, what, place in walk(page or "")]
    best, best_from, best_to, total, start = 0.0, 0, 0, 0.0, 0
    for k, (kind, what, _, weight) in enumerate(steps):
        if total <= 0:
            total, start = 0.0, k
        total += weight * words_in(what) if kind == "text" else -TAG_COST
        if total > best:
            best, best_from, best_to = total, start, k + 1
    lines, line = [], []
    for kind, what, _, weight in steps[best_from:best_to]:
        if kind == "block" or (kind == "inline" and what == "br"):
            lines.append("".join(line))
            line = []
        elif kind == "text" and weight > 0:
            line.append(html.unescape(what))
    lines.append("".join(line))
    return "\n".join(x for x in (SPACE.sub(" ", x).strip() for x in lines) if x)


def fit(pages: DataFrame, sample_pages: int = SAMPLE_PAGES, url_col: str = "url", html_col: str = "html") -> dict[str, float]:
    """The weights from pages that mark their main region; bounded in number, and so is what reaches the driver."""
    rows = pages.select(F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    chosen = rows.filter(F.col("html").rlike("(?i)<(article|main)[\\s>]")).select(
        F.xxhash64("url").alias("place"), "html"
    )
    limit = chosen.orderBy("place").select("place").limit(sample_pages).agg(F.max("place")).first()[0]
    if limit is None:
        return {}
    sample = chosen.filter(F.col("place") <= limit).limit(sample_pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for page in batch.column(0).to_pylist():
                count_blocks(page, seen)
        rows = [(k, s, n) for (k, s), n in seen.items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.bool_()), pa.array([r[2] for r in rows], pa.int64())],
            names=["kind", "inside", "n"],
        )

    found = sample.select("html").mapInArrow(run, "kind string, inside boolean, n long")
    return weights({(r["kind"], r["inside"]): r["n"] for r in found.groupBy("kind", "inside").agg(F.sum("n").alias("n")).collect()})


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row: the id, the url, and the main text as ``text``."""
    known = fit(pages, url_col=url_col, html_col=html_col)
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page, known) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    return rows.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
