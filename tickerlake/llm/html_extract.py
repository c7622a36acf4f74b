"""Operator 12: main text of web pages by a maximum-scoring subsequence.

A page is read as a sequence of tokens: words score positive, tags negative,
and the contiguous run of tokens with the highest sum is the content region,
found by one linear scan over prefix sums. The region's blocks are the text.

Weights come from labelled pages. A page labels itself where its markup names
the article: exactly one outermost ``<article>``, else exactly one ``<main>``
(or ``role=main``). Over these pages each kind of token (a word, a word inside
a link, a tag by name) is counted inside and outside the label. A token's weight is its
log-odds of lying inside, given where it stands: inside the label of its page,
outside it, or on a page without label (there both counts speak). Word weights
are kept positive and tag weights negative. Counts are sums in Spark over a
sample of about ``SAMPLE_PAGES`` pages chosen by hash; fixed prior counts stand for kinds that
it lacks.

Elements that are no content wherever they stand (menus, headers, footers,
sidebars, notices, adverts, forms, scripts, styles, reader comments; by tag,
or by a word of their class, id or role) score as one tag and give no text.
One of them that is never closed before the page ends is an ordinary tag.

In a block, character references are decoded (each text between two tags for
itself), white space (as Python's ``str.split`` knows it; ``<br>`` is one) becomes one
space, and the ends are trimmed; blocks are joined by two line feeds.

Defined cases: null or empty html gives an empty text; a page without words
too; text outside any tag counts as a block; broken tags are read as browsers
do (an unclosed comment or script runs to the end of the page); repeated rows
are pages of their own; of equal sums the earliest region counts; other
columns do not matter; no rows give no rows. A page is
handled whole, in time linear in its length.
"""

from __future__ import annotations

import html as references
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerlake.llm.common import slices

SAMPLE_PAGES = 4_000      # pages that the weights are counted on, about, at most
LEAST = 0.01              # of a word's weight
LEAST_COST = 0.05         # of a tag
_HASHES = 1 << 20

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot
th thead tr ul""".split())
DROPPED = frozenset("""nav header footer aside form noscript template button select svg math dialog menu object canvas audio video
input textarea script style title iframe""".split())
INLINE = frozenset("a abbr b bdi bdo cite code data del dfn em font i ins kbd label mark q s samp small span strong sub sup time tt u var".split())
NAMED = BLOCKS | DROPPED | INLINE | VOID
# Words of a class, id or role that name what is not content.
HINTS = frozenset("""ad ads adbox advert adverts advertisement advertising sponsor sponsored promo promotion sidebar nav navbar
navigation menu breadcrumb breadcrumbs footer masthead comment comments disqus reply replies respond cookie cookies consent gdpr notice notices
popup modal newsletter subscribe signup social share sharing related recommended widget pagination pager copyright complementary
contentinfo search login toolbar""".split())
WHOLE_HINTS = frozenset("header site-header page-header top-header banner alert form dialog".split())   # only as a whole name
NEVER = frozenset("html body main".split())       # hints on these speak of the page
_STATES = frozenset("has with no without is not".split())

# (inside, outside) counted before any page is seen.
PRIOR = {"word": (10, 5), "linked word": (1, 5), **{t: (1, 6) for t in "a li ul ol option".split()},
         **{t: (6, 1) for t in "p b i em strong h1 h2 h3 h4 blockquote pre br".split()}}
PRIOR_TAG = (1, 2)

_MARK = re.compile(r"<(?:(/?)([a-zA-Z][^\s/>]*)|(!--)|[!?])")
_STOP = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role|hidden|aria-hidden)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
_RAW_END = {n: re.compile(rf"</{n}(?=[\s/>]|$)", re.I) for n in RAW}
_BREAKS = re.compile(r"[^a-z0-9]+")


def _is_hint(name: str) -> bool:
    if name in WHOLE_HINTS or name in HINTS:
        return True
    parts = [p for p in _BREAKS.split(name) if p]
    return len(parts) > 1 and parts[0] not in _STATES and (parts[0] in HINTS or parts[-1] in HINTS)


def _attributes(text: str) -> tuple[bool, bool]:
    """(named as no content, role=main)."""
    hint = main = False
    for m in _ATTRIBUTE.finditer(text):
        name, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            hint = True
        elif name in ("class", "id", "role"):
            main |= name == "role" and value == "main"
            hint |= any(_is_hint(n) for n in value.split())
    return hint, main


def marks(page: str):
    """(start, end, name, closing, attributes) of each tag, in order; name None
    for comments and declarations. A raw element's content is skipped, so its
    end tag comes next. Each search forward is done once, so it is linear."""
    at, n = 0, len(page)
    last_quote = {'"': n, "'": n}         # no such quote from there on
    while m := _MARK.search(page, at):
        start = m.start()
        if m[3]:
            end = page.find("-->", m.end())
            at = n if end < 0 else end + 3
            yield start, at, None, False, ""
            continue
        at = m.end()
        while True:
            stop = _STOP.search(page, at)
            if not stop:
                at = n
                break
            at = stop.end()
            if stop[0] == ">":
                break
            if m[2] and page[max(m.end(), stop.start() - 20):stop.start()].rstrip().endswith("=") and stop.start() < last_quote[stop[0]]:
                close = page.find(stop[0], at)
                if close < 0:
                    last_quote[stop[0]] = stop.start()
                else:
                    at = close + 1
        if not m[2]:
            yield start, at, None, False, ""
            continue
        name = m[2].lower()
        yield start, at, name, bool(m[1]), page[m.end():max(m.end(), at - 1)]
        if name in RAW and not m[1]:
            end = _RAW_END[name].search(page, at)
            at = end.start() if end else n


class Page:
    """Tokens of one page: ``kinds`` (a word kind or tag name), ``counts``
    (words; 1 for a tag), ``sides`` (0 free, 1 inside the label, 2 outside),
    ``blocks`` (block of a run of words, -1 for tags), ``gone`` (inside an
    element that is no content) and the texts."""

    def __init__(self, page: str):
        opened: dict[str, list[int]] = {}
        stack: list[int] = []
        found, ends, drop, main = [], {}, set(), set()
        for start, end, name, closing, attributes in marks(page):
            i = len(found)
            found.append((start, end, name, closing))
            if name is None or name in VOID:
                if name == "input":
                    drop.add(i)
                    ends[i] = i
                continue
            if closing:
                if opened.get(name):
                    while True:
                        k = stack.pop()
                        own = found[k][2]
                        opened[own].pop()
                        ends[k] = i
                        if own == name:
                            break
                continue
            hint, is_main = _attributes(attributes) if attributes else (False, False)
            if name in DROPPED or (hint and name not in NEVER):
                drop.add(i)
            if name == "main" or is_main:
                main.add(i)
            stack.append(i)
            opened.setdefault(name, []).append(i)
        for k in stack:                   # open at the end of the page
            ends[k] = len(found)
            if found[k][2] not in RAW:
                drop.discard(k)
        label = self._label(found, ends, drop, main)
        self._read(page, found, ends, drop, label)

    @staticmethod
    def _label(found, ends, drop, main):
        """Marks (first, last) of the element that names the article."""
        articles, mains, until, gone = [], [], -1, -1
        inside_main = -1
        for i, (_, _, name, closing) in enumerate(found):
            if name is None or closing or i < gone or i not in ends:
                continue
            if i in drop:
                gone = max(gone, ends[i])
            elif name == "article" and i > until:
                articles.append(i)
                until = ends[i]
            elif i in main and i > inside_main:
                mains.append(i)
                inside_main = ends[i]
        one = articles if len(articles) == 1 else mains if len(mains) == 1 else []
        return (one[0], ends[one[0]]) if one else None

    def _read(self, page, found, ends, drop, label):
        self.kinds, self.counts, self.sides, self.blocks, self.gone = [], [], [], [], []
        self.labelled = label is not None
        self.texts: list[list[str]] = [[]]
        until, links, before, opening = -1, 0, 0, None
        for i in range(len(found) + 1):
            start, end, name, closing = found[i] if i < len(found) else (len(page), len(page), None, False)
            side = 0 if label is None else 1 if label[0] < i <= label[1] else 2
            gone = i <= until
            if start > before and (i == 0 or found[i - 1][2] not in RAW or found[i - 1][3]):
                raw = page[before:start]
                if not raw.isspace():
                    text = references.unescape(raw)
                    words = len(text.split())
                    if words:
                        self._add("linked word" if links else "word", words, side, -1 if gone else len(self.texts) - 1, gone)
                else:
                    text = " "
                if not gone:
                    self.texts[-1].append(text)
            before = end
            if name is None:
                continue
            if name == "a":
                links = 0 if closing else 1
            if name in BLOCKS and self.texts[-1] and not gone:
                self.texts.append([])
            elif name == "br" and not gone:
                self.texts[-1].append(" ")
            own = side if label is None or i not in label else 2
            if i in drop and i > until:
                until, opening = ends[i], name
                self._add("dropped", 1, own, -1, False)
            elif not (i == until and closing and name == opening):      # its end tag is part of it
                self._add(name if name in NAMED else "other", 1, own, -1, i < until)

    def _add(self, kind, count, side, block, gone):
        self.kinds.append(kind)
        self.counts.append(count)
        self.sides.append(side)
        self.blocks.append(block)
        self.gone.append(gone)


def is_word(kind: str) -> bool:
    return kind in ("word", "linked word")


def counted(pages) -> tuple[Counter, Counter]:
    """Tokens by kind inside and outside the labels of ``pages``."""
    inside, outside = Counter(), Counter()
    for page in pages:
        p = Page(page)
        if p.labelled:
            for kind, count, side, gone in zip(p.kinds, p.counts, p.sides, p.gone):
                (inside if side == 1 and not gone else outside)[kind] += count
    return inside, outside


class Weights:
    """Weight of a kind of token on each side: (free, inside, outside). On a
    page with a label all words of one side weigh the same, linked or not."""

    def __init__(self, inside: dict, outside: dict):
        self.of = {}
        words = [k for k in PRIOR if is_word(k)]
        every = [sum(counts.get(k, 0) + PRIOR[k][j] for k in words) for j, counts in enumerate((inside, outside))]
        for kind in {*NAMED, *PRIOR, "other", "dropped", *inside, *outside}:
            a, b = PRIOR.get(kind, PRIOR_TAG)
            more, less = inside.get(kind, 0) + a, outside.get(kind, 0) + b
            sides = every if is_word(kind) else (more, less)
            raw = (math.log(more / less), math.log(sides[0]), -math.log(sides[1]))
            self.of[kind] = tuple(max(w, LEAST) if is_word(kind) else min(w, -LEAST_COST) for w in raw)


def region(page: Page, weights: Weights) -> tuple[int, int]:
    """The tokens first <= i < last of the highest sum; the earliest such."""
    keep = [i for i, gone in enumerate(page.gone) if not gone]
    if not keep:
        return 0, 0
    scores = np.array([weights.of[page.kinds[i]][page.sides[i]] * page.counts[i] for i in keep])
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    low = np.minimum.accumulate(sums[:-1])
    last = int(np.argmax(sums[1:] - low))
    if sums[last + 1] - low[last] <= 0:
        return 0, 0
    first = int(np.flatnonzero(sums[:last + 1] == low[last])[-1])
    return keep[first], keep[last] + 1


def main_text(html: str | None, weights: Weights) -> str:
    if not html:
        return ""
    page = Page(html)
    first, last = region(page, weights)
    chosen = sorted({b for b in page.blocks[first:last] if b >= 0})
    return "\n\n".join(" ".join("".join(page.texts[b]).split()) for b in chosen)


def fit(pages: DataFrame, html: str = "html", sample_pages: int = SAMPLE_PAGES) -> Weights:
    """Weights from the pages of ``pages`` that label themselves: of all of
    them, or of about ``sample_pages`` chosen by a hash of the whole html."""
    total = pages.count()
    rows = pages.select(F.col(f"`{html}`").alias("html")).where(F.length("html") > 0)
    if total > sample_pages:
        rows = rows.where(F.pmod(F.xxhash64("html", F.lit("sample")), F.lit(_HASHES)) < max(1, _HASHES * sample_pages // total))

    def run(batches):
        inside, outside = Counter(), Counter()
        for batch in batches:
            for piece in slices(batch, "html"):
                a, b = counted(piece.column("html").to_pylist())
                inside += a
                outside += b
        kinds = sorted({*inside, *outside})
        yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array([inside[k] for k in kinds], pa.int64()),
                                          pa.array([outside[k] for k in kinds], pa.int64())], names=["kind", "inside", "outside"])

    # One row per kind of token: the names above, whatever the table.
    sums = (rows.mapInArrow(run, "kind string, inside long, outside long")
            .groupBy("kind").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside")).collect())
    return Weights({r["kind"]: r["inside"] for r in sums}, {r["kind"]: r["outside"] for r in sums})


def extract(pages: DataFrame, weights: Weights, html: str = "html", keep=("page_id", "url")) -> DataFrame:
    """``keep`` columns of each page, with text and n_chars of its main text."""
    rows = pages.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{html}`").alias("_html"))
    names = [*keep, "text", "n_chars"]
    schema = rows.drop("_html").withColumn("text", F.lit("")).withColumn("n_chars", F.lit(0).cast("long")).schema

    def run(batches):
        for batch in batches:
            for piece in slices(batch, "_html"):
                texts = pa.array([main_text(x.as_py(), weights) for x in piece.column("_html")], pa.string())
                yield pa.RecordBatch.from_arrays([*piece.columns[:-1], texts, pa.compute.utf8_length(texts).cast(pa.int64())], names=names)

    return rows.mapInArrow(run, schema)
