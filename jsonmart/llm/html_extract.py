"""Main text of web pages by maximum-scoring subsequence.

A page is a sequence of words and tags. Words score positive and tags negative; one linear scan finds the
contiguous region with the best sum, the content. The weights are counted from labelled pages: each tag costs more the
more often it stands outside marked content, and element names, classes, ids and roles that stand only outside
mark furniture (menus, adverts, forms, notices, comments, ...). An element of furniture scores one fixed loss in place of
its words, so a region may reach across it, and its text is left out. Where a page names its article, words outside of
it score negative.

A name is no proof: the whole page may stand in <form> or in class="site". What holds <main> is no furniture. Where
furniture holds more words than the best region has score, times a factor, the page is scanned again with those names
taken as plain; the reading that scores more by the factor holds. This is done for names seen only beside others and
for single elements that hold a first-level heading. A name that marks furniture on its own (comments, menu, sidebar)
holds at any length, also on a page without other words.

The text of the region comes in blocks: text between block-level tags, character references decoded, white
space folded to one space, trimmed; empty blocks vanish; blocks are joined by two line feeds.

Defined cases. Null or empty html, or a page without words: empty text, 0 characters. Unclosed and stray tags are
taken as they come; an unclosed comment or script ends with the page. Repeated rows are extracted each. Pages are
taken whole. Other columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from bisect import bisect_right
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled_pages import PAGES

#: Elements that start a new block of text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section "
    "summary table tbody td tfoot th thead title tr ul".split()
)
#: Elements that never have content of their own.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is never shown as prose.
HIDDEN = frozenset("head title noscript template button select textarea option label iframe object svg canvas".split())
#: Elements that name the article; furniture names inside do not count for these and for headings' containers.
ARTICLE = frozenset(("article", "main"))

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*>"
    r"""|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>"']|"[^"]*"|'[^']*')*)>"""
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_ANY_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_NOT_DISPLAYED = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

WORD_SCORE, OUTSIDE_SCORE, FURNITURE_SCORE = 1.0, -1.0, -3.0
#: What closing tags cost, and all tags and furniture inside an article that the page names.
INSIDE_COST = 0.1
#: How much more a page must score with some furniture taken as plain, and the score from which this counts.
WRAPPER_GAIN, LEAST_SCORE = 2.0, 10.0

#: Open elements that a tag ends without an end tag, and those beyond which it ends nothing.
_CELLS = (frozenset(("td", "th")), frozenset(("table",)))
_ROWS = (frozenset(("td", "th", "tr")), frozenset(("table",)))
_PARTS = (frozenset("td th tr tbody thead tfoot caption colgroup".split()), frozenset(("table",)))
_TERMS = (frozenset(("dt", "dd")), frozenset(("dl",)))
IMPLIED_ENDS = {
    "td": _CELLS, "th": _CELLS, "tr": _ROWS, "tbody": _PARTS, "thead": _PARTS, "tfoot": _PARTS, "dt": _TERMS, "dd": _TERMS,
    "li": (frozenset(("li",)), frozenset("ul ol menu dir".split())),
    "option": (frozenset(("option",)), frozenset(("select", "datalist"))),
    "optgroup": (frozenset(("option", "optgroup")), frozenset(("select",))),
}
#: Elements that a head may hold; any other ends it.
_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())


def hints(name: str, attributes: str) -> list[str]:
    """What an element calls itself: its tag, and the words of its class, id and role."""
    out = [f"<{name}>"]
    if attributes:
        for m in _ATTRIBUTE.finditer(attributes):
            out += [w.lower() for w in _NAME.findall(m[2])]
    return out


def not_shown(attributes: str) -> bool:
    """Whether an element's own attributes hide it."""
    low = attributes.lower()
    if "hidden" not in low and "display" not in low:
        return False
    for m in _ANY_ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or "").strip("\"'").strip()
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True
        if name == "style" and _NOT_DISPLAYED.search(value):
            return True
    return False


def tokens(page: str):
    """('text', run), ('open', name, attributes) and ('close', name) in page order; scripts and comments are gone."""
    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            yield "text", page[at : m.start()], ""
        at = m.end()
        name = m[3] or m[6]
        if name:
            name = name.lower()
            if m[2] or m[5]:
                yield "close", name, ""
            else:
                yield "open", name, m[4] if m[3] else m[7]
    if at < len(page):
        yield "text", page[at:], ""


class Stack:
    """Open elements; an element closes those inside it, a block an open paragraph, and cells, rows and items their like.

    The places of each name are kept, so a tag costs the same at any depth.
    """

    def __init__(self):
        self.names: list[str] = []
        self.marks: list[object] = []
        self.places: defaultdict[str, list[int]] = defaultdict(list)
        self.blocks: list[int] = []

    def _cut(self, at: int) -> None:
        for name in self.names[at:]:
            self.places[name].pop()
        while self.blocks and self.blocks[-1] >= at:
            self.blocks.pop()
        del self.names[at:], self.marks[at:]

    def _is_open(self, names) -> bool:
        return any(self.places.get(name) for name in names)

    def open(self, name: str, mark: object) -> None:
        if self._is_open(("head",)) and name not in _HEAD and not self._is_open(_HEAD):
            self._cut(self.places["head"][0])
        if name in IMPLIED_ENDS:
            ends, beyond = IMPLIED_ENDS[name]
            bound = max((p[-1] for x in beyond if (p := self.places.get(x))), default=-1)
            inner = [p[k] for x in ends if (p := self.places.get(x)) and (k := bisect_right(p, bound)) < len(p)]
            if inner:
                self._cut(min(inner))
        if name in BLOCKS and (paragraphs := self.places.get("p")) and self.blocks[-1] == paragraphs[-1]:
            self._cut(paragraphs[-1])
        if name not in VOID:
            at = len(self.names)
            self.places[name].append(at)
            if name in BLOCKS:
                self.blocks.append(at)
            self.names.append(name)
            self.marks.append(mark)

    def close(self, name: str) -> None:
        if places := self.places.get(name):
            self._cut(places[-1])


class _Labelled:
    """An element of a labelled page: whether it is in the marked content, and whether it is or holds some of it."""

    def __init__(self, name: str, attributes: str, inside: bool):
        self.name, self.attributes = name, attributes.replace("data-main", "")
        self.main = inside or "data-main" in attributes
        self.holds = self.main or name in ("html", "body", "table", "tr", "tbody")


class Weights:
    """Costs of tags and the names of furniture, counted from labelled pages."""

    def __init__(self, pages):
        inside, outside, own, furniture = Counter(), Counter(), Counter(), Counter()
        heads: list[set[str]] = []
        for page in pages:
            stack, elements = Stack(), []
            for kind, value, attributes in tokens(page):
                if kind == "open":
                    element = _Labelled(value, attributes, any(e.main for e in stack.marks))
                    (inside if element.main else outside)[value] += 1
                    if element.main:  # what is around it is no furniture either
                        for outer in stack.marks:
                            outer.holds = True
                    elements.append(element)
                    stack.open(value, element)
                elif kind == "close":
                    stack.close(value)
            for element in elements:
                (own if element.holds else furniture).update(set(hints(element.name, element.attributes)))
                if not element.holds:
                    called = (w for m in _ATTRIBUTE.finditer(element.attributes) for w in m[2].strip("\"'").split())
                    heads.append({found[-1].lower() for w in called if (found := _NAME.findall(w))})
        self.cost = {t: 0.25 + max(0.0, math.log((outside[t] + 1) / (inside[t] + 1))) for t in {*inside, *outside}}
        self.furniture = {h for h in furniture if not own[h] and h not in _NEUTRAL and not _plain(h)}
        #: Names that mark furniture on their own: the last words of an element's only name for it, and sections.
        self.alone = {"<nav>", "<aside>", "<footer>", "<header>"} & self.furniture
        for found in heads:
            if len(found & self.furniture) == 1:
                self.alone |= found & self.furniture

    def furniture_names(self, name: str, attributes: str, in_article: bool) -> frozenset[str]:
        if name in ("article", "main", "body", "html"):
            return frozenset()
        found = hints(name, attributes)
        if in_article and name == "header":  # the headline's own container
            found = found[1:]
        return frozenset(self.furniture.intersection(found))


#: Names that say nothing about an element's part in the page.
_NEUTRAL = frozenset("area bar left list posts right thread top".split())


def _plain(hint: str) -> bool:
    """Tags that hold prose and furniture alike."""
    return hint.startswith("<") and hint.strip("<>") not in {"nav", "aside", "footer", "header", "form", "noscript", "dialog"}


class _Element:
    """An element's end in the stream, the names that make it furniture, and what it holds."""

    def __init__(self, name: str, at: int, called: frozenset[str], unseen: bool):
        self.name, self.at, self.end, self.called, self.unseen = name, at, 0, called, unseen
        self.headed = self.main = False


class _Page:
    """A page's tokens and elements, and its best region in one reading."""

    def __init__(self, page: str, weights: Weights):
        self.stream, self.weights = list(tokens(page)), weights
        self.elements: dict[int, _Element] = {}
        self.articles: list[bool] = []  # whether a token is inside an article
        self.words = [0]
        stack, article, last = Stack(), 0, []
        for i, (kind, value, attributes) in enumerate(self.stream):
            if kind == "text":
                self.words.append(self.words[-1] + len(value.split()))
                self.articles.append(article > 0)
                continue
            self.words.append(self.words[-1])
            if kind == "open":
                element = _Element(value, i, frozenset(), value in HIDDEN or not_shown(attributes))
                stack.open(value, element)
                article -= self._ended(last, stack.marks, i)
                article += value in ARTICLE and value not in VOID
                if value not in VOID:
                    element.called = weights.furniture_names(value, attributes, article > 0)
                    self.elements[i] = element
                    last.append(element)
                    if value in ("h1", "main"):
                        about = "headed" if value == "h1" else "main"
                        for outer in reversed(stack.marks):
                            if getattr(outer, about):  # and so are all around it
                                break
                            setattr(outer, about, True)
            else:
                stack.close(value)
                article -= self._ended(last, stack.marks, i)
            self.articles.append(article > 0)
        self._ended(last, [], len(self.stream))

    @staticmethod
    def _ended(last: list[_Element], now: list, at: int) -> int:
        """Ends the elements of ``last`` that are open no more; the number of articles among them."""
        keep = len(now)
        if keep and (keep > len(last) or now[keep - 1] is not last[keep - 1]):
            keep -= 1  # the last one has just opened
        n = 0
        for element in last[keep:]:
            element.end = at
            n += element.name in ARTICLE
        del last[keep:]
        return n

    def read(self, plain: set) -> tuple[float, tuple[int, int], list[tuple[int, int]]]:
        """Score and range of the best region and the hidden stretches, with the names and elements in ``plain`` no furniture."""
        stretches, until = [], 0
        for i, e in self.elements.items():
            if i >= until and (e.unseen or (not e.main and i not in plain and not e.called <= plain)):
                until = e.end
                stretches.append((i, e.end))
        hidden = dict(stretches)
        until, named = 0, False
        for i, e in self.elements.items():
            until = max(until, hidden.get(i, 0))
            named = named or (i >= until and e.name in ARTICLE)
        best, best_range, total, start, until = 0.0, (0, 0), 0.0, 0, 0
        for i, (kind, value, _) in enumerate(self.stream):
            article, score = self.articles[i], 0.0
            if i in hidden:
                until = hidden[i]
                score = -INSIDE_COST if named and article else FURNITURE_SCORE
            elif i < until or (i == until and kind == "close" and i > 0):
                score = 0.0
            elif kind == "open":
                score = -INSIDE_COST if named and article else -self.weights.cost.get(value, 0.25)
            elif kind == "close":
                score = -INSIDE_COST
            else:
                score = (self.words[i + 1] - self.words[i]) * (WORD_SCORE if article or not named else OUTSIDE_SCORE)
            if total <= 0:
                total, start = 0.0, i
            total += score
            if total > best:
                best, best_range = total, (start, i + 1)
        return best, best_range, stretches

    def _wrappers(self, stretches, plain: set, rejected: set, score: float) -> tuple | None:
        """What holds the most words of ``stretches``, if enough: (words, names or element), not among ``rejected``."""
        held_back: Counter = Counter()
        for i, end in stretches:
            e = self.elements[i]
            alone = self.weights.alone & e.called
            if not e.unseen and (e.headed or not alone):
                held_back[i if alone else e.called - plain] += self.words[end] - self.words[i]
        least = WRAPPER_GAIN * max(score, LEAST_SCORE)
        found = [(n, what) for what, n in held_back.items() if what not in rejected and n > least]
        return max(found, key=lambda x: x[0], default=None)

    def best(self) -> tuple[tuple[int, int], list[tuple[int, int]]]:
        """Range and hidden stretches of the reading that holds."""
        score, region, stretches = self.read(set())
        plain, rejected = set(), set()
        while (first := self._wrappers(stretches, plain, rejected, score)) is not None:
            trial, wrapper = set(plain), first
            while wrapper is not None:  # also what stands inside of it
                what = wrapper[1]
                trial |= what if isinstance(what, frozenset) else {what}
                new, new_region, new_stretches = self.read(trial)
                if new > WRAPPER_GAIN * max(score, LEAST_SCORE):
                    score, region, stretches, plain = new, new_region, new_stretches, trial
                    break
                inner = set(new_stretches) - set(stretches)
                wrapper = self._wrappers(inner, trial, rejected, score)
            else:
                rejected.add(first[1])
        return region, stretches


def extract(page: str | None, weights: Weights | None = None) -> str:
    """The main text of one page."""
    if not page:
        return ""
    read = _Page(page, weights or Weights(PAGES))
    stream = read.stream
    best_range, stretches = read.best()
    shown = [True] * len(stream)
    for i, end in stretches:
        shown[i:end] = [False] * (end - i)

    blocks, current = [], []
    for i in range(*best_range):
        kind, value, _ = stream[i]
        if kind == "text":
            if shown[i]:
                current.append(value)
        elif value in BLOCKS:
            blocks.append("".join(current))
            current = []
        elif value == "br":
            current.append(" ")
    blocks.append("".join(current))
    folded = (" ".join(html.unescape(b).split()) for b in blocks)
    return "\n\n".join(b for b in folded if b)


def main_text(pages: DataFrame, labelled=PAGES) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars.

    ``labelled`` are pages whose main elements carry data-main; there are few of them, and their weights travel
    with the tasks.
    """
    weights = Weights(labelled)

    def run(batches):
        for batch in batches:
            texts = [extract(h, weights) for h in batch.column("html").to_pylist()]
            arrays = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
