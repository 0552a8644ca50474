"""Main text of web pages by maximum-scoring subsequence.

A page is read as one sequence of words and tags. Words score by the elements that enclose them, tags cost, and one linear scan
finds the contiguous region with the largest sum, which is the article. Inside the region, text is cut into blocks, and text of menus,
forms, adverts, comments and the like is left out.

Scores are learned from labelled pages: those whose own markup says where the article is (`article`, `main` or `role="main"`). For
every name of an element, class or id the learner counts words inside and outside of articles; the score is the
logarithm of the two rates, on top of fixed first counts for names with a known meaning. About `SAMPLE` of these pages are
looked at for that, chosen by a hash of id and html and counted in tasks. Pages without such markup are scored by the same table.

Defined cases: NULL or empty html has an empty text; a page without words too; repeated rows come back repeated; an unfinished tag at the end
of a page is dropped; unfinished character references stay as they are; of regions with equal sums the first counts; an empty table gives no
rows; other columns are not read. Pages of any length are read whole, in time by their length however they are nested or quoted.
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

from packetloom.llm.common import hashed_share, over_texts, staged

SAMPLE = 1000
#: A name needs this share of the counted words around it.
NAMES = 100_000
#: Elements whose content is not text of the page.
HIDDEN = frozenset("head script style noscript template iframe object svg math canvas audio video select datalist textarea title".split())
#: Of those, the ones in which tags are not tags.
RAW = frozenset("script style textarea title noscript iframe".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that hold a part of a page; these and elements with a class, id or role give words their score.
PARTS = frozenset("article main section nav header footer aside form dialog menu button search fieldset".split())
#: Names that mark what is not the article, and names that mark it: first counts of the learner.
OUTSIDE = frozenset(
    "nav footer aside form dialog menu button search fieldset ad ads advert adverts advertisement advertising sponsor sponsored promo promotion "
    "banner cookie cookies consent gdpr notice notices alert popup modal overlay sidebar breadcrumb breadcrumbs menubar navigation navbar "
    "pagination comment comments disqus replies respond share sharing social related recommended newsletter subscribe subscription signup login "
    "toolbar widget copyright masthead topbar".split()
)
INSIDE = frozenset("article main articlebody".split())
#: What closes an open `p`, and what closes an element of its own kind.
_ENDS_P = BLOCKS - {"body", "html"}
_ENDS_SELF = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

_START = re.compile(r"<(?:(!--)|(/?)([a-zA-Z][^\s/>]*)|[!?/])")
_COMMENT_END = re.compile(r"--!?>")
_IN_TAG = re.compile(r"[>\"']")
_NAMES = re.compile(r"(?:^|[\s/])(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_HIDES = re.compile(r"(?:^|[\s/])(?:hidden(?=[\s/=]|\Z)|aria-hidden\s*=\s*[\"']?true)|display\s*:\s*none", re.IGNORECASE)
_SPLIT = re.compile(r"[^a-z0-9]+")
WORD, TAG, BREAK = 0, 1, 2


class Frame:
    """The names of the parts around a text, as far as readers need them: own names, and what holds for all of them up to the page."""

    __slots__ = ("parent", "names", "fresh", "inside", "outside", "note")

    def __init__(self, parent: Frame | None, names: list[str], fresh: list[str]):
        self.parent, self.names, self.fresh = parent, names, fresh
        self.inside = (parent is not None and parent.inside) or any(n in INSIDE for n in names)
        self.outside = (parent is not None and parent.outside) or any(n in OUTSIDE for n in names)
        self.note = None  # for the reader's use


class Reader:
    """Events of one page: (kind, text or tag, frame, hidden), in order. `frames` holds all frames, parents first.

    Every step takes time by what it reads or closes, never by how much is open, so a page takes time by its length.
    """

    def __init__(self, page: str):
        self.page = page
        self.frames = [Frame(None, [], [])]
        self.open: list[tuple[str, Frame, bool]] = []  # element, its frame, hidden
        self.tags: Counter[str] = Counter()  # open elements by tag
        self.names: Counter[str] = Counter()  # and by the names of their frames
        self.blocks: list[int] = []  # places of open block elements
        self.lost: set[int] = set()  # places from which no tag ends, as a quote stays open
        self.last = {q: page.rfind(q) for q in "\"'"}

    def _push(self, tag: str, attrs: str) -> None:
        frame, hidden = self._here()
        names = [tag] if tag in PARTS else []
        if "=" in attrs:
            for m in _NAMES.finditer(attrs):
                value = (m[2] or m[3] or m[4] or "").lower()
                names += [x for x in _SPLIT.split(value) if x]
        # A header inside an article belongs to it.
        if tag == "header" and frame.inside:
            names.remove("header")
        if names:
            frame = Frame(frame, names, [n for n in dict.fromkeys(names) if not self.names[n]])
            self.frames.append(frame)
            self.names.update(names)
        if tag in BLOCKS:
            self.blocks.append(len(self.open))
        self.tags[tag] += 1
        self.open.append((tag, frame, hidden or tag in HIDDEN or bool(attrs and _HIDES.search(attrs))))

    def _cut(self, k: int) -> None:
        """Close the elements from place `k` on."""
        while len(self.open) > k:
            tag, frame, _ = self.open.pop()
            self.tags[tag] -= 1
            if frame is not self._here()[0]:
                self.names.subtract(frame.names)
        while self.blocks and self.blocks[-1] >= k:
            self.blocks.pop()

    def _close(self, tag: str) -> None:
        if self.tags[tag] > 0:
            self._cut(next(k for k in range(len(self.open) - 1, -1, -1) if self.open[k][0] == tag))

    def _close_before(self, tag: str) -> None:
        """The innermost block ends where `tag` begins, if it cannot hold it."""
        if self.blocks:
            name = self.open[self.blocks[-1]][0]
            if name in _ENDS_SELF.get(tag, ()) or (name == "p" and tag in _ENDS_P):
                self._cut(self.blocks[-1])

    def _tag_end(self, at: int) -> int:
        """The place of the `>` that ends a tag: the first outside of quotes, or just the first if a quote stays open; -1 without any."""
        first, trail = at, []
        while at not in self.lost:
            trail.append(at)
            m = _IN_TAG.search(self.page, at)
            if m and m[0] == ">":
                return m.start()
            if not m or m.start() == self.last[m[0]]:
                break
            at = self.page.index(m[0], m.end()) + 1
        self.lost.update(trail)
        return self.page.find(">", first)

    def events(self) -> Iterator[tuple[int, str, Frame, bool]]:
        at, page = 0, self.page
        while True:
            m = _START.search(page, at)
            text = page[at : m.start()] if m else page[at:]
            if text:
                yield WORD, text, *self._here()
            if not m:
                return
            tag = (m[3] or "").lower()
            if m[1]:
                end = _COMMENT_END.search(page, m.end())
                at = end.end() if end else len(page)
                continue
            end = self._tag_end(m.end()) if tag else page.find(">", m.end())
            at = end + 1 if end >= 0 else len(page)
            if not tag or end < 0:
                continue
            attrs = page[m.end() : end]
            if m[2]:
                yield TAG, "/" + tag, *self._here()
                self._close(tag)
            else:
                self._close_before(tag)
                if tag not in VOID and not (attrs.endswith("/") and tag not in BLOCKS and tag not in HIDDEN):
                    self._push(tag, attrs)
                yield TAG, tag, *self._here()
                if tag in RAW:
                    close = re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE).search(page, at)
                    at = close.start() if close else len(page)

    def _here(self) -> tuple[Frame, bool]:
        return (self.open[-1][1], self.open[-1][2]) if self.open else (self.frames[0], False)


def count_names(page: str | None) -> tuple[Counter[str], Counter[str]]:
    """Words by the names of their enclosing parts, within and without the article of a page that marks it; nothing of other pages."""
    reader, marked = Reader(page or ""), False
    for kind, text, frame, hidden in reader.events():
        if kind == WORD and not hidden:
            inside = frame.inside and not frame.outside
            marked = marked or inside
            frame.note = frame.note or [0, 0]
            frame.note[not inside] += len(text.split())
    counts: tuple[Counter[str], Counter[str]] = Counter(), Counter()
    if marked:
        for frame in reversed(reader.frames):  # from the leaves to the page
            if frame.note is None:
                continue
            for name in frame.fresh:  # around it no part has the name
                for part in (0, 1):
                    counts[part][name] += frame.note[part]
            if frame.parent is not None:
                above = frame.parent.note = frame.parent.note or [0, 0]
                above[0], above[1] = above[0] + frame.note[0], above[1] + frame.note[1]
    return counts


def scores_of(inside: dict[str, int], outside: dict[str, int]) -> dict[str, float]:
    """Score of a word by the name of an enclosing part."""
    inside, outside = Counter(inside), Counter(outside)
    inside.update({n: 200 for n in INSIDE})
    outside.update({n: 200 for n in OUTSIDE} | {"header": 5})
    return {n: max(-4.0, min(4.0, math.log((inside[n] + 1) / (outside[n] + 1)))) for n in {*inside, *outside}}


def learn_scores(pages: DataFrame, sample: int = SAMPLE, names: int = NAMES) -> dict[str, float]:
    """Scores from about `sample` of the `pages` (page_id, html) that mark their article themselves.

    Pages are read where they are; the driver gets a table of names. Names that fewer than one in `names` of all counted words have around
    them are left out, so there are at most `names` times the depth of a page.
    """
    marked = pages.filter(F.lower("html").rlike(r"<article|<main|role\s*=\s*[\"']?main"))

    def made(texts: list[str | None]) -> dict[str, object]:
        inside, outside = Counter(), Counter()
        for text in texts:
            for total, found in zip((inside, outside), count_names(text)):
                total.update(found)
        whole = [(n, inside[n], outside[n]) for n in {*inside, *outside}]
        kind = pa.list_(pa.struct([("name", pa.string()), ("inside", pa.int64()), ("outside", pa.int64())]))
        return {"names": pa.array([whole] + [[]] * (len(texts) - 1), kind)}

    schema = "names array<struct<name: string, inside: long, outside: long>>"
    found = over_texts(hashed_share(marked.select("page_id", "html"), sample, "page_id", "html"), schema, made, [], text="html")
    counts = staged(found.select(F.inline("names")).groupBy("name").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside")), "part-names")
    total = counts.agg(F.sum(F.col("inside") + F.col("outside"))).first()[0] or 0
    rows = counts.filter((F.col("inside") + F.col("outside")) * names >= total).collect()
    return scores_of({r.name: r.inside for r in rows}, {r.name: r.outside for r in rows})


#: What a tag costs, and the score of a word that no part encloses.
TAG_COST = 0.3
BARE_WORD = 1.0
#: From this score down a word is not of the article, wherever it stands. It counts as REJECT outside of a marked article, and as nothing
#: inside of one, so that an advert between paragraphs does not end the region.
REJECT = -1.0


def part_score(frame: Frame, scores: dict[str, float]) -> tuple[float, float, float, bool]:
    """Least and largest score of the names around, the score of a word there, and whether it belongs to the article."""
    if frame.note is None:
        chain = []
        at: Frame | None = frame
        while at is not None and at.note is None:
            chain.append(at)
            at = at.parent
        least, most = (math.inf, -math.inf) if at is None else at.note[:2]
        for part in reversed(chain):
            known = [scores[n] for n in part.names if n in scores]
            least, most = min([least, *known]), max([most, *known])
            if min(least, 0.0) <= REJECT:
                part.note = (least, most, 0.0 if part.inside else REJECT, False)
            else:
                part.note = (least, most, BARE_WORD if most == -math.inf else most, True)
    return frame.note


def best_region(scores: list[float]) -> tuple[int, int]:
    """From where to where the sum is largest: by a linear scan, in which the best sum that ends at a place goes on or starts anew."""
    best, region, run, start = 0.0, (0, 0), 0.0, 0
    for i, score in enumerate(scores):
        if run <= 0:
            run, start = 0.0, i
        run += score
        if run > best:
            best, region = run, (start, i + 1)
    return region


def main_text(page: str | None, scores: dict[str, float]) -> str:
    """The article's blocks, joined by line ends."""
    pieces: list[tuple[int, str, float]] = []  # kind, text, score
    for kind, text, frame, hidden in Reader(page or "").events():
        score, belongs = part_score(frame, scores)[2:]
        if kind == TAG:
            name = text.removeprefix("/")
            pieces.append((BREAK if name in BLOCKS else TAG, " " if name == "br" else "", -TAG_COST))
        elif not hidden:
            pieces.append((WORD, text if belongs else "", score * len(text.split())))
    best_from, best_to = best_region([score for _, _, score in pieces])
    blocks: list[list[str]] = [[]]
    for kind, text, _ in pieces[best_from:best_to]:
        if kind == BREAK:
            blocks.append([])
        else:
            blocks[-1].append(text)
    lines = (" ".join(html.unescape("".join(b)).split()) for b in blocks)
    return "\n".join(line for line in lines if line)


def extract(pages: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """`page_id, url, text, n_chars` for every row of `pages` (page_id, url, html)."""
    scores = learn_scores(pages, sample)

    def run(texts: list[str | None]) -> dict[str, object]:
        found = [main_text(t, scores) for t in texts]
        return {"text": found, "n_chars": [len(t) for t in found]}

    return over_texts(pages, "text string, n_chars long", run, ["page_id", "url"], text="html")
