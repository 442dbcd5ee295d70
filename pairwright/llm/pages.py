"""Main text of web pages by two passes over their blocks.

Pass one decides blocks by what holds them (menus, notices, scripts and the like go), by the share of their text in links,
by length and by the share of stop words. Short and middling blocks stay open, and in pass two take the label of the
nearest decided neighbours. Where a page marks its article, blocks outside are decided against, and stop words alone do
not decide against a block inside.

Class and id stand for what is no article only where all words of a name say so (`search-form`, not `long-form`). Stop
words count only where the page is in a language they are of. A page with a long block of few links never ends up empty:
if nothing is left, forms are read too, then what names put aside, then what the stop words decided against.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

from pairwright.llm.common import pieces, plain

#: Elements that end a block; elements whose text is never shown; elements without an end.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td "
    "tfoot th thead tr ul".split()
)
UNSEEN = frozenset("head title script style template noscript iframe object embed svg math canvas audio video map datalist".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements, roles and words in class or id that stand for what is no article.
ASIDE_TAGS = frozenset("nav header footer aside form button select textarea menu dialog label fieldset".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
ASIDE_WORDS = frozenset(
    "nav navbar navigation menu topbar masthead header footer sidebar aside ad ads advert adverts advertisement advertising "
    "sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay newsletter "
    "subscribe subscription signup login share sharing social related recommended recommendations breadcrumb breadcrumbs "
    "pagination pager toolbar widget copyright legal disclaimer search form".split()
)
REPLY_WORDS = frozenset("comment comments commentlist disqus discussion respond replies reply feedback responses".split())
#: Words that say nothing beside these in a name.
PLACE_WORDS = frozenset(
    "area article articles block body bottom box button col column container element entry fixed global group holder icon inline "
    "inner is item items js left link links list main middle nested outer page post posts primary reader readers right row "
    "secondary section site slot small sticky stories sub the thread title top unit user users widgets wrap wrapper".split()
)
#: Elements that at times hold a whole page.
WEAK_TAGS = frozenset(["form", "fieldset"])
#: Frequent words of the languages that are read.
STOP_WORDS = frozenset(
    ("the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which one you "
     "were her all she there would their we him been has when who will no more if out so "
     "der die das und ist in den von zu mit sich des auf für nicht ein eine als auch es an werden aus er hat dass sie nach wird "
     "bei einer um am sind noch wie einem über so zum "
     "le la les de des du et en un une est que qui dans pour par sur pas au aux avec ce il elle plus son sa se ne ou mais sont "
     "el los las y del se su una con por para como más pero sus al lo este ha entre cuando muy sin sobre").split()
)
SHORT, LONG = 70, 200
LINKS_MOST, STOP_LEAST, STOP_ENOUGH = 0.5, 0.05, 0.2

_NO_ARTICLE = ASIDE_WORDS | REPLY_WORDS
_NAME = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"([a-z])([A-Z])")
_PUNCTUATION = re.compile(r"[\W\d_]+")
_SIGNS = re.compile(r"[\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af]")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_CLOSED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
}

GOOD, BAD, OPEN = 1, 0, None
FORM, NAME = 1, 2


@dataclass
class Block:
    text: str
    links: int
    aside: bool
    weak: int  # aside for certain (0), as a form (FORM) or by the name of a container (NAME)
    article: bool
    heading: bool
    out: bool = False
    label: int | None = OPEN

    @cached_property
    def size(self) -> int:
        """Characters; signs that stand for a syllable or a word count as three."""
        return len(self.text) if self.text.isascii() else len(self.text) + 2 * len(_SIGNS.findall(self.text))

    @cached_property
    def linked(self) -> bool:
        return self.links / max(1, len(self.text.replace(" ", ""))) > LINKS_MOST

    @cached_property
    def counts(self) -> tuple[int, int]:
        """Stop words, words."""
        words = [_PUNCTUATION.sub("", w) for w in self.text.lower().split()]
        words = [w for w in words if w]
        return sum(w in STOP_WORDS for w in words), len(words)

    @property
    def stops(self) -> float:
        stops, words = self.counts
        return stops / words if words else 0.0


@dataclass
class Element:
    """What holds for all within: `weak` is how weak the reasons to be aside are; `within` an aside or footer; `kin` is in
    an article that is not aside, with nothing but the header of it aside."""

    tag: str
    unseen: bool
    aside: bool
    weak: int
    reply: bool
    article: bool
    link: bool
    heading: bool
    within: bool
    kin: bool


def _says(names: str, wanted: frozenset[str]) -> bool:
    """Whether a name among these has a wanted word, and none but words for what is no article and where that stands."""
    for name in names.split():
        own = set(_NAME.findall(_CAMEL.sub(r"\1 \2", name).lower())) - PLACE_WORDS
        if own <= _NO_ARTICLE and not own.isdisjoint(wanted):
            return True
    return False


class Page(HTMLParser):
    """Cuts a page into blocks. Elements that are not closed end where a reader of pages would end them."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self.open: list[Element] = [Element("", False, False, 0, *[False] * 6)]
        self.where: dict[str, list[int]] = defaultdict(list)  # places of open elements by tag
        self.parts: list[str] = []
        self.links = 0
        self.breaks = 0

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        return self.parse_bogus_comment(i, report)

    def _end_block(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            top = self.open[-1]
            self.blocks.append(Block(text, self.links, top.aside, top.weak, top.article, top.heading))
        self.parts, self.links, self.breaks = [], 0, 0

    def _last(self, tags: Iterable[str]) -> int:
        return max((self.where[t][-1] for t in tags if self.where.get(t)), default=0)

    def _pop(self, to: int) -> None:
        if any(e.tag in BLOCKS for e in self.open[to:]):
            self._end_block()
        for e in self.open[to:]:
            self.where[e.tag].pop()
        del self.open[to:]

    def _close(self, tags: set[str] | frozenset[str], scope: set[str]) -> None:
        at = self._last(tags)
        if at > self._last(scope):
            self._pop(at)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "br":
            self.parts.append(" ")
            self.breaks += 1
            if self.breaks > 1:
                self._end_block()
            return
        if tag in BLOCKS:
            self._close({"p"}, {"button", "td", "th", "caption", "table", "article", "section", "div", "li", "body"})
            if tag in _CLOSED_BY:
                self._close(*_CLOSED_BY[tag])
            self._end_block()
        if tag in VOID:
            return
        given = {k: v or "" for k, v in attrs}
        names = f"{given.get('class', '')} {given.get('id', '')}"
        above = self.open[-1]
        reply = above.reply or _says(names, REPLY_WORDS)
        article = tag in ("article", "main") or given.get("role") in ("main", "article")
        marked = tag in ASIDE_TAGS or given.get("role", "").lower() in ASIDE_ROLES
        weak = (FORM if tag in WEAK_TAGS else 0) if marked else NAME if _says(names, ASIDE_WORDS) else 0
        own = marked or weak > 0
        if tag in ("body", "html"):
            own = False
        heading = tag[0] == "h" and tag[1:].isdigit()
        held = above.aside and (not article or above.within)
        aside = held or own or reply
        certain = reply or own and not weak or held and not above.weak
        weak = 0 if certain or not aside else max(weak if own else 0, above.weak if held else 0)
        if above.article and heading and not reply and above.kin:
            aside, weak = False, 0
        hidden = "hidden" in given or given.get("aria-hidden") == "true" or bool(_HIDDEN.search(given.get("style", "")))
        self.where[tag].append(len(self.open))
        self.open.append(Element(
            tag, above.unseen or tag in UNSEEN or hidden, aside, weak, reply, above.article or article, above.link or tag == "a",
            above.heading or heading, above.within or tag in ("aside", "footer"),
            not aside if tag in ("article", "main") else above.kin and (tag == "header" or not aside or above.aside),
        ))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        at = self._last([tag])
        if at and (tag in ("article", "main", "body", "html") or at > self._last(("article", "main", "body"))):
            self._pop(at)  # an end without a start does not end the article
        elif tag in BLOCKS:
            self._end_block()

    def handle_data(self, data: str) -> None:
        top = self.open[-1]
        if top.unseen or not data:
            return
        self.parts.append(data)
        stripped = len("".join(data.split()))
        if stripped:
            self.breaks = 0
        if top.link:
            self.links += stripped

    def finish(self) -> list[Block]:
        self.close()
        self._end_block()
        return self.blocks


def decide(blocks: list[Block], unheard: int = 0, words: bool = True) -> None:
    """Pass one. `unheard`: reasons up to this one put nothing aside; `words`: whether stop words decide."""
    for b in blocks:
        b.out = b.aside and not 0 < b.weak <= unheard
    held = [b for b in blocks if not b.out]
    marked = any(b.article for b in held)
    if words:
        counts = [b.counts for b in held if not b.linked and (b.article or not marked)]
        words = sum(c[0] for c in counts) >= STOP_LEAST * sum(c[1] for c in counts)
    for b in blocks:
        b.label = OPEN
        if b.out or marked and not b.article or b.linked:
            b.label = BAD
        elif b.heading or b.size < SHORT:
            b.label = OPEN
        elif not words:
            b.label = GOOD if b.size >= LONG else OPEN
        elif (stops := b.stops) >= STOP_ENOUGH:
            b.label = GOOD
        elif stops < STOP_LEAST and not b.article:
            b.label = BAD


def inherit(blocks: list[Block]) -> None:
    """Pass two: open blocks take the label of the nearest decided block; at equal distance with different labels, that
    of the block behind for headings, else the good one. Blocks in a marked article ask those of the article only."""
    for inside in (True, False):
        own = [b for b in blocks if b.article == inside and not (inside and b.out)]
        known = [(k, b.label) for k, b in enumerate(own) if b.label is not OPEN]
        if inside and not any(label == GOOD for _, label in known):
            known = []
        before: list[tuple[int, int] | None] = [None] * len(own)
        last = None
        for k, b in enumerate(own):
            last = (k, b.label) if b.label is not OPEN else last
            before[k] = last
        after = None
        for k in range(len(own) - 1, -1, -1):
            b = own[k]
            if b.label is not OPEN:
                after = (k, b.label)
                continue
            back = before[k]
            if not known or (back is None and after is None):
                b.label = GOOD
            elif back is None or after is None:
                b.label = (back or after)[1]
            elif back[1] == after[1]:
                b.label = back[1]
            elif k - back[0] != after[0] - k:
                b.label = back[1] if k - back[0] < after[0] - k else after[1]
            else:
                b.label = after[1] if b.heading else GOOD


def main_text(html: str | None) -> str:
    """The blocks that stay, one a line."""
    page = Page()
    page.feed(html or "")
    blocks = page.finish()
    for unheard, words in ((0, True), (FORM, True), (NAME, True), (NAME, False)):
        decide(blocks, unheard, words)
        inherit(blocks)
        kept = [b.text for b in blocks if b.label == GOOD]
        if kept or not any(b.size >= LONG and not b.linked and (b.weak or not b.aside) for b in blocks):
            break
    return "\n".join(kept)


def extract(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text, n_chars for every row. No shuffle.

    Null and empty pages have an empty text; very long pages are read whole; repeated rows each get a row; an empty table
    gives an empty table; further columns are ignored. What is cut off or not closed is read as far as it goes.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 64):
            texts = [main_text(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    read = pages.select(plain(id).alias("page_id"), plain(url).alias("url"), plain(html).alias("html"))
    kinds = [read.schema[c].dataType.simpleString() for c in ("page_id", "url")]
    return read.mapInArrow(run, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars bigint")
