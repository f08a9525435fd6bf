"""Main text of web pages by two passes of block rules.

First pass: a block is bad inside menus, headers, footers, sidebars, notices,
adverts, forms or comments, or where links hold most of it; it is good where it
is long and holds enough stop words, or is written in letters for which no stop words are known;
the rest is open.  Second pass: an open block takes the label of its nearest
decided neighbour in the same section, else of the section itself.  A page on
which nothing is good is short: its open sentences are its text.

Class, id and role tell where a block is, by any part of a name (`site-header`)
unless the name only says what the element has (`has-sidebar`).  An article or
main element starts afresh inside of what such a name or a form encloses, but
not inside of comments, adverts and the like; within an article only names of
these count.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Elements that end a block, elements whose content is never
# shown, elements that are not the article, and words that class, id or role
# use for such elements.
BLOCKS = frozenset("""
address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer
form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol option p pre section select summary table tbody td
tfoot th thead title tr ul
""".split())
HIDDEN = frozenset("script style noscript template svg math iframe object embed canvas audio video head title".split())
ASIDE = frozenset("nav footer aside button select textarea menu dialog".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = BLOCKS - {"option", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "body", "html", "title", "select"}
# Fixed values, continued: names of page parts; names of what is not part of an article even inside of one; first
# parts of names that say what an element has or how it behaves, and not what it is.
PLACES = frozenset("""
banner breadcrumb breadcrumbs consent cookie cookies footer header login masthead menu modal nav navbar navigation
newsletter notice popup share sharing sidebar signup social subscribe widget
""".split())
STRANGERS = frozenset("""
ad ads advert advertisement advertising adverts comment comments cookie cookies disqus newsletter promo promoted related
replies respond sponsor sponsored
""".split())
MODIFIERS = frozenset("has no with without is are not sticky fixed hide show js enable disable".split())
NAME_PARTS = re.compile(r"[-_]+")
#: How strongly a block is outside of the article: not, by its place (an article inside starts afresh), or for good.
IN, PLACE, STRANGER = 0, 1, 2
STOP_WORDS = frozenset("""
a an and are as at be by for from has he in is it its of on or that the this to was were will with you not but they
der die das und ist nicht ein eine mit von zu den dem des auf für sich im als auch es an er hat aus bei sie wie
le la les de des du et un une en que qui dans pour sur pas par au avec il est ce se ne plus son sont
el los las del y un una que en por con no para es al lo como más su se o este sus ya
""".split())
LONG_WORDS, SHORT_WORDS = 20, 5
STOP_DENSITY, LINK_DENSITY = 0.1, 0.5
GOOD, BAD, OPEN = 1, -1, 0
SPACE = re.compile(r"\s+")
#: Letters of the scripts that the stop words are written in.
LATIN = re.compile(r"[A-Za-z\u00C0-\u024F]")
LETTERS = re.compile(r"[^\W\d_]")
#: Letters that count as a word where words are not spaced.
UNSPACED_WORD = 4


class _Open:
    """An open element; ``p`` and ``li`` are the places of those that a sibling would end, or -1."""

    __slots__ = ("tag", "aside", "section", "hidden", "p", "li")

    def __init__(self, tag: str, aside: int, section: int, hidden: bool, p: int, li: int) -> None:
        self.tag, self.aside, self.section, self.hidden, self.p, self.li = tag, aside, section, hidden, p, li


_NOTHING = _Open("", IN, 0, False, -1, -1)


class _Blocks(HTMLParser):
    """Collects (text, link characters, in an aside, section) of each block; each step costs the same on average."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[str, int, bool, int]] = []
        self.open: list[_Open] = []
        self.places: dict[str, list[int]] = {}
        self.text: list[str] = []
        self.links = 0
        self.in_link = 0
        self.sections = 0
        self.articles: set[int] = set()

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """``<![`` has no meaning in a page; browsers read it as a comment."""
        return self.parse_bogus_comment(i)

    def state(self) -> _Open:
        return self.open[-1] if self.open else _NOTHING

    def flush(self) -> None:
        if self.text:
            text = SPACE.sub(" ", "".join(self.text)).strip()
            if text:
                state = self.state()
                self.blocks.append((text, self.links, state.aside != IN, state.section))
        self.text, self.links = [], 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in BLOCKS:
            self.flush()
        if tag == "a":
            self.in_link += 1
        if tag == "br":
            self.text.append(" ")
        if tag in VOID:
            return
        if tag in CLOSES_P and self.state().p >= 0:
            self.close_from(self.state().p)
        if tag == "li" and self.state().li >= 0:
            self.close_from(self.state().li)
        above, at = self.state(), len(self.open)
        aside, section = above.aside, above.section
        inside = section in self.articles
        if tag in ("article", "main") and aside == PLACE:
            aside = IN
        aside = max(aside, _by_name(tag, attrs, inside))
        if tag in ASIDE:
            aside = STRANGER
        elif tag == "form" or (tag == "header" and not inside):
            aside = max(aside, PLACE)
        if tag in ("article", "main") and aside == IN:
            self.sections += 1
            section = self.sections
            self.articles.add(section)
        p = at if tag == "p" else -1 if tag in CLOSES_P else above.p
        li = at if tag == "li" else -1 if tag in ("ul", "ol", "menu", "dir") else above.li
        self.open.append(_Open(tag, aside, section, above.hidden or tag in HIDDEN, p, li))
        self.places.setdefault(tag, []).append(at)

    def close_from(self, at: int) -> None:
        """End the element at this place and all that are open inside of it."""
        for element in self.open[at:]:
            self.places[element.tag].pop()
        del self.open[at:]

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        if tag in BLOCKS:
            self.flush()
        if tag == "br":
            self.text.append(" ")

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.flush()
        if tag == "a" and self.in_link:
            self.in_link -= 1
        if self.places.get(tag):
            self.close_from(self.places[tag][-1])

    def handle_data(self, data: str) -> None:
        if not self.state().hidden:
            self.text.append(data)
            if self.in_link:
                self.links += len(data.strip())


def _by_name(tag: str, attrs: list, inside: bool) -> int:
    """What class, id and role of an element say; the page itself and its main element have no such names."""
    if tag in ("html", "body", "main"):
        return IN
    found = IN
    for key, value in attrs:
        if not value or key not in ("class", "id", "role"):
            continue
        for name in value.lower().split():
            parts = NAME_PARTS.split(name)
            if parts[0] in MODIFIERS:
                continue
            if not STRANGERS.isdisjoint(parts):
                # Within an article, a word of several may be of its subject: only whole names and first parts count.
                if not inside or parts[0] in STRANGERS:
                    return STRANGER
            elif not inside and tag != "article" and not PLACES.isdisjoint(parts):
                found = PLACE
    return found


def _words_of(text: str) -> tuple[list[str], int, bool]:
    """Words, how many they count as, and whether stop words are known for the letters."""
    words = text.split()
    if text.isascii():
        return words, len(words), True
    letters = len(LETTERS.findall(text))
    known = 2 * len(LATIN.findall(text)) >= letters
    return words, len(words) if known else max(len(words), letters // UNSPACED_WORD), known


def _stop_share(words: list[str]) -> float:
    return sum(w.strip(".,;:!?\"'()").lower() in STOP_WORDS for w in words) / max(1, len(words))


def _first_label(text: str, links: int, aside: bool, in_article: bool) -> int:
    if aside:
        return BAD
    words, size, known = _words_of(text)
    if links > LINK_DENSITY * len(text):
        # A link is part of an article, a list of links is not; a short one is left open.
        return OPEN if in_article and size < LONG_WORDS else BAD
    if size < SHORT_WORDS:
        return OPEN
    if not known:
        return GOOD if in_article or size >= LONG_WORDS else OPEN
    if _stop_share(words) >= STOP_DENSITY and (in_article or size >= LONG_WORDS):
        return GOOD
    # Few stop words: outside an article that is a list or a label, inside it may be a table or another language.
    return BAD if size >= LONG_WORDS and not in_article else OPEN


def _is_sentence(text: str) -> bool:
    words, size, known = _words_of(text)
    return size >= SHORT_WORDS and (not known or _stop_share(words) >= STOP_DENSITY)


def extract_text(html: str | None) -> str:
    """The main text of one page; empty if there is none."""
    parser = _Blocks()
    parser.feed(html or "")
    parser.close()
    parser.flush()
    labels = [_first_label(t, n, aside, s in parser.articles) for t, n, aside, s in parser.blocks]
    sections = [s for *_, s in parser.blocks]
    asides = [aside for _, _, aside, _ in parser.blocks]
    decided = list(labels)
    near: dict[int, tuple[int, int]] = {}
    left: list[tuple[int, int] | None] = []
    for i, (label, s) in enumerate(zip(labels, sections)):
        if label and not (asides[i]):
            near[s] = (i, label)
        left.append(near.get(s))
    near = {}
    for i in range(len(labels) - 1, -1, -1):
        s = sections[i]
        if labels[i] and not asides[i]:
            near[s] = (i, labels[i])
        if labels[i] == OPEN:
            found = [x for x in (left[i], near.get(s)) if x]
            home = GOOD if s in parser.articles else BAD
            # At equal distance a good neighbour wins.
            decided[i] = min(((abs(j - i), -label) for j, label in found), default=(0, -home))[1] * -1
    if GOOD not in decided:
        decided = [GOOD if label == OPEN and _is_sentence(text) else BAD
                   for label, (text, *_) in zip(labels, parser.blocks)]
    # Where a page marks its article, what lies outside is not part of it.
    inside = any(label == GOOD and s in parser.articles for label, s in zip(decided, sections))
    return "\n".join(text for (text, _, _, s), label in zip(parser.blocks, decided)
                     if label == GOOD and (s in parser.articles or not inside))


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id_col``, ``url_col``, text, n_chars of every page; rows keep their number.

    A null page is an empty one and has an empty text.  Pages that break off
    inside a tag or a reference are read as far as they go, and no page is an
    error.  Other columns are
    not looked at.  Each page is one row's work: no shuffle.
    """
    narrow = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = pa.array([extract_text(h) for h in batch.column("html").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), text], ["id", "url", "text"])

    schema = narrow.select("id", "url", F.lit("").alias("text")).schema
    return (narrow.mapInArrow(work, schema)
            .select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text",
                    F.length("text").cast("long").alias("n_chars")))
