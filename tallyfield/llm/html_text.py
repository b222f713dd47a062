"""Main text of web pages by smoothed text-to-tag ratios.

The standard library's parser streams a page's events. Text between block tags is one line; a line
knows its characters, the tags that came with it, and the container it stands in. Lines in
navigation, footers, asides, forms, scripts and styles, in elements whose role names such parts, or
in blocks of which a class or id does, are no candidates. Names of comments and adverts count as
part of a class or id, other names only as the whole of it. What a name or tag alone does not decide
is decided when the element ends: a block named a form, search or header goes unless it holds prose,
a header goes unless it stands in an article and holds a heading, an article in an article goes,
being a comment, unless it holds half of the other's text. Ratios of characters to tags are smoothed
over neighbouring lines by a Gaussian and split into two clusters by a threshold. The content region
is the innermost article or main element that holds nearly all of the high cluster's characters.
Without one, the innermost container that does is widened to the container that holds all content
lines: those of the high cluster, and headings, paragraphs and cells that are not mostly links. All
candidate lines of the region are its text, short ones too; what widening adds comes without lines
of links.

Cases. NULL, empty and text-free pages give an empty text. Broken markup is read as browsers do: an
end tag closes what is open inside it, an end tag without a start is ignored, an unknown declaration
or a comment without an end is a comment, an unfinished tag at the end goes, the end of the page
closes everything. The time of a page grows as its length, however its tags are nested; pages of any
length are taken whole. Repeated rows are kept; an empty table gives no rows. Columns of the input
are kept unless they clash with an added one, which then replaces it.
"""

from __future__ import annotations

import re
from functools import lru_cache
from html import unescape
from html.parser import HTMLParser

import numpy as np
from pyspark.sql import DataFrame

from tallyfield.llm.tables import add_columns

# Element and attribute names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike"
    " strong sub sup time tt u var wbr br img".split())
SKIPPED = frozenset(
    "head title script style noscript template nav footer aside form button select option textarea label"
    " fieldset iframe object svg math canvas audio video dialog menu".split())
# Parts that no block named so holds the article of.
SKIPPED_NAMES = frozenset(
    "ad ads adv advert advertisement advertising banner sponsor sponsored promo promotion nav navigation navbar menu"
    " submenu breadcrumb breadcrumbs footer sidebar aside widget cookie cookies consent notice notices"
    " alert popup modal overlay newsletter subscribe signup login share sharing social related recommended comment"
    " comments respond disqus reply replies toolbar pagination pager skip".split())
# Parts whose names also stand for what is written about them.
DOUBTFUL_NAMES = frozenset("form search header masthead".split())
# Words that a class or id may have beside one of the names, and the elements that are skipped by it.
PLACES = frozenset(
    "site page main global top bottom left right upper lower primary secondary mobile desktop inner outer wrapper wrap"
    " container box block area section bar list links link buttons button icons item items posts articles slot unit text"
    " title".split())
NAMED_BLOCKS = frozenset("div section td center table tr th ul ol dl li header".split())
# Words that name a comment or an advert wherever they stand in a class or id, the elements that are skipped by
# them, and the words beside which they mean something else.
CERTAIN_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adslot adunit adsbygoogle sponsor sponsored comment comments"
    " commentlist disqus".split())
CERTAIN_BLOCKS = NAMED_BLOCKS | frozenset("p dd dt figure figcaption blockquote pre".split())
OTHERWISE = frozenset("no not non without with has is free open opened closed count hoc on off enabled disabled about".split())
MOST_WORDS = 4  # of a class or id; longer ones are headings as words
ARTICLE_NAMES = frozenset("comment comments reply replies".split())
SKIPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search form menu menubar alert dialog alertdialog".split())
CONTAINERS = frozenset("html body div section article main td center blockquote".split())
ARTICLES = ("article", "main")
PARTS = frozenset(("td", "blockquote"))  # Containers that are no region of their own.
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
TEXT_BLOCKS = HEADINGS | frozenset("p li dt dd pre td th blockquote figcaption caption".split())
# What a new start tag ends, and what it does not reach beyond.
ENDED_BY_ITSELF = frozenset("p li dt dd option tr td th".split())
LISTS = frozenset("ul ol dl table".split())
STOPS = {tag: tuple(CONTAINERS - {tag} | LISTS) for tag in ENDED_BY_ITSELF}
INLINE_STOPS = tuple(CONTAINERS | {"p", "li"})
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+|[^\W\d_]+")
COMMENT_END = re.compile("--!?>")
UNFINISHED = re.compile("<[a-zA-Z/!?]")
# A start tag as the library gives it back as text when it cannot read it, and its attributes; a quote
# that is never closed ends with the tag.
LOOSE_TAG = re.compile(r"<([a-zA-Z][^\t\n\r\f />\x00]*)(.*?)(/?)>\Z", re.S)
LOOSE_ATTR = re.compile(r"""([^\s/>][^\s/=>]*)(?:\s*=\s*(?:'([^']*)'?|"([^"]*)"?|([^\s>]*)))?""")
# Characters of a line, not mostly links, that make a block prose.
PROSE = 80
# An article in an article that holds this share of its text is no comment.
INNER_SHARE = 0.5
# The container must hold this share of the characters in the high cluster.
SHARE = 0.8
SIGMA = 1.0


class Lines(HTMLParser):
    """Candidate lines of a page, as columns: text, tags, innermost container, whether it is mostly of links, whether
    it stands in a text block, whether in a heading; and the spans of lines to drop."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[str] = []
        self.ratio_tags: list[int] = []
        self.inner: list[int] = []
        self.linkish: list[bool] = []
        self.blocks: list[bool] = []
        self.dropped: list[tuple[int, int]] = []
        self.headings = self.prose = 0  # lines so far
        self.open: list[tuple[str, bool, int, tuple[int, int, int] | None]] = []  # tag, skipped, container, state if in doubt
        self.at: dict[str, list[int]] = {}  # places in ``open`` by tag
        self.tags_of: list[str] = []  # by container number
        self.parents: list[int] = []
        self.text: list[str] = []
        self.tags = 0
        self.skipping = 0
        self.in_blocks = self.in_headings = 0
        self.linked = 0  # characters of the line in links, without white space
        self.unended = False
        self.starting = False  # within the library's reading of a start tag

    def read(self, page: str) -> None:
        """All of a page. What follows the last tag cannot be one; the parser would try again at every sign."""
        end = page.rfind(">") + 1
        self.feed(page[:end])
        self.close()
        if not self.unended and self.cdata_elem is None:
            tail = UNFINISHED.split(page[end:], maxsplit=1)[0]
            self.handle_data(unescape(tail))
        self.end_line()
        self.leave_to(0)

    def parse_comment(self, i: int, report: int = 1) -> int:
        if self.rawdata.startswith((">", "->"), i + 4):
            return self.rawdata.index(">", i) + 1
        found = COMMENT_END.search(self.rawdata, i + 4)
        self.unended |= found is None
        return found.end() if found else len(self.rawdata)

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        return self.parse_bogus_comment(i)

    def parse_starttag(self, i: int) -> int:
        # Text given back for a start tag, at once or once the input has ended, is read as a tag if it can be.
        self.starting = True
        found = super().parse_starttag(i)
        self.starting = found < 0
        return found

    def loose_starttag(self, data: str) -> bool:
        """Read a start tag that the library gave back as text; whether it was one."""
        found = LOOSE_TAG.match(data)
        if not found:
            return False
        tag = found.group(1).lower()
        attrs = [(m.group(1).lower(), next((unescape(v) for v in m.group(2, 3, 4) if v is not None), None))
                 for m in LOOSE_ATTR.finditer(found.group(2))]
        if found.group(3):
            self.handle_startendtag(tag, attrs)
        else:
            self.handle_starttag(tag, attrs)
            if tag in self.CDATA_CONTENT_ELEMENTS:
                self.set_cdata_mode(tag)
        return True

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        if tag in INLINE or tag in VOID:
            if tag in ("br", "hr", "wbr"):
                self.text.append(" ")
            if tag in VOID:
                return
        else:
            self.end_line()
        # A repeated paragraph or item ends the one before.
        if tag in ENDED_BY_ITSELF:
            self.leave(tag, STOPS[tag])
        named, doubtful = (False, False) if tag in ("html", "body") else named_so(tag, attrs)
        skipped = tag in SKIPPED or named
        state = (len(self.lines), self.headings, self.prose) if doubtful or tag == "header" else None
        number = -1
        if tag in CONTAINERS:
            number = len(self.tags_of)
            self.tags_of.append(tag)
            self.parents.append(self.container())
        self.at.setdefault(tag, []).append(len(self.open))
        self.open.append((tag, skipped, number if number >= 0 else self.container(), state))
        self.skipping += skipped
        self.in_blocks += tag in TEXT_BLOCKS
        self.in_headings += tag in HEADINGS

    def container(self) -> int:
        return self.open[-1][2] if self.open else -1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in VOID:
            return
        if tag not in INLINE:
            self.end_line()
        # An inline end tag does not close blocks around it.
        self.leave(tag, INLINE_STOPS if tag in INLINE else ())

    def last(self, tag: str) -> int:
        places = self.at.get(tag)
        return places[-1] if places else -1

    def leave(self, tag: str, stops: tuple[str, ...]) -> None:
        k = self.last(tag)
        if k >= 0 and all(self.last(stop) <= k for stop in stops):
            self.leave_to(k)

    def leave_to(self, k: int) -> None:
        """Close all elements from place ``k`` on."""
        while len(self.open) > k:
            tag, skipped, _, state = self.open.pop()
            self.at[tag].pop()
            self.skipping -= skipped
            self.in_blocks -= tag in TEXT_BLOCKS
            self.in_headings -= tag in HEADINGS
            if state:
                first, headings, prose = state
                kept = self.last("article") >= 0 and self.headings > headings if tag == "header" else self.prose > prose
                if not kept:
                    self.dropped.append((first, len(self.lines)))

    def handle_data(self, data: str) -> None:
        starting, self.starting = self.starting, False
        if starting and self.loose_starttag(data):
            return
        if not self.skipping:
            self.text.append(data)
            if self.at.get("a"):
                self.linked += len("".join(data.split()))

    def end_line(self) -> None:
        line = " ".join("".join(self.text).split())
        self.text = []
        if line:
            linkish = 2 * self.linked > len(line) - line.count(" ")
            self.lines.append(line)
            self.ratio_tags.append(max(1, self.tags))
            self.inner.append(self.container())
            self.linkish.append(linkish)
            self.blocks.append(self.in_blocks > 0)
            self.headings += self.in_headings > 0
            self.prose += not linkish and len(line) >= PROSE
            self.tags = 0
        self.linked = 0


@lru_cache(10_000)
def name_kind(token: str) -> str:
    """What a class or id names: 'part' as a whole, 'doubtful' as a whole, 'certain' somewhere in it, or ''."""
    words = [w.lower() for w in NAME_PARTS.findall(token)]
    if not OTHERWISE.isdisjoint(words):
        return ""
    beside = [w for w in words if w not in PLACES and not w.isdigit()]
    if beside and all(w in SKIPPED_NAMES for w in beside):
        return "part"
    if beside and all(w in SKIPPED_NAMES or w in DOUBTFUL_NAMES for w in beside):
        return "doubtful"
    return "certain" if len(words) <= MOST_WORDS and not CERTAIN_NAMES.isdisjoint(words) else ""


def named_so(tag: str, attrs: list[tuple[str, str | None]]) -> tuple[bool, bool]:
    """Whether attributes name a part to skip, and whether they may do so."""
    doubtful = False
    for name, value in attrs:
        if name in ("class", "id") and value:
            for token in value.split():
                kind = name_kind(token)
                if kind == "part" and tag in NAMED_BLOCKS or kind == "certain" and tag in CERTAIN_BLOCKS:
                    return True, False
                if kind == "part" and (tag in CERTAIN_BLOCKS and has(token, CERTAIN_NAMES)
                                       or tag == "article" and has(token, ARTICLE_NAMES)):
                    return True, False
                doubtful |= kind == "doubtful" and tag in NAMED_BLOCKS
        elif name == "role" and value and value.strip().lower() in SKIPPED_ROLES:
            return True, False
        elif name == "hidden" or name == "aria-hidden" and value == "true":
            return True, False
    return False, doubtful


def has(token: str, names: frozenset[str]) -> bool:
    return any(w.lower() in names for w in NAME_PARTS.findall(token))


def smooth(values: np.ndarray) -> np.ndarray:
    """Gaussian mean over neighbours, of the neighbours that there are."""
    reach = np.arange(-3, 4)
    kernel = np.exp(-reach ** 2 / (2 * SIGMA ** 2))
    padded = np.convolve(values, kernel)[3:-3]
    return padded / np.convolve(np.ones(len(values)), kernel)[3:-3]


def high(values: np.ndarray) -> np.ndarray:
    """The upper of two clusters; all values if they do not differ."""
    cut = values.mean()
    while True:
        above = values >= cut
        if above.all():
            return above
        moved = (values[above].mean() + values[~above].mean()) / 2
        if moved <= cut or not (values >= moved).any():
            return above
        cut = moved


def main_text(html: str | None) -> str:
    """The main text of a page, blocks joined by a line feed."""
    page = Lines()
    page.read(html or "")
    parents, kept = page.parents, kept_lines(page)
    lines = [page.lines[i] for i in kept]
    if not lines:
        return ""
    inner = np.array(page.inner)[kept] + 1  # 0: in no container
    links, blocks = np.array(page.linkish)[kept], np.array(page.blocks)[kept]
    sizes = np.array(list(map(len, lines)), float)
    chosen = high(smooth(sizes / np.array(page.ratio_tags)[kept]))
    held = totals(parents, inner, sizes * chosen)
    enough = SHARE * (sizes * chosen).sum()
    good = [n for n, tag in enumerate(page.tags_of) if held[n + 1] >= enough and tag not in PARTS]
    articles = [n for n in good if page.tags_of[n] in ARTICLES]
    if articles:
        return "\n".join(line for line, within in zip(lines, inside(parents, max(articles))[inner], strict=True) if within)
    if not good:
        return "\n".join(lines)
    core = inside(parents, max(good))[inner]
    content = ~links & (chosen | blocks)
    each = totals(parents, inner, content.astype(float))
    around = max(good)
    while around >= 0 and each[around + 1] < content.sum():
        around = parents[around]
    wide = inside(parents, around)[inner]
    return "\n".join(line for line, c, w, link in zip(lines, core, wide, links, strict=True) if c or w and not link)


def kept_lines(page: Lines) -> np.ndarray:
    """Numbers of the lines that are in no dropped span, and in no article that is a comment on another."""
    depth = np.zeros(len(page.lines) + 1, int)
    for first, end in page.dropped:
        depth[first] += 1
        depth[end] -= 1
    kept = np.cumsum(depth)[:-1] == 0
    inner = np.array(page.inner, int) + 1
    sizes = totals(page.parents, inner, np.array(list(map(len, page.lines)), float) * kept)
    # By container: the innermost article around it, itself left out, and whether it is in a comment.
    outer, comment = [-1], [False]
    for n, parent in enumerate(page.parents):
        above = parent if parent >= 0 and page.tags_of[parent] == "article" else outer[parent + 1]
        outer.append(above)
        comment.append(comment[parent + 1] or page.tags_of[n] == "article" and above >= 0
                       and sizes[n + 1] < INNER_SHARE * sizes[above + 1])
    return np.flatnonzero(kept & ~np.array(comment)[inner])


def totals(parents: list[int], inner: np.ndarray, values: np.ndarray) -> list[float]:
    """Sum of the lines' values by container and all in it; place 0 is the page."""
    sums = np.bincount(inner, values, len(parents) + 1).tolist()
    for n in range(len(parents) - 1, -1, -1):
        sums[parents[n] + 1] += sums[n + 1]
    return sums


def inside(parents: list[int], region: int) -> np.ndarray:
    """By container, whether it is or lies in ``region``; place 0 is the page, as is region -1."""
    found = [region < 0]
    for n, parent in enumerate(parents):
        found.append(n == region or found[parent + 1])
    return np.array(found)


def extract(pages: DataFrame, html_col: str = "html", keep: list[str] | None = None) -> DataFrame:
    """``pages``, or its columns ``keep``, with ``text`` and its ``n_chars``."""
    def work(pages: list[str | None]) -> list:
        texts = [main_text(p) for p in pages]
        return [texts, [len(t) for t in texts]]

    return add_columns(pages.drop("text", "n_chars"), [html_col], "text string, n_chars long", lambda: work, keep)
