"""Main text of a web page by scoring the containers of its tree.

Every block of text gives points for its length and its commas to its parent, and half of them to its
grandparent. A container's points are discounted by its link density; the best container is kept. An ``article`` or ``main`` around it
stands for it, else the outermost element that holds no further text. Its siblings are judged each by itself: containers stay that
score a fifth of it or are of its kind with a whole sentence and few links, headings, paragraphs, lists and the like where
less than half of their text is linked. Beside an ``article`` or ``main`` only further ones stay.
Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments neither score nor
stay; they are known by tag, role, and words of class and id. A word says nothing beside one that says what the page has or lacks
(``no-sidebar``, ``comments-open``), nor on an element that holds most of the page's unlinked text and its article or heading.

Defined results: null or empty html, or pages without text outside those parts, give an empty text.
Unclosed and stray tags are read as browsers do (a new paragraph ends an open one). Only html is looked at;
repeated rows give equal texts; all columns are kept, of equal names the made one stays.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import keep_names, or_empty

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>",
    re.S,
)
#: A tag whose quotes don't close, up to the next end of a tag.
LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
# Elements of HTML by what they mean for the text.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template textarea title iframe xmp noembed noframes".split())
UNWANTED = RAW | set("head nav header footer aside form button select option datalist dialog menu svg canvas object applet audio video map".split())
BLOCKS = set(
    "html body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody tfoot tr td th "
    "blockquote pre figure figcaption address details summary fieldset center hgroup hr".split()
) | UNWANTED
ENDS_PARAGRAPH = set(
    "address article aside blockquote center details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr main menu nav ol p pre section table ul".split()
)
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
SCOPE = {"table", "td", "th", "caption", "html", "button", "object"}
HOLDERS = {"article", "main", "section", "div", "body", "td", "blockquote"}
UNWANTED_NAME = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|menu|nav\w*|breadcrumbs?|sidebar\w*|side|aside|footer|header|"
    r"masthead|cookies?|notices?|alert|consent|gdpr|popup|modal|overlay|newsletter|subscri\w*|shar(?:e|ing)|social|related|"
    r"recommend\w*|comments?|commentlist|replies|reply|respond|disqus|login|signup|widget|pagination|pager|toolbar|skip)(?:$|[\s_-])",
    re.I,
)
#: Names that tell what the page has, lacks or allows, not what the element is.
STATE_NAME = re.compile(r"(?:^|[_-])(?:has|have|no|not|with|without|hide|show)[_-]|[_-](?:open|opened|closed|hidden|enabled|disabled|active|on|off)$", re.I)
SENTENCE = re.compile(r"[.!?\u2026\u3002]")
#: Linked part of their text from which siblings are left out: containers, and other blocks.
LINKED_HOLDER, LINKED_BLOCK = 0.25, 0.5
UNWANTED_ROLE = {"navigation", "banner", "complementary", "contentinfo", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar", "toolbar"}
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _unwanted(tag: str, attributes: str) -> bool:
    """Whether tag, role or style say so."""
    if tag in UNWANTED:
        return True
    if not attributes or tag in ("html", "body"):
        return False
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "role" and value.strip().lower() in UNWANTED_ROLE:
            return True
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and HIDDEN.search(value):
            return True
    return False


def _unwanted_name(tag: str, attributes: str) -> bool:
    """Whether a word of class or id says so."""
    if not attributes or tag in ("html", "body"):
        return False
    values = (m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes) if m[1].lower() in ("class", "id"))
    return any(UNWANTED_NAME.search(word) and not STATE_NAME.search(word) for value in values for word in value.split())


class Page:
    """Tree of a page in order of its elements: the part below an element is ``element .. end[element]``."""

    def __init__(self, html: str):
        self.tags, self.parents, self.end = ["#"], [-1], [0]
        self.blocks: list[tuple[int, str, int]] = []  # element, text, characters of it inside links
        self.named: list[int] = []  # blocks that their names speak against
        self._open, self._off, self._words, self._linked, self._in_link = [0], 0, [], 0, 0
        # Places in the stack of open elements: of each tag, and of blocks.
        self._places, self._blocks = defaultdict(list), [0]
        at = 0
        while m := self._next(html, at):
            if m.start() > at:
                self._text(html[at : m.start()])
            at = m.end()
            if m[2] is None:
                if m[0].startswith("<![CDATA["):
                    self._text(m[0][9:].removesuffix("]]>"))
                continue
            tag = m[2].lower()
            if m[1]:
                self._close(tag)
            elif tag in RAW:
                close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(html, at)
                at = close.end() if close else len(html)
            else:
                self._start(tag, m[3])
        self._text(html[at:])
        self._flush()
        while self._open:
            self._pop()

    def _next(self, html: str, at: int) -> re.Match | None:
        """The next tag, comment or declaration. Each ``<`` is looked at once: behind the last ``>`` nothing ends any more, and a
        comment without end reaches to the end of the page."""
        last = html.rfind(">")
        while (at := html.find("<", at)) >= 0:
            if at > last and not html.startswith(("<!--", "<![CDATA["), at):
                return None
            if m := TOKEN.match(html, at) or LOOSE.match(html, at):
                return m
            at += 1
        return None

    def _text(self, text: str) -> None:
        if self._off:
            return
        self._words.append(unescape(text))
        if self._in_link:
            self._linked += len(text)

    def _flush(self) -> None:
        if self._words:
            text = " ".join("".join(self._words).split())
            if text:
                self.blocks.append((self._open[self._blocks[-1]], text, min(self._linked, len(text))))
            self._words, self._linked = [], 0

    def _start(self, tag: str, attributes: str) -> None:
        if tag in BLOCKS:
            self._flush()
        elif tag == "br":
            self._words.append(" ")
        if tag in ENDS_PARAGRAPH:
            self._close_open({"p"}, SCOPE)
        elif tag in CLOSES:
            self._close_open(*CLOSES[tag])
        if tag in VOID:
            return
        node = len(self.tags)
        off = bool(self._off) or _unwanted(tag, attributes)
        if not off and _unwanted_name(tag, attributes):
            if tag in BLOCKS:
                self.named.append(node)
            else:
                off = True
        self.tags.append(tag)
        self.parents.append(self._open[-1])
        self.end.append(node)
        self._places[tag].append(len(self._open))
        if tag in BLOCKS:
            self._blocks.append(len(self._open))
        self._open.append(node)
        self._off += off
        self._in_link += tag == "a"

    def _pop(self) -> None:
        node = self._open.pop()
        self.end[node] = len(self.tags) - 1
        if node:
            self._places[self.tags[node]].pop()
            if self.tags[node] in BLOCKS:
                self._blocks.pop()
        self._off -= bool(self._off)
        self._in_link -= self.tags[node] == "a" and node > 0

    def _close_open(self, tags: set[str], until: set[str]) -> None:
        n = self._last(tags)
        if n > self._last(until):
            self._flush()
            while len(self._open) > n:
                self._pop()

    def _last(self, tags: set[str]) -> int:
        """Place of the innermost open element of one of the tags; 0 if none is open."""
        return max((self._places[t][-1] for t in tags if self._places.get(t)), default=0)

    def _close(self, tag: str) -> None:
        n = self._last({tag})
        # An inline end tag never closes blocks around it.
        if not n or tag not in BLOCKS and n < self._blocks[-1]:
            return
        if tag in BLOCKS:
            self._flush()
        while len(self._open) > n:
            self._pop()

    def _without_named(self) -> list[tuple[int, str, int]]:
        """The blocks outside elements that their names speak against."""
        if not self.named:
            return self.blocks
        around, named = [0] * len(self.tags), set(self.named)  # the innermost such element, itself included
        holds = set()
        for n in range(1, len(self.tags)):
            around[n] = n if n in named else around[self.parents[n]]
            if around[n] != n and self.tags[n] in ("article", "main", "h1"):
                holds.add(around[n])
        plain = [0] * len(self.tags)
        for node, text, linked in self.blocks:
            plain[node] += len(text) - linked
        for n in range(len(self.tags) - 1, 0, -1):
            plain[self.parents[n]] += plain[n]
        cut = [False] * len(self.tags)
        for n in range(1, len(self.tags)):
            cut[n] = cut[self.parents[n]] or n in named and not (n in holds and 2 * plain[n] > plain[0])
        return [b for b in self.blocks if not cut[b[0]]]

    def main_text(self) -> str:
        blocks = self._without_named()
        if not blocks:
            return ""
        points: dict[int, float] = {}
        length, linked, sentence = [0] * len(self.tags), [0] * len(self.tags), [False] * len(self.tags)
        for node, text, in_links in blocks:
            gain = 1 + text.count(",") + len(text) / 100
            first = node if self.tags[node] in HOLDERS else self.parents[node]
            if first > 0:
                points[first] = points.get(first, 0) + gain
                if self.parents[first] > 0:
                    points[self.parents[first]] = points.get(self.parents[first], 0) + gain / 2
            length[node] += len(text)
            linked[node] += in_links
            sentence[node] |= SENTENCE.search(text) is not None
        for node in range(len(self.tags) - 1, 0, -1):
            length[self.parents[node]] += length[node]
            linked[self.parents[node]] += linked[node]
            sentence[self.parents[node]] |= sentence[node]
        score = {n: p * (1 - linked[n] / max(length[n], 1)) for n, p in points.items()}
        if not score:
            return "\n\n".join(t for _, t, _ in blocks)
        best = max(score, key=lambda n: (score[n], -n))
        top, around = 0, best
        while around > 0:
            if self.tags[around] in ("article", "main"):
                top = around
            around = self.parents[around]
        whole, enough = top > 0, 0.2 * score[best]
        if not whole:
            top = best
            while self.parents[top] > 0 and length[self.parents[top]] == length[top]:
                top = self.parents[top]
        beside = self.parents[top]

        def stays(n: int) -> bool:
            """Whether a sibling with text belongs to the article."""
            same, density = self.tags[n] == self.tags[top], linked[n] / length[n]
            if whole:
                return same and score.get(n, 0) >= enough
            if score.get(n, 0) >= enough:
                return True
            if self.tags[n] in HOLDERS:
                return (same or self.tags[n] == "section") and sentence[n] and density < LINKED_HOLDER
            return density < LINKED_BLOCK

        kept = [False] * len(self.tags)  # parents come before their children
        for n in range(1, len(self.tags)):
            kept[n] = kept[self.parents[n]] or n == top or self.parents[n] == beside and length[n] > 0 and stays(n)
        # Text right in the parent of the best container is a block of its own.
        bare = lambda node, text, links: node == beside and not whole and links < LINKED_BLOCK * len(text)
        return "\n\n".join(t for node, t, links in blocks if kept[node] or bare(node, t, links))


def main_text(html: str | None) -> str:
    return Page(html).main_text() if html else ""


def with_main_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """Adds text and n_chars (code points) to every row."""

    @F.pandas_udf("string")
    def extracted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(main_text)

    made = ("text", "n_chars")
    return pages.select(*keep_names(pages, *made), extracted(or_empty(html)).alias("text")).withColumn(
        "n_chars", F.char_length("text").cast("long")
    )
