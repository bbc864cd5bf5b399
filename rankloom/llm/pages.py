"""Main text of web pages by scoring the element tree (operator 10).

A page becomes a list of elements in page order, each with its parent. Every block of text gives points, one and one more
per comma and per 100 characters (at most three), to its nearest container in full, to the next ones above in
falling parts. A container's points are discounted by its share of linked text. The best one is the article, or the article or
main element that it lies in; a sibling is kept if it scores a fifth as much, or is a paragraph of plain text when the siblings are
paragraphs, or a heading or plain text between kept ones. Elements that by
name, class, id, role or ``hidden`` are menus, headers, footers, sidebars, notices, adverts, forms or reader comments count for
nothing and are left out, as are lists in the article that are nearly all links. A class, id or role is no such name where it
tells of the layout (no-sidebar, has-comments), or where its element wraps most of the page's points.

Pages are worked on where they are read, one at a time; nothing is shuffled.

Defined cases: null and empty pages and pages without text outside such elements (wrappers aside) give the empty text; text outside any
tag is a block; unclosed elements end with their parent or where the standard closes them; an unclosed comment, script or style
takes the rest; after an unclosed quote in a tag, later tags of the page end at the next ">"; ties go to the element first in the
page; repeated rows give equal results; columns named like a result are replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType

from rankloom.llm.common import query, table
from rankloom.llm.words import map_texts

# Fixed values of HTML: elements without content, with raw content, and that begin a block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title svg math".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3"
    " h4 h5 h6 header hgroup html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
#: An opening tag of the key closes an open element of the value, up to the nearest container that stands between.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}}
HOLDS = frozenset("ul ol menu dl table".split())
LEFT_OUT = frozenset("nav footer aside form button select dialog menu object canvas audio video head label input fieldset".split())
#: Words in class, id or role that mark what is not the article.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar aside comment comments"
    " disqus respond reply replies notice notices alert cookie cookies consent gdpr popup modal overlay newsletter subscribe"
    " subscription signup login share sharing social related recommended breadcrumb breadcrumbs menu nav navbar navigation"
    " footer header masthead pagination pager toolbar widget complementary contentinfo search hidden".split())
#: Words before such a mark that make it one of layout; marks of reader comments, which may outweigh the article.
LAYOUT = frozenset("no not non has have with without".split())
READERS = frozenset("comment comments disqus respond reply replies".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
ATTRIBUTE = re.compile(r"""([a-zA-Z-]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?+""")
FALLING = (1.0, 0.5, 0.25, 0.125)
SIBLING, LINKED = 0.2, 0.8
ROOT = 0
EXTRACTED = StructType([StructField("text", StringType()), StructField("n_chars", LongType())])


def marks_of(value: str, in_article: bool) -> set[str]:
    """Marks in a class, id or role. A header inside an article is the article's own."""
    found = set()
    for name in value.split():
        for word in re.split(r"[_-]+", name):
            if word in LAYOUT:
                break
            if word in MARKS and not (word == "header" and in_article):
                found.add(word)
    return found


def excluded(tag: str, rest: str, in_article: bool) -> tuple[bool, set[str]]:
    """Whether an element is left out with all it holds in any case, and the marks for which it is unless it is a wrapper."""
    if tag in LEFT_OUT or (tag == "header" and not in_article):
        return True, set()
    marks: set[str] = set()
    if not rest or tag in ("html", "body", "article", "main"):
        return False, marks
    for name, value in ATTRIBUTE.findall(rest):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True, marks
        if name == "style" and re.search(r"display\s*:\s*none", value):
            return True, marks
        if name in ("class", "id", "role"):
            marks |= marks_of(value, in_article)
    return False, marks


class Page:
    """Elements as parallel lists; text blocks as (element, text, linked characters) in page order.

    ``out`` is 2 for elements left out in any case, 1 for those with marks that are not in ``spared`` (None: all are spared);
    ``lost`` is a bound on the points of the latter.
    """

    def __init__(self, html: str, spared: frozenset[int] | None = frozenset()) -> None:
        self.tags, self.parents, self.out = ["#page"], [-1], [0]
        self.spared, self.marks, self.lost = spared, {}, 0
        self.stack, self.open = [ROOT], Counter()
        self.blocks: list[tuple[int, str, int]] = []
        self.pending: list[str] = []
        self.owner, self.linked, self.links = ROOT, 0, Counter()
        self.read(html)

    def flush(self) -> None:
        text = " ".join("".join(self.pending).split())
        if text and not self.out[self.owner]:
            self.blocks.append((self.owner, text, min(self.linked, len(text))))
        self.pending, self.linked = [], 0

    def text(self, raw: str) -> None:
        if not raw:
            return
        out = self.out[self.stack[-1]]
        if out == 2:
            return
        plain = unescape(raw) if "&" in raw else raw
        if out:
            self.lost += 2 + plain.count(",") + min(len(plain) // 100, 3) if plain.strip() else 0
        else:
            self.pending.append(plain)
            if self.open["a"]:
                self.linked += len(" ".join(plain.split()))

    def begin(self, tag: str, rest: str) -> None:
        if tag == "br":
            self.text(" ")
        if tag in VOID:
            return
        if tag in BLOCKS:
            self.flush()
            if self.open["p"]:
                self.end("p")
        if tag in CLOSES:
            for at in range(len(self.stack) - 1, 0, -1):
                name = self.tags[self.stack[at]]
                if name in HOLDS:
                    break
                if name in CLOSES[tag]:
                    self.shut(at)
                    break
        above = self.stack[-1]
        inside = bool(self.open["article"] or self.open["main"])
        self.tags.append(tag)
        self.parents.append(above)
        left, marks = excluded(tag, rest, inside)
        e = len(self.out)
        if marks:
            self.marks[e] = marks
        self.out.append(self.out[above] or (2 if left else int(bool(marks) and self.spared is not None and e not in self.spared)))
        self.stack.append(len(self.tags) - 1)
        self.open[tag] += 1
        if tag in BLOCKS:
            self.owner = self.stack[-1]
        elif tag == "a":
            self.links[self.owner] += 1

    def shut(self, at: int) -> None:
        """Close the element at this place of the stack and all above it."""
        if any(self.tags[e] in BLOCKS for e in self.stack[at:]):
            self.flush()
        for e in self.stack[at:]:
            self.open[self.tags[e]] -= 1
        del self.stack[at:]
        self.owner = next(e for e in reversed(self.stack) if e == ROOT or self.tags[e] in BLOCKS)

    def end(self, tag: str) -> None:
        if self.open[tag] > 0:
            at = len(self.stack) - 1
            while self.tags[self.stack[at]] != tag:
                at -= 1
            self.shut(at)

    def read(self, html: str) -> None:
        at, size, pattern = 0, len(html), TAG
        while at < size:
            to = html.find("<", at)
            if to < 0:
                to = size
            self.text(html[at:to])
            if to == size:
                break
            head = html[to + 1:to + 2]
            if html.startswith("<!--", to):
                close = html.find("-->", to + 4)
                at = size if close < 0 else close + 3
            elif head in ("!", "?"):
                close = html.find(">", to)
                at = size if close < 0 else close + 1
            elif head == "/" or (head.isascii() and head.isalpha()):
                found = pattern.match(html, to)
                if not found and pattern is TAG:
                    pattern = PLAIN_TAG
                    found = pattern.match(html, to)
                if not found:
                    close = html.find(">", to) if head == "/" else -1  # "</>" is nothing; an unclosed tag takes the rest
                    at = size if close < 0 else close + 1
                    continue
                slash, tag, rest = found.groups()
                tag, at = tag.lower(), found.end()
                if slash:
                    self.end(tag)
                elif tag in RAW:
                    if not rest.endswith("/"):
                        close = re.compile(rf"</{tag}[\s/>]", re.I).search(html, at)
                        close = html.find(">", close.start()) if close else -1
                        at = size if close < 0 else close + 1
                else:
                    self.begin(tag, rest)
            else:
                self.text("<")
                at = to + 1
        self.flush()


def gain(text: str, in_links: int) -> float:
    """Points of a block."""
    return (1.0 + text.count(",") + min(len(text) // 100, 3)) * (1.0 - in_links / len(text))


def wrappers(html: str) -> frozenset[int]:
    """Elements with marks that hold several blocks and most of the page's points, and beside which no article stands."""
    page = Page(html, None)
    n = len(page.tags)
    points, blocks, last, titled = [0.0] * n, [0] * n, list(range(n)), [t in ("h1", "main") for t in page.tags]
    for e, text, in_links in page.blocks:
        points[e] += gain(text, in_links)
        blocks[e] += 1
    for e in range(n - 1, 0, -1):
        above = page.parents[e]
        points[above] += points[e]
        blocks[above] += blocks[e]
        last[above] = max(last[above], last[e])
        titled[above] |= titled[e] and blocks[e] > 0
    articles = [e for e in range(n) if page.tags[e] in ("article", "main")]
    return frozenset(
        e for e, marks in page.marks.items() if blocks[e] > 1 and 2 * points[e] > points[ROOT] and (titled[e] or not marks & READERS)
        and not any(points[a] >= SIBLING * points[e] and (a > last[e] or last[a] < e) for a in articles))


def main_text(html: str) -> str:
    """The article's blocks joined by blank lines."""
    page = Page(html)
    if page.lost > sum(gain(text, in_links) for _, text, in_links in page.blocks):
        spared = wrappers(html)
        page = Page(html, spared) if spared else page
    if not page.blocks:
        return ""
    n = len(page.tags)
    points, chars, linked, links = [0.0] * n, [0] * n, [0] * n, [0] * n
    for e, text, in_links in page.blocks:
        chars[e] += len(text)
        linked[e] += in_links
        # A paragraph is no container: its points begin one level up.
        above = page.parents[e] if page.tags[e] in HEADINGS or page.tags[e] in ("p", "pre", "blockquote", "li", "td") else e
        worth = gain(text, in_links)
        for part in FALLING:
            if above < 0:
                break
            points[above] += worth * part
            above = page.parents[above]
    for e, count in page.links.items():
        links[e] += count
    for e in range(n - 1, 0, -1):
        chars[page.parents[e]] += chars[e]
        linked[page.parents[e]] += linked[e]
        links[page.parents[e]] += links[e]
    score = [p * (1.0 - linked[e] / chars[e]) if chars[e] else 0.0 for e, p in enumerate(points)]
    best = max(range(n), key=lambda e: (score[e] * (1.5 if page.tags[e] in ("article", "main") else 1.0), -e))
    home = enclosing(page, best)
    above = page.parents[home]
    beside = [e for e in range(n) if above >= 0 and page.parents[e] == above and e != home and chars[e]]
    plain = {e for e in beside if linked[e] <= 0.25 * chars[e]}
    kept = {home} | {e for e in beside if score[e] >= max(3.0, SIBLING * score[best]) or (page.tags[e] == "p" and e in plain and chars[e] >= 80)}
    low, high = min(kept), max(kept)
    kept |= {e for e in beside if low < e < high and (e in plain or page.tags[e] in HEADINGS)}
    inside = [False] * n  # below a kept element and not in a list of links
    for e in range(n):
        menu = page.tags[e] in ("ul", "ol", "div", "table") and links[e] >= 3 and linked[e] > LINKED * chars[e]
        inside[e] = (e in kept or (e > 0 and inside[page.parents[e]])) and not menu
    shown = [b for b, (e, _, _) in enumerate(page.blocks) if inside[e]]
    return "\n\n".join(text for b, (e, text, in_links) in enumerate(page.blocks) if inside[e] or (
        e == above and shown and shown[0] < b < shown[-1] and in_links <= 0.25 * len(text)))


def enclosing(page: Page, best: int) -> int:
    """The outermost article that the best container lies in, else the nearest main element, else itself."""
    chain = [best]
    while page.parents[chain[-1]] >= 0:
        chain.append(page.parents[chain[-1]])
    articles, mains = ([e for e in chain if page.tags[e] == t] for t in ("article", "main"))
    return articles[-1] if articles else mains[0] if mains else best


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` with text and n_chars (code points)."""
    def make():
        def work(texts: list[bytes]) -> tuple[list, list]:
            out = [main_text(t.decode()) for t in texts]
            return out, [len(t) for t in out]
        return work

    return map_texts(pages, make, EXTRACTED, html_col)


@query("op10_main_text")
def op10(spark, sf_dir):
    """The main text of every page."""
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")
