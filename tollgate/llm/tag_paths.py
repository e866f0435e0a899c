"""HTML extraction by tag-path ratios.

The text blocks of a page are grouped by their root-to-leaf tag path (tags with
their class, and a last step for blocks made of links).  Each path gets a text
ratio (characters per block) and a punctuation ratio (marks per block); both are
smoothed along the page, each block's smoothed and own ratios are fused by their
geometric mean, and the mean over a path's blocks is the path's ratio.  Paths at or over a threshold taken from the spread
of the ratios name the content: all their blocks are kept, wherever they stand.

Headings, captions and short items stand on paths of low ratio.  Such a block is
kept where the chosen blocks make up most of the element round it (lists, tables
and quotes counted to what holds them), within the innermost element that holds
nine tenths of the chosen text; an article or main that holds most of it speaks
for all its blocks.  Runs of two or more link blocks are menus and never kept so.

Paths through page furniture (navigation, headers, asides, forms, comments,
adverts, scripts) never count; a class such as ``article-header`` is none.  A form,
or an element that only its class or id makes furniture, is a mere wrapper where
the page has no article or main outside furniture and it holds one, or holds most
of the text of a page without any.

Time and memory are linear in the page, however long or malformed.

Defined results: null and empty pages give the empty text; pages without any
block outside furniture too; unclosed tags end with their container, unclosed
comments and tags with the page; a quote that is never closed belongs to an
unquoted value; repeated pages give repeated rows; an empty table gives no rows;
other columns, whatever their names, are not read.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.llm.common import map_arrow

# Element names of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr".split())
RAW = ("script", "style", "noscript", "template", "textarea", "title", "svg", "math", "iframe", "object", "canvas", "audio",
       "video", "select", "button", "head")
FURNITURE = frozenset("nav header footer aside form dialog menu fieldset".split())
FURNITURE_NAMES = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments cookie cookies consent disclaimer "
    "footer form header login masthead menu modal nav navbar navigation newsletter notice notices overlay pager pagination "
    "popup promo promotion recommended related reply replies respond share sharing sidebar signup social sponsor sponsored "
    "subscribe tags toolbar widget".split())
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu menubar toolbar".split())
#: Closed by the start of the same kind, or by the end of their container.
IMPLIED = {"p": ("p",), "li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th", "p"),
           "td": ("td", "th", "p"), "th": ("td", "th", "p"), "option": ("option",)}
MAIN = ("article", "main")
PUNCTUATION = frozenset(",.;:!?、。，！？…")
SMOOTHING = np.array([0.25, 0.5, 0.25])
#: Part of the standard deviation above zero that a path's ratio must reach.
STRENGTH = 0.5

#: Elements that say nothing by themselves about the text in them: what is round them decides.
STRUCTURE = frozenset("p ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote figure figcaption pre hr address "
                      "h1 h2 h3 h4 h5 h6 hgroup details summary".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: In a class like article-header these names mean the article's own opening, given one of the words of OWNERS.
OPENINGS = frozenset("header masthead banner".split())
OWNERS = frozenset("article body content entry main post story text".split())

_MARKUP = re.compile(r"<(?:!--|!\[CDATA\[|[!?]|/[^a-zA-Z]|(/?)([a-zA-Z][^\s/>]*))")
_GAP = re.compile(r"[\s/]*")
_ATTRIBUTE_NAME = re.compile(r"[^\s/>][^\s/>=]*")
_EQUALS = re.compile(r"\s*=\s*")
_UNQUOTED = re.compile(r"[^\s>]*")
_NAME = re.compile(r"[a-z]+")
_DIGITS = re.compile(r"\d+")
_CLOSE_RAW = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in RAW}

#: Furniture that may turn out to be a wrapper.
MAYBE = 2


def attributes(page: str, at: int, last: dict[str, int]) -> tuple[dict[str, str], int]:
    """Attributes of the tag whose name ends at ``at`` (the first of each name, values in lower case), and where the tag ends.

    ``last``: the last place of each quote in the page."""
    found: dict[str, str] = {}
    while True:
        at = _GAP.match(page, at).end()
        if at >= len(page):
            return found, at
        if page[at] == ">":
            return found, at + 1
        name = _ATTRIBUTE_NAME.match(page, at)
        at = name.end()
        value = ""
        if equals := _EQUALS.match(page, at):
            at = equals.end()
            quote = page[at:at + 1]
            if last.get(quote, -1) > at:
                stop = page.find(quote, at + 1)
                value, at = page[at + 1:stop], stop + 1
            else:
                plain = _UNQUOTED.match(page, at)
                value, at = plain[0], plain.end()
        found.setdefault(name[0].lower(), value.lower())


def is_furniture(tag: str, given: dict[str, str]) -> int:
    """0, 1, or MAYBE for forms and for elements that only their class or id makes furniture."""
    if tag in FURNITURE and tag not in ("form", "fieldset"):
        return 1
    found = MAYBE if tag in FURNITURE else 0
    if not given or tag in ("body", "html", *MAIN):
        return found
    if "hidden" in given or given.get("role") in FURNITURE_ROLES or given.get("aria-hidden") == "true":
        return 1
    if "style" in given and re.search(r"display\s*:\s*none", given["style"]):
        return 1
    for name in f"{given.get('class', '')} {given.get('id', '')}".split():
        words = set(_NAME.findall(name))
        named = words & FURNITURE_NAMES
        if named and not (named <= OPENINGS and words & OWNERS):
            return MAYBE
    return found


class Page:
    """Elements of a page by number (0: none) with parent, tag, path and kind of furniture; its text blocks outside
    sure furniture, in page order, as (element, path, text)."""

    def __init__(self, page: str):
        self.parent, self.tag, self.path, self.kind = [0], [""], [0], [0]
        self.paths: dict[tuple[int, str], int] = {}
        self.blocks: list[tuple[int, int, str]] = []
        self._read(page)

    def step(self, path: int, label: str) -> int:
        return self.paths.setdefault((path, label), len(self.paths) + 1)

    def _read(self, page: str) -> None:
        last = {q: page.rfind(q) for q in "\"'"}
        never_closed: set[str] = set()
        stack = [0]
        opened: dict[str, int] = {}
        buffer: list[str] = []
        linked = sure = 0
        link = None  # How many elements were open where the link began.

        def flush():
            nonlocal linked
            if buffer:
                text = " ".join(html.unescape("".join(buffer)).split())
                if text:
                    n = stack[-1]
                    path = self.path[n]
                    if 2 * linked > sum(map(len, buffer)):
                        path = self.step(path, "a")
                    self.blocks.append((n, path, text))
                buffer.clear()
            linked = 0

        def pop():
            nonlocal sure, link
            flush()
            n = stack.pop()
            opened[self.tag[n]] -= 1
            sure -= self.kind[n] == 1
            if link is not None and len(stack) < link:
                link = None

        at = 0
        while at < len(page):
            m = _MARKUP.search(page, at)
            stop = m.start() if m else len(page)
            if stop > at and not sure:
                buffer.append(page[at:stop])
                linked += (stop - at) * (link is not None)
            if not m:
                break
            at = m.end()
            if m[2] is None:
                end = {"<!--": "-->", "<![CDATA[": "]]>"}.get(m[0], ">")
                close = page.find(end, at - (m[0][1] == "/"))
                at = close + len(end) if close >= 0 else len(page)
                continue
            tag = m[2].lower()
            given, at = attributes(page, at, last)
            if m[1]:
                if tag == "a":
                    link = None
                if tag in INLINE:
                    continue
                if opened.get(tag):
                    while self.tag[stack[-1]] != tag:
                        pop()
                    pop()
                else:
                    flush()
                continue
            if tag == "head":
                continue
            if tag in RAW:
                close = None if tag in never_closed else _CLOSE_RAW[tag].search(page, at)
                if close:
                    end = page.find(">", close.end())
                    at = end + 1 if end >= 0 else len(page)
                elif tag in ("script", "style", "textarea", "title"):
                    break
                else:
                    never_closed.add(tag)
                continue
            if tag == "br":
                if not sure:
                    buffer.append(" ")
                continue
            if tag == "a":
                link = len(stack) if "href" in given else None
            if tag in INLINE or tag in VOID:
                if tag == "hr":
                    flush()
                continue
            flush()
            closes = IMPLIED.get(tag, ("p",))
            while self.tag[stack[-1]] in closes:
                pop()
            if page[at - 2:at] == "/>":
                continue
            kind = is_furniture(tag, given)
            name = _DIGITS.sub("", given.get("class", "")).split()
            self.path.append(self.step(self.path[stack[-1]], f"{tag}.{name[0]}" if name else tag))
            self.parent.append(stack[-1])
            self.tag.append(tag)
            self.kind.append(kind)
            stack.append(len(self.parent) - 1)
            opened[tag] = opened.get(tag, 0) + 1
            sure += kind == 1
        flush()

    def open_furniture(self) -> None:
        """Leave only the blocks outside furniture, doubtful elements opened as far as they are mere wrappers."""
        n = len(self.parent)
        sure, doubt = [False] * n, [0] * n
        for i in range(1, n):
            sure[i] = sure[self.parent[i]] or self.kind[i] == 1
            doubt[i] = i if self.kind[i] == MAYBE else doubt[self.parent[i]]
        own, own_main = [0] * n, [False] * n
        for i, _, text in self.blocks:
            own[doubt[i]] += len(text)
        for i in range(1, n):
            if self.tag[i] in MAIN and not sure[i]:
                own_main[doubt[i]] = True
        size, has = list(own), list(own_main)
        inner: dict[int, list[int]] = {}
        for i in range(n - 1, 0, -1):
            if doubt[i] == i and not sure[i]:
                outer = doubt[self.parent[i]]
                size[outer] += size[i]
                has[outer] = has[outer] or has[i]
                inner.setdefault(outer, []).append(i)
        opened = {0}
        level, main = [0], own_main[0]
        while not main and level:
            closed = [i for d in level for i in inner.get(d, ())]
            level = [i for i in closed if has[i]] if has[0] else [i for i in closed if 2 * size[i] > size[0]]
            opened.update(level)
            main = any(own_main[i] for i in level)
        self.blocks = [b for b in self.blocks if doubt[b[0]] in opened]


def path_ratios(paths: list[int], texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The fused ratio of each block's path, and the same before the mean over the path."""
    _, of, count = np.unique(np.array(paths), return_inverse=True, return_counts=True)
    smooth = lambda x: np.convolve(np.pad(x, 1, "edge"), SMOOTHING, "valid")
    per_path = lambda x: (np.bincount(of, np.array(x, float)) / count)[of]
    size = per_path([len(t) for t in texts])
    marks = per_path([sum(map(t.count, PUNCTUATION)) for t in texts])
    fused = np.sqrt(size * (marks + 0.5) * smooth(size) * smooth(marks + 0.5))
    return per_path(fused), fused


def main_text(page: str | None) -> str:
    tree = Page(page or "")
    tree.open_furniture()
    found = tree.blocks
    if not found:
        return ""
    ratio, fused = path_ratios([path for _, path, _ in found], [text for _, _, text in found])
    chosen = ratio >= min(STRENGTH * fused.std(), ratio.max())
    # Characters of all blocks, and of chosen ones, in each element.
    n = len(tree.parent)
    size, held = [0] * n, [0] * n
    for (i, _, text), c in zip(found, chosen):
        size[i] += len(text)
        held[i] += len(text) * bool(c)
    for i in range(n - 1, 0, -1):
        size[tree.parent[i]] += size[i]
        held[tree.parent[i]] += held[i]
    speaking = max((i for i in range(1, n) if tree.tag[i] in MAIN and 2 * held[i] > held[0]), default=0)
    box = speaking or max((i for i in range(1, n) if 10 * held[i] >= 9 * held[0] and tree.tag[i] not in STRUCTURE), default=0)
    # Whether an element lies in the box, and the nearest one round it that says something about its text.
    within, round_ = [box == 0] * n, list(range(n))
    for i in range(1, n):
        within[i] = i == box or within[tree.parent[i]]
        if tree.tag[i] in STRUCTURE:
            round_[i] = round_[tree.parent[i]]
    menu = [path != tree.path[i] and tree.tag[i] not in HEADINGS for i, path, _ in found]
    menu = [m and (a or b) for a, m, b in zip([False] + menu, menu, menu[1:] + [False])]
    keep = [text for (i, _, text), c, m in zip(found, chosen, menu)
            if c or not m and within[i] and (speaking or 2 * held[round_[i]] >= size[round_[i]])]
    return "\n\n".join(keep)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    slim = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(page).alias("html"))

    def task(batches):
        for batch in batches:
            texts = [main_text(p) for p in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return map_arrow(slim, task, T.StructType([slim.schema["page_id"], slim.schema["url"], T.StructField("text", T.StringType()),
                                               T.StructField("n_chars", T.LongType())]))
