"""Main text of web pages by tag-path ratios."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plaza.llm.common import pieces, small_batches

BATCH_BYTES = 4 << 20

# How HTML elements behave.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr html legend li listing main menu nav ol optgroup option p pre search section summary table tbody td "
    "tfoot th thead tr ul caption colgroup".split()
)
# Starting one of these ends an open one of those.
ENDS_P = BLOCKS - frozenset("dd dt li td th tr tbody thead tfoot caption colgroup option optgroup legend body html".split())
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",), "tbody": ("tbody", "thead", "tr", "td", "th"), "tfoot": ("tbody", "thead", "tr", "td", "th"), "body": ("head",),
}
LIMITS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",), "tbody": ("table",), "tfoot": ("table",)}

# Elements, roles and words of class and id that hold no main text.
NOT_TEXT = frozenset(
    "head script style noscript template nav footer aside form button select datalist iframe object embed applet svg canvas audio "
    "video menu dialog textarea title map".split()
)
# Those of the elements that hold readable blocks: they lower a block's score.
NAMED = frozenset("nav footer aside form menu dialog".split())
NOT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
NOT_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promoted promotion cookie cookies consent "
    "gdpr notice notices popup modal overlay newsletter subscribe subscription signup sidebar sidenav rail menu nav navbar navigation "
    "breadcrumb breadcrumbs header masthead topbar footer comment comments discussion disqus reply replies respond share sharing "
    "social related recommended recommendations widget widgets login search searchbox pagination pager toolbar skip "
    "hidden copyright disclaimer tags toc".split()
)
# These words may also name a part of the article, if one of those goes with them.
EITHER = frozenset("header banner tags widget widgets".split())
OF_ARTICLE = frozenset("article post entry content story body text".split())
WORD = re.compile(r"[a-z]+")
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|\b(hidden)\b""", re.I)
TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>|<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
CLASS = re.compile(r"""\bclass\s*=\s*["']?\s*([^\s"'>]+)""", re.I)
PUNCTUATION = re.compile(r"[,.;:!?…、。，；：！？]")
SPACE = re.compile(r"\s+")


@dataclass(slots=True)
class Node:
    """A run of text in one block of the page."""

    path: int
    text: str
    linked: int  # characters inside links
    parent: int  # number of the element around the block's own
    article: int  # number of the outermost article or main element around it, or 0
    suspect: int  # number of the innermost element around it whose class or id names boilerplate, or 0
    named: bool  # whether an element or role around it names boilerplate


@dataclass(slots=True)
class Suspect:
    """An element whose class or id names boilerplate."""

    around: int  # the suspect around it, or 0
    inside: bool  # whether it stands in an article
    size: int = 0  # unlinked characters in it
    article: bool = False  # whether it holds text of an article


@dataclass(slots=True)
class Open:
    """An element that has not ended."""

    name: str
    hidden: bool
    path: int
    number: int
    article: int
    suspect: int
    named: bool


ROOT = Open("", False, 0, 0, 0, 0, False)


def _boilerplate(name: str, attributes: str, inside_article: bool) -> tuple[bool, bool, bool]:
    """Whether an element is not shown, and whether its name or role, or its class or id, names boilerplate."""
    hidden, named, worded = name in NOT_TEXT and name not in NAMED, name in NAMED or name == "header" and not inside_article, False
    if not attributes or "=" not in attributes and "hidden" not in attributes.lower() or name in ("html", "body"):
        return hidden, named, worded
    for match in ATTRIBUTE.finditer(attributes):
        key = (match[1] or match[5]).lower()
        value = (match[2] or match[3] or match[4] or "").lower()
        if key in ("class", "id") and name not in ("article", "main"):
            words = WORD.findall(value)
            worded |= not (NOT_WORDS if OF_ARTICLE.isdisjoint(words) else NOT_WORDS - EITHER).isdisjoint(words)
        named |= key == "role" and value.strip() in NOT_ROLES
        hidden |= key == "hidden" or key == "aria-hidden" and value == "true"
        hidden |= key == "style" and bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value))
    return hidden, named, worded


def text_nodes(page: str) -> tuple[list[Node], list[Suspect]]:
    """The shown blocks of a page with the numbers of their paths from the root, and the elements that class words suspect.

    Every open element carries what holds for all inside it, so the time grows with the page and not with its depth.
    """
    stack: list[Open] = [ROOT]
    many: Counter[str] = Counter()  # open elements by name
    nodes: list[Node] = []
    suspects = [Suspect(0, False)]
    paths: dict[tuple[int, str], int] = {}
    held: list[str] = []
    linked = number = 0
    lower = None

    def close_block() -> None:
        nonlocal linked
        text = SPACE.sub(" ", html.unescape("".join(held))).strip()
        held.clear()
        top = stack[-1]
        if text and not top.hidden:
            place = len(stack) - 1
            while place > 0 and stack[place].name not in BLOCKS:
                place -= 1
            parent = stack[max(0, place - 1)].number
            nodes.append(Node(top.path, text, min(linked, len(text)), parent, top.article, top.suspect, top.named))
        linked = 0

    def hold(text: str) -> None:
        nonlocal linked
        held.append(text)
        linked += len(text) if many["a"] else 0

    def pop_to(place: int) -> None:
        if any(open_.name in BLOCKS for open_ in stack[place:]):
            close_block()
        many.subtract(open_.name for open_ in stack[place:])
        del stack[place:]

    def end_open(name: str, limits: tuple[str, ...] | frozenset[str]) -> None:
        """End the innermost open element of a name, unless one of ``limits`` stands before it."""
        for place in range(len(stack) - 1, 0, -1) if many[name] else ():
            if stack[place].name == name:
                pop_to(place)
                break
            if stack[place].name in limits:
                break

    at = 0
    while at < len(page):
        start = page.find("<", at)
        match = TAG.match(page, start) if start >= 0 else None
        shown = not stack[-1].hidden
        if match is None:
            end = len(page) if start < 0 else start + 1
            if shown:
                hold(page[at:end])
            at = end
            continue
        if shown and start > at:
            hold(page[at:start])
        at = match.end()
        name = match[2] or match[5]
        if not name:
            continue
        name, closing, attributes = name.lower(), match[1] or match[4], match[3] or match[6] or ""
        if closing:
            # An inline element does not reach out of its block.
            end_open(name, () if name in BLOCKS or name in NOT_TEXT else BLOCKS)
            continue
        if name == "br":
            if shown:
                held.append(" ")
            continue
        if name in ENDS_P:
            end_open("p", BLOCKS)
        for other in CLOSES.get(name, ()):
            end_open(other, LIMITS.get(name, ()))
        if name in BLOCKS:
            close_block()
        if name in VOID:
            continue
        if name in RAW:
            lower = page.lower() if lower is None else lower
            end = lower.find("</" + name, at)
            at = len(page) if end < 0 else (page.find(">", end) + 1 or len(page))
            continue
        if attributes.rstrip().endswith("/") and name in ("svg", "path"):
            continue
        around = stack[-1]
        hidden, named, worded = _boilerplate(name, attributes, bool(around.article))
        if name not in BLOCKS:  # parts of a line are shown or not
            hidden, named, worded = hidden or named or worded, False, False
            if hidden and not around.hidden and held and name in NOT_TEXT:
                held.append(" ")
        path, number = around.path, number + 1
        if name in BLOCKS:
            kind = CLASS.search(attributes) if attributes else None
            path = paths.setdefault((around.path, f"{name}.{kind[1].lower()}" if kind else name), len(paths) + 1)
        suspect, article = around.suspect, around.article
        if worded and not around.hidden:
            suspects.append(Suspect(suspect, bool(article)))
            suspect = len(suspects) - 1
        if name in ("article", "main") and not article:
            article = number
        stack.append(Open(name, around.hidden or hidden, path, number, article, suspect, around.named or named))
        many[name] += 1
    close_block()
    return nodes, suspects


def _lowered(nodes: list[Node], suspects: list[Suspect]) -> np.ndarray:
    """Blocks whose surroundings name boilerplate.

    Class words are weak signs: a suspect element is cleared by most of the unlinked text, or if it
    holds the only article of the page.
    """
    plain = [n for n in nodes if not n.named]
    for n in plain:
        suspects[n.suspect].size += len(n.text) - n.linked
        suspects[n.suspect].article |= bool(n.article)
    for s in suspects[:0:-1]:
        suspects[s.around].size += s.size
        suspects[s.around].article |= s.article
    total, free = suspects[0].size, any(n.article and not n.suspect for n in plain)
    cleared = [True]
    for s in suspects[1:]:
        cleared.append(cleared[s.around] and not free and (2 * s.size > total or s.article and not s.inside))
    return np.array([n.named or not cleared[n.suspect] for n in nodes])


def path_scores(nodes: list[Node], smooth: float = 1.0) -> np.ndarray:
    """For each block the unlinked text and punctuation per node of its path, smoothed along the page and fused.

    A block of links alone scores nothing, whatever stands next to it, unless an article holds it.
    """
    number = {path: k for k, path in enumerate(dict.fromkeys(n.path for n in nodes))}
    path = np.array([number[n.path] for n in nodes])
    whole = np.array([len(n.text) for n in nodes], float)
    size = whole - np.array([0 if n.article else n.linked for n in nodes], float)
    marks = np.array([len(PUNCTUATION.findall(n.text)) for n in nodes], float)
    many = np.bincount(path)
    text_ratio = (np.bincount(path, size) / many)[path]
    mark_ratio = (np.bincount(path, marks) / many)[path]
    reach = np.arange(-2, 3)
    kernel = np.exp(-(reach**2) / (2 * smooth**2))
    weight = np.convolve(np.ones(len(nodes)), kernel, "full")[2 : 2 + len(nodes)]

    def smoothed(x: np.ndarray) -> np.ndarray:
        return np.convolve(x, kernel, "full")[2 : 2 + len(nodes)] / weight

    return smoothed(text_ratio) * (1 + smoothed(mark_ratio)) * (size / whole) ** 2


def main_text(page: str | None, *, share: float = 0.1, trust: float = 20.0, doubt: float = 0.001) -> str:
    """The blocks whose path scores at least ``share`` of the mean over all text, joined by line breaks.

    Blocks inside an article or main element count ``trust`` times, as the page itself says what they
    are, and those that names call boilerplate ``doubt`` times. Blocks that no name speaks against
    stay also if they are of an article with a block that stays, or, unless they are links alone,
    between two that stay of one parent: short items and lines of a text. Without any block that no
    name speaks against the text is empty.
    """
    nodes, suspects = text_nodes(page or "")
    if not nodes:
        return ""
    lowered = _lowered(nodes, suspects)
    if lowered.all():
        return ""
    article = np.array([n.article for n in nodes])
    scores = path_scores(nodes) * np.where(article > 0, trust, 1.0) * np.where(lowered, doubt, 1.0)
    size = np.where(lowered, 0.0, [len(n.text) for n in nodes])
    kept = (scores > 0) & (scores >= share * float((scores * size).sum() / size.sum()))
    ends: dict[int, list[int]] = {}
    for k in np.flatnonzero(kept & ~lowered).tolist():
        ends.setdefault(nodes[k].parent, [k, k])[1] = k
    depth = np.zeros(len(nodes) + 1, int)
    for first, last in ends.values():
        depth[first] += 1
        depth[last + 1] -= 1
    between = (np.cumsum(depth)[:-1] > 0) & np.array([n.linked < len(n.text) for n in nodes])
    chosen = np.isin(article, article[kept & ~lowered & (article > 0)]) & (article > 0)
    kept |= ~lowered & (between | chosen)
    return "\n".join(n.text for n, stays in zip(nodes, kept.tolist(), strict=True) if stays)


def extract_text(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page, without a shuffle.

    A NULL or empty page, or one without main text, gives an empty text. Markup that is cut off or
    nested wrongly is read as far as it goes; text is never cut. Repeated rows give equal results.
    """
    small_batches(pages.sparkSession)
    given = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "html", BATCH_BYTES):
            texts = [main_text(page) for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in given.schema if f.name != "html")
    return given.mapInArrow(extract, f"{types}, text string, n_chars long")
