"""HTML extraction by tag-path ratios.

A page is cut into blocks, runs of text between block tags, each with its root-to-leaf tag path. Per path the text
length and the punctuation are summed and divided by the number of its blocks. Both ratios are smoothed over the
blocks in page order with a Gaussian, fused by a product, and compared with a share of their spread: paths above it
hold content. The article is the part of the page that holds the content blocks; its other blocks stay if they are
headings or stand beside content, so short paragraphs are kept.

Inside an article or main element the same limit decides: a path stays if the mean of its smoothed ratios and its own
ratio both reach it. The element only restores what stands beside such a path without a box of its own, as short
paragraphs, lists and tables do.

Paths that are mostly links are no content. Headings, and blocks that stay inside an article or main element, are never
left out for their links.

Elements that are never article text (menus, page headers, footers, sidebars, notices, adverts, forms, scripts,
styles, reader comments) are left out before by tag, role and state. Names leave out only where they say the same
plainly: a class such as ``ad`` or ``comments`` anywhere, and the words of ``_DOUBTFUL`` outside of the article. Inside
of an article or main element a doubtful name gives the element paths of its own and lowers their ratios to ``NAMED`` of
them, so that the ratios decide; an id counts there only if it is the plain word, since ids name chapters; headings are
never left out for their own name, nor a header that is the header of the post.

Defined cases: a null or empty page gives an empty text; a page without markup is one block; unclosed, stray and
cut-off tags do not fail; a very long page is read whole, one page at a time; extra columns are ignored; repeated rows
stay; no rows give no rows.
"""

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

from pingloom.llm.frames import prepare, tidied

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[A-Za-z][^\s/>]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>"
    r"|<(?P<close2>/?)(?P<tag2>[A-Za-z][^\s/>]*)(?P<rest2>[^>]*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"(?i)\b(class|id|role|style|hidden|aria-hidden|itemprop)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Their content is text up to the end tag, whatever stands in it.
_RAW = frozenset("script style noscript template iframe textarea title xmp noembed noframes".split())
_NEVER = frozenset(
    "head nav footer aside form button select option optgroup datalist fieldset dialog menu object canvas svg audio "
    "video map".split()
) | _RAW
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_ARTICLE = frozenset(("article", "main"))
# Elements of running text; blocks in any other element have a box of their own.
_TEXT = _HEADINGS | frozenset(
    "p ul ol li dl dt dd table caption thead tbody tfoot tr td th blockquote pre figure figcaption header hgroup".split()
)
# An open element of the second set ends when the tag opens inside it.
_P_ENDERS = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split()
)
_BLOCK = _P_ENDERS | _NEVER | frozenset(
    "html body p li dt dd tr td th thead tbody tfoot caption colgroup summary legend optgroup br article main".split()
)
_CLOSES = {
    "li": frozenset(("li",)), "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd")),
    "tr": frozenset(("tr", "td", "th")), "td": frozenset(("td", "th")), "th": frozenset(("td", "th")),
    "option": frozenset(("option",)), "tbody": frozenset(("thead", "tbody", "tr", "td", "th")),
}
_SCOPE = frozenset("ul ol dl table body html div section article main".split())

# Names of what is no article text; the second list also names chapters and parts of articles.
_PLAIN = (
    "ad|ads|advert|adverts|advertisement|advertising|sponsor|sponsored|promo|promoted|banner|cookie|cookies|"
    "consent|gdpr|notice|notices|notification|alert|popup|modal|overlay|paywall|newsletter|subscribe|subscription|signup|"
    "sidebar|widget|widgets|menu|nav|navbar|navigation|breadcrumb|breadcrumbs|pagination|pager|footer|masthead|"
    "comment|comments|disqus|respond|share|sharing|social|toolbar|login"
)
_DOUBTFUL = (
    "promotion|side|header|reply|replies|discussion|responses|related|recommended|recommendations|skip|search|toc|tags|"
    "taglist|byline-box|copyright|legal|disclaimer"
)


def _named(words: str) -> re.Pattern[str]:
    return re.compile(rf"(?:^|[-_])(?:{words})$|^(?:{words})(?:[-_]|$)", re.I)


_PLAIN_NAME, _DOUBTFUL_NAME = _named(_PLAIN), _named(_DOUBTFUL)
_PLAIN_WORD = re.compile(_PLAIN, re.I)
_POST_HEADER = re.compile(r"^(?:post|entry|article|story|content|chapter|section)[-_]header$", re.I)
_STATE = re.compile(r"^(?:has|with|no|without|is)[-_]", re.I)
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
_PUNCTUATION = re.compile(r"[.,;:!?…。,、;:!?¿¡»«“”\"()—–]")
# Share of the spread that a path must reach, and the width of the Gaussian in blocks.
THRESHOLD = 0.1
SIGMA = 1.0
LINK_SHARE = 0.6
# What is left of the ratio of a path under a doubtful name.
NAMED = 0.5
_LOWERED = "~"


@dataclass
class _Element:
    tag: str
    number: int
    dropped: bool
    article: bool
    path: str
    bare: bool


@dataclass
class _Block:
    text: str
    path: str
    elements: tuple[int, ...]
    heading: bool
    article: bool
    linked: int
    # Numbers of those of its elements that have no attributes.
    bare: frozenset[int]


def _verdict(tag: str, rest: str, in_article: bool) -> tuple[bool, bool]:
    """Whether an element is left out, and whether its paths are lowered."""
    if tag in _NEVER or (tag == "header" and not in_article):
        return True, False
    if "=" not in rest and "hidden" not in rest:
        return False, False
    lowered = False
    for name, value in _ATTRIBUTE.findall(rest):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True, False
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True, False
        if name == "role" and value.lower() in _ROLES:
            return True, False
        if name not in ("class", "id", "itemprop") or tag in ("html", "body", "main") or tag in _HEADINGS:
            continue
        words = [w for w in value.split() if not _STATE.match(w) and not _POST_HEADER.match(w)]
        if tag == "article":
            if any(_PLAIN_NAME.search(w) or _DOUBTFUL_NAME.search(w) for w in words) and re.search(r"(?i)\b(comment|reply)", value):
                return True, False
            continue
        plainly = _PLAIN_WORD.fullmatch if name == "id" and in_article else _PLAIN_NAME.search
        if any(plainly(w) for w in words):
            return True, False
        if any(_DOUBTFUL_NAME.search(w) or _PLAIN_NAME.search(w) for w in words):
            if not in_article:
                return True, False
            lowered = True
    return False, lowered


def blocks(page: str) -> list[_Block]:
    """The text blocks of a page in order, boilerplate left out."""
    found: list[_Block] = []
    stack: list[_Element] = []
    open_inline: list[str] = []
    parts: list[str] = []
    linked: list[str] = []
    state = {"number": 0}

    def plain(raw: list[str]) -> str:
        return " ".join(html.unescape("".join(raw)).split())

    def close_block() -> None:
        text = plain(parts) if parts else ""
        if text and not (stack and stack[-1].dropped):
            found.append(_Block(
                text, stack[-1].path if stack else "", tuple(e.number for e in stack),
                any(e.tag in _HEADINGS for e in stack), bool(stack and stack[-1].article), len(plain(linked)),
                frozenset(e.number for e in stack if e.bare),
            ))
        parts.clear()
        linked.clear()

    def pop_to(depth: int) -> None:
        close_block()
        del stack[depth:]

    def add(text: str) -> None:
        if text and not (stack and stack[-1].dropped):
            parts.append(text)
            if "a" in open_inline:
                linked.append(text)

    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            continue
        closing = bool(m["close"] or m["close2"])
        if tag not in _BLOCK:
            if not closing and tag not in _VOID:
                open_inline.append(tag)
            elif closing and tag in open_inline:
                open_inline.reverse()
                open_inline.remove(tag)
                open_inline.reverse()
            rest = m["rest"] or m["rest2"] or ""
            if not closing and tag not in _VOID and "=" in rest and _verdict(tag, rest, bool(stack and stack[-1].article))[0]:
                # An inline element that is no article text: skip to its end tag, if it has one.
                stop = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                if stop:
                    at = stop.end()
                    open_inline.pop()
            continue
        if closing:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth].tag == tag:
                    pop_to(depth)
                    break
            else:
                close_block()
            open_inline.clear()
            continue
        rest = m["rest"] or m["rest2"] or ""
        close_block()
        if tag in _VOID:
            continue
        if tag in _RAW:
            stop = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = stop.end() if stop else end
            continue
        open_inline.clear()
        if tag in _P_ENDERS:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth].tag == "p":
                    pop_to(depth)
                    break
                if stack[depth].tag in _SCOPE:
                    break
        for depth in range(len(stack) - 1, -1, -1):
            if stack[depth].tag in _CLOSES.get(tag, ()):
                pop_to(depth)
                break
            if stack[depth].tag in _SCOPE and tag not in ("tbody",):
                break
        above = stack[-1] if stack else None
        in_article = bool(above and above.article)
        out, lowered = _verdict(tag, rest, in_article)
        dropped = bool(above and above.dropped) or out
        state["number"] += 1
        name = tag + _LOWERED * lowered
        stack.append(_Element(
            tag, state["number"], dropped, in_article or (tag in _ARTICLE and not dropped),
            f"{above.path}/{name}" if above else name, not _ATTRIBUTE.search(rest),
        ))
    close_block()
    return found


def path_scores(found: list[_Block]) -> np.ndarray:
    """Fused, smoothed tag-path ratio of each block."""
    return _ratios(found)[0]


def _ratios(found: list[_Block]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each block: the fused, smoothed ratio, its mean over the path, and the fused ratio of the path alone."""
    paths = {p: i for i, p in enumerate(dict.fromkeys(b.path for b in found))}
    which = np.array([paths[b.path] for b in found])
    size = np.array([len(b.text) - b.linked for b in found], dtype=float).clip(0)
    marks = np.array([len(_PUNCTUATION.findall(b.text)) for b in found], dtype=float)
    n = np.bincount(which)
    text_ratio = (np.bincount(which, size) / n)[which]
    mark_ratio = (np.bincount(which, marks) / n)[which]
    reach = int(3 * SIGMA)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / SIGMA) ** 2)
    weight = np.convolve(np.ones(len(found)), kernel)[reach : reach + len(found)]

    def smooth(x: np.ndarray) -> np.ndarray:
        return np.convolve(x, kernel)[reach : reach + len(found)] / weight

    share = np.array([NAMED if _LOWERED in b.path else 1.0 for b in found])
    fused = smooth(text_ratio) * (1 + smooth(mark_ratio)) * share
    return fused, (np.bincount(which, fused) / n)[which], text_ratio * (1 + mark_ratio) * share


def _beside(found: list[_Block], chosen: np.ndarray) -> np.ndarray:
    """Blocks that stand in running text of an element that holds a chosen block.

    An element without attributes counts as running text for a block that is a sentence and not mostly a link.
    """
    hosts = {e for b, c in zip(found, chosen) if c for e in b.elements}

    def stands(b: _Block) -> bool:
        sentence = b.linked <= LINK_SHARE * len(b.text) and bool(_PUNCTUATION.search(b.text))
        return any(h in hosts for h in b.elements) and all(
            e in hosts or tag in _TEXT or (sentence and e in b.bare and not tag.endswith(_LOWERED))
            for e, tag in zip(b.elements, b.path.split("/"))
        )

    return np.array([stands(b) for b in found])


def main_text(page: str | None) -> str:
    """The article of one page: its blocks in page order, one per line."""
    found = blocks(page or "")
    if not found:
        return ""
    fused, path_mean, path_own = _ratios(found)
    limit = THRESHOLD * max(fused.std(), fused.mean())
    content = fused >= limit
    size, links = Counter(), Counter()
    for b in found:
        size[b.path] += len(b.text)
        links[b.path] += b.linked
    content &= np.array([links[b.path] <= LINK_SHARE * size[b.path] for b in found])
    if not content.any():
        content[:] = True
    inside = np.array([b.article for b in found])
    if (content & inside).any():
        part = inside
        chosen = inside & (path_mean >= limit) & (path_own >= limit)
        within = chosen | _beside(found, chosen) if chosen.any() else inside
    else:
        # The innermost element that holds all content blocks.
        shared = set.intersection(*[set(b.elements) for b, c in zip(found, content) if c])
        part = np.array([shared <= set(b.elements) for b in found])
        good_paths = {b.path for b, c in zip(found, content) if c}
        within = np.array([b.path in good_paths for b in found])
    keep = [p and (w or b.heading) for b, p, w in zip(found, part, within)]
    return "\n".join(b.text for b, k in zip(found, keep) if k)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every page."""
    prepare(pages.sparkSession)

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p.as_py()) for p in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
