"""Main text of web pages by line-block distribution.

Markup is stripped, block elements become lines, and the text lengths of
``BLOCK`` neighbouring lines are added up, on every page over all of its lines.
Text starts where the sum surges and ends where it dives to nothing.  Lines of
page furniture (menus, forms, adverts and the like) and link lists count as
empty; furniture and the borders of an article are as many empty lines as a block
has, so sums dive there.  An article or main element adds ``SURGE`` to the weight
of its lines if it has at least ``SHARE`` of the page's text; a teaser, an empty
main or one card of several has less, and the sums alone decide.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import bounded_batches, map_batches

#: Lines in a block, the sum at which text surges, and the share of a page's text from which an article adds weight.
BLOCK, SURGE, SHARE = 3, 80, 0.5

#: Elements whose text is no part of an article.
FURNITURE = frozenset("nav footer aside form script style noscript iframe svg template button select textarea dialog object canvas head title menu".split())
#: Those that pages are also wrapped in; like marked elements they are judged by what they hold.
WRAPPERS = frozenset("aside form head header".split())
#: Whole class, id or role tokens (``_`` as ``-``) that mark furniture.
MARKS = frozenset(
    "ad ads ad-banner ad-container ad-slot advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments comment-form comment-list comment-section comments-area comments-section "
    "consent contentinfo complementary cookie cookies cookie-banner cookie-consent cookie-notice disqus disqus-thread footer gdpr header main-menu main-nav main-navigation masthead menu modal nav nav-menu navbar "
    "navigation newsletter newsletter-signup notice page-footer popup promo promoted related related-articles related-content related-links related-posts search search-box search-form share share-buttons sharing "
    "sidebar signup site-footer site-header site-nav site-navigation skip skip-link social social-links social-share sponsor sponsored subscribe toolbar widget widget-area".split()
)
#: Elements that interrupt a line.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre "
    "section summary table tbody td tfoot th thead tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_ENDED_BY_BLOCK = frozenset(("p",))

_MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(script|style|title|textarea|noscript|iframe|template)\b[^>]*+>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?][^>]*+>|</?[a-zA-Z][^<>]*+\Z""",
    re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")


def _marked(attributes: str, inside: bool) -> bool:
    """Whether the attributes of an element mark furniture; the header inside an article or main is its headline."""
    if not attributes or attributes.isspace():
        return False
    for m in _ATTRIBUTE.finditer(attributes):
        name = m[1].lower()
        if name == "hidden":
            return True
        value = (m[2] or m[3] or m[4] or "").lower()
        if name == "aria-hidden" and value.strip() == "true":
            return True
        if name in ("class", "id", "role") and MARKS.intersection(value.replace("_", "-").split()) - ({"header"} if inside else set()):
            return True
    return False


def _without_furniture(lines: list[tuple[str, int, int, int]], outer: list[int], opened: list[int]) -> list[tuple[str, int, int]]:
    """Lines with a gap for each marked element that has neither the page's largest part nor most of its text.

    ``outer`` has the marked element around each marked element, ``opened`` the one that each part stands in; a marked
    element starts with a line of part -1.
    """
    held, own = [0] * len(outer), [0] * len(opened)
    for _, free, part, mark in lines:
        held[mark] += free
        # Comments inside an article are no text of it.
        own[part] += free if part > 0 and mark == opened[part] else 0
    for mark in range(len(outer) - 1, 0, -1):
        held[outer[mark]] += held[mark]
    kept = {0}
    if any(own[1:]):
        mark = opened[max(range(1, len(own)), key=own.__getitem__)]
        while mark:
            kept.add(mark)
            mark = outer[mark]
    dropped = [False] * len(outer)
    for mark in range(1, len(outer)):
        most = held[mark] >= SURGE and held[mark] > held[0] * SHARE
        dropped[mark] = dropped[outer[mark]] or not (most or mark in kept)
    out: list[tuple[str, int, int]] = []
    for text, free, part, mark in lines:
        if part < 0:
            out.extend([("", 0, 0)] * (BLOCK if dropped[mark] and not dropped[outer[mark]] else 0))
        elif not dropped[mark]:
            out.append((text, free, part))
    return out


def lines_of(page: str) -> tuple[list[tuple[str, int, int]], list[int]]:
    """Lines as (text, characters outside links, number of the article or main, 0: none), furniture as empty lines; the main around each number."""
    lines: list[tuple[str, int, int, int]] = []
    stack: list[str] = []
    dropped_at, article_at, main_at, link_at = 0, 0, 0, 0  # depth of the outermost open one, 0: none
    around, opened, outer = [0], [0], [0]
    part, main, mark = 0, 0, 0  # numbers of the innermost part, of the main and of the innermost marked element that are open
    marks_at: list[int] = []
    parts: list[str] = []
    free = 0

    def end_line() -> None:
        nonlocal free
        if parts:
            if text := " ".join("".join(parts).split()):
                lines.append((text, free, part, mark))
            parts.clear()
        free = 0

    def gap() -> None:
        end_line()
        lines.extend([("", 0, 0, mark)] * BLOCK)

    def shrink(depth: int) -> None:
        nonlocal dropped_at, article_at, main_at, link_at, part, main, mark
        del stack[depth:]
        if dropped_at > depth:
            dropped_at = 0
        while marks_at and marks_at[-1] > depth:
            end_line()
            marks_at.pop()
            mark = outer[mark]
        if article_at > depth:
            gap()
            article_at, part = 0, main
        if main_at > depth:
            gap()
            main_at = part = main = 0
        if link_at > depth:
            link_at = 0

    done = 0
    for m in _MARKUP.finditer(page):
        if m.start() > done and not dropped_at:
            text = html.unescape(page[done : m.start()])
            parts.append(text)
            if not link_at:
                free += len(text.strip())
        done = m.end()
        name = (m[3] or m[6] or "").lower()
        if not name:
            if m[1]:
                gap()
            continue
        block = name in BLOCKS
        if (m[2] or m[5]) == "/":
            if name in stack:
                was = dropped_at
                if block:
                    end_line()
                shrink(len(stack) - 1 - stack[::-1].index(name))
                if was and not dropped_at:
                    gap()
            continue
        if name == "br":
            parts.append(" ")
        if block:
            if not dropped_at:
                end_line()
            if stack and stack[-1] in _ENDED_BY_BLOCK:
                shrink(len(stack) - 1)
        attributes = m[4] if m[4] is not None else m[7] or ""
        if name in _VOID or attributes.endswith("/"):
            continue
        stack.append(name)
        if dropped_at:
            continue
        if name in FURNITURE and name not in WRAPPERS:
            gap()
            dropped_at = len(stack)
        elif name in WRAPPERS or (name not in ("html", "body", "main", "article") and _marked(attributes, part > 0)):
            if name != "header" or not part or _marked(attributes, True):
                end_line()
                outer.append(mark)
                mark = len(outer) - 1
                marks_at.append(len(stack))
                lines.append(("", 0, -1, mark))
            if name == "a" and not link_at:
                link_at = len(stack)
        elif not article_at and (name == "article" or (name == "main" and not main_at)):
            gap()
            part = len(around)
            around.append(main)
            opened.append(mark)
            if name == "main":
                main_at, main = len(stack), part
            else:
                article_at = len(stack)
        elif name == "a" and not link_at:
            link_at = len(stack)
    if done < len(page) and not dropped_at:
        parts.append(text := html.unescape(page[done:]))
        free += len(text.strip())
    end_line()
    return _without_furniture(lines, outer, opened), around


def _weights(lines: list[tuple[str, int, int]], around: list[int]) -> np.ndarray:
    """Characters outside links of each line; in the part that has most of the page's text, all characters and ``SURGE``, but for link lists."""
    free, part = np.array([line[1] for line in lines]), np.array([line[2] for line in lines])
    lengths = np.array([len(line[0]) for line in lines])
    if not free.any():
        return lengths * (part > 0)
    held = np.bincount(part, free, len(around))
    most = int(held[1:].argmax()) + 1 if len(around) > 1 else 0
    marked = ((part == most) | (part == around[most])) & (part > 0)
    if free[marked].sum() < SHARE * free.sum():
        return free
    links = np.flatnonzero(np.diff(np.concatenate([[0], (free == 0) & (lengths > 0), [0]])))
    for first, end in zip(links[::2], links[1::2], strict=True):
        if end - first >= BLOCK:
            marked[first:end] = False
    return np.where(marked & (lengths > 0), lengths + SURGE, free)


def main_text(page: str) -> str:
    """Text between surges and dives of the block sums; lines are joined by one space."""
    lines, around = lines_of(page)
    if not any(line[0] for line in lines):
        return ""
    weights = np.concatenate([_weights(lines, around), np.zeros(BLOCK, int)])
    sums = np.convolve(weights, np.ones(BLOCK, int))[BLOCK - 1 : BLOCK - 1 + len(lines)]
    surge = min(SURGE, int(weights.max()) or 1)
    kept, inside = [], False
    for i, (text, _, _) in enumerate(lines):
        if not inside:
            inside = bool(sums[i] >= surge and weights[i] > 0)
        elif sums[i] == 0:
            inside = False
        if inside and text and weights[i] > 0:
            kept.append(text)
    return " ".join(kept)


def _extracted(batch: pa.RecordBatch) -> pa.RecordBatch:
    found = [main_text(page) if page else "" for page in batch.column("html").to_pylist()]
    return pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(found, pa.string())], ["page_id", "url", "text"])


def extract_text(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages``: page_id, url and text, the main text of the whole page.

    Null and empty pages, and pages without text, have an empty text.  Broken
    markup is read as far as it goes: an element that is never closed ends with its
    parent, an unfinished tag at the end is dropped.  An element that its class, id or
    role marks as furniture is read if it holds the largest article or main, or most of the text.  Rows that repeat a page_id are read one
    by one; null ids and urls are kept.  Other columns are ignored.
    """
    bounded_batches(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return map_batches(rows, "page_id long, url string, text string", _extracted)
