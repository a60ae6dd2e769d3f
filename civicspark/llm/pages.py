"""Main text of HTML pages by line-block distribution.

Markup is stripped into lines, one for each block, and each line weighs as many characters as it has outside of links.
What stands in menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments leaves
empty lines, unless the text goes on around it within one box. Weights are summed over a sliding window of
lines; the text begins at a surge point, where that sum leaves nothing on its way to a threshold, and ends at the dive
point, where it has fallen to nothing again. Everything between a surge and its dive is kept, short lines included; lists
of links and short runs away from the text are not. Within an article or main element links weigh like other text.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .frames import tidy

# Element names of the HTML standard, and words of class, id and role names.
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
_RAW = frozenset("script style noscript template textarea title select iframe head".split())
_CHROME = frozenset("nav header footer aside form menu dialog button".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_ARTICLE = frozenset("article main".split())
#: What holds paragraphs; outside of them the page does.
_BOXES = frozenset("article center details div fieldset main section td th".split())
_CHROME_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies consent disqus footer form header "
    "masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted promotion related search share sharing "
    "sidebar sidebars signup social sponsor sponsored subscribe toolbar widget widgets contentinfo complementary alert".split()
)
#: What such words are joined with in names of page furniture; next to any other word they don't count ("related-work").
_PLAIN_WORDS = frozenset(
    "area bar block bottom box button buttons container count fixed global group icon icons inline inner item items left line link links list main module "
    "outer overlay panel post posts primary reply replies right secondary section site slot sticky story stories thread title top unit wrap wrapper zone".split()
)
#: Elements whose text is meant to be read; a short line in none of these counts only beside other text.
_TEXT = frozenset("p h1 h2 h3 h4 h5 h6 li dd dt blockquote pre td th figcaption caption summary".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What closes an open p.
_CLOSES_P = _BLOCKS - frozenset("li dd dt td th tr tbody thead tfoot caption option summary body html".split())
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(?:>|\Z)", re.S)
_MARKS = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[A-Za-z]+")


def _is_chrome(name: str, attributes: str) -> bool:
    if name in _CHROME:
        return True
    if not attributes or name in _ARTICLE or name in ("body", "html"):
        return False
    # each name counts alone, if all its words do: "ad-slot" and "site-header", not "has-sidebar" or "header-image"
    for match in _MARKS.finditer(attributes):
        for mark in (match[1] or match[2] or match[3] or "").split():
            found = {w.lower() for w in _WORD.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", mark))}
            if found & _CHROME_WORDS and found <= _CHROME_WORDS | _PLAIN_WORDS:
                return True
    return False


def lines_of(page: str) -> tuple[list[str], list[int], list[bool], list[int], list[bool], list[bool]]:
    """The page's blocks in order, white space turned into single spaces; the characters of each that stand outside of
    links; whether it stands in page furniture; the number of the article it stands in, or 0; whether it is furniture around
    which one text goes on; and whether it stands in no element for text."""
    texts: list[str] = []
    weights: list[int] = []
    bare: list[bool] = []
    furniture: list[bool] = []
    article: list[int] = []
    box_of: list[int] = []  # the innermost box of each block; of furniture, what stands around it
    part: list[str] = []
    linked: list[str] = []
    stack: list[tuple[str, bool, int, int, str]] = []  # name, in furniture, article, box, "link" or "heading" where in one
    outside = ("", False, 0, 0, "")
    chrome, inside, box, within, articles = False, 0, 0, "", 0
    opened, closed, around = [0], [size_ := len(page) + 1], [0]  # of each box: the block at its start and end, and its own box

    def close(depth: int) -> tuple[bool, int, int, str]:
        for _, _, _, b, _ in stack[depth:]:
            if b and b != (stack[depth - 1][3] if depth else 0):
                closed[b] = min(closed[b], len(texts))
        del stack[depth:]
        return (stack[-1] if stack else outside)[1:]

    def add(text: str) -> None:
        part.append(html.unescape(text))
        if within == "link":
            linked.append(part[-1])

    def end() -> None:
        if part:
            if line := " ".join("".join(part).split()):
                texts.append(line)
                weights.append(max(0, len(line) - len(" ".join("".join(linked).split()))))
                bare.append(not any(s[0] in _TEXT for s in stack))
                furniture.append(chrome)
                article.append(inside)
                box_of.append(box)
            part.clear()
            linked.clear()

    place, size = 0, len(page)
    while place < size:
        match = _TOKEN.search(page, place)
        if match is None:
            add(page[place:])
            break
        add(page[place : match.start()])
        place = match.end()
        if match[2] is None:
            continue
        name = match[2].lower()
        if match[1]:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    if name in _BLOCKS or stack[depth][1] != (depth > 0 and stack[depth - 1][1]):
                        end()
                    chrome, inside, box, within = close(depth)
                    break
                if stack[depth][0] in _ARTICLE | _CHROME and name not in _ARTICLE | _CHROME | {"body", "html"}:
                    break  # a stray end tag doesn't close what stands around the section
            else:
                if name in _BLOCKS:
                    end()
            continue
        attributes = match[3] or ""
        if name in _RAW:
            if not attributes.endswith("/"):
                closing = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, place)
                if closing is None and name == "head":
                    continue
                place = closing.end() if closing else size
                part.append(" ")
            continue
        if name == "br":
            part.append(" ")
            continue
        if name in _BLOCKS:
            end()
            if name in _CLOSES_P:
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth][0] == "p":
                        chrome, inside, box, within = close(depth)
                        break
                    if stack[depth][0] in _BLOCKS:
                        break
        if name in _VOID or attributes.endswith("/") and name not in _BLOCKS:
            continue
        now = chrome or _is_chrome(name, attributes)
        if now != chrome:
            end()
        chrome = now
        if name in _ARTICLE and not inside:
            inside = articles = articles + 1
        if name in _BOXES and not chrome:
            around.append(box)
            opened.append(len(texts))
            closed.append(size_)
            box = len(opened) - 1
        within = "heading" if name in _HEADINGS else "link" if name == "a" and not within else within
        stack.append((name, chrome, inside, box, within))
    end()

    def goes_on(before: int, after: int, b: int) -> bool:
        if not all(opened[b] <= i < closed[b] for i in (before, after)):
            return False
        own = [box_of[before], box_of[after]]
        # a box of one block is a paragraph of the box around it
        outer = [around[o] if closed[o] - opened[o] == 1 else o for o in own]
        return b in own or b != 0 and outer == [b, b]

    passed, last = [False] * len(texts), -1
    for i, f in enumerate(furniture):
        if not f:
            if 0 <= last < i - 1 and all(goes_on(last, i, b) for b in set(box_of[last + 1 : i])):
                passed[last + 1 : i] = [True] * (i - 1 - last)
            last = i
    return texts, weights, furniture, article, passed, bare


def main_text(page: str, *, window: int = 3, threshold: int = 80) -> str:
    """The text between surge and dive points, blocks in page order, joined by two line feeds.

    Blocks outside of article and main elements weigh nothing where one of these holds the main surge: at least as much
    text as any run outside that reaches the threshold. Furniture within an article, or around which one text goes on,
    leaves no line. A short line in no element for text weighs nothing if furniture alone stands beside it. The
    threshold falls to the largest window sum where no window reaches it, so that a short text is found too.
    """
    texts, weights, furniture, article, passed, bare = lines_of(page)
    for i in range(len(texts)):
        around = [j for j in (i - 1, i + 1) if 0 <= j < len(texts)]
        if bare[i] and len(texts[i]) < threshold and around and all(furniture[j] and not passed[j] for j in around):
            weights[i] = 0
    lines = [*zip(texts, weights, furniture, article, passed, strict=True)]
    held: dict[int, int] = {}
    for text, _, f, a, _ in lines:
        if a and not f:
            held[a] = held.get(a, 0) + len(text)
    others = [(None if a else "" if f else text, w) for text, w, f, a, p in lines if not p]
    outside = max((sum(map(len, run)) for run in _runs(others, window, threshold)), default=0) if held else 0
    rows: list[tuple[str | None, int]] = []
    if held and max(held.values()) >= outside:
        rows = [(text if a and not f else None, len(text)) for text, _, f, a, _ in lines if not (a and f)]
    else:
        last = 0
        for text, w, f, a, p in lines:
            if a != last:
                rows.append((None, 0))  # an article begins or ends
                last = a
            if not (p or a and f):
                rows.append(("" if f else text, w))
    return "\n\n".join(text for run in _runs(rows, window, threshold, fall=True) for text in run)


def _runs(rows: list[tuple[str | None, int]], window: int, threshold: int, *, fall: bool = False) -> list[list[str]]:
    """The texts of each run of rows (text, weight) that reaches the threshold, or the largest sum if none does.

    A row of furniture is an empty line, one without text a gap as long as the window."""
    weights: list[int] = []
    kept: list[str | None] = []
    for text, weight in rows:
        weights += [0] * window if text is None else [weight if text else 0]
        kept += [None] * window if text is None else [text]
    if not any(weights):
        # nothing but links: these are the text then
        return _runs([(text, len(text or "")) for text, _ in rows], window, threshold, fall=True) if fall and any(kept) else []
    sums = np.convolve(np.array([*weights, *[0] * window]), np.ones(window, int))[: len(weights)]
    least = min(threshold, int(sums.max())) if fall else threshold
    # from surge to dive: a run of sums above nothing, if one of them reaches the threshold, to its last line that weighs
    run = np.cumsum(sums == 0)
    reached = set(run[sums >= least].tolist())
    last = {r: i for i, (r, w) in enumerate(zip(run.tolist(), weights, strict=True)) if w}
    out: dict[int, list[str]] = {}
    for i, (text, r, total) in enumerate(zip(kept, run.tolist(), sums.tolist(), strict=True)):
        if text and total and r in reached and i <= last[r]:
            out.setdefault(r, []).append(text)
    return [*out.values()]


def extract(
    pages: DataFrame, *, key: str = "page_id", url: str = "url", page: str = "html", window: int = 3, threshold: int = 80
) -> DataFrame:
    """``key``, ``url`` and ``text`` of every row, from its whole page.

    A null or empty page, or one without text, gives ""; null urls stay null; repeated rows give a row each; an empty
    table gives no rows; no other column is read. Pages are taken one by one, so that memory is bounded by the longest.
    """
    frame = pages.select(key, url, page)
    kind = frame.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                found = [main_text(x.as_py() or "", window=window, threshold=threshold) for x in part.column(2)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(found, pa.string())], names=[key, url, "text"])

    return frame.mapInArrow(tidy(run), f"`{key}` {kind}, `{url}` string, text string")
