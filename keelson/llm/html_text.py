"""Main text of web pages by line-block distribution.

Markup is stripped into lines: a block element or a line break begins a new
line, character references are decoded, white space is collapsed. A line counts
the length of its text, link text outside headings not included, times a weight:
``ARTICLE_WEIGHT`` inside an article or main element, ``NAMED_WEIGHT`` inside an
element whose class, id or role is a name of page furniture (as a whole; outside an
article also as a part between hyphens or underscores), nothing
inside a furniture element (see the fixed lists below; a form counts as one unless it
holds most of the page's text). On a page without article, a single long line behind
the container that holds ``MOST`` of the long lines' text, in another one, counts nothing. The counts of ``WINDOW``
successive lines are summed over sliding windows. On every page, inside an article
too, the text surges where the windows rise above next to nothing and dives where
they fall back to it. Between a surge and its dive lies a stretch; those with a
window of ``SHARE`` of the highest are main text. At both ends of a stretch go
lines that are too short to reach that by themselves and lie in another container
than those that do (headings before the text stay); anywhere in it go lines that
count less than half of what their length would at the weight of its text, unless
they are single link lines between two of text.

Defined results: a null page is empty; a page without text gives an empty
text; unclosed, crossed and truncated tags end at the next tag that closes
them, or with the page. Nothing is cut off by length.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm import textbytes as tb

WINDOW = 3
SHARE = 0.15
NOTHING = 20.0  # a window below this is a dive
ARTICLE_WEIGHT = 16.0
NAMED_WEIGHT = 0.1
MOST = 0.8

# Fixed lists. Elements whose text is not text; elements and names of page furniture;
# elements without content; elements that do not begin a line.
RAW = ("script", "style", "title", "textarea", "noscript", "template", "iframe", "svg", "math", "object")
FURNITURE = {"nav", "footer", "aside", "button", "select", "menu", "dialog", "head", "header"}
FURNITURE_NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment",
    "comments", "consent", "cookie", "cookies", "disqus", "footer", "header", "masthead", "menu", "modal", "nav", "navbar",
    "navigation", "newsletter", "notice", "popup", "promo", "promotion", "related", "replies", "share", "sharing", "sidebar",
    "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget",
}
# Beside these, header as a part of a name is a text's own header.
TEXT_NAMES = {"article", "body", "content", "entry", "main", "post", "story", "text"}
FURNITURE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "menu"}
VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr",
}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins",
    "kbd", "label", "mark", "q", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u",
    "var", "wbr",
}

# Elements that hold one line of text; the others are containers.
LINE = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "pre", "blockquote", "dt", "dd", "figcaption", "caption"}
HEADING = {"h1", "h2", "h3", "h4", "h5", "h6"}

_TOKEN = re.compile(
    r"<!--(?s:.*?)(?:-->|\Z)"
    rf"|<(?P<raw>{'|'.join(RAW)})\b[^>]*+(?:/>|>(?s:.*?)(?:</(?P=raw)\s*>|\Z)|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][\w:-]*+)(?P<rest>(?:\"[^\"]*+\"|'[^']*+'|[^\"'>])*+)>"
    r"|<[!?][^>]*+(?:>|\Z)"
    r"|</?[a-zA-Z][^<>]*+(?:>|\Z)",
    re.IGNORECASE,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)

_PART = re.compile("[-_]+")


@dataclass(frozen=True)
class State:
    """What holds for the text inside an open element; containers are numbered, 0 is the page's own."""

    furniture: float = 1.0
    article: bool = False
    heading: bool = False
    container: int = 0
    form: int = 0  # the outermost open form, 0 if none


@dataclass(frozen=True)
class Line:
    text: str
    linked: int  # characters of link text
    state: State

    @property
    def weight(self) -> float:
        return self.state.furniture * (ARTICLE_WEIGHT if self.state.article else 1.0)

    @property
    def length(self) -> float:
        return self.weight * (len(self.text) - (0 if self.state.heading else self.linked))


def _furniture(name: str, rest: str, in_article: bool) -> float:
    """The weight of an element by its name and by its class, id and role."""
    if name in FURNITURE and not (name == "header" and in_article):
        return 0.0
    for kind, *values in _ATTRIBUTE.findall(rest) if "=" in rest else ():
        names = "".join(values).lower().split()
        if kind.lower() != "role" and not in_article:
            parts = {part for n in names for part in _PART.split(n)}
            names += parts - {"header"} if parts & TEXT_NAMES else parts
        if FURNITURE_ROLES.intersection(names) if kind.lower() == "role" else FURNITURE_NAMES.intersection(names):
            # The page itself may be styled for a sidebar or a banner.
            return 1.0 if name in ("html", "body", "article", "main") else NAMED_WEIGHT
    return 1.0


def page_lines(page: str) -> tuple[list[Line], list[int]]:
    """The lines of a page, and for each container the one it lies in."""
    lines: list[Line] = []
    parts: list[tuple[str, bool]] = []  # text, whether it is link text
    stack: list[tuple[str, State]] = []
    state, links, parents, forms = State(), 0, [0], 0

    def end_line() -> None:
        if parts:
            text = " ".join(html.unescape("".join(t for t, _ in parts)).split())
            if text:
                link = " ".join(html.unescape(" ".join(t for t, linked in parts if linked)).split())
                lines.append(Line(text, min(len(link), len(text)), state))
            parts.clear()

    def cut(i: int) -> None:
        """Close the open elements from ``i`` on."""
        nonlocal state, links
        links -= sum(n == "a" for n, _ in stack[i:])
        del stack[i:]
        state = stack[-1][1] if stack else State()

    at = 0
    for token in _TOKEN.finditer(page):
        if token.start() > at:
            parts.append((page[at : token.start()], links > 0))
        at = token.end()
        name = token["name"]
        if name is None:
            continue
        name = name.lower()
        if name not in INLINE:
            end_line()
        if token["close"]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    if stack[i][1] != (stack[i - 1][1] if i else State()):
                        end_line()
                    cut(i)
                    break
        elif name not in VOID and not token["rest"].endswith("/"):
            if name == "p" or name in HEADING:  # a paragraph ends the one before
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == "p":
                        cut(i)
                        break
                    if stack[i][0] not in INLINE:
                        break
            elif name == "a" and links:  # links do not nest
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == "a":
                        links -= 1
                        del stack[i]
                        break
                    if stack[i][0] not in INLINE:
                        break
            container = state.container
            if name not in INLINE and name not in LINE and name not in ("html", "body"):
                parents.append(container)
                container = len(parents) - 1
            forms += name == "form"
            new = State(
                min(state.furniture, _furniture(name, token["rest"], state.article)),
                state.article or name in ("article", "main"),
                state.heading or name in HEADING,
                container,
                state.form or (forms if name == "form" else 0),
            )
            if new != state:
                end_line()
            stack.append((name, new))
            links += name == "a"
            state = new
    if at < len(page):
        parts.append((page[at:], links > 0))
    end_line()
    return _without_forms(lines) if forms else lines, parents


def _without_forms(lines: list[Line]) -> list[Line]:
    """The lines of forms count nothing, but for a form that holds most of the page's text."""
    held: dict[int, int] = {}
    for line in lines:
        if line.state.furniture:
            held[line.state.form] = held.get(line.state.form, 0) + len(line.text) - line.linked
    whole = {f for f, n in held.items() if 2 * n > sum(held.values())} | {0}
    return [line if line.state.form in whole else replace(line, state=replace(line.state, furniture=0.0)) for line in lines]


def _behind(lines: list[Line], parents: list[int], length: np.ndarray, least: float) -> list[int]:
    """Single long lines that follow the container of nearly all long lines in another one; none beside an article."""
    long = [i for i in range(len(lines)) if length[i] >= least]
    if any(line.state.article for line in lines):
        return []
    held: dict[int, float] = {}
    around: dict[int, list[int]] = {}
    for i in long:
        c = lines[i].state.container
        around[i] = [c]
        while c:
            c = parents[c]
            around[i].append(c)
        for c in around[i]:
            held[c] = held.get(c, 0.0) + length[i]
    total = sum(length[i] for i in long)
    home = max((c for c, n in held.items() if n >= MOST * total), default=0)  # numbered from the outside in
    inside = [i for i in long if home in around[i]]
    if not home or len(inside) < 2:
        return []
    out = [i for i in long if i > inside[-1]]
    # Alone: no other long line outside the home lies in its own container.
    alone = {i for i in out if sum(lines[i].state.container in around[j] for j in long) == 1}
    return [i for i in out if i in alone and length[i] < 0.5 * held[home]]


def main_text(page: str) -> str:
    """The text between the surges and dives of a page's line blocks."""
    lines, parents = page_lines(page)
    length = np.array([line.length for line in lines])
    if not length.any():
        return ""
    sums = np.convolve(length, np.ones(WINDOW))  # of the lines i - WINDOW + 1 to i
    least = SHARE * sums.max()
    length[_behind(lines, parents, length, least)] = 0
    sums = np.convolve(length, np.ones(WINDOW))
    # A line is live if a window that holds it is not next to nothing.
    live = np.flatnonzero([sums[i : i + WINDOW].max() >= min(NOTHING, least) for i in range(len(lines))])
    out = []
    for stretch in np.split(live, np.flatnonzero(np.diff(live) > 1) + 1):
        if sums[stretch[0] : stretch[-1] + WINDOW].max() >= least:
            out += [lines[i].text for i in _kept(lines, parents, length, [int(i) for i in stretch], least)]
    return " ".join(out)


def _kept(lines: list[Line], parents: list[int], length: np.ndarray, stretch: list[int], least: float) -> list[int]:
    """The lines of a stretch that are its text."""
    long = [i for i in stretch if length[i] >= least] or stretch  # a window of short lines: all count
    weight = max(lines[i].weight for i in long)
    dense = {i: length[i] >= 0.5 * weight * len(lines[i].text) for i in stretch}
    long = [i for i in long if dense[i]]
    if not long:
        return []
    homes = {lines[i].state.container for i in long}
    # Containers inside one of the long lines', or around it; the page's own only if it holds a long line itself.
    near = set(homes)
    for c in range(1, len(parents)):
        if parents[c] and parents[c] in near:
            near.add(c)
    for c in homes:
        while (c := parents[c]) and c not in near:
            near.add(c)
    first, last = long[0], long[-1]

    def at_home(i: int) -> bool:
        return lines[i].state.container in near

    for i in range(first - 1, stretch[0] - 1, -1):  # headings and short lines before the first long one
        if dense[i] and (at_home(i) or (lines[i].state.heading and first - i < WINDOW)):
            first = i
    last = max([last, *(i for i in stretch if i > last and dense[i] and at_home(i))])
    return [
        i
        for i in stretch
        if first <= i <= last
        and (dense[i] or (lines[i].weight >= 0.5 * weight and dense[i - 1] and dense[i + 1]))
        and (long[0] <= i <= long[-1] or at_home(i) or lines[i].state.heading)
    ]


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row: ``page_id, url, text, n_chars``."""
    rows = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, _, _ in tb.chunks(batch.column(2)):
                part = batch.slice(lo, hi - lo)
                texts = [main_text(h or "") for h in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )

    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(tb.task(run), f"page_id {types['page_id']}, url {types['url']}, text string, n_chars bigint")
