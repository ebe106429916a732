"""Main text of web pages by minimum-cut labelling.

Method. A page is read once, from tag to tag, into blocks of text with the elements around them. A linear classifier
turns a block's shape and surroundings into a score; a positive score is the cost of calling the block boilerplate, a
negative one that of calling it content. These are the capacities to the two terminals. Edges between neighbours in the
page, stronger between children of the same element, make it costly to part them. The minimum cut between the terminals
labels all blocks of a page together: few unsure blocks follow their surroundings. Flow is pushed from each deficit to
the nearest surplus; regions that no surplus reaches are closed, so long pages cost about their length.

Nothing is dropped or capped but what the labels say. Null or empty html gives an empty text. Rows with null ids or
urls, and repeated rows, give a row each. Broken markup is read as far as it goes: an unclosed tag at the end is markup.
"""

from __future__ import annotations

import html
import re
from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame

from daybook.llm.textvec import slices

# One step of reading: comment or declaration, element whose content is not text, tag, unfinished tag.
STEP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(script|style|template|noscript|svg|iframe|object|textarea|select|title)\b(?:[^\"'>]|\"[^\"]*\"|'[^']*')*(?:>.*?(?:</\1\s*>|\Z)|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S | re.I,
)
NAMES = re.compile(r"\b(?:class|id|role|hidden|style|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
BLOCK_ELEMENTS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol option p pre search section "
    "summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("br hr img input link meta area base col embed source track wbr".split())
CLOSED_BY_NEXT = {"p": BLOCK_ELEMENTS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
HOLDERS = frozenset("ul ol dl table article section main body div blockquote".split())
# What the classifier adds for elements around a block.
BESIDE = frozenset("nav footer aside form button menu dialog label option head fieldset".split())
WITHIN = frozenset("article main".split())
BAD_NAME = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|banner|breadcrumbs?|comments?|cookies?|consent|disqus|footer|header|masthead|menu|modal|nav|navbar|navigation"
    r"|newsletter|notice|popup|promo\w*|related|share|sharing|sidebar|social|sponsor\w*|subscribe|toolbar|widget|reply|replies|respond|hidden|complementary|search)(?:$|[\s_-])"
    r"|display\s*:\s*none|visibility\s*:\s*hidden",
    re.I,
)
GOOD_NAME = re.compile(r"(?:^|[\s_-])(?:article\w*|content|entry|main|post|story|text|body)(?:$|[\s_-])", re.I)
NEIGHBOURS, SIBLINGS = 0.5, 0.75


def _score(text: str, linked: int, around: tuple) -> float:
    """The classifier: what speaks for content minus what speaks against."""
    beside = within = bad = good = 0
    heading = header = False
    for tag, name in around:
        beside += tag in BESIDE
        if tag in WITHIN:
            within += 1
        header = header or (tag == "header" and not within)
        heading = heading or (len(tag) == 2 and tag[0] == "h" and tag[1].isdigit())
        if name:
            bad += bool(BAD_NAME.search(name))
            good += bool(GOOD_NAME.search(name))
    n = len(text)
    score = -0.5 + min(n, 400) / 200 + 0.5 * (text[-1] in ".!?:\"'”»…") + 0.75 * heading
    score += 3.0 * bool(within) + 1.5 * bool(good) - 6.0 * bool(beside) - 6.0 * bool(bad) - 4.0 * header
    return score - 4.0 * (linked / n if n else 0) * (2 if within == 0 else 0.5)


def blocks(page: str) -> list[tuple[str, int, tuple, int]]:
    """(text, characters in links, elements around with their names, number of the innermost element that holds others)."""
    out: list[tuple[str, int, tuple, int]] = []
    stack: list[tuple[str, str, int]] = []  # open block elements: tag, names, number
    pieces: list[str] = []
    links, linked, number, at = 0, 0, 0, 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                holder = next((k for tag, _, k in reversed(stack) if tag in HOLDERS), 0)
                out.append((text, min(linked, len(text)), tuple((t, n) for t, n, _ in stack), holder))
            pieces.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        text = html.unescape(text) if "&" in text else text
        pieces.append(text)
        if links:
            linked += len(text.strip())

    for m in STEP.finditer(page):
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        tag = m.group(3) or m.group(6)
        if tag is None:
            if m.group(1):
                pieces.append(" ")
            continue
        tag = tag.lower()
        closing = (m.group(2) if m.group(3) else m.group(5)) == "/"
        if tag == "a":
            links = 0 if closing else 1
        elif tag == "br":
            pieces.append(" ")
        elif tag in BLOCK_ELEMENTS:
            flush()
            links = 0
            if closing:
                k = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag), None)
                if k is not None:
                    del stack[k:]
            elif tag not in VOID:
                while stack and tag in CLOSED_BY_NEXT.get(stack[-1][0], ()):
                    stack.pop()
                attributes = m.group(4) if m.group(3) else m.group(7)
                names = ""
                if attributes and not attributes.isspace():
                    names = " ".join(next((g for g in x.groups() if g is not None), x.group(0)) for x in NAMES.finditer(attributes))
                number += 1
                stack.append((tag, names, number))
    if at < len(page):
        add(page[at:])
    flush()
    return out


def cut(scores: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes lie on the content side of a minimum cut; scores are terminal capacities by sign."""
    n = len(scores)
    left = list(scores)  # what a node still has over (positive) or still needs (negative)
    flow: list[dict[int, float]] = [{} for _ in range(n)]  # residual capacity from a node to another
    for i, j, w in edges:
        flow[i][j] = flow[i].get(j, 0.0) + w
        flow[j][i] = flow[j].get(i, 0.0) + w
    closed = [False] * n
    for t in range(n):
        while left[t] < -1e-12 and not closed[t]:
            toward, queue, found = {t: t}, deque([t]), -1
            while queue and found < 0:
                v = queue.popleft()
                for u in flow[v]:
                    if u not in toward and not closed[u] and flow[u][v] > 1e-12:
                        toward[u] = v
                        if left[u] > 1e-12:
                            found = u
                            break
                        queue.append(u)
            if found < 0:
                for u in toward:
                    closed[u] = True
                break
            push, u = min(left[found], -left[t]), found
            while u != t:
                push = min(push, flow[u][toward[u]])
                u = toward[u]
            left[found] -= push
            left[t] += push
            u = found
            while u != t:
                v = toward[u]
                flow[u][v] -= push
                flow[v][u] += push
                u = v
    return [not c for c in closed]


def main_text(page: str) -> str:
    found = blocks(page)
    scores = [_score(text, linked, around) for text, linked, around, _ in found]
    edges, last = [], {}
    for i, (_, _, _, holder) in enumerate(found):
        if i:
            edges.append((i - 1, i, NEIGHBOURS))
        if holder in last:
            edges.append((last[holder], i, SIBLINGS))
        last[holder] = i
    if any(s > 0 for s in scores):
        keep = cut(scores, edges)
        return "\n\n".join(text for (text, _, _, _), k in zip(found, keep) if k)
    return ""


def extracted(pages: DataFrame, page: str = "html") -> DataFrame:
    """``pages`` without ``page``, with ``text`` and ``n_chars``."""
    others = [f for f in pages.schema.fields if f.name != page and f.name not in ("text", "n_chars")]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in others] + ["text string, n_chars long"])

    def run(batches):
        for batch in batches:
            for part in slices(batch, page, 4 << 20):
                texts = [main_text(p) if p else "" for p in part.column(page).to_pylist()]
                columns = [part.column(f.name) for f in others] + [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in others] + ["text", "n_chars"])

    return pages.select(*[f"`{f.name}`" for f in others], page).mapInArrow(run, schema)
