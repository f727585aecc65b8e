"""Main text of web pages by minimum-cut labelling of their blocks.

1. A page is read into text blocks: runs of text between block-level tags, each
   with the elements it stands in.  Scripts, styles, forms and the like hold no
   text.
2. A logistic classifier over block statistics (length, link share, sentence
   marks, kind of element, place on the page) gives each block the log odds of
   being content.  It is trained here, by Spark, on the blocks of about
   SAMPLE_PAGES pages, chosen by a hash, whose markup says what they are: inside
   an article or main element, or inside navigation, footers, adverts, comments.
3. The log odds become terminal capacities.  Blocks in elements that are never
   article text are tied to the boilerplate side; blocks in an article element
   lean to the content side.  Adjacent blocks, and blocks that follow each other
   under one parent element, are joined by edges that are stronger the more of
   their ancestors they share.
4. The minimum cut, by maximum flow, labels the blocks; a lone doubtful block
   follows its neighbours.

Pages are independent, so this is one pass without a shuffle; a page's work is
near linear in its blocks.  White space inside a block becomes one space; blocks
are joined by an empty line.  A line break inside a block is white space.

Cases: null html is empty and gives empty text; a page without tags is one
block, and its text is kept; a tag cut off at the end of a page is no text;
repeated rows each give a row; extra columns are ignored.
"""

from __future__ import annotations

import html as markup
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

from lexmill.llm.shared import materialize

SAMPLE_PAGES = 2_000
ARTICLE_LEAN = 4.0          # added log odds inside an article element
TIE = 1e6                   # capacity that no cut crosses
PATH = 256                  # outermost and innermost ancestors kept of a block, for edge weights only
NEXT = 0.5                  # edge between adjacent blocks, times the share of ancestors
SIBLING = 0.5               # edge between blocks that follow each other under one parent
# Log odds of the statistics where no page of the sample tells its parts apart:
# intercept, then the order of `_statistics`.
PLAIN_WEIGHTS = (-2.0, 0.9, -4.0, 1.0, 0.5, -0.5, 0.0)

# Element names of the HTML standard and usual names of page parts.
BLOCK_TAGS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt
fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p
pre section summary table tbody td tfoot th thead tr ul""".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
MUTE_TAGS = frozenset("head template svg math object canvas audio video select button form option datalist".split())
BOILERPLATE_TAGS = frozenset("nav footer aside menu dialog".split())
ARTICLE_TAGS = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PART_NAMES = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored promo banner sidebar
menu nav navbar navigation breadcrumb breadcrumbs footer masthead comment comments disqus cookie cookies
consent notice popup modal overlay share sharing social related newsletter subscribe signup login widget
toolbar pagination pager legal disclaimer copyright""".split())
PART_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert".split())

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>"""
                  r"""|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>|<(?:[a-zA-Z/!?][^>]*)?\Z""", re.S)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$|/)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_WORDS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Block:
    __slots__ = ("text", "linked", "tag", "path", "banned", "article")

    def __init__(self, text, linked, tag, path, banned, article):
        self.text, self.linked, self.tag = text, linked, tag
        self.path, self.banned, self.article = path, banned, article


def _is_part(tag: str, attributes: str, in_article: bool) -> bool:
    """Whether an element holds a part of the page that is never article text."""
    if tag in BOILERPLATE_TAGS or tag == "header" and not in_article:
        return True
    if not attributes or tag in ("html", "body") or tag in ARTICLE_TAGS:
        return False
    if _HIDDEN.search(attributes):
        return True
    for kind, *values in _NAMES.findall(attributes):
        names = _WORDS.findall(_CAMEL.sub(" ", "".join(values)).lower())
        if PART_NAMES.intersection(names) or kind.lower() == "role" and PART_ROLES.intersection(names):
            return True
    return False


def blocks(page: str) -> list[Block]:
    """The text blocks of a page, in order."""
    found: list[Block] = []
    # open elements: (tag, number, banned, muted, article, link, nearest block tag)
    stack: list[tuple] = [("", 0, False, False, False, False, "")]
    opened: Counter = Counter()
    pieces: list[str] = []
    linked = number = at = 0
    here = None

    def flush():
        nonlocal linked, here
        if pieces:
            text = " ".join(markup.unescape("".join(pieces)).split())
            if text:
                found.append(Block(text, linked, *here))
            pieces.clear()
        linked, here = 0, None

    def say(text):
        nonlocal linked, here
        top = stack[-1]
        if not text or top[3]:
            return
        pieces.append(text)
        if here is None and not text.isspace():
            kept = stack if len(stack) <= 2 * PATH else stack[:PATH] + stack[-PATH:]
            here = top[6], [e[1] for e in kept], top[2], top[4]
        if top[5]:
            linked += len(text)

    size = len(page)
    while at < size:
        m = _TAG.search(page, at)
        if m is None:
            say(page[at:])
            break
        if m.start() > at:
            say(page[at:m.start()])
        at = m.end()
        name = m.group(2) or m.group(5)
        if not name:
            continue
        tag, closing = name.lower(), m.group(1) or m.group(4)
        if tag == "br":
            if pieces:
                pieces.append(" ")
            continue
        if closing:
            depth = len(stack) - 1 if opened[tag] else 0
            while depth and stack[depth][0] != tag:
                depth -= 1
            if tag in BLOCK_TAGS:
                flush()
            elif any(e[0] in BLOCK_TAGS for e in stack[depth + 1:]):
                depth = 0               # an inline end tag closes no block
            if depth:
                opened.subtract(e[0] for e in stack[depth:])
                del stack[depth:]
            continue
        if tag in BLOCK_TAGS:
            flush()
            closes = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
                      "td": ("td", "th"), "th": ("td", "th")}.get(tag, ()) + ("p",)
            depth = len(stack) - 1
            while depth and (stack[depth][0] not in BLOCK_TAGS or stack[depth][0] in closes):
                if stack[depth][0] in closes:
                    opened.subtract(e[0] for e in stack[depth:])
                    del stack[depth:]
                depth -= 1
        if tag in VOID_TAGS:
            continue
        attributes = m.group(3) or m.group(6) or ""
        if attributes.endswith("/") and tag in ("svg", "iframe", "script"):
            continue
        if tag in RAW_TAGS:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else size
            continue
        number += 1
        top = stack[-1]
        article = top[4] or tag in ARTICLE_TAGS
        stack.append((tag, number, top[2] or _is_part(tag, attributes, top[4]), top[3] or tag in MUTE_TAGS,
                      article, top[5] or tag == "a", tag if tag in BLOCK_TAGS else top[6]))
        opened[tag] += 1
    flush()
    return found


def _statistics(block: Block, place: float) -> list[float]:
    words = len(block.text.split())
    marks = sum(map(block.text.count, ".!?;:,"))
    return [math.log1p(words), min(1.0, block.linked / len(block.text)), min(1.0, 5.0 * marks / words),
            float(block.tag in HEADINGS), float(block.tag in ("li", "td", "th")), place]


def minimum_cut(odds: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stand on the source side of a minimum cut.

    `odds[i]` > 0 is the capacity from the source, < 0 that to the sink; edges
    have one capacity in both directions.  Shortest augmenting paths in phases;
    the source side is what the last search reaches.
    """
    n = len(odds)
    source, sink = n, n + 1
    to, room, out = [], [], [[] for _ in range(n + 2)]

    def join(a, b, forward, backward):
        out[a].append(len(to)); to.append(b); room.append(forward)      # noqa: E702
        out[b].append(len(to)); to.append(a); room.append(backward)     # noqa: E702

    for i, v in enumerate(odds):
        if v > 0:
            join(source, i, v, 0.0)
        elif v < 0:
            join(i, sink, -v, 0.0)
    for a, b, v in edges:
        join(a, b, v, v)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = [source]
        for u in queue:
            for e in out[u]:
                if room[e] > 1e-9 and level[to[e]] < 0:
                    level[to[e]] = level[u] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        at = [0] * (n + 2)
        path: list[int] = []
        u = source
        while True:
            if u == sink:
                flow = min(room[e] for e in path)
                cut = next(k for k, e in enumerate(path) if room[e] == flow)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                u = to[path[cut] ^ 1]
                del path[cut:]
                continue
            while at[u] < len(out[u]):
                e = out[u][at[u]]
                if room[e] > 1e-9 and level[to[e]] == level[u] + 1:
                    break
                at[u] += 1
            else:
                if u == source:
                    break
                u = to[path.pop() ^ 1]
                at[u] += 1
                continue
            path.append(e)
            u = to[e]


def _edges(found: list[Block]) -> list[tuple[int, int, float]]:
    edges, last = [], {}
    for i, b in enumerate(found):
        if i:
            before = found[i - 1].path
            shared = 0
            for p, q in zip(before, b.path):
                if p != q:
                    break
                shared += 1
            edges.append((i - 1, i, NEXT * shared / max(len(before), len(b.path))))
        parent = b.path[-2] if len(b.path) > 1 else b.path[-1]
        if parent in last and last[parent] < i - 1:
            edges.append((last[parent], i, SIBLING))
        last[parent] = i
    return edges


def main_text(page: str | None, weights: tuple[float, ...] = PLAIN_WEIGHTS) -> str:
    """The main text of one page."""
    found = blocks(page or "")
    if not found:
        return ""
    if len(found) == 1 and found[0].tag == "" and len(found[0].path) == 1:
        return found[0].text            # no markup: the text itself
    has_article = any(b.article and not b.banned for b in found)
    odds = []
    for i, b in enumerate(found):
        if b.banned:
            odds.append(-TIE)
            continue
        s = _statistics(b, i / len(found))
        value = weights[0] + sum(w * x for w, x in zip(weights[1:], s))
        if has_article and b.article:
            low = -8.0 if s[1] > 0.5 else 0.5 - ARTICLE_LEAN    # only link lists can fall out
            value = max(low, min(8.0, value)) + ARTICLE_LEAN
        elif has_article:
            value -= ARTICLE_LEAN
        odds.append(value)
    keep = minimum_cut(odds, _edges(found))
    return "\n\n".join(b.text for b, k in zip(found, keep) if k)


def _label_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, labels = [], []
        for value in batch.column(0):
            found = blocks(value.as_py() or "")
            for i, b in enumerate(found):
                if b.banned or b.article:
                    rows.append(_statistics(b, i / len(found)))
                    labels.append(0.0 if b.banned else 1.0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.list_(pa.float64())), pa.array(labels, pa.float64())], names=["x", "label"])


def fit(pages: DataFrame, sample: int = SAMPLE_PAGES) -> tuple[float, ...]:
    """Intercept and weights of the block classifier, from about `sample` pages."""
    total = pages.count()
    share = int((1 << 30) * min(1.0, sample / max(1, total)))
    chosen = pages.filter(F.pmod(F.xxhash64("page_id", "url"), F.lit(1 << 30)) < share).select("html")
    rows = materialize(chosen.mapInArrow(_label_rows, "x array<double>, label double"), "blocks")
    if rows.select("label").distinct().count() < 2:
        return PLAIN_WEIGHTS
    model = LogisticRegression(regParam=0.01, maxIter=25).fit(
        rows.select(array_to_vector("x").alias("features"), "label"))
    return (float(model.intercept), *map(float, model.coefficients))


def extract(pages: DataFrame, weights: tuple[float, ...] | None = None) -> DataFrame:
    """(page_id, url, text, n_chars): the main text of every page."""
    weights = fit(pages) if weights is None else weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(v.as_py(), weights) for v in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array(list(map(len, texts)), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(
        run, f"page_id {kind}, url string, text string, n_chars long")
