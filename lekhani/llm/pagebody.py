"""The main body of web pages by two-pass block rules.

A page is read once into blocks: visible text not interrupted by a tag other
than inline ones. Pass one decides blocks on their own by length, link density
and stop-word density; only announced advertisements and lone dates have rules
of their own. Blocks that are too short to tell stay open.
Pass two hands them the label of the nearest decided neighbours, weighing
first the ones in the same container. Kept are the blocks decided good inside
the smallest container that holds the page's heading and running text.
"""

from __future__ import annotations

import hashlib
import html as htmllib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lekhani.llm.repetition import STOP_WORDS

INLINE = frozenset("a b i em strong span".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("script style noscript template title head svg iframe object select textarea".split())
RAW = frozenset("script style textarea title".split())
#: Containers that never hold the article itself.
ASIDE = frozenset("nav aside footer form button".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: An open tag closes an open one of these before it opens.
CLOSES = {"p": {"p"}, "li": {"li", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "tr": {"tr", "td", "th", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "option": {"option"}}
#: ... but not across these.
SCOPES = {"li": {"ul", "ol"}, "td": {"table"}, "th": {"table"}, "tr": {"table"}, "dt": {"dl"}, "dd": {"dl"}}

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][A-Za-z0-9:\-]*)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.S)
_SPACE = re.compile(r"\s+")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_DATE = re.compile(r"\b\d{1,4}[/.\-]\d{1,2}[/.\-]\d{1,4}\b|\b\d{1,2}(?:st|nd|rd|th)? [A-Z][a-z]+,? \d{4}\b|\b[A-Z][a-z]+ \d{1,2}, \d{4}\b|\b\d{1,2}:\d{2}\b")
# Words that announce an advertisement.
_AD = re.compile(r"^(?:advertisement|advert|sponsored|promoted|paid(?: content)?|partner content|ad)\s*[:\-–—|]", re.I)
_STOPS = frozenset(STOP_WORDS)


@dataclass
class Block:
    text: str
    linked: int
    tag: str
    node: int
    label: str = "open"


@dataclass
class Page:
    title: str = ""
    blocks: list[Block] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    tags: list[str] = field(default_factory=list)
    first: list[int] = field(default_factory=list)
    end: list[int] = field(default_factory=list)
    any_tag: bool = False


def read_page(source: str) -> Page:
    """Blocks and containers of a page; tolerates unclosed and stray tags."""
    page = Page()
    page.parent.append(-1), page.tags.append(""), page.first.append(0), page.end.append(-1)
    stack = [0]
    parts: list[str] = []
    linked: list[str] = []
    unseen = links = 0
    title: list[str] = []
    in_title = False

    def flush() -> None:
        if parts:
            text = _SPACE.sub(" ", htmllib.unescape("".join(parts))).strip()
            if text:
                own = len(_SPACE.sub(" ", htmllib.unescape("".join(linked))).strip()) if linked else 0
                page.blocks.append(Block(text, own, page.tags[stack[-1]], stack[-1]))
            parts.clear()
            linked.clear()

    def close(k: int) -> None:
        nonlocal unseen
        while len(stack) > k:
            n = stack.pop()
            page.end[n] = len(page.blocks)
            unseen -= hidden.pop(n, 0)

    hidden: dict[int, int] = {}
    at, size = 0, len(source)
    while at < size:
        m = _TAG.search(source, at)
        run = source[at : m.start()] if m else source[at:]
        if run:
            if in_title:
                title.append(run)
            elif not unseen:
                if links:
                    linked.append(run)
                parts.append(run)
        if not m:
            break
        at = m.end()
        if not m.group(2):
            continue
        page.any_tag = True
        shut, tag, attrs = m.group(1), m.group(2).lower(), m.group(3)
        if tag in INLINE:
            if tag == "a":
                links = 0 if shut else 1
            continue
        flush()
        if tag in VOID:
            continue
        if shut:
            for k in range(len(stack) - 1, 0, -1):
                if page.tags[stack[k]] == tag:
                    close(k)
                    break
            in_title = in_title and tag != "title"
            continue
        if tag in RAW:  # no markup inside
            e = re.compile(rf"</{tag}\s*>", re.I).search(source, at)
            if tag == "title" and not page.title:
                page.title = _SPACE.sub(" ", htmllib.unescape(source[at : e.start() if e else size])).strip()
            at = e.end() if e else size
            continue
        closes = CLOSES.get(tag)
        if closes:
            scope = SCOPES.get(tag, ())
            for k in range(len(stack) - 1, 0, -1):
                t = page.tags[stack[k]]
                if t in scope or (tag == "p" and t != "p"):
                    break
                if t in closes:
                    close(k)
                    if tag != "tr":
                        break
        links = 0
        n = len(page.tags)
        page.parent.append(stack[-1]), page.tags.append(tag), page.first.append(len(page.blocks)), page.end.append(-1)
        stack.append(n)
        if tag in UNSEEN or (attrs and _HIDDEN.search(attrs)):
            unseen += 1
            hidden[n] = 1
        if attrs.endswith("/") and tag not in ("p", "div", "td", "li"):
            close(len(stack) - 1)
    flush()
    close(0)
    return page


def first_pass(page: Page) -> None:
    """good, near, bad or open for every block on its own."""
    for b in page.blocks:
        words = b.text.lower().split()
        n = len(words)
        density = b.linked / len(b.text)
        stops = sum(w in _STOPS for w in words) / n
        if density > 0.5:
            b.label = "bad"
        elif _AD.match(b.text) or n <= 4 and _DATE.search(b.text):
            b.label = "bad"
        elif b.tag in HEADINGS or n < 5:
            b.label = "open"
        elif stops >= 0.15 or (n >= 8 and b.text[-1] in ".!?।۔؟”\""):
            b.label = "good" if n >= 12 else "near"
        else:
            b.label = "open"


def _aside(page: Page, node: int) -> bool:
    while node > 0:
        if page.tags[node] in ASIDE:
            return True
        node = page.parent[node]
    return False


def _same_title(heading: str, title: str) -> bool:
    h, t = heading.casefold(), title.casefold()
    return len(h) >= 3 and (t == h or (t.startswith(h) and not t[len(h)].isalnum()) or (len(h) >= 20 and h in t))


def article_root(page: Page) -> tuple[int, int, int] | None:
    """(container, index of heading, end) of the article: the smallest container
    with the heading that repeats the page's title and with running text after it."""
    headed = [k for k, b in enumerate(page.blocks) if b.tag in HEADINGS and b.label != "bad" and not _aside(page, b.node)]
    named = [k for k in headed if page.title and _same_title(page.blocks[k].text, page.title)]
    for k in named or [k for k in headed if page.blocks[k].tag == "h1"]:
        node = page.parent[page.blocks[k].node]
        while node >= 0 and page.tags[node] not in ("body", "html"):
            end = page.end[node]
            if any(b.label in ("good", "near") and b.tag not in HEADINGS for b in page.blocks[k + 1 : end]):
                return node, k, end
            node = page.parent[node]
    return None


def second_pass(page: Page, begin: int, end: int, root: int) -> None:
    """Open blocks take the label of their nearest decided neighbours."""
    decided = [k for k in range(begin, end) if page.blocks[k].label in ("good", "near", "bad")]
    # a list or table of links is bad as a whole; one with plain entries is text, and its entries that are links belong to it
    plain: dict[int, bool] = {}
    for b in page.blocks[begin:end]:
        if b.tag in ("li", "td", "th"):
            around = page.parent[b.node]
            plain[around] = plain.get(around, False) or (b.linked <= len(b.text) / 2 and b.label != "bad")
    for b in page.blocks[begin:end]:
        if b.tag in ("li", "td", "th") and b.label == "bad" and b.linked > len(b.text) / 2 and plain[page.parent[b.node]]:
            b.label = "open"
    decided = [k for k in decided if page.blocks[k].label != "open"]
    # decided blocks by container, and the nearest decided ones on either side, each found in one pass
    groups: dict[int, set[bool]] = {}
    for j in decided:
        groups.setdefault(page.parent[page.blocks[j].node], set()).add(page.blocks[j].label == "bad")
    near, last = {}, None
    for k in range(begin, end):
        if page.blocks[k].label == "open":
            near[k] = [last, None]
        else:
            last = k
    last = None
    for k in range(end - 1, begin - 1, -1):
        if k in near:
            near[k][1] = last
        else:
            last = k
    for k, (left, right) in near.items():
        b = page.blocks[k]
        around = page.parent[b.node]
        group = groups.get(around) if b.tag not in HEADINGS and around != root else None
        if group:
            b.label = "good" if False in group else "bad"
        elif b.tag in HEADINGS or b.tag in ("p", "li", "td", "th", "blockquote", "dd", "dt", "figcaption", "pre"):
            sides = [page.blocks[j].label for j in (left, right) if j is not None]
            # the item of a list or table stays with the text around it; a bad neighbour decides only alone
            b.label = "good" if any(x != "bad" for x in sides) else "bad"
        else:
            b.label = "good" if left is not None and right is not None and page.blocks[left].label != "bad" and page.blocks[right].label != "bad" and page.parent[b.node] == root else "bad"


def article_blocks(source: str | None) -> list[str]:
    """Texts of the article's blocks in order; [] without tags or article."""
    if not source or "<" not in source:
        return []
    page = read_page(source)
    if not page.any_tag:
        return []
    first_pass(page)
    found = article_root(page)
    if found is None:
        return []
    root, head, end = found
    page.blocks[head].label = "good"
    second_pass(page, head + 1, end, root)
    return [b.text for b in page.blocks[head:end] if b.label in ("good", "near") and not _aside(page, b.node)]


def main_content(df: DataFrame, id_col: str = "doc_id", html_col: str = "html") -> DataFrame:
    """(id, block_no, text, block_md5) per article block of every row.

    Null, empty, tag-less html and pages without an article give no row; each
    row is read for itself, repeated rows repeat. Row-local, no shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 500):  # bounded output batches
                part = batch.slice(a, 500)
                row, no, text = [], [], []
                for k, source in enumerate(part.column(1).to_pylist()):
                    found = article_blocks(source)
                    row += [k] * len(found)
                    no += range(len(found))
                    text += found
                md5 = [hashlib.md5(t.encode("utf-8", "surrogatepass"), usedforsecurity=False).hexdigest() for t in text]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row, pa.int64())), pa.array(no, pa.int32()), pa.array(text, pa.string()), pa.array(md5, pa.string())], names=["_id", "block_no", "text", "block_md5"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("_id"), F.col(html_col).alias("_html")).where("_html is not null").mapInArrow(run, f"_id {kind}, block_no int, text string, block_md5 string").withColumnRenamed("_id", id_col)
