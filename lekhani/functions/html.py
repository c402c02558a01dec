"""HTML detection and main-text extraction with the standard parser."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TAG = r"<[A-Za-z!/][^>]*>"
# Result columns of extraction after the key columns.
FIELDS = ["title", "description", "text", "comments", "author", "hostname", "sitename", "date", "categories", "tags", "fingerprint", "id", "license", "body", "commentsbody", "raw_text", "image", "pagetype"]
SKIPPED = frozenset(["script", "style", "noscript", "template", "nav", "aside", "footer", "form", "button", "svg", "iframe", "select"])
BLOCKS = frozenset(["p", "div", "section", "article", "main", "header", "h1", "h2", "h3", "h4", "h5", "h6", "li", "ul", "ol", "table", "tr", "td", "th", "blockquote", "pre", "br", "hr", "dt", "dd", "dl", "figure", "figcaption", "body"])
VOID = frozenset(["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"])
#: Words in a container's class or id that tell what it holds.
FURNITURE = re.compile(r"(?:^|[\s_-])(?:nav|navbar|navigation|menu|sidebar|footer|share|sharing|social|related|breadcrumbs?|cookies?|advert|advertisement|ads?|promo|teasers?|newsletter|subscribe|popular|recommended)(?:$|[\s_-])", re.I)
COMMENTS = re.compile(r"(?:^|[\s_-])(?:comments?|replies|disqus)(?:$|[\s_-])", re.I)
#: Kinds of what stands inside a container, the strongest first.
FURNISHED, COMMENTED, ARTICLE, OTHER = range(4)


def is_html(text: Column) -> Column:
    """Whether any tag is found; false for null."""
    return F.coalesce(text.rlike(TAG), F.lit(False))


class _Reader(HTMLParser):
    """Blocks of visible text with their link share and the kind of container
    they stand in; metadata. Unclosed and stray tags are tolerated."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[str, int, int, tuple[int, ...]]] = []
        self.run: list[str] = []
        self.linked = self.links = 0
        self.title: list[str] = []
        self.in_title = False
        self.meta: dict[str, str] = {}
        self.open: list[tuple[str, int, int]] = []
        self.count = 0

    def _kind(self) -> int:
        return self.open[-1][1] if self.open else OTHER

    def _end_block(self):
        text = " ".join("".join(self.run).split())
        if text and self._kind() != FURNISHED:
            # the containers around the block's own element, the nearest first, as far as they may count
            around = tuple(n for tag, _, n in self.open[-2:-12:-1] if tag not in ("body", "html"))
            self.blocks.append((text, self.linked, self._kind(), around))
        self.run, self.linked = [], 0

    def handle_starttag(self, tag, attrs):
        a = {k: v or "" for k, v in attrs}
        if tag == "meta":
            key = (a.get("name") or a.get("property") or "").lower()
            if key and a.get("content"):
                self.meta.setdefault(key, a["content"])
        elif tag == "time" and a.get("datetime"):
            self.meta.setdefault("time", a["datetime"])
        elif tag in ("a", "link") and "license" in a.get("rel", "").lower().split() and a.get("href"):
            self.meta.setdefault("license", a["href"])
        if tag in BLOCKS:
            self._end_block()
            # these end where the next block, or one like them, begins
            if self.open and (self.open[-1][0] == "p" or (self.open[-1][0] == tag and tag in ("li", "tr", "td", "th", "dt", "dd"))):
                self.open.pop()
        self.in_title = tag == "title" or (self.in_title and tag in VOID)
        if tag == "a":
            self.links += 1
        if tag in VOID or tag == "a":
            return
        named = f"{a.get('class', '')} {a.get('id', '')}"
        kind = self._kind()
        if tag in SKIPPED or FURNITURE.search(named) or "hidden" in a:
            kind = FURNISHED
        elif COMMENTS.search(named):
            kind = min(kind, COMMENTED)
        elif tag in ("article", "main"):
            kind = min(kind, ARTICLE)
        self.count += 1
        self.open.append((tag, kind, self.count))

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self._end_block()
        if tag == "title":
            self.in_title = False
        if tag == "a":
            self.links = max(0, self.links - 1)
            return
        for k in range(len(self.open) - 1, max(-1, len(self.open) - 40), -1):
            if self.open[k][0] == tag:
                if self.open[k][1] == FURNISHED:
                    self.run, self.linked = [], 0
                del self.open[k:]
                break

    def handle_data(self, data):
        if self.in_title:
            self.title.append(data)
        elif self._kind() != FURNISHED:
            self.run.append(data)
            if self.links:
                self.linked += len(data.strip())


def _fullest(blocks: list[tuple[str, tuple[int, ...]]]) -> list[str]:
    """The blocks in the container with most text: a block counts whole for the
    container it stands in and half for the one around that."""
    score: dict[int, float] = {}
    for text, around in blocks:
        for n, weight in zip(around, (1.0, 0.5)):
            score[n] = score.get(n, 0.0) + weight * len(text)
    best = max(score, key=lambda n: (score[n], -n), default=None)
    inside = [text for text, around in blocks if best in around]
    # text that stands in no container, or scattered over many, is taken whole
    return inside if 4 * sum(map(len, inside)) >= sum(len(t) for t, _ in blocks) else [t for t, _ in blocks]


def extract(source: str | None, url: str | None = None) -> dict[str, str] | None:
    """Metadata and main text of a page; null if there is no tag or no text.

    Blocks that are mostly links and containers named as page furniture are left
    out; comments stand apart. Where the page marks its article, only that
    counts, else the container with most text.
    """
    if not source or not re.search(TAG, source):
        return None
    reader = _Reader()
    try:
        reader.feed(source)
        reader.close()
    except (AssertionError, ValueError):
        return None
    reader._end_block()
    plain = [(t, kind, around) for t, linked, kind, around in reader.blocks if linked <= len(t) / 2]
    article = [t for t, kind, _ in plain if kind == ARTICLE]
    comments = [t for t, kind, _ in plain if kind == COMMENTED]
    kept = article or _fullest([(t, around) for t, kind, around in plain if kind != COMMENTED])
    if not kept:
        return None
    meta = reader.meta
    host = re.sub(r"^[a-z]+://([^/?#:]+).*$", r"\1", url, flags=re.S) if url else None
    words = re.findall(r"\w+", " ".join(kept).lower())
    return {
        "title": " ".join("".join(reader.title).split()) or meta.get("og:title"),
        "description": meta.get("description") or meta.get("og:description"),
        "author": meta.get("author") or meta.get("article:author"),
        "hostname": host,
        "sitename": meta.get("og:site_name") or meta.get("application-name"),
        "date": meta.get("article:published_time") or meta.get("date") or meta.get("time"),
        "categories": meta.get("article:section"),
        "tags": meta.get("keywords") or meta.get("article:tag"),
        # the same for pages whose text differs only in case, spacing and marks
        "fingerprint": hashlib.blake2b(" ".join(words).encode("utf-8", "surrogatepass"), digest_size=8).hexdigest(),
        "license": meta.get("license") or meta.get("dc.rights") or meta.get("copyright"),
        "image": meta.get("og:image"),
        "pagetype": meta.get("og:type"),
        "text": "\n".join(kept),
        "raw_text": " ".join(kept),
        "body": "\n".join(kept),
        "comments": "\n".join(comments) or None,
        "commentsbody": "\n".join(comments) or None,
    }


def extract_pages(df: DataFrame, keys: list[str], html_col: str = "text", url_col: str = "url") -> DataFrame:
    """Key columns, ``successful_extraction`` and the extraction columns (all strings).

    Pages without tags, and pages the parser gives up on, fail: all columns null.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            results = [extract(t, u) for t, u in zip(f["_html"], f["_url"])]
            out = f[keys].copy()
            out["successful_extraction"] = [r is not None for r in results]
            for c in FIELDS:
                out[c] = pd.Series([r.get(c) if r else None for r in results], dtype="object", index=f.index)
            yield out

    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keys) + ", successful_extraction boolean, " + ", ".join(f"`{c}` string" for c in FIELDS)
    return df.select(*keys, F.col(html_col).alias("_html"), F.col(url_col).alias("_url")).mapInPandas(run, schema)
