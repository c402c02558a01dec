"""Repair of scanned pages: furniture, cut words, misread words.

Pages of a book are read in order, in bounded runs of neighbours. A line-pair
classifier compares each edge line with the edge lines of nearby pages (page
furniture comes back, slightly misread, with a number that keeps step); a
second one judges whether the end of a line and the begin of the next are one
word. The words of all text lines make a vocabulary; for a word that is rare
beside a similar one, correction candidates come from an inverted join on
character q-grams, and gradient-boosted trees choose among them. All three
models learn from the data itself: from noised copies of its own lines and
words, no labels needed.
"""

from __future__ import annotations

import random
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lekhani.session import cut_lineage

#: Pages of a book handled together, and neighbours seen on either side.
RUN, HALO = 64, 12
#: Pages one group may hold; books with a fuller run of places are read place by place.
GROUP_PAGES = 10_000
#: Pages at either end of a crowded place that neighbours get to see; HALO are needed,
#: and as they are drawn by hash, fewer than that come with a probability below 1e-7.
EDGE_PAGES = 48
HYPHENS = "-‐‑¬­"
ENDS = ".!?।॥۔؟:"
#: Least count of a word to be a correction, and how much rarer a misreading is.
KNOWN_COUNT, RARER = 4, 6
#: A misreading happens to at most this share of a word's occurrences.
MISREAD_SHARE = 0.02
#: Bounded training samples: words, pages for line pairs, pairs of words for the ranker.
TRAIN_WORDS, TRAIN_LINES, TRAIN_PAIRS = 3000, 1500, 100_000
#: Grams known to be frequent; they are offered last, which saves work and changes no result.
FREQUENT_GRAMS = 2000

# What scanners confuse, right -> wrong.
CONFUSIONS = (("m", "rn"), ("n", "ri"), ("d", "cl"), ("w", "vv"), ("u", "ii"), ("h", "b"), ("h", "li"), ("e", "c"), ("c", "e"), ("i", "l"), ("l", "1"), ("i", "1"), ("l", "i"), ("o", "0"), ("s", "5"), ("g", "9"), ("t", "f"), ("b", "h"), ("a", "o"), ("i", "."), ("r", "'"), ("u", "'"), ("e", "."), ("a", "1"), ("e", ""), ("i", ""), ("a", ""), ("li", "h"), ("म", "भ"), ("भ", "म"), ("व", "ब"), ("ब", "व"), ("ध", "घ"), ("घ", "ध"), ("प", "ष"), ("थ", "य"), ("ख", "रव"), ("ी", "ि"), ("ব", "র"), ("র", "ব"), ("ম", "ষ"), ("ত", "ভ"), ("ন", "ণ"), ("ী", "ি"), ("য", "ষ"), ("ன", "ள"), ("ந", "ங"), ("ய", "ப"), ("ி", "ீ"), ("ீ", "ி"), ("ர", "ா"))

_NUMBER = re.compile(r"^[\W_]*(?:page|p\.?|पृष्ठ|পৃষ্ঠা|பக்கம்)?[\W_]*([\w']{1,6}?)(?:\s+of\s+\w{1,5})?[\W_]*$", re.I)
_GAP = re.compile(r"\s{2,}|\t|\s*[|—–]\s*|\s+(?=[\[(—–-]\s*\w{1,5}\s*[\])—–-]\s*$)")
_ROMAN = re.compile(r"^(?=[mdclxvi1])m{0,3}(?:cm|cd|d?c{0,3})(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3})$")
_MISREAD_DIGITS = str.maketrans("lIiOoSsBbZzgq|!", "111005588229911")


def page_number(text: str) -> list[int]:
    """Numbers that a line part may mean: digits of any script, also misread, or Roman."""
    m = _NUMBER.match(text.strip())
    if not m:
        return []
    core, out = m.group(1), []
    if core and all(unicodedata.decimal(c, None) is not None for c in core):
        return [int("".join(str(unicodedata.decimal(c)) for c in core))]
    low = core.lower()
    if _ROMAN.match(low.replace("1", "i")):
        value, prior = 0, 0
        for c in reversed(low.replace("1", "i")):
            v = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100, "d": 500, "m": 1000}[c]
            value += v if v >= prior else -v
            prior = max(prior, v)
        out.append(value)
    fixed = core.translate(_MISREAD_DIGITS)
    if fixed.isdigit() and any(c.isdigit() or c in "lIOSo" for c in core):
        out.append(int(fixed))
    return out


class _Letters(dict):
    """Code point -> itself if a letter or vowel sign, else a blank; for str.translate."""

    def __missing__(self, c: int) -> int:
        kept = self[c] = c if unicodedata.category(chr(c))[0] in "LM" else 32
        return kept


class _Cores(dict):
    """Lower-case word -> the word without adjoining marks, "" if it has no two letters."""

    LIMIT = 500_000

    def __missing__(self, w: str) -> str:
        a, b = 0, len(w)
        while a < b and unicodedata.category(w[a])[0] not in "LMN":
            a += 1
        while b > a and unicodedata.category(w[b - 1])[0] not in "LMN":
            b -= 1
        core = w[a:b]
        core = core if sum(unicodedata.category(c)[0] == "L" for c in core) >= 2 else ""
        if len(w) <= 40:
            if len(self) >= self.LIMIT:
                self.clear()
            self[w] = core
        return core


_LETTERS, _CORES = _Letters(), _Cores()


def skeleton(text: str) -> str:
    """Letters of a line in lower case, single blanks between words."""
    return " ".join(text.lower().translate(_LETTERS).split())


def split_number(line: str) -> tuple[list[int], str]:
    """A furniture line's page number, if it has one, and the rest of it."""
    whole = page_number(line)
    if whole:
        return whole, ""
    parts = [p for p in _GAP.split(line.strip()) if p and p.strip()]
    if len(parts) > 1:
        for k in (0, -1):
            n = page_number(parts[k])
            if n:
                rest = parts[1:] if k == 0 else parts[:-1]
                return n, " ".join(rest)
        if len(parts) > 2 and re.fullmatch(r"[\w]{1,6}", parts[1].strip()):
            n = page_number(parts[1])
            if n:
                return n, " ".join(parts[:1] + parts[2:])
    return [], line


class _Pairs(dict):
    """Skeleton -> its 2-grams."""

    LIMIT = 20_000

    def __missing__(self, s: str) -> frozenset[str]:
        padded = f" {s} "
        grams = frozenset(map("".join, zip(padded, padded[1:])))
        if len(self) >= self.LIMIT:
            self.clear()
        self[s] = grams
        return grams


_PAIRS = _Pairs()


def pair_features(a: str, b: str) -> list[float]:
    """Likeness of two line skeletons."""
    x, y = _PAIRS[a], _PAIRS[b]
    common = len(x & y)
    longer = max(len(a), len(b), 1)
    p = 0
    while p < min(len(a), len(b)) and a[p] == b[p]:
        p += 1
    q = 0
    while q < min(len(a), len(b)) - p and a[-1 - q] == b[-1 - q]:
        q += 1
    return [1.0, common / max(1, len(x | y)), common / max(1, min(len(x), len(y))), (p + q) / longer, abs(len(a) - len(b)) / longer, abs(a.count(" ") - b.count(" "))]


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 400, l2: float = 1e-3) -> np.ndarray:
    """Weights of a logistic regression by plain gradient steps on scaled columns."""
    scale = np.maximum(np.abs(x).max(axis=0), 1e-9)
    z, w = x / scale, np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        w -= 4.0 * (z.T @ (p - y) / len(y) + l2 * w)
    return w / scale


def noised(text: str, rng: random.Random) -> str:
    """A copy with one or two scanning errors."""
    for _ in range(rng.choice((1, 1, 2))):
        fits = [(a, b) for a, b in CONFUSIONS if a in text]
        if fits and rng.random() < 0.8:
            a, b = rng.choice(fits)
            at = rng.choice([m.start() for m in re.finditer(re.escape(a), text)])
            text = text[:at] + b + text[at + len(a) :]
        elif len(text) > 3:
            at = rng.randrange(len(text))
            text = text[:at] + rng.choice(("", "'", ".", "1")) + text[at + 1 :]
    return text


@dataclass
class Trees:
    """Boosted regression trees of depth 3 on logistic loss."""

    base: float
    trees: list[tuple]

    @staticmethod
    def fit(x: np.ndarray, y: np.ndarray, n: int = 60, rate: float = 0.2, depth: int = 3) -> Trees:
        edges = [np.unique(np.quantile(c, np.linspace(0, 1, 25)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(e, c, "right") for e, c in zip(edges, x.T)], axis=1)
        base = float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
        score = np.full(len(y), base)
        trees = []

        def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, left: int):
            leaf = -g[rows].sum() / (h[rows].sum() + 1.0)
            if left == 0 or len(rows) < 20:
                return rate * leaf
            best = (1e-3, None, None)
            whole = g[rows].sum() ** 2 / (h[rows].sum() + 1)
            for f in range(x.shape[1]):
                k = len(edges[f]) + 1
                gs, hs = np.cumsum(np.bincount(binned[rows, f], g[rows], k)), np.cumsum(np.bincount(binned[rows, f], h[rows], k))
                gain = gs**2 / (hs + 1) + (gs[-1] - gs) ** 2 / (hs[-1] - hs + 1) - whole
                j = int(gain[:-1].argmax()) if k > 1 else 0
                if k > 1 and gain[j] > best[0]:
                    best = (gain[j], f, j)
            if best[1] is None:
                return rate * leaf
            f, j = best[1], best[2]
            low = binned[rows, f] <= j
            return (f, edges[f][j], grow(rows[low], g, h, left - 1), grow(rows[~low], g, h, left - 1))

        for _ in range(n):
            p = 1 / (1 + np.exp(-score))
            tree = grow(np.arange(len(y)), p - y, np.maximum(p * (1 - p), 1e-6), depth)
            trees.append(tree)
            score += Trees._apply(tree, x)
        return Trees(base, trees)

    @staticmethod
    def _apply(tree, x: np.ndarray) -> np.ndarray:
        if not isinstance(tree, tuple):
            return np.full(len(x), tree)
        f, edge, low, high = tree
        return np.where(x[:, f] < edge, Trees._apply(low, x), Trees._apply(high, x))

    def predict(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.base + sum(Trees._apply(t, x) for t in self.trees), -30, 30)))


def tokens(line: str) -> list[str]:
    """Lower-case words without adjoining marks; what has no two letters is left out."""
    return [w for w in map(_CORES.__getitem__, line.lower().split()) if w]


@dataclass
class Page:
    doc: str
    place: int
    lines: list[str]
    own: bool
    title: str
    text: list[int] | None = None  # numbers of text lines that are not blank
    furniture: list[int] | None = None


def edge_lines(page: Page, top: bool) -> list[int]:
    """Numbers of the two outermost lines that are not blank."""
    order = range(len(page.lines)) if top else range(len(page.lines) - 1, -1, -1)
    out = []
    for k in order:
        if page.lines[k].strip():
            out.append(k)
            if len(out) == 2:
                break
    return out


def mark_furniture(pages: list[Page], weights: np.ndarray) -> None:
    """Decides the edge lines of ordered pages of one book."""
    read: dict[tuple[int, bool], list[tuple[int, list[int], str, str]]] = {}
    for i, p in enumerate(pages):
        for top in (True, False):
            read[i, top] = [(k, *_read_edge(p.lines[k])) for k in edge_lines(p, top)]
    known: dict[tuple[str, str], bool] = {}

    def alike(a: str, b: str) -> bool:
        if a == b:
            return True
        key = (a, b) if a < b else (b, a)
        if key not in known:
            known[key] = bool(np.dot(pair_features(a, b), weights) > 0)
        return known[key]

    heads: list[tuple[int, str]] = []  # headings met so far: page index, skeleton
    closed = True  # whether the text before ended a sentence
    for i, p in enumerate(pages):
        near = [j for j in range(max(0, i - HALO), min(len(pages), i + HALO + 1)) if j != i]
        p.furniture = []
        for top in (True, False):
            for rank, (k, numbers, bare, rest) in enumerate(read[i, top]):
                if k in p.furniture:
                    continue
                steps = [v - p.place for v in numbers]
                in_step = any(s == 0 for s in steps) or any(v - pages[j].place in steps for j in near for _, ns, *_ in read[j, top] for v in ns)
                if numbers and not bare:
                    if in_step:
                        p.furniture.append(k)
                        continue
                    break
                twins = [j for j in near if any(alike(bare, other) for _, _, other, _ in read[j, top] if other)] if len(bare) >= 4 else []
                if _is_prose(rest) and len([j for j in twins if any(bare == other for _, _, other, _ in read[j, top])]) < 3:
                    break
                echo = top and len(bare) >= 4 and any(alike(bare, h) for _, h in heads[-HALO:])
                named = bool(p.title) and len(bare) >= 4 and alike(bare, p.title)
                if (numbers and in_step) or named and (twins or rank == 0) or echo or len(twins) >= 2 or (len(twins) == 1 and len(near) <= 6):
                    if top and not (numbers and in_step) and _opens_chapter(pages, i, k, bare, named, twins, heads, closed, alike):
                        heads.append((i, bare))
                        break
                    p.furniture.append(k)
                    continue
                break
        cut = set(p.furniture)
        p.text = [k for k, x in enumerate(p.lines) if x.strip() and k not in cut]
        for a, k in enumerate(p.text):
            line = p.lines[k]
            alone = (k == 0 or not p.lines[k - 1].strip() or k - 1 in cut) and (k + 1 >= len(p.lines) or not p.lines[k + 1].strip() or a == 0)
            if alone and len(line.strip()) <= 60 and not _is_prose(line) and len(head := skeleton(line)) >= 4:
                heads.append((i, head))
        if p.text:
            closed = p.lines[p.text[-1]].rstrip()[-1:] in ENDS + "”\""


def _is_prose(line: str) -> bool:
    """Whether a line reads like running text: marks of a sentence in it or at its end, or a small first letter."""
    x = line.strip()
    words = [w for w in x.split() if w[:1].isalpha()]
    titled = bool(words) and sum(w[:1].isupper() for w in words) >= 0.6 * len(words)
    return bool(re.search(r"[,;:?!।॥۔]", x)) or (not titled and (x[:1].islower() or (len(words) > 5 and bool(re.search(r"[.]\s|[.]$", x)))))


def _read_edge(line: str) -> tuple[list[int], str, str]:
    """Numbers, skeleton and wording of a line without its page number."""
    numbers, rest = split_number(line)
    return numbers, skeleton(rest), rest


def _opens_chapter(pages, i, k, bare, named, twins, heads, closed, alike) -> bool:
    """Whether a line that looks like a running title is a chapter's own heading.

    A chapter's running title repeats the heading, so the first such line of a
    book is the heading unless the same line was met before; the book's title
    runs from the pages after the first on.
    """
    if i == 0 and pages[0].own:
        return True
    if named or any(alike(bare, h) for _, h in heads) or any(j < i for j in twins):
        return False
    if i <= 3:
        return False
    rest = [x for x in pages[i].lines[k + 1 :] if x.strip()]
    fresh = bool(rest) and not (rest[0].lstrip()[:1].islower())
    return closed and fresh


def train_line_pairs(pages: DataFrame, seed: int = 5) -> np.ndarray:
    """Line-pair weights from a bounded sample of edge lines and noised copies of them."""
    sample = pages.select("_text").orderBy(F.xxhash64("_text")).limit(TRAIN_LINES).collect()
    rng = random.Random(seed)
    lines = [s for r in sample for x in r._text.split("\n")[:3] if len(s := skeleton(x)) >= 6]
    if len(lines) < 2:
        return np.array([-6.0, 4.0, 2.0, 4.0, -2.0, -0.5])
    x, y = [], []
    for a in lines:
        x.append(pair_features(a, skeleton(noised(a, rng))))
        y.append(1)
        b = rng.choice(lines)
        if a != b:
            x.append(pair_features(a, b))
            y.append(0)
    return logistic(np.array(x), np.array(y))


def ordered_lines(df: DataFrame, doc_col: str = "doc_id", book_col: str = "identifier", url_col: str = "url", text_col: str = "text", name_col: str = "pdf_name") -> DataFrame:
    """Lines of all pages: doc, line_no, kind (text or furniture), words, and for
    a line that ends in a hyphen left, right (the halves) and sign.

    Pages are in the order of their book, place (the last element of the url)
    and a hash of their id. They are grouped by book and run of places, each run
    with copies of its neighbours; see ``page_groups``. Repeated rows are read
    once. Pages without book or place are read on their own. A word may continue
    up to HALO places on.
    """
    place = F.try_to_number(F.regexp_extract(F.col(url_col), r"/([0-9]{1,9})/*$", 1), F.lit("999999999")).cast("long")
    base = df.select(F.col(doc_col).cast("string").alias("_doc"), F.col(book_col).cast("string").alias("_book"), place.alias("_place"), F.col(text_col).alias("_text"), F.regexp_replace(F.col(name_col), r"\.[a-z]+$", "").alias("_name"))
    base = base.where("_doc is not null and _text is not null and trim(_text) != ''").withColumn("_h", F.xxhash64("_text")).dropDuplicates(["_doc", "_h"])
    weights = train_line_pairs(base)
    keyed = page_groups(base, rows=df.select(F.col(book_col).cast("string").alias("_book"), place.alias("_place")))
    keyed = keyed.repartition("_book", "_group").sortWithinPartitions("_book", "_group", "_place", "_at", "_doc")

    def run_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, pages = None, []
        rows: list[tuple] = []
        for batch in batches:
            for book, g, place, _, doc, own, name, text in zip(*(c.to_pylist() for c in batch.columns)):
                if (book, g) != group:
                    rows += read_book(pages, weights)
                    group, pages = (book, g), []
                    if len(rows) > 20_000:
                        yield _line_batch(rows)
                        rows = []
                pages.append(Page(doc, place or 0, text.split("\n"), own, skeleton((name or "").replace("_", " "))))
        rows += read_book(pages, weights)
        if rows:
            yield _line_batch(rows)

    return keyed.mapInArrow(run_, "doc string, line_no int, kind string, words array<string>, left string, right string, sign string, to_doc string, to_line int")


def page_groups(base: DataFrame, most: int | None = None, rows: DataFrame | None = None) -> DataFrame:
    """(_book, _group, _place, _at, _doc, _own, _name, _text): every page in its own
    group (_own), and copies in the groups that need it as a neighbour.

    A group is a run of RUN places with HALO places on either side. A book with
    more than ``most`` pages in one run (a wrong or default identifier that many
    pages share) is grouped by place and, within a place, by equal ranges of the
    hash that orders its pages; the pages next to a range's ends are copied to
    the ranges and places beside it. So groups are bounded and every page sees
    the HALO pages before and after it, whatever the book's size.

    ``rows`` (_book, _place), repeated rows included, are what is counted first,
    so that the texts need not be read to see that no book is crowded.
    """
    most = GROUP_PAGES if most is None else most
    lone = F.col("_book").isNull() | F.col("_place").isNull()
    base = base.withColumn("_at", (F.pmod(F.xxhash64("_doc"), F.lit(1 << 30)) / (1 << 30)))
    single = base.where(lone).select(F.concat(F.lit("\u0000"), "_doc").alias("_book"), F.lit("").alias("_group"), "_place", "_at", "_doc", F.lit(True).alias("_own"), "_name", "_text")
    placed = base.where(~lone)
    run = F.floor(F.col("_place") / RUN)
    crowd = lambda df: df.groupBy("_book", run.alias("_run")).agg(F.count("*").alias("_n")).where(F.col("_n") > most).select("_book").distinct()

    def copies(df: DataFrame, targets: Column) -> DataFrame:
        return df.withColumn("_t", F.explode(targets)).select("_book", F.col("_t.group").alias("_group"), "_place", "_at", "_doc", F.col("_t.own").alias("_own"), "_name", "_text")

    to = lambda group, own: F.struct(group.cast("string").alias("group"), F.lit(own).alias("own"))
    offset = F.col("_place") - run * RUN
    runs = F.array_compact(F.array(to(run, True), F.when(offset < HALO, to(run - 1, False)), F.when(offset >= RUN - HALO, to(run + 1, False))))
    if crowd((base if rows is None else rows).where(~lone)).isEmpty():
        return copies(placed, runs).union(single)
    sizes = placed.groupBy("_book", "_place").agg(F.count("*").alias("_n"))
    crowded = crowd(placed)
    calm = placed.join(crowded, "_book", "left_anti")
    # ranges of the hash within a place, about half of the most pages each
    ranges = sizes.join(crowded, "_book", "left_semi").withColumn("_ranges", F.ceil(F.col("_n") * 2 / F.lit(most)))
    pages = placed.join(ranges, ["_book", "_place"])
    mine = F.least(F.floor(F.col("_at") * F.col("_ranges")), F.col("_ranges") - 1)
    name = lambda place, part: F.concat_ws(":", place, part)
    span = F.lit(float(EDGE_PAGES)) / F.col("_n")  # of the hash, that holds about EDGE_PAGES pages
    inside = F.array_compact(F.array(to(name(F.col("_place"), mine), True), F.when((mine > 0) & (F.col("_at") < mine / F.col("_ranges") + span), to(name(F.col("_place"), mine - 1), False)), F.when((mine < F.col("_ranges") - 1) & (F.col("_at") > (mine + 1) / F.col("_ranges") - span), to(name(F.col("_place"), mine + 1), False))))
    # the first and last pages of a place, to the last range of the places before and the first of those after
    back = F.when(F.col("_at") < span, F.transform(F.sequence(F.lit(1), F.lit(HALO)), lambda k: F.struct((F.col("_place") - k).alias("place"), F.lit(True).alias("before"))))
    on = F.when(F.col("_at") > 1 - span, F.transform(F.sequence(F.lit(1), F.lit(HALO)), lambda k: F.struct((F.col("_place") + k).alias("place"), F.lit(False).alias("before"))))
    none = F.array().cast("array<struct<place:bigint,before:boolean>>")
    beside = pages.withColumn("_t", F.explode(F.concat(F.coalesce(back, none), F.coalesce(on, none))))
    there = ranges.select(F.col("_book").alias("_b"), F.col("_place").alias("_p"), F.col("_ranges").alias("_r"))
    beside = beside.join(there, (F.col("_book") == F.col("_b")) & (F.col("_t.place") == F.col("_p")))
    group = name(F.col("_p"), F.when(F.col("_t.before"), F.col("_r") - 1).otherwise(F.lit(0)))
    beside = beside.select("_book", group.alias("_group"), "_place", "_at", "_doc", F.lit(False).alias("_own"), "_name", "_text")
    return copies(calm, runs).union(copies(pages, inside)).union(beside).union(single)


def _line_batch(rows: list[tuple]) -> pa.RecordBatch:
    doc, no, kind, words, left, right, sign, to_doc, to_line = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(no, pa.int32()), pa.array(kind), pa.array(words, pa.list_(pa.string())), pa.array(left, pa.string()), pa.array(right, pa.string()), pa.array(sign, pa.string()), pa.array(to_doc, pa.string()), pa.array(to_line, pa.int32())], names=["doc", "line_no", "kind", "words", "left", "right", "sign", "to_doc", "to_line"])


def read_book(pages: list[Page], weights: np.ndarray) -> list[tuple]:
    """Rows of ``ordered_lines`` for the own pages of one group."""
    if not pages:
        return []
    mark_furniture(pages, weights)
    out = []
    flow = [(p, k) for p in pages for k in p.text]
    skip_first = None
    for n, (p, k) in enumerate(flow):
        line = p.lines[k].rstrip()
        words = tokens(line)
        if skip_first is not None and words and words[0] == skip_first:
            words = words[1:]
        skip_first = left = right = sign = to_doc = to_line = None
        if len(line) > 2 and line[-1] in HYPHENS and unicodedata.category(line[-2])[0] in "LM" and n + 1 < len(flow):
            page, at = flow[n + 1]
            following = page.lines[at].split()[0]
            last = line.split()[-1]
            half = "".join(c for c in last[:-1].lower() if unicodedata.category(c)[0] in "LMN" or c in "-'")
            rest = _head(following)
            if half and rest:
                left, right, sign, to_doc, to_line = half, rest, line[-1], page.doc, at
                # the halves are no words of their own
                if words and words[-1] == (tokens(last) or [None])[0]:
                    words = words[:-1]
                skip_first = (tokens(following) or [None])[0]
        if p.own:
            out.append((p.doc, k, "text", words, left, right, sign, to_doc, to_line))
    for p in pages:
        if p.own:
            out += [(p.doc, k, "furniture", None, None, None, None, None, None) for k in p.furniture]
    return out


def _head(word: str) -> str:
    """The letters a word begins with, marks at its ends left off."""
    t = word.lower().rstrip("".join(c for c in set(word) if unicodedata.category(c)[0] not in "LMN"))
    return t if t and unicodedata.category(t[0])[0] in "LM" else ""


def join_features(whole: np.ndarray, compound: np.ndarray, left: np.ndarray, right: np.ndarray, plain: np.ndarray) -> np.ndarray:
    lg = lambda x: np.log1p(np.asarray(x, float))
    return np.stack([np.ones(len(whole)), lg(whole), lg(compound), lg(whole) - lg(compound), np.minimum(lg(left), lg(right)) * (np.asarray(whole) == 0), lg(right) * (np.asarray(whole) == 0), np.asarray(plain, float)], axis=1)


def train_joins(vocabulary: DataFrame, seed: int = 7) -> np.ndarray:
    """Join weights: known words cut anywhere are joined, known compounds cut at
    their hyphen are not. Bounded samples by hash."""
    order = F.xxhash64("word")
    words = vocabulary.where((F.col("n") >= KNOWN_COUNT) & (F.length("word") >= 5) & ~F.col("word").contains("-")).orderBy(order).limit(TRAIN_WORDS).collect()
    compounds = vocabulary.where((F.col("n") >= 2) & F.col("word").rlike(r"\A[\p{L}\p{M}]{2,}-[\p{L}\p{M}]{2,}\z")).orderBy(order).limit(TRAIN_WORDS).collect()
    known = {r.word: r.n for r in words}
    rng = random.Random(seed)
    rows, y = [], []
    for r in words:
        at = rng.randrange(2, len(r.word) - 1)
        a, b = r.word[:at], r.word[at:]
        rows.append((r.n * rng.choice((0, 1, 1, 1)), 0, known.get(a, 0), known.get(b, 0), rng.random() < 0.6))
        y.append(1)
        other = rng.choice(words)  # the rest of the word is lost, another word follows
        rows.append((known.get(a + other.word, 0), 0, known.get(a, 0), other.n, rng.random() < 0.6))
        y.append(0)
    for _ in range(len(words) if compounds else 0):  # as many compounds as words
        r = rng.choice(compounds)
        a, b = r.word.split("-")
        rows.append((0, r.n, known.get(a, r.n), known.get(b, r.n), True))
        y.append(0)
    if not rows or len(set(y)) < 2:
        return np.array([0.5, 1.0, -2.0, 0.5, -0.2, -0.3, -0.2])
    return logistic(join_features(*(np.array(c) for c in zip(*rows))), np.array(y), 1500)


def joined_words(lines: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(doc, line_no, word, to_doc, to_line): words cut over two lines, as one word, and where the second half stands."""
    cuts = lines.where("left is not null").drop("words").withColumn("whole", F.concat(F.regexp_replace("left", r"['\x{ad}]", ""), "right")).withColumn("compound", F.concat_ws("-", "left", "right"))
    weights = train_joins(vocabulary)
    for c in ("whole", "compound", "left", "right"):
        counted = vocabulary.select(F.col("word").alias(f"_{c}"), F.col("n").alias(f"n_{c}"))
        cuts = cuts.join(counted, cuts[c] == counted[f"_{c}"], "left").drop(f"_{c}").na.fill(0, [f"n_{c}"])
    lg = lambda c: F.log1p(F.col(c).cast("double"))
    unseen = (F.col("n_whole") == 0).cast("double")
    terms = [F.lit(1.0), lg("n_whole"), lg("n_compound"), lg("n_whole") - lg("n_compound"), F.least(lg("n_left"), lg("n_right")) * unseen, lg("n_right") * unseen, F.col("sign").isin("-", "‐", "‑").cast("double")]
    score = sum(F.lit(float(w)) * t for w, t in zip(weights, terms))
    return cuts.where(score > 0).select("doc", "line_no", F.col("whole").alias("word"), "to_doc", "to_line")


def grams_of(word: str, q: int) -> set[str]:
    padded = f"^{word}$"
    return {padded[i : i + q] for i in range(len(padded) - q + 1)}


def frequent_grams(known: DataFrame) -> dict[str, int]:
    """The most frequent 2- and 3-grams of the known words, at most FREQUENT_GRAMS."""
    padded = F.concat(F.lit("^"), F.col("right"), F.lit("$"))
    grams = lambda q: F.transform(F.sequence(F.lit(1), F.greatest(F.length(padded) - (q - 1), F.lit(1))), lambda i: F.substring(padded, i, F.lit(q)))
    counts = known.select(F.explode(F.array_union(grams(2), grams(3))).alias("gram")).groupBy("gram").agg(F.count("*").alias("f"))
    return {r.gram: r.f for r in counts.orderBy(F.desc("f"), "gram").limit(FREQUENT_GRAMS).collect()}


def correction_candidates(suspects: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(word, n, right, n_right): known words within two edits (one for words up
    to four letters) and at least RARER times as frequent.

    Inverted join on q-grams with the prefix filter: strings within k edits share
    all but q * k of the longer one's grams, so it is enough that either side
    offers q * k + 1 of them, the same way ordered. Words of up to seven letters
    are looked up by 2-grams, longer ones by 3-grams, which far fewer words
    share; known words offer what words two letters shorter or longer may ask.
    """
    known = vocabulary.where(F.col("n") >= KNOWN_COUNT).select(F.col("word").alias("right"), F.col("n").alias("n_right"))
    frequent = vocabulary.sparkSession.sparkContext.broadcast(frequent_grams(known))

    def offers(df: DataFrame, asked: bool) -> DataFrame:
        word, n = df.columns

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            common = frequent.value
            for batch in batches:
                rows, out = [], []
                for i, w in enumerate(batch.column(0).to_pylist()):
                    for q in (2, 3):
                        if (len(w) <= (7 if asked else 9)) if q == 2 else (len(w) > (7 if asked else 5)):
                            best = sorted(grams_of(w, q), key=lambda g: (common.get(g, 0), g))[: 2 * q + 1]
                            out += best
                            rows += [i] * len(best)
                at = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(out, pa.string())], names=[word, n, "gram"])

        return df.mapInArrow(run, f"{word} string, {n} long, gram string")

    near = (F.abs(F.length("word") - F.length("right")) <= 2) & (F.col("n_right") >= RARER * F.col("n")) & (F.col("n") <= F.col("n_right") * MISREAD_SHARE + 3) & (F.col("word") != F.col("right"))
    edits = F.when(F.length("word") <= 4, 1).otherwise(2)
    close = F.when(F.levenshtein("word", "right", 2) >= 0, F.levenshtein("word", "right", 2) <= edits).otherwise(False)
    pairs = offers(suspects.select("word", "n"), True).join(offers(known, False), "gram").where(near).where(close)
    return pairs.drop("gram").distinct()


def candidate_features(word: pd.Series, n: pd.Series, right: pd.Series, n_right: pd.Series) -> np.ndarray:
    """What the ranker sees of each pair; the edit is what is left between the
    common begin and the common end."""
    known = {(b, a) for a, b in CONFUSIONS}
    out = np.zeros((len(word), 10))
    for i, (w, r) in enumerate(zip(word, right)):
        p = 0
        while p < min(len(w), len(r)) and w[p] == r[p]:
            p += 1
        q = 0
        while q < min(len(w), len(r)) - p and w[-1 - q] == r[-1 - q]:
            q += 1
        a, b = w[p : len(w) - q], r[p : len(r) - q]
        odd = sum(unicodedata.category(c)[0] not in "LM" for c in w)
        out[i] = (len(a), len(b), (a, b) in known, odd, sum(unicodedata.category(c)[0] not in "LM" for c in r), len(w), p == 0, q == 0, abs(len(a) - len(b)), 0)
    out[:, 9] = np.clip(np.log(np.asarray(n_right, float) / np.maximum(np.asarray(n, float), 0.5)), 0, 4.5)
    return out


def train_ranker(vocabulary: DataFrame, pairs: DataFrame, seed: int = 11) -> Trees | None:
    """Boosted trees from noised known words (right answer known) and from real
    rarer words (no answer right). The candidates come from the same join.

    In a large corpus misreadings are seen as often as real words in a small
    one, so no count tells which words are real. Those without a candidate in
    ``pairs`` (the vocabulary's own) are no misreadings at any size."""
    spark = vocabulary.sparkSession
    sound = vocabulary.join(pairs.select("word").distinct(), "word", "left_anti")
    words = sound.where((F.col("n") >= 4 * KNOWN_COUNT) & (F.length("word") >= 3)).orderBy(F.xxhash64("word")).limit(TRAIN_WORDS).collect()
    if len(words) < 20:
        return None
    rng = random.Random(seed)
    known = {r.word for r in words}
    rows = {}
    middle = sorted(r.n for r in words)[len(words) // 2]
    for r in words:
        for _ in range(min(12, 1 + r.n // middle)):  # frequent words are misread more often
            bad = noised(r.word, rng).strip(".'")
            if bad not in known and len(bad) >= 2:
                rows[bad] = (bad, max(1, int(r.n * 10 ** rng.uniform(-3.5, -1.7))), r.word)
    real = sound.where((F.col("n") >= KNOWN_COUNT) & (F.length("word") >= 3)).orderBy(F.xxhash64(F.lit("real"), "word")).limit(TRAIN_WORDS).collect()
    # seldom seen real words look as rare as misreadings do
    rows |= {r.word: (r.word, max(1, r.n // rng.choice((1, 1, 4, 20))), None) for r in real if r.n >= 4 * KNOWN_COUNT or r.word not in rows}
    made = spark.createDataFrame(list(rows.values()), "word string, n long, truth string")
    pairs = cut_lineage(correction_candidates(made.select("word", "n"), vocabulary).join(F.broadcast(made.select("word", "truth")), "word"))
    # how many candidates the made words have grows with the vocabulary: a sample of them by hash
    share = TRAIN_PAIRS / max(pairs.count(), 1)
    key = F.pmod(F.xxhash64("word", "right"), F.lit(1 << 30))
    pairs = pairs.where(key < int(min(1.0, share) * (1 << 30))).orderBy("word", "right").toPandas()
    if not len(pairs):
        return None
    y = (pairs["right"] == pairs["truth"]).to_numpy().astype(float)
    if y.min() == y.max():
        return None
    return Trees.fit(candidate_features(pairs["word"], pairs["n"], pairs["right"], pairs["n_right"]), y)


def corrections(vocabulary: DataFrame) -> DataFrame:
    """(word, right): misread words of the vocabulary and what they should be."""
    pairs = cut_lineage(correction_candidates(vocabulary, vocabulary))
    model = train_ranker(vocabulary, pairs)
    if model is None:
        return pairs.select("word", "right").limit(0)
    shared = vocabulary.sparkSession.sparkContext.broadcast(model)

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            s = shared.value.predict(candidate_features(f["word"], f["n"], f["right"], f["n_right"])) if len(f) else np.zeros(0)
            yield pd.DataFrame({"word": f["word"], "right": f["right"], "n_right": f["n_right"], "score": s})

    scored = pairs.mapInPandas(score, "word string, right string, n_right long, score double").where("score >= 0.5")
    return scored.groupBy("word").agg(F.max_by("right", F.struct("score", "n_right", "right")).alias("right"))


def read_pages(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The ordered lines (kept in the checkpoint folder, three steps read them)
    and the vocabulary (word, n) of their text."""
    lines = cut_lineage(ordered_lines(df))
    words = lines.where("kind = 'text'").select(F.explode("words").alias("word"))
    return lines, cut_lineage(words.groupBy("word").agg(F.count("*").alias("n")))


def small(df: DataFrame, most: int = 200_000) -> DataFrame:
    """The same rows, to be broadcast if there are at most ``most`` (some 20 MB of
    words); a join with more shuffles both sides."""
    return F.broadcast(df) if df.count() <= most else df


def noise_items(df: DataFrame) -> DataFrame:
    """(doc_id, line_no, kind, word): furniture lines (word empty), cut words and
    misread words, each once. Null and blank pages have none."""
    lines, vocabulary = read_pages(df)
    right = cut_lineage(corrections(vocabulary))
    furniture = lines.where("kind = 'furniture'").select("doc", "line_no", "kind", F.lit("").alias("word"))
    cut = joined_words(lines, vocabulary)
    cut = cut.join(right, "word", "left").select("doc", "line_no", F.lit("hyphen").alias("kind"), F.coalesce("right", "word").alias("word"))
    spoken = lines.where("kind = 'text'").select("doc", "line_no", F.explode("words").alias("word"))
    misread = spoken.join(small(right), "word").select("doc", "line_no", F.lit("misread").alias("kind"), F.col("right").alias("word"))
    return furniture.union(cut).union(misread).distinct().withColumnRenamed("doc", "doc_id")


def repaired_pages(df: DataFrame) -> DataFrame:
    """(doc_id, text) per page with text: furniture left out, cut words whole on
    the line they begin on, misread words replaced, lines joined to paragraphs
    (blank lines divide them). A page whose text is all furniture has an empty
    text; null and blank pages have no row."""
    lines, vocabulary = read_pages(df)
    right = cut_lineage(corrections(vocabulary))
    cut = joined_words(lines, vocabulary).join(right, "word", "left").withColumn("word", F.coalesce("right", "word"))
    spoken = lines.where("kind = 'text'").select("doc", "line_no", F.explode("words").alias("word")).distinct()
    nothing = F.lit(None).cast("string")
    actions = lines.where("kind = 'furniture'").select("doc", "line_no", F.lit("drop").alias("do"), nothing.alias("a"), nothing.alias("b"))
    actions = actions.union(cut.select("doc", "line_no", F.lit("last"), "word", nothing))
    actions = actions.union(cut.select("to_doc", "to_line", F.lit("first"), nothing, nothing))
    actions = actions.union(spoken.join(small(right), "word").select("doc", "line_no", F.lit("word"), "word", "right"))
    per_page = actions.groupBy("doc").agg(F.collect_list(F.struct("line_no", "do", "a", "b")).alias("todo"))  # a page's few lines
    pages = df.select(F.col("doc_id").cast("string").alias("doc"), "text").where("doc is not null and text is not null and trim(text) != ''").withColumn("_h", F.xxhash64("text")).dropDuplicates(["doc", "_h"]).drop("_h")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [_repair(t, todo or []) for t, todo in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["doc_id", "text"])

    return pages.join(per_page, "doc", "left").select("doc", "text", "todo").mapInArrow(apply, "doc_id string, text string")


def _repair(text: str, todo: list[dict]) -> str:
    lines: list[str | None] = text.split("\n")
    for x in sorted(todo, key=lambda x: ("word", "first", "last", "drop").index(x["do"])):
        k = x["line_no"]
        if k >= len(lines) or lines[k] is None:
            continue
        if x["do"] == "drop":
            lines[k] = None
        elif x["do"] == "word":
            lines[k] = re.sub(rf"(?<![^\W_]){re.escape(x['a'])}(?![^\W_])", lambda m, b=x["b"]: b.capitalize() if m.group()[:1].isupper() else b, lines[k], flags=re.I)
        elif x["do"] == "first":
            first, *others = lines[k].split() or [""]
            # marks that followed the second half stay at the begin, to be drawn to the word before
            marks = "".join(c for c in first[len(_head(first)) :] if unicodedata.category(c)[0] not in "LMN")
            lines[k] = " ".join([marks, *others] if marks else others) or None
        else:
            words = lines[k].split()
            whole = x["a"]
            lines[k] = " ".join([*words[:-1], whole.capitalize() if words and words[-1][:1].isupper() else whole]) if words else whole
    paragraphs: list[list[str]] = [[]]
    for line in lines:
        if line is None:
            continue
        if line.strip():
            paragraphs[-1].append(" ".join(line.split()))
        elif paragraphs[-1]:
            paragraphs.append([])
    # a mark left at a line's begin belongs to the word before it; lone dashes between words are scan noise
    joined = (" ".join(p) for p in paragraphs if p)
    return "\n\n".join(re.sub(r"(?<=[^\W_]) - (?=[^\W_])", " ", re.sub(r"(?<=\S) ([.,;:?!।॥۔”’)]+)(?= |$)", r"\1", p)) for p in joined)
