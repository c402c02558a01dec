"""Abusive, hateful and sexual content by multiple-instance learning.

A document is a bag of sentences. Every sentence has a logistic score per
category from its words, word pairs and term hits; the bag's score is their
noisy-or, 1 - prod(1 - p). Only document labels are known, so the sentence
weights are learned through the noisy-or, around a prior that knows the terms'
categories only. The same sentence scores then locate the offending sentences.

Term hits see through disguises: look-alike letters, accents, digits for
letters, stars, stretched letters, invisible characters, separators.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CATEGORIES = ("abusive", "hateful", "sexual")
#: Documents the model is fitted on, at most: so many rated ones and so many others,
#: chosen by hash, none of more than TRAIN_CHARS characters.
TRAIN_DOCS, TRAIN_CHARS = 5000, 50_000
#: Terms a list may have; it is a configuration.
MAX_TERMS = 20_000
THRESHOLD = 0.5
#: Weight of a document rated with one category as an example against another.
OTHER_RATED = 0.5
#: Weight of an unrated document without a term as an example against all categories.
UNRATED = 0.15
#: The prior: a sentence's bias, which stays (learned with the weights it falls to
#: -5 and single words then carry sentences: 7 % more rows), and the weights of a
#: term for its own category and for the others, which are learned on.
BIAS, TERM_WEIGHT, OTHER_WEIGHT = -4.0, 5.5, -2.0
#: Occurrences in labelled documents from which a word or pair is a feature, and
#: how many features the model has at most; those that lean most come first.
MIN_DOCS = 2
FEATURES = 40_000

# Letters that look like Latin ones; digits and signs used for letters.
LOOKALIKES = dict(zip("авеёкмнорстухіјѕһԁɡӏзΑΒΕΖΗΙΚΜΝΟΡΤΥΧαεικνορτυχ", "abeekmhopctyxijshdglzABEZHIKMNOPTYXaeiknoptyx")) | dict(zip("АВЕКМНОРСТУХІЈЅ", "ABEKMHOPCTYXIJS"))
LEET = {"a": "a4@", "b": "b8", "e": "e3", "g": "g9", "i": "i1!|", "l": "l1|", "o": "o0", "s": "s5$", "t": "t7+", "z": "z2"}
_OPEN, _CLOSE = "“\"«‘‹„", "”\"»’›“"


def _cleaning() -> dict[int, str | None]:
    table: dict[int, str | None] = {ord(a): b for a, b in LOOKALIKES.items()}
    for c in range(0xC0, 0x250):
        base = unicodedata.normalize("NFKD", chr(c))[0]
        if base.isascii() and base.isalpha():
            table[c] = base
    for c in chain(range(0x300, 0x370), (0xAD, 0x34F, 0x61C, 0x2060, 0xFEFF), range(0x200B, 0x2010), range(0x202A, 0x202F)):
        table[c] = None
    for c in range(0xFF01, 0xFF5F):
        table[c] = chr(c - 0xFEE0)
    return table


CLEAN = _cleaning()
_NEEDS_CLEANING = re.compile("[" + "".join(re.escape(chr(c)) for c in sorted(CLEAN)) + "]")


def _marks() -> dict[int, str]:
    """Sentence ends and line ends to line feeds, other marks to blanks."""
    table = {}
    for c in range(0x3000):
        kind = unicodedata.category(chr(c))
        if chr(c) in ".!?।॥۔؟…\n\r  ":
            table[c] = "\n"
        elif (kind[0] in "PS" and chr(c) not in "-'’") or kind in ("Zs", "Cc"):
            table[c] = " "
    return table


MARKS = _marks()


class Terms:
    """Disguise-proof matcher of a term list."""

    def __init__(self, terms: list[tuple[str, str]]):
        self.terms = [(t.translate(CLEAN).lower().strip(), c) for t, c in terms]
        gap = r"[\s._\-*|/\\]{0,3}"
        bodies = []
        for k, (t, _) in enumerate(self.terms):
            units = [("[" + re.escape(LEET.get(c, c)) + "*]+" if c.isascii() and c.isalpha() else re.escape(c)) for c in t if c.isalpha() or not (c.isspace() or unicodedata.category(c)[0] == "P")]
            plural = r"(?:[\s._\-]?[s5$])?" if t[:1].isascii() else ""
            bodies.append(f"(?P<t{k}>{gap.join(units)}{plural})")
        self.pattern = re.compile(rf"(?<![^\W_])(?:{'|'.join(bodies)})(?![^\W_])", re.I) if bodies else None
        self.starts = {t[:n] for t, _ in self.terms for n in range(2, len(t)) if not t[0].isascii()}
        self.suspects = _Suspects(self)

    def mark(self, text: str) -> str:
        """The text in plain letters, with every hit replaced by feature words."""
        if _NEEDS_CLEANING.search(text):
            text = text.translate(CLEAN)
        if self.pattern is None:
            return text
        found = bytes(map(self.suspects.__getitem__, text.split()))
        if 2 not in found and b"\1\1\1" not in found:
            return text
        quotes = [m.span() for m in re.finditer("“[^”\n]*”|«[^»\n]*»|\"[^\"\n]*\"", text)]

        def replace(m: re.Match) -> str:
            k = int(m.lastgroup[1:])
            term, category = self.terms[k]
            hit = m.group()
            letters = sum(c.isalnum() or c in "$@!|+" for c in hit)
            bare = sum(c.isalpha() for c in term)
            if letters < bare - 2 or (bare < 5 and "*" in hit and letters < bare):
                return hit
            a, b = m.span()
            quoted = any(x < a and b < y for x, y in quotes) or (text[a - 1 : a] in ("'", "‘") and text[b : b + 1] in ("'", "’"))
            return f" zzquoted{category} " if quoted else f" zzterm{category} zzword{k} "

        return self.pattern.sub(replace, text)


class _Suspects(dict):
    """Token -> 2: may be a disguised term or begin one, 1: a single letter, three
    of which in a row may spell one, 0: neither."""

    LIMIT = 500_000

    def __init__(self, terms: Terms):
        super().__init__()
        self.terms = terms

    def __missing__(self, token: str) -> int:
        core = token.strip(".,;:!?()[]{}\"“”‘’«»…।۔")
        if core in self.terms.starts or self.terms.pattern.search(token):
            kind = 2
        elif len(core) == 1 and not core.isdigit():
            kind = 1
        else:
            kind = 0
        if len(token) <= 40:
            if len(self) >= self.LIMIT:
                self.clear()
            self[token] = kind
        return kind


def sentences_of(marked: str) -> dict[tuple[str, ...], int]:
    """Different sentences in lower-case words -> number of the first such one.

    Names inside a sentence become one word. A sentence said again is no
    further witness for the noisy-or, so each stands once.
    """
    out: dict[tuple[str, ...], int] = {}
    n = 0
    for s in marked.translate(MARKS).split("\n"):
        words = s.split()
        if words:
            out.setdefault((words[0].lower(), *["zzname" if w[0].isupper() and not w.isupper() else w.lower() for w in words[1:]]), n)
            n += 1
    return out


class _Numbers(dict):
    """Word -> number of its form in a sentence; forms are shared between instances."""

    LIMIT = 1_000_000

    def __init__(self, forms: dict[str, int], vocabulary: list[int], words: dict[str, int], first: bool):
        super().__init__()
        self.forms, self.vocabulary, self.words, self.first = forms, vocabulary, words, first

    def __missing__(self, w: str) -> int:
        form = "zzname" if not self.first and w[0].isupper() and not w.isupper() else w.lower()
        n = self.forms.get(form)
        if n is None:
            n = self.forms[form] = len(self.vocabulary)
            self.vocabulary.append(self.words.get(form, 0))
        self[w] = n
        return n


class Reader:
    """Different sentences of marked texts as word numbers; the same sentences as
    ``sentences_of`` gives, without building their words again."""

    def __init__(self, words: dict[str, int]):
        self.words = words
        self._fresh()

    def _fresh(self) -> None:
        self.forms: dict[str, int] = {}
        self.vocabulary: list[int] = []
        self.first = _Numbers(self.forms, self.vocabulary, self.words, True)
        self.inner = _Numbers(self.forms, self.vocabulary, self.words, False)

    def read(self, marked: list[str]) -> list[list[tuple[int, ...]]]:
        if len(self.first) + len(self.inner) > _Numbers.LIMIT:
            self._fresh()
        first, inner, out = self.first, self.inner.__getitem__, []
        for text in marked:
            bag = {}
            for s in text.translate(MARKS).split("\n"):
                words = s.split()
                if words:
                    bag[(first[words[0]], *map(inner, words[1:]))] = None
            out.append(list(bag))
        return out


@dataclass
class Model:
    terms: list[tuple[str, str]]
    words: dict[str, int]  # word -> 1..; 0 is any other
    single: np.ndarray  # words x categories
    pairs: np.ndarray  # sorted keys
    paired: np.ndarray  # pairs x categories
    bias: np.ndarray

    def sentence_scores(self, bags: list[dict[tuple[str, ...], int]]) -> tuple[np.ndarray, np.ndarray]:
        """Sentences x categories, and the number of sentences per document."""
        numbered = [[tuple(map(self.words.get, s, repeat(0))) for s in bag] for bag in bags]
        return self.score(numbered, None)

    def score(self, bags: list[list[tuple[int, ...]]], vocabulary: list[int] | None) -> tuple[np.ndarray, np.ndarray]:
        """The same for sentences of word numbers; ``vocabulary`` maps them to words of the model."""
        per_doc = np.fromiter(map(len, bags), np.int64, len(bags))
        sentences = [s for bag in bags for s in bag]
        size = np.fromiter(map(len, sentences), np.int64, len(sentences))
        n = int(size.sum())
        ids = np.fromiter(chain.from_iterable(sentences), np.int64, n)
        if vocabulary is not None:
            ids = np.asarray(vocabulary, np.int64)[ids] if n else ids
        owner = np.repeat(np.arange(len(sentences)), size)
        z = np.tile(self.bias, (len(sentences), 1))
        known = np.flatnonzero(ids)
        # a word counts once per sentence
        key = np.unique(owner[known] * (len(self.single) + 1) + ids[known])
        np.add.at(z, key // (len(self.single) + 1), self.single[key % (len(self.single) + 1)])
        if n > 1 and len(self.pairs):
            a = np.flatnonzero((ids[1:] > 0) & (ids[:-1] > 0) & (owner[1:] == owner[:-1]))
            code = ids[a] * len(self.single) + ids[a + 1]
            at = np.minimum(np.searchsorted(self.pairs, code), len(self.pairs) - 1)
            ok = self.pairs[at] == code
            key = np.unique(owner[a[ok]] * len(self.pairs) + at[ok])
            np.add.at(z, key // len(self.pairs), self.paired[key % len(self.pairs)])
        return 1 / (1 + np.exp(-np.clip(z, -30, 30))), per_doc


def _features(sentence: tuple[str, ...]) -> set:
    return {*sentence, *zip(sentence, sentence[1:])}


def fit(bags: list[dict[tuple[str, ...], int]], labels: np.ndarray, terms: list[tuple[str, str]], rounds: int = 160, l2: float = 0.12) -> Model:
    """Weights from bags of sentences; ``labels`` is documents x categories of 1, 0, nan (unknown)."""
    k = len(CATEGORIES)
    count: Counter = Counter()
    good = [Counter() for _ in range(k)]
    beside: Counter = Counter()
    positive, negative = np.nansum(labels == 1, axis=0), np.nansum(labels == 0, axis=0)
    for bag, y in zip(bags, labels):
        seen = set()
        for s in bag:
            f = _features(s)
            seen |= f
            if any(w.startswith("zz") and w != "zzname" for w in s):
                beside.update(f)
        count.update(seen)
        for j in range(k):
            if y[j] == 1:
                good[j].update(seen)
    # kept: what stands beside terms, and what positive documents have more often than others
    rate = [(good[j], (positive[j] + 1) / (len(bags) + 2)) for j in range(k)]
    leaning = {f: max((g[f] + 0.2) / (n + 1) / r for g, r in rate) for f, n in count.items() if n >= MIN_DOCS}
    chosen = [f for f, x in leaning.items() if (x >= 3 and max(g[f] for g in good) >= MIN_DOCS) or beside[f] > MIN_DOCS]
    chosen = sorted(chosen, key=lambda f: (-leaning[f] * np.log1p(count[f]), str(f)))[:FEATURES]
    fixed = [f"zz{how}{c}" for c in CATEGORIES for how in ("term", "quoted")]
    chosen = list(dict.fromkeys([*fixed, *chosen]))
    place = {f: i for i, f in enumerate(chosen)}
    rows, cols, doc, n = [], [], [], 0
    for d, bag in enumerate(bags):
        for s in bag:
            f = [place[x] for x in _features(s) if x in place]
            if f:
                rows += [n] * len(f)
                cols += f
                doc.append(d)
                n += 1
    prior = np.zeros((len(chosen), k))
    for j, c in enumerate(CATEGORIES):
        prior[place[f"zzterm{c}"]] = OTHER_WEIGHT
        prior[place[f"zzterm{c}"], j] = TERM_WEIGHT
    w, b = prior.copy(), np.full(k, BIAS)
    if n and len(bags):
        rows, cols, doc = np.array(rows), np.array(cols), np.array(doc)
        starts = np.searchsorted(rows, np.arange(n))
        known = ~np.isnan(labels)
        y = np.where(known, np.clip(np.nan_to_num(labels), 0.03, 0.97), 0)  # some ratings are wrong
        weight = np.where(labels == 1, np.clip(negative / np.maximum(positive, 1), 1, 8), 1.0) * known
        # rated with another category: probably, but not surely, without this one
        other = ~known & (labels == 1).any(axis=1)[:, None]
        y, weight = np.where(other, 0.03, y), np.where(other, OTHER_RATED, weight)
        unrated = ~known.any(axis=1)[:, None]
        y, weight = np.where(unrated, 0.03, y), np.where(unrated, UNRATED, weight)
        m1, m2 = np.zeros_like(w), np.zeros_like(w)
        order = np.argsort(cols, kind="stable")
        sorted_cols, spread = cols[order], rows[order]
        heads = np.searchsorted(sorted_cols, np.arange(len(chosen)))
        empty = np.bincount(cols, minlength=len(chosen)) == 0
        heads = np.minimum(heads, len(cols) - 1)
        for step in range(1, rounds + 1):
            p = 1 / (1 + np.exp(-np.clip(np.add.reduceat(w[cols], starts, axis=0) + b, -30, 30)))
            log_none = np.zeros((len(bags), k))
            np.add.at(log_none, doc, np.log1p(-np.minimum(p, 1 - 1e-9)))
            bag_p = np.clip(1 - np.exp(log_none), 1e-6, 1 - 1e-6)
            # d loss / d z of a sentence through the noisy-or
            g = ((bag_p - y) / bag_p * weight)[doc] * p
            grad = np.add.reduceat(g[spread], heads, axis=0)
            grad[empty] = 0
            grad += l2 * len(bags) ** 0.5 * (w - prior)
            m1 = 0.9 * m1 + 0.1 * grad
            m2 = 0.999 * m2 + 0.001 * grad**2
            w -= 0.1 * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)
    words: dict[str, int] = {}
    for f in chosen:
        for x in (f,) if isinstance(f, str) else f:
            words.setdefault(x, len(words) + 1)
    single = np.zeros((len(words) + 1, k))
    pair_keys, pair_w = [], []
    for f, x in zip(chosen, w):
        if isinstance(f, str):
            single[words[f]] = x
        else:
            pair_keys.append(words[f[0]] * len(single) + words[f[1]])
            pair_w.append(x)
    order = np.argsort(pair_keys, kind="stable")
    return Model(terms, words, single, np.array(pair_keys, np.int64)[order], np.array(pair_w).reshape(-1, k)[order], b)


def train(docs: DataFrame, ratings: DataFrame, term_table: DataFrame, most: int = TRAIN_DOCS) -> Model:
    """Fits on at most ``most`` rated documents and as many unrated ones, none
    longer than TRAIN_CHARS.

    Ratings count in any letter case; null and unknown ones are ignored. A
    document is positive for a category if at least as many ratings name it as
    say none; it is negative if all say none; else nothing is known for it.
    """
    rows = term_table.where("term is not null and category is not null").select("term", F.lower(F.trim("category")).alias("category")).distinct().limit(MAX_TERMS + 1).collect()
    if len(rows) > MAX_TERMS:
        raise ValueError("too many terms")
    terms = sorted((r.term, r.category) for r in rows if r.category in CATEGORIES)
    counts = [F.count_if(F.col("c") == x).alias(x) for x in ("none", *CATEGORIES)]
    rated = ratings.select("doc_id", F.lower(F.trim("category")).alias("c")).where(F.col("c").isin("none", *CATEGORIES)).groupBy("doc_id").agg(*counts)
    rated = rated.orderBy(F.xxhash64("doc_id")).limit(most)
    fit_for = F.col("text").isNotNull() & (F.length("text") <= TRAIN_CHARS)
    chosen = docs.where(fit_for).select("doc_id", "text").join(rated, "doc_id").dropDuplicates(["doc_id"]).orderBy("doc_id").collect()
    matcher = Terms(terms)
    bags = [sentences_of(matcher.mark(r.text)) for r in chosen]
    # a hash range of about the wanted size; the hash makes it the same on every run
    key = F.pmod(F.xxhash64(F.lit("unrated"), "doc_id"), F.lit(1 << 20))
    share = min(1.0, 1.5 * most / max(1, docs.count()))
    others = docs.where((key < int(share * (1 << 20))) & fit_for).join(rated.select("doc_id"), "doc_id", "left_anti").orderBy(key, "doc_id").limit(most).select("text").collect()
    marked = [matcher.mark(r.text) for r in others]
    bags += [sentences_of(m) for m in marked if "zzterm" not in m and "zzquoted" not in m]
    labels = np.full((len(bags), len(CATEGORIES)), np.nan)
    for i, r in enumerate(chosen):
        for j, c in enumerate(CATEGORIES):
            if r[c] and r[c] >= r["none"]:
                labels[i, j] = 1
            elif r["none"] and not any(r[x] for x in CATEGORIES):
                labels[i, j] = 0
    return fit(bags, labels, terms)


def score_documents(df: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """The ``keep`` columns, a score per category, and per category the worst
    sentence (its number, counted from 0 over sentences with words) or null if
    no sentence reaches 0.5. Null and empty texts score 0. Row-local, no shuffle.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        matcher, reader = Terms(model.terms), Reader(model.words)
        for batch in batches:
            for a in range(0, batch.num_rows, 500):  # bounded work arrays
                part = batch.slice(a, 500)
                texts = part.column(part.num_columns - 1).to_pylist()
                marked = [matcher.mark(t) if t else "" for t in texts]
                p, per_doc = model.score(reader.read(marked), reader.vocabulary)
                total = np.zeros((len(texts), len(CATEGORIES)))
                owner = np.repeat(np.arange(len(texts)), per_doc)
                # the bias alone says nothing against a text, however long
                base = 1 / (1 + np.exp(-model.bias))
                np.add.at(total, owner, np.log1p(-np.minimum(np.maximum(p - base, 0), 1 - 1e-9)))
                score = 1 - np.exp(total)
                worst = np.full((len(texts), len(CATEGORIES)), -1)
                first = np.concatenate([[0], np.cumsum(per_doc)])
                for i in np.flatnonzero((score >= THRESHOLD).any(axis=1)).tolist():
                    s = p[first[i] : first[i + 1]]
                    number = np.array(list(sentences_of(marked[i]).values()))
                    worst[i] = np.where(s.max(axis=0) >= 0.5, number[s.argmax(axis=0)], -1)
                columns = [pa.array(score[:, j]) for j in range(len(CATEGORIES))]
                columns += [pa.array(worst[:, j].astype(np.int32), mask=worst[:, j] < 0) for j in range(len(CATEGORIES))]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *columns], names=[*keep, *CATEGORIES, *[f"{c}_sentence" for c in CATEGORIES]])

    fields = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)
    fields += ", " + ", ".join(f"{c} double" for c in CATEGORIES) + ", " + ", ".join(f"{c}_sentence int" for c in CATEGORIES)
    return df.select(*[F.col(c) for c in keep], F.col(text_col).alias("_text")).mapInArrow(run, fields)


def offending(scored: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id") -> DataFrame:
    """(id, category) for every score at or above the threshold, each once."""
    hits = F.array_compact(F.array(*[F.when(F.col(c) >= threshold, F.lit(c)) for c in CATEGORIES]))
    return scored.select(id_col, F.explode(hits).alias("category")).distinct()


def rates(scored: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Documents and share of offending ones per source (null is a source of its own)."""
    return scored.groupBy("source").agg(F.count("*").alias("docs"), *[F.avg((F.col(c) >= threshold).cast("double")).alias(f"{c}_rate") for c in CATEGORIES])
