"""Repetition scores of character and word n-grams, row by row.

Grams are hashed and sorted inside the row; run lengths of equal neighbours are
the counts. Nothing is exploded or shuffled.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _let(value: Column, body) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def _counts(grams: Column) -> Column:
    """Occurrences of each different element of an array of hashes."""

    def runs(a: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(a) - 1), lambda i: (i == 0) | (F.get(a, i) != F.get(a, i - 1)))
        return _let(starts, lambda s: F.transform(s, lambda x, k: F.coalesce(F.get(s, k + 1), F.size(a)) - x))

    return _let(F.sort_array(grams), runs)


def _hashes(parts: Column, n: int) -> Column:
    """Hashes of the n-grams; every element is hashed once."""
    grams = lambda h: F.transform(F.sequence(F.lit(0), F.size(h) - n), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(n)]))
    return _let(F.transform(parts, lambda w: F.xxhash64(w)), grams)


def _char_scores(texts: pd.Series, n: int) -> pd.Series:
    """Scores of a batch: rolling hashes over the code points of all its texts."""
    some = [t if isinstance(t, str) else "" for t in texts]
    out = np.full(len(some), np.nan)
    a = 0
    while a < len(some):
        b, size = a, 0
        while b < len(some) and (b == a or size + len(some[b]) < 1 << 20):
            size += len(some[b])
            b += 1
        code = np.frombuffer("".join(some[a:b]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        length = np.fromiter(map(len, some[a:b]), np.int64, b - a)
        if len(code) >= n:
            with np.errstate(over="ignore"):
                mixed = (code + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
                mixed ^= mixed >> np.uint64(29)
                h = np.zeros(len(code) - n + 1, np.uint64)
                for k in range(n):
                    h = (h + mixed[k : len(h) + k]) * np.uint64(0xBF58476D1CE4E5B9)
                    h ^= h >> np.uint64(32)
            ends = np.cumsum(length)
            for i, (end, m) in enumerate(zip(ends.tolist(), length.tolist())):
                if m >= n:
                    x = np.sort(h[end - m : end - n + 1])
                    counts = np.diff(np.append(np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])), len(x)))
                    out[a + i] = np.sort(counts)[::-1][: int(len(counts) ** 0.5)].sum() / len(x)
        a = b
    return pd.Series(out).astype(object).where(~np.isnan(out), None)


def char_repetition(text: Column, n: int) -> Column:
    """Share of the most frequent grams, as many as the root of the different
    ones; null if the text is shorter than n.

    An Arrow function: a rolling hash over a batch takes a tenth of the time that
    arrays of single characters take, which is what built-in functions offer.
    """

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return _char_scores(texts, n)

    return score.asNondeterministic()(text)  # else a filter above would call it again


def tokenize(text: Column) -> Column:
    """Words and single marks; numbers with , . : / between digits stay whole.

    Line feeds do not divide words.
    """
    marks = r"([!-/:-@\[-`{-~।॥꫰-꫱꯫-꯯᱾-᱿])"
    padded = F.regexp_replace(F.regexp_replace(text, "\t", " "), marks, " $1 ")
    single = F.regexp_replace(F.regexp_replace(padded, " +", " "), r"\A +| +\z", "")
    return F.split(F.regexp_replace(single, r"(?<=[0-9]) ([,.:/]) (?=[0-9])", "$1"), " ", -1)


def word_repetition(text: Column, n: int) -> Column:
    """Share of word n-grams that occur more than once; null if there are none or none repeats."""
    words = tokenize(text)

    def score(counts: Column) -> Column:
        add = lambda a: F.aggregate(a, F.lit(0), lambda x, y: x + y)
        return F.nullif(add(F.filter(counts, lambda c: c >= 2)) / add(counts), F.lit(0.0))

    return _let(words, lambda w: F.when(F.size(w) >= n, _let(_counts(_hashes(w, n)), score)))


def char_column(n: int | str) -> str:
    return f"{n}_gram_characters_repetition_score"


def word_column(n: int | str) -> str:
    return f"{n}_gram_words_repetition_score"


def exceeds(scores: dict[str, Column], thresholds: dict) -> Column:
    """Whether any score reaches its n's threshold; null and zero scores do not."""
    out = F.lit(False)
    for n, limit in thresholds.items():
        s = scores[str(n)]
        out = out | F.coalesce((s != 0) & (s >= F.lit(float(limit))), F.lit(False))
    return out


def exceeds_in_map(scores: Column, thresholds: dict) -> Column:
    """The same for a map of column name -> score."""
    limits = F.create_map(*[F.lit(x) for n, t in thresholds.items() for x in (str(n), float(t))])
    hit = lambda e: (e["value"] != 0) & (e["value"] >= F.try_element_at(limits, F.split(e["key"], "_")[0]))
    return F.coalesce(F.exists(F.map_entries(scores), lambda e: F.coalesce(hit(e), F.lit(False))), F.lit(False))
