"""Keyword hits: whole words in any case, longest first, from left to right."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lekhani.functions.ngrams import _let

#: Characters that belong to a word for the border test.
WORD = "0-9A-Za-z_"


def pattern(terms: list[str]) -> str | None:
    """Regular expression of a list; null for an empty one. Blank terms are ignored."""
    kept = sorted({t.strip().lower() for t in terms if t and t.strip()}, key=lambda t: (-len(t), t))
    if not kept:
        return None
    quoted = "|".join(re.sub(r"([\\.\[\]{}()*+?^$|\-])", r"\\\1", t) for t in kept)
    return f"(?i)(?<![{WORD}])(?:{quoted})(?![{WORD}])"


def hits(text: Column, terms: list[str]) -> Column:
    """Array of hits in order, in lower case."""
    p = pattern(terms)
    if p is None:
        return F.when(text.isNotNull(), F.array().cast("array<string>"))
    return F.transform(F.regexp_extract_all(text, F.lit(p), F.lit(0)), F.lower)


def spans(text: Column, regex: str) -> Column:
    """Array of struct(hit, start, end) in code points, of every match in order.

    The text is matched twice, for the hits and for what stands between them;
    places are running sums of their lengths.
    """
    found, gaps = F.regexp_extract_all(text, F.lit(regex), F.lit(0)), F.split(text, regex, -1)
    kind = "array<struct<hit:string,start:int,end:int>>"

    def placed(hits: Column) -> Column:
        pairs = F.zip_with(hits, F.slice(gaps, 1, F.size(hits)), lambda h, g: F.struct(h.alias("hit"), F.length(h).alias("n"), F.length(g).alias("gap")))
        start = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))

        def step(a: Column, p: Column) -> Column:
            begin = (a["at"] + p["gap"]).cast("int")
            end = (begin + p["n"]).cast("int")
            return F.struct(end.alias("at"), F.concat(a["out"], F.array(F.struct(p["hit"].alias("hit"), begin.alias("start"), end.alias("end")))).cast(kind).alias("out"))

        return F.when(F.size(hits) == 0, F.array().cast(kind)).otherwise(F.aggregate(pairs, start, step, lambda a: a["out"]))

    return _let(found, placed)


def hit_positions(text: Column, terms: list[str]) -> Column:
    """Array of struct(term, start, end) in code points."""
    return F.transform(spans(text, pattern(terms) or r"(?!)"), lambda x: F.struct(F.lower(x["hit"]).alias("term"), x["start"].alias("start"), x["end"].alias("end")))


def distribution(text: Column, terms: list[str]) -> Column:
    """map(term -> count)."""
    count = lambda found: F.map_from_entries(F.transform(F.array_distinct(found), lambda k: F.struct(k, F.size(F.filter(found, lambda x: x == k)))))
    return _let(hits(text, terms), count)


def total(counts: Column) -> Column:
    """Sum of a map's values; null for a null map."""
    return F.aggregate(F.map_values(counts), F.lit(0), lambda a, x: a + x)


def by_language(text: Column, language: Column, lists: dict[str, list[str]], build) -> Column:
    """``build(text, terms)`` with the list of each row's language (empty if it has none)."""
    out = build(text, [])
    for name, terms in sorted(lists.items()):
        out = F.when(language == name, build(text, terms)).otherwise(out)
    return out


def read_lists(spark: SparkSession, glob: str) -> dict[str, list[str]]:
    """Lists from text files, a term a line, named by language. Lists are configuration and small."""
    rows = spark.read.text(glob).select(F.regexp_extract(F.input_file_name(), r"([^/]+?)(?:\.[^./]*)?$", 1).alias("language"), F.trim("value").alias("term")).collect()
    out: dict[str, list[str]] = {}
    for r in rows:
        out.setdefault(r.language, []).append(r.term)
    return out


def lists_from_table(df: DataFrame, term: str = "term", language: str = "language", most: int = 20_000) -> dict[str, list[str]]:
    """Lists from a table of at most ``most`` terms."""
    rows = df.select(F.col(language).alias("language"), F.col(term).alias("term")).where("language is not null and term is not null").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError("too many terms")
    out: dict[str, list[str]] = {}
    for r in rows:
        out.setdefault(r.language, []).append(r.term)
    return out
