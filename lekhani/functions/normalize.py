"""Unicode normalisation: rules of the Indic scripts, then NFKC.

The rules are replacements by built-in functions. NFKC has no built-in function;
an Arrow function does it, and passes texts of ASCII characters on as they are.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# The script whose rules hold for a language; languages without rules.
RULES_OF = {
    "assamese": "bengali",
    "bengali": "bengali",
    "bodo": "devanagari",
    "dogri": "devanagari",
    "gujarati": "gujarati",
    "hindi": "devanagari",
    "kannada": "kannada",
    "kashmiri": "arabic",
    "konkani": "devanagari",
    "maithili": "devanagari",
    "malayalam": "malayalam",
    "marathi": "devanagari",
    "nepali": "devanagari",
    "oriya": "oriya",
    "punjabi": "gurmukhi",
    "sanskrit": "devanagari",
    "sindhi": "arabic",
    "tamil": "tamil",
    "telugu": "telugu",
    "urdu": "arabic",
}
PLAIN = ("english", "manipuri", "santhali", "other")

# What every script's rules drop or replace (marks of byte order,
# joiners and soft hyphens go; quotation marks, dashes and dots become ASCII ones).
DROPPED = ("\ufeff", "\ufffe", "\u2060", "\u00ad", "\u200c", "\u200d")
COMMON = (("\u200b", " "), ("\u00a0", " "), ("[\u2018\u2019\u201a\u201b]", "'"), ("[\u201c\u201d\u201e\u201f]", '"'), ("[\u2010-\u2015]", "-"), ("\u2026", "..."))

# Fixed values per script: its block, the code points of composed letters that
# become letter and nukta, parts of a vowel that become one sign, visarga.
SCRIPTS = {
    "devanagari": ("\u0900-\u097f", (("\u0929", "\u0928\u093c"), ("\u0931", "\u0930\u093c"), ("\u0934", "\u0933\u093c"), ("\u0958", "\u0915\u093c"), ("\u0959", "\u0916\u093c"), ("\u095a", "\u0917\u093c"), ("\u095b", "\u091c\u093c"), ("\u095c", "\u0921\u093c"), ("\u095d", "\u0922\u093c"), ("\u095e", "\u092b\u093c"), ("\u095f", "\u092f\u093c")), (), "\u0903"),
    "bengali": ("\u0980-\u09ff", (("\u09dc", "\u09a1\u09bc"), ("\u09dd", "\u09a2\u09bc"), ("\u09df", "\u09af\u09bc")), (("\u09c7\u09be", "\u09cb"), ("\u09c7\u09d7", "\u09cc")), "\u0983"),
    "gurmukhi": ("\u0a00-\u0a7f", (("\u0a33", "\u0a32\u0a3c"), ("\u0a36", "\u0a38\u0a3c"), ("\u0a59", "\u0a16\u0a3c"), ("\u0a5a", "\u0a17\u0a3c"), ("\u0a5b", "\u0a1c\u0a3c"), ("\u0a5e", "\u0a2b\u0a3c")), (), "\u0a03"),
    "gujarati": ("\u0a80-\u0aff", (), (), "\u0a83"),
    "oriya": ("\u0b00-\u0b7f", (("\u0b5c", "\u0b21\u0b3c"), ("\u0b5d", "\u0b22\u0b3c")), (("\u0b47\u0b56", "\u0b48"), ("\u0b47\u0b3e", "\u0b4b"), ("\u0b47\u0b57", "\u0b4c")), "\u0b03"),
    "tamil": ("\u0b80-\u0bff", (), (("\u0b92\u0bd7", "\u0b94"), ("\u0bc6\u0bbe", "\u0bca"), ("\u0bc7\u0bbe", "\u0bcb"), ("\u0bc6\u0bd7", "\u0bcc")), "\u0b83"),
    "telugu": ("\u0c00-\u0c7f", (), (("\u0c46\u0c56", "\u0c48"),), "\u0c03"),
    "kannada": ("\u0c80-\u0cff", (), (("\u0cbf\u0cd5", "\u0cc0"), ("\u0cc6\u0cd5", "\u0cc7"), ("\u0cc6\u0cd6", "\u0cc8"), ("\u0cc6\u0cc2", "\u0cca"), ("\u0cca\u0cd5", "\u0ccb")), "\u0c83"),
    "malayalam": ("\u0d00-\u0d7f", (("\u0d7a", "\u0d23\u0d4d"), ("\u0d7b", "\u0d28\u0d4d"), ("\u0d7c", "\u0d30\u0d4d"), ("\u0d7d", "\u0d32\u0d4d"), ("\u0d7e", "\u0d33\u0d4d"), ("\u0d7f", "\u0d15\u0d4d")), (("\u0d46\u0d3e", "\u0d4a"), ("\u0d47\u0d3e", "\u0d4b"), ("\u0d46\u0d57", "\u0d4c")), "\u0d03"),
}
DANDA, DOUBLE_DANDA = "\u0964", "\u0965"


def steps(script: str) -> list[tuple[str, str]]:
    """(pattern, replacement) in order; the patterns are those of RE2 too."""
    out = [("[" + "".join(DROPPED) + "]", ""), *COMMON]
    if script in SCRIPTS:
        block, composed, vowels, visarga = SCRIPTS[script]
        out += [*composed, *vowels]
        if script in ("devanagari", "bengali", "gurmukhi", "gujarati", "oriya"):
            out += [(r"\|\|", DOUBLE_DANDA), (r"\|", DANDA)]
        out.append((f"([{block}]):", rf"$1{visarga}"))
    return out


def apply_rules(text: Column, language: Column) -> Column:
    """The rules of each row's language; other languages keep their text."""
    out = F.when(F.lit(False), text)
    for script in sorted(set(RULES_OF.values())):
        new = text
        for pattern, replacement in steps(script):
            new = F.regexp_replace(new, pattern, replacement)
        out = out.when(language.isin([k for k, v in RULES_OF.items() if v == script]), new)
    return out.otherwise(text)


def _nfkc(t: str | None) -> str | None:
    return t if t is None or t.isascii() or unicodedata.is_normalized("NFKC", t) else unicodedata.normalize("NFKC", t)


def nfkc(text: Column) -> Column:
    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(_nfkc)

    return run.asNondeterministic()(text)  # else a filter above would call it again


def nfkc_all(texts: Column) -> Column:
    @F.pandas_udf("array<string>")
    def run(rows: pd.Series) -> pd.Series:
        return rows.map(lambda a: a if a is None else [_nfkc(t) for t in a])

    return run.asNondeterministic()(texts)


def normalize(text: Column, language: Column, rules: dict[str, Callable[[Column], Column]] | None = None) -> Column:
    """NFKC after the rules of the language's script. Null stays null.

    ``rules`` (language -> column function) replace the built-in ones.
    """
    return nfkc(_ruled(text, language, rules))


def normalize_all(texts: Column, language: Column, rules: dict[str, Callable[[Column], Column]] | None = None) -> Column:
    """The same for an array of texts of one language."""
    return nfkc_all(F.transform(texts, lambda t: _ruled(t, language, rules)))


def _ruled(text: Column, language: Column, rules: dict | None) -> Column:
    out = apply_rules(text, language)
    for name, rule in (rules or {}).items():
        out = F.when(language == name, rule(text)).otherwise(out)
    return out
