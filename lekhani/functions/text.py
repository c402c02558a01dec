"""Scalar text functions as built-in column expressions."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Code point ranges of valid characters (ASCII letters and digits,
# Devanagari, Bengali, Gurmukhi, Gujarati, Telugu, Kannada, Malayalam, Meetei
# Mayek, Oriya, Ol Chiki, Tamil, Arabic and its supplements, numeral systems).
VALID_RANGES = (
    (0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A),
    (0x900, 0x97F), (0x980, 0x9FF), (0xA00, 0xA7F), (0xA80, 0xAFF), (0xB00, 0xB7F), (0xB80, 0xBFF),
    (0xC00, 0xC7F), (0xC80, 0xCFF), (0xD00, 0xD7F), (0x1C50, 0x1C7F), (0xABC0, 0xABFF),
    (0x600, 0x6FF), (0x750, 0x77F), (0x870, 0x89F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF),
    (0x10E60, 0x10E7F), (0x10EC0, 0x10EFF), (0x1EC70, 0x1ECBF), (0x1ED00, 0x1ED4F), (0x1EE00, 0x1EEFF),
)

# The same scripts without digits and sentence marks.
LETTER_RANGES = (
    (0x41, 0x5A), (0x61, 0x7A),
    (0x900, 0x963), (0x970, 0x97F), (0x980, 0x9E3), (0x9F0, 0x9FF), (0xA00, 0xA65), (0xA70, 0xA7F),
    (0xA80, 0xAE5), (0xAF0, 0xAFF), (0xB00, 0xB65), (0xB70, 0xB7F), (0xB80, 0xBE5), (0xBF0, 0xBFF),
    (0xC00, 0xC65), (0xC70, 0xC7F), (0xC80, 0xCE5), (0xCF0, 0xCFF), (0xD00, 0xD65), (0xD70, 0xD7F),
    (0x1C5A, 0x1C7F), (0xABC0, 0xABED),
    (0x600, 0x65F), (0x670, 0x6EF), (0x6FA, 0x6FF), (0x750, 0x77F), (0x870, 0x89F), (0x8A0, 0x8FF),
    (0xFB50, 0xFDFF), (0xFE70, 0xFEFF), (0x10EC0, 0x10EFF),
)

# Marks that may end a chunk, endings that never may, sentence delimiters.
TERMINALS = [".", "!", "?", "।", ":", ",", ";", ")", "\"", "'", "؟", "۔"]
BAD_ENDINGS = ("...", "####")
DELIMITERS = [".", "?", "!", "।", "|", "॥", "؟", "۔"]

# Scripts of Indic and Latin text.
SCRIPTS = ["Latin", "Devanagari", "Bengali", "Gujarati", "Gurmukhi", "Kannada", "Malayalam", "Oriya", "Tamil", "Telugu", "Meetei_Mayek", "Arabic", "Dogra", "Ol_Chiki"]


def _class(ranges) -> str:
    return "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in ranges)


def _any(chars) -> str:
    return "[" + "".join("\\" + c if ord(c) < 128 else c for c in chars) + "]"


VALID_CLASS, LETTER_CLASS = _class(VALID_RANGES), _class(LETTER_RANGES)
TERMINAL_CLASS, DELIMITER_CLASS = _any(TERMINALS), _any(DELIMITERS)
BAD_ENDING = "(" + "|".join("".join("\\" + c for c in e) for e in BAD_ENDINGS) + r")\z"
FOREIGN_CLASS = "[^" + "".join(rf"\p{{Is{s}}}" for s in SCRIPTS) + r"\p{IsPunctuation}\s\x1c-\x1f\x{85}\p{Z}]"


def ratio(a: Column, b: Column) -> Column:
    """a / b as double; null where b is 0 or either is null."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def word_count(text: Column) -> Column:
    """Pieces between single spaces; an empty text has one."""
    return F.size(F.split(text, " ", -1))


def char_count(text: Column) -> Column:
    """Code points."""
    return F.length(text)


def byte_count(text: Column) -> Column:
    """UTF-8 bytes."""
    return F.octet_length(text)


def is_number(text: Column) -> Column:
    """Decimal digits of any script only; false for the empty text."""
    return text.rlike(r"\A\p{Nd}+\z")


def symbol_count(text: Column) -> Column:
    """Characters outside the valid ranges other than space and line feed."""
    return F.regexp_count(text, F.lit(rf"[^{VALID_CLASS} \n]"))


def symbol_ratio(text: Column) -> Column:
    """Share of symbols; null for the empty text."""
    return ratio(symbol_count(text), F.length(text))


def is_number_or_marks(text: Column, threshold: float = 0.4) -> Column:
    """Numeric only, or at least ``threshold`` of it neither letter nor blank; false for the empty text."""
    share = ratio(F.regexp_count(text, F.lit(rf"[^{LETTER_CLASS} \n]")), F.length(text))
    return text.rlike(r"\A\p{N}+\z") | F.coalesce((share > 0) & (share >= threshold), F.lit(False))


def ends_properly(text: Column) -> Column:
    """Ends in a terminal mark, but not in an ellipsis of dots or a row of hashes."""
    return text.rlike(rf"{TERMINAL_CLASS}\z") & ~text.rlike(BAD_ENDING)


def cut_after_terminal(chunk: Column, min_words: float) -> Column:
    """The chunk up to its last terminal mark if that has more than ``min_words`` words.

    Properly ended chunks stay as they are; badly ended and too short ones are null.
    """
    head = F.regexp_extract(chunk, rf"(?s)\A(.*{TERMINAL_CLASS})", 1)
    return F.when(ends_properly(chunk), chunk).when(~chunk.rlike(BAD_ENDING) & (word_count(head) > min_words), head)


def keep_properly_ended(text: Column) -> Column:
    """struct(text, dropped): the properly ended lines, and how many were dropped."""
    lines = F.split(text, "\n", -1)
    kept = F.filter(lines, ends_properly)
    return F.struct(F.array_join(kept, "\n").alias("text"), (F.size(lines) - F.size(kept)).alias("dropped"))


def split_sentences(text: Column) -> Column:
    """Pieces that end with one delimiter and the line feeds after it; the rest,
    also an empty one, is the last piece."""
    # \\G: a match begins where the last one ended, so a long rest without marks is read once
    whole = F.regexp_extract_all(text, F.lit(rf"\G[^{DELIMITER_CLASS[1:-1]}]*+{DELIMITER_CLASS}\n*+"), F.lit(0))
    # bound once: the rest begins where the whole pieces end
    return F.element_at(F.transform(F.array(whole), lambda w: F.concat(w, F.array(F.substring(text, F.length(F.array_join(w, "")) + 1, F.length(text))))), 1)


# Short forms after which a full stop ends no sentence.
SHORT_FORMS = ("Mr", "Mrs", "Ms", "Dr", "Prof", "St", "Jr", "Sr", "vs", "etc", "No", "Fig", "Vol", "pp", "cf", "e.g", "i.e")


def split_at_terminal(text: Column, language: Column | None = None) -> Column:
    """Sentences, trimmed and without empty ones; the marks stay.

    Ends are . ? ! (not after initials, short forms or between digits), dandas
    and the full stop and question mark of Urdu, each with blanks after it;
    texts in ``urdu`` are not divided at dandas.
    """
    forms = "|".join(f.replace(".", r"\.") for f in SHORT_FORMS)
    ends = lambda extra: rf"(?<=[.?!؟۔{extra}][\"”’)]?)(?<!\b\p{{Lu}}\.)(?<!\b(?:{forms})\.)\s+"
    cut = lambda p: F.filter(F.transform(F.split(text, p, -1), lambda x: F.regexp_replace(x, r"\A\s+|\s+\z", "")), lambda x: x != "")
    general = cut(ends("।॥"))
    return general if language is None else F.when(language == "urdu", cut(ends(""))).otherwise(general)


def split_by(splitter, text: Column, language: Column) -> Column:
    """Sentences by a function of one's own: a column function (text, language) ->
    array, or a Python function (str, str) -> list of strings, which runs in Arrow batches."""
    if getattr(splitter, "takes_columns", False) or splitter is split_at_terminal:
        return splitter(text, language)

    @F.pandas_udf("array<string>")
    def run(texts: pd.Series, languages: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else splitter(t, lang) for t, lang in zip(texts, languages)], dtype="object")

    return run(text, language)


def foreign_char_count(text: Column) -> Column:
    """Characters of other scripts (or of no script) that are no punctuation or space."""
    return F.regexp_count(text, F.lit(FOREIGN_CLASS))


def roman_share(text: Column) -> Column:
    """ASCII letters and digits per character that is neither special nor blank.

    Line feeds are taken off twice, as white space and by themselves; 0 where
    nothing is left.
    """
    left = F.length(text) - F.regexp_count(text, F.lit(r"[@_!#$%^&*()<>?/|}{~:]")) - F.regexp_count(text, F.lit(r"(?U)[\s\x1c-\x1f]")) - F.regexp_count(text, F.lit("\n"))
    return F.coalesce(ratio(F.regexp_count(text, F.lit("[a-zA-Z0-9]")), left), F.lit(0.0))


def tokenizer_language_code(language: Column, code: Column) -> Column:
    """Language code as word tokenizers name it: urdu is ``ur`` there."""
    return F.when((language == "urdu") & (code == "urd"), F.lit("ur")).otherwise(code)


def all_of(conditions: list[Column]) -> Column:
    """Conjunction; true for no conditions."""
    return reduce(lambda a, b: a & b, conditions, F.lit(True))
