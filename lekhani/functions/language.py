"""Language identification: script routing, detectors, cascade, majority vote.

The three built-in detectors are column expressions and need no model:
``routed`` (script, then letters and words that tell a script's languages
apart; romanised text through a cascade of two steps), ``words`` (function words
of each language) and ``script`` (the script most letters are in). Detectors in
Python plug in beside them.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lekhani.functions import text as T
from lekhani.functions.ngrams import _let
from lekhani.operators.lines import computed_once

OTHER = "other"

# Code point blocks of the scripts, and the language a script stands for by itself.
SCRIPT_BLOCKS = (
    ("Latn", "english", ((0x41, 0x5A), (0x61, 0x7A), (0xC0, 0x24F))),
    ("Deva", "hindi", ((0x900, 0x97F),)),
    ("Beng", "bengali", ((0x980, 0x9FF),)),
    ("Guru", "punjabi", ((0xA00, 0xA7F),)),
    ("Gujr", "gujarati", ((0xA80, 0xAFF),)),
    ("Orya", "oriya", ((0xB00, 0xB7F),)),
    ("Taml", "tamil", ((0xB80, 0xBFF),)),
    ("Telu", "telugu", ((0xC00, 0xC7F),)),
    ("Knda", "kannada", ((0xC80, 0xCFF),)),
    ("Mlym", "malayalam", ((0xD00, 0xD7F),)),
    ("Arab", "urdu", ((0x600, 0x6FF), (0x750, 0x77F))),
    ("Mtei", "manipuri", ((0xABC0, 0xABFF),)),
    ("Olck", "santhali", ((0x1C50, 0x1C7F),)),
)

# Frequent function words; romanised ones of Hindi apart.
FUNCTION_WORDS = {
    "english": ("the", "of", "and", "to", "in", "is", "was", "for", "that", "with", "this", "are"),
    "hindi": ("का", "की", "के", "में", "से", "को", "और", "है", "नहीं", "यह", "भी", "लिए"),
    "marathi": ("आहे", "आणि", "चा", "ची", "चे", "मध्ये", "साठी", "हा", "ती", "पण", "त्या", "नाही"),
    "bengali": ("এর", "এবং", "একটি", "এই", "থেকে", "জন্য", "না", "কিন্তু", "হয়েছে", "করে"),
    "assamese": ("আৰু", "এটা", "পৰা", "বাবে", "লগত", "হৈ", "নহয়", "ওপৰত", "মাজত", "সেই"),
    "punjabi": ("ਦਾ", "ਦੀ", "ਦੇ", "ਵਿੱਚ", "ਤੋਂ", "ਨੂੰ", "ਅਤੇ", "ਹੈ", "ਨਹੀਂ", "ਇਹ"),
    "gujarati": ("અને", "છે", "નો", "ની", "ના", "માં", "થી", "ને", "આ", "તે"),
    "tamil": ("மற்றும்", "ஒரு", "இந்த", "அந்த", "என்று", "இல்லை", "ஆனால்", "உள்ள"),
    "telugu": ("మరియు", "ఒక", "ఈ", "ఆ", "అని", "లేదు", "కోసం", "ఉన్న"),
    "kannada": ("ಮತ್ತು", "ಒಂದು", "ಈ", "ಆ", "ಎಂದು", "ಇಲ್ಲ", "ಆದರೆ", "ಇರುವ"),
    "urdu": ("اور", "کا", "کی", "کے", "میں", "سے", "کو", "ہے", "نہیں", "یہ"),
}
ROMAN_WORDS = ("hai", "hain", "ka", "ki", "ke", "mein", "se", "ko", "aur", "nahin", "yeh", "woh", "bhi", "tha", "liye", "saath")
# Letters only Assamese has in the Bengali script; letter pairs usual in romanised Hindi and in English.
ASSAMESE_LETTERS = "ৰৱ"
ROMAN_PAIRS, ENGLISH_PAIRS = ("aa", "ee", "kh", "gh", "bh", "dh", "jh", "iy"), ("th", "in", "er", "ed", "ou", "on", "ea", "ly")
#: What stands between words.
BETWEEN = "[ \\n\\r\\t.,;:!?()\"।॥۔؟]+"
#: Share of a text in ASCII letters and digits from which it is romanised, and the
#: score that the first step of the cascade has to reach.
ROMAN_SHARE, ROMAN_SCORE = 0.5, 0.6


class Detector(Protocol):
    """Names a text's language with a probability; ``load`` runs once a worker."""

    name: str

    def load(self) -> None: ...

    def predict(self, texts: list[str]) -> list[tuple[str, float]]: ...


class ColumnDetector:
    """A detector that is a column: ``said(text)`` is a struct of lang and probability."""

    name = ""

    def said(self, text: Column) -> Column:
        raise NotImplementedError


def is_roman(text: Column, threshold: float = ROMAN_SHARE) -> Column:
    """Route of a text: more than ``threshold`` of it ASCII letters and digits."""
    return T.roman_share(text) > threshold


def hard_vote(first: Column, second: Column, third: Column) -> Column:
    """Majority of three; without one the first (the order is that of trust)."""
    return F.when((second == third) & ((first != second) | first.isNull()), second).otherwise(first)


def iso_code(language: Column, codes: dict[str, str | None]) -> Column:
    """Code of a language; null if unknown."""
    known = {k: v for k, v in codes.items() if v is not None}
    if not known:
        return F.lit(None).cast("string")
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in sorted(known.items()) for x in kv]), language)


def block_class(ranges: tuple[tuple[int, int], ...]) -> str:
    return "[" + "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in ranges) + "]"


def _first_most(counts: list[tuple[str, Column]]) -> Column:
    """struct(lang, n, total): the first of the labels with the most; ``other`` if all are 0."""
    struct = F.struct(*[n.alias(f"c{i}") for i, (_, n) in enumerate(counts)])

    def pick(c: Column) -> Column:
        cells = [c[f"c{i}"] for i in range(len(counts))]
        most = F.greatest(*cells) if len(cells) > 1 else cells[0]
        lang = F.when(most == 0, OTHER)
        for (name, _), n in zip(counts, cells):
            lang = lang.when(n == most, name)
        return F.struct(lang.alias("lang"), most.alias("n"), sum(cells[1:], cells[0]).alias("total"))

    return _let(struct, pick)


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(T.ratio(part, whole), F.lit(0.0))


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), BETWEEN), lambda w: w != "")


def _hits(words: Column, wanted: tuple[str, ...]) -> Column:
    return F.size(F.filter(words, lambda w: w.isin(*wanted)))


def script_of(text: Column) -> Column:
    """struct(lang, n, total) with a script's four-letter code as lang."""
    return _first_most([(code, F.regexp_count(text, F.lit(block_class(ranges)))) for code, _, ranges in SCRIPT_BLOCKS])


class ScriptDetector(ColumnDetector):
    """Language by the script most letters are in."""

    name = "script"

    def said(self, text: Column) -> Column:
        langs = {code: lang for code, lang, _ in SCRIPT_BLOCKS}
        named = F.create_map(*[F.lit(x) for kv in langs.items() for x in kv])
        return _let(script_of(text), lambda s: F.struct(F.coalesce(F.try_element_at(named, s["lang"]), F.lit(OTHER)).alias("lang"), _share(s["n"], s["total"]).cast("float").alias("probability")))


class WordDetector(ColumnDetector):
    """Language with the most function words; ``other`` without any."""

    name = "words"

    def said(self, text: Column) -> Column:
        def pick(words: Column) -> Column:
            best = _first_most([(lang, _hits(words, w + (ROMAN_WORDS if lang == "hindi" else ()))) for lang, w in FUNCTION_WORDS.items()])
            return _let(best, lambda b: F.struct(b["lang"].alias("lang"), _share(b["n"], F.size(words)).cast("float").alias("probability")))

        return _let(words_of(text), pick)


class RoutedDetector(ColumnDetector):
    """Native and romanised texts by ways of their own; also tells the script.

    Native: the script, then Marathi words against Hindi ones and letters only
    Assamese has. Romanised: Hindi words against English ones; where that scores
    no more than ROMAN_SCORE, usual letter pairs decide.
    """

    name = "routed"

    def said(self, text: Column) -> Column:
        def native(words: Column) -> Column:
            def named(s: Column) -> Column:
                marathi = _hits(words, FUNCTION_WORDS["marathi"]) > _hits(words, FUNCTION_WORDS["hindi"])
                assamese = F.regexp_count(text, F.lit(f"[{ASSAMESE_LETTERS}]")) > 0
                lang = F.when((s["lang"] == "Deva") & marathi, "marathi").when((s["lang"] == "Beng") & assamese, "assamese")
                for code, name, _ in SCRIPT_BLOCKS:
                    lang = lang.when(s["lang"] == code, name)
                return F.struct(lang.otherwise(OTHER).alias("lang"), _share(s["n"], s["total"]).cast("float").alias("probability"), s["lang"].alias("script"))

            return _let(script_of(text), named)

        def roman(words: Column) -> Column:
            counts = F.struct(_hits(words, ROMAN_WORDS).alias("h"), _hits(words, FUNCTION_WORDS["english"]).alias("e"))

            def step(c: Column) -> Column:
                score = _share(F.greatest(c["h"], c["e"]), c["h"] + c["e"])
                first = F.struct(F.when(c["h"] > c["e"], "hindi").otherwise("english").alias("lang"), score.cast("float").alias("probability"), F.lit("Latn").alias("script"))
                pairs = lambda p: F.regexp_count(F.lower(text), F.lit("|".join(p)))
                second = _let(F.struct(pairs(ROMAN_PAIRS).alias("h"), pairs(ENGLISH_PAIRS).alias("e")), lambda p: F.struct(F.when(p["h"] > p["e"], "hindi").otherwise("english").alias("lang"), _share(F.greatest(p["h"], p["e"]), p["h"] + p["e"]).cast("float").alias("probability"), F.lit("Latn").alias("script")))
                return F.when(score > ROMAN_SCORE, first).otherwise(second)

            return _let(counts, step)

        return _let(words_of(text), lambda w: F.when(is_roman(text), roman(w)).otherwise(native(w)))


def detect(df: DataFrame, detectors: list, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns, and ``<name>_lang``, ``<name>_probability`` of every detector.

    Line feeds count as blanks. Column detectors are expressions; the models of
    others load once a worker, their texts go in batches. Null texts have null
    results. ``routed`` adds ``routed_script``.
    """
    clean = F.regexp_replace(F.col(text_col), "\n", " ")
    # a later expression reads the text by this name, so that it is made once
    base = df.select(*keep, clean.alias("_text"))
    models = [d for d in detectors if not isinstance(d, ColumnDetector)]
    if models:

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for d in models:
                d.load()
            for f in frames:
                out = f.copy()
                has = f["_text"].notna()
                texts = f.loc[has, "_text"].tolist()
                for d in models:
                    said = d.predict(texts)
                    out[f"{d.name}_lang"] = pd.Series([x for x, _ in said], index=f.index[has], dtype="object").reindex(f.index)
                    out[f"{d.name}_probability"] = pd.Series([p for _, p in said], index=f.index[has], dtype="float32").reindex(f.index)
                yield out

        schema = ", ".join(f"`{c}` {base.schema[c].dataType.simpleString()}" for c in base.columns) + "".join(f", `{d.name}_lang` string, `{d.name}_probability` float" for d in models)
        base = base.mapInPandas(run, schema)
    own = [d for d in detectors if isinstance(d, ColumnDetector)]
    columns = [F.when(F.col("_text").isNotNull(), d.said(F.col("_text"))).alias(f"_{d.name}") for d in own]
    said = computed_once(base, [F.col(c) for c in base.columns], columns) if own else base
    columns = [F.col(c) for c in keep]
    for d in detectors:
        if d in own:
            columns += [F.col(f"_{d.name}")[x].alias(f"{d.name}_{x}") for x in ("lang", "probability", *(("script",) if isinstance(d, RoutedDetector) else ()))]
        else:
            columns += [F.col(f"{d.name}_lang"), F.col(f"{d.name}_probability")]
    return said.select(*columns)


def identify(df: DataFrame, detectors: list, codes: dict[str, str | None], keep: list[str], text_col: str = "text", null_drop: bool = False) -> DataFrame:
    """Detector columns, ``doc_lang`` by vote of three (in order of trust), ``doc_lang_iso``,
    ``lang_per_model`` (detector -> language) and ``out_per_model`` (detector -> probability).

    A language outside ``codes`` is ``other``, also as code. ``null_drop`` leaves
    out rows with a null among the kept columns, as a join on them would.
    """
    if len(detectors) != 3:
        raise ValueError("three detectors vote")
    found = detect(df.dropna(subset=keep) if null_drop else df, detectors, keep, text_col)
    lang = hard_vote(*[F.col(f"{d.name}_lang") for d in detectors])
    known = lang.isin(list(codes))
    found = found.withColumn("doc_lang", F.when(known, lang).when(lang.isNotNull(), OTHER))
    found = found.withColumn("doc_lang_iso", F.when(F.col("doc_lang").isin(list(codes)), iso_code(F.col("doc_lang"), codes)).when(F.col("doc_lang").isNotNull(), OTHER))
    per_model = lambda what: F.when(F.col("doc_lang").isNotNull(), F.create_map(*[x for d in detectors for x in (F.lit(f"{d.name}_{what}"), F.col(f"{d.name}_{what}"))]))
    return found.withColumns({"lang_per_model": per_model("lang"), "out_per_model": per_model("probability")})


def identify_one(spark, text: str, codes: dict[str, str | None], detectors: list | None = None) -> dict:
    """The same for one text, as a dictionary."""
    rows = identify(spark.createDataFrame([(text,)], "text string"), detectors or default_detectors(), codes, ["text"])
    return rows.first().asDict(recursive=True)


def default_detectors() -> list[ColumnDetector]:
    """Three detectors that need no models, in order of trust."""
    return [RoutedDetector(), WordDetector(), ScriptDetector()]
