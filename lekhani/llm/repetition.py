"""Repetition inside single documents, as one projection of built-in functions.

A threshold table names statistics, comparisons and limits. It is compiled
into the columns of a single ``select``: statistics of length, symbols, stop
words, lines and repeats, then one boolean per rule. No user function, no
shuffle; the cost per document is n log n in its words (sorting of hashes).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space as Unicode has it, with the four separators U+001C-U+001F.
SPACE = r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: Punctuation and symbols, dropped at a word's ends.
MARK = r"[\p{P}\p{S}]"

# Frequent function words of the corpus languages.
STOP_WORDS = (
    "the a an of and to in is was for on with that by at from it this be are as were has had have not or but their "
    "का की के में से को और है नहीं पर यह वह जो तक भी तो लिए साथ बाद "
    "এর ও এবং একটি এই সেই থেকে জন্য উপর না কিন্তু আগে পরে "
    "மற்றும் ஒரு இந்த அந்த என்று தான் இல்லை ஆனால் உள்ள "
    "మరియు ఒక ఈ ఆ అని లేదు కానీ ఉన్న కోసం "
    "आणि आहे ही हे ते तो चा ची चे मध्ये साठी "
    "اور کا کی کے میں سے کو ہے نہیں پر یہ وہ جو تک بھی "
    "અને છે નો ની ના માં થી ને આ તે પર "
    "ಮತ್ತು ಒಂದು ಈ ಆ ಎಂದು ಇಲ್ಲ ಆದರೆ "
    "ਅਤੇ ਦਾ ਦੀ ਦੇ ਵਿੱਚ ਤੋਂ ਨੂੰ ਹੈ ਨਹੀਂ ਇਹ ਉਹ"
).split()


@dataclass(frozen=True)
class Rule:
    """``statistic op limit`` marks a document; ``op`` is one of < <= > >=."""

    name: str
    statistic: str
    op: str
    limit: float


#: Published heuristics for web text; the first is this project's own measure.
DEFAULT_RULES = (
    Rule("repeats_itself", "repeated_share", ">=", 0.30),
    Rule("too_short", "n_words", "<", 50),
    Rule("odd_word_length_low", "mean_word_chars", "<", 3),
    Rule("odd_word_length_high", "mean_word_chars", ">", 10),
    Rule("symbol_heavy", "symbol_share", ">", 0.10),
    Rule("few_stop_words", "stop_word_share", "<", 0.05),
    Rule("same_lines", "repeated_line_share", ">", 0.30),
    Rule("bullet_lines", "bullet_line_share", ">", 0.90),
    Rule("cut_lines", "ellipsis_line_share", ">", 0.30),
)


def words_of(text: Column) -> Column:
    """Lower-case words without marks at their ends; words of marks only vanish."""
    # each run of marks is looked at once: it is never given back and never begun inside
    bare = F.regexp_replace(F.lower(text), rf"(?<!{SPACE[:-1].replace('[', '[^', 1)}]){MARK}++|(?<!{MARK}){MARK}++(?={SPACE}|\z)", "")
    return F.filter(F.split(bare, f"{SPACE}+"), lambda w: w != "")


def repeated_words(words: Column, n: int) -> Column:
    """How many words lie in runs of n words that began earlier in the array.

    Every word is hashed once, every n-gram as the hashes of its words. Grams are
    sorted with their places; in the sorted array a gram equal to its left
    neighbour is a repeat, and the union of the repeats' spans is a sum over
    neighbouring places. An earlier occurrence may overlap.
    """

    def ordered(h: Column) -> Column:
        grams = F.transform(F.sequence(F.lit(0), F.size(h) - n), lambda i: F.struct(F.xxhash64(*[F.get(h, i + k) for k in range(n)]).alias("h"), i.alias("i")))
        return F.sort_array(grams)

    def covered(sorted_grams: Column) -> Column:
        repeats = F.filter(F.transform(sorted_grams, lambda g, k: F.when((k > 0) & (F.get(sorted_grams, k - 1)["h"] == g["h"]), g["i"])), lambda i: i.isNotNull())
        return _let(F.sort_array(repeats), lambda r: F.aggregate(F.transform(r, lambda i, k: F.coalesce(F.least(F.get(r, k + 1) - i, F.lit(n)), F.lit(n))), F.lit(0), lambda a, x: a + x))

    return F.when(F.size(words) > n, _let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: _let(ordered(h), covered))).otherwise(0)


def bound_words(text: Column, body) -> Column:
    """``body(words)`` with the words computed once, whatever the optimizer does
    with the column around it (an expression in a lambda runs per element)."""
    return _let(words_of(text), body)


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def statistics(text: Column, words: Column, lines: Column, run: int = 5) -> dict[str, Column]:
    """The statistics rules may name, of a text, its words and its lines."""
    n = F.size(words)
    share = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    return {
        "n_words": n,
        "mean_word_chars": share(F.length(F.array_join(words, "")), n),
        "symbol_share": share(F.regexp_count(text, F.lit(r"[#…]|\.\.\.")), n),
        "stop_word_share": share(F.size(F.filter(words, lambda w: w.isin(STOP_WORDS))), n),
        "n_lines": F.size(lines),
        "repeated_line_share": share(F.size(lines) - F.size(F.array_distinct(lines)), F.size(lines)),
        "bullet_line_share": share(F.size(F.filter(lines, lambda x: x.rlike(r"\A[•●▪◦‣*\-–]"))), F.size(lines)),
        "ellipsis_line_share": share(F.size(F.filter(lines, lambda x: x.rlike(r"(…|\.\.\.)\z"))), F.size(lines)),
        "repeated_words": repeated_words(words, run),
    }


def score_repetition(df: DataFrame, rules: tuple[Rule, ...] = DEFAULT_RULES, id_col: str = "doc_id", text_col: str = "text", run: int = 5) -> DataFrame:
    """(id, statistics, one boolean per rule) for every row.

    Only statistics that a rule needs are computed besides the repeated words
    and their share. Null and empty texts have counts and shares of 0; unknown
    statistics or comparisons raise ValueError. Repeated rows each keep a row;
    other columns are not read.
    """
    base = df.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    known = set(statistics(F.lit(""), F.array(), F.array()))
    names = {"n_words", "repeated_words", *(r.statistic for r in rules)} - {"repeated_share"}
    if bad := [r for r in rules if r.statistic not in {*known, "repeated_share"} or r.op not in ("<", "<=", ">", ">=")]:
        raise ValueError(f"unknown statistic or comparison: {bad}")
    text = F.col("_text")
    lines = F.filter(F.transform(F.split(text, r"\r\n|\n|\r"), F.trim), lambda x: x != "")
    wanted = lambda w, x: F.struct(*[c.alias(k) for k, c in statistics(text, w, x, run).items() if k in names])
    out = base.select("_id", bound_words(text, lambda w: _let(lines, lambda x: wanted(w, x))).alias("_s")).select("_id", "_s.*")
    out = out.withColumn("repeated_share", F.coalesce(F.try_divide(F.col("repeated_words").cast("double"), F.col("n_words").cast("double")), F.lit(0.0)))
    compare = {"<": Column.__lt__, "<=": Column.__le__, ">": Column.__gt__, ">=": Column.__ge__}
    return out.select("*", *[compare[r.op](F.col(r.statistic), F.lit(r.limit)).alias(r.name) for r in rules]).withColumnRenamed("_id", id_col)
