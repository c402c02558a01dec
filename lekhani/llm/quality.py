"""Per-document text statistics and what kind of text a document is.

Every line gets a kind by combined rules on its shape; kinds weigh by their
characters. All of it is one projection of built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lekhani.functions import text as T
from lekhani.llm.repetition import STOP_WORDS, _let, bound_words

LETTER = r"[\p{L}\p{M}]"
_END = r"[.!?।॥۔؟…。！？][\"'”’»)\]]*"

JUNK_SYMBOLS = rf"[^\p{{L}}\p{{M}}\p{{Nd}}\s]"
#: UTF-8 read as Latin-1 or Windows-1252: lead bytes with what follows them.
MOJIBAKE = r"[\x{c2}-\x{f4}][\x{80}-\x{bf}\x{152}\x{153}\x{160}\x{161}\x{178}\x{17d}\x{17e}\x{192}\x{2c6}\x{2dc}\x{2013}-\x{203a}\x{20ac}\x{2122}]|[\x{80}-\x{9f}\x{fffd}]"
#: Words of letters mixed with digits, as in encoded data, hashes and identifiers.
ENCODED_WORD = r"(?<![^\s=:,;\[\]()])(?=[A-Za-z0-9+/_\-]*[0-9])(?=[A-Za-z0-9+/_\-]*[A-Za-z])[A-Za-z0-9+/_\-]{8,}={0,2}(?![^\s,;:\[\]()])"
LOG_LINE = r"\A\s*(?:\[?\d{4}-\d\d-\d\d[T ])?\[?\d\d:\d\d:\d\d\]?.*|\A.*\b(?:ERR|ERROR|WARN|WARNING|INFO|DEBUG|TRACE|FATAL)\b.*(?:0x[0-9a-f]+|=\d).*"
#: Letter pairs and runs that no readable Latin-script word has.
UNREADABLE = r"(?i)[bcdfghjklmnpqrstvwxz]{5,}|q[^u\W\d_]|[jqvxw][bcdfgjkmpqtvxz]|[bcdfghjklmnpqrtvwxz][jqx]|[aeiou]{4,}|[aeiouy][aeiouy]{3,}|[dfgpt]k|k[dgjpt]|[fgkpdj]w|wj|[hjdgk]f|f[dghjkpq]|[jqwr]{2,}|p[dgjkq]|[dgjk]p"
#: Words too long for any language that sets blanks between words.
RUN_ON = r"(?<![\p{L}\p{M}\p{Nd}])[\p{L}\p{M}\p{Nd}&&[^\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}\p{IsTibetan}]]{40,}+"
BULLET = r"\A\s*(?:[•●▪◦‣·*»›→✓–—\-]\s|[*•●▪◦‣»]\S|o\s|\(?(?:\p{Nd}{1,3}|[a-zA-Z]|[ivxIVX]{1,4})[.)]\s|\p{Nd}{1,3}\s[-–—]\s)"
ITEM_COUNT = r"\s\(\p{Nd}+\)\s*\z"
CELLS = r"\A\s*\|.*\|\s*\z|\t.*\t|\A[^\t]+\t[^\t]*\p{Nd}[^\t]*\z"
#: Columns set with spaces; justified prose has such gaps too, but ends in a mark.
ALIGNED = r"\S {2,}\S.*?\S {2,}\S|\S {3,}\p{Nd}"
SEPARATED = r"\A[^,;|]{1,60}(?:;[^;]*){2,}\z|\A[^,;|.!?।]{1,60}(?:,\s?[^,]{0,30}){2,}\z"
NUMBER_CELL = r"(?:\A|[,;|\t]|\s{2,})\s*[-+]?\p{Nd}+(?:[.,]\p{Nd}+)?\s*(?:%|[,;|\t]|\s{2,}|\z)"
PAIR = rf"\A\s*[^:：=.!?।۔]{{1,50}}\s?[:：=]\s*\S.{{0,50}}\z"


def line_kind(line: Column) -> Column:
    """junk, table, list or prose for one trimmed, non-blank line."""
    n = F.length(line)
    count = lambda p: F.regexp_count(line, F.lit(p))
    words = F.size(F.split(line, r"\s+"))
    ended = line.rlike(rf"{_END}(?:\s*[-–—]\s*\S.{{0,40}})?\z")
    encoded = F.length(line) - F.length(F.regexp_replace(line, ENCODED_WORD, ""))
    latin = count(r"[A-Za-z]{2,}")
    # unreadable pairs per Latin word; mashed keys have one in most words
    mashed = (latin >= 3) & (count(r"[A-Za-z]") > n * 0.6) & (count(UNREADABLE) > latin * 0.5) & (count(r"[A-Z][a-z]") < latin * 0.3)
    run_on = F.length(line) - F.length(F.regexp_replace(line, RUN_ON, ""))
    junk = (count(JUNK_SYMBOLS) > n * 0.5) | (count(MOJIBAKE) > n * 0.12) | (encoded > n * 0.5) | line.rlike(LOG_LINE) | mashed | (run_on > n * 0.3)
    table = line.rlike(CELLS) | (line.rlike(ALIGNED) & ~ended) | (line.rlike(SEPARATED) & line.rlike(NUMBER_CELL) & ~ended) | (line.rlike(PAIR) & ~ended & (words <= 12))
    # items set one after another: many commas or semicolons, hardly a common word
    commas = count("[,;،؛、]")
    common = F.size(F.filter(F.split(F.lower(line), r"[\s\p{P}]+"), lambda w: w.isin(STOP_WORDS)))
    run_in = (commas >= 2) & (commas >= words * 0.18) & ~ended & (common <= words * 0.1)
    listed = run_in | line.rlike(BULLET) | line.rlike(ITEM_COUNT) | ((words <= 8) & ~ended) | ((count(r"\S [/|·•] \S") >= 3) & (count(r"\S [/|·•] \S") * 8 >= words))
    return F.when(junk & ~line.rlike(r"\A\s*\|.*\|\s*\z"), "junk").when(table, "table").when(listed, "list").otherwise("prose")


def _top_ngram_share(words: Column, n: int) -> Column:
    """Share of the words' characters that the most frequent n-gram covers."""
    grams = F.transform(F.sequence(F.lit(1), F.size(words) - (n - 1)), lambda i: F.array_join(F.slice(words, i, n), " "))
    start = F.struct(F.lit("").alias("g"), F.lit(0).alias("run"), F.lit(0).alias("most"), F.lit(0).alias("chars"))

    def step(a: Column, g: Column) -> Column:
        run = F.when(a["g"] == g, a["run"] + 1).otherwise(1)
        chars = F.when((run > a["most"]) | ((run == a["most"]) & (run > 1) & (F.length(g) * run > a["chars"])), F.length(g) * run).otherwise(a["chars"])
        return F.struct(g.alias("g"), run.alias("run"), F.greatest(run, a["most"]).alias("most"), chars.alias("chars"))

    covered = F.aggregate(F.sort_array(grams), start, step, lambda a: F.when(a["most"] > 1, a["chars"]).otherwise(0))
    total = F.length(F.array_join(words, " "))
    return F.when(F.size(words) >= n, F.coalesce(T.ratio(covered, total), F.lit(0.0))).otherwise(0.0)


def _repeated_share(parts: Column) -> Column:
    return F.coalesce(T.ratio(F.size(parts) - F.size(F.array_distinct(parts)), F.size(parts)), F.lit(0.0))


def lines_of(text: Column) -> Column:
    """Trimmed lines that are not blank."""
    return F.filter(F.transform(F.split(text, r"\r\n|\n|\r"), lambda x: F.regexp_replace(x, r"(?U)\A\s+|\s+\z", "")), lambda x: x != "")


KINDS = ("junk", "table", "list", "boilerplate", "prose")


def kind_shares(lines: Column) -> Column:
    """map(kind -> share of the lines' characters).

    A line that would be prose by its shape but stands in the text more than
    once is boilerplate.
    """
    kinds = F.sort_array(F.transform(lines, lambda x: F.struct(x.alias("line"), line_kind(x).alias("kind"), F.length(x).alias("n"))))

    def twice(k: Column) -> Column:
        same = lambda x, i: F.coalesce(F.get(k, i)["line"] == x["line"], F.lit(False))
        again = lambda x, i: (x["kind"] == "prose") & (same(x, i - 1) | same(x, i + 1))
        return F.transform(k, lambda x, i: F.struct(F.when(again(x, i), "boilerplate").otherwise(x["kind"]).alias("kind"), x["n"].alias("n")))

    chars = lambda k: F.aggregate(k, F.lit(0), lambda a, x: a + x["n"])

    def shares(k: Column) -> Column:
        part = lambda kind: F.coalesce(T.ratio(chars(F.filter(k, lambda x: x["kind"] == kind)), chars(k)), F.lit(0.0))
        return F.create_map(*[x for kind in KINDS for x in (F.lit(kind), part(kind))])

    return _let(kinds, lambda k: _let(twice(k), shares))


def text_statistics(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of statistics per row; null texts count as empty (zeros, ratio null).

    words_count and symbol_ratio are the ones stored tables should hold.
    """
    base = df.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    share = lambda a, b: F.coalesce(T.ratio(a, b), F.lit(0.0))
    text = F.col("_text")

    def all_statistics(words: Column, lines: Column) -> Column:
        n = F.size(words)
        return F.struct(
            share(F.length(F.array_join(words, "")), n).alias("mean_word_length"),
            share(F.size(F.filter(words, lambda w: w.isin(STOP_WORDS))), n).alias("common_word_share"),
            share(F.size(F.filter(lines, lambda x: x.rlike(rf"{_END}\z"))), F.size(lines)).alias("ended_line_share"),
            _repeated_share(lines).alias("repeated_line_share"),
            *[_top_ngram_share(words, k).alias(f"top_{k}_gram_share") for k in (2, 3, 4)],
            kind_shares(lines).alias("_share"),
        )

    out = base.select(
        "_id",
        T.word_count(text).alias("words_count"),
        F.length(text).alias("chars_count"),
        T.symbol_ratio(text).cast("float").alias("symbol_ratio"),
        _let(F.filter(F.split(text, r"\n\s*\n"), lambda p: F.trim(p) != ""), _repeated_share).alias("repeated_paragraph_share"),
        bound_words(text, lambda w: _let(lines_of(text), lambda x: all_statistics(w, x))).alias("_s"),
    )
    return out.select(F.col("_id").alias(id_col), "words_count", "chars_count", "symbol_ratio", "repeated_paragraph_share", "_s.*").select("*", *[F.col("_share")[k].alias(f"{k}_share") for k in KINDS]).drop("_share")


def text_kinds(df: DataFrame, id_col: str = "doc_id", text_col: str = "uncleaned_text", words_col: str = "uncleaned_words_count", symbols_col: str = "symbol_ratio", tolerance: float = 0.01) -> DataFrame:
    """(id, kind): list, table or junk where more than half of the text's
    characters stand in such lines; stale where a stored statistic is wrong.

    Prose, null and empty texts have no kind. Each pair once (duplicates are
    merged on their ids, after the texts are gone).
    """
    base = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.col(words_col).alias("_n"), F.col(symbols_col).alias("_s")).where("_text is not null")
    wrong = F.coalesce(F.col("_n") != T.word_count(F.col("_text")), F.lit(False)) | F.coalesce(F.abs(F.col("_s").cast("double") - F.coalesce(T.symbol_ratio(F.col("_text")), F.lit(0.0))) > tolerance, F.lit(False))
    kinds = _let(kind_shares(lines_of(F.col("_text"))), lambda m: F.array_compact(F.array(*[F.when(m[k] > 0.5, F.lit(k)) for k in ("list", "table", "junk")], F.when(wrong, F.lit("stale")))))
    return base.select(F.col("_id").alias(id_col), F.explode(kinds).alias("kind")).distinct()
