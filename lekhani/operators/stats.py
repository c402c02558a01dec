"""Line statistics and their aggregation to documents in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lekhani.functions import keywords as K
from lekhani.functions import ngrams as N
from lekhani.functions import text as T
from lekhani.operators.lines import computed_once, joined

#: Symbols (see ``text.symbol_count``) and decimal digits.
SYMBOL_OR_DIGIT = rf"[^{T.VALID_CLASS} \n]|\p{{Nd}}"


def measures(text: Column, keyword_lists: dict[str, list[str]] | None = None, language: Column | None = None, symbols: bool = False) -> dict[str, Column]:
    """Statistics of one line; nsfw_words_count is the total of nsfw_word_dist."""
    if keyword_lists and language is not None:
        dist = K.by_language(text, language, keyword_lists, K.distribution)
    else:
        dist = K.distribution(text, [])
    out = {
        "is_number": T.is_number(text),
        "words_count": T.word_count(text),
        "char_count": T.char_count(text),
        "bytes": T.byte_count(text),
        "nsfw_word_dist": dist,
        "non_li_char_count": T.foreign_char_count(text),
    }
    return out | ({"symbol_number_count": F.regexp_count(text, F.lit(SYMBOL_OR_DIGIT))} if symbols else {})


def line_stats(lines: DataFrame, keyword_lists: dict[str, list[str]] | None = None, text_col: str = "text", lang_col: str | None = "doc_lang", drop_numbers: bool = False, symbols: bool = False) -> DataFrame:
    """Adds is_number, words_count, char_count, bytes, nsfw_word_dist,
    nsfw_words_count and non_li_char_count to every line; with ``symbols`` also
    symbol_number_count."""
    stats = measures(F.col(text_col), keyword_lists, F.col(lang_col) if lang_col else None, symbols)
    out = lines.select("*", *[c.alias(k) for k, c in stats.items()])
    out = out.withColumn("nsfw_words_count", K.total(F.col("nsfw_word_dist")))
    return out.where(~F.col("is_number")) if drop_numbers else out


def documents_of_lines(df: DataFrame, keep: list[str], sentences: Column, keyword_lists: dict[str, list[str]] | None = None, language: Column | None = None, drop_numbers: bool = False) -> DataFrame:
    """``keep`` columns, ``_lines`` (the lines with their statistics), the text of
    the lines and the statistics of ``doc_stats``, all within the row: nothing is
    exploded, grouped or joined. Documents left without lines are left out.
    """
    stats = lambda x, i: F.struct(i.alias("pos"), x.alias("text"), *[c.alias(k) for k, c in measures(x, keyword_lists, language).items()])
    lines = F.transform(sentences, stats)
    if drop_numbers:
        lines = F.filter(lines, lambda x: ~x["is_number"])
    lines = F.transform(lines, lambda x: x.withField("nsfw_words_count", K.total(x["nsfw_word_dist"])))
    rows = computed_once(df, [F.col(c) for c in keep], [lines.alias("_lines")]).where(F.size("_lines") > 0)
    add = lambda c: F.aggregate(F.transform("_lines", lambda x: x[c].cast("bigint")), F.lit(0).cast("bigint"), lambda a, v: a + v)
    columns = [
        joined(F.transform("_lines", lambda x: F.struct(x["pos"].alias("pos"), x["text"].alias("text")))).alias("text"),
        *[add(c).alias(c) for c in ("bytes", "words_count", "char_count")],
        F.size("_lines").cast("bigint").alias("lines_count"),
        (add("words_count") / F.size("_lines")).alias("mean_line_length"),
        F.array_min("_lines.words_count").alias("min_line_length"),
        F.array_max("_lines.words_count").alias("max_line_length"),
        *[add(c).alias(c) for c in ("nsfw_words_count", "non_li_char_count")],
    ]
    return computed_once(rows, [*[F.col(c) for c in keep], F.col("_lines")], columns)


def doc_stats(lines: DataFrame, id_col: str = "doc_id", base_only: bool = False) -> DataFrame:
    """Document statistics of line statistics: one aggregation, one shuffle.

    Line lengths are counted in words. ``base_only`` gives bytes, words and
    characters only. Lines with a ``symbol_number_count`` have that summed too.
    """
    base = [F.sum(c).alias(c) for c in ("bytes", "words_count", "char_count")]
    if base_only:
        return lines.groupBy(id_col).agg(*base)
    return lines.groupBy(id_col).agg(
        *base,
        F.count("*").alias("lines_count"),
        F.avg("words_count").alias("mean_line_length"),
        F.min("words_count").alias("min_line_length"),
        F.max("words_count").alias("max_line_length"),
        F.sum("nsfw_words_count").alias("nsfw_words_count"),
        F.sum("non_li_char_count").alias("non_li_char_count"),
        *([F.sum("symbol_number_count").alias("symbol_number_count")] if "symbol_number_count" in lines.columns else []),
    )


def length_stats(lines: DataFrame, id_col: str = "doc_id", length_col: str = "words_count") -> DataFrame:
    """Mean, median, mode (the least of the most frequent), least and greatest line length."""
    counts = lines.groupBy(id_col, length_col).agg(F.count("*").alias("_n"), F.sum(length_col).alias("_s"))
    mode = counts.groupBy(id_col).agg(
        F.max_by(F.col(length_col), F.struct(F.col("_n"), -F.col(length_col))).alias("mode"),
        (F.sum("_s") / F.sum("_n")).alias("mean"),
        F.min(length_col).alias("min"),
        F.max(length_col).alias("max"),
        F.percentile(F.col(length_col), 0.5, F.col("_n")).alias("median"),
    )
    return mode.select(id_col, "mean", "median", "mode", "min", "max")


def repeated_lines(lines: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, count) of every different line."""
    return lines.groupBy(id_col, text_col).agg(F.count("*").alias("count"))


def repeated_line_dist(lines: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The same as a map text -> count per document."""
    counts = repeated_lines(lines.where(F.col(text_col).isNotNull()), id_col, text_col)
    return counts.groupBy(id_col).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(text_col, F.col("count").cast("int"))))).alias("repeated_line_dist"))


def document_bundle(lines: DataFrame, char_ns=("10",), word_ns=("5",), id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ("source", "url")) -> DataFrame:
    """Everything known of a document from its lines (with ``symbol_number_count``),
    in one aggregation: text, num_of_lines, stats, line_length_stats,
    repeated_line_dist and the repetition scores by n.
    """
    part = F.struct("pos", F.col(text_col).alias("text"), F.col("words_count").alias("n"))
    names = {"nsfw_words_count": "nsfw_words_count", "symbol_number_count": "symbol_numbers_count", "non_li_char_count": "non_li_count", "bytes": "bytes", "words_count": "words_count", "char_count": "char_count"}
    sums = [F.sum(c).alias(k) for c, k in names.items()]
    # a document's lines, which were one text before
    grouped = lines.groupBy(id_col).agg(*sums, *[F.first(c, ignorenulls=True).alias(c) for c in keep if c in lines.columns], F.array_sort(F.collect_list(part)).alias("_lines"))
    lengths = F.sort_array("_lines.n")

    def length_bundle(x: Column) -> Column:
        n, half = F.size(x), F.floor(F.size(x) / 2).cast("int")
        counts = F.transform(F.array_distinct(x), lambda v: F.struct(F.size(F.filter(x, lambda y: y == v)).alias("c"), (-v).alias("v")))
        return F.struct(
            (F.aggregate(x, F.lit(0).cast("bigint"), lambda a, v: a + v) / n).alias("mean"),
            F.when(n % 2 == 1, F.get(x, half).cast("double")).otherwise((F.get(x, half - 1) + F.get(x, half)) / 2.0).alias("median"),
            (-F.array_max(counts)["v"]).alias("mode"),
            F.array_min(x).alias("min"),
            F.array_max(x).alias("max"),
        )

    def repeats(x: Column) -> Column:
        """Run lengths in the sorted texts."""
        starts = F.filter(F.sequence(F.lit(0), F.size(x) - 1), lambda i: (i == 0) | (F.get(x, i) != F.get(x, i - 1)))
        return N._let(starts, lambda s: F.map_from_entries(F.transform(s, lambda i, k: F.struct(F.get(x, i), (F.coalesce(F.get(s, k + 1), F.size(x)) - i)))))

    out = grouped.select(
        id_col,
        *[c for c in keep if c in lines.columns],
        joined(F.transform("_lines", lambda x: F.struct(x["pos"].alias("pos"), x["text"].alias("text")))).alias("text"),
        F.size("_lines").alias("num_of_lines"),
        F.struct(*names.values()).alias("stats"),
        N._let(lengths, length_bundle).alias("line_length_stats"),
        N._let(F.sort_array("_lines.text"), repeats).alias("repeated_line_dist"),
    )
    return repetition_scores(out, char_ns, word_ns).withColumnsRenamed({"char_ngram_repetition_score": "repeated_char_ngram_dist", "word_ngram_repetition_score": "repeated_word_ngram_dist"})


def merge_distributions(lines: DataFrame, id_col: str = "doc_id", map_col: str = "nsfw_word_dist") -> DataFrame:
    """Sum of the keyword maps of a document's lines; documents without hits have an empty map."""
    entries = lines.select(id_col, F.explode_outer(map_col).alias("key", "value")).groupBy(id_col, "key").agg(F.sum("value").alias("value"))
    pairs = F.collect_list(F.when(F.col("key").isNotNull(), F.struct("key", "value")))
    return entries.groupBy(id_col).agg(F.map_from_entries(F.sort_array(pairs)).alias(map_col))


def repetition_scores(docs: DataFrame, char_ns=("10",), word_ns=("5",), text_col: str = "text") -> DataFrame:
    """Adds a score column for every n, and the maps char_/word_ngram_repetition_score."""
    t = F.col(text_col)
    out = docs
    for n in char_ns:
        out = out.withColumn(N.char_column(n), N.char_repetition(t, int(n)).cast("float"))
    for n in word_ns:
        out = out.withColumn(N.word_column(n), N.word_repetition(t, int(n)).cast("float"))
    for name, ns, column in (("char_ngram_repetition_score", char_ns, N.char_column), ("word_ngram_repetition_score", word_ns, N.word_column)):
        pairs = [x for n in ns for x in (F.lit(column(n)), F.col(column(n)))]
        out = out.withColumn(name, F.create_map(*pairs) if pairs else F.create_map().cast("map<string,float>"))
    return out


def keep_once(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key occurs exactly once (all copies of others go).

    Counted with partial aggregation, so a key with very many rows does not
    gather in one task. Null keys are keys.
    """
    rest = [c for c in df.columns if c not in keys]
    counted = df.groupBy(*keys).agg(F.count("*").alias("_n"), *[F.first(c).alias(c) for c in rest])
    return counted.where("_n = 1").select(*df.columns)
