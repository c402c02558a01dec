"""Quality flags and the filters built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lekhani.config import Config
from lekhani.functions import ngrams as N
from lekhani.functions import text as T
from lekhani.operators.dedup import one_per_key


def heavy(part: Column, whole: Column, threshold: float) -> Column:
    """part / whole reaches the threshold; false where the whole is 0 or anything is null."""
    return F.coalesce(T.ratio(part, whole) >= F.lit(float(threshold)), F.lit(False))


def _at_most(value: Column, limit: float) -> Column:
    return F.coalesce(value <= F.lit(limit), F.lit(False))


def add_flags(stats: DataFrame, config: Config = Config()) -> DataFrame:
    """Adds the six flags; repetition flags only where their filters are on.

    The two score maps are dropped, their single columns stay.
    """
    out = stats.select(
        "*",
        _at_most(F.col("lines_count"), config.min_line_count).alias("has_less_lines"),
        _at_most(F.col("mean_line_length"), config.min_mean_line_len).alias("is_short_lines_heavy"),
        heavy(F.col("nsfw_words_count"), F.col("words_count"), config.nsfw_threshold).alias("is_nsfw_heavy"),
        heavy(F.col("non_li_char_count"), F.col("char_count"), config.non_li_char_threshold).alias("is_non_li_heavy"),
    )
    for on, name, limits, column in (
        (config.char_repetition_filter, "has_char_repetition", config.char_ngram_cum_thresholds, N.char_column),
        (config.word_repetition_filter, "has_word_repetition", config.word_ngram_cum_thresholds, N.word_column),
    ):
        if on and all(column(n) in stats.columns for n in limits):
            out = out.withColumn(name, N.exceeds({n: F.col(column(n)) for n in limits}, limits))
    return out.drop("char_ngram_repetition_score", "word_ngram_repetition_score")


def enabled_filters(config: Config, columns: list[str]) -> list[tuple[str, str]]:
    """(filter, flag column) in the order of application."""
    order = [
        (config.line_count_filter, "line_count", "has_less_lines"),
        (config.line_length_filter, "line_length", "is_short_lines_heavy"),
        (config.nsfw_filter, "nsfw", "is_nsfw_heavy"),
        (config.non_li_filter, "non_li", "is_non_li_heavy"),
        (config.word_repetition_filter, "word_repetition", "has_word_repetition"),
        (config.char_repetition_filter, "char_repetition", "has_char_repetition"),
    ]
    return [(name, flag) for on, name, flag in order if on and flag in columns]


def keep_unflagged(flagged: DataFrame, config: Config = Config()) -> DataFrame:
    """Rows that no enabled filter removes."""
    return flagged.where(T.all_of([~F.col(flag) for _, flag in enabled_filters(config, flagged.columns)]))


def nsfw_side_output(flagged: DataFrame, config: Config = Config()) -> DataFrame:
    """Keyword-heavy rows that the filters ahead of the keyword filter keep."""
    ahead = [~F.col(flag) for name, flag in enabled_filters(config, flagged.columns) if name in ("line_count", "line_length")]
    return flagged.where(T.all_of(ahead) & F.col("is_nsfw_heavy"))


def remove_documents(docs: DataFrame, stats: DataFrame, key: str = "doc_id") -> DataFrame:
    """Documents with kept statistics, and the statistics but doc_lang. Each key
    is taken once on either side, the same row on every run; of columns both
    have, the documents' stay."""
    clash = [c for c in stats.columns if c != key and c in docs.columns]
    return one_per_key(docs, key).join(one_per_key(stats, key).drop("doc_lang", *clash), key)


def surviving_documents(docs: DataFrame, stats: DataFrame, key: str = "doc_id") -> DataFrame:
    """Documents with kept statistics, without those."""
    return docs.join(stats, key, "left_semi")


def flag_document(df: DataFrame, symbol_threshold: float, config: Config = Config()) -> DataFrame:
    """All seven flags of complete document metadata, symbols and numbers included."""
    return add_flags(df, config).withColumn("is_symbol_number_heavy", heavy(F.col("symbol_number_count"), F.col("char_count"), symbol_threshold))
