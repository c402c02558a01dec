"""Cleaning of extracted text chunk by chunk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lekhani.config import Config
from lekhani.functions import code as C
from lekhani.functions import text as T
from lekhani.operators import stats
from lekhani.operators.dedup import one_per_key
from lekhani.operators.lines import doc_to_chunks, lines_to_doc


def chunk_filter(chunk: Column, config: Config) -> Column:
    """Whether all enabled chunk rules keep a chunk."""
    rules = []
    if config.remove_only_num_or_punc_chunks:
        rules.append(~T.is_number_or_marks(chunk))
    if config.remove_terminal_invalid:
        rules.append(T.ends_properly(chunk))
    if config.chunk_length_filter:
        rules.append(T.word_count(chunk) > 1)
    return T.all_of(rules)


def measured(df: DataFrame, passthrough: list[str], config: Config = Config(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Texts without code and their statistics, before any filter.

    Columns: id, _original, passthrough (as strings, null as "None"), code_spans,
    uncleaned_chars_count, uncleaned_words_count, uncleaned_bytes, symbol_ratio,
    invalid_char_count, uncleaned_text. Null texts, and texts that are empty
    without their code, are left out.
    """
    base = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_original"), *[F.coalesce(F.col(c).cast("string"), F.lit("None")).alias(c) for c in passthrough]).where("_original is not null")
    if config.remove_code:
        base = base.withColumn("code_spans", C.code_spans(F.col("_original")))
        base = base.withColumn("uncleaned_text", C.remove_code(F.col("_original"), F.col("code_spans")))
    else:
        base = base.withColumn("code_spans", F.lit(None).cast("array<array<int>>")).withColumn("uncleaned_text", F.col("_original"))
    t = F.col("uncleaned_text")
    return base.where("uncleaned_text != ''").select(
        "doc_id",
        "_original",
        *passthrough,
        "code_spans",
        T.char_count(t).alias("uncleaned_chars_count"),
        T.word_count(t).alias("uncleaned_words_count"),
        T.byte_count(t).alias("uncleaned_bytes"),
        T.symbol_ratio(t).alias("symbol_ratio"),
        T.symbol_count(t).alias("invalid_char_count"),
        "uncleaned_text",
    )


def clean_chunks(text: Column, config: Config = Config()) -> Column:
    """Kept chunks, each with a line feed; null if none is kept."""
    kept = F.filter(F.split(text, "\n", -1), lambda c: chunk_filter(c, config))
    return F.when(F.size(kept) > 0, F.concat(F.array_join(kept, "\n"), F.lit("\n")))


def clean_documents(df: DataFrame, passthrough: list[str], config: Config = Config(), use_symbol_filter: bool = True, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(cleaned documents, symbol-heavy documents with their original text).

    A document whose chunks all fall out stays with a null text.
    """
    rows = measured(df, passthrough, config, id_col, text_col)
    heavy = F.col("symbol_ratio") >= config.symbol_threshold
    tail = ["code_spans", "uncleaned_chars_count", "uncleaned_words_count", "uncleaned_bytes", F.col("symbol_ratio").cast("float").alias("symbol_ratio"), "invalid_char_count"]
    kept = rows.where(~heavy) if use_symbol_filter else rows
    cleaned = kept.select("doc_id", clean_chunks(F.col("uncleaned_text"), config).alias("text"), *passthrough, *tail, "uncleaned_text")
    if config.repeated_chunk_filter:
        cleaned = drop_repeated_chunks(cleaned)
    side = rows.where(heavy).select("doc_id", F.col("_original").alias("text"), *passthrough, *tail)
    return cleaned, side


def unique_chunks(df: DataFrame, url_col: str = "url", text_col: str = "text") -> DataFrame:
    """Chunks that stand once in all documents of their url."""
    return stats.keep_once(doc_to_chunks(df, text_col), [url_col, text_col])


def drop_repeated_chunks(df: DataFrame, id_col: str = "doc_id", url_col: str = "url", text_col: str = "text") -> DataFrame:
    """Documents without chunks that occur more than once within their url; all
    copies go. A document left without chunks has a null text."""
    once = unique_chunks(df.select(id_col, url_col, text_col), url_col, text_col)
    rebuilt = lines_to_doc(once, id_col, text_col, separator="\n")
    return df.drop(text_col).join(rebuilt, id_col, "left").select(*df.columns)


def preprocess(df: DataFrame, passthrough: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Input of cleaning: failed extractions and null texts out, then ids once;
    which of several rows stays does not depend on partitions."""
    if "successful_extraction" in passthrough and "successful_extraction" in df.columns:
        df = df.where("successful_extraction")
    return one_per_key(df.select(id_col, text_col, *[c for c in passthrough if c not in (id_col, text_col)]).dropna(subset=[text_col]), id_col)
