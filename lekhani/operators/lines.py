"""Documents to lines and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lekhani.functions import text as T


def computed_once(df: DataFrame, keep: list, columns: list[Column]) -> DataFrame:
    """``keep`` and the ``columns``, which are computed once for whatever is built on
    them: filters are not pushed below a generator, and projections not merged
    with it, so that the optimizer copies no expression into its uses."""
    return df.select(*keep, F.inline(F.array(F.struct(*columns))))


def doc_to_chunks(df: DataFrame, text_col: str = "text", symbol: str = "\n") -> DataFrame:
    """A row per chunk: ``pos`` from 0, ``text_col`` the chunk; empty chunks stay. Null texts vanish."""
    keep = [F.col(c) for c in df.columns if c != text_col]
    return df.select(*keep, F.posexplode(F.split(text_col, symbol, -1)).alias("pos", text_col))


def doc_to_sentences(df: DataFrame, text_col: str = "text") -> DataFrame:
    """A row per sentence, also an empty last one; null texts vanish."""
    keep = [F.col(c) for c in df.columns if c != text_col]
    return df.select(*keep, F.posexplode(T.split_sentences(F.col(text_col))).alias("pos", text_col))


def joined(parts: Column, separator: str = "") -> Column:
    """Texts of (pos, text) structs in their order. Without a separator a line
    that begins with two blanks loses one."""
    texts = F.transform(F.array_sort(parts), lambda p: F.when(p["text"].startswith("  "), F.substring(p["text"], F.lit(2), F.length(p["text"]))).otherwise(p["text"]) if separator == "" else p["text"])
    return F.array_join(texts, separator)


def lines_to_doc(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", pos_col: str = "pos", separator: str = "") -> DataFrame:
    """One row per id with its lines joined by position (ties by text)."""
    part = F.struct(F.col(pos_col).alias("pos"), F.col(text_col).alias("text"))
    return df.groupBy(id_col).agg(joined(F.collect_list(part), separator).alias(text_col))
