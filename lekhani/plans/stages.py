"""The seven stages, three components and the whole pipeline.

A stage is a function from frames to frames; nothing is written unless asked.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lekhani.config import Config
from lekhani.functions import html, language, normalize, text
from lekhani.operators import clean, dedup, flags, lines, stats
from lekhani.sources import readers


def json_to_parquet(spark, glob: str, lang: str, mode: str = "crawl", multiline: bool = True) -> DataFrame:
    """Stage 1: ``mode`` is crawl, ocr or asr."""
    modes = {"crawl": readers.read_crawl_json, "ocr": readers.read_scan_json, "asr": readers.read_speech_json}
    if mode not in modes:
        raise ValueError(f"mode {mode!r}: crawl, ocr or asr")
    return modes[mode](spark, glob, lang, multiline)


def extract_text(raw: DataFrame) -> DataFrame:
    """Stage 2: main text and metadata of pages with a timestamp, ids once."""
    pages = dedup.one_per_key(raw.dropna(subset=["timestamp"]), "doc_id")
    return html.extract_pages(pages, ["doc_id", "url", "source", "timestamp", "language"])


def clean_documents(extracted: DataFrame, passthrough: list[str] | None = None, config: Config = Config(), use_symbol_filter: bool = True) -> tuple[DataFrame, DataFrame]:
    """Stage 3: (cleaned, symbol-heavy)."""
    keep = passthrough or ["url", "source", "language"]
    rows = clean.preprocess(extracted, keep)
    return clean.clean_documents(rows, [c for c in keep if c != "successful_extraction"], config, use_symbol_filter)


def identify_language(cleaned: DataFrame, detectors: list, codes: dict, keep: list[str] | None = None) -> DataFrame:
    """Stage 4: languages of non-null texts by three detectors."""
    columns = keep or ["doc_id", "url", "source", "language", "text"]
    return language.identify(cleaned.dropna(subset=["text"]), detectors, codes, columns)


@dataclass
class Analysis:
    lines: DataFrame
    docs: DataFrame
    stats: DataFrame
    #: documents with their statistics and scores, in one row each
    rows: DataFrame


def analyse(identified: DataFrame, keyword_lists: dict | None = None, config: Config = Config(), passthrough: list[str] | None = None, rules: dict | None = None, splitter=None) -> Analysis:
    """Stage 5: line statistics, documents of the surviving lines, document statistics.

    Lines never leave their document's row: all three results are columns of the
    same rows, so nothing is grouped or joined, and only line statistics are
    exploded, by whoever reads them. ``rules`` normalise texts by language;
    ``splitter`` (text, language) -> list replaces the sentence splitter.
    """
    keep = passthrough or [c for c in ("doc_id", "url", "source", "language", "doc_lang", "doc_lang_iso") if c in identified.columns]
    named = "doc_lang" in identified.columns
    lang = F.col("doc_lang") if named else F.lit("other")
    sentences = text.split_sentences(F.col("text")) if splitter is None else text.split_by(splitter, F.col("text"), lang)
    parts = lines.computed_once(identified.where("text is not null"), [F.col(c) for c in keep], [sentences.alias("_raw")])
    parts = parts.select(*keep, normalize.normalize_all(F.col("_raw"), lang, rules).alias("_parts"))
    rows = stats.documents_of_lines(parts, keep, F.col("_parts"), keyword_lists, F.col("doc_lang") if named else None, config.remove_only_number)
    if config.calculate_repetition_scores:
        rows = stats.repetition_scores(rows, tuple(config.char_ngram_cum_thresholds), tuple(config.word_ngram_cum_thresholds))
    measured = [c for c in rows.columns if c not in (*keep, "_lines", "text")]
    line = rows.select(*keep, F.explode("_lines").alias("_line")).select(*keep, "_line.*")
    return Analysis(line, rows.select(*keep, "text"), rows.select("doc_id", *measured, *(["doc_lang"] if named else [])), rows.drop("_lines"))


def flag_and_filter(doc_stats: DataFrame, config: Config = Config()) -> tuple[DataFrame, DataFrame]:
    """Stage 6: (kept statistics, keyword-heavy side output)."""
    flagged = flags.add_flags(dedup.one_per_key(doc_stats, "doc_id"), config)
    return flags.keep_unflagged(flagged, config), flags.nsfw_side_output(flagged, config)


def remove_documents(docs: DataFrame, kept_stats: DataFrame, key: str = "doc_id") -> DataFrame:
    """Stage 7: documents whose statistics were kept."""
    return flags.remove_documents(docs, kept_stats, key)


COMPONENTS = {
    "TextExtractionComponent": ["JSON2ParquetStage", "ExtractTextStage"],
    "CleanAnalysisComponent": ["DocCleanStage", "LIDStage", "AnalysisStage"],
    "FlagAndRemoveComponent": ["FlaggingAndFilteringStage", "DocumentRemovalStage"],
}


def default_detectors() -> list:
    """Three detectors that need no models."""
    return language.default_detectors()


def curate(extracted: DataFrame, codes: dict, keyword_lists: dict | None = None, config: Config = Config(), detectors: list | None = None) -> DataFrame:
    """Stages 3 to 7 in memory. Documents and statistics stay in one row, so
    ids are made unique once and nothing is joined."""
    cleaned, _ = clean_documents(extracted, config=config)
    identified = identify_language(cleaned, detectors or default_detectors(), codes)
    rows = analyse(identified, keyword_lists, config).rows
    return flags.keep_unflagged(flags.add_flags(rows, config), config)
