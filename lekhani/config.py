"""Thresholds and switches of the curation stages."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields, replace
from pathlib import Path


@dataclass(frozen=True)
class Config:
    """Web-crawl defaults; ``for_language`` and ``for_scans`` give variants."""

    symbol_threshold: float = 0.2
    input_threshold: float = 0.5
    roman_lid_threshold: float = 0.6
    lid_probability_threshold: float = 0.9
    remove_code: bool = True
    remove_terminal_invalid: bool = True
    remove_only_number: bool = True
    remove_only_num_or_punc_chunks: bool = False
    repeated_chunk_filter: bool = False
    chunk_length_filter: bool = False
    save_nsfw_data: bool = True
    nsfw_filter: bool = False
    nsfw_threshold: float = 1.0
    non_li_filter: bool = True
    non_li_char_threshold: float = 0.05
    line_count_filter: bool = True
    min_line_count: int = 4
    line_length_filter: bool = True
    min_mean_line_len: int = 5
    calculate_repetition_scores: bool = True
    word_repetition_filter: bool = True
    word_ngram_cum_thresholds: dict = field(default_factory=lambda: {"5": 0.4})
    char_repetition_filter: bool = True
    char_ngram_cum_thresholds: dict = field(default_factory=lambda: {"10": 0.2})


# Where languages deviate from the defaults.
OVERRIDES = {
    "assamese": {"non_li_char_threshold": 0.03, "min_line_count": 3, "char_ngram_cum_thresholds": {"10": 0.1}},
    "bodo": {"non_li_char_threshold": 0.06, "min_line_count": 3},
    "gujarati": {"non_li_char_threshold": 0.06, "min_line_count": 3, "min_mean_line_len": 4, "word_ngram_cum_thresholds": {"5": 0.3}},
    "hindi": {"word_ngram_cum_thresholds": {"5": 0.5}},
    "kannada": {"word_ngram_cum_thresholds": {"5": 0.5}},
}
NGRAM_KEYS = ("char_ngram_cum_thresholds", "word_ngram_cum_thresholds")


def for_language(language: str) -> Config:
    """Crawl settings of a language."""
    return replace(Config(), **OVERRIDES.get(language, {}))


def for_scans(language: str) -> Config:
    """Settings of a language for scanned books: no code removal, no repetition scores."""
    own = {k: v for k, v in OVERRIDES.get(language, {}).items() if k not in NGRAM_KEYS}
    return replace(Config(), **own, remove_code=False, calculate_repetition_scores=False, word_repetition_filter=False, char_repetition_filter=False)


def load(path: str) -> Config:
    """Settings from a flat JSON file; keys it does not know are ignored."""
    given = json.loads(Path(path).read_text(encoding="utf-8"))
    known = {f.name for f in fields(Config)}
    return Config(**{k: v for k, v in given.items() if k in known})


def as_bool(value: str | bool) -> bool:
    """Command-line booleans: yes, true, t, y, 1 and their opposites."""
    if isinstance(value, bool):
        return value
    low = value.strip().lower()
    if low in ("yes", "true", "t", "y", "1"):
        return True
    if low in ("no", "false", "f", "n", "0"):
        return False
    raise ValueError(f"not a boolean: {value!r}")


def as_list(value: str) -> list[str]:
    """Command-line lists: comma separated."""
    return value.split(",")
