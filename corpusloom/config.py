"""Settings of the engine."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class QaThresholds:
    """Limits of the suspicion score and of the high-confidence class."""

    min_source_chars: int = 40
    min_char_ratio: float = 0.45
    max_char_ratio: float = 2.35
    min_word_ratio: float = 0.45
    max_word_ratio: float = 2.35
    max_english_ratio: float = 0.35
    long_text: int = 5000
    long_abs_tolerance: int = 1200
    long_rel_tolerance: float = 0.18
    long_min_char_ratio: float = 0.18
    long_max_char_ratio: float = 3.5
    max_anchor_miss: float = 0.45
    sure_char_ratio: float = 0.28
    sure_word_ratio: float = 0.30
    sure_sentence_ratio: float = 0.34
    sure_min_chars: int = 120
    sure_min_words: int = 25


@dataclass(frozen=True)
class TranslateConfig:
    """How rows are sent to the model and rescued."""

    batch_size: int = 8
    min_batch_size: int = 1
    chunk_chars: int = 500
    min_chunk_chars: int = 80
    source_locale: str = "en-US"
    target_locale: str = "es-ES"
    response_format: str = "csv"
    model: str = "gemma3:4b"
    timeout_s: float = 120.0
    sleep_s: float = 0.5
    skip_unrecoverable: bool = False
