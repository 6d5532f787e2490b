"""All tunable numbers of the engine in one place."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    # fixed values: windows, thresholds and model parameters of the application
    window_seconds: int = 300
    slide_seconds: int = 1
    share_threshold: float = 0.0025
    small_max_followers: int = 300
    medium_max_followers: int = 1800
    topics: int = 10
    max_iter: int = 100
    min_doc_freq: int = 4
    words_per_topic: int = 10
    tracked_seeds: int | None = None  # all; a remote interface that takes fewer may set a number
    tracked_language: str = "en"
    flush_interval: str = "1 minute"
    run_minutes: int = 3

    # our own choices
    # a fit refuses more words than this: the driver and every task of a fit hold words x topics numbers
    # a few times; a larger min_doc_freq lowers the number of words
    vocabulary_size: int = 1 << 23
    # a message dated this much after its batch is processed goes to quarantine
    future_seconds: int = 300
    # numbers (words x topics) of a weight table that is broadcast to score posts; larger ones are joined
    broadcast_numbers: int = 1 << 25
    # longest tag list written into the plan as literals; longer lists are joined
    inline_list_limit: int = 1000
    # time slice one window task works on; must be at least window_seconds
    chunk_seconds: int = 3600
    watermark: str = "2 minutes"
    watermark_seconds: int = 120
    trigger: str = "1 second"


DEFAULTS = Settings()
