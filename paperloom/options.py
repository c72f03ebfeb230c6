"""Thresholds of the operators, with their defaults."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class FormOptions:
    # Document frequency floor, its least, similarity threshold, least corpus, lines of a page header.
    floor_fraction: float = 0.025
    floor_least: int = 2
    threshold: float = 0.55
    least_corpus: int = 40
    header_lines: int = 8
    # Letters of a joined word, its most parts, letters of a part; share of a form's members for its words.
    joined_letters: int = 12
    most_parts: int = 6
    least_part: int = 3
    inside_share: float = 0.4
    samples: int = 5
    seed: int = 0


@dataclass(frozen=True)
class ReadingOptions:
    # Readings and pictures of a batch; characters from which a scan's text stands in for its pictures.
    batch_size: int = 20
    most_images: int = 12
    ocr_chars: int = 120
    letters_per_page: int = 40


@dataclass(frozen=True)
class AnswerOptions:
    # Least confidence, least length of a quote, lengths of a title and a description, share kept of a cut.
    floor: float = 0.7
    least_quote: int = 12
    title: int = 120
    description: int = 600
    back_off: float = 0.6
    # Name similarity that is a match, how many nearest are kept, least ratio of a near miss.
    name_match: float = 0.6
    nearest: int = 3
    near_miss: float = 0.8


@dataclass(frozen=True)
class ReviewOptions:
    # Marks that fail a form; shares of a separating word; steps of a separating threshold; block sizes.
    fail: float = 0.25
    present: float = 0.8
    absent: float = 0.2
    ladder: tuple[float, ...] = (0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9)
    random: int = 8
    suspect: int = 6
    filled: int = 4


# Floors and thresholds of the sweep.
SWEEP_FLOORS = (0.01, 0.02, 0.025, 0.05, 0.1)
SWEEP_THRESHOLDS = (0.35, 0.45, 0.55, 0.65)
# Kinds of exceptions.
EXCEPTIONS = ("unbranched", "unidentified", "unmatched", "ambiguous", "archived", "unreadable")
