"""User-facing settings; every clock is passed in as an argument instead."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class DigestConfig:
    max_items_per_category: int = 10
    enable_executive_summary: bool = True
    fallback_to_keywords: bool = True
    custom_categories: tuple[str, ...] = field(default_factory=tuple)
    theme: str = "light"


@dataclass(frozen=True)
class SimilarityConfig:
    """Jaccard threshold as the integer ratio ``num/den`` over word shingles."""

    num: int = 8
    den: int = 10
    width: int = 3
    # A shingle shared by more stories than this is linked through leaders
    # instead of pair by pair.
    posting_limit: int = 100
    leader_rounds: int = 4
    # Leaders per shingle in every round after the first, which has one.
    leaders: int = 8


class DigestError(Exception):
    """Raised when a digest cannot be built under the given settings."""
