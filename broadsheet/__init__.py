"""Mail to news digests on Spark: extraction, deduplication, placement, assembly."""

from .config import DigestConfig, DigestError, SimilarityConfig
from .operators.scoring import CallProvider, ScoreProvider, score
from .plans.daily import Run, deliver_to, run
from .session import get_session

__all__ = [
    "CallProvider", "DigestConfig", "DigestError", "Run", "ScoreProvider", "SimilarityConfig", "deliver_to", "get_session", "run", "score",
]
