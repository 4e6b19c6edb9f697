"""Spark-native preparation, rule scoring and evaluation of financial decision data."""

from ledgerloom.session import build_session, checkpointed

__all__ = ["build_session", "checkpointed"]
