"""Spark-native analytics for a loan book held as periodic snapshots."""

from loanlens.session import build_session, configure

__all__ = ["build_session", "configure"]
