"""Ranked text search on Spark."""

from quillrank.plans.rank import rank_documents

__all__ = ["rank_documents"]
