"""All named queries."""

from corpuskit.catalogue import analytics, corpus, monitoring, retrieval, streams  # noqa: F401
from corpuskit.catalogue.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
