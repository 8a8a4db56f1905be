"""Barloom: market-panel analytics as PySpark DataFrame jobs."""

from barloom.config import BacktestConfig, GraphConfig, PAPER_GRAPH
from barloom.session import build_session, stage

__all__ = ["BacktestConfig", "GraphConfig", "PAPER_GRAPH", "build_session", "stage"]
