"""Every operator as a named query over the benchmark tables."""

from ledgerline.plans import alerts, drift, followups, gold, history, layout, progress, rows, running, streams, tables, watching
from ledgerline.plans.registry import QUERIES

__all__ = ["QUERIES", "alerts", "drift", "followups", "gold", "history", "layout", "progress", "rows", "running", "streams", "tables", "watching"]
