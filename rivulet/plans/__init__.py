"""Registered queries, one per operator, with the SQL they are checked against."""

import importlib

from rivulet.plans.registry import ORACLES, QUERIES

for _module in ("q_sources", "q_shaping", "q_scalars", "q_scores", "q_stats", "q_joins", "q_forecast",
                "q_text"):
    importlib.import_module(f"rivulet.plans.{_module}")

__all__ = ["ORACLES", "QUERIES"]
