"""All registered queries."""

from __future__ import annotations

from replygauge.plans import (  # noqa: F401
    certainty_queries,
    policy_queries,
    reply_queries,
    report_queries,
    source_queries,
    stage_queries,
    text_queries,
)
from replygauge.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
