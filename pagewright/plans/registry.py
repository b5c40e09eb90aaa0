"""The core's query modules."""

from __future__ import annotations

from pagewright.plans import layout_queries, nested_queries, quote_queries, stage_queries, stats_queries, text_queries


def modules() -> list:
    return [nested_queries, layout_queries, text_queries, stats_queries, quote_queries, stage_queries]
