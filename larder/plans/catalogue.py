"""All registered catalogue queries and their SQL."""

from __future__ import annotations

from larder.plans import enrichment, jobs, ladders, layers, matching, outcomes, pages, parsing, rules, screens, stats, votes

_ALL = {**stats.QUERIES, **parsing.QUERIES, **matching.QUERIES, **votes.QUERIES, **jobs.QUERIES, **enrichment.QUERIES, **screens.QUERIES, **rules.QUERIES, **pages.QUERIES, **layers.QUERIES, **ladders.QUERIES, **outcomes.QUERIES}


def queries() -> dict:
    return {name: query for name, (query, _) in _ALL.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _ALL.items() if sql}
