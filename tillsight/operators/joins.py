"""Joins used by the reports and the recommender."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame


def join_rollup(detail: DataFrame, keys: Sequence[str], totals: dict[str, Column]) -> DataFrame:
    """Join an aggregated frame with its own roll-up to fewer keys."""
    rollup = detail.groupBy(*keys).agg(*[c.alias(name) for name, c in totals.items()])
    return detail.join(rollup, list(keys))


def with_baseline(df: DataFrame, **baseline: DataFrame) -> DataFrame:
    """Attach one-row, one-column frames as constant columns.

    Scalar subqueries: Spark evaluates each once and refuses a frame with more than one row.
    """
    return df.withColumns({name: frame.scalar() for name, frame in baseline.items()})


def minus_history(candidates: DataFrame, history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Candidates that do not occur in the history."""
    return candidates.join(history.select(*keys).distinct(), list(keys), "left_anti")


def lookup(df: DataFrame, mapping: DataFrame, key: str) -> DataFrame:
    """Add the columns of a mapping by an equal key; Spark broadcasts the mapping if its bytes are few."""
    return df.join(mapping, key)
