"""Ranks inside groups, shares and top rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.numeric import percent


def _columns(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def number_in_group(df: DataFrame, groups: Sequence[str], order: Sequence[str | Column], out: str = "rn") -> DataFrame:
    """``row_number``; the order must end in a key so that ties have one result."""
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*groups).orderBy(*_columns(order))))


def rank_in_group(df: DataFrame, groups: Sequence[str], order: Sequence[str | Column], out: str = "rank") -> DataFrame:
    """``rank``: equal rows share a rank and leave a gap after it."""
    return df.withColumn(out, F.rank().over(Window.partitionBy(*groups).orderBy(*_columns(order))))


def top_k_per_group(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[str | Column],
    k: int,
    out: str = "rn",
    keep_ties: bool = False,
) -> DataFrame:
    """The first ``k`` rows of every group.

    The limit on the rank reaches the map side (WindowGroupLimit), so a large group
    sends at most ``k`` rows per task through the shuffle.
    """
    rank = rank_in_group if keep_ties else number_in_group
    return rank(df, groups, order, out).where(F.col(out) <= k)


def share_in_group(df: DataFrame, groups: Sequence[str], measure: str, out: str, digits: int = 2) -> DataFrame:
    """Percentage of a measure within its group; no groups means within the whole frame.

    Meant for frames that are aggregated already and hold one row per dimension value.
    """
    whole = F.sum(measure).over(Window.partitionBy(*groups))
    return df.withColumn("_whole", whole).withColumn(out, percent(measure, "_whole", digits)).drop("_whole")


def top_rows(df: DataFrame, order: Sequence[str | Column], n: int) -> DataFrame:
    """Sort and limit; every task keeps ``n`` rows only."""
    return df.orderBy(*_columns(order)).limit(n)


def first_per_group(df: DataFrame, groups: Sequence[str], pick: str, order: Column) -> DataFrame:
    """Top-1 per group as an aggregate: ``pick`` of the row with the smallest ``order``."""
    return df.groupBy(*groups).agg(F.min_by(pick, order).alias(pick))


def order_by_labels(df: DataFrame, position: Column, *rest: str | Column) -> DataFrame:
    """Sort by a computed position, such as the place of a label in a list."""
    return df.orderBy(position.asc_nulls_last(), *_columns(rest))
