"""Turning a number into a labelled band."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class Bands:
    """Ascending exclusive upper bounds and one label per band.

    ``labels`` has one entry more than ``bounds``.  A value below ``floor`` and NULL
    get ``null_label``, which may be None.
    """

    bounds: tuple[int, ...]
    labels: tuple[str, ...]
    null_label: str | None = None
    floor: int | None = None


# Band limits and labels that the reports are known by.
AGE_GENERATIONS = Bands(
    (25, 35, 45, 55, 65),
    ("18-24 (Gen Z)", "25-34 (Millennials)", "35-44 (Gen X)", "45-54 (Gen X)", "55-64 (Boomers)", "65+ (Seniors)"),
    null_label="65+ (Seniors)",
)
AGE_FIVE = Bands((25, 35, 45, 55), ("18-24", "25-34", "35-44", "45-54", "55+"))
AGE_FIVE_OPEN = Bands((25, 35, 45, 55), ("18-24", "25-34", "35-44", "45-54", "55+"), null_label="55+")
AGE_DECADES = Bands((20, 30, 40, 50, 60), ("Under 20", "20-29", "30-39", "40-49", "50-59", "60+"))
LOYALTY_SEGMENTS = Bands(
    (1, 11, 26), ("New Customer", "Regular (1-10)", "Loyal (11-25)", "VIP (25+)"), floor=0
)
PURCHASE_TIERS = Bands((30, 60), ("Budget", "Standard", "Premium"), null_label="Premium")


def bucketize(x: str | Column, bands: Bands) -> Column:
    """Label of the band that holds ``x``."""
    c = F.col(x) if isinstance(x, str) else x
    missing = c.isNull() if bands.floor is None else c.isNull() | (c < bands.floor)
    out = F.when(missing, F.lit(bands.null_label))
    for bound, label in zip(bands.bounds, bands.labels):
        out = out.when(c < bound, label)
    return out.otherwise(bands.labels[-1])


def band_order(label: str | Column, bands: Bands) -> Column:
    """Position of a label in its band list, for sorting; NULL sorts as NULL."""
    c = F.col(label) if isinstance(label, str) else label
    out = F.when(c == bands.labels[0], 1)
    for i, name in enumerate(bands.labels[1:], start=2):
        out = out.when(c == name, i)
    return out


def loyalty_tier(previous: str | Column) -> Column:
    """New, Regular, Loyal or VIP by number of previous purchases; NULL is VIP."""
    c = F.col(previous) if isinstance(previous, str) else previous
    return F.when(c == 0, "New").when(c <= 10, "Regular").when(c <= 25, "Loyal").otherwise("VIP")
