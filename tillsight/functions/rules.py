"""Rule lists whose first matching entry decides."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from .bands import AGE_FIVE_OPEN, PURCHASE_TIERS, bucketize, loyalty_tier
from .numeric import flag


@dataclass(frozen=True)
class AnomalyLimits:
    """The default limits of the anomaly rules."""

    high_amount: float = 90
    senior_age: int = 70
    low_amount: float = 20
    loyal_purchases: int = 40


@dataclass(frozen=True)
class LiftLimits:
    """The default limits of the affinity strength."""

    strong: float = 1.5
    moderate: float = 1.2
    weak: float = 1.0


def classify_anomaly(amount: Column, age: Column, previous: Column, limits: AnomalyLimits = AnomalyLimits()) -> Column:
    """Name of the first anomaly rule that a purchase meets, else ``NORMAL``."""
    return (
        F.when(amount >= limits.high_amount, "HIGH_PURCHASE")
        .when(age >= limits.senior_age, "SENIOR_BUYER")
        .when(amount <= limits.low_amount, "LOW_PURCHASE")
        .when(previous >= limits.loyal_purchases, "SUPER_LOYAL")
        .otherwise("NORMAL")
    )


def affinity_strength(lift: Column, limits: LiftLimits = LiftLimits()) -> Column:
    """Affinity label of an unrounded lift."""
    return (
        F.when(lift > limits.strong, "Strong Affinity")
        .when(lift > limits.moderate, "Moderate Affinity")
        .when(lift > limits.weak, "Weak Affinity")
        .otherwise("Negative Affinity")
    )


def value_segment(value_q: Column, frequency_q: Column, loyalty_q: Column) -> Column:
    """Lifetime-value segment from three ascending quartiles (4 is the highest)."""
    return (
        F.when((value_q == 4) & (frequency_q == 4), "VIP Champions")
        .when(value_q == 4, "High Spenders")
        .when(frequency_q == 4, "Frequent Buyers")
        .when(loyalty_q == 4, "Loyal Customers")
        .when((value_q == 1) & (frequency_q == 1), "At Risk")
        .otherwise("Regular Customers")
    )


def derived_features() -> dict[str, Column]:
    """Feature columns of a retail row, for ``withColumns``."""
    return {
        "age_group": bucketize("age", AGE_FIVE_OPEN),
        "purchase_tier": bucketize("purchase_amount", PURCHASE_TIERS),
        "is_subscriber": flag(F.col("subscription_status") == "Yes"),
        "loyalty_tier": loyalty_tier("previous_purchases"),
        "uses_discount": flag(F.col("discount_applied") == "Yes"),
    }
