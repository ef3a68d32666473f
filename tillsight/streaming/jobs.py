"""The stream queries: from an unbounded purchase frame to an unbounded result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import count_where, exact_mean, mean, percent, round_half_up, share_where, total
from ..functions.rules import AnomalyLimits, classify_anomaly, derived_features

AMOUNT = "purchase_amount"
PREMIUM = 60  # fixed value: purchases from this amount on count as premium
#: Size of a customer sketch, as a power of two: about 0.8 % error, and next to none below a thousand customers.
SKETCH = 14


def _bounds(df: DataFrame, *rest: str) -> DataFrame:
    return df.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rest)


def _customers() -> Column:
    return F.hll_sketch_agg("customer_id", F.lit(SKETCH))


def _estimated(df: DataFrame, keep_sketch: bool) -> DataFrame:
    """``unique_customers`` from the sketch, which stays only if asked for."""
    counted = df.withColumn("unique_customers", F.hll_sketch_estimate("customers_sketch"))
    return counted if keep_sketch else counted.drop("customers_sketch")


def customers_over(rows: DataFrame, window: str, *keys: str) -> DataFrame:
    """Distinct customers per coarser window from the sketches of finer ones: nothing is counted again."""
    merged = rows.groupBy(F.window("window_start", window), *keys).agg(F.hll_union_agg("customers_sketch").alias("customers_sketch"))
    return _estimated(_bounds(merged, *keys, "customers_sketch"), True)


def category_performance(df: DataFrame, window: str = "1 minute", keep_sketch: bool = False) -> DataFrame:
    """Sales per tumbling window and category, with distinct customers from a mergeable sketch."""
    aggs = [
        F.count(F.lit(1)).alias("transaction_count"),
        total(AMOUNT).alias("total_revenue"),
        mean(AMOUNT).alias("avg_purchase"),
        mean("age", 1).alias("avg_age"),
        mean("review_rating").alias("avg_rating"),
        _customers().alias("customers_sketch"),
    ]
    columns = ["category", "transaction_count", "total_revenue", "avg_purchase", "avg_age", "avg_rating", "customers_sketch"]
    return _estimated(_bounds(df.groupBy(F.window("event_time", window), "category").agg(*aggs), *columns), keep_sketch)


def live_kpis(
    df: DataFrame,
    window: str = "1 minute",
    payment_shares: dict[str, str] | None = None,
    premium: float = PREMIUM,
    keep_sketch: bool = False,
) -> DataFrame:
    """Key figures per tumbling window; ``payment_shares`` maps an output column to a method."""
    shares = payment_shares or {"credit_card_pct": "Credit Card", "paypal_pct": "PayPal"}
    named = {
        "total_transactions": F.count(F.lit(1)),
        "total_revenue": total(AMOUNT),
        "avg_order_value": mean(AMOUNT),
        "avg_rating": mean("review_rating"),
        **{out: share_where(F.col("payment_method") == method, 1) for out, method in shares.items()},
        "subscriber_rate": share_where(F.col("subscription_status") == "Yes", 1),
        "premium_rate": share_where(F.col(AMOUNT) >= premium, 1),
        "customers_sketch": _customers(),
    }
    grouped = df.groupBy(F.window("event_time", window)).agg(*[c.alias(n) for n, c in named.items()])
    return _estimated(_bounds(grouped, *named), keep_sketch)


def customer_behavior(df: DataFrame, window: str = "2 minutes", premium: float = PREMIUM) -> DataFrame:
    """Spending per tumbling window, age group and gender."""
    named = {
        "customer_count": F.count(F.lit(1)),
        "total_spent": total(AMOUNT),
        "avg_spent": mean(AMOUNT),
        "avg_rating": mean("review_rating"),
        "avg_loyalty": mean("previous_purchases", 1),
        "premium_rate": share_where(F.col(AMOUNT) >= premium, 1),
    }
    grouped = (
        df.withColumns(derived_features())
        .groupBy(F.window("event_time", window), "age_group", "gender")
        .agg(*[c.alias(n) for n, c in named.items()])
    )
    return _bounds(grouped, "age_group", "gender", *named)


def anomaly_alerts(df: DataFrame, limits: AnomalyLimits = AnomalyLimits()) -> DataFrame:
    """Unusual purchases with the rule they met; no state is kept."""
    kind = classify_anomaly(F.col(AMOUNT), F.col("age"), F.col("previous_purchases"), limits)
    return (
        df.withColumn("anomaly_type", kind)
        .where(F.col("anomaly_type") != "NORMAL")
        .select(  # fixed values: the columns of an alert
            "event_time",
            "customer_id",
            "age",
            "gender",
            "item_purchased",
            "category",
            AMOUNT,
            "previous_purchases",
            "anomaly_type",
        )
    )


def data_quality(df: DataFrame, window: str = "1 minute") -> DataFrame:
    """Missing values and delay per tumbling window of the processing time.

    The caller sets a watermark on ``processing_time``, so that old windows leave the state.
    """
    rows = F.count(F.lit(1))
    age_gaps, amount_gaps = count_where(~F.col("age_valid")), count_where(~F.col("amount_valid"))
    delay = F.unix_timestamp("processing_time") - F.unix_timestamp("event_time")
    grouped = df.groupBy(F.window("processing_time", window)).agg(
        rows.alias("total_records"),
        age_gaps.alias("age_null_count"),
        amount_gaps.alias("amount_null_count"),
        round_half_up(exact_mean(delay), 1).alias("avg_delay_sec"),
        percent(age_gaps, rows).alias("age_null_pct"),
        percent(amount_gaps, rows).alias("amount_null_pct"),
    )
    return _bounds(
        grouped,
        "total_records",
        "age_null_count",
        "amount_null_count",
        "avg_delay_sec",
        "age_null_pct",
        "amount_null_pct",
    )
