"""Exploratory frames: distributions and means over one or two dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.bands import AGE_DECADES, AGE_FIVE, AGE_FIVE_OPEN, LOYALTY_SEGMENTS, band_order, bucketize
from ..functions.numeric import mean, sample_stddev, total
from ..operators.ranking import order_by_labels, share_in_group, top_rows

AMOUNT = "purchase_amount"


def breakdown(df: DataFrame, keys: list[str | Column], count_as: str, **measures: Column) -> DataFrame:
    """Rows per key combination and further aggregates."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_as), *[c.alias(n) for n, c in measures.items()])


def _by_size(df: DataFrame, count: str, *keys: str) -> DataFrame:
    return df.orderBy(F.desc(count), *keys)


def _with_share(df: DataFrame, count: str) -> DataFrame:
    return share_in_group(df, [], count, "percentage")


def age_stats(r: DataFrame) -> DataFrame:
    return r.agg(
        mean("age").alias("avg_age"),
        F.min("age").alias("min_age"),
        F.max("age").alias("max_age"),
        sample_stddev("age").alias("stddev_age"),
    )


def age_groups(r: DataFrame) -> DataFrame:
    out = breakdown(r, [bucketize("age", AGE_FIVE).alias("age_group")], "customer_count")
    return _with_share(out, "customer_count").orderBy("age_group")


def gender(r: DataFrame) -> DataFrame:
    return _by_size(_with_share(breakdown(r, ["gender"], "count"), "count"), "count", "gender")


def top_locations(r: DataFrame, n: int = 10) -> DataFrame:
    return top_rows(breakdown(r, ["location"], "customer_count"), [F.desc("customer_count"), "location"], n)


def revenue_metrics(r: DataFrame) -> DataFrame:
    return r.agg(
        mean(AMOUNT).alias("avg_purchase"),
        F.min(AMOUNT).cast("double").alias("min_purchase"),
        F.max(AMOUNT).cast("double").alias("max_purchase"),
        sample_stddev(AMOUNT).alias("stddev_purchase"),
        total(AMOUNT).alias("total_revenue"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.count(F.lit(1)).alias("total_transactions"),
    )


def category_revenue(r: DataFrame) -> DataFrame:
    out = breakdown(r, ["category"], "purchase_count", avg_amount=mean(AMOUNT), total_revenue=total(AMOUNT))
    return _by_size(out, "total_revenue", "category")


def top_items(r: DataFrame, n: int = 15) -> DataFrame:
    out = breakdown(r, ["item_purchased", "category"], "purchase_count", avg_price=mean(AMOUNT))
    return top_rows(out, [F.desc("purchase_count"), "item_purchased", "category"], n)


def frequency(r: DataFrame) -> DataFrame:
    out = breakdown(r, ["frequency_of_purchases"], "customer_count", avg_purchase_amount=mean(AMOUNT))
    return _by_size(out, "customer_count", "frequency_of_purchases")


def payment(r: DataFrame) -> DataFrame:
    out = breakdown(r, ["payment_method"], "transaction_count", avg_amount=mean(AMOUNT))
    return _by_size(_with_share(out, "transaction_count"), "transaction_count", "payment_method")


def shipping(r: DataFrame) -> DataFrame:
    out = breakdown(r, ["shipping_type"], "order_count")
    return _by_size(_with_share(out, "order_count"), "order_count", "shipping_type")


def discount(r: DataFrame) -> DataFrame:
    out = breakdown(r, ["discount_applied", "promo_code_used"], "count", avg_purchase=mean(AMOUNT))
    return _by_size(out, "count", "discount_applied", "promo_code_used")


def subscription(r: DataFrame) -> DataFrame:
    out = breakdown(
        r,
        ["subscription_status"],
        "customer_count",
        avg_purchase=mean(AMOUNT),
        avg_previous_purchases=mean("previous_purchases"),
    )
    return _by_size(out, "customer_count", "subscription_status")


def subscription_impact(r: DataFrame) -> DataFrame:
    return breakdown(
        r,
        ["subscription_status"],
        "customer_count",
        avg_purchase=mean(AMOUNT),
        avg_previous_purchases=mean("previous_purchases"),
        avg_rating=mean("review_rating"),
    )


def loyalty(r: DataFrame) -> DataFrame:
    segment = bucketize("previous_purchases", LOYALTY_SEGMENTS).alias("customer_segment")
    out = breakdown(r, [segment], "customer_count", avg_purchase=mean(AMOUNT))
    return order_by_labels(out, band_order("customer_segment", LOYALTY_SEGMENTS))


def rating(r: DataFrame) -> DataFrame:
    return _with_share(breakdown(r, ["review_rating"], "count"), "count").orderBy(F.desc("review_rating"))


def season_sales(r: DataFrame) -> DataFrame:
    out = breakdown(r, ["season"], "purchase_count", avg_purchase=mean(AMOUNT), total_revenue=total(AMOUNT))
    return _by_size(out, "total_revenue", "season")


def season_category(r: DataFrame) -> DataFrame:
    return breakdown(r, ["season", "category"], "purchase_count").orderBy(
        "season", F.desc("purchase_count"), "category"
    )


def age_gender(r: DataFrame) -> DataFrame:
    group = bucketize("age", AGE_FIVE_OPEN).alias("age_group")
    return breakdown(r, [group, "gender"], "count", avg_purchase=mean(AMOUNT)).orderBy("age_group", "gender")


def color_size(r: DataFrame, n: int = 15) -> DataFrame:
    return top_rows(breakdown(r, ["color", "size"], "count"), [F.desc("count"), "color", "size"], n)


def summary(r: DataFrame) -> DataFrame:
    return r.agg(
        F.count_distinct("customer_id").alias("total_customers"),
        F.count(F.lit(1)).alias("total_transactions"),
        total(AMOUNT).alias("total_revenue"),
        mean(AMOUNT).alias("avg_transaction_value"),
        mean("age", 1).alias("avg_customer_age"),
        mean("review_rating").alias("avg_rating"),
        F.count_distinct("category").alias("total_categories"),
        F.count_distinct("item_purchased").alias("total_unique_items"),
    )


def category_counts(r: DataFrame) -> DataFrame:
    return _by_size(breakdown(r, ["category"], "count"), "count", "category")


def age_decades(r: DataFrame) -> DataFrame:
    group = bucketize("age", AGE_DECADES).alias("age_group")
    out = breakdown(r, [group], "customer_count", avg_purchase=mean(AMOUNT))
    return order_by_labels(out, band_order("age_group", AGE_DECADES))


def gender_revenue(r: DataFrame) -> DataFrame:
    out = breakdown(r, ["gender"], "total_purchases", avg_purchase=mean(AMOUNT), total_spent=total(AMOUNT))
    return _by_size(out, "total_spent", "gender")
