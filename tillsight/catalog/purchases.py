"""The events of the test tables as purchases, for the stream queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def events_as_purchases(events: DataFrame) -> DataFrame:
    """The ``events`` table in the columns of the purchase stream."""
    return events.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("event_time"),
        F.col("user_id").alias("customer_id"),
        (F.lit(18) + F.col("user_id") % 53).cast("int").alias("age"),
        F.when(F.col("user_id") % 2 == 0, "Female").otherwise("Male").alias("gender"),
        F.concat(F.lit("item-"), (F.col("event_id") % 25).cast("string")).alias("item_purchased"),
        F.col("event_type").alias("category"),
        F.col("value").cast("decimal(12,2)").alias("purchase_amount"),
        ((F.lit(25) + F.col("event_id") % 26).cast("double") / 10).cast("decimal(2,1)").alias("review_rating"),
        F.when(F.col("user_id") % 4 == 0, "Yes").otherwise("No").alias("subscription_status"),
        F.when(F.col("event_id") % 3 == 0, "Yes").otherwise("No").alias("discount_applied"),
        (F.col("user_id") % 50).cast("int").alias("previous_purchases"),
        F.col("event_type").alias("payment_method"),
    )


def with_missing_values(purchases: DataFrame) -> DataFrame:
    """Purchases with gaps and a given processing time, for the quality figures."""
    return purchases.withColumns(
        {
            "purchase_amount": F.when(F.col("event_id") % 17 != 0, F.col("purchase_amount")),
            "age": F.when(F.col("event_id") % 23 != 0, F.col("age")),
            "processing_time": F.col("event_time") + F.make_dt_interval(secs=F.col("event_id") % 7),
        }
    )
