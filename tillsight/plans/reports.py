"""The retail reports.  Each takes a retail frame and returns a DataFrame.

Frames marked *dimension level* hold one row per value of a report dimension (category,
payment method, location); windows over all rows are used on those only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.bands import AGE_GENERATIONS, Bands, bucketize
from ..functions.numeric import (
    count_where,
    exact_mean,
    mean,
    percent,
    ratio,
    ratio_sql,
    relative_difference,
    round_half_up,
    sample_stddev,
    share_where,
    total,
)
from ..functions.rules import LiftLimits, value_segment
from ..operators.basket import affinity
from ..operators.ordering import exact_quantiles, global_ntiles
from ..operators.ranking import first_per_group, share_in_group, top_k_per_group, top_rows
from ..sources.shared import materialize

AMOUNT, RATING, AGE = "purchase_amount", "review_rating", "age"


def _rows() -> Column:
    return F.count(F.lit(1))


def _yes(column: str) -> str:
    return f"{column} = 'Yes'"


def _everything():
    return Window.partitionBy()


def top_categories(retail: DataFrame, k: int = 3, bands: Bands = AGE_GENERATIONS) -> DataFrame:
    """Most bought categories of every age band, with their share of the band."""
    stats = retail.groupBy(bucketize(AGE, bands).alias("age_group"), "category").agg(
        _rows().alias("purchase_count"),
        total(AMOUNT).alias("total_revenue"),
        mean(AMOUNT).alias("avg_purchase"),
        mean(RATING).alias("avg_rating"),
    )
    shared = share_in_group(stats, ["age_group"], "purchase_count", "percentage_of_age_group")
    ranked = top_k_per_group(
        shared, ["age_group"], [F.desc("purchase_count"), "category"], k, out="popularity_rank"
    )
    return ranked.orderBy("age_group", "popularity_rank")


def subscription_frequency(retail: DataFrame, weighted: bool = False) -> DataFrame:
    """Purchase frequencies of subscribers and others, next to the mean of their group.

    The group mean is the plain mean over the frequencies; ``weighted=True`` weighs each
    frequency by its number of purchases.
    """
    detail = retail.groupBy("subscription_status", "frequency_of_purchases").agg(
        _rows().alias("customer_count"),
        exact_mean(AMOUNT).alias("amount"),
        exact_mean("previous_purchases").alias("history"),
        F.sum(AMOUNT).alias("amount_sum"),
        F.sum("previous_purchases").alias("history_sum"),
        mean(RATING).alias("avg_rating"),
        mean(AGE, 1).alias("avg_age"),
    )
    over = "OVER (PARTITION BY subscription_status)"
    rows = f"sum(customer_count) {over}"
    amount = ratio_sql(f"sum(amount_sum) {over}", rows) if weighted else f"avg(amount) {over}"
    history = ratio_sql(f"sum(history_sum) {over}", rows) if weighted else f"avg(history) {over}"
    joined = detail.selectExpr("*", f"{rows} AS group_rows", f"{amount} AS group_amount", f"{history} AS group_history")
    return joined.select(
        "subscription_status",
        "frequency_of_purchases",
        "customer_count",
        percent("customer_count", "group_rows").alias("pct_of_subscribers"),
        round_half_up("amount").alias("avg_purchase_amount"),
        round_half_up("history").alias("avg_historical_purchases"),
        "avg_rating",
        "avg_age",
        round_half_up("group_amount").alias("group_avg_purchase"),
        round_half_up("group_history").alias("group_avg_history"),
    ).orderBy("subscription_status", F.desc("customer_count"), "frequency_of_purchases")


def subscription_summary(retail: DataFrame) -> DataFrame:
    """Purchases, mean amount and mean history by subscription."""
    return (
        retail.groupBy("subscription_status")
        .agg(_rows().alias("customers"), mean(AMOUNT).alias("avg_purchase"), mean("previous_purchases").alias("avg_loyalty"))
        .orderBy(F.desc("subscription_status"))
    )


def discount_promo(retail: DataFrame) -> DataFrame:
    """Discount and promo combinations against purchases made with neither.

    The baseline is one of the groups, so it is read from the grouped result (dimension
    level) and the purchases are scanned once.
    """
    stats = retail.groupBy("discount_applied", "promo_code_used").agg(
        _rows().alias("transaction_count"),
        exact_mean(AMOUNT).alias("amount"),
        F.min(AMOUNT).cast("double").alias("min_purchase"),
        F.max(AMOUNT).cast("double").alias("max_purchase"),
        sample_stddev(AMOUNT).alias("stddev_purchase"),
        total(AMOUNT).alias("total_revenue"),
        mean(RATING).alias("avg_rating"),
        share_where(_yes("subscription_status")).alias("subscriber_rate"),
    )
    neither = (F.col("discount_applied") == "No") & (F.col("promo_code_used") == "No")
    return (
        stats.withColumns(
            {
                "baseline": F.max(F.when(neither, F.col("amount"))).over(_everything()),
                "all_rows": F.sum("transaction_count").over(_everything()),
            }
        )
        .select(
            "discount_applied",
            "promo_code_used",
            "transaction_count",
            round_half_up("amount").alias("avg_purchase"),
            "min_purchase",
            "max_purchase",
            "stddev_purchase",
            "total_revenue",
            "avg_rating",
            "subscriber_rate",
            percent("transaction_count", "all_rows").alias("market_share_pct"),
            relative_difference("amount", "baseline").alias("vs_baseline_pct"),
        )
        .orderBy(F.desc("transaction_count"), "discount_applied", "promo_code_used")
    )


def payment_performance(retail: DataFrame, approximate_median: bool = False) -> DataFrame:
    """Payment methods by spending and popularity, with the exact median by default.

    All purchases count, also those without an amount or a payment method; only the median is
    sought apart, and is NULL where a method has no amounts.  For it several passes read the narrow columns, which
    are stored once.
    """
    if not approximate_median:
        retail = materialize(retail.select("payment_method", AMOUNT, RATING, AGE, "subscription_status"))
    stats = retail.groupBy("payment_method").agg(
        _rows().alias("transaction_count"),
        mean(AMOUNT).alias("avg_purchase"),
        F.min(AMOUNT).cast("double").alias("min_purchase"),
        F.max(AMOUNT).cast("double").alias("max_purchase"),
        sample_stddev(AMOUNT).alias("stddev"),
        total(AMOUNT).alias("total_revenue"),
        mean(RATING).alias("avg_rating"),
        mean(AGE, 1).alias("avg_customer_age"),
        share_where(_yes("subscription_status")).alias("subscriber_rate"),
    )
    if approximate_median:
        medians = retail.groupBy("payment_method").agg(F.percentile_approx(AMOUNT, 0.5).cast("double").alias("median"))
    else:
        medians = exact_quantiles(retail, ["payment_method"], AMOUNT, {"median": 0.5})
    medians = medians.withColumnRenamed("payment_method", "_method")
    stats = stats.join(medians, F.col("payment_method").eqNullSafe(F.col("_method")), "left").drop("_method")
    return (
        share_in_group(stats, [], "transaction_count", "market_share")
        .select(
            "payment_method",
            "transaction_count",
            "avg_purchase",
            round_half_up("median").alias("median_purchase"),
            "min_purchase",
            "max_purchase",
            "stddev",
            "total_revenue",
            "avg_rating",
            "avg_customer_age",
            "subscriber_rate",
            "market_share",
            F.rank().over(Window.orderBy(F.desc("avg_purchase"))).alias("spending_rank"),
            F.rank().over(Window.orderBy(F.desc("transaction_count"))).alias("popularity_rank"),
        )
        .orderBy(F.desc("avg_purchase"), "payment_method")
    )


def seasonal_categories(retail: DataFrame, k: int = 3) -> DataFrame:
    """Categories with the highest revenue in each season."""
    stats = retail.groupBy("season", "category").agg(
        _rows().alias("sales_volume"),
        total(AMOUNT).alias("revenue"),
        mean(AMOUNT).alias("avg_price"),
        mean(RATING).alias("avg_rating"),
        share_where(_yes("discount_applied")).alias("discount_rate"),
    )
    shared = share_in_group(stats, ["season"], "sales_volume", "pct_of_season")
    ranked = top_k_per_group(shared, ["season"], [F.desc("revenue")], k, out="revenue_rank", keep_ties=True)
    return ranked.orderBy("season", "revenue_rank", "category")


def customer_metrics(retail: DataFrame) -> DataFrame:
    """One row per customer: purchases, lifetime value and attributes."""
    return retail.groupBy("customer_id").agg(
        _rows().alias("total_transactions"),
        F.sum(AMOUNT).alias("lifetime_value"),
        exact_mean(AMOUNT).alias("avg_transaction"),
        exact_mean(RATING).alias("avg_rating"),
        F.max("gender").alias("gender"),
        F.max(AGE).alias("age"),
        F.max("location").alias("location"),
        F.max("previous_purchases").alias("loyalty_score"),
        F.max("subscription_status").alias("is_subscriber"),
    )


def customer_segments(retail: DataFrame) -> DataFrame:
    """Customer metrics with value, frequency and loyalty quartile and the segment.

    All three quartiles count upwards: 4 is the highest value, frequency and loyalty.
    """
    scored = global_ntiles(
        materialize(customer_metrics(retail)),
        "customer_id",
        {
            "value_quartile": "lifetime_value",
            "frequency_quartile": "total_transactions",
            "loyalty_quartile": "loyalty_score",
        },
    )
    return scored.withColumn(
        "customer_segment",
        value_segment(F.col("value_quartile"), F.col("frequency_quartile"), F.col("loyalty_quartile")),
    )


def lifetime_value(retail: DataFrame) -> DataFrame:
    """Profile and share of revenue of every customer segment."""
    profile = (
        customer_segments(retail)
        .groupBy("customer_segment")
        .agg(
            _rows().alias("customer_count"),
            mean("lifetime_value").alias("avg_lifetime_value"),
            mean("total_transactions", 1).alias("avg_transactions"),
            round_half_up("avg(avg_transaction)").alias("avg_transaction_size"),
            mean(AGE, 1).alias("avg_age"),
            mean("loyalty_score", 1).alias("avg_loyalty_score"),
            round_half_up("avg(avg_rating)").alias("avg_rating"),
            share_where(_yes("is_subscriber")).alias("subscriber_rate"),
            total("lifetime_value").alias("segment_total_value"),
        )
    )
    return share_in_group(profile, [], "segment_total_value", "pct_of_total_revenue").orderBy(
        F.desc("avg_lifetime_value"), "customer_segment"
    )


def shipping_preferences(retail: DataFrame) -> DataFrame:
    """Shipping types by category, next to the plain mean over the categories."""
    detail = retail.groupBy("shipping_type", "category").agg(
        _rows().alias("order_count"),
        exact_mean(AMOUNT).alias("amount"),
        total(AMOUNT).alias("total_revenue"),
        mean(RATING).alias("avg_rating"),
        mean(AGE, 1).alias("avg_customer_age"),
        share_where(_yes("subscription_status")).alias("subscriber_rate"),
        share_where(_yes("discount_applied")).alias("discount_rate"),
    )
    over = "OVER (PARTITION BY shipping_type)"
    joined = detail.selectExpr("*", f"sum(order_count) {over} AS type_rows", f"avg(amount) {over} AS type_amount")
    return joined.select(
        "shipping_type",
        "category",
        "order_count",
        round_half_up("amount").alias("avg_order_value"),
        "total_revenue",
        "avg_rating",
        "avg_customer_age",
        "subscriber_rate",
        "discount_rate",
        percent("order_count", "type_rows").alias("pct_of_shipping_type"),
        round_half_up("type_amount").alias("shipping_type_avg"),
    ).orderBy("shipping_type", F.desc("total_revenue"), "category")


def location_markets(retail: DataFrame, top: int = 20) -> DataFrame:
    """The strongest locations: demographics, leading category and share of all revenue.

    Purchases are summed per location, category and customer once; both the figures of a
    location and its leading category come from that table.
    """
    detail = materialize(
        retail.groupBy("location", "category", "customer_id").agg(
            _rows().alias("n"),
            F.sum(AMOUNT).alias("spent"),
            F.count(AMOUNT).alias("priced"),
            F.sum(AGE).alias("ages"),
            F.count(AGE).alias("aged"),
            F.sum(RATING).alias("ratings"),
            F.count(RATING).alias("rated"),
            F.sum("previous_purchases").alias("history"),
            F.count("previous_purchases").alias("with_history"),
            count_where(_yes("subscription_status")).alias("subscribers"),
            count_where("gender = 'Male'").alias("male"),
            count_where("gender = 'Female'").alias("female"),
        )
    )
    markets = detail.groupBy("location").agg(
        F.count_distinct("customer_id").alias("unique_customers"),
        F.sum("n").alias("total_transactions"),
        total("spent").alias("total_revenue"),
        round_half_up(ratio_sql("sum(spent)", "sum(priced)")).alias("avg_transaction"),
        round_half_up(ratio_sql("sum(ages)", "sum(aged)"), 1).alias("avg_customer_age"),
        round_half_up(ratio_sql("sum(ratings)", "sum(rated)")).alias("avg_rating"),
        percent("sum(subscribers)", "sum(n)").alias("subscription_rate"),
        percent("sum(male)", "sum(n)").alias("male_pct"),
        percent("sum(female)", "sum(n)").alias("female_pct"),
        round_half_up(ratio_sql("sum(history)", "sum(with_history)"), 1).alias("avg_loyalty"),
    )
    leaders = first_per_group(
        detail.groupBy("location", "category").agg(F.sum("n").alias("n")),
        ["location"],
        "category",
        F.struct(-F.col("n"), F.col("category")),
    ).withColumnRenamed("category", "top_category")
    shared = share_in_group(markets, [], "total_revenue", "revenue_market_share")
    joined = shared.join(leaders, "location").withColumn(
        "transactions_per_customer", round_half_up(ratio("total_transactions", "unique_customers"))
    )
    return top_rows(joined, [F.desc("total_revenue"), "location"], top)


def product_affinity(
    retail: DataFrame,
    basket: str = "customer_id",
    item: str = "category",
    min_support: int = 5,
    top: int = 20,
    limits: LiftLimits = LiftLimits(),
) -> DataFrame:
    """Item pairs bought together, strongest lift first."""
    pairs = affinity(retail, basket, item, AMOUNT, min_support, limits)
    return top_rows(pairs, [F.desc("lift"), "item_a", "item_b"], top)
