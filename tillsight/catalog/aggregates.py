"""Aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.bands import AGE_DECADES, bucketize
from ..functions.numeric import count_where, exact_mean, mean, round_half_up, sample_stddev, total
from ..operators.ordering import exact_quantiles
from ..sources.retail import retail, table
from ..sources.shared import materialize
from .registry import DECADES, avg, big, on_retail, quantile, query, rnd, sd, tot

AMOUNT = "purchase_amount"
_SUITE = (
    f"COUNT(*) AS n, {tot(AMOUNT)} AS sum_amount, {avg(AMOUNT)} AS avg_amount, "
    f"CAST(MIN({AMOUNT}) AS DOUBLE) AS min_amount, CAST(MAX({AMOUNT}) AS DOUBLE) AS max_amount"
)


def _suite():
    return [
        F.count("*").alias("n"),
        total(AMOUNT).alias("sum_amount"),
        mean(AMOUNT).alias("avg_amount"),
        F.min(AMOUNT).cast("double").alias("min_amount"),
        F.max(AMOUNT).cast("double").alias("max_amount"),
    ]


@query("agg_global", on_retail(f"SELECT {_SUITE}, {sd(AMOUNT)} AS stddev_amount FROM retail"))
def agg_global(spark, sf_dir):
    return retail(spark, sf_dir).agg(*_suite(), sample_stddev(AMOUNT).alias("stddev_amount"))


@query("agg_one_key", on_retail(f"SELECT color, {_SUITE} FROM retail GROUP BY color"))
def agg_one_key(spark, sf_dir):
    return retail(spark, sf_dir).groupBy("color").agg(*_suite())


@query("agg_multi_key", on_retail(f"SELECT season, category, gender, {_SUITE} FROM retail GROUP BY 1, 2, 3"))
def agg_multi_key(spark, sf_dir):
    return retail(spark, sf_dir).groupBy("season", "category", "gender").agg(*_suite())


@query("agg_by_expression", on_retail(f"SELECT {DECADES} AS age_group, {_SUITE} FROM retail GROUP BY 1"))
def agg_by_expression(spark, sf_dir):
    return retail(spark, sf_dir).groupBy(bucketize("age", AGE_DECADES).alias("age_group")).agg(*_suite())


@query(
    "agg_numeric_suite",
    "SELECT l_returnflag, l_linestatus, COUNT(*) AS n, SUM(l_quantity) AS sum_quantity, MIN(l_quantity) AS min_quantity, "
    f"MAX(l_quantity) AS max_quantity, {rnd('(SUM(l_quantity) / COUNT(l_quantity))')} AS avg_quantity FROM lineitem GROUP BY 1, 2",
)
def agg_numeric_suite(spark, sf_dir):
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.count("*").alias("n"),
            F.sum("l_quantity").alias("sum_quantity"),
            F.min("l_quantity").alias("min_quantity"),
            F.max("l_quantity").alias("max_quantity"),
            mean("l_quantity").alias("avg_quantity"),
        )
    )


@query("agg_stddev", on_retail(f"SELECT location, {sd(AMOUNT)} AS stddev_amount, {sd('age')} AS stddev_age FROM retail GROUP BY 1"))
def agg_stddev(spark, sf_dir):
    return (
        retail(spark, sf_dir)
        .groupBy("location")
        .agg(sample_stddev(AMOUNT).alias("stddev_amount"), sample_stddev("age").alias("stddev_age"))
    )


@query(
    "agg_median",
    on_retail(
        f"SELECT category, {rnd('median')} AS median_amount FROM ({quantile('retail', 'category', AMOUNT, {'median': 0.5})})"
    ),
)
def agg_median(spark, sf_dir):
    amounts = materialize(retail(spark, sf_dir).select("category", AMOUNT))
    medians = exact_quantiles(amounts, ["category"], AMOUNT, {"median": 0.5})
    return medians.select("category", round_half_up("median").alias("median_amount"))


@query(
    "agg_count_if",
    on_retail("SELECT category, COUNT(CASE WHEN subscription_status = 'Yes' THEN 1 END) AS subscribers FROM retail GROUP BY 1"),
)
def agg_count_if(spark, sf_dir):
    return (
        retail(spark, sf_dir)
        .groupBy("category")
        .agg(count_where(F.col("subscription_status") == "Yes").alias("subscribers"))
    )


@query(
    "agg_sum_if",
    on_retail(
        f"SELECT category, {big('SUM(CASE WHEN purchase_amount >= 60000 THEN 1 ELSE 0 END)')} AS premium FROM retail GROUP BY 1"
    ),
)
def agg_sum_if(spark, sf_dir):
    return (
        retail(spark, sf_dir)
        .groupBy("category")
        .agg(F.sum((F.col(AMOUNT) >= 60_000).cast("int")).alias("premium"))
    )


@query(
    "agg_count_distinct",
    on_retail(
        "SELECT season, COUNT(DISTINCT customer_id) AS customers, COUNT(DISTINCT item_purchased) AS items, "
        "COUNT(DISTINCT order_id) AS orders FROM retail GROUP BY 1"
    ),
)
def agg_count_distinct(spark, sf_dir):
    return (
        retail(spark, sf_dir)
        .groupBy("season")
        .agg(
            F.count_distinct("customer_id").alias("customers"),
            F.count_distinct("item_purchased").alias("items"),
            F.count_distinct("order_id").alias("orders"),
        )
    )


@query("agg_approx_distinct")
def agg_approx_distinct(spark, sf_dir):
    return retail(spark, sf_dir).groupBy("season").agg(F.approx_count_distinct("customer_id").alias("customers"))


@query("agg_approx_distinct_rules", on_retail("SELECT season, TRUE AS near FROM retail GROUP BY 1"))
def agg_approx_distinct_rules(spark, sf_dir):
    """Whether the approximate count is within three of its standard errors of the exact one."""
    exact = retail(spark, sf_dir).groupBy("season").agg(F.count_distinct("customer_id").alias("exact"))
    gap = F.abs(F.col("customers") - F.col("exact"))
    return agg_approx_distinct(spark, sf_dir).join(exact, "season").select(
        "season", (gap <= F.col("exact") * 0.15).alias("near")
    )


@query(
    "agg_max_string",
    on_retail("SELECT customer_id, MAX(discount_applied) AS any_discount, MAX(season) AS last_season FROM retail GROUP BY 1"),
)
def agg_max_string(spark, sf_dir):
    return (
        retail(spark, sf_dir)
        .groupBy("customer_id")
        .agg(F.max("discount_applied").alias("any_discount"), F.max("season").alias("last_season"))
    )


@query(
    "agg_two_level",
    on_retail(
        f"SELECT location, {rnd('AVG(a)', 2)} AS mean_of_means FROM "
        f"(SELECT location, category, {avg(AMOUNT, None)} AS a FROM retail GROUP BY 1, 2) GROUP BY location"
    ),
)
def agg_two_level(spark, sf_dir):
    return (
        retail(spark, sf_dir)
        .groupBy("location", "category")
        .agg(exact_mean(AMOUNT).alias("a"))
        .groupBy("location")
        .agg(round_half_up(F.avg("a")).alias("mean_of_means"))
    )
