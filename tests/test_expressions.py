import pytest
from pyspark.sql import functions as F

from tillsight.functions.bands import (
    AGE_DECADES,
    AGE_FIVE,
    AGE_FIVE_OPEN,
    AGE_GENERATIONS,
    LOYALTY_SEGMENTS,
    band_order,
    bucketize,
    loyalty_tier,
)
from tillsight.functions.numeric import exact_mean, percent, ratio, relative_difference, round_half_up, sample_stddev
from tillsight.functions.rules import LiftLimits, affinity_strength, classify_anomaly, value_segment


def _labels(spark, bands, values):
    df = spark.createDataFrame([(v,) for v in values], "x INT")
    return [r[0] for r in df.select(bucketize("x", bands)).collect()]


@pytest.mark.parametrize(
    "bands, null_label",
    [(AGE_GENERATIONS, "65+ (Seniors)"), (AGE_FIVE, None), (AGE_FIVE_OPEN, "55+"), (AGE_DECADES, None)],
)
def test_missing_age(spark, bands, null_label):
    assert _labels(spark, bands, [None]) == [null_label]


def test_age_edges(spark):
    edges = [17, 24, 25, 34, 35, 54, 55, 64, 65, 70]
    assert _labels(spark, AGE_GENERATIONS, edges) == [
        "18-24 (Gen Z)",
        "18-24 (Gen Z)",
        "25-34 (Millennials)",
        "25-34 (Millennials)",
        "35-44 (Gen X)",
        "45-54 (Gen X)",
        "55-64 (Boomers)",
        "55-64 (Boomers)",
        "65+ (Seniors)",
        "65+ (Seniors)",
    ]
    assert _labels(spark, AGE_FIVE, edges)[-4:] == ["55+"] * 4
    assert _labels(spark, AGE_DECADES, [19, 20, 59, 60]) == ["Under 20", "20-29", "50-59", "60+"]


def test_loyalty_edges(spark):
    values = [None, -1, 0, 1, 10, 11, 25, 26]
    assert _labels(spark, LOYALTY_SEGMENTS, values) == [
        None,
        None,
        "New Customer",
        "Regular (1-10)",
        "Regular (1-10)",
        "Loyal (11-25)",
        "Loyal (11-25)",
        "VIP (25+)",
    ]
    df = spark.createDataFrame([(v,) for v in values], "x INT")
    assert [r[0] for r in df.select(loyalty_tier("x")).collect()] == [
        "VIP",
        "Regular",
        "New",
        "Regular",
        "Regular",
        "Loyal",
        "Loyal",
        "VIP",
    ]


def test_band_order(spark):
    df = spark.createDataFrame([("VIP (25+)",), ("New Customer",), (None,)], "s STRING")
    assert [r[0] for r in df.select(band_order("s", LOYALTY_SEGMENTS)).collect()] == [4, 1, None]


def test_anomaly_precedence(spark):
    cases = [(90, 70, 40), (20, 70, 0), (20, 30, 40), (50, 30, 40), (50, 30, 0), (None, None, None)]
    df = spark.createDataFrame(cases, "a INT, b INT, c INT")
    got = [r[0] for r in df.select(classify_anomaly(F.col("a"), F.col("b"), F.col("c"))).collect()]
    assert got == ["HIGH_PURCHASE", "SENIOR_BUYER", "LOW_PURCHASE", "SUPER_LOYAL", "NORMAL", "NORMAL"]


def test_affinity_strength(spark):
    df = spark.createDataFrame([(1.6,), (1.5,), (1.2,), (1.0,), (0.4,)], "x DOUBLE")
    got = [r[0].split()[0] for r in df.select(affinity_strength(F.col("x"), LiftLimits())).collect()]
    assert got == ["Strong", "Moderate", "Weak", "Negative", "Negative"]


def test_value_segment_first_match(spark):
    cases = [(4, 4, 1), (4, 1, 4), (1, 4, 4), (1, 1, 4), (1, 1, 1), (2, 1, 1)]
    df = spark.createDataFrame(cases, "v INT, f INT, l INT")
    got = [r[0] for r in df.select(value_segment(F.col("v"), F.col("f"), F.col("l"))).collect()]
    assert got == [
        "VIP Champions",
        "High Spenders",
        "Frequent Buyers",
        "Loyal Customers",
        "At Risk",
        "Regular Customers",
    ]


def test_rounding_and_zero_denominators(spark):
    df = spark.createDataFrame([(1.5, 0.0), (-1.5, None), (0.25, 2.0), (None, 1.0)], "x DOUBLE, d DOUBLE")
    assert [r[0] for r in df.select(round_half_up("x", 0)).collect()] == [2.0, -2.0, 0.0, None]
    assert [r[0] for r in df.select(round_half_up(F.col("x"), 1)).collect()] == [1.5, -1.5, 0.3, None]
    assert [r[0] for r in df.select(ratio("x", "d")).collect()] == [None, None, 0.125, None]
    assert [r[0] for r in df.select(percent(F.col("x"), F.col("d"))).collect()] == [None, None, 12.5, None]
    assert [r[0] for r in df.select(relative_difference("x", "d")).collect()] == [None, None, -87.5, None]


def test_small_groups(spark):
    one = spark.createDataFrame([(5,)], "x INT")
    assert tuple(one.agg(sample_stddev("x"), exact_mean("x")).first()) == (None, 5.0)
    assert tuple(one.where("x > 9").agg(sample_stddev("x"), exact_mean("x")).first()) == (None, None)


def test_payment_report_keeps_rows_without_amount_or_method(spark):
    from tillsight.plans.reports import payment_performance

    kinds = "payment_method string, purchase_amount decimal(12,2), review_rating decimal(2,1), age int, subscription_status string"
    from decimal import Decimal

    rows = [("a", Decimal("10.00")), ("a", None), ("b", None), (None, Decimal("5.00"))]
    df = spark.createDataFrame([(m, x, None, 30, "Yes") for m, x in rows], kinds)
    found = {r.payment_method: r for r in payment_performance(df).collect()}
    assert {m: r.transaction_count for m, r in found.items()} == {"a": 2, "b": 1, None: 1}
    assert (found["a"].market_share, found[None].median_purchase, found["b"].median_purchase) == (50.0, 5.0, None)
    big = [("a", Decimal(1_000_000_000) + Decimal(i) / 100, None, 30, "Yes") for i in range(1000)]
    assert payment_performance(spark.createDataFrame(big, kinds)).first().stddev == 2.89
