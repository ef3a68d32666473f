"""Projections, filters, predicates, labels and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.bands import (
    AGE_DECADES,
    AGE_FIVE,
    AGE_FIVE_OPEN,
    AGE_GENERATIONS,
    LOYALTY_SEGMENTS,
    Bands,
    band_order,
    bucketize,
)
from ..functions.numeric import mean, ratio, relative_difference, round_half_up
from ..functions.rules import AnomalyLimits, classify_anomaly, derived_features
from ..operators.ranking import order_by_labels, share_in_group, top_k_per_group
from ..plans.reports import customer_segments
from ..sources.files import normalize_columns
from ..sources.retail import FILE_COLUMN_RENAMES, retail, table, to_display_names
from ..streaming.jobs import anomaly_alerts
from .purchases import events_as_purchases, with_missing_values
from .registry import (
    DECADES,
    FIVE_AGES,
    FIVE_AGES_OPEN,
    LOYALTY,
    SIX_AGES,
    avg,
    on_gappy,
    on_retail,
    pct,
    query,
    rnd,
)

# Limits that suit the amounts of the order tables.
LINE_LIMITS = AnomalyLimits(high_amount=90_000, senior_age=70, low_amount=2_000, loyal_purchases=40)

_ANOMALY = (
    "CASE WHEN purchase_amount >= 90000 THEN 'HIGH_PURCHASE' WHEN age >= 70 THEN 'SENIOR_BUYER' "
    "WHEN purchase_amount <= 2000 THEN 'LOW_PURCHASE' WHEN previous_purchases >= 40 THEN 'SUPER_LOYAL' ELSE 'NORMAL' END"
)


@query(
    "project_alias",
    "SELECT event_id AS event, user_id AS customer, DATE_TRUNC('hour', ts) AS hour_start FROM events",
)
def project_alias(spark, sf_dir):
    hour = F.window("ts", "1 hour")
    return (
        table(spark, sf_dir, "events")
        .select(F.col("event_id").alias("event"), F.col("user_id").alias("customer"), hour.alias("hour"))
        .select("event", "customer", F.col("hour.start").alias("hour_start"))
    )


@query(
    "normalize_columns",
    on_retail(
        "SELECT * REPLACE (CAST(purchase_amount AS DOUBLE) AS purchase_amount, CAST(review_rating AS DOUBLE) AS review_rating) FROM retail"
    ),
)
def normalize(spark, sf_dir):
    named = normalize_columns(to_display_names(retail(spark, sf_dir)), FILE_COLUMN_RENAMES)
    return named.withColumns({c: F.col(c).cast("double") for c in ("purchase_amount", "review_rating")})


def _banded(spark, sf_dir, column: str, bands: Bands, out: str):
    return (
        retail(spark, sf_dir)
        .groupBy(column, bucketize(column, bands).alias(out))
        .agg(F.count("*").alias("n"))
    )


def _banded_sql(column: str, case: str, out: str) -> str:
    return on_retail(f"SELECT {column}, {case} AS {out}, COUNT(*) AS n FROM retail GROUP BY 1, 2")


@query("bucket_age6", _banded_sql("age", SIX_AGES, "age_group"))
def bucket_age6(spark, sf_dir):
    return _banded(spark, sf_dir, "age", AGE_GENERATIONS, "age_group")


@query("bucket_age5", _banded_sql("age", FIVE_AGES, "age_group"))
def bucket_age5(spark, sf_dir):
    return _banded(spark, sf_dir, "age", AGE_FIVE, "age_group")


@query(
    "bucket_age5_df",
    on_gappy(f"SELECT age, {FIVE_AGES_OPEN} AS age_group, COUNT(*) AS n FROM purchases GROUP BY 1, 2"),
)
def bucket_age5_df(spark, sf_dir):
    purchases = with_missing_values(events_as_purchases(table(spark, sf_dir, "events")))
    return purchases.groupBy("age", bucketize("age", AGE_FIVE_OPEN).alias("age_group")).agg(F.count("*").alias("n"))


@query("bucket_age_decade", _banded_sql("age", DECADES, "age_group"))
def bucket_age_decade(spark, sf_dir):
    return _banded(spark, sf_dir, "age", AGE_DECADES, "age_group")


@query("bucket_loyalty_segment", _banded_sql("previous_purchases", LOYALTY, "customer_segment"))
def bucket_loyalty_segment(spark, sf_dir):
    return _banded(spark, sf_dir, "previous_purchases", LOYALTY_SEGMENTS, "customer_segment")


@query(
    "derived_features",
    on_retail(
        f"SELECT order_id, item_purchased, {FIVE_AGES_OPEN} AS age_group, "
        "CASE WHEN purchase_amount < 30 THEN 'Budget' WHEN purchase_amount < 60 THEN 'Standard' ELSE 'Premium' END AS purchase_tier, "
        "CASE WHEN subscription_status = 'Yes' THEN 1 ELSE 0 END AS is_subscriber, "
        "CASE WHEN previous_purchases = 0 THEN 'New' WHEN previous_purchases <= 10 THEN 'Regular' "
        "WHEN previous_purchases <= 25 THEN 'Loyal' ELSE 'VIP' END AS loyalty_tier, "
        "CASE WHEN discount_applied = 'Yes' THEN 1 ELSE 0 END AS uses_discount FROM retail"
    ),
)
def derived(spark, sf_dir):
    features = derived_features()
    return retail(spark, sf_dir).withColumns(features).select("order_id", "item_purchased", *features)


@query(
    "anomaly_classify",
    on_retail(f"SELECT {_ANOMALY} AS anomaly_type, gender, COUNT(*) AS n FROM retail GROUP BY 1, 2"),
)
def anomaly_classify(spark, sf_dir):
    kind = classify_anomaly(F.col("purchase_amount"), F.col("age"), F.col("previous_purchases"), LINE_LIMITS)
    return retail(spark, sf_dir).groupBy(kind.alias("anomaly_type"), "gender").agg(F.count("*").alias("n"))


@query(
    "anomaly_filter",
    on_retail(
        "SELECT order_id, customer_id, age, gender, item_purchased, category, CAST(purchase_amount AS DOUBLE) AS purchase_amount, "
        f"previous_purchases, {_ANOMALY} AS anomaly_type FROM retail WHERE {_ANOMALY} <> 'NORMAL'"
    ),
)
def anomaly_filter(spark, sf_dir):
    alerts = anomaly_alerts(retail(spark, sf_dir).withColumn("event_time", F.col("order_id")), LINE_LIMITS)
    return alerts.withColumnRenamed("event_time", "order_id").withColumn(
        "purchase_amount", F.col("purchase_amount").cast("double")
    )


@query(
    "lookup_entity",
    on_retail(
        "SELECT customer_id, order_id, item_purchased, purchase_amount, age, gender, location FROM (SELECT *, "
        "ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY order_id, item_purchased, purchase_amount) AS rn FROM retail) WHERE rn = 1"
    ),
)
def lookup_entity(spark, sf_dir):
    """The profile row of each customer: the first purchase in a fixed order."""
    first = top_k_per_group(
        retail(spark, sf_dir), ["customer_id"], ["order_id", "item_purchased", "purchase_amount"], 1
    )
    return first.select("customer_id", "order_id", "item_purchased", "purchase_amount", "age", "gender", "location")


@query(
    "filter_baseline",
    on_retail(
        f"SELECT COUNT(*) AS purchases, {avg('purchase_amount')} AS avg_purchase FROM retail "
        "WHERE discount_applied = 'No' AND promo_code_used = 'No'"
    ),
)
def filter_baseline(spark, sf_dir):
    neither = (F.col("discount_applied") == "No") & (F.col("promo_code_used") == "No")
    return (
        retail(spark, sf_dir)
        .where(neither)
        .agg(F.count("*").alias("purchases"), mean("purchase_amount").alias("avg_purchase"))
    )


@query(
    "topk_per_group",
    on_retail(
        "SELECT location, item_purchased, n, CAST(rn AS INT) AS rn FROM (SELECT location, item_purchased, COUNT(*) AS n, ROW_NUMBER() OVER "
        "(PARTITION BY location ORDER BY COUNT(*) DESC, item_purchased) AS rn FROM retail GROUP BY location, item_purchased) WHERE rn <= 5"
    ),
)
def topk_per_group(spark, sf_dir):
    counts = retail(spark, sf_dir).groupBy("location", "item_purchased").agg(F.count("*").alias("n"))
    return top_k_per_group(counts, ["location"], [F.desc("n"), "item_purchased"], 5)


@query(
    "min_support_filter",
    on_retail("SELECT item_purchased, category, COUNT(*) AS n FROM retail GROUP BY 1, 2 HAVING COUNT(*) >= 150"),
)
def min_support_filter(spark, sf_dir):
    counts = retail(spark, sf_dir).groupBy("item_purchased", "category").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= 150)


@query(
    "scenario_override",
    on_retail(
        "SELECT customer_id, 'Winter' AS season, 'No' AS promo_code_used, COUNT(*) AS n FROM retail GROUP BY customer_id"
    ),
)
def scenario_override(spark, sf_dir):
    what_if = retail(spark, sf_dir).withColumns({"season": F.lit("Winter"), "promo_code_used": F.lit("No")})
    return what_if.groupBy("customer_id", "season", "promo_code_used").agg(F.count("*").alias("n"))


@query(
    "pct_of_total",
    on_retail(
        f"SELECT color, COUNT(*) AS n, {pct('COUNT(*)', '(SELECT COUNT(*) FROM retail)')} AS percentage FROM retail GROUP BY color"
    ),
)
def pct_of_total(spark, sf_dir):
    counts = retail(spark, sf_dir).groupBy("color").agg(F.count("*").alias("n"))
    return share_in_group(counts, [], "n", "percentage")


@query(
    "vs_baseline",
    on_retail(
        f"SELECT category, {rnd('((a - b) / b * 1e2)')} AS vs_baseline_pct FROM "
        f"(SELECT category, {avg('purchase_amount', None)} AS a FROM retail GROUP BY category), "
        f"(SELECT {avg('purchase_amount', None)} AS b FROM retail)"
    ),
)
def vs_baseline(spark, sf_dir):
    r = retail(spark, sf_dir)
    sums = r.groupBy("category").agg(F.sum("purchase_amount").alias("s"), F.count("purchase_amount").alias("c"))
    means = sums.select(
        "category", ratio("s", "c").alias("amount"), ratio("sum(s) OVER ()", "sum(c) OVER ()").alias("overall")
    )
    return means.select("category", relative_difference("amount", "overall").alias("vs_baseline_pct"))


@query(
    "clv_segments",
    on_retail(
        "SELECT customer_id, value_quartile, frequency_quartile, loyalty_quartile, "
        "CASE WHEN value_quartile = 4 AND frequency_quartile = 4 THEN 'VIP Champions' WHEN value_quartile = 4 THEN 'High Spenders' "
        "WHEN frequency_quartile = 4 THEN 'Frequent Buyers' WHEN loyalty_quartile = 4 THEN 'Loyal Customers' "
        "WHEN value_quartile = 1 AND frequency_quartile = 1 THEN 'At Risk' ELSE 'Regular Customers' END AS customer_segment "
        "FROM (SELECT customer_id, CAST(NTILE(4) OVER (ORDER BY v, customer_id) AS INT) AS value_quartile, "
        "CAST(NTILE(4) OVER (ORDER BY n, customer_id) AS INT) AS frequency_quartile, "
        "CAST(NTILE(4) OVER (ORDER BY p, customer_id) AS INT) AS loyalty_quartile FROM "
        "(SELECT customer_id, SUM(purchase_amount) AS v, COUNT(*) AS n, MAX(previous_purchases) AS p FROM retail GROUP BY customer_id))"
    ),
)
def clv_segments(spark, sf_dir):
    return customer_segments(retail(spark, sf_dir)).select(
        "customer_id", "value_quartile", "frequency_quartile", "loyalty_quartile", "customer_segment"
    )


@query(
    "order_by_case",
    on_retail(
        "SELECT customer_segment, CASE customer_segment WHEN 'New Customer' THEN 1 WHEN 'Regular (1-10)' THEN 2 "
        "WHEN 'Loyal (11-25)' THEN 3 WHEN 'VIP (25+)' THEN 4 END AS position, customers FROM "
        f"(SELECT {LOYALTY} AS customer_segment, COUNT(DISTINCT customer_id) AS customers FROM retail GROUP BY 1) ORDER BY position"
    ),
)
def order_by_case(spark, sf_dir):
    segment = bucketize("previous_purchases", LOYALTY_SEGMENTS).alias("customer_segment")
    counts = retail(spark, sf_dir).groupBy(segment).agg(F.count_distinct("customer_id").alias("customers"))
    position = band_order("customer_segment", LOYALTY_SEGMENTS)
    return order_by_labels(counts.withColumn("position", position), F.col("position"))


@query(
    "drop_null_rows",
    on_gappy(
        "SELECT * REPLACE (CAST(purchase_amount AS DOUBLE) AS purchase_amount, CAST(review_rating AS DOUBLE) AS review_rating) "
        "FROM purchases WHERE age IS NOT NULL AND purchase_amount IS NOT NULL"
    ),
)
def drop_null_rows(spark, sf_dir):
    purchases = with_missing_values(events_as_purchases(table(spark, sf_dir, "events")))
    times = {c: F.col(c).cast("timestamp_ntz") for c in ("event_time", "processing_time")}
    numbers = {c: F.col(c).cast("double") for c in ("purchase_amount", "review_rating")}
    return purchases.na.drop().withColumns(times | numbers)


@query(
    "scalar_math",
    "SELECT o_orderkey, "
    + rnd("o_totalprice", 1)
    + " AS one_digit, "
    + rnd("(o_totalprice / 7e0)", 2)
    + " AS two_digits, "
    + rnd("(o_totalprice / 1e3)", 3)
    + " AS three_digits, ABS(o_totalprice - 2.5e5) AS distance, o_totalprice BETWEEN 1e5 AND 2e5 AS in_range, "
    "o_totalprice * 2e0 + 1e0 AS linear FROM orders",
)
def scalar_math(spark, sf_dir):
    price = F.col("o_totalprice")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        round_half_up(price, 1).alias("one_digit"),
        round_half_up(price / 7, 2).alias("two_digits"),
        round_half_up(price / 1000, 3).alias("three_digits"),
        F.abs(price - 250_000).alias("distance"),
        price.between(100_000, 200_000).alias("in_range"),
        (price * 2 + 1).alias("linear"),
    )


@query(
    "scalar_time_diff",
    on_gappy(
        "SELECT event_id, CAST(FLOOR(EPOCH(processing_time)) - FLOOR(EPOCH(event_time)) AS BIGINT) AS delay_seconds FROM purchases"
    ),
)
def scalar_time_diff(spark, sf_dir):
    purchases = with_missing_values(events_as_purchases(table(spark, sf_dir, "events")))
    delay = F.unix_timestamp("processing_time") - F.unix_timestamp("event_time")
    return purchases.select("event_id", delay.alias("delay_seconds"))


@query(
    "array_explode_inline",
    on_retail(
        "SELECT customer_id, item_purchased, n FROM (SELECT customer_id, item_purchased, COUNT(*) AS n, ROW_NUMBER() OVER "
        "(PARTITION BY customer_id ORDER BY COUNT(*) DESC, item_purchased) AS rn FROM retail GROUP BY 1, 2) WHERE rn <= 3"
    ),
)
def array_explode_inline(spark, sf_dir):
    """Three favourites per customer as an array of structs, and back to rows."""
    counts = retail(spark, sf_dir).groupBy("customer_id", "item_purchased").agg(F.count("*").alias("n"))
    best = top_k_per_group(counts, ["customer_id"], [F.desc("n"), "item_purchased"], 3)
    packed = best.groupBy("customer_id").agg(F.collect_list(F.struct("item_purchased", "n")).alias("favourites"))
    return packed.select("customer_id", F.inline("favourites"))
