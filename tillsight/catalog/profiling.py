"""Data quality and distributions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numeric import round_half_up
from ..operators import profile
from ..sources.shared import materialize
from ..sources.retail import retail, table
from .purchases import events_as_purchases, with_missing_values
from .registry import big, on_gappy, on_retail, pct, quantile, query, rnd, sd

_NUMBERS = ["customer_id", "age", "purchase_amount", "review_rating", "previous_purchases", "order_id"]
_TEXTS = [
    "gender", "item_purchased", "category", "location", "size", "color", "season", "subscription_status", "shipping_type",
    "discount_applied", "promo_code_used", "payment_method", "frequency_of_purchases",
]


def _describe_sql() -> str:
    parts = []
    for c in _NUMBERS:
        parts.append(
            f"SELECT '{c}' AS column_name, COUNT({c}) AS filled, {rnd(f'(CAST(SUM({c}) AS DOUBLE) / COUNT({c}))', 4)} AS mean, "
            f"{sd(c, 4)} AS stddev, CAST(MIN({c}) AS DOUBLE) AS min_value, CAST(MAX({c}) AS DOUBLE) AS max_value, "
            "CAST(NULL AS VARCHAR) AS min_text, CAST(NULL AS VARCHAR) AS max_text FROM retail"
        )
    for c in _TEXTS:
        parts.append(
            f"SELECT '{c}', COUNT({c}), NULL, NULL, NULL, NULL, MIN({c}), MAX({c}) FROM retail"
        )
    return on_retail(" UNION ALL ".join(parts))


@query("describe_table", _describe_sql())
def describe_table(spark, sf_dir):
    return profile.describe_table(retail(spark, sf_dir))


_GAPPY_COLUMNS = [
    "event_id", "event_time", "customer_id", "gender", "item_purchased", "category", "review_rating",
    "purchase_amount", "age", "processing_time", "subscription_status", "discount_applied", "previous_purchases",
    "payment_method",
]


@query(
    "null_counts",
    on_gappy(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, COUNT(*) - COUNT({c}) AS nulls, {pct(f'(COUNT(*) - COUNT({c}))', 'COUNT(*)')} AS null_pct FROM purchases"
            for c in _GAPPY_COLUMNS
        )
    ),
)
def null_counts(spark, sf_dir):
    purchases = with_missing_values(events_as_purchases(table(spark, sf_dir, "events")))
    return profile.null_counts(purchases)


@query(
    "duplicate_count",
    f"SELECT {big('SUM(n)')} AS total_rows, COUNT(*) AS distinct_rows, {big('SUM(n - 1)')} AS duplicates FROM "
    "(SELECT lineitem, COUNT(*) AS n FROM lineitem GROUP BY lineitem)",
)
def duplicate_count(spark, sf_dir):
    return profile.duplicate_count(table(spark, sf_dir, "lineitem"))


@query(
    "agg_bitmap_distinct",
    "SELECT l_returnflag, COUNT(DISTINCT l_orderkey) AS orders, COUNT(DISTINCT l_partkey) AS parts, COUNT(DISTINCT l_suppkey) AS suppliers "
    "FROM lineitem GROUP BY 1",
)
def agg_bitmap_distinct(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return profile.exact_distinct(
        lines, ["l_returnflag"], {"orders": "l_orderkey", "parts": "l_partkey", "suppliers": "l_suppkey"}
    )


@query("distinct_count", on_retail("SELECT COUNT(*) AS distinct_values FROM (SELECT DISTINCT item_purchased FROM retail)"))
def distinct_count(spark, sf_dir):
    return profile.distinct_count(retail(spark, sf_dir), "item_purchased")


@query(
    "overview",
    on_retail(
        "SELECT COUNT(*) AS total_rows, COUNT(DISTINCT customer_id) AS unique_customers, CAST(19 AS INT) AS column_count FROM retail"
    ),
)
def overview(spark, sf_dir):
    return profile.overview(retail(spark, sf_dir), "customer_id")


_MODE_COLUMNS = [
    "gender", "item_purchased", "category", "location", "size", "color", "season", "payment_method",
    "subscription_status", "shipping_type", "discount_applied", "promo_code_used", "frequency_of_purchases",
]


@query(
    "mode_per_column",
    on_retail(
        " UNION ALL ".join(
            f"(SELECT '{c}' AS column_name, {c} AS top_value, COUNT(*) AS frequency FROM retail GROUP BY {c} ORDER BY COUNT(*) DESC, {c} LIMIT 1)"
            for c in _MODE_COLUMNS
        )
    ),
)
def mode_per_column(spark, sf_dir):
    return profile.mode_per_column(retail(spark, sf_dir), _MODE_COLUMNS)


_LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]
_LINE_PAIRS = [(a, b) for i, a in enumerate(_LINE_NUMBERS) for b in _LINE_NUMBERS[i + 1 :]]


@query(
    "correlation_pairs",
    " UNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, {rnd(f'CORR({a}, {b})', 6)} AS correlation FROM lineitem"
        for a, b in _LINE_PAIRS
    ),
)
def correlation_pairs(spark, sf_dir):
    return profile.correlation_pairs(table(spark, sf_dir, "lineitem"), _LINE_NUMBERS)


@query(
    "correlation_prune",
    "SELECT l_orderkey, l_quantity, l_discount, l_tax FROM lineitem",
)
def correlation_prune(spark, sf_dir):
    """The derived column follows the quantity, so it is the one that goes."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_quantity",
        (F.col("l_quantity") * 2 + F.col("l_tax")).alias("doubled"),
        "l_discount",
        "l_tax",
    )
    return profile.correlation_prune(lines, exclude=["l_orderkey"])


def _histogram_sql(bins: int) -> str:
    bin_no = f"CAST(LEAST({bins - 1}, COALESCE(FLOOR((x - lo) / NULLIF((hi - lo) / {bins}e0, 0e0)), 0)) AS INT)"
    return on_retail(
        f"SELECT bin, {rnd(f'(lo + bin * ((hi - lo) / {bins}e0))', 4)} AS bin_start, "
        f"{rnd(f'(lo + (bin + 1) * ((hi - lo) / {bins}e0))', 4)} AS bin_end, n FROM "
        f"(SELECT {bin_no} AS bin, MIN(lo) AS lo, MIN(hi) AS hi, COUNT(*) AS n FROM "
        "(SELECT CAST(purchase_amount AS DOUBLE) AS x FROM retail), "
        "(SELECT CAST(MIN(purchase_amount) AS DOUBLE) AS lo, CAST(MAX(purchase_amount) AS DOUBLE) AS hi FROM retail) GROUP BY 1)"
    )


@query("histogram", _histogram_sql(20))
def histogram(spark, sf_dir):
    return profile.histogram(retail(spark, sf_dir), "purchase_amount", 20)


_INSIDE = "v BETWEEN q1 - (q3 - q1) * 15e-1 AND q3 + (q3 - q1) * 15e-1"


@query(
    "boxplot_stats",
    on_retail(
        f"SELECT gender, COUNT(*) AS n, {rnd('MIN(q1)')} AS q1, {rnd('MIN(median)')} AS median, {rnd('MIN(q3)')} AS q3, "
        f"MIN(CASE WHEN {_INSIDE} THEN v END) AS whisker_low, MAX(CASE WHEN {_INSIDE} THEN v END) AS whisker_high, "
        f"COUNT(CASE WHEN NOT ({_INSIDE}) THEN 1 END) AS outliers FROM "
        "(SELECT r.gender, CAST(r.purchase_amount AS DOUBLE) AS v, q1, median, q3 FROM retail r JOIN q ON r.gender = q.gender) GROUP BY gender",
        q=quantile("retail", "gender", "purchase_amount", {"q1": 0.25, "median": 0.5, "q3": 0.75}),
    ),
)
def boxplot_stats(spark, sf_dir):
    amounts = materialize(retail(spark, sf_dir).select("gender", "purchase_amount"))
    stats = profile.boxplot_stats(amounts, "gender", "purchase_amount")
    return stats.withColumns({c: round_half_up(c) for c in ("q1", "median", "q3")})
