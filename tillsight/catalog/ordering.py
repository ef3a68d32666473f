"""Window functions, sorting, top rows, splits and samples."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from ..functions.numeric import exact_mean, round_half_up, total
from ..operators.joins import with_baseline
from ..operators.ordering import global_ntiles
from ..operators.ranking import number_in_group, rank_in_group, share_in_group, top_k_per_group, top_rows
from ..operators.sampling import sample_with_replacement, split_point
from ..plans.reports import customer_metrics
from ..sources.retail import retail, table
from ..sources.shared import materialize
from .registry import on_retail, pct, query, rnd, tot


def _counts(spark, sf_dir, *keys):
    return retail(spark, sf_dir).groupBy(*keys).agg(F.count("*").alias("n"))


@query(
    "win_row_number",
    on_retail(
        "SELECT category, item_purchased, n, CAST(ROW_NUMBER() OVER (PARTITION BY category ORDER BY n DESC, item_purchased) AS INT) AS rn "
        "FROM (SELECT category, item_purchased, COUNT(*) AS n FROM retail GROUP BY 1, 2)"
    ),
)
def win_row_number(spark, sf_dir):
    return number_in_group(_counts(spark, sf_dir, "category", "item_purchased"), ["category"], [F.desc("n"), "item_purchased"])


@query(
    "win_rank_partitioned",
    on_retail(
        "SELECT location, age, n, CAST(RANK() OVER (PARTITION BY location ORDER BY n DESC) AS INT) AS rank "
        "FROM (SELECT location, age, COUNT(*) AS n FROM retail GROUP BY 1, 2)"
    ),
)
def win_rank_partitioned(spark, sf_dir):
    return rank_in_group(_counts(spark, sf_dir, "location", "age"), ["location"], [F.desc("n")])


@query(
    "win_rank_global",
    on_retail(
        "SELECT color, n, revenue, CAST(RANK() OVER (ORDER BY n DESC) AS INT) AS by_count, CAST(RANK() OVER (ORDER BY revenue DESC) AS INT) AS by_revenue "
        f"FROM (SELECT color, COUNT(*) AS n, {tot('purchase_amount')} AS revenue FROM retail GROUP BY 1)"
    ),
)
def win_rank_global(spark, sf_dir):
    """Two rankings of a frame with one row per colour."""
    stats = retail(spark, sf_dir).groupBy("color").agg(
        F.count("*").alias("n"), total("purchase_amount").alias("revenue")
    )
    return stats.withColumns(
        {
            "by_count": F.rank().over(Window.orderBy(F.desc("n"))),
            "by_revenue": F.rank().over(Window.orderBy(F.desc("revenue"))),
        }
    )


@query(
    "win_ntile",
    "SELECT o_orderkey, CAST(NTILE(4) OVER (ORDER BY o_totalprice, o_orderkey) AS INT) AS price_quartile, "
    "CAST(NTILE(10) OVER (ORDER BY o_custkey DESC, o_orderkey) AS INT) AS customer_decile FROM orders",
)
def win_ntile(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_custkey")
    tiled = global_ntiles(orders, "o_orderkey", {"price_quartile": "o_totalprice"})
    tiled = global_ntiles(tiled, "o_orderkey", {"customer_decile": "o_custkey"}, tiles=10, descending=True)
    return tiled.select("o_orderkey", "price_quartile", "customer_decile")


@query(
    "win_sum_partition",
    on_retail(
        f"SELECT season, category, n, {pct('n', 'SUM(n) OVER (PARTITION BY season)')} AS pct FROM "
        "(SELECT season, category, COUNT(*) AS n FROM retail GROUP BY 1, 2)"
    ),
)
def win_sum_partition(spark, sf_dir):
    return share_in_group(_counts(spark, sf_dir, "season", "category"), ["season"], "n", "pct")


@query(
    "win_sum_all",
    on_retail(
        f"SELECT payment_method, n, {pct('n', 'SUM(n) OVER ()')} AS market_share FROM "
        "(SELECT payment_method, COUNT(*) AS n FROM retail GROUP BY 1)"
    ),
)
def win_sum_all(spark, sf_dir):
    return share_in_group(_counts(spark, sf_dir, "payment_method"), [], "n", "market_share")


@query(
    "win_zscore",
    on_retail(
        f"SELECT customer_id, CAST(v AS DOUBLE) AS lifetime_value, {rnd('((CAST(v AS DOUBLE) - m) / NULLIF(s, 0e0))', 4)} AS zscore FROM "
        "spend, (SELECT CAST(SUM(v) AS DOUBLE) / COUNT(v) AS m, STDDEV_SAMP(CAST(v AS DOUBLE)) AS s FROM spend)",
        spend="SELECT customer_id, SUM(purchase_amount) AS v FROM retail GROUP BY customer_id",
    ),
)
def win_zscore(spark, sf_dir):
    """Distance from the mean in standard deviations; mean and deviation are scalar subqueries."""
    spend = materialize(customer_metrics(retail(spark, sf_dir)).select("customer_id", "lifetime_value"))
    value = F.col("lifetime_value").cast("double")
    scored = with_baseline(
        spend,
        center=spend.agg(exact_mean("lifetime_value")),
        spread=spend.agg(F.stddev_samp(value)),
    )
    return scored.select(
        "customer_id",
        value.alias("lifetime_value"),
        round_half_up((value - F.col("center")) / F.nullif("spread", F.lit(0.0)), 4).alias("zscore"),
    )


@query(
    "topk_per_user",
    on_retail(
        "SELECT customer_id, item_purchased, spent, CAST(rank AS INT) AS rank FROM (SELECT customer_id, item_purchased, CAST(SUM(purchase_amount) AS DOUBLE) AS spent, "
        "ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY SUM(purchase_amount) DESC, item_purchased) AS rank "
        "FROM retail GROUP BY 1, 2) WHERE rank <= 3"
    ),
)
def topk_per_user(spark, sf_dir):
    spent = retail(spark, sf_dir).groupBy("customer_id", "item_purchased").agg(total("purchase_amount").alias("spent"))
    return top_k_per_group(spent, ["customer_id"], [F.desc("spent"), "item_purchased"], 3, out="rank")


@query(
    "sort_multi",
    on_retail("SELECT location, category, COUNT(*) AS n FROM retail GROUP BY 1, 2 ORDER BY location, n DESC, category"),
)
def sort_multi(spark, sf_dir):
    return _counts(spark, sf_dir, "location", "category").orderBy("location", F.desc("n"), "category")


@query("sort_desc", on_retail("SELECT age, gender, COUNT(*) AS n FROM retail GROUP BY 1, 2 ORDER BY age DESC, gender DESC"))
def sort_desc(spark, sf_dir):
    return _counts(spark, sf_dir, "age", "gender").orderBy(F.desc("age"), F.desc("gender"))


@query(
    "top_n",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20",
)
def top_n(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return top_rows(orders, [F.desc("o_totalprice"), "o_orderkey"], 20)


@query("distinct_rows", on_retail("SELECT DISTINCT customer_id, category, season FROM retail"))
def distinct_rows(spark, sf_dir):
    return retail(spark, sf_dir).select("customer_id", "category", "season").distinct()


@query(
    "deterministic_split",
    "SELECT o_orderkey, CASE WHEN CAST(CAST('0x' || SUBSTR(MD5(CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) AS DOUBLE) "
    "/ 4294967296e0 < 8e-1 THEN 'train' ELSE 'test' END AS side FROM orders",
)
def split(spark, sf_dir):
    side = F.when(split_point("o_orderkey") < 0.8, "train").otherwise("test")
    return table(spark, sf_dir, "orders").select("o_orderkey", side.alias("side"))


@query("sample_replacement")
def sample_replacement(spark, sf_dir):
    return sample_with_replacement(table(spark, sf_dir, "orders"), 50, seed=42)


@query(
    "sample_replacement_rules",
    "SELECT CAST(CASE WHEN COUNT(*) > 0 THEN 50 ELSE 0 END AS BIGINT) AS n, CAST(0 AS BIGINT) AS strangers FROM orders",
)
def sample_replacement_rules(spark, sf_dir):
    """How many rows are drawn, and how many of them are no rows of the table."""
    known = table(spark, sf_dir, "orders").select("o_orderkey", F.lit(1).alias("known"))
    drawn = sample_replacement(spark, sf_dir).join(known, "o_orderkey", "left")
    return drawn.agg(F.count("*").alias("n"), F.count_if(F.col("known").isNull()).alias("strangers"))
