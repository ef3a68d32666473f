"""Joins and subqueries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numeric import exact_mean, percent, ratio, relative_difference, round_half_up, total
from ..operators.basket import basket_items, pairs_of
from ..operators.joins import join_rollup, lookup, minus_history, with_baseline
from ..operators.ranking import first_per_group
from ..plans.reports import product_affinity
from ..functions.rules import LiftLimits
from ..sources.retail import retail, stored_retail, table
from ..sources.shared import materialize
from .registry import avg, big, on_retail, pct, query, rnd, tot


@query(
    "join_detail_to_rollup",
    on_retail(
        f"SELECT d.location, d.category, d.n, t.location_n, {pct('d.n', 't.location_n')} AS pct FROM "
        "(SELECT location, category, COUNT(*) AS n FROM retail GROUP BY 1, 2) d JOIN "
        "(SELECT location, COUNT(*) AS location_n FROM retail GROUP BY 1) t ON d.location = t.location"
    ),
)
def join_detail_to_rollup(spark, sf_dir):
    detail = retail(spark, sf_dir).groupBy("location", "category").agg(F.count("*").alias("n"))
    joined = join_rollup(detail, ["location"], {"location_n": F.sum("n")})
    return joined.select("location", "category", "n", "location_n", percent("n", "location_n").alias("pct"))


@query(
    "join_top1",
    on_retail(
        f"SELECT m.color, m.n, m.revenue, t.category AS top_category FROM (SELECT color, COUNT(*) AS n, {tot('purchase_amount')} AS revenue "
        "FROM retail GROUP BY color) m JOIN (SELECT color, category, ROW_NUMBER() OVER (PARTITION BY color ORDER BY COUNT(*) DESC, category) AS rn "
        "FROM retail GROUP BY color, category) t ON m.color = t.color AND t.rn = 1"
    ),
)
def join_top1(spark, sf_dir):
    detail = retail(spark, sf_dir).groupBy("color", "category").agg(
        F.count("*").alias("n"), F.sum("purchase_amount").alias("amount")
    )
    metrics = detail.groupBy("color").agg(F.sum("n").alias("n"), F.sum("amount").cast("double").alias("revenue"))
    leader = first_per_group(
        detail.select("color", "n", F.col("category").alias("top_category")),
        ["color"],
        "top_category",
        F.struct(-F.col("n"), F.col("top_category")),
    )
    return metrics.join(leader, "color")


@query(
    "cross_join_baseline",
    on_retail(
        f"SELECT payment_method, n, {rnd('amount')} AS avg_purchase, {rnd('base')} AS baseline_avg, "
        f"{rnd('((amount - base) / base * 1e2)')} AS vs_baseline_pct FROM "
        f"(SELECT payment_method, COUNT(*) AS n, {avg('purchase_amount', None)} AS amount FROM retail GROUP BY 1) CROSS JOIN "
        f"(SELECT {avg('purchase_amount', None)} AS base FROM retail WHERE discount_applied = 'No' AND promo_code_used = 'No')"
    ),
)
def cross_join_baseline(spark, sf_dir):
    """Every group next to a one-row baseline, which is a scalar subquery and not a join."""
    r = retail(spark, sf_dir)
    base = F.when((F.col("discount_applied") == "No") & (F.col("promo_code_used") == "No"), F.col("purchase_amount"))
    sums = materialize(
        r.groupBy("payment_method").agg(
            F.count("*").alias("n"),
            exact_mean("purchase_amount").alias("amount"),
            F.sum(base).alias("base_sum"),
            F.count(base).alias("base_n"),
        )
    )
    return with_baseline(sums, base=sums.agg(ratio("sum(base_sum)", "sum(base_n)"))).select(
        "payment_method",
        "n",
        round_half_up("amount").alias("avg_purchase"),
        round_half_up("base").alias("baseline_avg"),
        relative_difference("amount", "base").alias("vs_baseline_pct"),
    )


_ITEMS = "SELECT DISTINCT order_id AS basket, item_purchased AS item FROM retail"


@query(
    "self_join_pairs",
    on_retail(
        "SELECT a.item AS item_a, b.item AS item_b, COUNT(*) AS baskets_with_both FROM items a JOIN items b "
        "ON a.basket = b.basket AND a.item < b.item GROUP BY 1, 2",
        items=_ITEMS,
    ),
)
def self_join_pairs(spark, sf_dir):
    lines = stored_retail(spark, sf_dir, "order_id", "item_purchased", "purchase_amount")
    items = materialize(basket_items(lines, "order_id", "item_purchased", "purchase_amount"))
    return pairs_of(items).select("item_a", "item_b", "baskets_with_both")


@query(
    "left_anti_history",
    on_retail(
        "SELECT customer_id, item_purchased FROM retail WHERE discount_applied = 'Yes' EXCEPT "
        "SELECT customer_id, item_purchased FROM retail WHERE discount_applied = 'No'"
    ),
)
def left_anti_history(spark, sf_dir):
    """Items a customer has bought at a discount but never without one."""
    r = retail(spark, sf_dir)
    keys = ["customer_id", "item_purchased"]
    candidates = r.where(F.col("discount_applied") == "Yes").select(*keys).distinct()
    return minus_history(candidates, r.where(F.col("discount_applied") == "No"), keys)


@query(
    "lookup_join_broadcast",
    "SELECT n.n_name, COUNT(*) AS customers FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY n.n_name",
)
def lookup_join_broadcast(spark, sf_dir):
    names = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return (
        lookup(table(spark, sf_dir, "customer"), names, "c_nationkey")
        .groupBy("n_name")
        .agg(F.count("*").alias("customers"))
    )


@query(
    "scalar_subquery_share",
    on_retail(
        f"SELECT category, {tot('purchase_amount')} AS revenue, "
        f"{pct('SUM(purchase_amount)', '(SELECT SUM(purchase_amount) FROM retail)')} AS revenue_pct FROM retail GROUP BY category"
    ),
)
def scalar_subquery_share(spark, sf_dir):
    r = retail(spark, sf_dir)
    by_category = materialize(r.groupBy("category").agg(F.sum("purchase_amount").alias("revenue")))
    return with_baseline(by_category, all_revenue=by_category.agg(total("revenue"))).select(
        "category", F.col("revenue").cast("double"), percent("revenue", "all_revenue").alias("revenue_pct")
    )


def affinity_sql(basket: str, item: str, min_support: int, top: int, limits: tuple[float, float, float]) -> str:
    strong, moderate, weak = limits
    lift = "(CAST(shared AS DOUBLE) * CAST(total AS DOUBLE) / (CAST(na AS DOUBLE) * CAST(nb AS DOUBLE)))"
    body = (
        f"SELECT item_a, item_b, shared AS baskets_with_both, {rnd('(spend / shared)')} AS avg_combined_spend, "
        f"{rnd('(CAST(bought AS DOUBLE) / shared)', 1)} AS avg_combined_purchases, {pct('shared', 'total')} AS penetration_pct, "
        f"{rnd('(CAST(shared AS DOUBLE) / na)', 3)} AS confidence_a_to_b, {rnd('(CAST(shared AS DOUBLE) / nb)', 3)} AS confidence_b_to_a, "
        f"{rnd(lift)} AS lift, CASE WHEN {lift} > {strong} THEN 'Strong Affinity' WHEN {lift} > {moderate} THEN 'Moderate Affinity' "
        f"WHEN {lift} > {weak} THEN 'Weak Affinity' ELSE 'Negative Affinity' END AS strength "
        "FROM (SELECT p.*, ta.n AS na, tb.n AS nb, (SELECT COUNT(DISTINCT basket) FROM items) AS total FROM pairs p "
        "JOIN totals ta ON p.item_a = ta.item JOIN totals tb ON p.item_b = tb.item) "
        f"WHERE shared >= {min_support} ORDER BY lift DESC, item_a, item_b LIMIT {top}"
    )
    return on_retail(
        body,
        items=f"SELECT {basket} AS basket, {item} AS item, COUNT(*) AS n, {avg('purchase_amount', None)} AS m FROM retail GROUP BY 1, 2",
        totals="SELECT item, COUNT(*) AS n FROM items GROUP BY item",
        pairs="SELECT a.item AS item_a, b.item AS item_b, COUNT(*) AS shared, SUM(a.m + b.m) AS spend, "
        f"{big('SUM(a.n + b.n)')} AS bought FROM items a JOIN items b ON a.basket = b.basket AND a.item < b.item GROUP BY 1, 2",
    )


@query("basket_affinity", affinity_sql("order_id", "category", 5, 20, (1.0, 0.99, 0.98)))
def basket_affinity(spark, sf_dir):
    lines = stored_retail(spark, sf_dir, "order_id", "category", "purchase_amount")
    return product_affinity(lines, basket="order_id", limits=LiftLimits(strong=1.0, moderate=0.99, weak=0.98))
