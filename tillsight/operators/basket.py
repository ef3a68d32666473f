"""Which items share a basket, and how much more often than by chance."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.numeric import exact_mean, percent, ratio, round_half_up
from ..functions.rules import LiftLimits, affinity_strength
from ..sources.shared import materialize


#: Rows that one task sorts or groups at most, apart from those of one key: the parts of a table go by its size.
TASK_ROWS = 500_000


def _tasks(rows: int) -> int:
    return max(1, -(-rows // TASK_ROWS))


def basket_items(df: DataFrame, basket: str, item: str, amount: str) -> DataFrame:
    """One row per basket and distinct item: purchases and mean amount.

    Rows are counted, so a frame that is costly to make should be stored; they are dealt to as many tasks as they
    ask for, and grouped twice: an item's very many lines in one basket are first told apart by amount.
    """
    rows = df.where(F.col(basket).isNotNull() & F.col(item).isNotNull()).select(
        F.col(basket).alias("basket"), F.col(item).alias("item"), F.col(amount).alias("amount")
    )
    parts = _tasks(rows.count())
    lots = rows.withColumn("lot", F.pmod(F.xxhash64("amount"), F.lit(16))).repartition(parts, "basket", "item", "lot")
    sums = lots.groupBy("basket", "item", "lot").agg(
        F.count(F.lit(1)).alias("purchases"), F.sum("amount").alias("amount"), F.count("amount").alias("amounts")
    )
    return (
        sums.repartition(parts, "basket", "item")
        .groupBy("basket", "item")
        .agg(F.sum("purchases").alias("purchases"), ratio("sum(amount)", "sum(amounts)").alias("mean_amount"))
    )


def pairs_of(items: DataFrame, rows_per_part: int = 1_000) -> DataFrame:
    """Totals of all pairs of items that share a basket.

    A basket of n items is worked on by ceil(n / rows_per_part) tasks: its left side is spread by
    item and its right side is repeated for each part.  Matches go straight into a partial
    aggregate; no pair is shuffled before that.  A task counts and joins a bounded number of rows;
    the few baskets that are cut are stored, so that the others need no shuffle to meet them.
    """
    rows = items.count()
    tasks = _tasks(rows)
    sizes = items.repartition(tasks, "basket").groupBy("basket").agg(F.count(F.lit(1)).alias("size"))
    cut = materialize(
        sizes.where(F.col("size") > rows_per_part).withColumn("parts", F.ceil(F.col("size") / F.lit(rows_per_part)))
    )
    repeated = cut.agg(F.sum(F.col("size") * (F.col("parts") - 1))).first()[0] or 0
    sized = items.join(cut.drop("size").repartition(tasks, "basket"), "basket", "left").fillna(1, ["parts"])
    tasks = _tasks(rows + repeated)
    left = sized.select(
        "basket",
        F.pmod(F.xxhash64("item"), F.col("parts")).alias("salt"),
        F.col("item").alias("item_a"),
        F.col("purchases").alias("purchases_a"),
        F.col("mean_amount").alias("mean_a"),
    )
    right = sized.select(
        "basket",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("salt"),
        F.col("item").alias("item_b"),
        F.col("purchases").alias("purchases_b"),
        F.col("mean_amount").alias("mean_b"),
    )
    return (
        left.repartition(tasks, "basket", "salt")
        .join(right.repartition(tasks, "basket", "salt"), ["basket", "salt"])
        .where(F.col("item_a") < F.col("item_b"))
        .groupBy("item_a", "item_b")
        .agg(
            F.count(F.lit(1)).alias("baskets_with_both"),
            F.sum(F.col("mean_a") + F.col("mean_b")).alias("spend"),
            F.sum(F.col("purchases_a") + F.col("purchases_b")).alias("purchases"),
        )
    )


def frequent_pairs(items: DataFrame, min_support: int) -> DataFrame:
    """Totals of all pairs that share at least ``min_support`` baskets.

    An item in fewer baskets than that cannot belong to such a pair and is left out
    before pairs are formed.
    """
    return _frequent_pairs(items, _per_item(items), min_support)


def _per_item(items: DataFrame) -> DataFrame:
    """The number of baskets of every item, stored, so that Spark knows if it is small."""
    return materialize(items.groupBy("item").agg(F.count(F.lit(1)).alias("baskets")), _tasks(items.count()))


def _frequent_pairs(items: DataFrame, per_item: DataFrame, min_support: int) -> DataFrame:
    """Rows of an item in more baskets than a task has room for are dealt to several tasks; such items are few."""
    tasks = _tasks(items.count())
    lots = per_item.withColumn("lots", F.ceil(F.col("baskets") / F.lit(TASK_ROWS)))
    common = lots.where(F.col("baskets") >= min_support).select(
        "item", F.explode(F.sequence(F.lit(0).cast("long"), F.col("lots") - 1)).alias("lot")
    )
    crowded = lots.where(F.col("lots") > 1).select("item", "lots")
    dealt = (
        items.join(F.broadcast(crowded), "item", "left")
        .fillna(1, ["lots"])
        .withColumn("lot", F.pmod(F.xxhash64("basket"), F.col("lots")))
    )
    kept = dealt.join(common.repartition(tasks, "item", "lot"), ["item", "lot"], "left_semi")
    return pairs_of(materialize(kept.drop("lots", "lot"))).where(F.col("baskets_with_both") >= min_support)


def affinity(
    df: DataFrame,
    basket: str,
    item: str,
    amount: str,
    min_support: int = 5,
    limits: LiftLimits = LiftLimits(),
) -> DataFrame:
    """Support, confidence in both directions, lift and strength label of item pairs."""
    items = materialize(basket_items(df, basket, item, amount))
    per_item = _per_item(items)
    all_baskets = items.repartition(_tasks(items.count()), "basket").agg(F.count_distinct("basket")).scalar()
    a = per_item.select(F.col("item").alias("item_a"), F.col("baskets").alias("baskets_a"))
    b = per_item.select(F.col("item").alias("item_b"), F.col("baskets").alias("baskets_b"))
    both = "baskets_with_both"
    lift = ratio(
        "CAST(baskets_with_both AS DOUBLE) * CAST(all_baskets AS DOUBLE)",
        "CAST(baskets_a AS DOUBLE) * CAST(baskets_b AS DOUBLE)",
    )
    return (
        _frequent_pairs(items, per_item, min_support)
        .join(a, "item_a")
        .join(b, "item_b")
        .withColumn("all_baskets", all_baskets)
        .withColumn("lift_exact", lift)
        .select(
            "item_a",
            "item_b",
            "baskets_with_both",
            round_half_up(ratio("spend", both)).alias("avg_combined_spend"),
            round_half_up(ratio("purchases", both), 1).alias("avg_combined_purchases"),
            percent(both, "all_baskets").alias("penetration_pct"),
            round_half_up(ratio(both, "baskets_a"), 3).alias("confidence_a_to_b"),
            round_half_up(ratio(both, "baskets_b"), 3).alias("confidence_b_to_a"),
            round_half_up("lift_exact").alias("lift"),
            affinity_strength(F.col("lift_exact"), limits).alias("strength"),
        )
    )
