"""The flat retail table: one row per purchased line, with customer and product attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .shared import materialize

#: Lines that one task sorts at most where the joins of the retail table are stored, apart from those of one key.
TASK_LINES = 500_000

# Header of the flat retail file and our column for each entry.
DISPLAY_NAMES = {
    "customer_id": "Customer ID",
    "age": "Age",
    "gender": "Gender",
    "item_purchased": "Item Purchased",
    "category": "Category",
    "purchase_amount": "Purchase Amount (USD)",
    "location": "Location",
    "size": "Size",
    "color": "Color",
    "season": "Season",
    "review_rating": "Review Rating",
    "subscription_status": "Subscription Status",
    "shipping_type": "Shipping Type",
    "discount_applied": "Discount Applied",
    "promo_code_used": "Promo Code Used",
    "previous_purchases": "Previous Purchases",
    "payment_method": "Payment Method",
    "frequency_of_purchases": "Frequency of Purchases",
}

# Types of the flat retail file, in header order.
RETAIL_FILE_SCHEMA = ", ".join(
    f"`{DISPLAY_NAMES[name]}` {kind}"
    for name, kind in [
        ("customer_id", "INT"),
        ("age", "INT"),
        ("gender", "STRING"),
        ("item_purchased", "STRING"),
        ("category", "STRING"),
        ("purchase_amount", "INT"),
        ("location", "STRING"),
        ("size", "STRING"),
        ("color", "STRING"),
        ("season", "STRING"),
        ("review_rating", "DOUBLE"),
        ("subscription_status", "STRING"),
        ("shipping_type", "STRING"),
        ("discount_applied", "STRING"),
        ("promo_code_used", "STRING"),
        ("previous_purchases", "INT"),
        ("payment_method", "STRING"),
        ("frequency_of_purchases", "STRING"),
    ]
)

# Columns of the order and event tables, so that opening one starts no job.
TABLE_SCHEMAS = {
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}

FILE_COLUMN_RENAMES = {display: name for name, display in DISPLAY_NAMES.items()}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(TABLE_SCHEMAS[name]) if name in TABLE_SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def retail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Join the order tables into the flat retail table.

    Customers and orders meet before the lines do, so that the largest table is shuffled
    once for its product and once for its order.  No side carries a broadcast hint: Spark
    broadcasts what its size check allows, and splits skewed keys otherwise.
    """
    customers = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"))
        .selectExpr(
            "c_custkey",
            "CAST(18 + c_custkey % 53 AS INT) AS age",
            "CASE WHEN c_custkey % 3 = 0 THEN 'Female' ELSE 'Male' END AS gender",
            "n_name AS location",
            "CASE WHEN c_custkey % 4 = 0 THEN 'Yes' ELSE 'No' END AS subscription_status",
            "CAST(greatest(0, floor(c_acctbal / 200)) AS INT) AS previous_purchases",
            "c_mktsegment AS frequency_of_purchases",
        )
    )
    orders = table(spark, sf_dir, "orders").join(customers, F.expr("o_custkey = c_custkey"))
    products = table(spark, sf_dir, "part")
    return (
        table(spark, sf_dir, "lineitem")
        .join(products, F.expr("l_partkey = p_partkey"))
        .join(orders, F.expr("l_orderkey = o_orderkey"))
        .selectExpr(
            "o_custkey AS customer_id",
            "age",
            "gender",
            "p_name AS item_purchased",
            "p_type AS category",
            "CAST(l_extendedprice AS DECIMAL(12,2)) AS purchase_amount",
            "location",
            "CASE WHEN p_size <= 12 THEN 'S' WHEN p_size <= 25 THEN 'M' WHEN p_size <= 38 THEN 'L' ELSE 'XL' END AS size",
            "p_brand AS color",
            "CASE WHEN month(l_shipdate) IN (12, 1, 2) THEN 'Winter' WHEN month(l_shipdate) IN (3, 4, 5) THEN 'Spring' "
            "WHEN month(l_shipdate) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season",
            "CAST(CAST(25 + (l_partkey * 7 + l_linenumber) % 26 AS DOUBLE) / 10 AS DECIMAL(2,1)) AS review_rating",
            "subscription_status",
            "o_orderpriority AS shipping_type",
            "CASE WHEN l_discount > 0.05D THEN 'Yes' ELSE 'No' END AS discount_applied",
            "CASE WHEN l_tax > 0.04D THEN 'Yes' ELSE 'No' END AS promo_code_used",
            "previous_purchases",
            "l_returnflag || l_linestatus AS payment_method",
            "frequency_of_purchases",
            "l_orderkey AS order_id",
        )
    )


def stored_retail(spark: SparkSession, sf_dir: str, *columns: str, measured: bool = False) -> DataFrame:
    """Some columns of the retail table, stored; the tasks of its joins go by the number of lines.

    ``measured`` is that of :func:`materialize`.
    """
    lines = table(spark, sf_dir, "lineitem").count()
    return materialize(retail(spark, sf_dir).select(*columns), -(-lines // TASK_LINES), measured)


def from_flat_file(df: DataFrame) -> DataFrame:
    """Retail columns from a frame that carries the file's header names."""
    return df.select(*[F.col(f"`{display}`").alias(name) for name, display in DISPLAY_NAMES.items()])


def to_display_names(df: DataFrame) -> DataFrame:
    """The file's header names on a retail frame; other columns keep theirs."""
    return df.withColumnsRenamed(DISPLAY_NAMES)
