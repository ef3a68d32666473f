"""Sources and sinks."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..ml.classifiers import PROMO, save_model, score_rows, train
from ..operators.ranking import top_rows
from ..operators.sampling import deterministic_split
from ..sources.files import (
    read_csv,
    read_first_available,
    read_parquet,
    register_view,
    save,
    schema_frame,
)
from ..sources.retail import retail, table
from ..sources.shared import shared_folder
from ..streaming.sources import with_validity_flags
from .learning import promo_purchases
from .purchases import events_as_purchases, with_missing_values
from .registry import on_gappy, on_retail, query, tot

CUSTOMER_SCHEMA = "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"


def _as_csv(spark, df):
    path = shared_folder(spark)
    save(df, path, "csv")
    return path


@query("scan_csv_inferred", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def scan_csv_inferred(spark, sf_dir):
    inferred = read_csv(spark, _as_csv(spark, table(spark, sf_dir, "orders")))
    return inferred.withColumns(
        {
            "o_orderkey": F.col("o_orderkey").cast("bigint"),
            "o_custkey": F.col("o_custkey").cast("bigint"),
            "o_orderdate": F.col("o_orderdate").cast("timestamp_ntz"),
        }
    )


@query("scan_csv_schema", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def scan_csv_schema(spark, sf_dir):
    return read_csv(spark, _as_csv(spark, table(spark, sf_dir, "customer")), CUSTOMER_SCHEMA)


@query("scan_parquet", "SELECT * FROM lineitem")
def scan_parquet(spark, sf_dir):
    return read_parquet(spark, f"{sf_dir}/lineitem.parquet")


@query("scan_fallback", "SELECT o_orderstatus, COUNT(*) AS n FROM orders GROUP BY o_orderstatus")
def scan_fallback(spark, sf_dir):
    orders = read_first_available(
        spark, [("parquet", f"{sf_dir}/orders_processed.parquet"), ("parquet", f"{sf_dir}/orders.parquet")]
    )
    return orders.groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query(
    "temp_view",
    on_retail(f"SELECT category, season, COUNT(*) AS n, {tot('purchase_amount')} AS revenue FROM retail GROUP BY category, season"),
)
def temp_view(spark, sf_dir):
    view = register_view(retail(spark, sf_dir), "tillsight_temp_view")
    return spark.sql(
        f"SELECT category, season, count(*) AS n, CAST(sum(purchase_amount) AS DOUBLE) AS revenue FROM {view} GROUP BY ALL"
    )


@query("sink_parquet_roundtrip", "SELECT * FROM orders")
def sink_parquet_roundtrip(spark, sf_dir):
    path = shared_folder(spark)
    save(table(spark, sf_dir, "orders"), path)
    return read_parquet(spark, path)


@query("sink_csv_roundtrip", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def sink_csv_roundtrip(spark, sf_dir):
    path = _as_csv(spark, table(spark, sf_dir, "supplier"))
    return read_csv(spark, path, "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE")


@query(
    "rows_to_frame",
    on_retail(
        "SELECT m.season, m.months, COUNT(*) AS purchases FROM retail r JOIN (VALUES ('Winter', 'Dec-Feb'), "
        "('Spring', 'Mar-May'), ('Summer', 'Jun-Aug'), ('Fall', 'Sep-Nov')) m(season, months) "
        "ON r.season = m.season GROUP BY m.season, m.months"
    ),
)
def rows_to_frame(spark, sf_dir):
    months = spark.createDataFrame(
        [("Winter", "Dec-Feb"), ("Spring", "Mar-May"), ("Summer", "Jun-Aug"), ("Fall", "Sep-Nov")],
        "season STRING, months STRING",
    )
    counts = retail(spark, sf_dir).groupBy("season").agg(F.count("*").alias("purchases"))
    return months.join(counts, "season")


@query(
    "validity_flags",
    on_gappy("SELECT event_id, age IS NOT NULL AS age_valid, purchase_amount IS NOT NULL AS amount_valid FROM purchases"),
)
def validity_flags(spark, sf_dir):
    purchases = with_missing_values(events_as_purchases(table(spark, sf_dir, "events")))
    return with_validity_flags(purchases).select("event_id", "age_valid", "amount_valid")


_LINE_TYPES = [
    ("l_orderkey", "bigint"),
    ("l_partkey", "bigint"),
    ("l_suppkey", "bigint"),
    ("l_linenumber", "int"),
    ("l_quantity", "double"),
    ("l_extendedprice", "double"),
    ("l_discount", "double"),
    ("l_tax", "double"),
    ("l_returnflag", "string"),
    ("l_linestatus", "string"),
    ("l_shipdate", "timestamp_ntz"),
]


@query(
    "schema_info",
    " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS column_name, '{t}' AS data_type, COUNT({c}) AS filled FROM lineitem"
        for i, (c, t) in enumerate(_LINE_TYPES, start=1)
    ),
)
def schema_info(spark, sf_dir):
    return schema_frame(table(spark, sf_dir, "lineitem"))


@query("sample_rows", "SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 10")
def sample_rows(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    return top_rows(customers, [F.desc("c_acctbal"), "c_custkey"], 10)


@query("model_roundtrip")
def model_roundtrip(spark, sf_dir):
    """Predictions of a model that was saved and loaded, counted by label."""
    from pyspark.ml import PipelineModel

    training, held_out = deterministic_split(promo_purchases(spark, sf_dir), ["order_id"])
    path = shared_folder(spark)
    save_model(train(training, PROMO), path)
    scored = score_rows(PipelineModel.load(path), held_out, PROMO)
    return scored.groupBy("promo_code_used", "predicted_label").agg(F.count("*").alias("n"))


@query(
    "model_roundtrip_rules",
    on_retail("SELECT promo_code_used, COUNT(*) AS n, CAST(0 AS BIGINT) AS changed FROM retail GROUP BY 1"),
)
def model_roundtrip_rules(spark, sf_dir):
    """Rows scored by a model before and after it was saved, and how many probabilities changed."""
    from pyspark.ml import PipelineModel

    purchases = promo_purchases(spark, sf_dir)
    path = shared_folder(spark)
    model = train(deterministic_split(purchases, ["order_id"])[0], PROMO)
    save_model(model, path)
    before = score_rows(model, purchases, PROMO).withColumnRenamed("probability", "earlier")
    both = score_rows(PipelineModel.load(path), before, PROMO, "earlier")
    changed = vector_to_array("probability") != vector_to_array("earlier")
    return both.groupBy("promo_code_used").agg(F.count("*").alias("n"), F.count_if(changed).alias("changed"))
