"""File sources and sinks."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """CSV with a header.  Without a schema the types are inferred, at the price of a second scan.

    With a schema, a header that does not match it is an error, not a silent shift of columns.
    A missing path is Spark's own PATH_NOT_FOUND.
    """
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).option("enforceSchema", False).csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_first_available(spark: SparkSession, candidates: Sequence[tuple[str, str]]) -> DataFrame:
    """The first ``(format, path)`` that exists and can be analysed, in the given order."""
    problem: AnalysisException | None = None
    for fmt, path in candidates:
        try:
            return read_csv(spark, path) if fmt == "csv" else spark.read.format(fmt).load(path)
        except AnalysisException as e:
            problem = e
    if problem is None:
        raise ValueError("no candidate source was given")
    raise problem


def save(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Write Parquet, or CSV with a header; any other format is refused."""
    writer = df.write.mode(mode)
    if fmt == "parquet":
        writer.parquet(path)
    elif fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        raise ValueError(f"unsupported sink format: {fmt}")


def register_view(df: DataFrame, name: str) -> str:
    df.createOrReplaceTempView(name)
    return name


def snake_case(name: str) -> str:
    """``Purchase Amount (USD)`` becomes ``purchase_amount_usd``."""
    return re.sub(r"[^0-9a-z]+", "_", name.lower()).strip("_")


def normalize_columns(df: DataFrame, renames: dict[str, str] | None = None) -> DataFrame:
    """Rename every column to snake case; ``renames`` overrides single names."""
    renames = renames or {}
    return df.toDF(*[renames.get(c, snake_case(c)) for c in df.columns])


def schema_frame(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type and number of filled values, from one scan."""
    filled = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f"n{i}") for i, f in enumerate(df.schema.fields)])
    rows = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("position"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.col(f"n{i}").alias("filled"),
            )
            for i, f in enumerate(df.schema.fields)
        ]
    )
    return filled.select(F.inline(rows))
