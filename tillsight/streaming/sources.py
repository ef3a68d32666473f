"""Unbounded inputs and the columns every stream query relies on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..sources.retail import RETAIL_FILE_SCHEMA

# The stream file is the flat retail file with a text timestamp behind it.
STREAM_FILE_SCHEMA = RETAIL_FILE_SCHEMA + ", `timestamp` STRING"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def read_stream(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    fmt: str = "csv",
    files_per_trigger: int | None = 1,
) -> DataFrame:
    """A folder or glob of files as an unbounded table; ``None`` takes all new files at once.

    A CSV header that does not match the schema is an error, not a silent shift of columns.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def with_ingest_columns(
    df: DataFrame, text_time: str = "timestamp", age: str = "age", amount: str = "purchase_amount"
) -> DataFrame:
    """Event time parsed from text, processing time, and validity flags.

    A malformed time becomes NULL instead of stopping the query.
    """
    return with_validity_flags(
        df.withColumns(
            {
                "event_time": F.try_to_timestamp(F.col(text_time), F.lit(TIMESTAMP_FORMAT)),
                "processing_time": F.current_timestamp(),
            }
        ),
        age,
        amount,
    )


def with_validity_flags(df: DataFrame, age: str = "age", amount: str = "purchase_amount") -> DataFrame:
    return df.withColumns({"age_valid": F.col(age).isNotNull(), "amount_valid": F.col(amount).isNotNull()})


def with_lateness(df: DataFrame, delay: str = "2 minutes", column: str = "event_time") -> DataFrame:
    """Watermark: a row is dropped once its window ended before the newest time minus ``delay``."""
    return df.withWatermark(column, delay)
