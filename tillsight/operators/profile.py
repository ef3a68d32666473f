"""Data quality and distribution figures, each from as few passes as possible."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType, StringType

from ..functions.numeric import percent, round_half_up
from .ordering import exact_quantiles


def _quoted(name: str):
    return F.col(f"`{name}`")


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in exclude]


def describe_table(df: DataFrame, digits: int = 4) -> DataFrame:
    """Count, mean, standard deviation, minimum and maximum of numeric and string columns.

    One pass and one row per column; numeric limits and text limits have their own columns.
    Means of whole and decimal numbers come from exact sums.
    """
    aggs, rows = [], []
    for i, f in enumerate(df.schema.fields):
        c = _quoted(f.name)
        if isinstance(f.dataType, NumericType):
            exact = not isinstance(f.dataType, (FloatType, DoubleType))
            center = F.sum(c).cast("double") / F.nullif(F.count(c), F.lit(0)) if exact else F.avg(c)
            aggs += [
                F.count(c).alias(f"n{i}"),
                round_half_up(center, digits).alias(f"m{i}"),
                round_half_up(F.stddev_samp(c.cast("double")), digits).alias(f"s{i}"),
                F.min(c).cast("double").alias(f"lo{i}"),
                F.max(c).cast("double").alias(f"hi{i}"),
            ]
            parts = [F.col(f"m{i}"), F.col(f"s{i}"), F.col(f"lo{i}"), F.col(f"hi{i}"), F.lit(None).cast("string"), F.lit(None).cast("string")]
        elif isinstance(f.dataType, StringType):
            aggs += [F.count(c).alias(f"n{i}"), F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}")]
            parts = [F.lit(None).cast("double")] * 4 + [F.col(f"lo{i}"), F.col(f"hi{i}")]
        else:
            continue
        names = ("mean", "stddev", "min_value", "max_value", "min_text", "max_text")
        rows.append(
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.col(f"n{i}").alias("filled"),
                *[p.alias(n) for p, n in zip(parts, names)],
            )
        )
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def null_counts(df: DataFrame) -> DataFrame:
    """Missing values and their percentage for every column, from one scan."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [F.count_if(_quoted(f.name).isNull()).alias(f"n{i}") for i, f in enumerate(df.schema.fields)]
    rows = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.col(f"n{i}").alias("nulls"),
                percent(f"n{i}", "rows").alias("null_pct"),
            )
            for i, f in enumerate(df.schema.fields)
        ]
    )
    return df.agg(*aggs).select(F.inline(rows))


def row_digest(df: DataFrame) -> tuple[Column, Column]:
    """128 bits that equal rows share; NULLs have a part in it, and zeros of either sign are one."""
    parts = [
        _quoted(f.name) + F.lit(0.0).cast(f.dataType) if isinstance(f.dataType, (FloatType, DoubleType)) else _quoted(f.name)
        for f in df.schema.fields
    ]
    gaps = F.concat(*[F.when(_quoted(c).isNull(), "1").otherwise("0") for c in df.columns])
    return F.xxhash64(gaps, *parts), F.xxhash64(*parts, gaps, F.lit(1))


def duplicate_count(df: DataFrame, digest: Callable[[DataFrame], tuple[Column, Column]] = row_digest) -> DataFrame:
    """Rows, distinct rows and duplicates, without a shuffle of whole rows.

    Digests of the rows, which are not NULL, are counted.  Only rows whose digest repeats are compared in full, so two
    different rows with one digest still count as two.  The input is read twice.
    """
    one, two = digest(df)
    digested = df.withColumns({"_one": one, "_two": two})
    counted = digested.groupBy("_one", "_two").agg(F.count(F.lit(1)).alias("_n"))
    of_digests = counted.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"), F.count_if(F.col("_n") == 1).alias("_single")
    )
    repeated = counted.where("_n > 1").select("_one", "_two")
    full = digested.join(repeated, ["_one", "_two"], "left_semi").groupBy(*[_quoted(c) for c in df.columns]).agg(F.lit(1))
    several = full.agg(F.count(F.lit(1))).scalar()
    distinct = F.col("_single") + several
    return of_digests.select(
        "total_rows", distinct.alias("distinct_rows"), (F.col("total_rows") - distinct).alias("duplicates")
    )


def exact_distinct(df: DataFrame, groups: Sequence[str], ids: dict[str, str]) -> DataFrame:
    """Exact distinct values of several whole-number columns per group: one column per ``output: column``.

    Ids become bits of bitmaps of 32,768 numbers, which tasks build and merge: rows are not copied for each column, as
    several distinct counts in one aggregation would, and what is shuffled is at most a bit an id and task.
    For ids that lie close together; NULL counts as no value.  The input is read once a column.
    """
    found = df.select(*groups).distinct()
    for out, column in ids.items():
        id_ = F.col(column).cast("bigint")
        bits = (
            df.where(id_.isNotNull())
            .groupBy(*groups, F.bitmap_bucket_number(id_).alias("_bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(id_)).alias("_bits"))
            .groupBy(*[F.col(g).alias(f"_of_{g}") for g in groups])
            .agg(F.sum(F.bitmap_count("_bits")).alias("_n"))
        )
        same = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"_of_{g}")) for g in groups])
        found = found.join(bits, same, "left").withColumn(out, F.coalesce("_n", F.lit(0))).select(*found.columns, out)
    return found


def overview(df: DataFrame, customer: str) -> DataFrame:
    """Rows, distinct customers and number of columns."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct(customer).alias("unique_customers"),
        F.lit(len(df.columns)).alias("column_count"),
    )


def distinct_count(df: DataFrame, column: str) -> DataFrame:
    """Number of distinct values; NULL is a value of its own, as in ``distinct().count()``."""
    return df.select(column).distinct().agg(F.count(F.lit(1)).alias("distinct_values"))


def mode_per_column(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Most frequent value of each column and its frequency; ties go to the smaller value.

    Values are counted on the map side, so the unpivoted rows are never shuffled as such.
    """
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [], list(columns), "column_name", "value"
    )
    return (
        long.where(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("column_name")
        .agg(
            F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("top_value"),
            F.max("n").alias("frequency"),
        )
    )


def _correlations(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, list[tuple[str, str]]]:
    pairs = list(combinations(columns, 2))
    return df.agg(*[F.expr(_pearson(a, b)).alias(f"r{i}") for i, (a, b) in enumerate(pairs)]), pairs


def _pearson(a: str, b: str) -> str:
    """Correlation over the rows where both are filled; NULL for a constant column.

    The built-in ``corr`` stops with a division by zero there.
    """
    x, y = f"CAST(`{a}` AS DOUBLE)", f"CAST(`{b}` AS DOUBLE)"
    spread = f"stddev_pop(CASE WHEN {y} IS NOT NULL THEN {x} END) * stddev_pop(CASE WHEN {x} IS NOT NULL THEN {y} END)"
    return f"covar_pop({x}, {y}) / nullif({spread}, 0D)"


def correlation_pairs(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """Pearson correlation of every pair of columns, all in one aggregate."""
    one_row, pairs = _correlations(df, columns)
    rows = F.array(
        *[
            F.struct(
                F.lit(a).alias("column_a"),
                F.lit(b).alias("column_b"),
                round_half_up(f"r{i}", digits).alias("correlation"),
            )
            for i, (a, b) in enumerate(pairs)
        ]
    )
    return one_row.select(F.inline(rows))


def correlated_columns(df: DataFrame, columns: Sequence[str], threshold: float = 0.85) -> list[str]:
    """The later column of each pair whose absolute correlation exceeds the threshold.

    Only one row, with a figure per pair, reaches the driver.  An undefined correlation
    (constant column) never counts as high.
    """
    if len(columns) < 2:
        return []
    one_row, pairs = _correlations(df, columns)
    figures = one_row.first()
    late = {b for (_, b), r in zip(pairs, figures) if r is not None and abs(r) > threshold}
    return [c for c in columns if c in late]


def correlation_prune(
    df: DataFrame, columns: Sequence[str] | None = None, exclude: Sequence[str] = (), threshold: float = 0.85
) -> DataFrame:
    """Drop the columns named by :func:`correlated_columns`."""
    chosen = list(columns) if columns is not None else numeric_columns(df, exclude)
    return df.drop(*correlated_columns(df, chosen, threshold))


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Equal-width bins between minimum and maximum; the last bin includes the maximum.

    One pass finds the limits and one fills the bins; a task hands on its bins only.
    """
    x = df.where(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("x"))
    limits = x.agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi"))).scalar()
    return (
        x.withColumn("_limits", limits)
        .withColumns({"lo": F.col("_limits.lo"), "width": (F.col("_limits.hi") - F.col("_limits.lo")) / F.lit(float(bins))})
        .withColumn(
            "bin",
            F.least(
                F.lit(bins - 1),
                F.coalesce(F.floor((F.col("x") - F.col("lo")) / F.nullif("width", F.lit(0.0))), F.lit(0)),
            ).cast("int"),
        )
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n"), F.min("lo").alias("lo"), F.min("width").alias("width"))
        .select(
            "bin",
            round_half_up("lo + bin * width", 4).alias("bin_start"),
            round_half_up("lo + (bin + 1) * width", 4).alias("bin_end"),
            "n",
        )
    )


def boxplot_stats(df: DataFrame, group: str, value: str, reach: float = 1.5) -> DataFrame:
    """Quartiles, whisker ends and outlier count per group.

    Whiskers end at the last values within ``reach`` interquartile ranges of the box.  The input is read once a
    pass: hand in a table scan or a materialized frame.
    """
    rows = df.where(F.col(value).isNotNull()).select(group, value)
    q = exact_quantiles(rows, [group], value, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    spread = (F.col("q3") - F.col("q1")) * F.lit(reach)
    x = F.col(value).cast("double")
    inside = (x >= F.col("q1") - spread) & (x <= F.col("q3") + spread)
    return (
        rows.join(q.withColumnRenamed(group, "_group"), F.col(group).eqNullSafe(F.col("_group")))
        .groupBy(group)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.first("q1").alias("q1"),
            F.first("median").alias("median"),
            F.first("q3").alias("q3"),
            F.min(F.when(inside, x)).alias("whisker_low"),
            F.max(F.when(inside, x)).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
    )
