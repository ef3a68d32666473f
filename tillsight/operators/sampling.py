"""Repeatable splits and samples."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F


def split_point(*keys: str) -> Column:
    """A number in [0, 1) that depends on the key values only.

    The first 32 bits of an MD5 digest: the same on every engine, and unlike
    ``randomSplit`` independent of partitioning and row order.
    """
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def deterministic_split(df: DataFrame, keys: list[str], train: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Split by key: rows with equal keys land on the same side."""
    point = split_point(*keys)
    return df.where(point < train), df.where(point >= train)


def sample_with_replacement(df: DataFrame, n: int, seed: int) -> DataFrame:
    """Exactly ``n`` rows drawn with replacement, the same ones for the same seed.  No rows come from an empty table.

    The rows of each partition are counted, ``n`` is split over the partitions by one multinomial draw, and every
    drawn number names a position in its partition.  Drawn numbers, not rows, are made up and counted, and a row drawn
    twice is repeated.  The input is read twice in the same partitions: hand in a table scan or a materialized frame.
    """
    numbered = df.withColumn("_at", F.monotonically_increasing_id())  # partition in the upper bits, position in the lower 33
    sizes = numbered.groupBy(F.shiftright("_at", 33).alias("p")).agg(F.count(F.lit(1)).alias("n")).orderBy("p").collect()
    rows = sum(r.n for r in sizes)
    if rows == 0:
        return df.limit(0)
    shares = np.random.default_rng(seed).multinomial(n, [r.n / rows for r in sizes])
    split = [(r.p, r.n, int(k)) for r, k in zip(sizes, shares) if k]
    drawn = (
        df.sparkSession.createDataFrame(split, "p BIGINT, size BIGINT, k BIGINT")
        .select("p", "size", F.explode(F.sequence(F.lit(1).cast("bigint"), "k")).alias("i"))
        .select((F.shiftleft("p", 33) + F.pmod(F.xxhash64(F.lit(seed), "p", "i"), "size")).alias("_drawn"))
        .groupBy("_drawn")
        .agg(F.count(F.lit(1)).cast("int").alias("_times"))
    )
    found = numbered.join(drawn, F.col("_at") == F.col("_drawn"))
    return found.withColumn("_copy", F.explode(F.sequence(F.lit(1), "_times"))).select(*df.columns)
