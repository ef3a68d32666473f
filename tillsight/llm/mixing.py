"""Mixing sources to target weights, with DataFrame functions only.

The words of every source are summed, a repetition rate follows from each source's target,
and a document is emitted floor(rate) times plus once more if a number drawn from a hash of its
id and text is below the fraction.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..operators.ordering import global_row_number
from ..sources.shared import materialize
from .common import WORD, table, word_count

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0
SEED = "mix"


def source_targets(
    sized: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """One row per source of ``(_source, _size)``: ``_of, source_size, target, rate``.

    Sources in code point order, NULL last, take the weights in turn and share ``share`` times all
    words; no target is above ``most`` times its source's words, and what it would exceed is
    shared again by weight.  That level is the highest of the levels that result when the sources
    with the smallest room per weight are filled first.  The windows run over one row per source.
    """
    by_source = sized.groupBy("_source").agg(F.sum("_size").alias("source_size"))
    order = Window.orderBy(F.col("_source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weighed = by_source.withColumn(
        "_w", F.element_at(cycle, ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    ).withColumn("_room", F.col("source_size").cast("double") * F.lit(float(most)))
    fill = Window.orderBy(F.col("_room") / F.col("_w"), F.col("_source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    onwards = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    all_words = F.sum("source_size").over(Window.partitionBy()).cast("double") * F.lit(float(share))
    levels = weighed.withColumn(
        "_level", (all_words - F.coalesce(F.sum("_room").over(before), F.lit(0.0))) / F.sum("_w").over(onwards)
    )
    target = F.least(F.col("_room"), F.max("_level").over(Window.partitionBy()) * F.col("_w"))
    return levels.withColumn("target", target).select(
        F.col("_source").alias("_of"),
        "source_size",
        "target",
        F.coalesce(F.col("target") / F.nullif(F.col("source_size").cast("double"), F.lit(0.0)), F.lit(0.0)).alias("rate"),
    )


def row_digest(id_col: str, text: str, seed: str = SEED) -> Column:
    """A digest of seed, id and text; NULL counts as empty."""
    name = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    of_text = F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))
    return F.md5(F.concat(F.lit(seed + ":"), name, F.lit(":"), of_text).cast("binary"))


def chance(digest: str) -> Column:
    """A number in [0, 1) from the first 52 bits of a digest in hex."""
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(16**13))


def _extra(draw: Column, rows: Column, rate: Column) -> Column:
    """How many of so many equal rows are taken once more than floor(rate) times."""
    due = rows * (rate - F.floor(rate))
    return F.floor(due) + (draw < due - F.floor(due)).cast("int")


def with_copies(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The documents with ``_words, _of, source_size, target, rate, _copies``.

    The table is read twice: once for a narrow row of each document, stored with the few sums so that Spark
    knows their sizes when it plans the joins, and once for the result.  A third of all rows in one source is no
    matter: sums are combined before the shuffle, and a join that is not broadcast has one row per
    source on its other side, so that adaptive execution can split it.
    NULL and empty texts have no words; a source without words has rate 0.  A document's draw comes from id and
    text.  Rows that agree in source, id and text share one draw, which decides how many of them are taken
    once more: they are numbered in contiguous ranges of all their columns, so that no group needs a task of its own.
    """
    digested = docs.withColumns({"_words": word_count(text), "_digest": row_digest(id_col, text)})
    sized = materialize(
        digested.groupBy(F.col(source).alias("_source"), "_digest").agg(
            F.count(F.lit(1)).alias("_rows"), F.sum("_words").alias("_size")
        )
    )
    targets = materialize(source_targets(sized))
    rated = digested.join(targets, F.col(source).eqNullSafe(F.col("_of")), "left")
    equal = materialize(sized.where("_rows > 1").select("_source", F.col("_digest").alias("_same"), "_rows"))
    of_equal = (F.col("_digest") == F.col("_same")) & F.col(source).eqNullSafe(F.col("_source"))
    once = rated.join(equal, of_equal, "left_anti").withColumn(
        "_copies", (F.floor("rate") + _extra(chance("_digest"), F.lit(1), F.col("rate"))).cast("long")
    )
    if equal.isEmpty():
        return once.drop("_digest")
    names = docs.columns
    repeated = rated.join(equal, of_equal).withColumns(
        {"_order": F.xxhash64(*names), "_tie": F.monotonically_increasing_id()}
    )
    order = [F.col("_same"), F.col("_source"), F.col("_order"), F.col("_tie")]
    numbered = materialize(global_row_number(repeated, "_at", *order))
    firsts = numbered.groupBy(F.col("_same").alias("_same2"), F.col("_source").alias("_source2")).agg(F.min("_at").alias("_first"))
    placed = numbered.join(
        firsts, (F.col("_same") == F.col("_same2")) & F.col("_source").eqNullSafe(F.col("_source2"))
    )
    extra = _extra(chance("_digest"), F.col("_rows"), F.col("rate"))
    several = placed.withColumn("_copies", (F.floor("rate") + (F.col("_at") - F.col("_first") < extra).cast("int")).cast("long"))
    return once.unionByName(several.select(*once.columns)).drop("_digest")


def mix_report(docs: DataFrame) -> DataFrame:
    """What the mix takes of every document."""
    return with_copies(docs.select("doc_id", "text", "source")).select(
        "doc_id",
        F.col("_words").alias("size"),
        "source_size",
        "target",
        (F.col("_words") * F.col("_copies")).alias("taken"),
    )


def mix(docs: DataFrame) -> DataFrame:
    """The mixed documents: every document as often as it is taken, with its own columns only.

    A column of ``docs`` named as one that is added here stays: it is set aside meanwhile.
    """
    names = docs.columns
    aside = docs.toDF(*[f"d{i}" for i in range(len(names))])
    at = {n: f"d{i}" for i, n in reversed(list(enumerate(names)))}
    counted = with_copies(aside, at["doc_id"], at["text"], at["source"])
    return counted.where("_copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(
        *[F.col(f"d{i}").alias(n) for i, n in enumerate(names)]
    )


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`mix_report` of ``documents``."""
    return mix_report(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))


OP9_SQL = rf"""
WITH sized AS (
  SELECT doc_id, source, CAST(LEN(REGEXP_EXTRACT_ALL(COALESCE(text, ''), '{WORD}')) AS BIGINT) AS size,
    MD5('{SEED}:' || COALESCE(CAST(doc_id AS VARCHAR), '') || ':' || MD5(COALESCE(text, ''))) AS digest FROM documents),
by_source AS (SELECT source, CAST(SUM(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, CAST([3, 1, 2][CAST((ROW_NUMBER() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS DOUBLE) AS w,
    source_size * 2e0 AS room FROM by_source),
levels AS (
  SELECT *, ((SUM(source_size) OVER ()) * 15e-1 - COALESCE(SUM(room) OVER (
      ORDER BY room / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0e0))
    / SUM(w) OVER (ORDER BY room / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
targets AS (SELECT source, source_size, LEAST(room, (MAX(level) OVER ()) * w) AS target FROM levels),
rated AS (
  SELECT doc_id, size, source_size, target, COALESCE(target / NULLIF(CAST(source_size AS DOUBLE), 0e0), 0e0) AS rate,
    CAST(CAST('0x' || SUBSTR(digest, 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496e0 AS draw,
    COUNT(*) OVER (PARTITION BY sized.source, digest) AS equal_rows,
    ROW_NUMBER() OVER (PARTITION BY sized.source, digest) - 1 AS place
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source),
due AS (SELECT *, equal_rows * (rate - FLOOR(rate)) AS due FROM rated)
SELECT doc_id, size, source_size, target,
  size * CAST(FLOOR(rate) + CASE WHEN place < FLOOR(due) + CASE WHEN draw < due - FLOOR(due) THEN 1 ELSE 0 END THEN 1 ELSE 0 END
    AS BIGINT) AS taken
FROM due
"""
