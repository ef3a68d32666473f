"""Exact ordering functions over a whole table, without moving it into one task.

Tiles and quantiles look for the few rows that stand at given places, see :mod:`.selection`.  Row numbers and
running sums deal the table to contiguous ranges of its order, each sorted in a task of its own and moved
by what comes before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.shared import materialize
from .selection import BOUND, Pick, rows_at


def _tile_ends(keyed: DataFrame, orders: Sequence[str], id_col: str, tiles: int, bound: int) -> dict[str, list[tuple]]:
    """Key and id of the last row of every tile but the last one, for each order; NULL keys come first.

    Keys are sought for all orders at once.  Where an end falls among the rows of one key that are too many to
    gather, or that have no key, its id is sought among them, again for all ends at once.
    """
    rows = keyed.count()
    if not rows:
        return {}
    ends = [rows // tiles * t + min(t, rows % tiles) - 1 for t in range(1, tiles)]  # places from 0

    def place(end: int):
        return lambda n: F.lit(end - rows) + n  # NULL keys stand before all others

    picks = [Pick(f"{o}_{t}", o, place(end), (end + 1) / rows) for o in orders for t, end in enumerate(ends)]
    found = {}
    for kind in {str(keyed.schema[o].dataType) in ("DoubleType()", "FloatType()") for o in orders}:
        alike = [p for p in picks if (str(keyed.schema[p.column].dataType) in ("DoubleType()", "FloatType()")) == kind]
        found |= rows_at(keyed, [], alike, id_col, bound).first().asDict()
    known, again, columns = {}, {}, {}
    for p in picks:
        at = found[p.name]
        end = ends[int(p.name.rsplit("_", 1)[1])]
        if at is not None and at["among"] is None:
            known[p.name] = (at["value"], at["id"])
        else:  # one heavy key, or no key
            value, among = (None, end) if at is None else (at["value"], at["among"])
            again[p.name] = (value, among)
            columns[p.name] = F.when(F.col(p.column).eqNullSafe(F.lit(value)), F.col(id_col))
    if again:
        ids = keyed.select(*[c.alias(name) for name, c in columns.items()])
        picks_again = [Pick(name, name, lambda n, a=among: F.lit(a)) for name, (_, among) in again.items()]
        by_id = rows_at(ids, [], picks_again, None, bound).first()
        known |= {name: (value, by_id[name]["value"]) for name, (value, _) in again.items()}
    return {o: [known[f"{o}_{t}"] for t in range(len(ends))] for o in orders}


def _after(key: Column, id_col: str, end: tuple) -> Column:
    """Whether a row comes after the given key and id; NULL keys come first."""
    end_key, end_id = end
    later_id = F.col(id_col) > F.lit(end_id)
    if end_key is None:
        return key.isNotNull() | later_id
    return F.coalesce((key > F.lit(end_key)) | ((key == F.lit(end_key)) & later_id), F.lit(False))


def global_ntiles(
    df: DataFrame, id_col: str, orders: dict[str, str], tiles: int = 4, descending: bool = False, bound: int = BOUND
) -> DataFrame:
    """``ntile(tiles)`` over the whole table, once for each ``output: order column``.

    Ties go by a unique numeric id and NULLs come first.  The first ``rows % tiles`` tiles
    hold one row more.  A tile is told by its last row, and the few last rows are found by narrowing, for
    all orders in the same passes; no task sorts more than ``bound`` rows.  The table itself gets its
    tiles by comparison with them: it is neither sorted nor shuffled.
    """
    keys = {out: -F.col(c) if descending else F.col(c) for out, c in orders.items()}
    names = {out: f"k{i}" for i, out in enumerate(keys)}
    keyed = df.select(F.col(id_col).alias("_id"), *[keys[out].alias(n) for out, n in names.items()])
    ends = _tile_ends(keyed, list(names.values()), "_id", tiles, bound)
    tiled = df
    for out, key in keys.items():
        tile = F.lit(1)
        for end in ends.get(names[out], []):
            tile = tile + _after(key, id_col, end).cast("int")
        tiled = tiled.withColumn(out, tile)
    return tiled


def exact_quantiles(
    df: DataFrame, groups: Sequence[str], value: str, probs: dict[str, float], bound: int = BOUND
) -> DataFrame:
    """Exact interpolated quantiles per group, one DOUBLE column per entry of ``probs``.

    Groups without a value are left out.  Nothing of the table's length is shuffled or written, and a group that
    holds a large part of all rows is never gathered in one task.
    """

    def place(p: float, upper: bool):
        return lambda n: (F.ceil if upper else F.floor)((n.cast("double") - 1.0) * F.lit(float(p)))

    picks = [Pick(f"_{i}_{side}", value, place(p, side), p) for i, p in enumerate(probs.values()) for side in (0, 1)]
    found = rows_at(df.where(F.col(value).isNotNull()), groups, picks, None, bound)
    out = []
    for i, (name, p) in enumerate(probs.items()):
        low, high = F.col(f"_{i}_0.value").cast("double"), F.col(f"_{i}_1.value").cast("double")
        at = (F.col(f"_{i}_0.rows").cast("double") - 1.0) * F.lit(float(p))
        out.append((low + (high - low) * (at - F.floor(at).cast("double"))).alias(name))
    return found.select(*groups, *out)


def _stored_ranges(df: DataFrame, ranges: int | None, *order: Column) -> DataFrame:
    """A stored table, dealt to contiguous ranges of a unique order, which ``_range`` numbers in that order.

    There are as many ranges as the session has shuffle partitions, unless told otherwise.
    """
    dealt = df.repartitionByRange(*order) if ranges is None else df.repartitionByRange(ranges, *order)
    return materialize(dealt.withColumn("_range", F.spark_partition_id()))


def _earlier_ranges():
    return Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)


def global_row_number(df: DataFrame, out: str, *order: Column, ranges: int | None = None) -> DataFrame:
    """Number all rows from 1 in a unique order; a range's rows are counted, and sorted in a task of their own."""
    ranged = _stored_ranges(df, ranges, *order)
    offsets = (
        ranged.groupBy("_range")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_range", F.coalesce(F.sum("_n").over(_earlier_ranges()), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy("_range").orderBy(*order)
    return (
        ranged.join(offsets, "_range")
        .withColumn(out, F.col("_offset") + F.row_number().over(inside))
        .drop("_range", "_offset")
    )


def global_running_sum(
    df: DataFrame, order_col: str, measures: Sequence[str], suffix: str = "_before", ranges: int | None = None
) -> DataFrame:
    """For each row the sum of every measure over all rows with a smaller order value.

    ``order_col`` must be unique and not NULL, as it is after grouping by it.
    """
    ranged = _stored_ranges(df, ranges, F.col(order_col))
    offsets = (
        ranged.groupBy("_range")
        .agg(*[F.sum(m).alias(f"_s_{m}") for m in measures])
        .select(
            "_range",
            *[F.coalesce(F.sum(f"_s_{m}").over(_earlier_ranges()), F.lit(0)).alias(f"_o_{m}") for m in measures],
        )
    )
    inside = Window.partitionBy("_range").orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranged.join(offsets, "_range")
        .withColumns(
            {m + suffix: F.col(f"_o_{m}") + F.coalesce(F.sum(m).over(inside), F.lit(0)) for m in measures}
        )
        .drop("_range", *[f"_o_{m}" for m in measures])
    )
