"""Rows at given places of an order, found by narrowing instead of sorting.

A sketch brackets each wanted place between two values.  The next pass counts the rows between, at and beside
all such values, which tells exactly where a place lies.  The rows between the two are gathered and sorted if they
can be no more than a bound, else sketched again for the next pass.  A task hands on a few counts per group
and those rows, so nothing as long as the table is shuffled or written.
The sketches decide how fast a bracket shrinks, never the result: a pass removes two values at least.

The input is read once a pass: hand in a table scan or a materialized frame.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DecimalType, FractionalType

from ..sources.shared import materialize

#: Rows of a bracket that are gathered and sorted in one place, at most.
BOUND = 50_000
_ACCURACY = 10_000
_GRID = 64
_MARGIN = 2 / _ACCURACY


@dataclass(frozen=True)
class Pick:
    """A row to find: its place, from 0, in the order of ``column`` among the rows where that is not NULL.

    ``place`` makes the place of the number of such rows in the group; ``near`` is about the fraction of them
    that come before, if it is known.
    """

    name: str
    column: str
    place: Callable[[Column], Column]
    near: float | None = None


def _cutting(kind: str, floating: bool) -> tuple[Callable, Callable]:
    """Distance of a value from a base as DOUBLE, and the value at a distance.

    Distances tell close values apart that large doubles cannot.
    """
    infinite = lambda b: F.isnan(b) | (F.abs(b) == float("inf"))
    if floating:
        return (
            lambda x, base: F.when(infinite(base), x).otherwise(x - base).cast("double"),
            lambda off, base: F.when(infinite(base), off).otherwise(base + off).cast(kind),
        )
    return (
        lambda x, base: F.try_subtract(x, base).cast("double"),
        lambda off, base: F.try_add(base, off.try_cast(kind)).try_cast(kind),
    )


def _common_type(df: DataFrame, columns: Sequence[str]) -> tuple[str, bool]:
    """A type that holds the values of all columns exactly, and whether it is a floating one."""
    kinds = [df.schema[c].dataType for c in columns]
    if any(isinstance(k, FractionalType) and not isinstance(k, DecimalType) for k in kinds):
        if not all(isinstance(k, FractionalType) and not isinstance(k, DecimalType) for k in kinds):
            raise ValueError("floating and exact columns cannot be searched together")
        return "double", True
    if not any(isinstance(k, DecimalType) for k in kinds):
        return "bigint", False
    sizes = [(k.precision - k.scale, k.scale) if isinstance(k, DecimalType) else (20, 0) for k in kinds]
    scale = max(s for _, s in sizes)
    return f"decimal({min(38, max(w for w, _ in sizes) + scale)},{scale})", False


class _Search:
    """``rows``: group keys, number of the column, its value ``x`` and the payload.

    A state row is a pick ``(keys, _column, pick, place, rows)`` with its open bracket ``lo, hi``, which holds ``n`` rows after
    ``start`` others, and the values ``c, d`` to try next; or, once ``done``, with the value ``v`` and its row.
    """

    def __init__(self, df: DataFrame, groups: Sequence[str], picks: Sequence[Pick], payload: str | None, bound: int) -> None:
        groups_ = [f"_g{i}" for i in range(len(groups))]
        self.columns = sorted({p.column for p in picks})
        self.kind, floating = _common_type(df, self.columns)
        self.offset, self.moved = _cutting(self.kind, floating)
        values = [F.struct(F.lit(k).alias("_column"), F.col(c).cast(self.kind).alias("x")) for k, c in enumerate(self.columns)]
        self.rows = df.select(
            *[F.col(g).alias(k) for g, k in zip(groups, groups_)],
            (F.col(payload) if payload else F.lit(None).cast("int")).alias("_id"),
            F.inline(F.array(*values)),
        ).where("x is not null")
        self.keys, self.alone = [*groups_, "_column"], not groups
        self.picks, self.bound = list(picks), bound
        close = {p.near + s * 2 * _MARGIN for p in picks if p.near is not None for s in (-1, 1)}
        self.fractions = sorted({i / _GRID for i in range(_GRID + 1)} | {f for f in close if 0 < f < 1})

    def _cuts(self, offset: str) -> Column:
        return F.expr(f"percentile_approx({offset}, {self._known()}, {_ACCURACY})")

    def _known(self) -> str:
        return "array(" + ",".join(f"{f!r}D" for f in self.fractions) + ")"

    def _same(self, other: str) -> Column:
        return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(k + other)) for k in self.keys])

    def _with(self, rows: DataFrame, small: DataFrame) -> DataFrame:
        """Rows with the columns of a frame that has one row per group and column."""
        named = small.withColumnsRenamed({k: k + "_of" for k in self.keys})
        if self.alone:  # one row per column
            named = F.broadcast(named)
        return rows.join(named, self._same("_of")).drop(*[k + "_of" for k in self.keys])

    def _tried(self, found: DataFrame) -> DataFrame:
        """State from picks with their bracket: the values of its sketch that lie safely around the place."""
        share = (F.col("place") - F.col("start")).cast("double") / F.col("n")
        known = F.expr(self._known())
        guess = {
            "_low": F.get("cuts", F.size(F.filter(known, lambda f: f <= share - 1.5 * _MARGIN)) - 1),
            "_high": F.get("cuts", F.size(F.filter(known, lambda f: f < share + 1.5 * _MARGIN))),
        }
        least, most = F.col("least"), F.col("most")
        single = ~F.col("done") & (least == most)
        return (
            found.withColumns(guess)
            .withColumn("c", F.least(F.greatest(F.coalesce(self.moved(F.col("_low"), F.col("base")), least), least), most))
            .withColumn("d", F.least(F.greatest(F.coalesce(self.moved(F.col("_high"), F.col("base")), most), "c"), most))
            .withColumn("v", F.when(single, least).otherwise(F.col("v")))
            .withColumn("among", F.when(single, F.col("place") - F.col("start")).otherwise(F.col("among")))
            .withColumn("done", F.col("done") | single)
            .select(*self.keys, "pick", "place", "rows", "lo", "hi", "start", "n", "c", "d", "done", "v", "id", "among")
        )

    def first(self) -> DataFrame:
        """The picks of all groups, with counts and a sketch of the whole column."""
        x, none = F.col("x"), F.lit(None).cast(self.kind)
        base = F.lit(0).cast(self.kind)
        counted = (
            self.rows.withColumn("_off", self.offset(x, base))
            .groupBy(*self.keys)
            .agg(F.count(F.lit(1)).alias("rows"), F.min(x).alias("least"), F.max(x).alias("most"), self._cuts("_off").alias("cuts"))
        )
        wanted = [
            F.struct(F.lit(self.columns.index(p.column)).alias("_of"), F.lit(i).alias("pick"), p.place(F.col("rows")).cast("long").alias("place"))
            for i, p in enumerate(self.picks)
        ]
        listed = counted.select("*", F.inline(F.array(*wanted))).where("_of = _column and place >= 0 and place < rows")
        return self._tried(
            listed.withColumns(
                {
                    "lo": none,
                    "hi": none,
                    "base": base,
                    "start": F.lit(0).cast("long"),
                    "n": F.col("rows"),
                    "done": F.lit(False),
                    "v": none,
                    "id": F.lit(None).cast(self.rows.schema["_id"].dataType),
                    "among": F.lit(None).cast("long"),
                }
            )
        )

    def _upto(self) -> Column:
        """How many of the sorted ends are not above ``x``: written out if they are few."""
        x, most = F.col("x"), 4 * max(sum(p.column == c for p in self.picks) for c in self.columns)
        if most > 32:
            return F.size(F.filter("_ends", lambda e: e <= x))
        return F.expr(" + ".join(f"if(coalesce(get(_ends, {i}) <= x, false), 1, 0)" for i in range(most)))

    def narrowed(self, state: DataFrame) -> DataFrame:
        """One pass over the rows of the groups in ``state``: the state of its picks afterwards.

        The values to try and the ends of the brackets cut the range; every row is counted at one of them
        (odd pieces) or between two (even pieces).  ``_use`` says of each piece whether its rows are sketched or gathered: a sketch
        of n rows leaves at most 8 n / accuracy of them between two neighbouring values.
        """
        ends = F.array_compact(F.flatten(F.collect_list(F.array("lo", "c", "d", "hi"))))
        few = F.least(F.col("n"), F.ceil(F.col("n") * F.lit(4 * _MARGIN))) <= self.bound
        by_grid = (F.col("n") <= self.bound) | (few & F.col("lo").isNull() & F.col("hi").isNull() & F.lit(self._close()))
        tries = F.collect_set(F.struct("c", "d", F.when(by_grid, "gather").otherwise("sketch").alias("use")))
        cut = (
            state.groupBy(*self.keys)
            .agg(F.array_sort(F.array_distinct(ends)).alias("_ends"), tries.alias("_tries"))
            .withColumn("_use", F.expr(
                "transform(sequence(0, size(_ends)), i -> array_min(transform(filter(_tries, t -> i > 0 and i < size(_ends) "
                "and get(_ends, i - 1) >= t.c and get(_ends, i) <= t.d), t -> t.use)))"
            ))
            .drop("_tries")
        )
        x = F.col("x")
        placed = (
            self._with(self.rows, cut)
            .withColumn("_upto", self._upto())
            .withColumn("_lower", F.get("_ends", F.col("_upto") - 1))
            .withColumn("_at", F.coalesce(F.col("_lower") == x, F.lit(False)))
            .withColumn("piece", F.col("_upto") * 2 - F.col("_at").cast("int"))
            .withColumn("_use", F.when(~F.col("_at"), F.get("_use", F.col("_upto"))))
            .withColumn("_off", F.when(F.col("_use") == "sketch", self.offset(x, F.col("_lower"))))
        )
        counted = placed.groupBy(*self.keys, "piece").agg(
            F.count(F.lit(1)).alias("n"),
            F.min(x).alias("least"),
            F.max(x).alias("most"),
            self._cuts("_off").alias("cuts"),
            F.collect_list(F.when(F.col("_use") == "gather", F.struct("x", "_id"))).alias("_rows"),
        )
        before = Window.partitionBy(*self.keys).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
        pieces = self._with(counted.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))), cut)
        picks = state.select(*[F.col(k).alias(k + "_at") for k in self.keys], "pick", "place", "rows")
        holds = (F.col("start") <= F.col("place")) & (F.col("place") < F.col("start") + F.col("n"))
        row = F.get(F.array_sort("_rows"), (F.col("place") - F.col("start")).cast("int"))
        at = F.col("piece") % 2 == 1
        found = pieces.join(picks, self._same("_at") & holds).withColumn("_row", F.when(F.size("_rows") == F.col("n"), row))
        return self._tried(
            found.withColumns(
                {
                    "lo": F.get("_ends", (F.col("piece") / 2).cast("int") - 1),
                    "hi": F.get("_ends", (F.col("piece") / 2).cast("int")),
                    "base": F.get("_ends", (F.col("piece") / 2).cast("int") - 1),
                    "done": at | F.col("_row").isNotNull(),
                    "v": F.when(at, F.col("least")).otherwise(F.col("_row.x")),
                    "id": F.col("_row._id"),
                    "among": F.when(at, F.col("place") - F.col("start")),
                }
            )
        )

    def _close(self) -> bool:
        """Whether the first sketch was cut closely around every place."""
        return all(p.near is not None for p in self.picks)

    def pivoted(self, state: DataFrame) -> DataFrame:
        """One row per group, with the picks side by side."""
        found = F.struct(F.col("v").alias("value"), "id", "among", "rows")
        return state.groupBy(*self.keys[:-1]).agg(
            *[F.max(F.when(F.col("pick") == i, found)).alias(p.name) for i, p in enumerate(self.picks)]
        )


def rows_at(
    df: DataFrame,
    groups: Sequence[str],
    picks: Sequence[Pick],
    payload: str | None = None,
    bound: int = BOUND,
    on_pass: Callable[[DataFrame], None] | None = None,
) -> DataFrame:
    """One row per group that has a row to find: its columns, and per pick a struct ``value, id, among, rows``.

    ``rows`` is the number of rows that have a value.  Rows with equal values go by ``payload``.  Where its bracket was
    gathered, ``id`` is the payload of the row found and ``among`` NULL.  A value that a pass met on its own, as it does
    one on more rows than the bound, is known without gathering: then ``id`` is NULL and ``among`` the place, from 0,
    among the rows of that value.  A pick whose place does not exist is NULL.  Without groups there is always one row.
    ``on_pass`` is handed the state of every pass.
    """
    search = _Search(df, groups, picks, payload, bound)
    state = materialize(search.first())
    while True:
        if on_pass:
            on_pass(state)
        left = state.where(~F.col("done"))
        if left.isEmpty():
            return search.pivoted(state).withColumnsRenamed(dict(zip(search.keys, groups)))
        state = materialize(search.narrowed(left).unionByName(state.where("done")))
