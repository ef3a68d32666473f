import random

import pytest
from pyspark.sql import functions as F

from tillsight.operators.ordering import exact_quantiles, global_ntiles, global_row_number, global_running_sum
from tillsight.operators.ranking import share_in_group, top_k_per_group


def _frame(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "id BIGINT, v DOUBLE").repartition(5)


def _expected_order(values, descending=False):
    def key(i):
        v = values[i]
        return (v is not None, 0 if v is None else (-v if descending else v), i)

    return {i: n for n, i in enumerate(sorted(range(len(values)), key=key), start=1)}


SHAPES = {
    "distinct": [float(x) for x in random.Random(1).sample(range(10_000), 500)],
    "one heavy value": [7.0] * 400 + [float(x) for x in range(100)],
    "few values and gaps": [random.Random(2).choice([1.0, 2.0, 2.5, None]) for _ in range(300)],
    "all equal": [3.0] * 200,
    "all missing": [None] * 20,
    "single": [1.0],
}


def _tiles(order, tiles):
    """Tile of each id from its place in the whole order."""
    n = len(order)
    sizes = [n // tiles + (1 if t < n % tiles else 0) for t in range(tiles)]
    by_place = [t for t, size in enumerate(sizes, start=1) for _ in range(size)]
    return {i: by_place[place - 1] for i, place in order.items()}


@pytest.mark.parametrize("shape", SHAPES)
@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("tiles", [4, 17])
def test_tiles_over_everything(spark, shape, descending, tiles):
    values = SHAPES[shape]
    got = global_ntiles(_frame(spark, values), "id", {"t": "v"}, tiles, descending, bound=10)
    assert {r["id"]: r["t"] for r in got.collect()} == _tiles(_expected_order(values, descending), tiles)


def test_empty_input(spark):
    assert global_ntiles(_frame(spark, [1.0]).where("id < 0"), "id", {"t": "v"}).count() == 0


@pytest.mark.parametrize("n", [1, 3, 4, 5, 10])
def test_tile_sizes(spark, n):
    got = global_ntiles(_frame(spark, [float(i % 3) for i in range(n)]), "id", {"t": "v"}, tiles=4, bound=10)
    sizes = [got.where(F.col("t") == t).count() for t in (1, 2, 3, 4)]
    assert sizes == [n // 4 + (1 if t < n % 4 else 0) for t in range(4)]


def test_large_decimals_that_share_a_double(spark):
    """Neighbours that a DOUBLE cannot tell apart keep their order."""
    base = 10**20
    rows = [(i, f"{base + (i * 7) % 40}") for i in range(40)]
    df = spark.createDataFrame(rows, "id BIGINT, s STRING").select("id", F.col("s").cast("decimal(22,0)").alias("v"))
    got = {r["id"]: r["t"] for r in global_ntiles(df, "id", {"t": "v"}, tiles=40, bound=10).collect()}
    assert got == {i: n for n, i in enumerate(sorted(range(40), key=lambda i: (i * 7) % 40), start=1)}


def test_several_orders_at_once(spark):
    rows = [(i, (i * 31) % 97, i % 5) for i in range(90)]
    df = spark.createDataFrame(rows, "id BIGINT, a INT, b INT")
    got = global_ntiles(df, "id", {"ta": "a", "tb": "b"}, bound=10).collect()
    for out, c in (("ta", 1), ("tb", 2)):
        order = {r[0]: n for n, r in enumerate(sorted(rows, key=lambda r: (r[c], r[0])), start=1)}
        assert {r["id"]: r[out] for r in got} == _tiles(order, 4)


def test_running_sum(spark):
    rows = [(float(v), v % 7) for v in random.Random(3).sample(range(5_000), 400)]
    df = spark.createDataFrame(rows, "v DOUBLE, m BIGINT")
    before, expected = 0, {}
    for v, m in sorted(rows):
        expected[v] = before
        before += m
    got = global_running_sum(df, "v", ["m"], ranges=8)
    assert {r["v"]: r["m_before"] for r in got.collect()} == expected


def test_row_number(spark):
    rows = [(i, i % 5 if i % 9 else None) for i in random.Random(5).sample(range(900), 300)]
    df = spark.createDataFrame(rows, "id BIGINT, v INT")
    expected = sorted(rows, key=lambda r: (r[1] is not None, -(r[1] or 0), r[0]))
    got = global_row_number(df, "n", F.desc_nulls_first("v"), F.col("id"), ranges=8).collect()
    assert {r["n"]: (r["id"], r["v"]) for r in got} == dict(enumerate(expected, start=1))
    assert global_row_number(df.limit(0), "n", F.col("id")).count() == 0


def test_quantiles_of_skewed_groups(spark):
    rng = random.Random(4)
    groups = {
        "big": [float(rng.choice([1, 2, 2, 2, 5, 900])) for _ in range(700)],
        "small": [3.0, 1.0],
        "one": [4.5],
        None: [1.0, 2.0, 4.0],
    }
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs] + [("small", None)], "g STRING, v DOUBLE")
    got = exact_quantiles(df, ["g"], "v", {"q1": 0.25, "median": 0.5, "top": 1.0}, bound=10)

    def quantile(vs, p):
        vs, at = sorted(vs), p * (len(vs) - 1)
        lo = int(at)
        return vs[lo] + (vs[min(lo + 1, len(vs) - 1)] - vs[lo]) * (at - lo)

    assert {r["g"]: tuple(r)[1:] for r in got.collect()} == {
        g: tuple(quantile(vs, p) for p in (0.25, 0.5, 1.0)) for g, vs in groups.items()
    }


def test_ties_across_the_cut(spark, rows):
    df = spark.createDataFrame([("g", "a", 5), ("g", "b", 5), ("g", "c", 5), ("h", "z", 1)], "g STRING, k STRING, n INT")
    two = top_k_per_group(df, ["g"], [F.desc("n"), "k"], 2).select("g", "k")
    assert rows(two) == [("g", "a"), ("g", "b"), ("h", "z")]
    tied = top_k_per_group(df, ["g"], [F.desc("n")], 2, keep_ties=True)
    assert tied.count() == 4


def test_shares_add_up(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", 0)], "g STRING, n INT")
    got = {(r["g"], r["n"]): r["p"] for r in share_in_group(df, ["g"], "n", "p").collect()}
    assert got == {("a", 1): 25.0, ("a", 3): 75.0, ("b", 0): None}
