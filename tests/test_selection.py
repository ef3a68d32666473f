import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillsight.operators.ordering import exact_quantiles, global_ntiles
from tillsight.operators.selection import Pick, rows_at


def _largest_brackets(df, groups, picks, bound):
    """The rows found, and the largest open bracket after each pass."""
    sizes = []

    def note(state):
        sizes.append(state.where("not done").agg(F.max("n")).first()[0] or 0)

    found = rows_at(df, groups, picks, "id", bound, on_pass=note)
    return found, sizes


def _picks(places):
    return [Pick(f"at{p}", "v", lambda n, p=p: F.lit(p)) for p in places]


@pytest.mark.parametrize("seed", range(4))
def test_picks_equal_a_sort(spark, seed):
    rng = random.Random(seed)
    values = [rng.choice([rng.random() * 10.0**k, float(rng.randint(0, 3)), -1e300]) for k in range(6) for _ in range(100)]
    values += [None] * 5 + ([float("inf"), float("-inf")] * 40 + [float("nan")] * 30 if seed > 1 else [])
    rows = list(enumerate(values))
    df = spark.createDataFrame(rows, "id BIGINT, v DOUBLE").repartition(4)
    places = [0, 1, 17, 300, 599, 10_000]
    found, _ = _largest_brackets(df, [], _picks(places), 10)
    row = found.first()
    order = sorted(((i, v) for i, v in rows if v is not None), key=lambda r: (math.isnan(r[1]), 0 if math.isnan(r[1]) else r[1], r[0]))
    for p in places:
        got = row[f"at{p}"]
        if p >= len(order):
            assert got is None
            continue
        i, v = order[p]
        assert got["value"] == v or math.isnan(v) and math.isnan(got["value"])
        if got["among"] is None:
            assert got["id"] == i
        else:
            assert got["among"] == p - next(k for k, (_, w) in enumerate(order) if w == v or math.isnan(v) and math.isnan(w))


def test_a_small_bound_takes_several_rounds(spark):
    """Brackets shrink pass by pass until none holds more than the bound, and nothing else is gathered."""
    n = 400_000
    df = spark.range(n).select("id", ((F.col("id") * 7_919) % n).cast("decimal(20,2)").alias("v"))
    picks = [Pick("a", "v", lambda m: F.floor(m / 3)), Pick("b", "v", lambda m: m - 5)]
    found, sizes = _largest_brackets(df, [], picks, 50)
    row = found.first()
    assert (row.a["value"], row.b["value"]) == (Decimal(n // 3), Decimal(n - 5))
    assert len(sizes) >= 4 and sizes[-1] == 0 and sizes == sorted(sizes, reverse=True)


def test_values_that_share_a_double_take_turns(spark):
    """A heavy DECIMAL beyond 2^53 is cut on its exact value, and its rows again by id."""
    base = 10**25
    values = [base + 1] * 300 + [base + 2] * 300 + [base + k for k in range(3, 200)]
    df = spark.createDataFrame([(i, str(v)) for i, v in enumerate(values)], "id BIGINT, s STRING")
    df = df.select("id", F.col("s").cast("decimal(30,2)").alias("v")).repartition(3)
    got = {r["id"]: r["t"] for r in global_ntiles(df, "id", {"t": "v"}, tiles=5, bound=20).collect()}
    sizes = [len(values) // 5 + (t < len(values) % 5) for t in range(5)]
    tiles = [t + 1 for t, s in enumerate(sizes) for _ in range(s)]
    assert got == {i: tiles[i] for i in range(len(values))}  # ids follow the values


def test_heavy_groups_and_values(spark):
    """A third of all rows in one group and one value, NULL groups, groups below the bound."""
    rng = random.Random(9)
    groups = {
        "hot": [5] * 900 + [rng.randint(0, 10_000) for _ in range(600)],
        None: [rng.randint(0, 50) for _ in range(300)],
        "two heavy": [1] * 200 + [2] * 200,
        "tiny": [3],
        "none": [],
    }
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("none", None)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g STRING, v BIGINT")
    probs = {"lo": 0.0, "q1": 0.25, "median": 0.5, "p99": 0.99, "hi": 1.0}
    got = {r["g"]: tuple(r)[1:] for r in exact_quantiles(df, ["g"], "v", probs, bound=30).collect()}

    def quantile(vs, p):
        vs, at = sorted(vs), p * (len(vs) - 1)
        lo = int(at)
        return vs[lo] + (vs[min(lo + 1, len(vs) - 1)] - vs[lo]) * (at - lo)

    expected = {g: tuple(quantile(vs, p) for p in probs.values()) for g, vs in groups.items() if vs}
    assert got.keys() == expected.keys()
    assert all(abs(a - b) < 1e-9 for g in got for a, b in zip(got[g], expected[g]))
    assert exact_quantiles(df.limit(0), ["g"], "v", probs).count() == 0


def test_passes_do_not_shuffle_the_table(spark):
    """What a pass hands on is one row per group and task, not the rows."""
    from tillsight.operators.selection import _Search

    df = spark.range(10_000).select("id", (F.col("id") % 3).alias("g"), F.rand(1).alias("v"))
    plan = _Search(df, ["g"], _picks([5]), "id", 50).first()._jdf.queryExecution().executedPlan().toString()
    assert "partial_percentile_approx" in plan and plan.count("Exchange") == 1
