import pytest
from pyspark.sql import functions as F

from tillsight.operators import profile
from tillsight.operators.joins import minus_history, with_baseline
from tillsight.operators.sampling import deterministic_split, sample_with_replacement


@pytest.fixture
def related(spark):
    rows = [(float(i), 2.0 * i + i % 2, float((i * 37) % 11), 5.0) for i in range(50)]
    return spark.createDataFrame(rows, "a DOUBLE, b DOUBLE, c DOUBLE, const DOUBLE")


def test_correlated_column_goes_and_constant_stays(related):
    assert profile.correlated_columns(related, ["a", "b", "c", "const"]) == ["b"]
    assert profile.correlation_prune(related).columns == ["a", "c", "const"]
    assert profile.correlation_prune(related, exclude=["a"]).columns == related.columns
    constant = profile.correlation_pairs(related, ["a", "const"]).first()
    assert constant["correlation"] is None


def test_chain_of_correlated_columns(spark):
    df = spark.createDataFrame([(i, 2 * i, 3 * i) for i in range(9)], "a INT, b BIGINT, c BIGINT")
    assert profile.correlation_prune(df).columns == ["a"]


def test_nulls_duplicates_and_overview(spark, rows):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (None, "y"), (2, None)], "k INT, s STRING")
    assert rows(profile.null_counts(df)) == [("k", 1, 25.0), ("s", 1, 25.0)]
    assert rows(profile.duplicate_count(df)) == [(4, 3, 1)]
    assert rows(profile.distinct_count(df, "k")) == [(3,)]
    assert rows(profile.overview(df, "k")) == [(4, 2, 2)]
    assert rows(profile.duplicate_count(df.where("k > 9"))) == [(0, 0, 0)]


def test_mode_ties_go_to_the_smaller_value(spark, rows):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("b", 2), ("a", 2), (None, 2)], "s STRING, n INT")
    assert rows(profile.mode_per_column(df, ["s", "n"])) == [("n", "2", 3), ("s", "a", 2)]


def test_histogram_edges(spark, rows):
    df = spark.createDataFrame([(0.0,), (1.0,), (9.99,), (10.0,), (None,)], "x DOUBLE")
    assert rows(profile.histogram(df, "x", 10).select("bin", "n")) == [(0, 1), (1, 1), (9, 2)]
    assert rows(profile.histogram(df.where("x = 1"), "x", 10).select("bin", "n")) == [(0, 1)]


def test_boxplot(spark):
    df = spark.createDataFrame([("g", float(v)) for v in [1, 2, 3, 4, 100]], "g STRING, v DOUBLE")
    r = profile.boxplot_stats(df, "g", "v").first()
    assert (r["q1"], r["median"], r["q3"], r["whisker_low"], r["whisker_high"], r["outliers"], r["n"]) == (
        2.0,
        3.0,
        4.0,
        1.0,
        4.0,
        1,
        5,
    )


def test_describe_equals_spark(spark):
    df = spark.createDataFrame([(1, "b"), (4, "a"), (None, "c")], "n INT, s STRING")
    mine = {r["column_name"]: r for r in profile.describe_table(df).collect()}
    theirs = {r["summary"]: r for r in df.describe().collect()}
    assert mine["n"]["filled"] == int(theirs["count"]["n"]) and mine["n"]["mean"] == float(theirs["mean"]["n"])
    assert mine["n"]["stddev"] == pytest.approx(float(theirs["stddev"]["n"]), abs=1e-4)
    assert (mine["s"]["min_text"], mine["s"]["max_text"]) == (theirs["min"]["s"], theirs["max"]["s"])


def test_split_does_not_depend_on_partitions(spark, rows):
    df = spark.range(1000).withColumn("g", F.col("id") % 100)
    train, test = deterministic_split(df, ["g"])
    again, _ = deterministic_split(df.repartition(7), ["g"])
    assert rows(train) == rows(again)
    assert train.count() + test.count() == 1000
    assert train.select("g").intersect(test.select("g")).count() == 0
    assert 600 < train.count() < 950


def test_sample_size_and_repetition(spark):
    df = spark.range(20)
    sample = sample_with_replacement(df, 200, seed=1)
    assert sample.count() == 200 and sample.distinct().count() <= 20
    assert sample_with_replacement(df.where("id < 0"), 5, seed=1).count() == 0


def test_joins(spark, rows):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (2, "z")], "u INT, i STRING")
    assert rows(minus_history(a, a.where("i = 'z'"), ["u", "i"])) == [(1, "x"), (2, "y")]
    assert rows(with_baseline(a, n=a.agg(F.count("*"))).select("u", "n")) == [(1, 3), (2, 3), (2, 3)]


def test_duplicates_with_a_forced_digest_clash(spark):
    """Different rows with one digest count as different; NULLs, zeros and NaN as in a grouping."""
    rows = [(1, None, 0.0), (None, "1", 0.0), (1, None, -0.0), (1, "a", float("nan")), (1, "a", float("nan")), (2, "b", None)] + [(9, "x", 1.5)] * 300
    df = spark.createDataFrame(rows, "a INT, b STRING, c DOUBLE").repartition(5)
    expected = (len(rows), df.distinct().count(), len(rows) - df.distinct().count())
    assert expected[1] == 5
    for digest in (profile.row_digest, lambda d: (F.lit(1).cast("bigint"), F.lit(2).cast("bigint")), lambda d: (F.coalesce(F.length("b"), F.lit(0)).cast("bigint"), F.lit(0).cast("bigint"))):
        got = profile.duplicate_count(df, digest).first()
        assert (got.total_rows, got.distinct_rows, got.duplicates) == expected
    none = profile.duplicate_count(df.limit(0)).first()
    assert tuple(none) == (0, 0, 0)


def test_duplicates_shuffle_digests_only(spark):
    df = spark.range(1000).selectExpr("id", "repeat(cast(id as string), 50) AS wide")
    plan = profile.duplicate_count(df)._jdf.queryExecution().optimizedPlan().toString()
    first = plan[plan.index("Aggregate [_one") :].split("scalar-subquery")[0]
    assert "wide" not in first.splitlines()[0] and "xxhash64" in first


def test_exact_distinct_by_bitmaps(spark):
    rows = [("a", 5, 10**9), ("a", 5, -3), ("a", 40_000, None), ("b", 1, 0), (None, 7, 7), (None, 7, 7), ("c", None, 1)]
    df = spark.createDataFrame(rows, "g STRING, x INT, y BIGINT").repartition(3)
    got = profile.exact_distinct(df, ["g"], {"xs": "x", "ys": "y"})
    assert {r.g: (r.xs, r.ys) for r in got.collect()} == {"a": (2, 2), "b": (1, 1), None: (1, 1), "c": (0, 1)}
    assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()


def test_sample_with_replacement_is_exact_and_repeatable(spark):
    df = spark.range(0, 1_000, 1, 7).withColumn("x", df_text())
    for n in (0, 1, 50, 3_000):
        drawn = sample_with_replacement(df, n, seed=4)
        rows = sorted(map(tuple, drawn.collect()))
        assert len(rows) == n and rows == sorted(map(tuple, sample_with_replacement(df, n, seed=4).collect()))
        assert set(rows) <= {(i, f"row {i}") for i in range(1_000)}
    many = sample_with_replacement(df, 30_000, seed=9).groupBy("id").count()
    counts = [r["count"] for r in many.collect()]
    assert len(counts) > 990 and max(counts) < 70  # about 30 each
    assert sample_with_replacement(df.limit(0), 5, seed=1).count() == 0


def df_text():
    return F.concat(F.lit("row "), F.col("id").cast("string"))
