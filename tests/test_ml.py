import random
from dataclasses import replace

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import IndexToString
from pyspark.sql import functions as F

from tillsight.ml import classifiers, metrics, recommend
from tillsight.ml.features import fit_bins, fit_index, label_table, with_index, with_label

SPEC = classifiers.ForestSpec("target", ("colour",), ("x",), trees=4, depth=3)


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(6)
    rows = []
    for i in range(300):
        x, colour = rng.random(), rng.choice(["red", "blue"])
        rows.append((i, colour, x, "Yes" if x > 0.5 or colour == "red" and rng.random() > 0.7 else "No"))
    return spark.createDataFrame(rows, "id INT, colour STRING, x DOUBLE, target STRING")


@pytest.fixture(scope="module")
def rows_to_fit(labelled):
    return classifiers.training_rows(labelled, SPEC)


@pytest.fixture(scope="module")
def model(rows_to_fit):
    return classifiers.fit_forest(rows_to_fit, SPEC)


def test_index_order_and_unseen(spark):
    df = spark.createDataFrame([("b",), ("b",), ("c",), ("a",)], "s STRING")
    assert list(fit_index(df, "s", "i").labels) == ["b", "a", "c"]
    other = spark.createDataFrame([("z",), ("b",)], "s STRING")
    assert fit_index(df, "s", "i", unseen="skip").transform(other).count() == 1


def test_scores_are_repeatable(labelled, rows_to_fit, model):
    again = classifiers.fit_forest(rows_to_fit, SPEC)
    a = classifiers.score_class(model, labelled, ["id"]).orderBy("id").collect()
    b = classifiers.score_class(again, labelled, ["id"]).orderBy("id").collect()
    assert a == b
    assert all(0 <= r["probability"] <= 1 for r in a)
    assert all((r["probability"] > 0.5) == (r["decision"] == "Yes") for r in a if r["probability"] != 0.5)


def test_scenarios_rank_classes(labelled, model):
    got = classifiers.score_scenarios(model, labelled, ["id"], "colour", ["red", "blue", "unseen"], k=2)
    assert got.count() == 300 * 3 * 2
    sums = got.groupBy("id", "colour").agg(F.sum("probability").alias("s"), F.max("rank").alias("r"))
    assert sums.where((F.abs(F.col("s") - 1) > 1e-9) | (F.col("r") != 2)).count() == 0


def test_load_or_train(labelled, model, tmp_path):
    path = str(tmp_path / "m")
    calls = []

    def fit():
        calls.append(1)
        return model

    classifiers.load_or_train(path, fit)
    loaded = classifiers.load_or_train(path, fit)
    assert len(calls) == 1 and isinstance(loaded.stages[-1], IndexToString)
    from pyspark.ml import PipelineModel

    classifiers.save_model(PipelineModel(model.stages[:-1]), path)  # without names at the end
    classifiers.load_or_train(path, fit)
    assert len(calls) == 2
    broken = tmp_path / "broken" / "metadata"
    broken.mkdir(parents=True)
    (broken / "part-00000").write_text("not a model")
    with pytest.raises(Exception):
        classifiers.load_or_train(str(broken.parent), fit)
    assert len(calls) == 2 and (broken / "part-00000").exists()


def test_metrics_equal_evaluators(labelled, model):
    scored = model.transform(labelled)
    mine = metrics.classification_metrics(scored).first()
    theirs = metrics.evaluator_metrics(scored)
    for a, b in zip(("accuracy", "weighted_precision", "weighted_recall", "f1"), theirs.values()):
        assert mine[a] == pytest.approx(b, abs=1e-6)
    from pyspark.ml.functions import vector_to_array

    frame = scored.select(vector_to_array("probability")[1].alias("p"), (F.col("label") == 1).alias("pos"), "label")
    auc = metrics.auc_roc(frame, "p", "pos").first()[0]
    assert auc == pytest.approx(metrics.evaluator_auc(scored), abs=1e-6)


def test_rmse(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, None), (5.0, float("nan"))], "y DOUBLE, prediction DOUBLE")
    assert metrics.rmse(df, "y", "prediction").first()[0] == pytest.approx(0.5**0.5, abs=1e-6)


def _history():
    rng = random.Random(7)
    rows = {(u, f"i{rng.randrange(9)}") for u in range(40) for _ in range(rng.randrange(1, 9))}
    rows |= {(100, f"i{i}") for i in range(9)}  # has everything
    rows |= {(101, "i8")}
    return sorted(rows)


def test_popular_unseen_equals_brute_force(spark):
    history = _history()
    buyers = {}
    for _, i in history:
        buyers[i] = buyers.get(i, 0) + 1
    ranked = sorted(buyers, key=lambda i: (-buyers[i], i))
    expected = set()
    for u in {u for u, _ in history}:
        own = {i for v, i in history if v == u}
        expected |= {(u, i, buyers[i], n) for n, i in enumerate([i for i in ranked if i not in own][:3], start=1)}
    df = spark.createDataFrame(history, "user_id INT, item STRING")
    got = recommend.popular_unseen(df, "item", k=3)
    assert {(r["user_id"], r["item"], r["buyers"], r["rank"]) for r in got.collect()} == expected
    assert not [r for r in expected if r[0] == 100]


def test_novel_recommendations_leave_out_history(spark, tmp_path):
    history = _history()
    rows = [(u, i, float(1 + (u * 7 + int(i[1:])) % 5)) for u, i in history] + [(0, "i0", 2.0)] * 2
    df = spark.createDataFrame(rows, "user INT, item STRING, rating DOUBLE").withColumn("rating", F.col("rating").cast("decimal(3,1)"))
    labels = label_table(df, "item")
    ratings = recommend.interactions(df, labels, "user", "item", "rating").cache()
    assert ratings.count() == len(set(history) | {(0, "i0")})
    model = recommend.load_or_train_als(str(tmp_path / "als"), lambda: recommend.train_als(ratings, iterations=3))
    model = recommend.load_or_train_als(str(tmp_path / "als"), None)
    got = recommend.novel_recommendations(model, ratings.select("user_id", "item_id"), labels, "item").collect()
    seen = set(history) | {(0, "i0")}
    assert not [r for r in got if (r["user_id"], r["item"]) in seen]
    per_user = {}
    for r in got:
        per_user[r["user_id"]] = per_user.get(r["user_id"], 0) + 1
    for u in {u for u, _ in seen}:
        assert per_user.get(u, 0) == min(3, 9 - len([1 for v, _ in seen if v == u]))


def test_labels_as_a_table(spark, monkeypatch):
    """Numbers as the string indexer gives them; hot values are joined apart, and the way back needs the index only."""
    from tillsight.ml import features

    values = ["b"] * 50 + ["a"] * 50 + [f"v{k}" for k in range(40)] + [None] * 3
    df = spark.createDataFrame(list(enumerate(values)), "id INT, s STRING").repartition(4)
    labels = label_table(df, "s")
    expected = {v: i for i, v in enumerate(fit_index(df.where("s is not null"), "s", "i").labels)}
    assert {r.value: r.idx for r in labels.collect()} == expected
    for hot in (1_000, 4):
        monkeypatch.setattr(features, "HOT_LABELS", hot)
        got = with_label(with_index(df, labels, "s", "i").drop("s"), labels, "i", "s").collect()
        assert sorted((r.id, r.s) for r in got) == [(i, v) for i, v in enumerate(values) if v is not None]
    assert label_table(df.limit(0), "s").count() == 0


@pytest.mark.parametrize("block, strip", [(65_536, 1_024), (40, 7)])
def test_best_items_equal_all_pairs(spark, monkeypatch, block, strip):
    """As if every user were paired with every item, but with fewer strips looked at."""
    import random

    rng = random.Random(3)
    rows = [(u, i, float(1 + (u * 7 + i * 3) % 5) * (3 if i < 5 else 0.2)) for u in range(120) for i in range(150) if rng.random() < 0.2]
    model = recommend.train_als(spark.createDataFrame(rows, "user_id INT, item_id INT, rating DOUBLE"), iterations=4)
    monkeypatch.setattr(recommend, "BLOCK", block)
    monkeypatch.setattr(recommend, "STRIP", strip)
    wanted = spark.createDataFrame([(u, 1 + u % 9) for u in range(118)] + [(118, 150), (119, 400), (9_999, 5)], "user_id INT, k INT")
    got = recommend.best_items(model, wanted).collect()
    factors = {r.id: r.features for r in model.userFactors.collect()}
    items = {r.id: r.features for r in model.itemFactors.collect()}
    lists = {}
    for r in got:
        lists.setdefault(r.user_id, []).append((r.item_id, r.predicted_rating))
    assert 9_999 not in lists
    for u, k in [(u, 1 + u % 9) for u in range(118)] + [(118, 150), (119, 400)]:
        every = sorted((sum(a * b for a, b in zip(factors[u], f)) for f in items.values()), reverse=True)
        assert len(lists[u]) == min(k, len(items)) == len({i for i, _ in lists[u]})
        assert [s for _, s in lists[u]] == pytest.approx(every[: len(lists[u])], rel=1e-4, abs=1e-5)
        assert all(s == pytest.approx(sum(a * b for a, b in zip(factors[u], items[i])), rel=1e-4, abs=1e-5) for i, s in lists[u])
    if strip == 7:
        looked = {r.user_id: r.looked for r in got}
        assert max(looked.values()) <= -(-40 // 7) * 4 and sum(looked[u] for u in range(118)) < 0.7 * 118 * len(items) / 7
    spark_lists = {r.user_id: [x.rating for x in r.recommendations] for r in model.recommendForAllUsers(4).collect()}
    mine = {}
    for r in sorted(recommend.recommend_all(model, 4).collect(), key=lambda r: -r.predicted_rating):
        mine.setdefault(r.user_id, []).append(r.predicted_rating)
    assert all(mine[u] == pytest.approx(s, rel=1e-4, abs=1e-5) for u, s in spark_lists.items())


PLAIN = replace(SPEC, trees=60)
MERGED = replace(PLAIN, draws=2_000)


def _many(spark, n=6_000):
    rng = random.Random(8)
    rows = []
    for i in range(n):
        x, colour = rng.randrange(50), rng.choice(["red", "blue", None])
        likely = 0.9 if x > 30 or colour == "red" else 0.2
        rows.append((i, colour, x, "Yes" if rng.random() < likely else "No"))
    return spark.createDataFrame(rows, "id INT, colour STRING, x INT, target STRING")


def test_merged_rows_stand_for_all_rows(spark):
    """Every row is in the weights, no lot is larger than told, and rows are far fewer than before."""
    df = _many(spark)
    bins = fit_bins(df, ["x"], 32)
    rows = classifiers.merged_rows(df, bins, MERGED)
    assert round(rows.agg(F.sum("weight")).first()[0], 6) == df.count() and rows.agg(F.max("weight")).first()[0] <= 3
    assert rows.count() < df.count() * 0.5
    got = rows.groupBy("target", "colour").agg(F.round(F.sum("weight")).cast("long").alias("n"))
    assert sorted(got.collect(), key=repr) == sorted(df.groupBy("target", "colour").agg(F.count("*").alias("n")).collect(), key=repr)
    assert len(bins.getSplitsArray()[0]) <= 33 and rows.select("x_bin").distinct().count() <= 32


def test_a_forest_of_merged_rows_scores_as_one_of_all_rows(spark, tmp_path):
    df = _many(spark)
    merged, plain = classifiers.train(df, MERGED), classifiers.train(df, PLAIN)
    assert any(type(s).__name__ == "Bucketizer" for s in merged.stages)
    assert classifiers.class_labels(merged) == classifiers.class_labels(plain)
    a = classifiers.score_class(merged, df, ["id"]).withColumnRenamed("probability", "p")
    b = classifiers.score_class(plain, df, ["id"]).withColumnRenamed("probability", "q")
    both = a.select("id", "p").join(b.select("id", "q"), "id")
    assert both.count() == df.count() and both.agg(F.avg(F.abs(F.col("p") - F.col("q")))).first()[0] < 0.05
    each = classifiers.score_rows(merged, df, MERGED, "id").select("id", "probability", "prediction", MERGED.predicted)
    plainly = merged.transform(df).select("id", "probability", "prediction", MERGED.predicted)
    assert sorted(each.collect()) == sorted(plainly.collect())
    classifiers.save_model(merged, f"{tmp_path}/m")
    again = classifiers.score_class(PipelineModel.load(f"{tmp_path}/m"), df, ["id"])
    assert sorted(again.collect(), key=repr) == sorted(classifiers.score_class(merged, df, ["id"]).collect(), key=repr)


def test_bins_of_few_and_of_no_values(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (4.0, None), (None, None), (float("nan"), None)], "a DOUBLE, b INT")
    bins = fit_bins(df, ["a", "b"], 32)
    inside = [s[1:-1] for s in bins.getSplitsArray()]
    assert inside == [[1.5, 3.0], [0.0]]
    even = spark.range(1_000).union(spark.range(500)).select(F.col("id").alias("a"))
    assert fit_bins(even, ["a"], 3).getSplitsArray()[0][1:-1] == [250.0, 500.0]
    assert bins.transform(df).count() == 5


def _wide(spark, n=60_000):
    """Rows of some ten thousand combinations, with gaps."""
    h = {c: F.pmod(F.xxhash64("id", F.lit(c)), F.lit(32)) for c in "xyz"}
    rows = spark.range(n).select("id", *[F.when(v != 31, v.cast("int")).alias(c) for c, v in h.items()])
    colour = F.when(F.col("id") % 3 > 0, F.when(F.col("id") % 3 > 1, "red").otherwise("blue"))
    target = F.when((F.coalesce("x", F.lit(0)) + F.col("id") % 7) > 20, "Yes").otherwise("No")
    return rows.withColumns({"colour": colour, "target": target})


WIDE = classifiers.ForestSpec("target", ("colour",), ("x", "y", "z"), trees=4, depth=3, draws=20_000)


def _joins(df):
    import re

    df.collect()
    return set(re.findall(r"(?:SortMerge|ShuffledHash|BroadcastHash|BroadcastNestedLoop)Join", df._jdf.queryExecution().toString()))


def test_many_outputs_of_a_forest_are_not_broadcast(spark):
    """However small their files are, the driver holds none of them; a few are broadcast."""
    df = _wide(spark)
    model = classifiers.train(df, WIDE)
    each = classifiers.score_rows(model, df, WIDE, "id").select("id", "label", "probability", "prediction", WIDE.predicted)
    assert _joins(each) == {"SortMergeJoin"}
    assert sorted(each.collect()) == sorted(model.transform(df).select(*each.columns).collect())
    assert _joins(classifiers.score_rows(model, df.where("id < 1000"), WIDE, "id")) == {"BroadcastHashJoin"}


def test_combinations_of_columns_as_numbers(spark):
    """Also where one BIGINT does not tell them all, and for NULL."""
    sizes = {"a": 3, "b": 2**62, "c": 2**60, "d": 4, "e": 2**63 - 1}
    numbers = classifiers._numbers(sizes)
    assert list(numbers.values()) == [["a"], ["b"], ["c", "d"], ["e"]]
    rows = [(0, 2**53 - 1, 2**53 - 2, 2, None), (1, None, 7, None, 5), (None, 0, None, 0, 2**53), (None, None, None, None, None)]
    df = spark.createDataFrame([tuple(x if x is None else float(x) for x in r) for r in rows], "a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE, e DOUBLE")
    packed = df.select(*[classifiers._number({c: sizes[c] for c in of}).alias(n) for n, of in numbers.items()])
    for n, of in numbers.items():
        packed = packed.withColumns(classifiers._places(n, {c: sizes[c] for c in of}))
    assert sorted(map(tuple, packed.select(*sizes).collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("query", ["train_promo", "model_roundtrip", "train_promo_rules"])
def test_keys_of_many_products_are_not_broadcast(spark, tmp_path, query):
    """Their files are under the limit and their rows are not: no join of the promo queries hands them to the driver."""
    import re

    from tillsight.catalog import QUERIES
    from tillsight.sources.retail import TABLE_SCHEMAS

    def value(name, kind):
        if name in ("c_custkey", "o_orderkey", "p_partkey", "n_nationkey"):
            return F.col("id").cast(kind)
        keys = {"o_custkey": 500, "l_orderkey": 5_000, "l_partkey": 60_000, "c_nationkey": 25}
        drawn = F.pmod(F.xxhash64("id", F.lit(name)), F.lit(keys.get(name, 1_000)))
        if kind == "DOUBLE":
            return drawn / 10_000
        return F.lit("1995-01-01").cast(kind) if kind == "TIMESTAMP_NTZ" else F.lit("x") if kind == "STRING" else drawn.cast(kind)

    rows = {"nation": 25, "customer": 500, "orders": 5_000, "part": 60_000, "lineitem": 20_000}
    for name, n in rows.items():
        columns = [c.split() for c in TABLE_SCHEMAS[name].split(", ")]
        spark.range(n).select(*[value(c, kind).alias(c) for c, kind in columns]).write.parquet(f"{tmp_path}/{name}.parquet")
    store = spark._jsparkSession.sharedState().statusStore()
    earlier = store.executionsCount()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "200k")
    try:
        assert QUERIES[query](spark, str(tmp_path)).first()[0] is not None
        assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "200k"
        assert spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None) is None
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark._jsc.sc().listenerBus().waitUntilEmpty()
    plans = [store.executionsList().apply(i).physicalPlanDescription() for i in range(store.executionsCount())][earlier:]
    assert any("p_partkey" in p for p in plans)
    assert not [p for p in plans if re.search(r"BroadcastExchange\s+Input \[\d+\]: \[p_partkey", p)]
