"""Indexing, model training and scoring, metrics, recommendations."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window, functions as F

from ..functions.numeric import ratio, round_half_up
from ..ml import classifiers, features, metrics, recommend
from ..operators.ranking import top_k_per_group
from ..operators.sampling import deterministic_split
from ..sources.retail import retail, stored_retail
from ..sources.shared import materialize
from .registry import avg, on_retail, query, rnd


@query(
    "string_index",
    on_retail(
        "SELECT item_purchased, CAST(ROW_NUMBER() OVER (ORDER BY n DESC, item_purchased) - 1 AS INT) AS idx, n FROM "
        "(SELECT item_purchased, COUNT(*) AS n FROM retail GROUP BY 1)"
    ),
)
def string_index(spark, sf_dir):
    return features.label_table(retail(spark, sf_dir), "item_purchased").withColumnRenamed("value", "item_purchased")


@query(
    "index_to_label",
    on_retail(
        "SELECT customer_id, order_id, CAST(idx AS INT) AS idx, item_purchased AS label FROM retail JOIN "
        "(SELECT item_purchased, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, item_purchased) - 1 AS idx FROM retail GROUP BY 1) "
        "USING (item_purchased)"
    ),
)
def index_to_label(spark, sf_dir):
    """The item of every purchase as an index, and back again by the index alone."""
    rows = materialize(retail(spark, sf_dir).select("customer_id", "order_id", "item_purchased"))
    labels = features.label_table(rows, "item_purchased")
    indexed = features.with_index(rows, labels, "item_purchased", "idx").drop("item_purchased")
    return features.with_label(indexed, labels, "idx", "label")


@query(
    "one_hot",
    on_retail(
        "SELECT location, n, CAST(p.position AS INT) AS position, CASE WHEN idx = p.position THEN 1e0 ELSE 0e0 END AS value FROM indexed, "
        "(SELECT idx AS position FROM indexed WHERE idx < (SELECT MAX(idx) FROM indexed)) p",
        indexed="SELECT location, COUNT(*) AS n, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, location) - 1 AS idx FROM retail GROUP BY 1",
    ),
)
def one_hot(spark, sf_dir):
    return features.one_hot_frame(retail(spark, sf_dir).select("location"), "location")


@query("assemble_features")
def assemble_features(spark, sf_dir):
    """Encoded promo inputs of every purchase as an array."""
    from pyspark.ml import Pipeline

    spec = classifiers.PROMO
    purchases = materialize(retail(spark, sf_dir).select("customer_id", "order_id", *spec.inputs))
    stages = [*features.encoder_stages(spec.categorical), features.assembler(spec.categorical, spec.numeric)]
    vectors = Pipeline(stages=stages).fit(purchases).transform(purchases)
    return vectors.select("customer_id", "order_id", vector_to_array("features").alias("features"))


_HOT = " UNION ALL ".join(f"SELECT {i} AS c, {name} AS v FROM retail" for i, name in enumerate(classifiers.PROMO.categorical))
_NUMBERS = " UNION ALL ".join(
    f"SELECT (SELECT COUNT(*) FROM placed) + {i}, COUNT(CASE WHEN {name} <> 0 THEN 1 END), {rnd(f'CAST(SUM({name}) AS DOUBLE)')} FROM retail"
    for i, name in enumerate(classifiers.PROMO.numeric)
)


@query(
    "assemble_features_rules",
    on_retail(
        f"SELECT CAST(position AS INT) AS position, filled, total FROM (SELECT * FROM placed UNION ALL {_NUMBERS})",
        placed="SELECT ROW_NUMBER() OVER (ORDER BY c, n DESC, v) - 1 AS position, n AS filled, CAST(n AS DOUBLE) AS total "
        f"FROM (SELECT c, v, COUNT(*) AS n FROM ({_HOT}) GROUP BY 1, 2)",
    ),
)
def assemble_features_rules(spark, sf_dir):
    """Of every position of the encoded purchases: rows that are not zero, and the sum."""
    entries = assemble_features(spark, sf_dir).select(F.posexplode("features").alias("position", "value"))
    return entries.groupBy("position").agg(
        F.count_if(F.col("value") != 0).alias("filled"), round_half_up(F.sum("value"), 2).alias("total")
    )


def _profiles(r):
    """One profile per customer: the first purchase in a fixed order."""
    order = ["order_id", "item_purchased", "purchase_amount", "payment_method", "season"]
    return materialize(top_k_per_group(r, ["customer_id"], order, 1)).drop("rn")


_PREDICTIONS = (
    "SELECT CASE WHEN promo_code_used = 'Yes' THEN 1 ELSE 0 END AS label, "
    "CASE WHEN discount_applied = 'Yes' OR previous_purchases > 30 THEN 1 ELSE 0 END AS prediction FROM retail"
)


@query(
    "classification_metrics",
    on_retail(
        f"SELECT {rnd('(SUM(hits) * 1e0 / SUM(actual))', 6)} AS accuracy, {rnd('(SUM(p * actual) / SUM(actual))', 6)} AS weighted_precision, "
        f"{rnd('(SUM(r * actual) / SUM(actual))', 6)} AS weighted_recall, {rnd('(SUM(f * actual) / SUM(actual))', 6)} AS f1 FROM "
        "(SELECT *, CASE WHEN p + r > 0 THEN 2e0 * p * r / (p + r) ELSE 0e0 END AS f FROM (SELECT c, "
        "(SELECT COUNT(*) FROM predictions WHERE label = c) AS actual, "
        "(SELECT COUNT(*) FROM predictions WHERE label = c AND prediction = c) AS hits, "
        "(SELECT COUNT(*) FROM predictions WHERE label = c AND prediction = c) * 1e0 / (SELECT COUNT(*) FROM predictions WHERE prediction = c) AS p, "
        "(SELECT COUNT(*) FROM predictions WHERE label = c AND prediction = c) * 1e0 / (SELECT COUNT(*) FROM predictions WHERE label = c) AS r "
        "FROM (VALUES (0), (1)) v(c)))",
        predictions=_PREDICTIONS,
    ),
)
def classification_metrics(spark, sf_dir):
    """The metrics on a fixed rule in place of a model, so that the figures are known."""
    predicted = (F.col("discount_applied") == "Yes") | (F.col("previous_purchases") > 30)
    frame = retail(spark, sf_dir).select(
        (F.col("promo_code_used") == "Yes").cast("int").alias("label"), predicted.cast("int").alias("prediction")
    )
    return metrics.classification_metrics(frame)


@query(
    "auc_roc",
    on_retail(
        f"SELECT {rnd('((SUM(CASE WHEN pos THEN r END) - p * (p + 1e0) / 2e0) / (p * n))', 6)} AS auc FROM "
        "(SELECT pos, rnk + (ties - 1) / 2e0 AS r, SUM(CASE WHEN pos THEN 1e0 ELSE 0e0 END) OVER () AS p, "
        "SUM(CASE WHEN pos THEN 0e0 ELSE 1e0 END) OVER () AS n FROM (SELECT promo_code_used = 'Yes' AS pos, "
        "RANK() OVER (ORDER BY purchase_amount) AS rnk, COUNT(*) OVER (PARTITION BY purchase_amount) AS ties FROM retail)) GROUP BY p, n"
    ),
)
def auc_roc(spark, sf_dir):
    """How well the amount alone separates purchases with and without a promo code."""
    frame = retail(spark, sf_dir).select("purchase_amount", (F.col("promo_code_used") == "Yes").alias("promo"))
    return metrics.auc_roc(frame, "purchase_amount", "promo")


@query(
    "rmse",
    on_retail(
        f"SELECT {rnd('SQRT(AVG((CAST(review_rating AS DOUBLE) - m) * (CAST(review_rating AS DOUBLE) - m)))', 6)} AS rmse FROM retail r "
        f"JOIN (SELECT item_purchased, {avg('review_rating', None)} AS m FROM retail GROUP BY 1) i ON r.item_purchased = i.item_purchased"
    ),
)
def rmse(spark, sf_dir):
    """Error of predicting each rating by the mean of its item."""
    counted = (
        retail(spark, sf_dir)
        .where("review_rating is not null")
        .groupBy("item_purchased", "review_rating")
        .agg(F.count("*").alias("n"))
    )
    of_item = "OVER (PARTITION BY item_purchased)"  # one row per rating that the item has
    mean = ratio(f"sum(review_rating * n) {of_item}", f"sum(n) {of_item}")
    return metrics.rmse(counted.withColumn("prediction", mean), "review_rating", "prediction", rows="n")


def _held_out(r):
    return deterministic_split(r, ["order_id"])


def promo_purchases(spark, sf_dir):
    """What the promo model reads of the purchases, stored once for training and scoring.

    No column of the products is read, so Spark would expect their keys to be a small table however many they are.
    """
    return stored_retail(spark, sf_dir, "order_id", classifiers.PROMO.target, *classifiers.PROMO.inputs, measured=True)


@query("train_promo")
def train_promo(spark, sf_dir):
    """Promo classifier: figures on the held-out part."""
    training, held_out = _held_out(promo_purchases(spark, sf_dir))
    scored = materialize(_scored(classifiers.train(training, classifiers.PROMO), held_out, classifiers.PROMO))
    figures = metrics.classification_metrics(scored)
    return figures.withColumn("auc", metrics.auc_roc(scored, "score", "is_second").scalar())


def _scored(model, df, spec):
    """Label, prediction and the probability of the second class."""
    return classifiers.score_rows(model, df, spec).select(
        "label",
        "prediction",
        F.get(vector_to_array("probability"), F.lit(1)).alias("score"),
        (F.col("label") == 1).alias("is_second"),
    )


@query(
    "train_promo_rules",
    on_retail(
        "SELECT COUNT(*) AS held_out, TRUE AS not_below_majority, TRUE AS better_than_chance FROM retail WHERE "
        "CAST('0x' || SUBSTR(MD5(CAST(order_id AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296e0 >= 8e-1"
    ),
)
def train_promo_rules(spark, sf_dir):
    """Rows that were held out, and whether the forest is there as good as always the most frequent class."""
    training, held_out = _held_out(promo_purchases(spark, sf_dir))
    return _rules(classifiers.train(training, classifiers.PROMO), training, held_out, classifiers.PROMO)


@query(
    "train_seasonal_rules",
    on_retail(
        "SELECT COUNT(*) AS held_out, TRUE AS better_than_chance FROM retail WHERE "
        "CAST('0x' || SUBSTR(MD5(CAST(order_id AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296e0 >= 8e-1"
    ),
)
def train_seasonal_rules(spark, sf_dir):
    """Rows that were held out, and whether the forest with its 100 trees is better than guessing.

    The items of the test tables do not depend on the customer, so it is no better than the most frequent item.
    """
    training, held_out = _held_out(retail(spark, sf_dir))
    return _rules(classifiers.train(training, classifiers.SEASONAL), training, held_out, classifiers.SEASONAL).drop("not_below_majority")


def _rules(model, training, held_out, spec):
    """Accuracy against that of the most frequent class and of guessing, each less four standard errors."""
    common = training.groupBy(spec.target).agg(F.count("*").alias("n")).agg(
        F.max_by(spec.target, F.struct("n", spec.target)).alias("most"), F.count(F.lit(1)).alias("classes")
    ).first()
    scored = materialize(classifiers.score_rows(model, held_out, spec).select(spec.target, spec.predicted))
    if common.most is None:
        return scored.agg(F.count("*").alias("held_out")).withColumns({"not_below_majority": F.lit(True), "better_than_chance": F.lit(True)})
    hit = F.avg((F.col(spec.target) == F.col(spec.predicted)).cast("int"))
    by_most = F.avg((F.col(spec.target) == F.lit(common.most)).cast("int"))
    spread = 4 * F.sqrt(by_most * (1 - by_most) / F.count("*"))
    return scored.agg(
        F.count("*").alias("held_out"),
        (hit >= by_most - spread).alias("not_below_majority"),
        (hit >= F.lit(1.0 / common.classes) - spread).alias("better_than_chance"),
    )


@query("train_seasonal")
def train_seasonal(spark, sf_dir):
    """Seasonal item classifier: figures on the held-out part."""
    return _seasonal_figures(retail(spark, sf_dir), classifiers.SEASONAL)


@query("train_seasonal_light")
def train_seasonal_light(spark, sf_dir):
    """The same with the small forest."""
    return _seasonal_figures(retail(spark, sf_dir), classifiers.SEASONAL_LIGHT)


def _seasonal_figures(r, spec):
    training, held_out = _held_out(r)
    return metrics.classification_metrics(_scored(classifiers.train(training, spec), held_out, spec))


@query("score_promo_batch")
def score_promo_batch(spark, sf_dir):
    r = retail(spark, sf_dir)
    training, _ = _held_out(r)
    model = classifiers.train(training, classifiers.PROMO)
    return classifiers.score_class(model, _profiles(r), ["customer_id"])


@query(
    "score_promo_rules",
    on_retail(
        "SELECT COUNT(DISTINCT customer_id) AS n, COUNT(DISTINCT customer_id) AS customers, CAST(0 AS BIGINT) AS outside, "
        "CAST(0 AS BIGINT) AS against FROM retail"
    ),
)
def score_promo_rules(spark, sf_dir):
    """Scored rows and customers, probabilities that are none, and decisions against the probability."""
    p, yes = F.col("probability"), F.col("decision") == "Yes"
    return score_promo_batch(spark, sf_dir).agg(
        F.count("*").alias("n"),
        F.count_distinct("customer_id").alias("customers"),
        F.count_if(~F.coalesce(p.between(0, 1), F.lit(False))).alias("outside"),
        F.count_if((yes & (p < 0.5)) | (~yes & (p > 0.5))).alias("against"),
    )


@query("score_season_topk")
def score_season_topk(spark, sf_dir):
    """The three likeliest items of every customer in each of the four seasons."""
    r = retail(spark, sf_dir)
    training, _ = _held_out(r)
    model = classifiers.train(training, classifiers.SEASONAL)
    return classifiers.score_scenarios(
        model, _profiles(r), ["customer_id"], "season", ["Winter", "Spring", "Summer", "Fall"], k=3
    )


@query(
    "score_season_rules",
    on_retail(
        "SELECT season, COUNT(DISTINCT customer_id) AS customers, COUNT(DISTINCT customer_id) * least_items AS n, TRUE AS ranks_in_order, "
        "CAST(0 AS BIGINT) AS outside FROM (SELECT customer_id, s.season, (SELECT LEAST(3, COUNT(DISTINCT item_purchased)) FROM retail) "
        "AS least_items FROM retail, (VALUES ('Winter'), ('Spring'), ('Summer'), ('Fall')) s(season)) GROUP BY season, least_items"
    ),
)
def score_season_rules(spark, sf_dir):
    """Of each season: customers, their items, whether ranks go by probability, and probabilities that are none."""
    order = Window.partitionBy("customer_id", "season").orderBy("rank")
    p = F.col("probability")
    stepped = score_season_topk(spark, sf_dir).withColumn("before", F.lag("probability").over(order))
    return stepped.groupBy("season").agg(
        F.count_distinct("customer_id").alias("customers"),
        F.count("*").alias("n"),
        F.bool_and(F.coalesce(p <= F.col("before"), F.lit(True)) & F.col("rank").between(1, 3)).alias("ranks_in_order"),
        F.count_if(~F.coalesce(p.between(0, 1), F.lit(False))).alias("outside"),
    )


def _interactions(spark, sf_dir):
    """Ratings by user and item number, and the items' labels; the purchases are joined once for both."""
    r = materialize(retail(spark, sf_dir).select("customer_id", "item_purchased", "review_rating"))
    labels = features.label_table(r, "item_purchased")
    return recommend.interactions(r, labels, "customer_id", "item_purchased", "review_rating"), labels


@query(
    "interactions",
    on_retail(
        f"SELECT user_id, CAST(idx AS INT) AS item_id, {rnd('rating', 4)} AS rating FROM (SELECT customer_id AS user_id, item_purchased, "
        f"{avg('review_rating', None)} AS rating FROM retail GROUP BY 1, 2) r JOIN (SELECT item_purchased, "
        "ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, item_purchased) - 1 AS idx FROM retail GROUP BY 1) i ON r.item_purchased = i.item_purchased"
    ),
)
def interactions(spark, sf_dir):
    rows, _ = _interactions(spark, sf_dir)
    return rows.withColumn("rating", round_half_up("rating", 4))


@query("user_history", on_retail("SELECT DISTINCT customer_id AS user_id, item_purchased FROM retail"))
def user_history(spark, sf_dir):
    return recommend.user_history(retail(spark, sf_dir), "customer_id", "item_purchased")


def _als(spark, sf_dir):
    """A factorization of all ratings, so that every user and item can be recommended for."""
    rows, labels = _interactions(spark, sf_dir)
    ratings = materialize(rows)
    return recommend.train_als(ratings), ratings, labels


@query("train_als")
def train_als(spark, sf_dir):
    """Factorization: error on held-out ratings."""
    rows, _ = _interactions(spark, sf_dir)
    training, held_out = deterministic_split(materialize(rows), ["user_id", "item_id"])
    model = recommend.train_als(training)
    return metrics.rmse(model.transform(held_out), "rating", "prediction")


@query(
    "train_als_rules",
    on_retail("SELECT COUNT(*) > 0 AS rated, TRUE AS factors_not_negative, TRUE AS error_in_range, TRUE AS better_than_the_worst FROM retail"),
)
def train_als_rules(spark, sf_dir):
    """Held-out ratings were predicted, factors are not negative, and the error is below the spread of the scale."""
    rows, _ = _interactions(spark, sf_dir)
    training, held_out = deterministic_split(materialize(rows), ["user_id", "item_id"])
    model = recommend.train_als(training)
    negative = model.itemFactors.union(model.userFactors).select(F.min(F.array_min("features")).alias("least")).scalar()
    error = metrics.rmse(model.transform(held_out), "rating", "prediction").select("rmse").scalar()
    spread = held_out.agg(F.max("rating").cast("double") - F.min("rating").cast("double")).scalar()
    return held_out.agg((F.count("*") > 0).alias("rated")).select(
        "rated",
        (negative >= 0).alias("factors_not_negative"),
        (error >= 0).alias("error_in_range"),
        (error < spread).alias("better_than_the_worst"),
    )


@query("recommend_all")
def recommend_all(spark, sf_dir):
    model, _, _ = _als(spark, sf_dir)
    return recommend.recommend_all(model, 25)


@query(
    "recommend_all_rules",
    on_retail(
        "SELECT customer_id AS user_id, LEAST(25, (SELECT COUNT(DISTINCT item_purchased) FROM retail)) AS n, TRUE AS distinct_items "
        "FROM retail GROUP BY 1"
    ),
)
def recommend_all_rules(spark, sf_dir):
    """How many items each user is given, and whether they differ."""
    return (
        recommend_all(spark, sf_dir)
        .groupBy(F.col("user_id").cast("bigint").alias("user_id"))
        .agg(F.count("*").alias("n"), (F.count("*") == F.count_distinct("item_id")).alias("distinct_items"))
    )


@query("novel_recs_als")
def novel_recs_als(spark, sf_dir):
    return _novel(spark, sf_dir)[0]


def _novel(spark, sf_dir):
    """New items of every user, and all ratings."""
    model, ratings, labels = _als(spark, sf_dir)
    history = ratings.select("user_id", "item_id")
    found = recommend.novel_recommendations(model, history, labels, "item_purchased")
    return found, features.with_label(history, labels, "item_id", "item_purchased")


@query(
    "novel_recs_als_rules",
    on_retail(
        "SELECT user_id, n, 0 AS bought_before, n AS last_rank FROM (SELECT customer_id AS user_id, "
        "LEAST(3, (SELECT COUNT(DISTINCT item_purchased) FROM retail) - COUNT(DISTINCT item_purchased)) AS n FROM retail GROUP BY 1) WHERE n > 0"
    ),
)
def novel_recs_als_rules(spark, sf_dir):
    """How many new items each user gets, how many of them were bought before, and the last rank."""
    found, history = _novel(spark, sf_dir)
    bought = history.select("user_id", "item_purchased", F.lit(1).alias("bought"))
    return (
        found.join(bought, ["user_id", "item_purchased"], "left")
        .groupBy(F.col("user_id").cast("bigint").alias("user_id"))
        .agg(
            F.count_distinct("item_purchased").alias("n"),
            F.count("bought").cast("int").alias("bought_before"),
            F.max("rank").cast("bigint").alias("last_rank"),
        )
    )


@query(
    "novel_recs_popularity",
    on_retail(
        "SELECT user_id, item_purchased, buyers, CAST(rank AS INT) AS rank FROM (SELECT u.user_id, c.item_purchased, c.buyers, "
        "ROW_NUMBER() OVER (PARTITION BY u.user_id ORDER BY c.buyers DESC, c.item_purchased) AS rank FROM "
        "(SELECT DISTINCT user_id FROM history) u CROSS JOIN (SELECT item_purchased, COUNT(*) AS buyers FROM history GROUP BY 1) c "
        "ANTI JOIN history h ON h.user_id = u.user_id AND h.item_purchased = c.item_purchased) WHERE rank <= 3",
        history="SELECT DISTINCT customer_id AS user_id, item_purchased FROM retail",
    ),
)
def novel_recs_popularity(spark, sf_dir):
    history = materialize(recommend.user_history(retail(spark, sf_dir), "customer_id", "item_purchased"))
    return recommend.popular_unseen(history, "item_purchased")
