"""Random forests for promo use and for the item bought in a season."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import Bucketizer, IndexToString
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F
from py4j.protocol import Py4JJavaError

from ..sources.shared import materialize
from .features import assembler, encoder_stages, fit_bins, fit_index


@dataclass(frozen=True)
class ForestSpec:
    """What to predict, from which columns, with which forest."""

    target: str
    categorical: tuple[str, ...]
    numeric: tuple[str, ...]
    trees: int
    depth: int = 5
    predicted: str = "predicted_label"
    seed: int = 42
    #: The draw of the trees goes by partition, so their number is part of the model: one for each so many rows, but at
    #: least ``partitions``.  Every partition hands on the statistics of all nodes, so more of them only cost on a small table.
    rows_each: int = 1_000_000
    partitions: int = 8
    #: Above so many rows the forest is fitted on merged rows, see :func:`fit_merged`.
    draws: int = 4_000_000

    @property
    def inputs(self) -> list[str]:
        return [*self.categorical, *self.numeric]


# Inputs and forest sizes of the two models.
PROMO = ForestSpec(
    target="promo_code_used",
    categorical=("gender", "payment_method", "subscription_status", "frequency_of_purchases"),
    numeric=("age", "purchase_amount", "previous_purchases"),
    trees=50,
)
SEASONAL = ForestSpec(
    target="item_purchased",
    categorical=("season", "gender", "location", "subscription_status"),
    numeric=("age", "previous_purchases"),
    trees=100,
    depth=10,
    predicted="predicted_item",
)
SEASONAL_LIGHT = ForestSpec(
    target="item_purchased",
    categorical=SEASONAL.categorical,
    numeric=SEASONAL.numeric,
    trees=50,
    predicted="predicted_item",
)


def training_rows(df: DataFrame, spec: ForestSpec) -> DataFrame:
    """The columns of a model as a stored table, which fitting reads several times.

    The draw of the trees goes by position, so rows are dealt by their values to partitions whose number follows
    from the rows, and sorted there: the same rows give the same forest on any cluster.
    """
    return _dealt(materialize(df.select(spec.target, *spec.inputs)), spec)


def _dealt(stored: DataFrame, spec: ForestSpec) -> DataFrame:
    parts = max(spec.partitions, -(-stored.count() // spec.rows_each))
    return stored.repartition(parts, *stored.columns).sortWithinPartitions(*stored.columns)


def train(df: DataFrame, spec: ForestSpec) -> PipelineModel:
    """Store the training rows and fit on them, merged if they are very many."""
    stored = materialize(df.select(spec.target, *spec.inputs))
    if stored.count() > spec.draws:
        return fit_merged(stored, spec)
    return fit_forest(_dealt(stored, spec), spec)


def _forest(spec: ForestSpec) -> RandomForestClassifier:
    return RandomForestClassifier(
        labelCol="label", featuresCol="features", numTrees=spec.trees, maxDepth=spec.depth, seed=spec.seed
    )


def fit_forest(rows: DataFrame, spec: ForestSpec) -> PipelineModel:
    """Fit encoders and forest.

    The label index is fitted here too, so that test rows have no say in it; a row whose
    target was not met in training is skipped and no extra class is made for it.
    """
    label = fit_index(rows, spec.target, "label", unseen="skip")
    stages = [
        label,
        *encoder_stages(spec.categorical),
        assembler(spec.categorical, spec.numeric),
        _forest(spec),
        IndexToString(inputCol="prediction", outputCol=spec.predicted, labels=label.labels),
    ]
    return Pipeline(stages=stages).fit(rows)


def fit_merged(stored: DataFrame, spec: ForestSpec) -> PipelineModel:
    """Fit on rows that stand for several equal ones.

    A forest sees a number only as one of ``maxBins`` bins.  Here the bins are a stage before it, with edges from all
    rows, and rows that are then equal become one with their number as weight: there are no more of them than ways to
    combine the bins and values, whatever the size of the table.  The trees draw whole rows; so that none draws
    large lots, a row stands for ``rows / draws`` equal ones at most and there are several of it otherwise.
    """
    label = fit_index(stored, spec.target, "label", unseen="skip")
    encoders = Pipeline(stages=encoder_stages(spec.categorical)).fit(stored)
    forest = _forest(spec).setWeightCol("weight")
    bins = fit_bins(stored, spec.numeric, forest.getMaxBins())
    prepared = PipelineModel([label, *encoders.stages])
    assembled = assembler(spec.categorical, bins.getOutputCols())
    rows = merged_rows(stored, bins, spec)
    vectors = assembled.transform(prepared.transform(rows))
    if all_common(rows, spec.categorical):
        # Told nothing of its features, the forest splits 0 and 1 at a half, as it does nominal ones, but faster.
        vectors = vectors.withMetadata("features", {})
    fitted = forest.fit(vectors)
    named = IndexToString(inputCol="prediction", outputCol=spec.predicted, labels=label.labels)
    return PipelineModel([*prepared.stages, bins, assembled, fitted, named])


def all_common(rows: DataFrame, columns: Sequence[str], share: int = 1_000) -> bool:
    """Whether every value is on a ``share``-th of the rows, so that the 10,000 rows a forest looks for splits in hold it."""
    total = rows.count()
    least = (rows.groupBy(c).agg(F.count(F.lit(1)).alias("n")).agg(F.min("n")).first()[0] for c in columns)
    return all(n * share >= total for n in least)


def merged_rows(stored: DataFrame, bins: Bucketizer, spec: ForestSpec) -> DataFrame:
    """Target, categories and bins of all rows, equal ones merged, with ``weight``; dealt as :func:`training_rows` are."""
    limit = -(-stored.count() // spec.draws)
    binned = bins.transform(stored).withColumns(
        {
            out: F.least(F.coalesce(out, F.lit(float("inf"))), F.lit(float(len(splits) - 2)))  # NULL counts as highest
            for out, splits in zip(bins.getOutputCols(), bins.getSplitsArray())
        }
    )
    counted = binned.groupBy(spec.target, *spec.categorical, *bins.getOutputCols()).agg(F.count(F.lit(1)).alias("_n"))
    times = F.ceil(F.col("_n") / F.lit(limit))
    lots = counted.withColumn("weight", F.col("_n") / times).withColumn("_lot", F.explode(F.sequence(F.lit(1).cast("long"), times)))
    return _dealt(materialize(lots.drop("_n")), spec)


#: Outputs of a forest are broadcast up to so many numbers.  Their files say little of that: stored, millions take 10 MB.
FEW_OUTPUTS = 100_000


def _numbers(sizes: dict[str, int]) -> dict[str, list[str]]:
    """Names of numbers, each for as many of the columns as a BIGINT can tell the combinations of."""
    numbers, room = {}, 0
    for c, size in sizes.items():
        if size > room:
            numbers[f"_combination_{len(numbers)}"], room = [], 2**63 - 1
        numbers[f"_combination_{len(numbers) - 1}"].append(c)
        room //= size
    return numbers


def _number(sizes: dict[str, int]) -> Column:
    """The combination of columns as one number; each is NULL or a whole number below its size less one."""
    number = F.lit(0).cast("long")
    for c, size in sizes.items():
        number = number * F.lit(size).cast("long") + F.coalesce(F.col(c).cast("long"), F.lit(size - 1).cast("long"))
    return number


def _places(number: str, sizes: dict[str, int]) -> dict[str, Column]:
    """The columns of a combination, from its number."""
    out, rest = {}, 1
    for c, size in reversed(sizes.items()):
        place = F.expr(f"`{number}` div {rest} % {size}")
        out[c] = F.when(place < size - 1, place.cast("double"))
        rest *= size
    return out


def score_rows(model: PipelineModel, df: DataFrame, spec: ForestSpec, *keep: str) -> DataFrame:
    """Target, inputs, ``keep`` and the outputs of the model for every row.

    A forest with bins before it gives equal bins the same outputs, so it is run once for each of them, which are
    then joined to their rows by a number of the combination.  They may be millions: unless they are few by their
    count they are joined by a shuffle, and the driver holds none of them, whatever Spark expects from their files.
    """
    rows = df.select(spec.target, *spec.inputs, *keep)
    if not any(isinstance(s, Bucketizer) for s in model.stages):
        return model.transform(rows)
    label, indexer, hot, bins, *rest = model.stages
    sizes = {c: len(values) + 2 for c, values in zip(indexer.getOutputCols(), indexer.labelsArray)}  # with other values
    sizes |= {c: len(splits) + 1 for c, splits in zip(bins.getOutputCols(), bins.getSplitsArray())}  # with NaN
    numbers = _numbers(sizes)
    numbered = PipelineModel([label, indexer, bins]).transform(rows).withColumns(
        {n: _number({c: sizes[c] for c in columns}) for n, columns in numbers.items()}
    )
    binned = materialize(numbered.drop(*sizes))
    met = binned.select(*numbers).distinct()
    for n, columns in numbers.items():
        met = met.withColumns(_places(n, {c: sizes[c] for c in columns}))
    outputs = materialize(PipelineModel([hot, *rest]).transform(met).select(*numbers, "probability", "prediction", spec.predicted))
    few = outputs.count() * (len(numbers) + len(class_labels(model))) <= FEW_OUTPUTS
    return binned.join(F.broadcast(outputs) if few else outputs.hint("merge"), [*numbers]).drop(*numbers)


def class_labels(model: PipelineModel) -> list[str]:
    """Class names in the order of the probability vector."""
    return list(model.stages[-1].getLabels())


def scoring_stages(model: PipelineModel) -> PipelineModel:
    """The fitted stages without the label index: profiles to score have no target."""
    return PipelineModel(model.stages[1:])


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_or_train(path: str, fit: Callable[[], PipelineModel]) -> PipelineModel:
    """Load a saved pipeline that ends in label names; otherwise train one and save it.

    Only a missing path leads to training: any other problem with reading is raised, and what
    lies there is left alone.
    """
    try:
        model = PipelineModel.load(path)
        if isinstance(model.stages[-1], IndexToString):
            return model
    except (AnalysisException, Py4JJavaError) as problem:
        if "does not exist" not in str(problem).lower() and "PATH_NOT_FOUND" not in str(problem):
            raise
    model = fit()
    save_model(model, path)
    return model


def score_class(model: PipelineModel, profiles: DataFrame, keys: Sequence[str], positive: str = "Yes") -> DataFrame:
    """Probability of one class and the predicted label for a table of profiles."""
    at = class_labels(model).index(positive)
    predicted = model.stages[-1].getOutputCol()
    return scoring_stages(model).transform(profiles).select(
        *keys,
        F.get(vector_to_array("probability"), F.lit(at)).alias("probability"),
        F.col(predicted).alias("decision"),
    )


def score_scenarios(
    model: PipelineModel, profiles: DataFrame, keys: Sequence[str], column: str, values: Sequence[str], k: int = 3
) -> DataFrame:
    """The ``k`` likeliest classes of every profile under each override of one column.

    The overrides are a short list that each row is repeated for.  Ranking happens inside
    the row's own probability array, so nothing is shuffled.
    """
    names = F.array(*[F.lit(x) for x in class_labels(model)])
    what_if = profiles.withColumn(column, F.explode(F.array(*[F.lit(v) for v in values])))
    scored = scoring_stages(model).transform(what_if)
    best = F.slice(
        F.array_sort(
            F.transform(
                vector_to_array("probability"),
                lambda p, i: F.struct((-p).alias("against"), F.get(names, i).alias("item"), p.alias("probability")),
            )
        ),
        1,
        k,
    )
    return scored.select(*keys, column, F.posexplode(best).alias("at", "c")).select(
        *keys,
        column,
        (F.col("at") + 1).alias("rank"),
        F.col("c.item").alias("item"),
        F.col("c.probability").alias("probability"),
    )
