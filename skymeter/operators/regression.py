"""Regression on reading features: preparation, three models, evaluation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skymeter.functions import hash_bucket
from skymeter.operators.graph import dense_ids
from skymeter.session import materialize, stored_for_join

# Label, features, share of training rows, seed, model parameters.
LABEL = "pm25"
NUMERIC_FEATURES = ("year", "month", "day", "hour", "is_weekend")
CATEGORICAL_FEATURES = ("station", "season")
TRAIN_SHARE = 0.8
SEED = 42
LINEAR_ITERATIONS = 20
FOREST_TREES = 20
DEFAULT_MAX_BINS = 32

SPLIT_BUCKETS = 10_000

# Training rows of a partition.
ROWS_PER_PARTITION = 200_000

# Categories of a feature up to which trees take it as one. Trees keep statistics for each
# category and the driver all names; beyond, use means_by_category for the feature.
MOST_CATEGORIES = 1_000


def training_rows(
    df: DataFrame,
    label: str = LABEL,
    numeric: Sequence[str] = NUMERIC_FEATURES,
    categorical: Sequence[str] = CATEGORICAL_FEATURES,
    carry: Sequence[str] = ("datetime",),
) -> DataFrame:
    """Label, features and carried columns of the rows where none is NULL or NaN."""
    return df.select(label, *numeric, *categorical, *carry).dropna("any")


def _in_training(keys: Sequence[str], share: float, seed: int) -> Column:
    bucket = hash_bucket([F.col(k) for k in keys], SPLIT_BUCKETS, seed)
    return bucket < F.lit(round(share * SPLIT_BUCKETS))


def train_test_split(
    df: DataFrame, keys: Sequence[str] | None = None, share: float = TRAIN_SHARE, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """Training and test rows by the hash of a row's key (all columns by default).

    A row's side does not change with the partitioning or when a task is run again,
    so the two sides never share or lose a row.
    """
    chosen = _in_training(df.columns if keys is None else keys, share, seed)
    return df.filter(chosen), df.filter(~chosen)


def index_column(name: str) -> str:
    return f"{name}_index"


def category_index(train: DataFrame, category: str) -> tuple[DataFrame, int]:
    """``category, <category>_index`` of the training rows' categories, and how many there are.

    The most frequent one is 0, ties go by name. Counting, numbering and the table itself
    stay distributed; only the number of categories comes to the driver.
    """
    counts = train.filter(F.col(category).isNotNull()).groupBy(category).agg(F.count(F.lit(1)).alias("_n"))
    name = index_column(category)
    numbered = dense_ids(counts, [F.desc("_n"), category], name)
    index = materialize(numbered.select(category, F.col(name).cast("double").alias(name)), "category-index")
    return stored_for_join(index, "category-join"), index.count()


@dataclass
class FeatureIndex:
    """Fitted features: numeric columns, and an index table for each categorical one."""

    numeric: Sequence[str]
    tables: dict[str, DataFrame] = field(default_factory=dict)
    sizes: dict[str, int] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        """The features in the order of the vector."""
        return [*self.numeric, *map(index_column, self.tables)]

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with an index per categorical column and the vector ``features``.

        Rows with a category that the training rows do not have are skipped. Index tables
        are joined by their counted bytes. Trees learn from the columns' metadata which
        features are categories, and how many there are.
        """
        out = df
        for category, table in self.tables.items():
            name = index_column(category)
            kind = {"ml_attr": {"type": "nominal", "name": name, "num_vals": self.sizes[category]}}
            joined = out.join(table, category)
            out = joined.select(*out.columns, F.col(name).alias(name, metadata=kind))
        return VectorAssembler(inputCols=self.columns, outputCol="features").transform(out)


def means_by_category(train: DataFrame, df: DataFrame, category: str, label: str = LABEL) -> DataFrame:
    """``df`` with ``<category>_mean``: the training rows' mean label of the row's category.

    A numeric stand-in for a category with very many values, for which trees need no bin
    per value. Values not seen in training get the mean of all training rows.
    """
    name = f"{category}_mean"
    means = stored_for_join(train.groupBy(category).agg(F.avg(label).alias(name)), "category-means")
    overall = train.agg(F.avg(label)).scalar()
    return df.join(means, category, "left").withColumn(name, F.coalesce(name, overall))


def max_bins(index: FeatureIndex) -> int:
    """Bins that hold every category.

    An error above ``MOST_CATEGORIES``: nothing is cut off in silence.
    """
    most = max(index.sizes.values(), default=0)
    if most > MOST_CATEGORIES:
        raise ValueError(f"a feature has {most} categories, more than {MOST_CATEGORIES}: use means_by_category for it")
    return max(DEFAULT_MAX_BINS, most)


def linear_regression(label: str = LABEL, prediction: str = "prediction") -> LinearRegression:
    return LinearRegression(
        labelCol=label, featuresCol="features", predictionCol=prediction, maxIter=LINEAR_ITERATIONS
    )


def decision_tree(
    label: str = LABEL, prediction: str = "prediction", bins: int = DEFAULT_MAX_BINS
) -> DecisionTreeRegressor:
    return DecisionTreeRegressor(
        labelCol=label, featuresCol="features", predictionCol=prediction, maxBins=bins, seed=SEED
    )


def random_forest(
    label: str = LABEL, prediction: str = "prediction", bins: int = DEFAULT_MAX_BINS
) -> RandomForestRegressor:
    return RandomForestRegressor(
        labelCol=label,
        featuresCol="features",
        predictionCol=prediction,
        numTrees=FOREST_TREES,
        maxBins=bins,
        seed=SEED,
    )


ESTIMATORS = {
    "linear_regression": lambda label, prediction, bins: linear_regression(label, prediction),
    "decision_tree": decision_tree,
    "random_forest": random_forest,
}


def fit_features(
    train: DataFrame,
    numeric: Sequence[str] = NUMERIC_FEATURES,
    categorical: Sequence[str] = CATEGORICAL_FEATURES,
) -> FeatureIndex:
    """Indexes the categories once, for all models of the same training rows."""
    found = {c: category_index(train, c) for c in categorical}
    return FeatureIndex(tuple(numeric), {c: t for c, (t, _) in found.items()}, {c: n for c, (_, n) in found.items()})


def in_stable_layout(rows: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """The rows in partitions and an order that depend on the rows alone.

    They are dealt by a hash of their key (all columns by default) to a number of
    partitions given by their count, and sorted there. Whatever is then drawn or added up
    per partition, such as a forest's samples, comes out the same for any layout of the
    input and in a task that runs again.
    """
    by = [F.hash(*(rows.columns if keys is None else keys))]
    parts = max(1, -(-rows.count() // ROWS_PER_PARTITION))
    order = [*by, *[c for c, kind in rows.dtypes if kind != "vector"]]
    return rows.repartition(parts, *by).sortWithinPartitions(*order)


def fit_models(
    train: DataFrame,
    index: FeatureIndex,
    names: Sequence[str],
    label: str = LABEL,
    keys: Sequence[str] | None = None,
) -> dict[str, Model]:
    """Fits the named models on the same cached vectors; model ``m`` predicts into ``m``.

    ``keys`` name a row; by default its label and features do. Fitting the same rows gives
    the same models however they are partitioned.
    """
    indexed = index.transform(train)
    named = [label, *index.columns] if keys is None else [*keys, label, *index.columns]
    vectors = in_stable_layout(indexed.select(*dict.fromkeys(named), "features"), keys or named)
    vectors = vectors.select(label, "features").persist()
    try:
        bins = max_bins(index) if set(names) - {"linear_regression"} else DEFAULT_MAX_BINS
        return {n: ESTIMATORS[n](label, n, bins).fit(vectors) for n in names}
    finally:
        vectors.unpersist()


def predict(df: DataFrame, index: FeatureIndex, models: dict[str, Model]) -> DataFrame:
    """Rows with one prediction column per model."""
    out = index.transform(df)
    for model in models.values():
        out = model.transform(out)
    return out


def rmse(label: str, prediction: str) -> Column:
    """Root mean squared error as an aggregate."""
    return F.sqrt(F.avg(F.pow(F.col(label) - F.col(prediction), F.lit(2.0))))


def score_models(predicted: DataFrame, names: Sequence[str], label: str = LABEL) -> DataFrame:
    """``model, rmse`` of prediction columns, in one pass over the rows."""
    return predicted.agg(*[rmse(label, n).alias(n) for n in names]).unpivot([], list(names), "model", "rmse")


def compare_models(
    train: DataFrame,
    test: DataFrame,
    names: Sequence[str] = tuple(ESTIMATORS),
    label: str = LABEL,
    numeric: Sequence[str] = NUMERIC_FEATURES,
    categorical: Sequence[str] = CATEGORICAL_FEATURES,
) -> DataFrame:
    """Fits the named models on the training rows and scores them on the test rows."""
    index = fit_features(train, numeric, categorical)
    return score_models(predict(test, index, fit_models(train, index, names, label)), names, label)


def linear_coefficients(model: Model, features: Sequence[str], df: DataFrame) -> DataFrame:
    """``term, coefficient`` of a fitted linear model; the terms are its features and the intercept."""
    rows = [*zip(features, [float(c) for c in model.coefficients]), ("intercept", float(model.intercept))]
    return df.sparkSession.createDataFrame(rows, "term string, coefficient double")
