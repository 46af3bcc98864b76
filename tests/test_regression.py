from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from skymeter.operators import regression
from skymeter.operators.regression import (
    ESTIMATORS,
    compare_models,
    fit_features,
    fit_models,
    max_bins,
    means_by_category,
    predict,
    train_test_split,
    training_rows,
)

COLUMNS = (
    "pm25 double, year int, month int, day int, hour int, is_weekend int, station string, season string, "
    "datetime timestamp_ntz"
)
GOOD = (5.0, 2013, 3, 1, 4, 0, "a", "spring", dt.datetime(2013, 3, 1, 4))


def test_rows_with_any_missing_value_are_dropped(spark):
    rows = [GOOD] + [tuple(None if i == j else v for j, v in enumerate(GOOD)) for i in range(len(GOOD))]
    rows.append((float("nan"), *GOOD[1:]))
    assert training_rows(spark.createDataFrame(rows, COLUMNS)).count() == 1


@pytest.fixture
def data(spark):
    """Label with an additive part, a station effect and a step in the hour."""
    step = F.when(F.col("hour").between(8, 15), 30.0).otherwise(0.0)
    label = F.col("month") * 2.0 + step + (F.xxhash64("id") % 100) / 50.0
    rows = spark.range(3000).select(
        "id",
        F.lit(2013).alias("year"),
        (F.col("id") % 12 + 1).cast("int").alias("month"),
        (F.col("id") % 28 + 1).cast("int").alias("day"),
        (F.col("id") % 24).cast("int").alias("hour"),
        (F.col("id") % 2).cast("int").alias("is_weekend"),
        F.concat(F.lit("s"), (F.col("id") * F.col("id") % 40).cast("string")).alias("station"),
        F.when(F.col("id") % 12 < 6, "winter").otherwise("summer").alias("season"),
    )
    return rows.withColumn("pm25", label)


def test_split_is_a_partition_that_survives_repartitioning(data):
    train, test = train_test_split(data, ["id"])
    ids = {r.id for r in train.select("id").collect()}
    rest = {r.id for r in test.select("id").collect()}
    assert ids | rest == set(range(3000)) and not ids & rest
    assert 0.75 < len(ids) / 3000 < 0.85
    again, _ = train_test_split(data.repartition(9), ["id"])
    assert {r.id for r in again.select("id").collect()} == ids
    whole, other = train_test_split(data.select("id", "pm25"))
    assert whole.count() + other.count() == 3000


def test_category_ties_are_indexed_by_name(spark):
    rows = [("b", "x"), ("a", "x"), ("c", "y"), ("c", "y")]
    df = spark.createDataFrame(rows, "station string, season string")
    index = fit_features(df, (), ("station", "season"))
    order = {c: [r[c] for r in t.orderBy(f"{c}_index").collect()] for c, t in index.tables.items()}
    assert order == {"station": ["c", "a", "b"], "season": ["x", "y"]} and index.sizes == {"station": 3, "season": 2}


def test_a_million_categories_stay_distributed(spark):
    names = spark.range(1_000_000).select(F.format_string("s%07d", F.pmod(F.col("id") * 7, F.lit(999_983))).alias("station"))
    index = fit_features(names, (), ("station",))
    table, size = index.tables["station"], index.sizes["station"]
    assert size == 999_983
    ends = table.agg(F.min("station_index"), F.max("station_index"), F.count_distinct("station_index")).first()
    assert tuple(ends) == (0.0, size - 1.0, size)
    # Those that occur twice come first, each part in the order of names.
    twice = names.groupBy("station").count().filter("count = 2").count()
    first = table.filter(F.col("station_index") < twice).join(names, "station").count()
    assert first == 2 * twice
    head = [r.station for r in table.filter(F.col("station_index") >= twice).orderBy("station_index").limit(50).collect()]
    assert head == sorted(head)
    indexed = index.transform(names)
    assert "BroadcastHashJoin" not in indexed._jdf.queryExecution().sparkPlan().toString()
    assert indexed.count() == 1_000_000


def test_unseen_category_is_skipped(spark, data):
    prefix = fit_features(data)
    unseen = data.limit(2).withColumn("station", F.lit("new"))
    assert prefix.transform(unseen).count() == 0


def test_bins_hold_every_category(data):
    wide = data.withColumn("station", F.concat(F.lit("s"), (F.col("id") % 60).cast("string")))
    prefix = fit_features(wide)
    assert max_bins(prefix) == 60
    fit_models(wide, prefix, ["decision_tree"])


def test_least_squares_residuals_are_orthogonal_to_the_features(data):
    prefix = fit_features(data)
    fitted = predict(data, prefix, fit_models(data, prefix, ["linear_regression"]))
    residual = F.col("pm25") - F.col("linear_regression")
    features = ["month", "day", "hour", "is_weekend", "station_index", "season_index"]
    sums = fitted.agg(F.avg(residual).alias("one"), *[F.avg(residual * F.col(f)).alias(f) for f in features])
    assert [abs(v) for v in sums.first()] == pytest.approx([0.0] * 7, abs=1e-4)


def test_models_beat_the_mean_and_trees_beat_the_line(data):
    train, test = train_test_split(data, ["id"])
    got = {r.model: r.rmse for r in compare_models(train, test).collect()}
    spread = test.agg(F.stddev_pop("pm25")).first()[0]
    assert set(got) == set(ESTIMATORS)
    assert got["linear_regression"] < spread
    assert got["decision_tree"] < got["linear_regression"]
    assert got["random_forest"] < spread


def test_seeded_models_are_reproducible(data):
    train, test = train_test_split(data, ["id"])
    first = compare_models(train, test, ["random_forest"]).collect()
    assert compare_models(train, test, ["random_forest"]).collect() == first


def test_models_do_not_depend_on_the_layout(spark, data, monkeypatch):
    monkeypatch.setattr(regression, "ROWS_PER_PARTITION", 700)
    train, test = train_test_split(data, ["id"])
    layouts = [train, train.repartition(7), train.orderBy(F.desc("id")).coalesce(1), train.repartition(3, "station")]
    found = []
    for layout in layouts:
        index = fit_features(layout)
        models = fit_models(layout, index, ["decision_tree", "random_forest"], keys=["id"])
        rows = predict(test, index, models).orderBy("id").select("decision_tree", "random_forest").collect()
        found.append([tuple(r) for r in rows])
    assert found[0] == found[1] == found[2] == found[3]


def test_trees_refuse_more_categories_than_they_can_hold(spark, data, monkeypatch):
    monkeypatch.setattr(regression, "MOST_CATEGORIES", 5)
    train, test = train_test_split(data, ["id"])
    with pytest.raises(ValueError, match="means_by_category"):
        compare_models(train, test, ["decision_tree"])
    assert compare_models(train, test, ["linear_regression"]).count() == 1
    numeric = [*regression.NUMERIC_FEATURES, "station_mean"]
    sides = [means_by_category(train, side, "station") for side in (train, test)]
    assert sides[1].count() == test.count()
    scored = compare_models(*sides, ["decision_tree"], numeric=numeric, categorical=("season",))
    spread = test.agg(F.stddev_pop("pm25")).first()[0]
    assert scored.first().rmse < spread


def test_unseen_categories_get_the_overall_mean(spark, collected):
    train = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 8.0)], "station string, pm25 double")
    rows = spark.createDataFrame([("a", 0.0), ("z", 0.0), (None, 0.0)], "station string, pm25 double")
    got = collected(means_by_category(train, rows, "station"), "station", "station_mean")
    assert got == [(None, 4.0), ("a", 2.0), ("z", 4.0)]
