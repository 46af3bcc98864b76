"""Queries: regression. Two features where SQL has a closed form, seven otherwise."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from skymeter.operators.regression import (
    CATEGORICAL_FEATURES,
    LABEL,
    NUMERIC_FEATURES,
    compare_models,
    fit_features,
    fit_models,
    linear_coefficients,
    predict,
    rmse,
    train_test_split,
    training_rows,
)
from skymeter.operators.composite import top_rows
from skymeter.plans.adapters import (
    EVENT_FEATURES,
    ORDER_FEATURES,
    event_features,
    stored_event_features,
    stored_order_features,
)

KEY = "event_id"
TWO_FEATURES = ("hour", "day")
COLUMNS = [LABEL, *NUMERIC_FEATURES, *CATEGORICAL_FEATURES, "datetime", KEY]
VECTOR = ["year", "month", "day", "hour", "is_weekend", "station_index", "season_index"]


def _data(spark, folder):
    return training_rows(stored_event_features(spark, folder), carry=("datetime", KEY))


def _year_data(spark, folder):
    return training_rows(stored_order_features(spark, folder), carry=("datetime", "o_orderkey"))


def _split(spark, folder):
    return train_test_split(_data(spark, folder), [KEY])


def _two_feature_model(train):
    index = fit_features(train, TWO_FEATURES, ())
    return index, fit_models(train, index, ["linear_regression"])


def split_sides(spark, folder):
    sides = zip(("train", "test"), _split(spark, folder))
    train, test = (rows.select(KEY, F.lit(name).alias("side")) for name, rows in sides)
    return train.union(test)


def string_index(spark, folder):
    data = _year_data(spark, folder)
    indexed = fit_features(data).transform(data)
    return indexed.groupBy("station", "station_index", "season", "season_index").agg(
        F.count(F.lit(1)).alias("n")
    )


def feature_vector(spark, folder):
    data = _year_data(spark, folder)
    values = fit_features(data).transform(data).select("o_orderkey", vector_to_array("features").alias("_v"))
    return values.select("o_orderkey", *[F.col("_v")[i].alias(name) for i, name in enumerate(VECTOR)])


def lr_coefficients(spark, folder):
    train, _ = _split(spark, folder)
    _, models = _two_feature_model(train)
    terms = linear_coefficients(models["linear_regression"], TWO_FEATURES, train)
    return terms.withColumn("coefficient", F.round("coefficient", 6))


def lr_rmse(spark, folder):
    train, test = _split(spark, folder)
    index, models = _two_feature_model(train)
    scored = predict(test, index, models)
    return scored.agg(F.round(rmse(LABEL, "linear_regression"), 6).alias("rmse"))


def _model_rmse(name):
    def query(spark, folder):
        return compare_models(*_split(spark, folder), [name]).withColumn("rmse", F.round("rmse", 4))

    return query


def prediction_examples(spark, folder):
    train, test = _split(spark, folder)
    index = fit_features(train)
    scored = predict(test, index, fit_models(train, index, ["decision_tree"]))
    examples = top_rows(scored, "datetime", [KEY], 20)
    return examples.select("datetime", "station", LABEL, F.round("decision_tree", 6).alias("prediction"))


def model_comparison(spark, folder):
    return compare_models(*_split(spark, folder)).withColumn("rmse", F.round("rmse", 4))


QUERIES = {
    "ml_input": lambda s, d: training_rows(event_features(s, d), carry=("datetime", KEY)),
    "string_index": string_index,
    "feature_vector": feature_vector,
    "train_test_split": split_sides,
    "lr_coefficients": lr_coefficients,
    "lr_rmse": lr_rmse,
    "lr_full_rmse": _model_rmse("linear_regression"),
    "dt_rmse": _model_rmse("decision_tree"),
    "rf_rmse": _model_rmse("random_forest"),
    "prediction_examples": prediction_examples,
    "model_comparison": model_comparison,
}


def _input_sql(features: str, key: str) -> str:
    columns = ", ".join([*COLUMNS[:-1], key])
    required = " AND ".join(f"{c} IS NOT NULL" for c in COLUMNS[:-1])
    return f"""{features},
        data AS (SELECT {columns} FROM features WHERE {required} AND NOT isnan({LABEL}))"""


_INPUT = _input_sql(EVENT_FEATURES, KEY)
_YEAR_INPUT = _input_sql(ORDER_FEATURES, "o_orderkey")
_INDEXES = """
        station_counts AS (SELECT station, count(*) AS n FROM data GROUP BY station),
        season_counts AS (SELECT season, count(*) AS n FROM data GROUP BY season),
        stations AS (SELECT station, CAST(row_number() OVER (ORDER BY n DESC, station) - 1 AS DOUBLE)
                     AS station_index FROM station_counts),
        seasons AS (SELECT season, CAST(row_number() OVER (ORDER BY n DESC, season) - 1 AS DOUBLE)
                    AS season_index FROM season_counts)"""
_SIDES = f"""{_INPUT},
        sides AS (SELECT *, CASE WHEN CAST('0x' || substr(md5('42|' || CAST({KEY} AS VARCHAR)), 1, 8) AS BIGINT)
                         % 10000 < 8000 THEN 'train' ELSE 'test' END AS side FROM data)"""
_OLS = f"""{_SIDES},
        moments AS (
          SELECT avg(hour) AS mh, avg(day) AS md, avg(pm25) AS my, var_samp(hour) AS vh, var_samp(day) AS vd,
                 covar_samp(hour, day) AS chd, covar_samp(hour, pm25) AS chy, covar_samp(day, pm25) AS cdy
          FROM sides WHERE side = 'train'),
        slopes AS (
          SELECT *, (vd * chy - chd * cdy) / (vh * vd - chd * chd) AS bh,
                    (vh * cdy - chd * chy) / (vh * vd - chd * chd) AS bd FROM moments),
        model AS (SELECT bh, bd, my - bh * mh - bd * md AS b0 FROM slopes)"""

_TRAIN_INDEXES = _INDEXES.replace("FROM data", "FROM sides WHERE side = 'train'")


def _least_squares_sql(features: list[str]) -> str:
    """Steps that leave the residual of the label in ``y``.

    Every feature in turn, centred on the training rows, is taken out of those after it and
    of the label, by its share on the training rows; constant ones have none.
    """
    names = [f"x{i}" for i in range(len(features))]
    means = ", ".join(f"avg({f}) AS m{i}" for i, f in enumerate(features))
    centred = ", ".join(f"{f} - m{i} AS x{i}" for i, f in enumerate(features))
    steps = [
        f"""means AS (SELECT {means}, avg({LABEL}) AS mean_y FROM indexed WHERE side = 'train'),
        step0 AS (SELECT side, {centred}, {LABEL} - mean_y AS y FROM indexed, means)"""
    ]
    for i, name in enumerate(names):
        left = [*names[i + 1 :], "y"]
        shares = ", ".join(
            f"CASE WHEN sum({name} * {name}) > 1e-9 THEN sum({name} * {c}) / sum({name} * {name}) ELSE 0 END AS share_{c}"
            for c in left
        )
        rest = ", ".join(f"{c} - share_{c} * {name} AS {c}" for c in left)
        steps.append(
            f"""shares{i} AS (SELECT {shares} FROM step{i} WHERE side = 'train'),
        step{i + 1} AS (SELECT side, {rest} FROM step{i}, shares{i})"""
        )
    return ",\n        ".join(steps)


ORACLE = {
    "lr_full_rmse": f"""WITH {_SIDES}, {_TRAIN_INDEXES},
        indexed AS (SELECT * FROM sides JOIN stations USING (station) JOIN seasons USING (season)),
        {_least_squares_sql(VECTOR)}
        SELECT 'linear_regression' AS model, round(sqrt(avg(y * y)), 4) AS rmse
        FROM step{len(VECTOR)} WHERE side = 'test'""",
    "ml_input": f"WITH {_INPUT} SELECT * FROM data",
    "string_index": f"""WITH {_YEAR_INPUT}, {_INDEXES}
        SELECT station, station_index, season, season_index, count(*) AS n
        FROM data JOIN stations USING (station) JOIN seasons USING (season)
        GROUP BY station, station_index, season, season_index""",
    "feature_vector": f"""WITH {_YEAR_INPUT}, {_INDEXES}
        SELECT o_orderkey, {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in VECTOR)}
        FROM data JOIN stations USING (station) JOIN seasons USING (season)""",
    "train_test_split": f"WITH {_SIDES} SELECT {KEY}, side FROM sides",
    "lr_coefficients": f"""WITH {_OLS}
        SELECT 'hour' AS term, round(bh, 6) AS coefficient FROM model UNION ALL
        SELECT 'day', round(bd, 6) FROM model UNION ALL SELECT 'intercept', round(b0, 6) FROM model""",
    "lr_rmse": f"""WITH {_OLS}
        SELECT round(sqrt(avg(power(pm25 - (b0 + bh * hour + bd * day), 2))), 6) AS rmse
        FROM sides, model WHERE side = 'test'""",
}
