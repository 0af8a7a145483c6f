"""Splits, forest regression and its scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilth.operators.forest import walk
from tilth.operators.forest_fit import learn, node_rows
from tilth.schemas import require_columns
from tilth.session import delete_at_end, materialize, scratch_path

# Model inputs per target, and the forest's settings.
MOISTURE_FEATURES = ("angle", "vvs", "s", "l", "year", "doy", "lc", "op")
OTHER_FEATURES = ("vh", "vv", "angle", "rvi", "year", "doy", "lc", "op")
NUM_TREES, MAX_DEPTH, SEED = 15, 15, 42
TEST_FRACTION = 0.2
#: Training rows that a cache of row objects, about 300 bytes each with their nodes, holds in a few gigabytes.
CACHED_ROWS = 1 << 22


def features_for(target: str) -> tuple[str, ...]:
    return MOISTURE_FEATURES if target.lower() == "ssm" else OTHER_FEATURES


def select_features(df: DataFrame, target: str) -> DataFrame:
    """Add the ``features`` vector and ``label`` for a target; rows must be complete."""
    target = target.lower()
    inputs = features_for(target)
    require_columns(df, [target, *inputs], f"training table for {target!r}")
    numeric = df.withColumns({f"__f_{c}": F.col(c).cast("double") for c in inputs})
    assembled = VectorAssembler(inputCols=[f"__f_{c}" for c in inputs], outputCol="features").transform(numeric)
    return assembled.withColumn("label", F.col(target).cast("double")).drop(*[f"__f_{c}" for c in inputs])


def _complete(df: DataFrame, target: str) -> Column:
    target = target.lower()
    require_columns(df, [target, *features_for(target)], f"training table for {target!r}")
    out = F.lit(True)
    for c in [target, *features_for(target)]:
        out = out & F.col(c).isNotNull()
    return out


def filter_complete_cases(df: DataFrame, target: str) -> DataFrame:
    """Rows with no NULL among the target and its features."""
    return df.filter(_complete(df, target))


def completeness(df: DataFrame, target: str) -> DataFrame:
    """One row: how many rows :func:`filter_complete_cases` keeps and drops."""
    ok = _complete(df, target)
    return df.agg(F.count_if(ok).alias("kept"), F.count_if(~ok).alias("dropped"))


def holdout_year_per_station(df: DataFrame, seed: int = SEED) -> DataFrame:
    """One year per station, uniform over its years and repeatable from the seed."""
    draw = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("station"), F.col("year").cast("string")))
    return (
        df.select("station", "year")
        .dropna()
        .distinct()
        .groupBy("station")
        .agg(F.min_by("year", draw).alias("test_year"))
    )


def split_by_holdout_year(df: DataFrame, chosen: DataFrame) -> DataFrame:
    """``is_test`` marks rows of their station's held-out year.

    ``chosen`` is written first (runs a job), so the planner knows its size and
    need not shuffle the rows by their few stations.
    """
    chosen = materialize(chosen, "chosen")
    return df.join(chosen, on="station", how="left").select(
        *df.columns, F.coalesce(F.col("test_year") == F.col("year"), F.lit(False)).alias("is_test")
    )


def random_split(
    df: DataFrame, ids: Sequence[str], fraction: float = TEST_FRACTION, seed: int = SEED
) -> DataFrame:
    """``is_test`` for about ``fraction`` of the rows, by a hash of the row's ids and the seed.

    The same rows fall on the same side whatever the partitioning.
    """
    key = F.concat_ws(":", *[F.col(c).cast("string") for c in ids], F.lit(str(seed)))
    return df.withColumn("is_test", F.conv(F.substring(F.md5(key), 1, 4), 16, 10).cast("int") < int(fraction * 65536))


def check_split(split: DataFrame) -> DataFrame:
    """Fail when either side is empty. Runs one aggregate."""
    n_test, n_train = split.agg(F.count_if("is_test"), F.count_if(~F.col("is_test"))).first()
    if not n_test or not n_train:
        raise ValueError(f"split leaves {n_train} rows to train on and {n_test} to test on")
    return split


def train_forest(
    train: DataFrame,
    target: str,
    num_trees: int = NUM_TREES,
    max_depth: int = MAX_DEPTH,
    seed: int = SEED,
) -> RandomForestRegressionModel:
    """Random forest over all features per split, on bootstrap samples; runs jobs.

    Up to ``CACHED_ROWS`` rows MLlib's trainer holds them in its cache and keeps the node of each,
    so that no level walks them down from the roots again. More are learned from binned rows
    (see ``operators/forest_fit.py``): the same rules, other draws of the same bags.
    """
    forest = RandomForestRegressor(
        numTrees=num_trees,
        maxDepth=max_depth,
        seed=seed,
        featureSubsetStrategy="all",
        bootstrap=True,
        featuresCol="features",
        labelCol="label",
        cacheNodeIds=True,
    )
    assembled = select_features(train, target).select("features", "label")
    rows = materialize(assembled.select(vector_to_array("features").alias("x"), "label"), "training")
    n = rows.count()
    return forest.fit(assembled) if n <= CACHED_ROWS else fit_binned(forest, rows, n)


def fit_binned(forest: RandomForestRegressor, rows: DataFrame, n: int) -> RandomForestRegressionModel:
    """What ``forest`` learns from the ``n`` written rows (x, label); runs jobs.

    The nodes are stored in MLlib's form, beside the settings of a model of two rows, and read as its model.
    """
    nodes, cuts = learn(rows, n, forest.getNumTrees(), forest.getMaxDepth(), forest.getSeed(), forest.getBootstrap())
    path = scratch_path(rows.sparkSession, "forest")
    forest.fit(rows.limit(2).select(array_to_vector("x").alias("features"), "label")).write().save(path)
    delete_at_end(rows.sparkSession, path)
    node_rows(rows.sparkSession, nodes, cuts).write.mode("overwrite").parquet(f"{path}/data")
    return RandomForestRegressionModel.load(path)


def predict_holdout(model: RandomForestRegressionModel, test: DataFrame, target: str) -> DataFrame:
    """Full test rows with ``<target>_pred``."""
    scored = model.transform(select_features(test, target))
    return scored.withColumnRenamed("prediction", f"{target.lower()}_pred").drop("features", "label")


def predict_nodes(nodes: DataFrame, test: DataFrame, target: str, ids: Sequence[str] = ("obs_id",)) -> DataFrame:
    """As :func:`predict_holdout`, from a forest's node rows; ``ids`` tell rows apart.

    Runs jobs over the nodes, and one that writes ``test``, which is walked and joined with its predictions.
    """
    require_columns(test, [target.lower(), *features_for(target)], f"test table for {target!r}")
    test = materialize(test, "test")
    scored = walk(test, nodes, features_for(target), ids, f"{target.lower()}_pred")
    return test.join(scored, on=list(ids))


def regression_metrics(df: DataFrame, target: str, prediction: str | None = None) -> DataFrame:
    """One row: r2, mae, mse, rmse, ubrmse and bias = mean(observed - predicted)."""
    y, p = F.col(target), F.col(prediction or f"{target}_pred")
    err = y - p
    sums = df.agg(
        F.avg(F.abs(err)).alias("mae"),
        F.avg(err * err).alias("mse"),
        F.avg(err).alias("bias_obs_pred"),
        F.var_pop(F.when(p.isNotNull(), y)).alias("__var"),
    )
    spread = F.col("mse") - F.col("bias_obs_pred") * F.col("bias_obs_pred")
    return sums.select(
        (F.lit(1.0) - F.try_divide(F.col("mse"), F.col("__var"))).alias("r2"),
        "mae",
        "mse",
        F.sqrt("mse").alias("rmse"),
        "bias_obs_pred",
        F.sqrt(F.greatest(spread, F.lit(0.0))).alias("ubrmse"),
    )


def tree_table_export(spark, model: RandomForestRegressionModel) -> DataFrame:
    """One row per tree: its text on one line, nodes parted by ``#``.

    Rows come from the fitted model, which lives on the driver and whose size
    is set by the number and depth of its trees, not by the data.
    """
    rows = [(i, tree.toDebugString) for i, tree in enumerate(model.trees)]
    raw = spark.createDataFrame(rows, "tree_id int, tree string")
    lines = F.regexp_replace(F.trim("tree"), r"\s*\n\s*", "#")
    return raw.withColumn("tree", F.regexp_replace(lines, r"\s+", " "))


def train_targets(df: DataFrame, targets: Sequence[str], holdout_by_year: bool = True, ids=("obs_id",)) -> dict:
    """Per target: the model, its metrics table, its scored test rows, and how many rows were complete."""
    chosen = holdout_year_per_station(df) if holdout_by_year else None
    out = {}
    for target in targets:
        clean = filter_complete_cases(df, target)
        split = check_split(split_by_holdout_year(clean, chosen) if holdout_by_year else random_split(clean, ids))
        model = train_forest(split.filter(~F.col("is_test")), target)
        scored = predict_holdout(model, split.filter("is_test").drop("is_test"), target)
        out[target] = {
            "model": model,
            "metrics": regression_metrics(scored, target.lower()),
            "holdout": scored,
            "rows": completeness(df, target),
        }
    return out
