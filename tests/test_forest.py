import contextlib
import io
import re

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from tilth.operators import forest, forest_fit, modelling
from tilth.sources import sinks

INPUTS = modelling.MOISTURE_FEATURES
NODES = "tree int, node int, feature int, threshold double, left int, right int, value double"


def table(spark, n=600, seed=3):
    rng = np.random.default_rng(seed)
    frame = pd.DataFrame({c: rng.normal(size=n).round(2) for c in INPUTS})
    frame["ssm"] = (frame["vvs"] > 0.1) * frame["angle"] + frame["doy"] ** 2
    frame.insert(0, "obs_id", [f"r{i}" for i in range(n)])
    return spark.createDataFrame(frame)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    rows = table(spark)
    model = modelling.train_forest(rows.where("obs_id < 'r4'"), "ssm", num_trees=5, max_depth=7)
    path = str(tmp_path_factory.mktemp("forest") / "model")
    sinks.write_model(model, path)
    return rows, model, sinks.read_nodes(spark, path)


def test_walk_predicts_what_the_model_does(stored):
    rows, model, nodes = stored
    want = {r["obs_id"]: r["ssm_pred"] for r in modelling.predict_holdout(model, rows, "ssm").collect()}
    got = modelling.predict_nodes(nodes, rows, "ssm").collect()
    assert len(got) == len(want) == 600
    assert all(abs(r["ssm_pred"] - want[r["obs_id"]]) < 1e-12 for r in got)


def test_levels_joined_by_shuffle_give_the_same(stored, monkeypatch):
    rows, _, nodes = stored
    want = sorted(map(tuple, forest.walk(rows, nodes, INPUTS, ["obs_id"]).collect()))
    monkeypatch.setattr(forest, "BROADCAST_NODES", -1)
    got = dict(map(tuple, forest.walk(rows, nodes, INPUTS, ["obs_id"]).collect()))
    assert all(abs(got[i] - p) < 1e-12 for i, p in want) and len(got) == len(want)


def test_recursive_sql_over_stored_nodes(stored):
    rows, _, nodes = stored
    held, stored_nodes = rows.toPandas(), nodes.toPandas()  # noqa: F841 (read by the SQL)
    x = ", ".join(INPUTS)
    sql = f"""WITH RECURSIVE w AS (SELECT obs_id, [{x}] AS x, tree, 0 AS node FROM held, (SELECT DISTINCT tree FROM stored_nodes)
        UNION ALL SELECT obs_id, x, w.tree, CASE WHEN x[CAST(feature AS INT) + 1] <= threshold THEN "left" ELSE "right" END
        FROM w JOIN stored_nodes n ON n.tree = w.tree AND n.node = w.node WHERE "left" IS NOT NULL)
      SELECT obs_id, avg(value) FROM w JOIN stored_nodes n ON n.tree = w.tree AND n.node = w.node WHERE "left" IS NULL GROUP BY obs_id"""
    want = dict(duckdb.sql(sql).fetchall())
    got = forest.walk(rows, nodes, INPUTS, ["obs_id"]).collect()
    assert len(got) == len(want) and all(abs(r["prediction"] - want[r["obs_id"]]) < 1e-12 for r in got)


def test_text_and_sizes_are_those_of_the_model(stored):
    _, model, nodes = stored
    texts = {r["tree_id"]: r["tree"] for r in forest.tree_text(nodes).collect()}
    sizes = {r["tree"]: (r["n_nodes"], r["depth"]) for r in forest.forest_size(nodes).collect()}
    for i, tree in enumerate(model.trees):
        lines = re.sub(r"\s*\n\s*", "#", tree.toDebugString.strip()).split("#", 1)[1]
        assert texts[i] == lines
        assert sizes[i] == (tree.numNodes, tree.depth)


def test_a_lone_leaf_missing_features_and_no_forest(spark):
    rows = spark.createDataFrame([(1, 0.5, None), (2, None, 1.0)], "id long, a double, b double")
    leaf = [(0, 0, None, None, None, None, 4.0)]
    split = [(1, 0, 0, 0.5, 1, 2, 9.0), (1, 1, None, None, None, None, 1.0), (1, 2, None, None, None, None, 3.0)]
    got = forest.walk(rows, spark.createDataFrame(leaf + split, NODES), ["a", "b"], ["id"])
    assert sorted(map(tuple, got.collect())) == [(1, 2.5), (2, 3.5)]
    assert forest.tree_text(spark.createDataFrame(leaf, NODES)).collect()[0]["tree"] == "Predict: 4.0"
    assert forest.walk(rows, spark.createDataFrame([], NODES), ["a", "b"], ["id"]).count() == 0


def test_splits_by_category_are_refused(spark, tmp_path):
    data = "treeID int, nodeData struct<id:int,prediction:double,rawCount:long,leftChild:int,rightChild:int,split:struct<featureIndex:int,leftCategoriesOrThreshold:array<double>,numCategories:int>>"
    spark.createDataFrame([(0, (0, 1.0, 5, 1, 2, (0, [1.0, 2.0], 3)))], data).write.parquet(str(tmp_path / "data"))
    with pytest.raises(Exception, match="split by category"):
        sinks.read_nodes(spark, str(tmp_path)).collect()


def spine(depth):
    """One tree whose inner nodes are 0, 2, 4...; the left child of each is a leaf with its level as value."""
    inner = [(0, 2 * i, 0, float(i), 2 * i + 1, 2 * i + 2, 0.0) for i in range(depth)]
    leaves = [(0, 2 * i + 1, None, None, None, None, float(i)) for i in range(depth)]
    return [*inner, *leaves, (0, 2 * depth, None, None, None, None, float(depth))]


def test_deep_walk_is_compiled_in_parts(spark):
    names = "abcdefgh"
    schema = "id string, " + ", ".join(f"{c} double" for c in names)
    rows = spark.createDataFrame([(str(i), *[i - 0.5] * 8) for i in range(18)], schema).repartition(3)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # only a plan that is not adaptive shows its code
    try:
        out = forest.walk(rows, spark.createDataFrame(spine(15), NODES), list(names), ["id"])
        text = io.StringIO()
        with contextlib.redirect_stdout(text):
            out.explain("codegen")
        got = dict(map(tuple, out.collect()))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(-?\d+)", text.getvalue())]
    assert min(sizes) > 0 and max(sizes) < 5000, sizes  # -1: not compiled at all; beyond 8000 the JVM interprets
    assert got == {str(i): float(min(i, 15)) for i in range(18)}


def test_training_keeps_the_nodes_of_its_rows(stored):
    """Else every level walks all rows down from the roots again."""
    assert stored[1].getCacheNodeIds()


@pytest.mark.parametrize("local", [1 << 22, 150, 1])
def test_binned_rows_give_the_trees_of_mllib(spark, monkeypatch, local):
    """Grown in one task, partly by histograms, and by histograms down to the leaves; without bags both are exact."""
    monkeypatch.setattr(forest_fit, "LOCAL_ROWS", local)
    rows = table(spark, 900).withColumns({"lc": F.round("lc"), "op": F.lit(0.0)}).repartition(3)
    trainer = RandomForestRegressor(numTrees=1, maxDepth=4, seed=42, featureSubsetStrategy="all", bootstrap=False)
    assembled = modelling.select_features(rows, "ssm").select("features", "label").cache()
    want = trainer.fit(assembled)
    written = modelling.materialize(rows.select(F.array(*INPUTS).alias("x"), F.col("ssm").alias("label")))
    model = modelling.fit_binned(trainer, written, 900)
    # two splits that part a node's rows alike are one as good as the other, so rows are compared, not splits
    both = model.setPredictionCol("got").transform(want.setPredictionCol("want").transform(assembled))
    assert both.where("abs(got - want) > 1e-9").isEmpty() and both.select("want").distinct().count() > 9
    assert (model.trees[0].numNodes, model.trees[0].depth) == (want.trees[0].numNodes, want.trees[0].depth)
    first = lambda m: m.trees[0].toDebugString.split("\n")[1:4]
    assert first(model) == first(want) and model.getMaxDepth() == 4 and model.numFeatures == len(INPUTS)


def test_many_rows_are_not_held_as_objects(spark, monkeypatch, tmp_path):
    """Beyond ``CACHED_ROWS`` MLlib's trainer sees two rows, for its settings; the forest is whole all the same."""
    fit, seen = RandomForestRegressor.fit, []
    monkeypatch.setattr(RandomForestRegressor, "fit", lambda self, rows: seen.append(rows.count()) or fit(self, rows))
    monkeypatch.setattr(modelling, "CACHED_ROWS", 100)
    monkeypatch.setattr(forest_fit, "LOCAL_ROWS", 200)
    rows = table(spark, 2000, seed=5).repartition(3)
    model = modelling.train_forest(rows, "ssm", num_trees=9, max_depth=6)
    assert seen == [2]
    path = str(tmp_path / "model")
    sinks.write_model(model, path)
    nodes = sinks.read_nodes(spark, path)
    want = {r["obs_id"]: (r["ssm"], r["ssm_pred"]) for r in modelling.predict_holdout(model, rows, "ssm").collect()}
    got = {r["obs_id"]: r["prediction"] for r in forest.walk(rows, nodes, INPUTS, ["obs_id"]).collect()}
    assert all(abs(got[i] - p) < 1e-9 for i, (_, p) in want.items()) and len(got) == 2000
    truth, predicted = np.array(list(want.values())).T
    assert np.mean((truth - predicted) ** 2) < 0.2 * np.var(truth)
    assert {r["depth"] for r in forest.forest_size(nodes).collect()} == {6}
    # each tree has a bag of its own, and all rows of a node's bag go to its children
    every = {(r["tree"], r["node"]): r for r in nodes.collect()}
    roots = [every[t, 0]["n"] for t in range(9)]
    assert len(set(roots)) > 5 and all(abs(n - 2000) < 250 for n in roots)
    assert all(r["n"] == every[r["tree"], r["left"]]["n"] + every[r["tree"], r["right"]]["n"] for r in every.values() if r["left"])


def test_leaves_that_agree_are_one_and_pure_nodes_are_not_split():
    """Two bins of one feature with equal labels, parted by a third; the feature beside it says nothing."""
    codes = np.array([[0, 0, 1, 1, 2, 2], [0, 1, 0, 1, 0, 1]], np.uint8)
    y = np.array([1.0, 1.0, 1.0, 1.0, 5.0, 5.0])
    grown = forest_fit.grow(codes, y, np.array([1.0, 2.0, 1.0, 1.0, 3.0, 1.0]), 4)
    assert grown["feature"].tolist() == [0, -1, -1] and grown["cut"][0] == 1 and grown["w"].tolist() == [9.0, 5.0, 4.0]
    # a split whose two leaves predict the same is taken back
    tree = {"w": [4, 2, 2, 1, 1], "s": [8.0, 4.0, 4.0, 1.0, 3.0], "ss": [20.0, 8.0, 10.0, 1.0, 9.0], "feature": [0, -1, 1, -1, -1], "cut": [0, -1, 0, -1, -1], "gain": [0.1, -1, 1, -1, -1], "left": [1, -1, 3, -1, -1]}
    tree = {c: np.array(v) for c, v in tree.items()}
    assert forest_fit.in_order(tree)["left"].tolist() == [1, -1, 3, -1, -1]
    agreeing = {**tree, "left": np.array([1, -1, -1, -1, -1])}
    assert forest_fit.in_order(agreeing)["prediction"].tolist() == [2.0]


def test_thresholds_are_those_of_mllib_and_rows_must_be_finite(spark):
    assert forest_fit.candidates(np.array([1.0, 1.0, 2.0, 4.0]), 32).tolist() == [1.5, 3.0]
    assert len(forest_fit.candidates(np.arange(1000.0), 32)) == 31
    assert len(forest_fit.candidates(np.ones(5), 5)) == 0
    rows = spark.createDataFrame([([1.0], 2.0), ([2.0], float("nan"))], "x array<double>, label double")
    with pytest.raises(Exception, match="must be finite"):
        forest_fit.binned(rows, [np.array([1.5])], 3, True, 42).collect()
