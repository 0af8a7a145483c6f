"""Splits, forest, scores and validation tables."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tilth.operators import modelling as md
from tilth.operators import validation as val
from tilth.operators.readings import filter_station_contains
from tilth.plans import bindings as b
from tilth.plans.queries_models import training
from tilth.sources import sinks

SF = "/root/testdata/sf0.001"


def test_holdout_years(spark):
    table = b.scenes(spark, SF)
    chosen = md.holdout_year_per_station(table)
    assert chosen.count() == table.select("station").distinct().count()
    assert chosen.join(table.select("station", F.col("year").alias("test_year")), ["station", "test_year"], "left_anti").isEmpty()
    other = md.holdout_year_per_station(table, seed=7)
    assert not chosen.exceptAll(other).isEmpty()
    split = md.check_split(md.split_by_holdout_year(table, chosen))
    assert split.count() == table.count()
    with pytest.raises(ValueError):
        md.check_split(split.filter("is_test"))


def test_random_split_share_and_repeatability(spark):
    ids = spark.range(20_000).withColumnRenamed("id", "obs_id")
    split = md.random_split(ids, ["obs_id"])
    share = split.agg(F.avg(F.col("is_test").cast("int"))).first()[0]
    assert 0.19 < share < 0.21
    assert split.exceptAll(md.random_split(ids.repartition(7), ["obs_id"])).isEmpty()


def test_forest_per_target_and_round_trip(spark, tmp_path):
    table = training(spark, SF).withColumn("rvi", F.col("vv") / F.col("vh"))
    fits = md.train_targets(table, ["SSM", "s"])
    for target, fit in fits.items():
        assert fit["model"].getNumTrees == md.NUM_TREES
        scores = fit["metrics"].first()
        assert scores.ubrmse**2 + scores.bias_obs_pred**2 == pytest.approx(scores.mse)
        assert f"{target.lower()}_pred" in fit["holdout"].columns
    model, held = fits["SSM"]["model"], fits["SSM"]["holdout"]
    sinks.write_model(model, f"{tmp_path}/m")
    again = md.predict_holdout(sinks.read_model(f"{tmp_path}/m"), held.drop("ssm_pred"), "ssm")
    assert again.select("obs_id", "ssm_pred").exceptAll(held.select("obs_id", "ssm_pred")).isEmpty()
    trees = md.tree_table_export(spark, model).collect()
    assert len(trees) == md.NUM_TREES and all("\n" not in t.tree and "  " not in t.tree and "#If" in t.tree for t in trees)
    with pytest.raises(KeyError, match="available"):
        md.filter_complete_cases(table, "nothing")
    counts = md.completeness(table, "ssm").first()
    assert counts.kept + counts.dropped == table.count() and counts.dropped > 0


def test_metrics_equal_numpy(spark):
    rng = np.random.default_rng(0)
    o, p = rng.normal(size=50), rng.normal(size=50)
    rows = [(float(x), float(y)) for x, y in zip(o, p)] + [(None, 1.0), (1.0, float("nan"))]
    m = val.pairwise_metrics(spark.createDataFrame(rows, "o double, p double"), "o", "p").first()
    slope, intercept = np.polyfit(o, p, 1)
    assert m.n == 50
    assert (m.r, m.slope, m.intercept) == pytest.approx((np.corrcoef(o, p)[0, 1], slope, intercept))
    assert m.bias_pred_obs == pytest.approx((p - o).mean()) and m.rmse == pytest.approx(np.sqrt(((p - o) ** 2).mean()))


def test_metrics_edge_cases(spark):
    frame = spark.createDataFrame(
        [("one", 1.0, 2.0), ("flat", 1.0, 2.0), ("flat", 1.0, 3.0), (None, 1.0, 1.0), (None, 2.0, 2.0)],
        "station string, ssm double, ssm_pred double",
    )
    got = {r.station: r for r in val.grouped_metrics(frame, by=["station"]).collect()}
    assert (got["one"].n, got["one"].r, got["one"].slope) == (1, None, None)
    assert (got["flat"].r, got["flat"].slope) == (None, None)
    assert got[None].r == pytest.approx(1.0)
    empty = spark.createDataFrame([(None, 1.0)], "o double, p double")
    with pytest.raises(Exception, match="no valid pairs"):
        val.pairwise_metrics(empty, "o", "p").collect()


def test_subset_errors(spark):
    held = b.holdout(spark, SF)
    with pytest.raises(ValueError, match="no records"):
        val.holdout_subset(held, station="XX1")
    with pytest.raises(KeyError, match="other_pred"):
        val.holdout_subset(held.withColumn("other", F.lit(1)), target="other")


def test_panel_keys_fall_back(spark):
    full = spark.createDataFrame([("a", 2020, "110")], "station string, year int, lc string")
    no_year = spark.createDataFrame([("a", None, "110"), ("b", None, None)], "station string, year int, lc string")
    keys = [tuple(r) for r in val.distinct_keys_priority(full, no_year).collect()]
    assert keys == [(0, "110", "a", "2020")]
    keys = [tuple(r) for r in val.distinct_keys_priority(no_year).collect()]
    assert keys == [(2, None, "b", None), (2, "110", "a", None)]
    assert [tuple(r) for r in val.panel_keys(full, full).collect()] == [("110", 2020)]


def test_station_substring(spark):
    stations = spark.createDataFrame([("MB1",), ("MB10",), ("MB13",), ("mb3",), (None,)], "station string")
    assert {r.station for r in filter_station_contains(stations, "mb1").collect()} == {"MB1", "MB10", "MB13"}
    assert {r.station for r in filter_station_contains(stations, "MB3").collect()} == {"mb3"}


def test_backfill_without_a_target_column(spark):
    held = spark.createDataFrame([("a", 1, 0.5), ("b", 1, 0.6)], "station string, doy int, ssm_pred double")
    seen = spark.createDataFrame([("a", 1, 0.4), ("a", 1, 0.3)], "station string, doy int, ssm double")
    rows = {r.station: r.ssm for r in val.backfill_target(held, seen, "ssm").collect()}
    assert rows == {"a": 0.3, "b": None}
    with pytest.raises(ValueError):
        val.backfill_target(held.select("ssm_pred"), seen, "ssm")


def test_rollup_is_the_groups_the_margins_and_the_total(spark):
    rng = np.random.default_rng(4)
    n = 400
    frame = pd.DataFrame({"station": rng.choice(["a", "b", None], n), "year": rng.integers(2019, 2022, n), "ssm": rng.random(n), "x": 1})
    frame["ssm_pred"] = frame["ssm"] + rng.normal(size=n) * 0.1
    table = spark.createDataFrame([tuple(None if v is None else v for v in r) for r in frame.itertuples(index=False)], "station string, year long, ssm double, x long, ssm_pred double")
    got = {(r.level, r.station, r.year): r for r in val.metrics_rollup(table, by=["station", "year"]).collect()}
    parts = [(["station", "year"], val.grouped_metrics(table, by=["station", "year"])), (["station"], val.grouped_metrics(table, by=["station"]))]
    parts += [(["year"], val.grouped_metrics(table, by=["year"])), ([], val.overall_metrics(table))]
    seen = 0
    for keys, part in parts:
        for r in part.collect():
            own = r.asDict()
            mine = got[",".join(keys) or "all", own.get("station"), own.get("year")].asDict()
            seen += 1
            assert all(mine[c] == pytest.approx(v) for c, v in own.items() if c not in keys)
    assert seen == len(got) == 9 + 3 + 3 + 1
    assert {r.level for r in val.metrics_rollup(table, by=["station", "year"], sets=[["year"], []]).collect()} == {"year", "all"}
    empty = table.withColumn("ssm_pred", F.lit(None).cast("double"))
    for column in ("n", "rmse", "level"):
        with pytest.raises(Exception, match="no valid pairs"):
            val.metrics_rollup(empty, by=["station"]).select(column).collect()


def test_binned_curve_counts_every_row_once(spark):
    frame = pd.DataFrame({"x": [float(i // 3) for i in range(100)], "y": range(100), "year": [i % 2 for i in range(100)]})
    table = spark.createDataFrame(frame).union(spark.createDataFrame([(None, 1, 0)], "x double, y long, year long"))
    rows = val.binned_curve(table, "x", "y", by=["year"], bins=4).collect()
    assert sum(r.n for r in rows) == 100
    edges = np.quantile(frame["x"], [0.25, 0.5, 0.75], method="inverted_cdf")
    want = frame.assign(bin=np.searchsorted(edges, frame["x"], side="left")).groupby(["bin", "year"])
    assert {(r.bin, r.year): (r.n, r.mean_y) for r in rows} == {k: (len(g), g["y"].mean()) for k, g in want}
    assert val.binned_curve(table.limit(0), "x", "y", by=["year"]).count() == 0
    assert [r.n for r in val.binned_curve(table, "x", "y", by=[], bins=1).collect()] == [100]
    with pytest.raises(ValueError):
        val.binned_curve(table, "x", "y", bins=0)
