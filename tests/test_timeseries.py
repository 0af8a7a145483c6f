"""Ordered operators against pandas, with ties, gaps and one crowded key."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tilth.operators import timeseries as ops
from tilth.operators.quantiles import exact_median
from tilth.operators.scan import running

START = pd.Timestamp("2020-03-01")


def series(n, seed=0, ties=True, crowd=0.4):
    """Readings of five stations; one station has ``crowd`` of all rows."""
    rng = np.random.default_rng(seed)
    station = np.where(rng.random(n) < crowd, "MB1", rng.choice(["MB2", "MB3", "MB4", "SK1"], n))
    minutes = rng.integers(0, 60 * 24 * 20, n) if ties else rng.permutation(60 * 24 * 20)[:n]
    value = np.where(rng.random(n) < 0.35, np.nan, rng.normal(5, 3, n).round(3))
    return pd.DataFrame(
        {"id": np.arange(n), "station": station, "date": START + pd.to_timedelta(minutes, "m"), "x": value}
    )


def to_spark(spark, frame):
    rows = frame.astype(object).where(frame.notna(), None)
    kinds = {"M": "timestamp_ntz", "i": "bigint", "f": "double", "O": "string"}
    ddl = ", ".join(f"{c} {kinds.get(frame[c].dtype.kind, 'string')}" for c in frame.columns)
    values = [
        tuple(v.to_pydatetime() if isinstance(v, pd.Timestamp) else v for v in row)
        for row in rows.itertuples(index=False)
    ]
    return spark.createDataFrame(values, ddl)


def hash_order(spark, frame, col):
    """Frame in the order the library gives rows of one instant."""
    import hashlib

    return frame.assign(h=[hashlib.md5(str(v).encode()).hexdigest() for v in frame[col]]).sort_values(["date", "h"])


def test_running_over_ties_equals_pandas(spark):
    frame = series(3000)
    frame["date"] = frame["date"].dt.floor("D")  # hundreds of rows share an instant
    table, order, helpers = ops.with_time_order(to_spark(spark, frame), "date", ["id"])
    out = running(table, ["station"], order, {"total": ("sum", "x"), "prev": ("last", "x"), "next": ("next", "x")})
    got = out.select("id", "total", "prev", "next").toPandas().sort_values("id").reset_index(drop=True)
    want = hash_order(spark, frame, "id")
    by = want.groupby("station")["x"]
    want = want.assign(total=by.cumsum(), prev=by.ffill(), next=by.bfill()).sort_values("id")
    known = want["x"].notna().to_numpy()
    np.testing.assert_allclose(got["total"][known], want["total"][known], atol=1e-9)
    np.testing.assert_array_equal(got["prev"].fillna(-99), want["prev"].fillna(-99))
    np.testing.assert_array_equal(got["next"].fillna(-99), want["next"].fillna(-99))


def test_running_keeps_rows_without_a_key(spark):
    table = spark.createDataFrame(
        [(None, 1, 1.0), (None, 2, 2.0), ("a", 1, 3.0), ("a", 2, 4.0)], "k string, t int, x double"
    ).withColumn("b", F.lit(0))
    rows = running(table, ["k"], ["t"], {"s": ("sum", "x")}).orderBy("k", "t").collect()
    assert [(r.k, r.s) for r in rows] == [(None, None), (None, None), ("a", 3.0), ("a", 7.0)]


def test_running_over_many_ranges_and_batches(spark):
    """Long gaps, lone rows, keys in many ranges and infinities that stay with their key."""
    rng = np.random.default_rng(11)
    n = 6000
    frame = pd.DataFrame({"k": np.where(rng.random(n) < 0.6, "hot", [f"k{i}" for i in rng.integers(0, 400, n)]), "t": rng.permutation(n), "x": rng.normal(size=n), "i": rng.integers(-5, 5, n)})
    frame.loc[(rng.random(n) < 0.9) | frame["t"].between(1000, 4000), "x"] = np.nan
    frame.loc[frame["k"] == "k7", "x"] = np.inf
    specs = {"s": ("sum", "x"), "si": ("sum", "i"), "n": ("count", "x"), "a": ("last_at", "x"), "b": ("next_at", "x"), "l": ("last", "i")}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "97")
    try:
        out = running(to_spark(spark, frame), ["k"], ["t"], specs)
        got = out.selectExpr("k", "t", "x", "i", "s", "si", "n", "a.p ap", "a.v av", "b.p bp", "b.v bv", "l").toPandas().sort_values(["k", "t"], ignore_index=True)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = frame.sort_values(["k", "t"], ignore_index=True)
    by = want.groupby("k")
    place = by.cumcount() + 1
    known = want.assign(p=place.where(want["x"].notna())).groupby("k")
    total = by["x"].transform(lambda s: s.fillna(0).cumsum())
    seen = by["x"].transform(lambda s: s.notna().cumsum() > 0)
    same = lambda a, b: np.testing.assert_allclose(a.astype(float).fillna(-99), b.astype(float).fillna(-99), atol=1e-9)
    same(got["s"], total.where(seen))
    same(got["si"], by["i"].cumsum())
    same(got["n"], place)
    same(got["ap"], known["p"].ffill())
    same(got["av"], by["x"].ffill())
    same(got["bp"], known["p"].bfill())
    same(got["bv"], by["x"].bfill())
    same(got["l"], want["i"])


def test_fill_and_interpolate_equal_pandas(spark):
    frame = series(1500, seed=1, ties=False)
    table = to_spark(spark, frame)
    want = frame.sort_values("date")
    by = want.groupby("station")["x"]
    want = want.assign(
        filled=by.transform(lambda s: s.ffill().bfill()), line=by.transform(lambda s: s.interpolate())
    ).sort_values("id")
    filled = ops.fill_forward_backward(table, ["x"]).toPandas().sort_values("id")
    line = ops.interpolate_linear(table, "x").toPandas().sort_values("id")
    np.testing.assert_allclose(filled["x"], want["filled"])
    np.testing.assert_allclose(line["x"], want["line"], atol=1e-9)


def test_interpolate_whole_table_with_ties(spark):
    frame = series(600, seed=2)
    frame["date"] = frame["date"].dt.floor("D")
    got = ops.interpolate_linear(to_spark(spark, frame), "x", by=[], ids=["id"]).toPandas().sort_values("id")
    want = hash_order(spark, frame, "id").assign(line=lambda f: f["x"].interpolate()).sort_values("id")
    np.testing.assert_allclose(got["x"], want["line"], atol=1e-9)


def test_asof_equals_merge_asof(spark):
    rng = np.random.default_rng(3)
    left = series(600, seed=3)[["id", "station", "date"]]
    # whole minutes, so ties and exact two-hour gaps occur
    right = series(500, seed=4)[["id", "station", "date"]].rename(columns={"id": "rid"})
    edge = left.iloc[::7].assign(rid=lambda f: 10_000 + f["id"], date=lambda f: f["date"] + pd.Timedelta("2h"))
    both = left.iloc[::11].assign(rid=lambda f: 20_000 + f["id"])
    right = pd.concat([right, edge[right.columns], both[right.columns]], ignore_index=True)
    right["v"] = rng.normal(size=len(right)).round(6)
    want = pd.merge_asof(
        left.sort_values(["date", "id"]),
        right.sort_values(["date", "rid"], kind="stable"),
        on="date",
        by="station",
        tolerance=pd.Timedelta("2h"),
        direction="nearest",
    ).sort_values("id")
    got = ops.asof_nearest(to_spark(spark, left), to_spark(spark, right), right_ids=["rid"]).toPandas().sort_values("id")
    assert len(got) == len(left)
    np.testing.assert_array_equal(got["rid"].fillna(-1), want["rid"].fillna(-1))
    np.testing.assert_array_equal(got["v"].fillna(-9), want["v"].fillna(-9))


def test_asof_tie_goes_to_the_earlier(spark):
    at = lambda h: dt.datetime(2020, 1, 1, h)
    left = spark.createDataFrame([("a", at(10)), ("b", at(10))], "station string, date timestamp_ntz")
    right = spark.createDataFrame(
        [("a", at(9), 1), ("a", at(11), 2), ("b", at(12), 3), ("b", at(7), 4)], "station string, date timestamp_ntz, v int"
    )
    got = {r.station: r.v for r in ops.asof_nearest(left, right).collect()}
    assert got == {"a": 1, "b": 3}


def test_median_equals_pandas_in_groups_of_all_sizes(spark):
    rng = np.random.default_rng(5)
    sizes = {"one": 1, "two": 2, "odd": 301, "even": 500, "crowded": 40_000}
    frame = pd.concat([pd.DataFrame({"g": g, "x": rng.normal(size=n)}) for g, n in sizes.items()])
    frame = pd.concat([frame, pd.DataFrame({"g": "same", "x": [2.5] * 1000}), pd.DataFrame({"g": [None] * 3, "x": [1.0, 2.0, 4.0]})])
    table = to_spark(spark, frame)
    # a coarse sketch forces the bracket to cut through the crowded group
    got = {r.g: r.median for r in exact_median(table, ["g"], "x", accuracy=50).collect()}
    want = frame.groupby("g", dropna=False)["x"].median()
    assert len(got) == 7
    for g, m in want.items():
        assert got[None if pd.isna(g) else g] == pytest.approx(m, abs=1e-12)


def test_spans(spark):
    day = lambda d: dt.date(2020, 1, d)
    days = spark.createDataFrame([(day(d),) for d in (1, 2, 3, 6, 8, 9)], "day date")
    got = [(r.start.day, r.end.day) for r in ops.spans_of_consecutive_days(days).orderBy("start").collect()]
    assert got == [(1, 3), (6, 6), (8, 9)]
    daily = spark.createDataFrame(
        [(day(1), -1.0), (day(2), 2.0), (day(3), -1.0), (day(6), -2.0), (day(8), 1.0)], "day date, t double"
    )
    runs = ops.spans_between_changes(daily, F.col("t") <= 0).orderBy("start").collect()
    assert [(r.start.day, r.end.day) for r in runs] == [(1, 1), (3, 6)]


def test_daily_sums_and_calendar(spark):
    at = lambda d, h=0: dt.datetime(2020, 1, d, h)
    rain = spark.createDataFrame(
        [("a", at(1), 1.0), ("a", at(1, 5), 2.0), ("a", at(4), None), ("a", at(5), 1.0), ("b", at(1), 0.0)],
        "station string, date timestamp_ntz, prcp double",
    )
    got = [(r.station, r.day.day, r.total) for r in ops.daily_sum_dense(rain, "prcp").orderBy("day").collect()]
    assert got == [("a", 1, 3.0), ("a", 2, 0.0), ("a", 3, 0.0), ("a", 4, 0.0), ("a", 5, 1.0)]
    pooled = ops.daily_sum_dense(rain, "prcp", by=[]).orderBy("day").collect()
    assert [r.total for r in pooled] == [3.0, 0.0, 0.0, 0.0, 1.0]
    daily = ops.daily_midrange(rain, {"mid": "prcp"})
    dense = ops.calendar_densify(daily).filter("station = 'a'").orderBy("day").collect()
    assert [r.mid for r in dense] == [1.5, None, None, None, 1.0]


@pytest.mark.parametrize("known", [True, False])
def test_rain_is_pooled_only_where_no_station_has_any(spark, known):
    rows = [("dry", "a", "2020-05-01", 0.0), ("dry", "b", "2020-05-03", 0.0), ("odd", None, "2020-05-01", 1.0), ("odd", None, "2020-05-03", 2.0), ("odd", "a", "2020-05-04", 0.0)]
    rows += [("wet", "a", "2020-05-01", 4.0), ("wet", "a", "2020-05-03", 1.0), ("wet", "b", "2020-05-02", 0.0), ("wet", None, "2020-05-09", 7.0)] if known else []
    rain = spark.createDataFrame(rows, "panel string, station string, day string, prcp double").withColumn("date", F.to_timestamp("day").cast("timestamp_ntz"))
    got = [(r.panel, r.station, r.pooled, r.day.day, r.total) for r in ops.daily_sum_or_pooled(rain, "prcp", within=["panel"]).collect()]
    odd = [("odd", None, True, d, t) for d, t in ((1, 1.0), (2, 0.0), (3, 2.0), (4, 0.0))]
    wet = [("wet", "a", False, d, t) for d, t in ((1, 4.0), (2, 0.0), (3, 1.0))] if known else []
    assert sorted(got, key=str) == sorted(odd + wet, key=str)
    all_in_one = ops.daily_sum_or_pooled(rain.where("panel <> 'wet'"), "prcp").collect()
    assert {r.pooled for r in all_in_one} == {True}
    assert ops.daily_sum_or_pooled(rain.limit(0), "prcp").count() == 0
