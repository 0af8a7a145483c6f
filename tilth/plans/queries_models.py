"""Queries over model splits, scores and validation tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilth.operators import forest
from tilth.operators import modelling as md
from tilth.operators import timeseries as ts_ops
from tilth.operators import validation as val
from tilth.plans import bindings as b
from tilth.plans.bindings import with_tables
from tilth.plans.pipeline import growth
from tilth.plans.queries_fit import GROWTH_TABLES, STAGE_TABLES, gappy_scenes, stage_sql
from tilth.plans.queries_readings import WIDE_SQL, wide
from tilth.plans.registry import query, rounded
from tilth.session import delete_at_end, scratch_path
from tilth.sources import sinks

# -- modelling -------------------------------------------------------------

#: scenes with stand-ins for the inversion's results; every tenth day lacks one
TRAIN_SQL = f"SELECT *, CASE WHEN doy % 10 = 0 THEN NULL ELSE vv - 1.5 END AS vvs, {', '.join(b.FIT_STAND_IN[1:])} FROM scenes"


def training(spark, sf_dir) -> DataFrame:
    return b.scenes(spark, sf_dir).selectExpr(
        "*", "CASE WHEN doy % 10 = 0 THEN NULL ELSE vv - 1.5 END AS vvs", *b.FIT_STAND_IN[1:]
    )


def forest_split(spark, sf_dir) -> DataFrame:
    table = training(spark, sf_dir)
    chosen = md.holdout_year_per_station(table)
    return md.split_by_holdout_year(md.filter_complete_cases(table, "ssm"), chosen)


def fitted(spark, sf_dir):
    """The forest for soil moisture and the rows it has not seen."""
    split = forest_split(spark, sf_dir)
    model = md.train_forest(split.filter("NOT is_test"), "ssm")
    return model, split.filter("is_test").drop("is_test")


@query(
    "select_features",
    with_tables("scenes", train=TRAIN_SQL)
    + "SELECT obs_id, "
    + ", ".join(f"round(CAST({c} AS DOUBLE), 6) AS f{i}" for i, c in enumerate(md.features_for("ssm")))
    + ", round(ssm, 6) AS label FROM train WHERE "
    + " AND ".join(f"{c} IS NOT NULL" for c in ("ssm", *md.features_for("ssm"))),
)
def select_features(spark, sf_dir):
    """The assembled vector by position, one row per complete case."""
    from pyspark.ml.functions import vector_to_array

    complete = md.filter_complete_cases(training(spark, sf_dir), "ssm")
    out = md.select_features(complete, "ssm").withColumn("features", vector_to_array("features"))
    places = [F.col("features")[i].alias(f"f{i}") for i in range(len(md.features_for("ssm")))]
    return rounded(out.select("obs_id", *places, "label"))


@query(
    "filter_complete_cases",
    with_tables("scenes", train=TRAIN_SQL)
    + "SELECT obs_id, round(vvs, 6) AS vvs, round(ssm, 6) AS ssm FROM train WHERE vvs IS NOT NULL",
)
def filter_complete_cases(spark, sf_dir):
    return rounded(md.filter_complete_cases(training(spark, sf_dir), "ssm").select("obs_id", "vvs", "ssm"))


CHOSEN_SQL = (
    "SELECT station, year AS test_year FROM (SELECT station, year, row_number() OVER (PARTITION BY station"
    " ORDER BY md5(concat_ws(':', '42', station, CAST(year AS VARCHAR)))) AS rn"
    " FROM (SELECT DISTINCT station, year FROM scenes)) WHERE rn = 1"
)


@query("holdout_year_per_station", with_tables("scenes", chosen=CHOSEN_SQL) + "SELECT * FROM chosen")
def holdout_year_per_station(spark, sf_dir):
    return md.holdout_year_per_station(b.scenes(spark, sf_dir))


@query(
    "split_by_holdout_year",
    with_tables("scenes", chosen=CHOSEN_SQL)
    + "SELECT obs_id, s.station, year, year = test_year AS is_test FROM scenes s JOIN chosen c ON s.station = c.station",
)
def split_by_holdout_year(spark, sf_dir):
    scenes = b.scenes(spark, sf_dir).select("obs_id", "station", "year")
    return md.split_by_holdout_year(scenes, md.holdout_year_per_station(scenes))


@query(
    "random_split",
    with_tables("scenes") + "SELECT obs_id, substr(md5(concat(obs_id, ':42')), 1, 4) < '3333' AS is_test FROM scenes",
)
def random_split(spark, sf_dir):
    return md.random_split(b.scenes(spark, sf_dir).select("obs_id"), ["obs_id"])


COMPLETE_SQL = " AND ".join(f"{c} IS NOT NULL" for c in ("ssm", *md.features_for("ssm")))
HELD_SQL = f"SELECT t.* FROM train t JOIN chosen c ON t.station = c.station AND t.year = c.test_year WHERE {COMPLETE_SQL}"
TREES_SQL = f"SELECT CAST(unnest(range({md.NUM_TREES})) AS INT) AS tree_id"


@query("train_forest", f"SELECT tree_id, true AS grown, true AS depth_ok FROM ({TREES_SQL})")
def train_forest(spark, sf_dir):
    """Whether each tree of the trained forest splits its rows, no deeper than allowed."""
    model, _ = fitted(spark, sf_dir)
    rows = [(i, t.numNodes > 1, t.depth <= md.MAX_DEPTH) for i, t in enumerate(model.trees)]
    return spark.createDataFrame(rows, "tree_id int, grown boolean, depth_ok boolean")


#: Stand-in for a learned forest: trees of up to 31 nodes in heap order, by a rule both engines can follow.
#: Some inner nodes of the lower levels are leaves; what would be below them is left out.
_EARLY = "{0} BETWEEN 3 AND 14 AND (tree + {0}) % 7 = 3"
_LEAF = f"(node >= 15 OR ({_EARLY.format('node')}))"
_SPANS = ((31, 7), (-16, 12), (0.0052, 0.0012), (0.0401, 0.0366), (1992, 7), (1, 365), (30, 150), (0, 1))
_CUT = "CAST((7 * node + 3 * tree) % 9 + 1 AS DOUBLE) / 10"
_FEATURE = "(tree + node) % 8"
_THRESHOLD = f"CASE {_FEATURE} " + " ".join(f"WHEN {i} THEN round(CAST({lo} AS DOUBLE) + CAST({w} AS DOUBLE) * {_CUT}, 4)" for i, (lo, w) in enumerate(_SPANS)) + " END"
FOREST_SQL = (
    f"SELECT tree, node, CASE WHEN NOT {_LEAF} THEN CAST({_FEATURE} AS INT) END AS feature, CASE WHEN NOT {_LEAF} THEN {_THRESHOLD} END AS threshold,"
    f" CASE WHEN NOT {_LEAF} THEN 2 * node + 1 END AS left_node, CASE WHEN NOT {_LEAF} THEN 2 * node + 2 END AS right_node,"
    f" round(CAST((31 * tree + 7 * node) % 97 AS DOUBLE) / 100, 2) AS value FROM numbers"
    f" WHERE NOT (node > 6 AND ({_EARLY.format('up')})) AND NOT (node > 14 AND ({_EARLY.format('grand')}))"
)


def _numbers(explode: str) -> str:
    """(tree, node, up, grand) of all places in heap order; ``explode`` makes the rows 0 to n - 1."""
    above = "CAST(floor((node - {0}) / CAST({1} AS DOUBLE)) AS INT)"
    rows = f"SELECT tree, {explode.format(31)} AS node FROM (SELECT {explode.format(md.NUM_TREES)} AS tree)"
    return f"SELECT CAST(tree AS INT) AS tree, CAST(node AS INT) AS node, {above.format(1, 2)} AS up, {above.format(3, 4)} AS grand FROM ({rows})"


NUMBERS_SQL = _numbers("unnest(range({0}))")


def forest_stand_in(spark) -> DataFrame:
    """Node rows of the stand-in forest, from the rule that its SQL follows."""
    numbers = _numbers("explode(sequence(0, {0} - 1))")
    nodes = spark.sql(f"WITH numbers AS ({numbers}) {FOREST_SQL}")
    return nodes.withColumnsRenamed({"left_node": "left", "right_node": "right"})


#: Recursion over node rows: every held-out row goes down every tree until it is in a leaf.
WALK_SQL = (
    "SELECT obs_id, ssm, x, tree, node FROM inputs, (SELECT DISTINCT tree, 0 AS node FROM forest)"
    " UNION ALL SELECT w.obs_id, w.ssm, w.x, w.tree, CASE WHEN w.x[f.feature + 1] <= f.threshold THEN f.left_node ELSE f.right_node END"
    " FROM walked w JOIN forest f ON f.tree = w.tree AND f.node = w.node WHERE f.left_node IS NOT NULL"
)
INPUTS_SQL = "SELECT obs_id, ssm, [" + ", ".join(f"CAST({c} AS DOUBLE)" for c in md.features_for("ssm")) + "] AS x FROM held"


@query(
    "predict_holdout",
    with_tables("scenes", train=TRAIN_SQL, chosen=CHOSEN_SQL, held=HELD_SQL, inputs=INPUTS_SQL, numbers=NUMBERS_SQL, forest=FOREST_SQL, walked=WALK_SQL).replace("WITH", "WITH RECURSIVE", 1)
    + "SELECT obs_id, round(any_value(ssm), 6) AS ssm, round(avg(value), 6) AS ssm_pred FROM walked w"
    " JOIN forest f ON f.tree = w.tree AND f.node = w.node WHERE f.left_node IS NULL GROUP BY obs_id",
)
def predict_holdout(spark, sf_dir):
    """Predictions for the rows held out, from node rows of a stand-in forest walked level by level."""
    test = forest_split(spark, sf_dir).filter("is_test").drop("is_test")
    scored = md.predict_nodes(forest_stand_in(spark), test, "ssm", ["obs_id"])
    return rounded(scored.select("obs_id", "ssm", "ssm_pred"))


@query("forest_nodes")
def forest_nodes(spark, sf_dir):
    """Every node of the forest learned from the rows not held out, read from the stored files. Bootstrapped: no SQL form."""
    return rounded(stored_nodes(spark, sf_dir)[0])


@query("forest_predictions")
def forest_predictions(spark, sf_dir):
    """What the learned forest predicts for the rows held out, by a walk over its stored nodes. Bootstrapped: no SQL form."""
    nodes, test = stored_nodes(spark, sf_dir)
    return rounded(md.predict_nodes(nodes, test, "ssm", ["obs_id"]).select("obs_id", "ssm", "ssm_pred"))


def stored_nodes(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    model, test = fitted(spark, sf_dir)
    path = scratch_path(spark, "model")
    sinks.write_model(model, path)
    delete_at_end(spark, path)
    return sinks.read_nodes(spark, path), test


@query(
    "sink_model",
    with_tables("scenes", train=TRAIN_SQL, chosen=CHOSEN_SQL, held=HELD_SQL) + "SELECT obs_id, true AS same FROM held",
)
def sink_model(spark, sf_dir):
    """Whether the stored forest predicts what the fitted one does, for every row held out."""
    model, test = fitted(spark, sf_dir)
    path = scratch_path(spark, "model")
    sinks.write_model(model, path)
    delete_at_end(spark, path)
    scored = md.predict_holdout(model, test, "ssm").withColumnRenamed("ssm_pred", "fitted")
    again = md.predict_holdout(sinks.read_model(path), scored, "ssm")
    return again.select("obs_id", (F.col("ssm_pred") == F.col("fitted")).alias("same"))


@query(
    "tree_table_export",
    f"""WITH RECURSIVE numbers AS ({NUMBERS_SQL}), forest AS ({FOREST_SQL}),
      ways AS (SELECT DISTINCT tree, 0 AS node, '' AS way FROM forest UNION ALL SELECT f.tree, s.child, way || s.mark FROM ways w JOIN forest f ON f.tree = w.tree AND f.node = w.node
        CROSS JOIN LATERAL (VALUES (f.left_node, '1'), (f.right_node, '3')) s(child, mark) WHERE f.left_node IS NOT NULL),
      lines AS (SELECT f.tree, way || '0' AS place, 'If (feature ' || feature || ' <= ' || threshold || ')' AS line FROM ways w JOIN forest f ON f.tree = w.tree AND f.node = w.node WHERE left_node IS NOT NULL
        UNION ALL SELECT f.tree, way || '2', 'Else (feature ' || feature || ' > ' || threshold || ')' FROM ways w JOIN forest f ON f.tree = w.tree AND f.node = w.node WHERE left_node IS NOT NULL
        UNION ALL SELECT f.tree, way, 'Predict: ' || value FROM ways w JOIN forest f ON f.tree = w.tree AND f.node = w.node WHERE left_node IS NULL)
      SELECT tree AS tree_id, string_agg(line, '#' ORDER BY place) AS tree FROM lines GROUP BY tree""",
)
def tree_table_export(spark, sf_dir):
    """Each tree of the stand-in forest as one line of text."""
    return forest.tree_text(forest_stand_in(spark))


@query(
    "regression_metrics",
    with_tables("holdout")
    + """, m AS (SELECT avg(abs(ssm - ssm_pred)) AS mae, avg((ssm - ssm_pred)*(ssm - ssm_pred)) AS mse,
          avg(ssm - ssm_pred) AS bias, var_pop(ssm) AS spread FROM holdout)
      SELECT round(1 - mse/spread, 6) AS r2, round(mae, 6) AS mae, round(mse, 6) AS mse, round(sqrt(mse), 6) AS rmse,
        round(bias, 6) AS bias_obs_pred, round(sqrt(greatest(mse - bias*bias, 0)), 6) AS ubrmse FROM m""",
)
def regression_metrics(spark, sf_dir):
    return rounded(md.regression_metrics(b.holdout(spark, sf_dir), "ssm"))


# -- validation ------------------------------------------------------------


@query(
    "filter_in_list",
    with_tables("scenes")
    + "SELECT obs_id, station, year, lc FROM scenes WHERE station = 'MB3' AND lc IN ('133', '136', '146')",
)
def filter_in_list(spark, sf_dir):
    scenes = b.scenes(spark, sf_dir).select("obs_id", "station", "year", "lc")
    for col, value in (("station", "MB3"), ("lc", ["133", "136", "146"]), ("year", None), ("absent", [1])):
        scenes = val.filter_in_list(scenes, col, value)
    return scenes


@query(
    "holdout_subset",
    with_tables("holdout")
    + """SELECT obs_id, station, year, doy, lc, round(ssm, 6) AS ssm, round(ssm_pred, 6) AS ssm_pred FROM holdout
      WHERE station IN ('MB4', 'MB5') AND year = 1998 ORDER BY doy, obs_id""",
)
def holdout_subset(spark, sf_dir):
    out = val.holdout_subset(b.holdout(spark, sf_dir), station=["MB4", "MB5"], year=1998, ids=["obs_id"])
    return rounded(out.select("obs_id", "station", "year", "doy", "lc", "ssm", "ssm_pred"))


def metrics_sql(o: str, p: str) -> str:
    return (
        f"count(*) AS n, round(CASE WHEN count(*) >= 2 AND stddev_pop({o}) > 0 AND stddev_pop({p}) > 0 THEN covar_pop({o}, {p})/(stddev_pop({o})*stddev_pop({p})) END, 6) AS r,"
        f" round(sqrt(avg(({p} - {o})*({p} - {o}))), 6) AS rmse,"
        f" round(sqrt(greatest(avg(({p} - {o})*({p} - {o})) - avg({p} - {o})*avg({p} - {o}), 0)), 6) AS ubrmse,"
        f" round(avg({p} - {o}), 6) AS bias_pred_obs,"
        f" round(CASE WHEN count(*) >= 2 AND var_pop({o}) > 0 THEN regr_slope({p}, {o}) END, 6) AS slope,"
        f" round(CASE WHEN count(*) >= 2 AND var_pop({o}) > 0 THEN regr_intercept({p}, {o}) END, 6) AS intercept"
    )


GAPPY_HOLDOUT = (
    "SELECT obs_id, CASE WHEN doy % 20 = 0 THEN NULL ELSE station END AS station, year, lc,"
    " CASE WHEN doy % 9 = 0 THEN NULL ELSE ssm END AS ssm, ssm_pred + angle/1000 AS ssm_pred FROM holdout"
)


def gappy_holdout(spark, sf_dir) -> DataFrame:
    return b.holdout(spark, sf_dir).select(
        "obs_id",
        F.when(F.col("doy") % 20 != 0, F.col("station")).alias("station"),
        "year",
        "lc",
        F.when(F.col("doy") % 9 != 0, F.col("ssm")).alias("ssm"),
        (F.col("ssm_pred") + F.col("angle") / 1000).alias("ssm_pred"),
    )


@query(
    "pairwise_metrics",
    with_tables("holdout", g=GAPPY_HOLDOUT) + f"SELECT {metrics_sql('ssm', 'ssm_pred')} FROM g WHERE ssm IS NOT NULL",
)
def pairwise_metrics(spark, sf_dir):
    return rounded(val.pairwise_metrics(gappy_holdout(spark, sf_dir), "ssm", "ssm_pred"))


@query(
    "grouped_metrics",
    with_tables("holdout", g=GAPPY_HOLDOUT)
    + f"SELECT station, year, {metrics_sql('ssm', 'ssm_pred')} FROM g WHERE ssm IS NOT NULL GROUP BY station, year",
)
def grouped_metrics(spark, sf_dir):
    """Station NULL is a group of its own."""
    return rounded(val.grouped_metrics(gappy_holdout(spark, sf_dir), by=["station", "year"]))


@query(
    "metrics_rollup",
    with_tables("holdout", g=GAPPY_HOLDOUT)
    + f"""SELECT station, CAST(year AS VARCHAR) AS year, lc, CASE WHEN names = '' THEN 'all' ELSE names END AS level, * EXCLUDE (station, year, lc, names) FROM (
      SELECT station, year, lc, concat_ws(',', CASE WHEN grouping(station) = 0 THEN 'station' END, CASE WHEN grouping(year) = 0 THEN 'year' END,
        CASE WHEN grouping(lc) = 0 THEN 'lc' END) AS names, {metrics_sql('ssm', 'ssm_pred').replace(', 6)', ' + 1e-8, 6)')} FROM g WHERE ssm IS NOT NULL
      GROUP BY GROUPING SETS ((station, year, lc), (station), (year), (lc), ()))""",
)
def metrics_rollup(spark, sf_dir):
    """Groups, margins and total at once; rows without a station are a group, not a total."""
    told = gappy_holdout(spark, sf_dir).filter("ssm IS NOT NULL").withColumn("year", F.col("year").cast("string"))
    return rounded(val.metrics_rollup(told), nudge=1e-8)


@query(
    "overall_metrics",
    with_tables("holdout") + f"SELECT {metrics_sql('ssm', 'ssm_pred')} FROM holdout",
)
def overall_metrics(spark, sf_dir):
    return rounded(val.overall_metrics(b.holdout(spark, sf_dir)))


#: three of four keys, by hash
SOME_KEYS = "substr(md5(concat(station, ':', lc, ':', CAST(year AS STRING), ':', CAST(doy AS STRING))), 1, 1) < 'c'"


@query(
    "backfill_target",
    with_tables(
        "holdout",
        obs=f"SELECT station, year, lc, doy, date, min(ssm) AS obs FROM scenes WHERE {SOME_KEYS} GROUP BY ALL",
    )
    + """SELECT h.obs_id, round(h.ssm_pred, 6) AS ssm_pred, round(coalesce(CASE WHEN h.doy % 3 <> 0 THEN h.ssm END, o.obs), 6) AS ssm
      FROM holdout h LEFT JOIN obs o ON h.station = o.station AND h.year = o.year AND h.lc = o.lc AND h.doy = o.doy AND h.date = o.date""",
)
def backfill_target(spark, sf_dir):
    """A third of the targets is missing; three quarters of the keys were observed and fill what they can."""
    held = b.holdout(spark, sf_dir).withColumn("ssm", F.when(F.col("doy") % 3 != 0, F.col("ssm")))
    observed = b.scenes(spark, sf_dir).filter(SOME_KEYS)
    return rounded(val.backfill_target(held, observed, "ssm").select("obs_id", "ssm_pred", "ssm"))


@query(
    "distinct_keys_priority",
    with_tables("scenes")
    + """SELECT DISTINCT 0 AS level, lc, station, CAST(year AS VARCHAR) AS year FROM scenes WHERE year IS NOT NULL AND station IS NOT NULL""",
)
def distinct_keys_priority(spark, sf_dir):
    scenes = b.scenes(spark, sf_dir).select("station", "year", "lc", "op")
    return val.distinct_keys_priority(scenes.filter("op = 0"), scenes.filter("op = 1"))


def _pairs(spark, sf_dir) -> DataFrame:
    held = b.holdout(spark, sf_dir)
    return val.match_observed_predicted(held.filter(f"op = 0 AND {OBSERVED}"), held.filter("op = 1"))


#: whole keys of one crop in one year were never observed
OBSERVED = "NOT (lc = '110' AND year = 1997)"
PAIRS_SQL = (
    f"SELECT station, year, lc, date, 'observed' AS series, ssm AS value FROM holdout WHERE op = 0 AND {OBSERVED}"
    f" UNION ALL SELECT station, year, lc, date, 'predicted', ssm_pred FROM holdout h WHERE op = 1 AND {OBSERVED} AND EXISTS ("
    "SELECT 1 FROM holdout o WHERE o.op = 0 AND o.station = h.station AND o.year = h.year AND o.lc = h.lc)"
)


@query(
    "match_observed_predicted",
    with_tables("holdout", pairs=PAIRS_SQL) + "SELECT station, year, lc, date, series, round(value, 6) AS value FROM pairs",
)
def match_observed_predicted(spark, sf_dir):
    return rounded(_pairs(spark, sf_dir))


@query(
    "date_extent",
    with_tables("holdout", pairs=PAIRS_SQL)
    + "SELECT lc, year, min(date) AS first_date, max(date) AS last_date FROM pairs GROUP BY lc, year",
)
def date_extent(spark, sf_dir):
    return val.date_extent(_pairs(spark, sf_dir))


RAIN_SQL = "SELECT station, date, CASE WHEN station = 'MB7' THEN 0 ELSE prcp END AS prcp FROM wide WHERE prcp IS NOT NULL AND day(date) % 6 <> 0"


@query(
    "daily_precip_dense",
    with_tables("readings", wide=WIDE_SQL, rain=RAIN_SQL)
    + """, daily AS (SELECT station, CAST(date AS DATE) AS day, sum(prcp) AS total FROM rain GROUP BY 1, 2),
      span AS (SELECT station, min(day) AS lo, max(day) AS hi FROM daily GROUP BY station HAVING sum(abs(total)) > 0),
      grid AS (SELECT station, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM span)
      SELECT station, day, round(coalesce(total, 0), 6) AS total FROM grid LEFT JOIN daily USING (station, day)""",
)
def daily_precip_dense(spark, sf_dir):
    """Every sixth day is missing; one station's rain is all zero and drops out."""
    rain = wide(spark, sf_dir).filter("prcp IS NOT NULL AND day(date) % 6 <> 0")
    rain = rain.withColumn("prcp", F.when(F.col("station") != "MB7", F.col("prcp")).otherwise(0.0))
    return rounded(ts_ops.daily_sum_dense(rain, "prcp"))


@query(
    "daily_precip_pooled",
    with_tables("readings", wide=WIDE_SQL, rain=RAIN_SQL)
    + """, own AS (SELECT month(date) % 3 AS panel, CASE WHEN month(date) % 3 <> 1 THEN station END AS station, CAST(date AS DATE) AS day, prcp FROM rain),
      daily AS (SELECT panel, station, day, false AS pooled, sum(prcp) AS total FROM own WHERE station IS NOT NULL GROUP BY ALL
        UNION ALL SELECT panel, NULL, day, true, sum(prcp) FROM own GROUP BY ALL),
      span AS (SELECT panel, station, pooled, min(day) AS lo, max(day) AS hi FROM daily GROUP BY ALL HAVING sum(abs(total)) > 0),
      kept AS (SELECT * FROM span s WHERE NOT pooled OR NOT EXISTS (SELECT 1 FROM span o WHERE o.panel = s.panel AND NOT o.pooled)),
      grid AS (SELECT panel, station, pooled, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM kept)
      SELECT CAST(g.panel AS INTEGER) AS panel, g.station, g.pooled, g.day, round(coalesce(d.total, 0), 6) AS total FROM grid g LEFT JOIN daily d
        ON d.panel = g.panel AND d.station IS NOT DISTINCT FROM g.station AND d.pooled = g.pooled AND d.day = g.day""",
)
def daily_precip_pooled(spark, sf_dir):
    """Three panels of months; one has no stations, so its rain is pooled, the others have a series for each."""
    rain = wide(spark, sf_dir).filter("prcp IS NOT NULL AND day(date) % 6 <> 0")
    rain = rain.withColumn("prcp", F.when(F.col("station") != "MB7", F.col("prcp")).otherwise(0.0))
    rain = rain.withColumn("panel", F.month("date") % 3)
    rain = rain.withColumn("station", F.when(F.col("panel") != 1, F.col("station")))
    return rounded(ts_ops.daily_sum_or_pooled(rain, "prcp", within=["panel"]))


@query(
    "daily_median_temperature",
    with_tables("readings", wide=WIDE_SQL)
    + "SELECT CAST(date AS DATE) AS day, round(median(sst), 6) AS median_temp FROM wide WHERE sst IS NOT NULL GROUP BY 1",
)
def daily_median_temperature(spark, sf_dir):
    return rounded(val.daily_median_temperature(wide(spark, sf_dir)))


@query(
    "freeze_spans",
    with_tables("readings", wide=WIDE_SQL)
    + """, daily AS (SELECT station, CAST(date AS DATE) AS day, median(sst) AS t FROM wide WHERE sst IS NOT NULL GROUP BY 1, 2),
      cold AS (SELECT station, day, day - CAST(row_number() OVER (PARTITION BY station ORDER BY day) AS INT) AS island
        FROM daily WHERE t <= 0)
      SELECT station, min(day) AS start, max(day) AS "end" FROM cold GROUP BY station, island""",
)
def freeze_spans(spark, sf_dir):
    return val.freeze_spans(wide(spark, sf_dir), by=["station"])


@query(
    "crop_station_year_pivot",
    with_tables("scenes")
    + "SELECT station, year, "
    + ", ".join(f"count(*) FILTER (lc = '{c}') AS \"{c}\"" for c in b.CLASSES)
    + " FROM scenes WHERE doy % 17 <> 0 GROUP BY station, year",
)
def crop_station_year_pivot(spark, sf_dir):
    """Rows with a NULL crop drop out."""
    scenes = b.scenes(spark, sf_dir).withColumn("lc", F.when(F.col("doy") % 17 != 0, F.col("lc")))
    return val.crop_station_year_pivot(scenes, b.CLASSES)


@query(
    "crop_coverage",
    with_tables("scenes")
    + """SELECT lc, count(*) AS records, count(DISTINCT station || '/' || year) AS station_year_pairs,
        count(DISTINCT station) AS unique_stations, count(DISTINCT year) AS unique_years FROM scenes GROUP BY lc""",
)
def crop_coverage(spark, sf_dir):
    return val.crop_coverage(b.scenes(spark, sf_dir))


# -- ad-hoc reports --------------------------------------------------------

FOUR = ("30", "34", "162", "110")
STATIONS = tuple(f"MB{i}" for i in range(1, 26))
STATION_COUNTS = (
    "SELECT lc, year, "
    + ", ".join(f"count(*) FILTER (station = '{s}') AS {s}" for s in STATIONS)
    + " FROM scenes WHERE lc IN ('30', '34', '162', '110') GROUP BY lc, year"
)


@query("count_lc_year_station", with_tables("scenes") + STATION_COUNTS)
def count_lc_year_station(spark, sf_dir):
    return val.count_by_station(b.scenes(spark, sf_dir), FOUR, STATIONS)


@query(
    "row_totals",
    with_tables("scenes")
    + "SELECT lc, year, count(*) AS total FROM scenes WHERE lc IN ('30', '34', '162', '110') GROUP BY lc, year",
)
def row_totals(spark, sf_dir):
    return val.row_totals(val.count_by_station(b.scenes(spark, sf_dir), FOUR, STATIONS))


@query("value_counts", with_tables("scenes") + "SELECT lc, count(*) AS n FROM scenes GROUP BY lc ORDER BY n DESC, lc")
def value_counts(spark, sf_dir):
    return val.value_counts(b.scenes(spark, sf_dir), "lc")


@query("distinct_sorted", with_tables("scenes") + "SELECT DISTINCT CAST(lc AS INT) AS lc FROM scenes ORDER BY lc")
def distinct_sorted(spark, sf_dir):
    return val.distinct_sorted(b.scenes(spark, sf_dir).select(F.col("lc").cast("int").alias("lc")), "lc")


CURVE_TABLES = dict(
    **GROWTH_TABLES,
    merged="SELECT *, coalesce((cum_gdd_air + cum_gdd_soil)/2, cum_gdd_air, cum_gdd_soil) AS cum_gdd FROM summed",
    **STAGE_TABLES,
    grown=stage_sql("merged"),
)


def grown_scenes(spark, sf_dir) -> DataFrame:
    """Degree sums, moisture sum and stage of scenes, with the columns that curves need."""
    read = gappy_scenes(spark, sf_dir).select("obs_id", "date", "year", "doy", "lc", "ssm", "sst", "mean_airt", "mean_sst")
    return growth(read, b.small(spark, "crop_base"), b.small(spark, "crop_stage"))


def flagship(spark, sf_dir) -> DataFrame:
    """Mean degree sum and stage by day of year, year and crop, from bare scenes."""
    grown = grown_scenes(spark, sf_dir)
    return rounded(val.seasonal_curve(grown, "doy", ["cum_gdd", "bbch"]))


@query(
    "seasonal_curve",
    with_tables("scenes", "crop_base", "crop_stage", **CURVE_TABLES)
    + """SELECT doy, year, lc, round(avg(cum_gdd), 6) AS mean_cum_gdd, round(avg(bbch), 6) AS mean_bbch, count(*) AS n
      FROM grown GROUP BY doy, year, lc""",
)
def seasonal_curve(spark, sf_dir):
    return flagship(spark, sf_dir)


@query(
    "moisture_by_degree_sum",
    with_tables("scenes", "crop_base", "crop_stage", **CURVE_TABLES)
    + """, sums AS (SELECT year, lc, round(cum_gdd, 6) AS cum_gdd, round(cum_ssm, 6) AS cum_ssm FROM grown WHERE cum_gdd IS NOT NULL AND cum_ssm IS NOT NULL),
      listed AS (SELECT quantile_disc(cum_gdd, [i/20.0 for i in range(1, 20)]) AS edges FROM sums)
      SELECT CAST(len(list_filter(edges, lambda e: e < cum_gdd)) AS INTEGER) AS bin, year, lc, round(avg(cum_gdd) + 1e-8, 6) AS mean_cum_gdd,
        round(avg(cum_ssm) + 1e-8, 6) AS mean_cum_ssm, count(*) AS n FROM sums, listed GROUP BY 1, 2, 3""",
)
def moisture_by_degree_sum(spark, sf_dir):
    """The moisture sum against the degree sum in twenty bins, per year and crop.

    Sums are rounded first: on days without growth they stand still, but for the last bits.
    """
    grown = grown_scenes(spark, sf_dir)
    return rounded(val.binned_curve(rounded(grown.select("year", "lc", "cum_gdd", "cum_ssm")), "cum_gdd", "cum_ssm"), nudge=1e-8)


@query(
    "daily_mean_and_sum_outer",
    with_tables("readings", wide=WIDE_SQL)
    + """, t AS (SELECT station, CAST(date AS DATE) AS day, avg(sst) AS sst_daily FROM wide WHERE sst IS NOT NULL GROUP BY 1, 2),
      p AS (SELECT station, CAST(date AS DATE) AS day, sum(prcp) AS prcp_daily FROM wide WHERE prcp IS NOT NULL GROUP BY 1, 2)
      SELECT station, day, round(sst_daily, 6) AS sst_daily, round(coalesce(prcp_daily, 0), 6) AS prcp_daily
      FROM t FULL OUTER JOIN p USING (station, day)""",
)
def daily_mean_and_sum_outer(spark, sf_dir):
    every = wide(spark, sf_dir)
    return rounded(val.daily_mean_and_sum_outer(every.filter("sst IS NOT NULL"), every.filter("prcp IS NOT NULL"), by=["station"]))


@query(
    "freeze_runs_changepoint",
    with_tables("readings", wide=WIDE_SQL)
    + """, daily AS (SELECT station, CAST(date AS DATE) AS day, avg(sst) <= 0 AS frozen FROM wide WHERE sst IS NOT NULL GROUP BY 1, 2),
      marked AS (SELECT *, CASE WHEN frozen <> lag(frozen) OVER (PARTITION BY station ORDER BY day) THEN 1 ELSE 0 END AS ch FROM daily),
      runs AS (SELECT *, sum(ch) OVER (PARTITION BY station ORDER BY day) AS run FROM marked)
      SELECT station, min(day) AS start, max(day) AS "end" FROM runs WHERE frozen GROUP BY station, run""",
)
def freeze_runs_changepoint(spark, sf_dir):
    daily = (
        wide(spark, sf_dir)
        .filter("sst IS NOT NULL")
        .groupBy("station", F.to_date("date").alias("day"))
        .agg(F.avg("sst").alias("sst_daily"))
    )
    return ts_ops.spans_between_changes(daily, F.col("sst_daily") <= 0, by=["station"])


@query(
    "head_n",
    with_tables("scenes")
    + """SELECT lc, count(*) AS records FROM scenes GROUP BY lc ORDER BY records DESC, lc LIMIT 5""",
)
def head_n(spark, sf_dir):
    report = val.crop_coverage(b.scenes(spark, sf_dir)).select("lc", "records")
    return val.head_n(report, [F.desc("records"), "lc"], 5)
