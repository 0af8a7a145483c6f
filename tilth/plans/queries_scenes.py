"""Queries over satellite scenes and image pixels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilth.functions.columns import db_to_power, power_to_db
from tilth.operators import pixels as px
from tilth.operators import scenes as ops
from tilth.plans import bindings as b
from tilth.plans.bindings import with_tables
from tilth.plans.registry import query, rounded

# -- scenes ----------------------------------------------------------------

SCENE_ID = "concat('S1A_IW_GRDH_1SDV_', strftime(date, '%Y%m%dT%H%M%S'), '_', obs_id, '_VV')"


@query(
    "parse_scene_key",
    with_tables("scenes")
    + f"""SELECT obs_id,
        concat('from', strftime(date, '%Y%m%dT%H%M%S'), '_VV', CASE op WHEN 0 THEN '_asc' ELSE '_desc' END) AS key,
        date, year, doy, 'VV' AS band, op,
        concat(split_part({SCENE_ID}, '_', 5), '_VV', CASE op WHEN 0 THEN '_asc' ELSE '_desc' END) AS id_key
      FROM scenes""",
)
def parse_scene_key(spark, sf_dir):
    scenes = b.scenes(spark, sf_dir)
    scene_id = F.concat(
        F.lit("S1A_IW_GRDH_1SDV_"), F.date_format("date", ops.KEY_TIME_FORMAT), F.lit("_"), "obs_id", F.lit("_VV")
    )
    keyed = scenes.select(
        "obs_id",
        ops.scene_key(F.col("date"), F.lit("VV"), F.col("op")).alias("key"),
        ops.key_from_scene_id(scene_id, F.col("op")).alias("id_key"),
    )
    return ops.parse_scene_key(keyed)


BANDS = ("vv", "vh", "angle", "doy", "year")
LONG_SQL = " UNION ALL ".join(
    f"SELECT obs_id, station, date, op, year, doy, '{c}' AS band, CAST({c} AS DOUBLE) AS value FROM scenes" for c in BANDS
)


def long_scenes(spark, sf_dir) -> DataFrame:
    scenes = b.scenes(spark, sf_dir).select("obs_id", "station", "date", "op", "year", "doy", "vv", "vh", "angle")
    as_bands = scenes.select(
        "obs_id", "station", "date", "op", "year", "doy", *[F.col(c).cast("double").alias(f"b_{c}") for c in BANDS]
    )
    long = as_bands.unpivot(
        ["obs_id", "station", "date", "op", "year", "doy"], [f"b_{c}" for c in BANDS], "band", "value"
    )
    return long.withColumn("band", F.substring("band", 3, 10))


@query(
    "drop_meta_bands",
    with_tables("scenes", long=LONG_SQL)
    + "SELECT obs_id, band, round(value, 6) AS value FROM long WHERE band NOT IN ('doy', 'year')",
)
def drop_meta_bands(spark, sf_dir):
    return rounded(ops.drop_meta_bands(long_scenes(spark, sf_dir)).select("obs_id", "band", "value"))


@query(
    "pivot_bands_mean",
    with_tables("scenes", long=LONG_SQL)
    + """SELECT station, date, op, year, doy, round(avg(CASE WHEN band = 'vv' THEN value END), 6) AS vv,
        round(avg(CASE WHEN band = 'vh' THEN value END), 6) AS vh,
        round(avg(CASE WHEN band = 'angle' THEN value END), 6) AS angle
      FROM long WHERE doy % 9 <> 0 GROUP BY station, date, op, year, doy""",
)
def pivot_bands_mean(spark, sf_dir):
    """Several scenes share a key and are averaged; every ninth day has a NULL key and drops out."""
    long = long_scenes(spark, sf_dir).withColumn("doy", F.when(F.col("doy") % 9 != 0, F.col("doy")))
    return rounded(ops.pivot_bands_mean(ops.drop_meta_bands(long), ["vv", "vh", "angle"]))


@query(
    "union_scenes_cast_crop",
    with_tables("scenes")
    + "SELECT obs_id, station, round(vv, 6) AS vv, lc FROM scenes",
)
def union_scenes_cast_crop(spark, sf_dir):
    """Three tables with a third of the stations each."""
    scenes = b.scenes(spark, sf_dir)
    tables = [
        scenes.filter(F.substring("station", 3, 10).cast("int") % 3 == third).select(
            "obs_id", F.col("station").alias("Station"), F.col("vv").alias("VV"), F.col("lc").cast("double").alias("landcover")
        )
        for third in range(3)
    ]
    return rounded(ops.cast_crop(tables[0].unionByName(tables[1]).unionByName(tables[2])))


@query(
    "date_range_filter",
    with_tables("scenes")
    + "SELECT obs_id, date FROM scenes WHERE date >= TIMESTAMP '1996-03-01' AND date < TIMESTAMP '1999-01-01'",
)
def date_range_filter(spark, sf_dir):
    scenes = b.scenes(spark, sf_dir).select("obs_id", "date")
    return ops.date_range_filter(scenes, "1990-01-01", "1999-01-01", mission_start="1996-03-01")


@query(
    "scene_attribute_filter",
    """SELECT o_orderkey AS scene_id, o_orderdate AS date FROM orders
      WHERE list_contains(string_split(o_orderpriority, '-'), 'HIGH') AND o_orderstatus = 'F'""",
)
def scene_attribute_filter(spark, sf_dir):
    catalogue = b.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("scene_id"),
        F.col("o_orderdate").alias("date"),
        F.col("o_orderstatus").alias("mode"),
        F.split("o_orderpriority", "-").alias("polarisations"),
    )
    kept = ops.scene_attribute_filter(catalogue, wanted_polarisation="HIGH", wanted_mode="F")
    return kept.select("scene_id", "date")


@query(
    "dedupe_by_time",
    """SELECT date, scene_id, price FROM (
        SELECT o_orderdate AS date, o_orderkey AS scene_id, round(o_totalprice, 6) AS price,
          row_number() OVER (PARTITION BY o_orderdate ORDER BY o_orderkey) AS rn FROM orders) WHERE rn = 1""",
)
def dedupe_by_time(spark, sf_dir):
    catalogue = b.table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").alias("date"), F.col("o_orderkey").alias("scene_id"), F.col("o_totalprice").alias("price")
    )
    return rounded(ops.dedupe_by_time(catalogue))


@query(
    "split_by_pass",
    with_tables("scenes")
    + "SELECT CASE op WHEN 0 THEN 'asc' ELSE 'desc' END AS pass, count(*) AS n FROM scenes GROUP BY 1",
)
def split_by_pass(spark, sf_dir):
    return ops.count_by_pass(b.scenes(spark, sf_dir))


@query(
    "truncate_to_short",
    with_tables("scenes")
    + """SELECT obs_id, CAST(trunc(vv) AS INT) AS vv, CAST(trunc(vh) AS INT) AS vh, CAST(trunc(angle) AS INT) AS angle
      FROM scenes""",
)
def truncate_to_short(spark, sf_dir):
    cols = ["vv", "vh", "angle"]
    short = ops.truncate_to_short(b.scenes(spark, sf_dir).select("obs_id", *cols), cols)
    return short.select("obs_id", *[F.col(c).cast("int") for c in cols])


# -- pixels ----------------------------------------------------------------

#: a station on every image row, so that buffers of neighbours overlap
STATION_COLUMNS = [
    "concat('ST', CAST(vec_id AS {0})) AS station",
    "CAST((vec_id * 7) % 64 * 10 + 3 AS DOUBLE) AS sx",
    "CAST(vec_id * 10 + 4 AS DOUBLE) AS sy",
]


@query(
    "buffer_range_join",
    with_tables("pixels", stations=f"SELECT {', '.join(STATION_COLUMNS).format('VARCHAR')} FROM embeddings", steps="SELECT unnest([-2, -1, 0, 1, 2]) AS step")
    + """, near AS (SELECT station, sx, sy, CAST(floor(sy / 10) AS BIGINT) + step AS "row" FROM stations CROSS JOIN steps)
      SELECT station, p."row", col, round(v, 6) AS v FROM pixels p JOIN near n ON n."row" = p."row"
        AND (col*10 - sx)*(col*10 - sx) + (p."row"*10 - sy)*(p."row"*10 - sy) <= 225""",
)
def buffer_range_join(spark, sf_dir):
    """Pixels on a 10 m grid within 15 m of the stations, one to each image row."""
    stations = b.table(spark, sf_dir, "embeddings").selectExpr(*(c.format("STRING") for c in STATION_COLUMNS))
    grid = b.pixels(spark, sf_dir).selectExpr("row", "col", "v", "CAST(col*10 AS DOUBLE) AS x", "CAST(row*10 AS DOUBLE) AS y")
    return rounded(px.buffer_range_join(grid, stations, 15.0).select("station", "row", "col", "v"))


@query(
    "edge_mask",
    with_tables("pixels", db='SELECT "row", col, 300*log10(v) AS v FROM pixels')
    + """SELECT "row", col, CASE WHEN v < -30 THEN NULL ELSE round(v, 6) END AS v FROM db""",
)
def edge_mask(spark, sf_dir):
    db = b.pixels(spark, sf_dir).select("row", "col", (F.lit(300.0) * F.log10("v")).alias("v"))
    return rounded(px.edge_mask(db))


@query(
    "db_power_convert",
    with_tables("scenes")
    + """SELECT obs_id, round(pow(10, vv/10), 6) AS vv_p, round(pow(10, vh/10), 6) AS vh_p,
        CASE WHEN angle - 33 > 0 THEN round(10*log10(CASE WHEN angle - 33 > 0 THEN angle - 33 ELSE 1 END), 6) END AS back
      FROM scenes""",
)
def db_power_convert(spark, sf_dir):
    """Both directions; values that are not positive have no dB."""
    return rounded(
        b.scenes(spark, sf_dir).select(
            "obs_id",
            db_to_power("vv").alias("vv_p"),
            db_to_power("vh").alias("vh_p"),
            power_to_db(F.col("angle") - 33).alias("back"),
        )
    )


DATED_SQL = "SELECT *, TIMESTAMP '2020-01-15' + label * INTERVAL 200 DAY AS date FROM pixels"
MAPS_SQL = (
    'SELECT TIMESTAMP \'2020-06-01\' + (label % 4) * INTERVAL 200 DAY AS map_date, "row", col,'
    ' CAST(("row" + col) % 14 AS VARCHAR) AS lc FROM pixels'
    ' UNION ALL SELECT TIMESTAMP \'2020-03-01\' + (label % 4) * INTERVAL 200 DAY, "row", col,'
    ' CAST(("row" * 3 + col) % 14 AS VARCHAR) FROM pixels WHERE col % 2 = 0'
)


@query(
    "attach_date_and_crop",
    with_tables("pixels", dated=DATED_SQL, maps=MAPS_SQL)
    + """, first AS (SELECT * FROM (SELECT CAST(year(map_date) AS INT) AS year, "row", col, lc,
          row_number() OVER (PARTITION BY year(map_date), "row", col ORDER BY map_date) AS rn FROM maps) WHERE rn = 1)
      SELECT d."row", d.col, CAST(year(d.date) AS INT) AS year, CAST(dayofyear(d.date) AS INT) AS doy, f.lc
      FROM dated d LEFT JOIN first f ON f.year = year(d.date) AND f."row" = d."row" AND f.col = d.col""",
)
def attach_date_and_crop(spark, sf_dir):
    image = b.pixels(spark, sf_dir)
    dated = image.withColumn("date", F.expr("TIMESTAMP_NTZ '2020-01-15' + make_interval(0, 0, 0, label * 200)"))
    later = "make_interval(0, 0, 0, (label % 4) * 200)"
    maps = image.selectExpr(
        f"TIMESTAMP_NTZ '2020-06-01' + {later} AS map_date", "row", "col", "CAST((row + col) % 14 AS STRING) AS lc"
    ).unionByName(
        image.filter("col % 2 = 0").selectExpr(
            f"TIMESTAMP_NTZ '2020-03-01' + {later} AS map_date", "row", "col", "CAST((row * 3 + col) % 14 AS STRING) AS lc"
        )
    )
    return px.attach_date_and_crop(dated, maps).select("row", "col", "year", "doy", "lc")


#: one pixel in eleven is masked
MASKED_SQL = 'SELECT "row", col, CASE WHEN ("row" * 7 + col) % 11 <> 0 THEN v END AS v FROM pixels'
BOX_SQL = "SELECT dr, dc FROM (SELECT unnest([-1, 0, 1]) AS dr) CROSS JOIN (SELECT unnest([-1, 0, 1]) AS dc)"
FOCAL_SQL = (
    'SELECT c."row", c.col, any_value(c.v) AS v, avg(n.v) AS mean, var_pop(n.v) AS var FROM img c CROSS JOIN box'
    ' LEFT JOIN img n ON n."row" = c."row" + dr AND n.col = c.col + dc WHERE c.v IS NOT NULL GROUP BY c."row", c.col'
)


def masked_pixels(spark, sf_dir) -> DataFrame:
    return b.pixels(spark, sf_dir).select(
        "row", "col", F.when((F.col("row") * 7 + F.col("col")) % 11 != 0, F.col("v")).alias("v")
    )


@query(
    "focal_mean_var_3x3",
    with_tables("pixels", img=MASKED_SQL, box=BOX_SQL, focal=FOCAL_SQL)
    + 'SELECT "row", col, round(v, 6) AS v, round(mean, 6) AS mean, round(var, 6) AS var FROM focal',
)
def focal_mean_var_3x3(spark, sf_dir):
    return rounded(px.focal_mean_var_3x3(masked_pixels(spark, sf_dir), scene=[]))


# The eight half windows by their defining inequalities on (dr, dc).
HALF_WINDOWS = ("dr >= 0", "dc <= dr", "dc <= 0", "dr <= -dc", "dr <= 0", "dc >= dr", "dc >= 0", "dr >= -dc")


def _lee_sql() -> str:
    ring = {k: (2 * (k // 3 - 1), 2 * (k % 3 - 1)) for k in range(9)}
    samples = ", ".join(
        f"max(CASE WHEN dr = {r} AND dc = {c} THEN n.mean END) AS m{k}, max(CASE WHEN dr = {r} AND dc = {c} THEN n.var END) AS s{k}"
        for k, (r, c) in ring.items()
    )
    halves = ", ".join(
        f"avg(CASE WHEN {cond} THEN n.v END) AS wm{k}, var_pop(CASE WHEN {cond} THEN n.v END) AS wv{k}"
        for k, cond in enumerate(HALF_WINDOWS)
    )
    pairs = [(1, 7), (6, 2), (3, 5), (0, 8)]
    grads = ", ".join(f"abs(m{a} - m{b_}) AS g{i}" for i, (a, b_) in enumerate(pairs))
    direction = " + ".join(
        f"CASE WHEN g{i} = greatest(g0, g1, g2, g3) THEN CASE WHEN m{a} - m4 > m4 - m{b_} THEN {i + 1} ELSE {i + 5} END ELSE 0 END"
        for i, (a, b_) in enumerate(pairs)
    )
    complete = " AND ".join(f"s{k} IS NOT NULL" for k in range(9))
    ratios = ", ".join(f"s{k}/(m{k}*m{k})" for k in range(9))
    pick = lambda p: "CASE direction " + " ".join(f"WHEN {k + 1} THEN {p}{k}" for k in range(8)) + " END"
    return (
        with_tables("pixels", img='SELECT "row", col, v FROM pixels', box=BOX_SQL, focal=FOCAL_SQL)
        + f""", side AS (SELECT unnest([-3, -2, -1, 0, 1, 2, 3]) AS o),
      offsets AS (SELECT a.o AS dr, b.o AS dc FROM side a CROSS JOIN side b),
      stats AS (SELECT c."row", c.col, any_value(c.v) AS z, {samples}, {halves}
        FROM focal c CROSS JOIN offsets LEFT JOIN focal n ON n."row" = c."row" + dr AND n.col = c.col + dc
        GROUP BY c."row", c.col),
      g AS (SELECT *, {grads}, CASE WHEN {complete} THEN list_sum(list_sort([{ratios}])[1:5])/5 END AS noise FROM stats),
      d AS (SELECT *, {direction} AS direction FROM g),
      w AS (SELECT *, {pick('wm')} AS wm, {pick('wv')} AS wv FROM d)
      SELECT "row", col, round(wm + (wv - wm*wm*noise)/(noise + 1)/wv*(z - wm), 6) AS v FROM w"""
    )


@query("refined_lee", _lee_sql())
def refined_lee(spark, sf_dir):
    return rounded(px.refined_lee(b.pixels(spark, sf_dir), scene=[]))


@query(
    "zonal_median",
    with_tables("pixels") + "SELECT label, col % 3 AS band, round(median(v), 6) AS median FROM pixels GROUP BY 1, 2",
)
def zonal_median(spark, sf_dir):
    """Median per label and band; a label spans a tenth of all pixels."""
    banded = b.pixels(spark, sf_dir).withColumn("band", F.col("col") % 3)
    return rounded(px.zonal_median(banded, ["label", "band"]))
