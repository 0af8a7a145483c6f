"""Queries over station readings and their files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilth.operators import readings as ops
from tilth.operators import timeseries as ts_ops
from tilth.plans import bindings as b
from tilth.plans.bindings import with_tables
from tilth.plans.registry import query, rounded
from tilth.schemas import READINGS_LONG, SCENES
from tilth.session import delete_at_end, scratch_path
from tilth.sources import sinks, tables
from tilth.sources.csv_lines import StationFiles, read_scene_csv, read_station_csv, reject_counts

MEASURE_NAMES = {"SSM": "ssm", "SST": "sst", "AIRT": "airt", "PRCP": "prcp"}

#: one row per (station, date): the shape of a logger file
WIDE_SQL = (
    "SELECT station, date,"
    " avg(CASE WHEN sensor = 'Soil water content' THEN value END) AS ssm,"
    " avg(CASE WHEN sensor = 'Soil temperature' THEN value END) AS sst,"
    " avg(CASE WHEN sensor = 'Air temperature' THEN value END) AS airt,"
    " avg(CASE WHEN sensor = 'Precipitation totals' THEN value END) AS prcp"
    " FROM readings GROUP BY station, date"
)


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = ops.categorize_sensor(b.readings(spark, sf_dir))
    return cells.groupBy("station", "date").agg(
        *[F.avg(F.when(F.col("category") == code, F.col("value"))).alias(name) for code, name in MEASURE_NAMES.items()]
    )


def write_raw_lines(files: DataFrame, path: str) -> None:
    """Write ``(file, ord, line)`` as one unquoted CSV file per ``file``.

    Test data for the file readers; each ``file`` is kept small by the caller.
    """
    (
        files.repartition("file")
        .sortWithinPartitions("file", "ord")
        .select("file", "line")
        .write.partitionBy("file")
        .option("sep", "\u0001")
        .option("quote", "\u0000")
        .csv(path)
    )


# -- sources, sinks, catalogue --------------------------------------------

LOGGER_HEAD = [
    "Bulk export,station data",
    "generated,2024-02-01 00:00:00",
    ",Air Temp.Air temperature,Soil.Soil water content 0 to 5 cm,Soil.Soil temperature 5 cm depth,Rain.Precipitation totals,Logger.Battery",
    '"Timestamp (UTC)",Value (Ã‚Â°C),"Value (m3/m3, raw)",Value (Â°C),Value (mm),Value (V)',
]


@query(
    "src_station_csv",
    with_tables("readings")
    + """SELECT station, date AS ts, CASE sensor WHEN 'Air temperature' THEN 'Air temperature (°C)'
        WHEN 'Soil water content' THEN 'Soil water content 0 to 5 cm (m3/m3, raw)'
        WHEN 'Soil temperature' THEN 'Soil temperature 5 cm depth (°C)'
        WHEN 'Battery' THEN 'Battery (V)' ELSE 'Precipitation totals (mm)' END AS "column", round(value, 6) AS value
      FROM readings""",
)
def src_station_csv(spark, sf_dir):
    """Logger files written from the readings, one for each station and month, read back as cells."""
    events = b.readings(spark, sf_dir).withColumn(
        "file", F.concat(F.lit("LOGGER_"), "station", F.lit("_"), F.date_format("date", "yyyyMM"))
    )
    order = ["Air temperature", "Soil water content", "Soil temperature", "Precipitation totals", "Battery"]
    cell = [F.when(F.col("sensor") == s, F.col("value").cast("string")).otherwise("") for s in order]
    data = events.select(
        "file", (F.col("event_id") + 10).alias("ord"), F.concat_ws(",", F.col("date").cast("string"), *cell).alias("line")
    )
    head = events.select("file").distinct().select("file", F.posexplode(F.array(*map(F.lit, LOGGER_HEAD))).alias("ord", "line"))
    path = scratch_path(spark, "loggers")
    write_raw_lines(data.unionByName(head), path)
    cells = ops.coerce_numeric(read_station_csv(spark, path).withColumnRenamed("raw", "value"), ["value"])
    return rounded(cells.filter("value is not null").select("station", "ts", "column", "value"))


@query(
    "src_station_rejects",
    with_tables("readings")
    + """SELECT station, CASE WHEN event_id % 11 = 5 THEN CASE WHEN event_id % 2 = 0 THEN 'no time' ELSE 'time in no known format' END ELSE 'read' END AS reason,
        count(*) AS n FROM readings GROUP BY 1, 2""",
)
def src_station_rejects(spark, sf_dir):
    """Logger files, one for each station, with times in three formats and some that are none: lines read and lines rejected, by reason."""
    formats = ["yyyy-MM-dd HH:mm:ss", "M/d/yyyy H:mm:ss", "dd-MMM-yyyy HH:mm"]
    told = F.element_at(F.array(*(F.date_format("date", f) for f in formats)), (F.col("event_id") % 3 + 1).cast("int"))
    time = F.when(F.col("event_id") % 11 != 5, told).otherwise(F.when(F.col("event_id") % 2 == 0, "").otherwise("n/a"))
    events = b.readings(spark, sf_dir).withColumn("file", F.concat(F.lit("LOGGER_"), "station"))
    line = F.concat_ws(",", time, F.col("event_id").cast("string"))
    head = events.select("file").distinct().select("file", F.posexplode(F.array(F.lit("Time,Air temperature"), F.lit("Timestamp (UTC),"))).alias("ord", "line"))
    path = scratch_path(spark, "loggers")
    write_raw_lines(events.select("file", (F.col("event_id") + 10).alias("ord"), line.alias("line")).unionByName(head), path)
    loggers = StationFiles(spark, path)
    counted = reject_counts(loggers.rejects()).unionByName(loggers.cells().groupBy("file").agg(F.count("*").alias("n")).withColumn("reason", F.lit("read")))
    return counted.groupBy(ops.station_of_file(F.col("file")).alias("station"), "reason").agg(F.sum("n").alias("n"))


FILE_NAME = (
    "CASE CAST(event_id % 3 AS INT) WHEN 0 THEN concat('LOGGER_', station, '_2015_to_2024.csv')"
    " WHEN 1 THEN concat('S1_Backscatter_LOGGER_', station, '_2015_to_2024_buffer15m.csv')"
    " ELSE concat('LOGGER_', station, '.txt') END"
)


@query(
    "src_station_name",
    with_tables("readings", named=f"SELECT event_id, {FILE_NAME} AS file_name FROM readings")
    + """SELECT event_id, file_name,
        regexp_extract(file_name, '[^A-Za-z0-9]([A-Z][A-Z][0-9]+)[^A-Za-z0-9]', 1) AS station
      FROM named WHERE file_name LIKE '%.csv'""",
)
def src_station_name(spark, sf_dir):
    named = b.readings(spark, sf_dir).selectExpr("event_id", f"{FILE_NAME} AS file_name")
    return named.filter(F.col("file_name").endswith(".csv")).withColumn(
        "station", ops.station_from_name(F.col("file_name"))
    )


SCENE_DAY = "SELECT station, date, op, avg(vv) AS vv, avg(vh) AS vh, avg(angle) AS angle FROM scenes GROUP BY station, date, op"


@query(
    "src_scene_csv",
    with_tables("scenes", per_day=SCENE_DAY)
    + """, long AS (
        SELECT station, date, op, 'VV' AS band, vv AS value FROM per_day
        UNION ALL SELECT station, date, op, 'VH', vh FROM per_day
        UNION ALL SELECT station, date, op, 'angle', angle FROM per_day
        UNION ALL SELECT station, date, op, 'year', CAST(year(date) AS DOUBLE) FROM per_day
        UNION ALL SELECT station, date, op, 'doy', CAST(dayofyear(date) AS DOUBLE) FROM per_day)
      SELECT station,
        'from' || strftime(date, '%Y%m%dT%H%M%S') || '_' || band || CASE op WHEN 0 THEN '_asc' ELSE '_desc' END AS key,
        date, CAST(year(date) AS INT) AS year, CAST(dayofyear(date) AS INT) AS doy, band, op, round(value, 6) AS value
      FROM long""",
)
def src_scene_csv(spark, sf_dir):
    """Wide scene files (one per station and year) written from the scenes, read back as cells."""
    from tilth.operators.scenes import scene_key

    per_day = b.scenes(spark, sf_dir).groupBy("station", "date", "op").agg(
        F.avg("vv").alias("VV"),
        F.avg("vh").alias("VH"),
        F.avg("angle").alias("angle"),
        F.year(F.first("date")).cast("double").alias("year"),
        F.dayofyear(F.first("date")).cast("double").alias("doy"),
    )
    long = per_day.unpivot(["station", "date", "op"], ["VV", "VH", "angle", "year", "doy"], "band", "value").select(
        F.concat(F.lit("S1_Backscatter_LOGGER_"), "station", F.lit("_"), F.year("date").cast("string")).alias("file"),
        scene_key(F.col("date"), F.col("band"), F.col("op")).alias("key"),
        F.col("value").cast("string").alias("text"),
    )
    # one file's columns: the days of one year, two passes and five bands
    wide_files = long.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("key", "text"))).alias("cols"))
    row = lambda first, field, last: F.concat_ws(
        ",", F.lit(first), F.concat_ws(",", F.col(f"cols.{field}")), F.lit(last)
    )
    geo = '"{""type"":""Point"",""coordinates"":[0,0]}"'
    lines = wide_files.select(
        "file",
        F.posexplode(
            F.array(row("system:index", "key", ".geo"), row("0", "text", geo), row("1", "text", geo))
        ).alias("ord", "line"),
    )
    path = scratch_path(spark, "scenes")
    write_raw_lines(lines, path)
    return rounded(read_scene_csv(spark, path).select("station", "key", "date", "year", "doy", "band", "op", "value"))


CATALOGUE = (
    "SELECT DISTINCT station, sensor AS param_name,"
    " CASE CAST(event_id % 2 AS INT) WHEN 0 THEN 'average' ELSE 'single' END AS sensor,"
    " CASE CAST(event_id % 3 AS INT) WHEN 0 THEN '0 to 5 cm' WHEN 1 THEN '5 cm' ELSE '20 cm' END AS depth FROM readings"
)


@query(
    "src_param_catalogue",
    with_tables("readings", catalogue=CATALOGUE)
    + """SELECT station, param_name, sensor, depth FROM catalogue
      WHERE param_name IN ('Air temperature', 'Soil temperature', 'Soil water content') AND sensor = 'average'
        AND depth IN ('0 to 5 cm', '5 cm')
        AND station IN (SELECT concat('MB', CAST(n_nationkey + 1 AS VARCHAR)) FROM nation WHERE n_regionkey < 2)""",
)
def src_param_catalogue(spark, sf_dir):
    catalogue = (
        b.readings(spark, sf_dir)
        .selectExpr(
            "station",
            "sensor AS param_name",
            "CASE CAST(event_id % 2 AS INT) WHEN 0 THEN 'average' ELSE 'single' END AS sensor",
            "CASE CAST(event_id % 3 AS INT) WHEN 0 THEN '0 to 5 cm' WHEN 1 THEN '5 cm' ELSE '20 cm' END AS depth",
        )
        .distinct()
    )
    wanted = b.table(spark, sf_dir, "nation").filter("n_regionkey < 2").selectExpr(
        "concat('MB', CAST(n_nationkey + 1 AS STRING)) AS station"
    )
    picked = tables.select_datasets(
        catalogue,
        wanted,
        ["Air temperature", "Soil temperature", "Soil water content"],
        "average",
        ["0 to 5 cm", "5 cm"],
    )
    return picked.select("station", "param_name", "sensor", "depth")


@query(
    "sink_partitioned_incremental",
    with_tables("readings") + "SELECT station, event_id, sensor, round(value, 6) AS value FROM readings",
)
def sink_partitioned_incremental(spark, sf_dir):
    """Every second station is written first; the second call may add only the others."""
    every = b.readings(spark, sf_dir).select("station", "event_id", "sensor", "value")
    even = F.substring("station", 3, 10).cast("int") % 2 == 0
    path = scratch_path(spark, "stations")
    sinks.write_new_stations(every.filter(even), path)
    sinks.write_new_stations(every, path)
    return rounded(spark.read.parquet(path).select(F.col("station").cast("string"), "event_id", "sensor", "value"))


def json_files(df, number, key, value, spark) -> str:
    """A folder of JSON files, each one object of up to 500 keys with their values."""
    entries = F.map_from_entries(F.collect_list(F.struct(key, value)))
    files = df.groupBy(F.floor(number / 500).alias("file")).agg(F.to_json(entries).alias("value"))
    path = scratch_path(spark, "json")
    files.write.partitionBy("file").text(path)
    delete_at_end(spark, path)
    return path


@query(
    "src_texture_json",
    """SELECT concat('MB', CAST(c_custkey AS VARCHAR)) AS station, 5 AS depth_cm, round(1 + c_nationkey/CAST(100 AS DOUBLE), 6) AS bulk,
        round((20 + c_nationkey)/CAST(100 AS DOUBLE), 6) AS sand, round((50 - c_nationkey)/CAST(100 AS DOUBLE), 6) AS silt,
        round(30/CAST(100 AS DOUBLE), 6) AS clay, c_mktsegment AS classification FROM customer""",
)
def src_texture_json(spark, sf_dir):
    """JSON files of stations with two depths, one station per customer, read back."""

    def layer(depth: int):
        n = F.col("c_nationkey").cast("double")
        return F.struct(
            F.lit(depth).alias("depth_cm"),
            (1 + n / 100).alias("density_gcm3"),
            (20 + n).alias("sand_pct"),
            (50 - n).alias("silt_pct"),
            F.lit(30.0).alias("clay_pct"),
            F.col("c_mktsegment").alias("classification"),
        )

    station = F.concat(F.lit("MB"), F.col("c_custkey").cast("string"))
    customer = b.table(spark, sf_dir, "customer")
    path = json_files(customer, F.col("c_custkey"), station, F.array(layer(5), layer(20)), spark)
    return rounded(tables.read_texture_json(spark, path, 5))


def bound_triplets():
    triplet = F.array(F.col("p_size") / 100.0, F.lit(0.25), F.col("p_retailprice") / 5000.0)
    return F.struct(*[triplet.alias(f"{p}bound") for p in ("c", "s", "l", "w")])


@query(
    "src_crop_tables",
    """WITH points AS (SELECT CAST(p_partkey AS VARCHAR) AS lc, p_size, p_retailprice, unnest([0, 1, 2]) AS seq FROM part)
      SELECT lc, seq, round(CAST(p_size + 10*seq AS DOUBLE), 6) AS gdd, round(p_retailprice/100 + seq, 6) AS stage,
        round(CAST(p_size AS DOUBLE)/2, 6) AS base, round(CAST(p_size - seq AS DOUBLE), 6) AS k, round(CAST(seq AS DOUBLE)/4, 6) AS b
      FROM points""",
)
def src_crop_tables(spark, sf_dir):
    """JSON files of base, stage, height and bound tables, a crop per part, read back and joined."""
    part = b.table(spark, sf_dir, "part")
    lc, size = F.col("p_partkey").cast("string"), F.col("p_size").cast("double")
    points = F.array(*[F.array(size + 10.0 * i, F.col("p_retailprice") / 100 + float(i)) for i in range(3)])
    heights = F.array(
        *[F.array(F.col("p_retailprice") / 100 + float(i), size - float(i), F.lit(i / 4)) for i in range(3)]
    )
    values = (size / 2, points, F.struct(heights.alias("bbch_k_b")), bound_triplets())
    crops = tables.read_crop_tables(spark, *[json_files(part, F.col("p_partkey"), lc, v, spark) for v in values])
    heights_rows = crops["heights"].select("lc", "seq", "k", "b")
    joined = crops["stages"].join(crops["base"], "lc").join(heights_rows, ["lc", "seq"])
    return rounded(joined.select("lc", "seq", "gdd", "stage", "base", "k", "b"))


@query(
    "src_bounds_json",
    """WITH raw AS (SELECT CAST(p_partkey AS VARCHAR) AS lc, unnest(['c','s','l','w']) AS param,
          CAST(p_size AS DOUBLE)/100 AS a, CAST(25 AS DOUBLE)/100 AS seed0, p_retailprice/5000 AS z FROM part)
      SELECT lc, param, round(least(a, z), 6) AS lo, round(greatest(least(a, z), least(seed0, greatest(a, z))), 6) AS seed,
        round(CASE WHEN a = z THEN a + 0.000001 ELSE greatest(a, z) END, 6) AS hi FROM raw""",
)
def src_bounds_json(spark, sf_dir):
    """JSON files of bounds, a crop per part; many triplets are reversed or have the seed outside."""
    part = b.table(spark, sf_dir, "part")
    path = json_files(part, F.col("p_partkey"), F.col("p_partkey").cast("string"), bound_triplets(), spark)
    return rounded(tables.read_bounds_json(spark, path))


@query(
    "sink_stage_tables",
    with_tables("scenes")
    + """SELECT date, op, year, doy, station, round(angle, 6) AS angle, round(vv, 6) AS vv, round(vh, 6) AS vh, lc
      FROM scenes""",
)
def sink_stage_tables(spark, sf_dir):
    path = scratch_path(spark, "stage")
    sinks.write_stage(b.scenes(spark, sf_dir), path, SCENES)
    return rounded(sinks.read_stage(spark, path, SCENES))


# -- readings --------------------------------------------------------------

NAME_TOKEN = (
    "CASE sensor WHEN 'Air temperature' THEN 'Air Temp.Air temperature'"
    " WHEN 'Soil temperature' THEN 'Soil.Soil temperature.avg' ELSE sensor END"
)
UNIT_TOKEN = "CASE CAST(event_id % 4 AS INT) WHEN 0 THEN 'Value (Ã‚Â°C)' WHEN 1 THEN 'Value (Â°C)' WHEN 2 THEN ' Value' ELSE '' END"


@query(
    "normalize_column_names",
    with_tables("readings", tokens=f"SELECT event_id, {NAME_TOKEN} AS name, {UNIT_TOKEN} AS unit FROM readings")
    + """, cleaned AS (SELECT event_id, regexp_replace(name, '^[^.]*\\.', '') AS name,
          replace(replace(unit, 'Ã‚', ''), 'Â°', '°') AS unit FROM tokens)
      SELECT event_id, trim(CASE WHEN contains(unit, 'Value') THEN replace(unit, 'Value', name) ELSE name END) AS label
      FROM cleaned""",
)
def normalize_column_names(spark, sf_dir):
    tokens = b.readings(spark, sf_dir).selectExpr("event_id", f"{NAME_TOKEN} AS name", f"{UNIT_TOKEN} AS unit")
    return tokens.select("event_id", ops.column_label(F.col("name"), F.col("unit")).alias("label"))


@query(
    "parse_timestamp_dropna",
    with_tables("readings") + "SELECT event_id, date AS ts FROM readings WHERE event_id % 7 <> 0",
)
def parse_timestamp_dropna(spark, sf_dir):
    raw = b.readings(spark, sf_dir).selectExpr(
        "event_id", "CASE WHEN event_id % 7 = 0 THEN 'no time' ELSE CAST(date AS STRING) END AS raw"
    )
    return ops.parse_timestamp_dropna(raw, "raw").select("event_id", "ts")


@query(
    "coerce_numeric",
    with_tables("readings")
    + "SELECT event_id, CASE WHEN event_id % 5 > 2 THEN NULL ELSE round(value, 6) END AS value FROM readings",
)
def coerce_numeric(spark, sf_dir):
    raw = b.readings(spark, sf_dir).selectExpr(
        "event_id",
        "CASE CAST(event_id % 5 AS INT) WHEN 3 THEN 'n/a' WHEN 4 THEN 'NaN' ELSE CAST(value AS STRING) END AS value",
    )
    return rounded(ops.coerce_numeric(raw, ["value"]))


LOGGER_COLUMN = (
    "CASE sensor WHEN 'Air temperature' THEN 'Air Temp (°C)' WHEN 'Precipitation totals' THEN 'PRECIPITATION totals (mm)'"
    " WHEN 'Soil water content' THEN concat('Soil water content ', CASE CAST(event_id % 3 AS INT) WHEN 0 THEN '0 to 5 cm'"
    " WHEN 1 THEN '5 cm depth' ELSE '20 cm depth' END)"
    " WHEN 'Soil temperature' THEN concat('soil temperature ', CASE CAST(event_id % 2 AS INT) WHEN 0 THEN '0 To 5 cm'"
    " ELSE '100 cm' END) ELSE sensor END"
)


@query(
    "classify_columns",
    with_tables("readings", cols=f'SELECT station, event_id AS col_pos, {LOGGER_COLUMN} AS "column" FROM readings')
    + """, labelled AS (SELECT *, CASE WHEN regexp_matches("column", '(?i)^air\\s*temp') THEN 'AIRT'
          WHEN regexp_matches("column", '(?i)^(precipitation\\s*totals|precip\\s*total)') THEN 'PRCP'
          WHEN regexp_matches("column", '(?i)^soil water content')
            AND regexp_matches("column", '(?i)(0\\s*to\\s*5\\s*cm|\\b5\\s*cm\\s*depth)') THEN 'SSM'
          WHEN regexp_matches("column", '(?i)^soil temperature')
            AND regexp_matches("column", '(?i)(0\\s*to\\s*5\\s*cm|\\b5\\s*cm\\s*depth)') THEN 'SST' END AS category FROM cols),
      ranked AS (SELECT *, min(col_pos) OVER (PARTITION BY station, category) AS first_pos FROM labelled WHERE category IS NOT NULL)
      SELECT station, col_pos, "column", category FROM ranked
      WHERE category IN ('SSM', 'SST') OR col_pos = first_pos""",
)
def classify_columns(spark, sf_dir):
    cols = b.readings(spark, sf_dir).selectExpr("station", "event_id AS col_pos", f"{LOGGER_COLUMN} AS `column`")
    return ops.classify_columns(cols)


@query(
    "row_mean_ignore_null",
    with_tables("readings")
    + """SELECT station, date_trunc('hour', date) AS ts, sensor,
        round(avg(CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END), 6) AS value
      FROM readings GROUP BY 1, 2, 3""",
)
def row_mean_ignore_null(spark, sf_dir):
    gappy = b.readings(spark, sf_dir).selectExpr(
        "station",
        "date_trunc('hour', date) AS ts",
        "sensor",
        "CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS value",
    )
    out = ops.row_mean_ignore_null(gappy, ["station", "ts", "sensor"])
    return rounded(out.withColumn("ts", F.col("ts").cast("timestamp_ntz")))


MIDRANGE_SQL = (
    "SELECT station, CAST(date AS DATE) AS day, (min(airt) + max(airt))/2 AS mean_airt, (min(sst) + max(sst))/2 AS mean_sst"
    " FROM wide GROUP BY 1, 2"
)
#: days of one station are missing on purpose, so that the calendar has gaps
GAPPY_SQL = "SELECT * FROM daily WHERE (day(day) + CAST(substr(station, 3) AS INT)) % 4 <> 0"
GRID_SQL = (
    "SELECT station, CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM gappy GROUP BY station"
)
DENSE_SQL = "SELECT station, day, mean_airt, mean_sst FROM grid LEFT JOIN gappy USING (station, day)"


def midrange(spark, sf_dir) -> DataFrame:
    return ts_ops.daily_midrange(wide(spark, sf_dir), {"mean_airt": "airt", "mean_sst": "sst"})


def gappy_days(spark, sf_dir) -> DataFrame:
    return midrange(spark, sf_dir).filter(
        (F.dayofmonth("day") + F.substring("station", 3, 10).cast("int")) % 4 != 0
    )


@query(
    "daily_midrange",
    with_tables("readings", wide=WIDE_SQL, daily=MIDRANGE_SQL)
    + "SELECT station, day, round(mean_airt, 6) AS mean_airt, round(mean_sst, 6) AS mean_sst FROM daily",
)
def daily_midrange(spark, sf_dir):
    return rounded(midrange(spark, sf_dir))


DAILY_TABLES = dict(wide=WIDE_SQL, daily=MIDRANGE_SQL, gappy=GAPPY_SQL, grid=GRID_SQL, dense=DENSE_SQL)


@query(
    "calendar_densify",
    with_tables("readings", **DAILY_TABLES)
    + "SELECT station, day, round(mean_airt, 6) AS mean_airt, round(mean_sst, 6) AS mean_sst FROM dense",
)
def calendar_densify(spark, sf_dir):
    return rounded(ts_ops.calendar_densify(gappy_days(spark, sf_dir)))


def _filled(c: str) -> str:
    past = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    return (
        f"round(coalesce(last_value({c} IGNORE NULLS) OVER (PARTITION BY station ORDER BY date {past}),"
        f" first_value({c} IGNORE NULLS) OVER (PARTITION BY station ORDER BY date"
        f" ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), 6) AS {c}"
    )


@query(
    "fill_forward_backward",
    with_tables("readings", wide=WIDE_SQL)
    + f"SELECT station, date, {', '.join(_filled(c) for c in MEASURE_NAMES.values())} FROM wide",
)
def fill_forward_backward(spark, sf_dir):
    return rounded(ts_ops.fill_forward_backward(wide(spark, sf_dir), list(MEASURE_NAMES.values())))


@query(
    "melt_wide_to_long",
    with_tables("readings", wide=WIDE_SQL)
    + " UNION ALL ".join(
        f"SELECT station, date, '{words}' AS sensor, round({c}, 6) AS value, '0 to 5 cm' AS depth FROM wide"
        for words, c in (
            ("Soil water content", "ssm"),
            ("Soil temperature", "sst"),
            ("Air temperature", "airt"),
            ("Precipitation totals", "prcp"),
        )
    ),
)
def melt_wide_to_long(spark, sf_dir):
    return rounded(ops.melt_wide_to_long(wide(spark, sf_dir)))


@query(
    "attach_daily_stats",
    with_tables("readings", wide=WIDE_SQL, daily=MIDRANGE_SQL)
    + """SELECT r.event_id, r.station, r.date, r.sensor, round(r.value, 6) AS value, round(d.mean_airt, 6) AS mean_airt,
        round(d.mean_sst, 6) AS mean_sst
      FROM readings r LEFT JOIN daily d ON r.station = d.station AND CAST(r.date AS DATE) = d.day""",
)
def attach_daily_stats(spark, sf_dir):
    long = b.readings(spark, sf_dir).select("event_id", "station", "date", "sensor", "value")
    return rounded(ts_ops.attach_daily_stats(long, midrange(spark, sf_dir)))


@query(
    "union_stations",
    with_tables("readings")
    + """SELECT date, sensor, round(value, 6) AS value, station, CASE WHEN sensor = 'Battery' THEN NULL ELSE depth END AS depth,
        CAST(NULL AS DOUBLE) AS mean_airt, CASE WHEN sensor = 'Soil temperature' THEN round(value/2, 6) END AS mean_sst
      FROM readings""",
)
def union_stations(spark, sf_dir):
    long = b.readings(spark, sf_dir)
    parts = [
        long.filter("sensor = 'Battery'").select("date", "sensor", "value", "station"),
        long.filter("sensor = 'Soil temperature'").withColumn("mean_sst", F.col("value") / 2),
        long.filter("sensor NOT IN ('Battery', 'Soil temperature')"),
    ]
    return rounded(ops.union_stations(spark, parts, READINGS_LONG))


DEPTH = "CASE CAST(event_id % 4 AS INT) WHEN 0 THEN '0 to 5 cm' WHEN 1 THEN '20 cm' WHEN 2 THEN '100cm depth' ELSE 'surface' END"


@query(
    "filter_depth",
    with_tables("readings", deep=f"SELECT event_id, station, {DEPTH} AS depth FROM readings")
    + "SELECT * FROM deep WHERE depth = '0 to 5 cm'",
)
def filter_depth(spark, sf_dir):
    return ops.filter_depth(b.readings(spark, sf_dir).selectExpr("event_id", "station", f"{DEPTH} AS depth"))


def _interpolated(source: str, c: str, ts: str) -> str:
    return f"""placed AS (SELECT station, {ts}, {c} AS x, row_number() OVER (PARTITION BY station ORDER BY {ts}) AS i FROM {source}),
      near AS (SELECT *, last_value(CASE WHEN x IS NOT NULL THEN i END IGNORE NULLS) OVER before AS i0,
          last_value(x IGNORE NULLS) OVER before AS x0,
          first_value(CASE WHEN x IS NOT NULL THEN i END IGNORE NULLS) OVER behind AS i1,
          first_value(x IGNORE NULLS) OVER behind AS x1
        FROM placed WINDOW before AS (PARTITION BY station ORDER BY {ts} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
          behind AS (PARTITION BY station ORDER BY {ts} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
      SELECT station, {ts}, round(coalesce(x, x0 + (x1 - x0)*CAST(i - i0 AS DOUBLE)/(i1 - i0), x0), 6) AS {c} FROM near"""


@query("interpolate_linear", with_tables("readings", wide=WIDE_SQL) + ", " + _interpolated("wide", "sst", "date"))
def interpolate_linear(spark, sf_dir):
    """Soil temperature over each station's instants, most of which lack it."""
    return rounded(ts_ops.interpolate_linear(wide(spark, sf_dir).select("station", "date", "sst"), "sst"))


@query(
    "categorize_sensor",
    with_tables("readings")
    + """SELECT event_id, CASE WHEN contains(sensor, 'Soil water content') THEN 'SSM' WHEN contains(sensor, 'Soil temperature') THEN 'SST'
        WHEN contains(sensor, 'Air temperature') THEN 'AIRT' WHEN contains(sensor, 'Precipitation totals') THEN 'PRCP'
        ELSE 'Unknown' END AS category,
        CASE WHEN contains(sensor, 'Soil water content') THEN 'SSM' WHEN contains(sensor, 'Soil temperature') THEN 'SST'
        ELSE 'Unknown' END AS soil_category
      FROM (SELECT event_id, concat('avg ', sensor, ' 0 to 5 cm') AS sensor FROM readings)""",
)
def categorize_sensor(spark, sf_dir):
    worded = b.readings(spark, sf_dir).selectExpr("event_id", "concat('avg ', sensor, ' 0 to 5 cm') AS sensor")
    return ops.categorize_sensor(worded).select(
        "event_id", "category", ops.sensor_category_soil(F.col("sensor")).alias("soil_category")
    )


@query(
    "pivot_long_to_wide",
    with_tables("readings", wide=WIDE_SQL)
    + """SELECT r.station, r.date, CASE WHEN r.event_id % 9 = 0 THEN NULL ELSE r.depth END AS depth,
        round(ssm, 6) AS ssm, round(sst, 6) AS sst, round(airt, 6) AS airt, round(prcp, 6) AS prcp
      FROM readings r JOIN wide USING (station, date)""",
)
def pivot_long_to_wide(spark, sf_dir):
    long = ops.categorize_sensor(b.readings(spark, sf_dir)).withColumn(
        "depth", F.when(F.col("event_id") % 9 != 0, F.col("depth"))
    )
    return rounded(ops.pivot_long_to_wide(long, ["station", "date", "depth"]))


@query(
    "calendar_columns",
    with_tables("readings")
    + "SELECT event_id, date, CAST(year(date) AS INT) AS year, CAST(dayofyear(date) AS INT) AS doy FROM readings",
)
def calendar_columns(spark, sf_dir):
    return ops.calendar_columns(b.readings(spark, sf_dir).select("event_id", "date"))


@query(
    "depth_label_to_cm",
    with_tables("readings", deep=f"SELECT event_id, {DEPTH} AS depth FROM readings")
    + "SELECT event_id, coalesce(try_cast(regexp_extract(depth, '(\\d+)\\s*cm', 1) AS INT), 5) AS depth_cm FROM deep",
)
def depth_label_to_cm(spark, sf_dir):
    deep = b.readings(spark, sf_dir).selectExpr("event_id", f"{DEPTH} AS depth")
    return deep.select("event_id", ops.depth_label_to_cm(F.col("depth")).alias("depth_cm"))


@query(
    "join_texture",
    with_tables("readings", "texture")
    + """SELECT event_id, station, round(bulk, 6) AS bulk, round(sand, 6) AS sand, round(silt, 6) AS silt,
        round(clay, 6) AS clay FROM readings LEFT JOIN texture USING (station)""",
)
def join_texture(spark, sf_dir):
    joined = ops.join_texture(b.readings(spark, sf_dir).select("event_id", "station"), b.small(spark, "texture"))
    return rounded(joined.select("event_id", "station", "bulk", "sand", "silt", "clay"))


@query(
    "sort_by_time",
    with_tables("readings") + "SELECT station, date, event_id FROM readings ORDER BY date, event_id",
)
def sort_by_time(spark, sf_dir):
    return ts_ops.sort_by_time(b.readings(spark, sf_dir).select("station", "date", "event_id"), ids=["event_id"])


@query(
    "filter_station_contains",
    with_tables("readings")
    + "SELECT event_id, station FROM readings WHERE contains(lower(station), 'b1') AND year(date) = 2024",
)
def filter_station_contains(spark, sf_dir):
    dated = ops.calendar_columns(b.readings(spark, sf_dir))
    return ops.filter_station_contains(dated, "B1", 2024).select("event_id", "station")
