"""Station readings: names, types, categories, reshapes and lookups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tilth.functions.columns import TIME_FORMATS, doy_of, first_time, to_number, year_of
from tilth.schemas import SENSOR_CATEGORIES, conform, require_columns

# Patterns that name the columns of a logger export.
AIR_PATTERN = r"(?i)^air\s*temp"
PRECIP_PATTERN = r"(?i)^(precipitation\s*totals|precip\s*total)"
WATER_PATTERN = r"(?i)^soil water content"
SOIL_TEMP_PATTERN = r"(?i)^soil temperature"
SHALLOW_PATTERN = r"(?i)(0\s*to\s*5\s*cm|\b5\s*cm\s*depth)"
DEPTH_CM_PATTERN = r"(\d+)\s*cm"
DEFAULT_DEPTH_CM = 5
SHALLOW_LABEL = "0 to 5 cm"


def column_label(name_token: Column, unit_token: Column) -> Column:
    """Label of a logger column from its name row and unit row.

    The name loses everything up to its first dot; the unit has its degree
    sign repaired; the word Value in the unit stands for the name.
    """
    name = F.regexp_replace(F.coalesce(name_token, F.lit("")), r"^[^.]*\.", "")
    unit = F.coalesce(unit_token, F.lit(""))
    unit = F.replace(F.replace(unit, F.lit("Ã‚"), F.lit("")), F.lit("Â°"), F.lit("°"))
    return F.trim(F.when(unit.contains("Value"), F.replace(unit, F.lit("Value"), name)).otherwise(name))


def station_from_name(name: Column) -> Column:
    """Short station id found in a file name or path; NULL when there is none."""
    token = F.regexp_extract(name, r"(?:^|[^A-Za-z0-9])([A-Z]{2}\d+)(?=[^A-Za-z0-9]|$)", 1)
    return F.when(token != "", token)


def station_of_file(name: Column) -> Column:
    """Station of a file: the id found in its path, else the second part of its name between underscores, else the whole name."""
    base = F.regexp_replace(F.element_at(F.split(name, "/"), -1), r"\.[^.]*$", "")
    second = F.get(F.split(base, "_"), 1)
    return F.coalesce(station_from_name(name), F.when(second != "", second), base)


def parse_timestamp_dropna(
    df: DataFrame, raw: str, out: str = "ts", formats: Sequence[str | None] = TIME_FORMATS
) -> DataFrame:
    """Text to timestamp by the first format that fits; rows that fit none are dropped."""
    return df.withColumn(out, first_time(raw, formats)).filter(F.col(out).isNotNull())


def unparsed_times(df: DataFrame, raw: str, formats: Sequence[str | None] = TIME_FORMATS) -> DataFrame:
    """The rows that :func:`parse_timestamp_dropna` drops."""
    return df.filter(first_time(raw, formats).isNull())


def coerce_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: to_number(c) for c in cols})


def column_category(label: Column) -> Column:
    """Which measure a labelled logger column holds; NULL for the rest."""
    shallow = label.rlike(SHALLOW_PATTERN)
    return (
        F.when(label.rlike(AIR_PATTERN), "AIRT")
        .when(label.rlike(PRECIP_PATTERN), "PRCP")
        .when(label.rlike(WATER_PATTERN) & shallow, "SSM")
        .when(label.rlike(SOIL_TEMP_PATTERN) & shallow, "SST")
    )


def classify_columns(columns: DataFrame, by: Sequence[str] = ("station",)) -> DataFrame:
    """Pick the useful columns of each file from its ``(column, col_pos)`` list.

    All shallow soil columns are kept; of the air and of the precipitation
    columns only the leftmost.
    """
    by = list(by)
    labelled = columns.withColumn("category", column_category(F.col("column"))).filter("category is not null")
    kept = labelled.groupBy(*by, "category").agg(F.min("col_pos").alias("__first"))
    single = F.col("category").isin("AIRT", "PRCP")
    return (
        labelled.join(kept, on=[*by, "category"], how="inner")
        .filter(~single | (F.col("col_pos") == F.col("__first")))
        .select(*columns.columns, "category")
    )


def row_mean_ignore_null(
    df: DataFrame, by: Sequence[str] = ("station", "ts", "category"), value: str = "value"
) -> DataFrame:
    """Mean over the sensors of one kind at one instant; NULL when all are NULL."""
    return df.groupBy(*by).agg(F.avg(value).alias(value))


def melt_wide_to_long(
    df: DataFrame,
    ids: Sequence[str] = ("station", "date"),
    measures: dict[str, str] | None = None,
    depth: str = SHALLOW_LABEL,
) -> DataFrame:
    """Measure columns to (sensor, value) rows with the sensor's wording and a depth label."""
    measures = measures or {code.lower(): words for words, code in SENSOR_CATEGORIES}
    wide = df.select(*ids, *[F.col(c).alias(words) for c, words in measures.items()])
    return wide.unpivot(list(ids), list(measures.values()), "sensor", "value").withColumn("depth", F.lit(depth))


def union_stations(spark: SparkSession, tables: Sequence[DataFrame], schema) -> DataFrame:
    """All tables as one; no table at all gives an empty one with the known columns."""
    if not tables:
        return spark.createDataFrame([], schema)
    return conform(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables), schema)


def filter_depth(df: DataFrame, depth: str = SHALLOW_LABEL) -> DataFrame:
    return df.filter(F.col("depth") == depth)


def sensor_category(sensor: Column) -> Column:
    """Measure code from the sensor's wording; the first wording contained wins."""
    out = None
    for words, code in SENSOR_CATEGORIES:
        hit = sensor.contains(words)
        out = F.when(hit, code) if out is None else out.when(hit, code)
    return out.otherwise("Unknown")


def sensor_category_soil(sensor: Column) -> Column:
    """The two-way variant: soil moisture, soil temperature or Unknown."""
    return (
        F.when(sensor.contains("Soil water content"), "SSM")
        .when(sensor.contains("Soil temperature"), "SST")
        .otherwise("Unknown")
    )


def categorize_sensor(df: DataFrame) -> DataFrame:
    return df.withColumn("category", sensor_category(F.col("sensor")))


def pivot_long_to_wide(
    df: DataFrame,
    keys: Sequence[str],
    categories: Sequence[str] = ("SSM", "SST", "AIRT", "PRCP"),
    value: str = "value",
    carried: Sequence[str] = (),
) -> DataFrame:
    """One column per category, without aggregation: a doubled cell is an error.

    Keys may be NULL. Rows of other categories add no column but keep their
    key's row. ``carried``: columns that are the same in all rows of a key. The error is raised by the job itself when it meets a doubled cell.
    """
    aggs = []
    for c in categories:
        here = F.col("category") == c
        twice = F.raise_error(F.lit(f"pivot: several {c} values for one key")).cast("double")
        aggs.append(
            F.when(F.count_if(here) > 1, twice).otherwise(F.max(F.when(here, F.col(value)))).alias(c.lower())
        )
    return df.groupBy(*keys).agg(*aggs, *[F.max(c).alias(c) for c in carried])


def duplicate_cells(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Cells a pivot could not place: key combinations that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def calendar_columns(df: DataFrame, ts: str = "date") -> DataFrame:
    return df.withColumns({"year": year_of(ts), "doy": doy_of(ts)})


def depth_label_to_cm(label: Column) -> Column:
    """Number directly before ``cm``, else 5."""
    return F.coalesce(F.regexp_extract(label, DEPTH_CM_PATTERN, 1).try_cast("int"), F.lit(DEFAULT_DEPTH_CM))


def join_texture(readings: DataFrame, texture: DataFrame) -> DataFrame:
    """Soil texture of the station; readings of unknown stations stay, with NULLs."""
    return readings.join(texture, on="station", how="left")


def filter_station_contains(df: DataFrame, needle: str, year: int | None = None) -> DataFrame:
    """Stations whose id contains ``needle`` in any case, optionally in one year."""
    require_columns(df, ["station"])
    out = df.filter(F.lower("station").contains(needle.lower()))
    return out if year is None else out.filter(F.col("year") == year)
