"""Satellite scenes as tables: keys, filters, reshapes."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilth.functions.columns import doy_of, to_timestamp_ntz, year_of

# The mission's first day, the key's layout and the meta bands.
MISSION_START = "2014-10-03"
KEY_TIME_FORMAT = "yyyyMMdd'T'HHmmss"
KEY_PREFIX = "from"
META_BANDS = ("doy", "year")


def parse_scene_key(df: DataFrame, key: str = "key") -> DataFrame:
    """Split ``from<time>_<band>_<pass>`` into date, year, doy, band and pass flag.

    The flag is 0 for ``asc`` and 1 for anything else, a missing part included.
    """
    parts = F.split(F.col(key), "_")
    stamp = F.replace(F.get(parts, F.lit(0)), F.lit(KEY_PREFIX), F.lit(""))
    return (
        df.withColumn("date", to_timestamp_ntz(stamp, KEY_TIME_FORMAT))
        .withColumn("year", year_of("date"))
        .withColumn("doy", doy_of("date"))
        .withColumn("band", F.get(parts, F.lit(1)))
        .withColumn("op", F.when(F.get(parts, F.lit(2)) == "asc", 0).otherwise(1))
    )


def scene_key(ts: Column, band: Column, op: Column) -> Column:
    """The inverse: compose a column key from time, band and pass flag."""
    return F.concat(
        F.lit(KEY_PREFIX),
        F.date_format(ts, KEY_TIME_FORMAT),
        F.lit("_"),
        band,
        F.when(op == 0, "_asc").otherwise("_desc"),
    )


def key_from_scene_id(scene_id: Column, op: Column) -> Column:
    """Column key from a full scene id: its fifth part, its last part and the pass."""
    parts = F.split(scene_id, "_")
    return F.concat_ws(
        "_", F.get(parts, F.lit(4)), F.element_at(parts, -1), F.when(op == 0, "asc").otherwise("desc")
    )


def drop_meta_bands(df: DataFrame) -> DataFrame:
    return df.filter(F.col("band").isNull() | ~F.col("band").isin(*META_BANDS))


def pivot_bands_mean(
    df: DataFrame,
    bands: Sequence[str],
    keys: Sequence[str] = ("station", "date", "op", "year", "doy"),
    value: str = "value",
) -> DataFrame:
    """One column per band, repeated cells averaged, rows with a NULL key dropped."""
    means = [F.avg(F.when(F.col("band") == band, F.col(value))).alias(band) for band in bands]
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(*means)


def cast_crop(df: DataFrame, landcover: str = "landcover") -> DataFrame:
    """Land cover number to the crop code string ``lc``; other names to lower case."""
    return df.select(
        *[F.col(c).alias(c.lower()) for c in df.columns if c != landcover],
        F.col(landcover).cast("int").cast("string").alias("lc"),
    )


def date_range_filter(
    df: DataFrame, start: str, end: str, ts: str = "date", mission_start: str = MISSION_START
) -> DataFrame:
    """Rows in ``[start, end)``; an earlier start is moved to the mission's first day."""
    if date.fromisoformat(start) >= date.fromisoformat(end):
        raise ValueError("start must be earlier than end")
    start = max(start, mission_start)
    return df.filter(
        (F.col(ts) >= F.lit(start).cast("timestamp_ntz")) & (F.col(ts) < F.lit(end).cast("timestamp_ntz"))
    )


def scene_attribute_filter(
    df: DataFrame,
    polarisations: str = "polarisations",
    mode: str = "mode",
    wanted_polarisation: str = "VV",
    wanted_mode: str = "IW",
) -> DataFrame:
    """Scenes that carry the polarisation and were taken in the mode."""
    return df.filter(F.array_contains(polarisations, wanted_polarisation) & (F.col(mode) == wanted_mode))


def dedupe_by_time(df: DataFrame, ts: str = "date", scene_id: str = "scene_id") -> DataFrame:
    """One scene per start time: the one with the smallest id.

    A map-side aggregate, so many scenes at one instant do not meet in one task.
    """
    others = [c for c in df.columns if c != ts]
    return (
        df.groupBy(ts)
        .agg(F.min_by(F.struct(*others), scene_id).alias("__row"))
        .select(*[F.col(c) if c == ts else F.col(f"__row.{c}").alias(c) for c in df.columns])
    )


def count_by_pass(df: DataFrame, op: str = "op") -> DataFrame:
    """Scenes per orbit direction; the direction stays a column."""
    name = F.when(F.col(op) == 0, "asc").otherwise("desc")
    return df.groupBy(name.alias("pass")).agg(F.count(F.lit(1)).alias("n"))


def truncate_to_short(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop the fraction toward zero, as an export to 16-bit bands does."""
    return df.withColumns({c: F.col(c).cast("smallint") for c in cols})
