"""Growing-degree sums and crop stages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilth.functions.columns import clip_low, mean_ignoring_null
from tilth.operators.lookup import intervals
from tilth.operators.scan import running
from tilth.operators.timeseries import with_time_order


def dropna_subset(df: DataFrame, cols: Sequence[str] = ("vv", "vh", "angle")) -> DataFrame:
    return df.dropna(subset=list(cols))


def lookup_base_temp(df: DataFrame, base: DataFrame) -> DataFrame:
    """Base temperature of the crop; NULL for crops the table does not list."""
    return df.join(base.select("lc", F.col("base").cast("double").alias("base_temp")), on="lc", how="left")


def _cumulative(df: DataFrame, inputs: dict[str, str], by, ts, ids) -> DataFrame:
    """Running totals; a NULL input gives NULL there and does not reset the total."""
    out, order, helpers = with_time_order(df, ts, ids)
    summed = running(out, by, order, {name: ("sum", col) for name, col in inputs.items()}, helpers)
    return summed.withColumns(
        {name: F.when(F.col(col).isNotNull(), F.col(name)) for name, col in inputs.items()}
    )


def cumulative_gdd(
    df: DataFrame,
    by: Sequence[str] = ("year",),
    ts: str = "date",
    ids: Sequence[str] | None = ("obs_id",),
) -> DataFrame:
    """Running growing-degree sums ``cum_gdd_air`` and ``cum_gdd_soil``.

    The default groups by year alone, all stations and crops mixed in time
    order; pass ``by=("station", "year")`` for one series per station.
    """
    degrees = df.withColumns(
        {
            "__gdd_air": clip_low(F.col("mean_airt") - F.col("base_temp")),
            "__gdd_soil": clip_low(F.col("mean_sst") - F.col("base_temp")),
        }
    )
    return _cumulative(
        degrees, {"cum_gdd_air": "__gdd_air", "cum_gdd_soil": "__gdd_soil"}, by, ts, ids
    ).drop("__gdd_air", "__gdd_soil")


def cumulative_ssm(
    df: DataFrame,
    by: Sequence[str] = ("year",),
    ts: str = "date",
    ids: Sequence[str] | None = ("obs_id",),
) -> DataFrame:
    return _cumulative(df, {"cum_ssm": "ssm"}, by, ts, ids)


def cumulative_all(
    df: DataFrame,
    by: Sequence[str] = ("year",),
    ts: str = "date",
    ids: Sequence[str] | None = ("obs_id",),
) -> DataFrame:
    """All three running totals in one pass over the blocks."""
    degrees = df.withColumns(
        {
            "__gdd_air": clip_low(F.col("mean_airt") - F.col("base_temp")),
            "__gdd_soil": clip_low(F.col("mean_sst") - F.col("base_temp")),
        }
    )
    inputs = {"cum_gdd_air": "__gdd_air", "cum_gdd_soil": "__gdd_soil", "cum_ssm": "ssm"}
    return _cumulative(degrees, inputs, by, ts, ids).drop("__gdd_air", "__gdd_soil")


def mean_of_two_ignore_null(df: DataFrame, a: str = "cum_gdd_air", b: str = "cum_gdd_soil", out: str = "cum_gdd"):
    return df.withColumn(out, mean_ignoring_null(a, b))


def stage_from_gdd(
    df: DataFrame, stages: DataFrame, gdd: str = "cum_gdd", sst: str = "sst", out: str = "bbch"
) -> DataFrame:
    """Crop stage by linear interpolation between degree-sum breakpoints.

    NULL degree sum or temperature, or a crop without breakpoints, gives NULL;
    below the first breakpoint 0; from the last on, its stage as it is; in
    between the interpolated stage rounded half to even, or NULL while the
    soil is below 0 degrees.
    """
    table = intervals(stages, "lc", "gdd", ["stage"])
    g = F.col(gdd)
    hit = (
        (F.col("is_first") & (g < F.col("x0")))
        | (F.col("is_last") & (g >= F.col("x0")))
        | ((g >= F.col("x0")) & (g < F.col("x1")))
    )
    joined = df.join(table.withColumnRenamed("lc", "__lc"), (F.col("lc") == F.col("__lc")) & hit, "left")
    between = F.rint(
        F.col("stage0")
        + (g - F.col("x0")) / (F.col("x1") - F.col("x0")) * (F.col("stage1") - F.col("stage0"))
    )
    stage = (
        F.when(g.isNull() | F.col(sst).isNull() | F.col("__lc").isNull(), F.lit(None))
        .when(F.col("is_first") & (g < F.col("x0")), F.lit(0.0))
        .when(F.col("is_last"), F.col("stage0"))
        .when(F.col(sst) >= 0, between)
    )
    return joined.select(*[F.col(c) for c in df.columns if c != out], stage.alias(out))
