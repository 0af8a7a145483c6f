"""Per-station time series: fills, interpolation, daily grids, spans, as-of join."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tilth.functions.columns import day, hashed_order, micros
from tilth.operators.scan import running
from tilth.session import materialize


def with_time_order(df: DataFrame, ts: str, ids: Sequence[str] | None) -> tuple[DataFrame, list[str], list[str]]:
    """The table, the columns that order a timeline for :func:`tilth.operators.scan.running`, and those to drop afterwards.

    Without ``ids`` every (key, instant) occurs once. With ``ids`` many rows
    may share an instant: they are taken in the order of a hash of the ids.
    """
    if ids is None:
        return df, [ts], []
    return df.withColumn("__h", hashed_order(*ids)), [ts, "__h"], ["__h"]


def sort_by_time(df: DataFrame, ts: str = "date", ids: Sequence[str] = ()) -> DataFrame:
    """Total order by time, then by ids (a distributed range sort)."""
    return df.orderBy(ts, *ids)


def fill_forward_backward(
    df: DataFrame,
    cols: Sequence[str],
    by: Sequence[str] = ("station",),
    ts: str = "date",
    ids: Sequence[str] | None = None,
) -> DataFrame:
    """Fill gaps with the last earlier reading, leading gaps with the first later one; runs jobs."""
    out, order, helpers = with_time_order(df, ts, ids)
    specs = {}
    for c in cols:
        specs[f"__prev_{c}"] = ("last", c)
        specs[f"__next_{c}"] = ("next", c)
    filled = running(out, by, order, specs, helpers)
    return filled.select(
        *[
            F.coalesce(c, f"__prev_{c}", f"__next_{c}").alias(c) if c in cols else F.col(c)
            for c in df.columns
        ]
    )


def interpolate_linear(
    df: DataFrame,
    cols: str | Sequence[str],
    by: Sequence[str] = ("station",),
    ts: str = "date",
    ids: Sequence[str] | None = None,
) -> DataFrame:
    """Fill gaps on a straight line over row positions between the neighbours; runs jobs.

    Positions count rows, not time. Leading gaps stay, trailing gaps take the
    last reading. ``by=()`` runs over the whole table in time order.
    """
    cols = [cols] if isinstance(cols, str) else list(cols)
    out, order, helpers = with_time_order(df, ts, ids)
    specs = {"__pos": ("count", ts)}
    for c in cols:
        specs[f"__prev_{c}"] = ("last_at", c)
        specs[f"__next_{c}"] = ("next_at", c)
    near = running(out, by, order, specs, helpers)

    def filled(c: str) -> Column:
        p0, v0 = F.col(f"__prev_{c}.p"), F.col(f"__prev_{c}.v")
        p1, v1 = F.col(f"__next_{c}.p"), F.col(f"__next_{c}.v")
        share = F.try_divide((F.col("__pos") - p0).cast("double"), (p1 - p0).cast("double"))
        return F.coalesce(F.col(c), v0 + (v1 - v0) * share, v0)

    return near.select(*[filled(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def daily_midrange(
    df: DataFrame, measures: dict[str, Column | str], by: Sequence[str] = ("station",), ts: str = "date"
) -> DataFrame:
    """Half-way between the day's lowest and highest value, per key and day."""
    return df.groupBy(*by, day(ts).alias("day")).agg(
        *[((F.min(c) + F.max(c)) / 2.0).alias(name) for name, c in measures.items()]
    )


def calendar_densify(daily: DataFrame, by: Sequence[str] = ("station",), day_col: str = "day") -> DataFrame:
    """Every day from the key's first to its last, with NULL measures where none was."""
    span = daily.groupBy(*by).agg(F.min(day_col).alias("__lo"), F.max(day_col).alias("__hi"))
    grid = span.select(*by, F.explode(F.sequence("__lo", "__hi")).alias(day_col))
    return grid.join(daily, on=[*by, day_col], how="left").select(*daily.columns)


def attach_daily_stats(
    readings: DataFrame, *daily: DataFrame, by: Sequence[str] = ("station",), ts: str = "date"
) -> DataFrame:
    """Put each day's statistics on every reading of that day.

    The daily tables are written first (runs jobs), so the planner knows their size.
    """
    out = readings.withColumn("day", day(ts))
    for stats in daily:
        out = out.join(materialize(stats, "daily"), on=[*by, "day"], how="left")
    return out.drop("day")


def daily_sum_dense(
    df: DataFrame, col: str, by: Sequence[str] = ("station",), ts: str = "date"
) -> DataFrame:
    """Daily totals with 0 for missing days; series that are 0 throughout are dropped.

    ``by=()`` pools all stations of the table, the fallback when no station
    series survives.
    """
    by = list(by)
    daily = df.filter(F.col(ts).isNotNull()).groupBy(*by, day(ts).alias("day")).agg(F.sum(col).alias("total"))
    span = daily.groupBy(*by).agg(
        F.min("day").alias("__lo"), F.max("day").alias("__hi"), F.sum(F.abs("total")).alias("__size")
    )
    grid = span.filter("__size > 0").select(*by, F.explode(F.sequence("__lo", "__hi")).alias("day"))
    return grid.join(daily, on=[*by, "day"], how="left").select(
        *by, "day", F.coalesce("total", F.lit(0.0)).alias("total")
    )


def daily_sum_or_pooled(
    df: DataFrame, col: str, by: Sequence[str] = ("station",), within: Sequence[str] = (), ts: str = "date"
) -> DataFrame:
    """Daily totals per series, and where no series of a panel survives, those of all its rows together.

    As :func:`daily_sum_dense`; both kinds come from one aggregate, and the data
    tell which stays. ``pooled`` marks the totals over all rows, whose ``by``
    columns are NULL; rows with a NULL there belong to no series, but are
    pooled. ``within`` are the panels that are settled apart.
    """
    by, within = list(by), list(within)
    rows = df.filter(F.col(ts).isNotNull()).select(*within, *by, day(ts).alias("day"), F.col(col).alias("__v"))
    sets = [[*within, *by, "day"], [*within, "day"]]
    daily = rows.groupingSets(sets, *within, *by, "day").agg(
        F.sum("__v").alias("total"), (F.grouping(by[0]) == 1).alias("pooled")
    )
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in by])
    daily = daily.filter(F.col("pooled") | known)
    spans = (
        daily.groupBy(*within, *by, "pooled")
        .agg(F.min("day").alias("__lo"), F.max("day").alias("__hi"), F.sum(F.abs("total")).alias("__size"))
        .filter("__size > 0")
    )
    # a row per series
    alone = F.count_if(~F.col("pooled")).over(Window.partitionBy(F.lit(0), *within)) == 0
    kept = spans.withColumn("__alone", alone).filter(~F.col("pooled") | F.col("__alone"))
    grid = kept.select(*within, *by, "pooled", F.explode(F.sequence("__lo", "__hi")).alias("day")).alias("g")
    own = daily.alias("d")
    same = reduce(
        lambda a, b: a & b, [F.col(f"g.{c}").eqNullSafe(F.col(f"d.{c}")) for c in [*within, *by, "pooled", "day"]]
    )
    return grid.join(own, same, "left").select(
        *[F.col(f"g.{c}") for c in [*within, *by, "pooled", "day"]], F.coalesce("d.total", F.lit(0.0)).alias("total")
    )


def spans_of_consecutive_days(days: DataFrame, by: Sequence[str] = (), day_col: str = "day") -> DataFrame:
    """Collapse a set of distinct days into [start, end] spans; a missing day splits.

    The input has one row per key and day, so a key holds no more rows than
    the calendar has days.
    """
    w = Window.partitionBy(*by).orderBy(day_col)
    island = F.date_sub(F.col(day_col), F.row_number().over(w))
    return (
        days.select(*by, day_col, island.alias("__island"))
        .groupBy(*by, "__island")
        .agg(F.min(day_col).alias("start"), F.max(day_col).alias("end"))
        .drop("__island")
    )


def spans_between_changes(
    daily: DataFrame, flag: Column, by: Sequence[str] = (), day_col: str = "day"
) -> DataFrame:
    """Spans of rows where ``flag`` holds, cut only where it changes between present rows.

    Missing days do not split. One row per key and day, as above.
    """
    w = Window.partitionBy(*by).orderBy(day_col)
    changed = F.when(F.col("__flag") != F.lag("__flag").over(w), 1).otherwise(0)
    return (
        daily.select(*by, day_col, F.coalesce(flag, F.lit(False)).alias("__flag"))
        .withColumn("__changed", changed)
        .withColumn("__run", F.sum("__changed").over(w.rowsBetween(Window.unboundedPreceding, 0)))
        .filter("__flag")
        .groupBy(*by, "__run")
        .agg(F.min(day_col).alias("start"), F.max(day_col).alias("end"))
        .drop("__run")
    )


def asof_nearest(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str] = ("station",),
    ts: str = "date",
    tolerance_seconds: int = 7200,
    right_ids: Sequence[str] | None = None,
) -> DataFrame:
    """Left rows with the right row nearest in time, per key, within the tolerance.

    The tolerance is inclusive; of two equally near rows the earlier wins.
    Among right rows at one instant, the last in ``right_ids`` order answers
    looks back (and exact hits), the first answers looks ahead. Unmatched left
    rows are kept with NULLs. Left columns win over right ones of equal name.

    The timeline is cut into buckets as wide as the tolerance, so a match lies
    in the row's own bucket or a neighbour: right instants are copied to three
    buckets and both lookups are windows inside (key, bucket). Equal instants
    are folded first on both sides, so a bucket holds at most a few
    tolerances' worth of clock ticks however crowded one station is; the
    answer is joined back by (key, instant), a join whose right side is unique.
    """
    by = list(by)
    payload = [c for c in right.columns if c not in left.columns]
    reach = tolerance_seconds * 1_000_000
    width = max(reach, 1_000_000)
    fields = F.struct(*payload)
    present = F.lit(True)
    for c in [*by, ts]:
        present = present & F.col(c).isNotNull()

    if right_ids is None:
        folded = right.filter(present).select(*by, ts, fields.alias("first"), fields.alias("last"))
    else:
        rank = F.struct(*right_ids)
        folded = right.filter(present).groupBy(*by, ts).agg(
            F.min_by(fields, rank).alias("first"), F.max_by(fields, rank).alias("last")
        )
    folded = folded.withColumn("t", micros(ts)).withColumn("__bucket", F.floor(F.col("t") / width))
    near_buckets = F.explode(F.array(*[F.col("__bucket") + F.lit(k) for k in (-1, 0, 1)]))
    marks = folded.select(
        *by,
        ts,
        "t",
        F.lit(0).alias("__side"),
        F.struct("t", F.col("last").alias("row")).alias("__back"),
        F.struct("t", F.col("first").alias("row")).alias("__ahead"),
        near_buckets.alias("__bucket"),
    )
    wanted = (
        left.filter(present)
        .select(*by, ts)
        .distinct()
        .withColumn("t", micros(ts))
        .select(*by, ts, "t", F.lit(1).alias("__side"), F.floor(F.col("t") / width).alias("__bucket"))
    )

    past = (
        Window.partitionBy(*by, "__bucket").orderBy("t", "__side").rowsBetween(Window.unboundedPreceding, 0)
    )
    future = (
        Window.partitionBy(*by, "__bucket")
        .orderBy(F.desc("t"), F.desc("__side"))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    seen = (
        marks.unionByName(wanted, allowMissingColumns=True)
        .withColumn("__b", F.last("__back", ignorenulls=True).over(past))
        .withColumn("__a", F.last("__ahead", ignorenulls=True).over(future))
        .filter("__side = 1")
    )
    gap_b, gap_a = F.col("t") - F.col("__b.t"), F.col("__a.t") - F.col("t")
    back_ok, ahead_ok = gap_b <= reach, gap_a <= reach
    pick = (
        F.when(back_ok & (~F.coalesce(ahead_ok, F.lit(False)) | (gap_b <= gap_a)), F.col("__b.row"))
        .when(ahead_ok, F.col("__a.row"))
    )
    matched = seen.withColumn("__row", pick).filter("__row is not null").select(*by, ts, "__row.*")
    return left.join(matched, on=[*by, ts], how="left").select(
        *[F.col(c) for c in left.columns], *[F.col(c) for c in payload]
    )
