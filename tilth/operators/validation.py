"""Tables that judge the result: fit metrics, coverage, panels, spans."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilth.functions.columns import day
from tilth.operators.quantiles import exact_median
from tilth.operators.timeseries import spans_of_consecutive_days
from tilth.schemas import require_columns, require_rows
from tilth.session import materialize


def _as_list(value) -> list | None:
    if value is None:
        return None
    if isinstance(value, str) or not isinstance(value, Iterable):
        return [value]
    return list(value)


def filter_in_list(df: DataFrame, col: str, value) -> DataFrame:
    """Rows whose ``col`` is the value or among the values; None or an absent column keeps all."""
    values = _as_list(value)
    if values is None or col not in df.columns:
        return df
    return df.filter(F.col(col).isin(*values))


def holdout_subset(
    df: DataFrame, target: str = "ssm", station=None, year=None, crop=None, ids: Sequence[str] = (), check: bool = True
) -> DataFrame:
    """Rows matching the filters, ordered by day of year (or date).

    ``check`` runs a one-row job and fails when nothing matches.
    """
    require_columns(df, [target, f"{target}_pred"], "holdout table")
    out = df
    for col, value in (("station", station), ("year", year), ("lc", crop)):
        out = filter_in_list(out, col, value)
    if check:
        require_rows(out, "no records for these station/year/crop filters")
    first = next((c for c in ("doy", "date") if c in out.columns), None)
    return out.orderBy(first, *ids) if first else out


def metric_columns(obs: Column, pred: Column) -> list[Column]:
    """Aggregates for one group: n, r, rmse, ubrmse, bias (pred - obs), slope, intercept.

    Pairs with a NULL or NaN side are left out; r, slope and intercept need two
    pairs, and a spread, to be defined.
    """
    sound = obs.isNotNull() & pred.isNotNull() & ~F.isnan(obs) & ~F.isnan(pred)
    o, p = F.when(sound, obs), F.when(sound, pred)
    diff = p - o
    n = F.count_if(sound)
    bias = F.avg(diff)
    mse = F.avg(diff * diff)
    cov = F.covar_pop(o, p)
    slope = F.try_divide(cov, F.var_pop(o))
    enough = n >= 2
    return [
        n.alias("n"),
        F.when(enough, F.try_divide(cov, F.stddev_pop(o) * F.stddev_pop(p))).alias("r"),
        F.sqrt(mse).alias("rmse"),
        F.sqrt(F.greatest(mse - bias * bias, F.lit(0.0))).alias("ubrmse"),
        bias.alias("bias_pred_obs"),
        F.when(enough, slope).alias("slope"),
        F.when(enough, F.avg(p) - slope * F.avg(o)).alias("intercept"),
    ]


def _require_pairs(metrics: DataFrame) -> DataFrame:
    """Fails the job where a group has no valid pair, whichever columns are read."""
    message = F.raise_error(F.lit("metrics: a group has no valid pairs")).cast("boolean")
    return metrics.filter(F.when(F.col("n") == 0, message).otherwise(F.lit(True)))


def pairwise_metrics(df: DataFrame, obs: str, pred: str) -> DataFrame:
    """Metrics of one pair of columns over the whole table; no valid pair fails the job."""
    return _require_pairs(df.agg(*metric_columns(F.col(obs), F.col(pred))))


def grouped_metrics(
    df: DataFrame, target: str = "ssm", by: Sequence[str] = ("station", "year", "lc"), extra: Sequence[str] = ()
) -> DataFrame:
    """Metrics per group; rows with NULL group values form groups of their own."""
    cols = list(dict.fromkeys([*extra, *by]))
    return _require_pairs(df.groupBy(*cols).agg(*metric_columns(F.col(target), F.col(f"{target}_pred"))))


def overall_metrics(df: DataFrame, target: str = "ssm") -> DataFrame:
    return pairwise_metrics(df, target, f"{target}_pred")


def metrics_rollup(
    df: DataFrame,
    target: str = "ssm",
    by: Sequence[str] = ("station", "year", "lc"),
    sets: Sequence[Sequence[str]] | None = None,
) -> DataFrame:
    """Metrics of all groups, of the margins of each column, and of the whole table, in one aggregate.

    ``sets`` names other groupings (subsets of ``by``). ``level`` has the
    columns a row is grouped by, or ``all``: a NULL in one of them is a group
    of rows without that value, a NULL elsewhere means all values.
    """
    by = list(by)
    sets = [list(s) for s in sets] if sets is not None else [by, *([c] for c in by if len(by) > 1), []]
    names = F.concat_ws(",", *(F.when(F.grouping(c) == 0, F.lit(c)) for c in by))
    columns = metric_columns(F.col(target), F.col(f"{target}_pred"))
    level = F.when(names == "", F.lit("all")).otherwise(names).alias("level")
    return _require_pairs(df.groupingSets(sets, *by).agg(level, *columns))


def backfill_target(
    holdout: DataFrame, observed: DataFrame, target: str, keys: Sequence[str] = ("station", "year", "lc", "doy", "date")
) -> DataFrame:
    """Missing targets from the observations on the shared keys.

    Of several observations with one key the smallest value is taken, so no
    holdout row is doubled.
    """
    shared = [k for k in keys if k in holdout.columns and k in observed.columns]
    if not shared:
        raise ValueError("no shared keys to align observations and predictions on")
    one = observed.groupBy(*shared).agg(F.min(target).alias("__obs"))
    own = F.col(target) if target in holdout.columns else F.lit(None).cast("double")
    joined = holdout.join(one, on=shared, how="left")
    return joined.select(
        *[c for c in holdout.columns if c != target], F.coalesce(own, F.col("__obs")).alias(target)
    )


# Key sets tried in turn for panels: columns kept, and those that must be present
KEY_PRIORITY = (
    (("year", "lc", "station"), ("year", "station")),
    (("year", "station"), ("year", "station")),
    (("lc", "station"), ("station",)),
    (("year", "lc"), ("year",)),
    (("station",), ("station",)),
)


def distinct_keys_priority(*tables: DataFrame, priority=KEY_PRIORITY) -> DataFrame:
    """Distinct panel keys over all tables, from the first key set that yields any.

    Columns outside the chosen set are NULL; ``level`` tells which set it was.
    The choice is made inside the query, on the distinct keys.
    """
    every = sorted({c for columns, _ in priority for c in columns})

    def key_sets(table: DataFrame) -> list[Column]:
        """The row's key in every set the table and the row can serve, else NULL."""
        out = []
        for level, (columns, required) in enumerate(priority):
            if all(c in table.columns for c in columns):
                present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required])
                key = F.struct(
                    F.lit(level).alias("level"),
                    *[(F.col(c) if c in columns else F.lit(None)).cast("string").alias(c) for c in every],
                )
                out.append(F.when(present, key))
        return out

    parts = []
    for table in tables:
        sets = key_sets(table)
        if sets:
            own = table.select(*[c for c in every if c in table.columns]).distinct()
            parts.append(own.select(F.inline(F.filter(F.array(*sets), lambda k: k.isNotNull()))))
    if not parts:
        raise KeyError("no key columns in any table")
    keys = reduce(DataFrame.unionByName, parts).distinct()
    best = keys.agg(F.min("level").alias("level"))
    return keys.join(best, on="level", how="inner").select("level", *every).orderBy(*every)


def panel_keys(*tables: DataFrame, columns: Sequence[str] = ("lc", "year")) -> DataFrame:
    """The two-column case: distinct (crop, year) panels, sorted."""
    return reduce(DataFrame.unionByName, [t.select(*columns) for t in tables]).distinct().orderBy(*columns)


def match_observed_predicted(
    observed: DataFrame,
    holdout: DataFrame,
    target: str = "ssm",
    keys: Sequence[str] = ("station", "year", "lc"),
    ts: str = "date",
) -> DataFrame:
    """Observed and predicted series of each key as rows tagged by ``series``.

    Keys without observations are left out. The keys are written first (runs a
    job), so the planner knows their size.
    """
    known = materialize(observed.select(*keys).dropna().distinct(), "keys")
    seen = observed.select(*keys, ts, F.lit("observed").alias("series"), F.col(target).alias("value"))
    made = holdout.select(*keys, ts, F.lit("predicted").alias("series"), F.col(f"{target}_pred").alias("value"))
    return seen.dropna(subset=list(keys)).unionByName(made.join(known, on=list(keys), how="left_semi"))


def date_extent(series: DataFrame, by: Sequence[str] = ("lc", "year"), ts: str = "date") -> DataFrame:
    """First and last date per panel over all its series."""
    return series.groupBy(*by).agg(F.min(ts).alias("first_date"), F.max(ts).alias("last_date"))


def daily_median_temperature(
    df: DataFrame, temp: str = "sst", by: Sequence[str] = (), ts: str = "date"
) -> DataFrame:
    """Daily median over all readings of the panel (all its stations unless ``by`` says otherwise)."""
    days = df.filter(F.col(ts).isNotNull()).select(*by, day(ts).alias("day"), F.col(temp).alias("__t"))
    return exact_median(days, [*by, "day"], "__t", out="median_temp")


def freeze_spans(
    df: DataFrame, temp: str = "sst", by: Sequence[str] = (), ts: str = "date", threshold: float = 0.0
) -> DataFrame:
    """Spans of days whose median is at or below the threshold; a missing day splits."""
    cold = daily_median_temperature(df, temp, by, ts).filter(F.col("median_temp") <= threshold)
    return spans_of_consecutive_days(cold, by)


def crop_station_year_pivot(df: DataFrame, crops: Sequence[str]) -> DataFrame:
    """Rows per station and year by crop, 0 where none, sorted; NULL keys dropped.

    ``crops``: the codes that become columns, as in the crop tables.
    """
    require_columns(df, ["station", "year", "lc"])
    full = df.select("station", "year", "lc").dropna()
    counts = full.groupBy("station", "year", "lc").agg(F.count(F.lit(1)).alias("n"))
    return (
        counts.groupBy("station", "year").pivot("lc", list(crops)).agg(F.sum("n")).na.fill(0).orderBy("station", "year")
    )


def crop_coverage(df: DataFrame) -> DataFrame:
    """Per crop: records, distinct station-years, stations and years."""
    require_columns(df, ["station", "year", "lc"])
    combos = df.select("station", "year", "lc").dropna().groupBy("lc", "station", "year").agg(
        F.count(F.lit(1)).alias("n")
    )
    return combos.groupBy("lc").agg(
        F.sum("n").alias("records"),
        F.count(F.lit(1)).alias("station_year_pairs"),
        F.countDistinct("station").alias("unique_stations"),
        F.countDistinct("year").alias("unique_years"),
    )


# -- ad-hoc reports --------------------------------------------------------


def count_by_station(df: DataFrame, crops: Sequence[str], stations: Sequence[str]) -> DataFrame:
    """Rows of the given crops per (crop, year), one column per station, 0 where none."""
    counts = (
        df.filter(F.col("lc").isin(*crops) & F.col("station").isin(*stations))
        .groupBy("lc", "year", "station")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counts.groupBy("lc", "year").pivot("station", list(stations)).agg(F.sum("n")).na.fill(0)


def row_totals(pivoted: DataFrame, keys: Sequence[str] = ("lc", "year")) -> DataFrame:
    """Total over the pivoted columns of each row."""
    cells = [F.coalesce(F.col(f"`{c}`"), F.lit(0)) for c in pivoted.columns if c not in keys]
    return pivoted.select(*keys, reduce(lambda a, b: a + b, cells).alias("total"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Frequency of each value, most frequent first; NULLs are not counted."""
    return (
        df.filter(F.col(col).isNotNull())
        .groupBy(col)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), col)
    )


def distinct_sorted(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct().orderBy(col)


def seasonal_curve(
    df: DataFrame, x: str, measures: Sequence[str], by: Sequence[str] = ("year", "lc")
) -> DataFrame:
    """Mean of each measure at each x per year and crop, and the rows, as a line plot averages replicates."""
    return df.groupBy(x, *by).agg(*[F.avg(m).alias(f"mean_{m}") for m in measures], F.count(F.lit(1)).alias("n"))


def binned_curve(
    df: DataFrame, x: str, measure: str, by: Sequence[str] = ("year", "lc"), bins: int = 20, accuracy: int = 100_000
) -> DataFrame:
    """A measure against a real-valued x: mean of both per bin of x and group, and the rows; runs a job.

    Bins hold about equally many rows of the whole table; their edges come
    from a quantile sketch, exact up to ``accuracy`` rows and off by one part
    in ``accuracy`` of the rows beyond. An edge belongs to the bin below it.
    Rows without x or the measure are left out.
    """
    if bins < 1:
        raise ValueError("bins must be at least 1")
    known = df.filter(F.col(x).isNotNull() & F.col(measure).isNotNull())
    shares = [i / bins for i in range(1, bins)]
    edges = (known.agg(F.percentile_approx(x, shares, accuracy)).first()[0] if shares else None) or []
    at = reduce(lambda a, b: a + b, [(F.col(x) > F.lit(float(e))).cast("int") for e in edges], F.lit(0))
    return (
        known.withColumn("bin", at)
        .groupBy("bin", *by)
        .agg(F.avg(x).alias(f"mean_{x}"), F.avg(measure).alias(f"mean_{measure}"), F.count(F.lit(1)).alias("n"))
    )


def daily_mean_and_sum_outer(
    means_of: DataFrame,
    sums_of: DataFrame,
    mean_col: str = "sst",
    sum_col: str = "prcp",
    by: Sequence[str] = (),
    ts: str = "date",
) -> DataFrame:
    """Daily mean of one table's measure beside the daily sum of another's.

    Days of either table appear; a day without a sum has 0.
    """
    means = means_of.groupBy(*by, day(ts).alias("day")).agg(F.avg(mean_col).alias(f"{mean_col}_daily"))
    sums = sums_of.groupBy(*by, day(ts).alias("day")).agg(F.sum(sum_col).alias(f"{sum_col}_daily"))
    return means.join(sums, on=[*by, "day"], how="full_outer").select(
        *by,
        "day",
        f"{mean_col}_daily",
        F.coalesce(f"{sum_col}_daily", F.lit(0.0)).alias(f"{sum_col}_daily"),
    )


def head_n(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    """First n rows of an ordered report."""
    return df.orderBy(*order).limit(n)
