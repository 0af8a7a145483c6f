"""Exact medians of groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tilth.session import materialize


def exact_median(
    df: DataFrame, by: Sequence[str], value: str, out: str = "median", accuracy: int = 100_000
) -> DataFrame:
    """Interpolated median per group, as ``median()`` gives it, without holding a group in memory.

    The built-in exact median keeps every distinct value of a group in one
    task. Here a quantile sketch first brackets the middle of each group; its
    guaranteed rank error makes the bracket certain to contain the median.
    A second pass counts what lies below the bracket and keeps, per distinct
    value, a count of what lies inside it: about 6/accuracy of the group.
    Only that sliver is ranked.

    Runs the sketch's job and writes its one row per group, so that the planner
    knows the true size: few groups are broadcast and rows stay where they are,
    many are joined by key with skewed partitions split.
    """
    by = list(by)
    known = df.filter(F.col(value).isNotNull()).select(*by, F.col(value).alias("__v"))
    slack = 2.0 / accuracy
    bracket = materialize(
        known.groupBy(*by).agg(
            F.percentile_approx("__v", [0.5 - slack, 0.5 + slack], accuracy).alias("__band"),
            F.count(F.lit(1)).alias("__n"),
        ),
        "bracket",
    )
    # NULL keys are groups too, so the join back must match them
    left, right = known.alias("x"), bracket.alias("y")
    on = F.lit(True)
    for c in by:
        on = on & F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}"))
    inside = F.when(F.col("__v") >= F.col("__band")[0], F.col("__v"))
    counted = (
        left.join(right, on, "inner")
        .filter(F.col("__v") <= F.col("__band")[1])
        .select(*[F.col(f"x.{c}").alias(c) for c in by], "__n", inside.alias("__v"))
        .groupBy(*by, "__n", "__v")
        .agg(F.count(F.lit(1)).alias("__k"))
    )
    # everything below the bracket is one NULL-valued row, which sorts first
    w = Window.partitionBy(*by).orderBy(F.asc_nulls_first("__v"))
    upto = F.sum("__k").over(w.rowsBetween(Window.unboundedPreceding, 0))
    lower = F.floor((F.col("__n") + 1) / 2)
    upper = F.floor(F.col("__n") / 2) + 1
    ranked = counted.withColumn("__hi", upto).withColumn("__lo", F.col("__hi") - F.col("__k"))

    def holds(rank: Column) -> Column:
        return F.when((rank > F.col("__lo")) & (rank <= F.col("__hi")), F.col("__v"))

    middle = (F.max(holds(lower)) + F.max(holds(upper))) / 2.0
    missed = F.raise_error(F.lit("the bracket missed the middle of a group")).cast("double")
    return ranked.groupBy(*by).agg(F.coalesce(middle, missed).alias(out))
