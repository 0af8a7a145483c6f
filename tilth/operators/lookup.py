"""Piecewise-linear lookup tables: breakpoints to intervals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def intervals(points: DataFrame, key: str, x: str, ys: Sequence[str]) -> DataFrame:
    """Breakpoints ``(key, x, ys)`` to segments ``(key, x0, x1, y0, y1...)``.

    A key's breakpoints are few: they come from a hand-made table.
    """
    out = points.select(key, F.col(x).cast("double").alias("x0"), *[F.col(y).cast("double").alias(f"{y}0") for y in ys])
    w = Window.partitionBy(key).orderBy("x0")
    return (
        out.withColumn("x1", F.lead("x0").over(w))
        .withColumns({f"{y}1": F.lead(f"{y}0").over(w) for y in ys})
        .withColumn("is_first", F.row_number().over(w) == 1)
        .withColumn("is_last", F.col("x1").isNull())
    )


def non_increasing(points: DataFrame, key: str, seq: str, x: str) -> DataFrame:
    """Keys whose breakpoints do not strictly increase in table order."""
    w = Window.partitionBy(key).orderBy(seq)
    return points.withColumn("__prev", F.lag(x).over(w)).filter(F.col(x) <= F.col("__prev")).select(key).distinct()


def open_segments(points: DataFrame, key: str, x: str, ys: Sequence[str]) -> DataFrame:
    """Segments whose first and last are open-ended, for linear extrapolation.

    Keys with fewer than two points have no segment.
    """
    w = Window.partitionBy(key).orderBy("x0")
    return (
        intervals(points, key, x, ys)
        .filter(~F.col("is_last"))
        .withColumn("is_last", F.lead("x0").over(w).isNull())
    )
