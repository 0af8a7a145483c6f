"""Small tables: station catalogue, soil texture and crop parameters from JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tilth.operators.inversion import validate_bounds
from tilth.operators.lookup import non_increasing
from tilth.schemas import FIT_PARAMS


def select_datasets(
    catalogue: DataFrame,
    stations: DataFrame,
    parameters: Sequence[str],
    sensors: Sequence[str] | str | None = None,
    depths: Sequence[str] | None = None,
) -> DataFrame:
    """Datasets of the wanted parameters, kinds and depths at the requested stations."""
    out = catalogue.filter(F.col("param_name").isin(*parameters))
    if sensors is not None:
        out = out.filter(F.col("sensor").isin(*([sensors] if isinstance(sensors, str) else sensors)))
    if depths is not None:
        out = out.filter(F.col("depth").isin(*depths))
    return out.join(stations.select("station"), on="station", how="left_semi")


def _json_files(spark: SparkSession, path: str, text: str = "json") -> DataFrame:
    """Whole JSON documents, one row each; these are hand-made parameter files."""
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", text)


def texture_rows(documents: DataFrame, depth_cm: int = 5, json: str = "json") -> DataFrame:
    """``station -> [{depth_cm, density, sand, silt, clay, class}]`` as rows of one depth."""
    entry = (
        "map<string,array<struct<depth_cm:int,density_gcm3:double,sand_pct:double,"
        "silt_pct:double,clay_pct:double,classification:string>>>"
    )
    stations = documents.select(F.explode(F.from_json(json, entry)).alias("station", "layers"))
    layer = stations.select("station", F.explode("layers").alias("x")).select("station", "x.*")
    return layer.filter(F.col("depth_cm") == depth_cm).select(
        "station",
        "depth_cm",
        F.col("density_gcm3").alias("bulk"),
        (F.col("sand_pct") / 100).alias("sand"),
        (F.col("silt_pct") / 100).alias("silt"),
        (F.col("clay_pct") / 100).alias("clay"),
        "classification",
    )


def read_texture_json(spark: SparkSession, path: str, depth_cm: int = 5) -> DataFrame:
    return texture_rows(_json_files(spark, path), depth_cm)


def base_rows(documents: DataFrame, json: str = "json") -> DataFrame:
    """``crop -> temperature`` as ``(lc, base)``."""
    return documents.select(F.explode(F.from_json(json, "map<string,double>")).alias("lc", "base"))


def stage_rows(documents: DataFrame, json: str = "json") -> DataFrame:
    """``crop -> [[gdd, stage]...]`` as ``(lc, seq, gdd, stage)``."""
    crops = documents.select(F.explode(F.from_json(json, "map<string,array<array<double>>>")).alias("lc", "points"))
    return crops.select("lc", F.posexplode("points").alias("seq", "p")).select(
        "lc", "seq", F.get("p", F.lit(0)).alias("gdd"), F.get("p", F.lit(1)).alias("stage")
    )


def height_rows(documents: DataFrame, json: str = "json") -> DataFrame:
    """``crop -> {bbch_k_b: [[stage, k, b]...]}`` as ``(lc, seq, stage, k, b)``."""
    crops = documents.select(
        F.explode(F.from_json(json, "map<string,struct<bbch_k_b:array<array<double>>>>")).alias("lc", "c")
    )
    return crops.select("lc", F.posexplode("c.bbch_k_b").alias("seq", "p")).select(
        "lc",
        "seq",
        F.get("p", F.lit(0)).alias("stage"),
        F.get("p", F.lit(1)).alias("k"),
        F.get("p", F.lit(2)).alias("b"),
    )


def bounds_rows(documents: DataFrame, json: str = "json") -> DataFrame:
    """``crop -> {cbound: [lo, seed, hi], ...}`` as validated ``(lc, param, lo, seed, hi)``.

    A triplet of another length fails the job.
    """
    fields = ",".join(f"{p}bound:array<double>" for p in FIT_PARAMS)
    crops = documents.select(F.explode(F.from_json(json, f"map<string,struct<{fields}>>")).alias("lc", "b"))
    triplets = F.array(
        *[F.struct(F.lit(p).alias("param"), F.col(f"b.{p}bound").alias("t")) for p in FIT_PARAMS]
    )

    def side(i: int) -> Column:
        wrong = F.raise_error(F.concat(F.lit("bounds need [lo, seed, hi]: "), F.col("lc"))).cast("double")
        return F.when(F.size("t") != 3, wrong).otherwise(F.get("t", F.lit(i)))

    rows = crops.select("lc", F.inline(triplets)).filter("t is not null")
    return validate_bounds(
        rows.select("lc", "param", side(0).alias("lo"), side(1).alias("seed"), side(2).alias("hi"))
    )


def read_bounds_json(spark: SparkSession, path: str) -> DataFrame:
    return bounds_rows(_json_files(spark, path))


def rising(points: DataFrame, key: str = "lc", seq: str = "seq", x: str = "gdd") -> DataFrame:
    """The breakpoints, or an error that names a key whose breakpoints do not rise. Runs a job."""
    bad = non_increasing(points, key, seq, x).first()
    if bad is not None:
        raise ValueError(f"breakpoints of {key} {bad[0]!r} do not rise in {x}")
    return points


def read_crop_tables(spark: SparkSession, base: str, stages: str, heights: str, bounds: str) -> dict[str, DataFrame]:
    """The four crop tables from their JSON files; breakpoints must rise (runs a job)."""
    return {
        "base": base_rows(_json_files(spark, base)),
        "stages": rising(stage_rows(_json_files(spark, stages))),
        "heights": height_rows(_json_files(spark, heights)),
        "bounds": read_bounds_json(spark, bounds),
    }
