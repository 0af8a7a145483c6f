"""The stages from raw files to scored models.

Stages hand over written tables (see :func:`tilth.session.materialize`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilth.functions.columns import mean_ignoring_null, to_number
from tilth.operators import phenology, readings, scenes, timeseries
from tilth.operators.inversion import derive_bounds, invert_once
from tilth.operators.modelling import train_targets, tree_table_export
from tilth.schemas import READINGS, READINGS_LONG, SCENES, conform
from tilth.session import materialize
from tilth.sources.csv_lines import StationFiles, read_scene_csv
from tilth.sources.sinks import (
    IterationStore,
    attach_manifest,
    latest_manifest,
    table_digest,
    write_model,
    write_stage,
)

MEASURES = ("SSM", "SST", "AIRT", "PRCP")


def wide_readings(cells: DataFrame, columns: DataFrame | None = None) -> DataFrame:
    """Logger cells to one row per (station, date) with ssm, sst, airt, prcp.

    ``columns`` (file, station, col_pos, column) is what the files' headers
    tell; without it the cells are searched for their columns. The columns
    that count are written (runs a job): a few rows per file, joined to the
    cells where they are.
    """
    layout = columns if columns is not None else cells.select("file", "station", "column", "col_pos").distinct()
    chosen = materialize(readings.classify_columns(layout, by=["file", "station"]), "columns")
    values = cells.join(chosen.select("file", "col_pos", "category"), on=["file", "col_pos"], how="left")
    instants = values.select("station", F.col("ts").alias("date"), "category", to_number("raw").alias("value"))
    # cells of other columns keep their instant's row
    return instants.groupBy("station", "date").pivot("category", list(MEASURES)).agg(F.avg("value")).select(
        "station", "date", *[F.col(m).alias(m.lower()) for m in MEASURES]
    )


def long_readings(wide: DataFrame) -> DataFrame:
    """Daily midranges, then fills, then one row per (date, sensor).

    Midranges come from the readings as measured; filled values do not enter.
    """
    daily = timeseries.daily_midrange(wide, {"mean_airt": "airt", "mean_sst": "sst"}, ts="date")
    filled = materialize(timeseries.fill_forward_backward(wide, ["ssm", "sst", "airt", "prcp"]), "filled")
    melted = readings.melt_wide_to_long(filled)
    return conform(timeseries.attach_daily_stats(melted, daily), READINGS_LONG)


def load_readings(long: DataFrame, texture: DataFrame, depth: str = readings.SHALLOW_LABEL) -> DataFrame:
    """Long readings to the wide stage table with calendar columns and soil texture.

    Daily means are interpolated per station over its instants.
    """
    kept = readings.categorize_sensor(readings.filter_depth(long, depth))
    keys = ["date", "station", "depth"]
    wide = readings.pivot_long_to_wide(kept, keys, MEASURES, carried=["mean_sst", "mean_airt"])
    wide = timeseries.interpolate_linear(materialize(wide, "wide"), ["mean_airt", "mean_sst"])
    wide = readings.calendar_columns(wide)
    return conform(readings.join_texture(wide, texture), READINGS)


def load_scenes(long: DataFrame, bands: Sequence[str] = ("VV", "VH", "angle", "landcover")) -> DataFrame:
    """Scene cells to the stage table, one row per station, date and pass."""
    wide = scenes.pivot_bands_mean(scenes.drop_meta_bands(long), bands)
    return conform(scenes.cast_crop(wide), SCENES)


def phenology_table(
    scene_table: DataFrame,
    reading_table: DataFrame,
    base: DataFrame,
    stages: DataFrame,
    by: Sequence[str] = ("year",),
    ids: Sequence[str] | None = ("station", "op"),
    tolerance_seconds: int = 7200,
) -> DataFrame:
    """Scenes with the nearest readings, degree sums, crop stage and moisture sum."""
    merged = timeseries.asof_nearest(scene_table, reading_table, tolerance_seconds=tolerance_seconds)
    merged = phenology.dropna_subset(readings.calendar_columns(merged))
    merged = timeseries.interpolate_linear(materialize(merged, "merged"), "sst", ids=ids)
    return growth(materialize(merged, "continuous"), base, stages, by, ids)


def growth(
    df: DataFrame,
    base: DataFrame,
    stages: DataFrame,
    by: Sequence[str] = ("year",),
    ids: Sequence[str] | None = ("obs_id",),
) -> DataFrame:
    """Base temperature, running sums and stage for scenes that already carry readings."""
    summed = phenology.cumulative_all(phenology.lookup_base_temp(df, base), by=by, ids=ids)
    return phenology.stage_from_gdd(
        summed.withColumn("cum_gdd", mean_ignoring_null("cum_gdd_air", "cum_gdd_soil")), stages
    )


def iterative_refinement(
    pheno: DataFrame,
    height: DataFrame,
    bounds: DataFrame,
    iterations: int,
    store: IterationStore,
    resume: bool = True,
    f_ghz: float = 5.4,
    model: str = "SPM",
    levels: int = 3,
    refinements: int = 1,
) -> DataFrame:
    """Passes over the same input, each within the bounds the pass before it found.

    Every pass is written and read back, which cuts the lineage and lets a
    later run over the same tables resume after the last finished pass.
    Returns the last result. The input is written first: digest and passes
    read it instead of joining it anew, and the joins don't share one
    compiled method with the search's inputs, which would outgrow the 8000
    bytes that the JVM compiles.
    """
    if iterations < 1:
        raise ValueError("iterations must be at least 1")
    pheno = materialize(pheno, "pheno")
    store.begin(table_digest(pheno, height, bounds) + f"-{f_ghz}-{model}-{levels}-{refinements}", resume)
    results, done = None, store.latest(iterations)
    base, current = bounds, bounds
    if done is not None:
        results, current = store.restore(done, base)
    for i in range((done or 0) + 1, iterations + 1):
        results = store.write(i, invert_once(pheno, height, current, f_ghz, model, levels, refinements))
        current = store.write_bounds(i, derive_bounds(results, current))
        store.finish(i, iterations)
    return results


def run_to_phenology(
    spark: SparkSession, station_files: str, scene_files: str, texture: DataFrame, crop_tables: dict
) -> DataFrame:
    """Raw files to the phenology table."""
    loggers = StationFiles(spark, station_files)
    wide = materialize(wide_readings(loggers.cells(), loggers.columns()), "instants")
    reading_table = materialize(load_readings(long_readings(wide), texture), "readings")
    scene_table = materialize(load_scenes(read_scene_csv(spark, scene_files)), "scenes")
    return phenology_table(scene_table, reading_table, crop_tables["base"], crop_tables["stages"])


def run_to_models(
    pheno: DataFrame,
    crop_tables: dict,
    store: IterationStore,
    out: str,
    targets: Sequence[str] = ("SSM", "vvs", "s"),
    iterations: int = 1,
    holdout_by_year: bool = True,
) -> dict[str, DataFrame]:
    """From the phenology table to stored forests. Returns the metrics of each target.

    Below ``out``: the refined table, and for each target its model, the rows held
    out with their predictions, the trees as text (Parquet and CSV), and its
    metrics with the checkpoint they rest on.
    """
    spark = pheno.sparkSession
    results = iterative_refinement(pheno, crop_tables["heights"], crop_tables["bounds"], iterations, store)
    write_stage(results, f"{out}/inversion")
    manifest = latest_manifest(spark, store.root)
    metrics = {}
    for target, fit in train_targets(spark.read.parquet(f"{out}/inversion"), targets, holdout_by_year).items():
        folder = f"{out}/{target.lower()}"
        write_model(fit["model"], f"{folder}/model")
        write_stage(fit["holdout"], f"{folder}/holdout")
        trees = tree_table_export(spark, fit["model"])
        write_stage(trees, f"{folder}/trees")
        write_stage(trees, f"{folder}/trees_csv", fmt="csv")
        write_stage(attach_manifest(fit["metrics"], manifest), f"{folder}/metrics")
        metrics[target] = spark.read.parquet(f"{folder}/metrics")
    return metrics
