"""Writers between stages: incremental station tables, stage tables, checkpoints, models."""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilth.operators.inversion import derive_bounds, merge_bounds
from tilth.schemas import BOUNDS, conform, struct
from tilth.session import materialize


def _gone(missing: AnalysisException) -> bool:
    return any(mark in (missing.getCondition() or "") for mark in ("PATH_NOT_FOUND", "UNABLE_TO_INFER"))


def _read_or_none(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as missing:
        if _gone(missing):
            return None
        raise


def absent_stations(df: DataFrame, existing: DataFrame) -> DataFrame:
    """Rows of stations that ``existing`` does not have yet."""
    return df.join(existing.select("station").distinct(), on="station", how="left_anti")


def write_new_stations(df: DataFrame, path: str) -> None:
    """Append the stations not yet complete below ``path``, one partition folder per station.

    A station counts as present once it stands in ``_complete``, written after the
    data: what a lost job left of a station is written anew in its place. Rows are
    dealt out by station first, large stations to several tasks and small ones
    together, so files follow stations and size, not the number of input splits.
    """
    spark = df.sparkSession
    done = _read_or_none(spark, f"{path}/_complete", struct("station string"))
    # written once: an input that changes in between can't mark stations complete that were not written
    new = materialize(df if done is None else absent_stations(df, done), "new-stations")
    writer = new.hint("rebalance", "station").write.partitionBy("station").mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)
    stations = new.select(F.col("station").cast("string").alias("station")).distinct()
    stations.write.mode("append").parquet(f"{path}/_complete")


def write_stage(df: DataFrame, path: str, schema: T.StructType | None = None, fmt: str = "parquet") -> None:
    out = df if schema is None else conform(df, schema)
    writer = out.write.mode("overwrite")
    (writer.option("header", "true") if fmt == "csv" else writer).format(fmt).save(path)


def read_stage(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """A stage's table, or an error that says which stage must run first."""
    reader = spark.read.schema(schema).format(fmt)
    try:
        return (reader.option("header", "true") if fmt == "csv" else reader).load(path)
    except AnalysisException as missing:
        if not _gone(missing):
            raise
        raise FileNotFoundError(f"no stage table at {path}; run the stage that writes it first") from missing


# -- inversion checkpoints -------------------------------------------------


def configuration(f_ghz: float, acf: str, models: dict) -> str:
    """What a fit depends on besides its tables: one ``name=value`` line each, in order of name."""
    lines = {"acf": acf, "frequency_ghz": float(f_ghz), **{f"model.{k}": v for k, v in models.items()}}
    return "\n".join(f"{k}={lines[k]}" for k in sorted(lines))


def checkpoint_id(f_ghz: float, acf: str, models: dict) -> str:
    """Folder name of a configuration: its digest."""
    return "config-" + hashlib.sha256(configuration(f_ghz, acf, models).encode()).hexdigest()[:12]


def table_digest(*tables: DataFrame) -> str:
    """Digest of the rows of each table, whatever their order. Runs one aggregate for each."""
    seen = []
    for t in tables:
        row = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(t.columns)]).cast("decimal(38,0)")
        seen.append([str(v) for v in t.agg(F.count(F.lit(1)), F.sum(row)).first()])
    return hashlib.sha256(json.dumps(seen).encode()).hexdigest()[:16]


class IterationStore:
    """Results and bounds of each pass below ``root/<checkpoint id>/<run>``.

    A run belongs to one input. Starting one writes the mark that names it and
    its input's digest, before any pass: a job lost half-way, a run that starts
    anew and a changed input can never find the passes of another run. A pass
    counts once its row in ``passes`` is written, after its tables.
    """

    def __init__(self, spark: SparkSession, root: str, f_ghz: float, acf: str, models: dict):
        self.spark, self.root = spark, root.rstrip("/")
        self.configuration = configuration(f_ghz, acf, models)
        self.identifier = checkpoint_id(f_ghz, acf, models)
        self.home, self.folder = f"{self.root}/{self.identifier}", None

    def begin(self, digest: str, resume: bool = True) -> None:
        """Goes on with the marked run if it had the same input, else starts a new one."""
        marked = _read_or_none(self.spark, f"{self.home}/mark", struct("run string, digest string"))
        mark = marked.first() if marked is not None else None
        if not (resume and mark is not None and mark.digest == digest):
            run = f"run-{uuid.uuid4().hex[:12]}"
            row = self.spark.range(1).select(F.lit(run).alias("run"), F.lit(digest).alias("digest"))
            row.write.mode("overwrite").parquet(f"{self.home}/mark")
        else:
            run = mark.run
        self.folder = f"{self.home}/{run}"

    def write(self, iteration: int, results: DataFrame) -> DataFrame:
        """Write a pass's results and return them as read back, free of lineage."""
        path = f"{self.folder}/results/iter={iteration}"
        results.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(results.schema).parquet(path)

    def write_bounds(self, iteration: int, bounds: DataFrame) -> DataFrame:
        path = f"{self.folder}/bounds/iter={iteration}"
        conform(bounds, BOUNDS).write.mode("overwrite").parquet(path)
        return self.spark.read.schema(BOUNDS).parquet(path)

    def finish(self, iteration: int, requested: int) -> None:
        done = self.spark.range(1).select(F.lit(iteration).alias("iteration"))
        done.write.mode("append").parquet(f"{self.folder}/passes")
        row = self.spark.range(1).select(
            F.lit(self.identifier).alias("identifier"),
            F.lit(self.configuration).alias("configuration"),
            F.lit(self.folder).alias("folder"),
            F.lit(iteration).alias("iteration"),
            F.lit(requested).alias("passes_asked"),
            F.current_timestamp().alias("finished"),
        )
        row.write.mode("overwrite").json(f"{self.root}/latest")

    def latest(self, at_most: int) -> int | None:
        """Highest finished pass of the run not above ``at_most``."""
        passes = _read_or_none(self.spark, f"{self.folder}/passes", struct("iteration int"))
        if passes is None:
            return None
        return passes.filter(F.col("iteration") <= at_most).agg(F.max("iteration")).first()[0]

    def restore(self, iteration: int, base_bounds: DataFrame) -> tuple[DataFrame, DataFrame]:
        """A pass's results and bounds; bounds are derived again when their table is gone."""
        results = self.spark.read.parquet(f"{self.folder}/results/iter={iteration}")
        stored = _read_or_none(self.spark, f"{self.folder}/bounds/iter={iteration}")
        bounds = derive_bounds(results, base_bounds) if stored is None else merge_bounds(stored, base_bounds)
        return results, bounds


def latest_manifest(spark: SparkSession, root: str) -> DataFrame | None:
    """The one-row manifest of the last finished pass; None when absent or unreadable."""
    try:
        manifest = spark.read.json(f"{root.rstrip('/')}/latest")
    except AnalysisException:
        return None
    return manifest if "iteration" in manifest.columns else None


def attach_manifest(metrics: DataFrame, manifest: DataFrame | None) -> DataFrame:
    """Metrics rows with the checkpoint they were trained from; unchanged without one."""
    row = manifest.first() if manifest is not None else None
    if row is None:
        return metrics
    return metrics.withColumns({f"checkpoint_{c}": F.lit(row[c]) for c in ("identifier", "iteration")})


# -- models ----------------------------------------------------------------


def write_model(model: RandomForestRegressionModel, path: str) -> None:
    model.write().overwrite().save(path)


def read_model(path: str) -> RandomForestRegressionModel:
    return RandomForestRegressionModel.load(path)


def read_nodes(spark: SparkSession, path: str) -> DataFrame:
    """A stored forest as node rows (see ``operators/forest.py``), read from its files without loading the model.

    ``n`` counts the bootstrapped training rows in a node. Splits by category have no
    threshold and are refused.
    """
    split = F.col("nodeData.split")
    inner = F.col("nodeData.leftChild") >= 0
    refused = F.raise_error(F.lit("a split by category has no threshold"))
    threshold = F.when(split["numCategories"] >= 0, refused.cast("double")).otherwise(split["leftCategoriesOrThreshold"][0])
    return spark.read.parquet(f"{path.rstrip('/')}/data").select(
        F.col("treeID").alias("tree"),
        F.col("nodeData.id").alias("node"),
        F.when(inner, split["featureIndex"]).alias("feature"),
        F.when(inner, threshold).alias("threshold"),
        F.when(inner, F.col("nodeData.leftChild")).alias("left"),
        F.when(inner, F.col("nodeData.rightChild")).alias("right"),
        F.col("nodeData.prediction").alias("value"),
        F.col("nodeData.rawCount").alias("n"),
    )
