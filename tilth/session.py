"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "tilth", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are tuned for.

    Partition counts are left to the cluster's own defaults and to adaptive
    execution; pass ``spark.sql.shuffle.partitions`` to override.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    A machine-local folder is made only where driver and executors are one
    process and none is set, as in tests.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="tilth-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the scratch folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def delete_at_end(spark: SparkSession, path: str) -> None:
    """The session owns what lies there and removes it when it ends."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write the table to the scratch folder and return it as read back.

    Runs the job; the files go when the session ends. Ordered operators read their input several times; cutting
    the lineage between them keeps plans small and lets a lost executor cost
    one stage rather than the whole chain.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    delete_at_end(df.sparkSession, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
