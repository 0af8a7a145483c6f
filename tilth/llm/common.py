"""What the operators share: columns by name, written tables, Arrow helpers."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilth.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names; other columns can't clash.

    Rows without an id (the first column) name no document and are left out.
    """
    out = df.select(*[df[old].alias(new) for new, old in columns.items()])
    return out.where(F.col(next(iter(columns))).isNotNull())


def written(df: DataFrame, name: str) -> DataFrame:
    """Runs the job, keeps its rows below the shared scratch folder until the session ends, and reads them back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def forget(df: DataFrame) -> None:
    """Removes what ``written`` keeps of a table that nothing reads any more."""
    spark = df.sparkSession
    target = spark._jvm.org.apache.hadoop.fs.Path(df.written_to)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def raw(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, empty for null."""
    return [b if b is not None else b"" for b in column.cast(pa.binary()).to_pylist()]


def blob(array: np.ndarray) -> bytes:
    return np.ascontiguousarray(array).tobytes()


def batches(rows: Iterable[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Record batches of at most ``size`` rows."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
