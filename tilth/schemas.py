"""Column types of the tables handed from stage to stage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {
    "timestamp_ntz": T.TimestampNTZType(),
    "string": T.StringType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
}


def struct(text: str) -> T.StructType:
    """``name type, ...`` to a schema, without needing a session."""
    fields = [part.split() for part in text.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


READINGS_LONG = struct(
    "date timestamp_ntz, sensor string, value double, station string, depth string,"
    " mean_airt double, mean_sst double"
)

READINGS = struct(
    "date timestamp_ntz, station string, depth string, mean_sst double, mean_airt double,"
    " ssm double, sst double, airt double, prcp double, year int, doy int, depth_cm int,"
    " bulk double, sand double, silt double, clay double, classification string"
)

SCENES = struct(
    "date timestamp_ntz, op int, year int, doy int, station string,"
    " angle double, vv double, vh double, lc string"
)


BOUNDS = struct("lc string, param string, lo double, seed double, hi double")

#: parameters fitted by the inversion, in the order used for tie-breaking
FIT_PARAMS = ("c", "s", "l", "w")

#: measures kept from the loggers, with the sensor wording that identifies them
SENSOR_CATEGORIES = (
    ("Soil water content", "SSM"),
    ("Soil temperature", "SST"),
    ("Air temperature", "AIRT"),
    ("Precipitation totals", "PRCP"),
)

#: classes that are bare ground whatever the tables say
BARE_CLASSES = ("30", "34")


def require_columns(df: DataFrame, columns, what: str = "table") -> DataFrame:
    """Fail early, naming what is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"{what} lacks {missing}; available: {', '.join(sorted(df.columns))}")
    return df


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """Fail when the table is empty. Runs a one-row job."""
    if df.isEmpty():
        raise ValueError(message)
    return df


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Lower-case names, add absent columns as NULL, cast and order by ``schema``."""
    present = {c.lower(): c for c in df.columns}
    return df.select(
        *[
            (F.col(present[f.name]) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )
