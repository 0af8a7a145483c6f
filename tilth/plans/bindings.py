"""The domain tables bound to the driver's test tables, in Spark and in SQL.

Crop and soil tables are small, synthetic and written out once; both engines
read the same literals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Synthetic crop and soil tables (not measured values).
GROWING = ("110", "122", "133", "136", "146", "147", "153", "157", "158", "162", "167")
CLASSES = ("30", "34", *GROWING, "177")
CROP_BASE = [(lc, 4.0 + i % 5) for i, lc in enumerate(CLASSES)]
CROP_STAGE = [
    (lc, seq, gdd * (10.0 + i), stage)
    for i, lc in enumerate(GROWING)
    for seq, (gdd, stage) in enumerate([(20.0, 10.0), (200.0, 21.3), (900.0, 47.9), (2500.0, 66.1), (6000.0, 89.0)])
]
CROP_HEIGHT = [
    (lc, stage, k + 0.25 * i, b + 2.0 * i)
    for i, lc in enumerate(GROWING)
    for stage, k, b in [(10.0, 2.0, 6.0), (30.0, 4.5, 14.0), (55.0, 1.5, 49.0), (89.0, 0.5, 96.0)]
]
_TRIPLET = {"c": (0.0, 0.1, 0.5), "s": (0.001, 0.004, 0.012), "l": (0.02, 0.05, 0.12), "w": (0.0, 0.1, 0.5)}
BOUNDS = [
    (lc, p, lo, seed, hi * (1.0 + 0.05 * i))
    for i, lc in enumerate((*GROWING, "177"))
    for p, (lo, seed, hi) in _TRIPLET.items()
]
#: the same with one reversed, one empty and one out-of-range triplet
RAW_BOUNDS = [
    {("122", "c"): (lc, p, hi, seed, lo), ("133", "s"): (lc, p, lo, lo, lo), ("136", "w"): (lc, p, lo, hi + 1.0, hi)}.get(
        (lc, p), (lc, p, lo, seed, hi)
    )
    for lc, p, lo, seed, hi in BOUNDS
]
TEXTURE = [
    (f"MB{i}", 5, 1.1 + 0.02 * i, 0.2 + 0.02 * i, 0.35 - 0.01 * i, 0.45 - 0.01 * i) for i in range(1, 25)
]

TABLES = {
    "crop_base": ("lc string, base double", CROP_BASE),
    "crop_stage": ("lc string, seq int, gdd double, stage double", CROP_STAGE),
    "crop_height": ("lc string, stage double, k double, b double", CROP_HEIGHT),
    "bounds": ("lc string, param string, lo double, seed double, hi double", BOUNDS),
    "raw_bounds": ("lc string, param string, lo double, seed double, hi double", RAW_BOUNDS),
    "texture": (
        "station string, depth_cm int, bulk double, sand double, silt double, clay double",
        TEXTURE,
    ),
}


def _literal(value, kind: str) -> str:
    if kind == "string":
        return f"'{value}'"
    return f"CAST({round(value, 6)!r} AS {kind.upper()})"


def literal_sql(name: str) -> str:
    """``SELECT ... FROM (VALUES ...)`` text of a small table, valid in both engines."""
    ddl, rows = TABLES[name]
    fields = [part.strip().split(" ") for part in ddl.split(",")]
    body = ", ".join(
        "(" + ", ".join(_literal(v, kind) for v, (_, kind) in zip(row, fields)) + ")" for row in rows
    )
    names = ", ".join(f for f, _ in fields)
    return f"SELECT * FROM (VALUES {body}) AS t({names})"


def small(spark: SparkSession, name: str) -> DataFrame:
    """A small table as a local relation, whose size the optimizer knows."""
    return spark.sql(literal_sql(name))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


READING_COLUMNS = [
    "event_id",
    "concat('MB', CAST(user_id % 30 + 1 AS STRING)) AS station",
    "ts AS date",
    "CASE event_type WHEN 'view' THEN 'Soil water content' WHEN 'click' THEN 'Soil temperature'"
    " WHEN 'error' THEN 'Air temperature' WHEN 'purchase' THEN 'Precipitation totals' ELSE 'Battery' END AS sensor",
    "'0 to 5 cm' AS depth",
    "CASE event_type WHEN 'view' THEN value/1000 WHEN 'click' THEN value-40 WHEN 'error' THEN value-30 ELSE value END"
    " AS value",
]

SCENE_COLUMNS = [
    "concat(CAST(l_orderkey AS STRING),'-',CAST(l_linenumber AS STRING),'-',CAST(l_partkey AS STRING),'-',"
    "CAST(l_suppkey AS STRING)) AS obs_id",
    "concat('MB', CAST(c_nationkey + 1 AS STRING)) AS station",
    "l_shipdate AS date",
    "CAST(year(l_shipdate) AS INT) AS year",
    "CAST(dayofyear(l_shipdate) AS INT) AS doy",
    "CASE l_linestatus WHEN 'O' THEN 0 ELSE 1 END AS op",
    "CAST(30 + l_linenumber AS DOUBLE) AS angle",
    "CAST(-5 AS DOUBLE) - l_quantity/5 AS vv",
    "CAST(-12 AS DOUBLE) - l_quantity/5 - 50*l_tax AS vh",
    "CASE CAST(l_partkey % 14 AS INT) "
    + " ".join(f"WHEN {i} THEN '{lc}'" for i, lc in enumerate(CLASSES[:-1]))
    + f" ELSE '{CLASSES[-1]}' END AS lc",
    "CAST(0.05 AS DOUBLE) + 4*l_discount AS ssm",
    "CAST(20 AS DOUBLE) - abs(dayofyear(l_shipdate)-200)/CAST(6 AS DOUBLE) AS mean_airt",
    "CAST(16 AS DOUBLE) - abs(dayofyear(l_shipdate)-200)/CAST(8 AS DOUBLE) AS mean_sst",
    "CAST(17 AS DOUBLE) - abs(dayofyear(l_shipdate)-200)/CAST(8 AS DOUBLE) AS sst",
]

#: stand-ins for upstream results, where an operator is shown on its own
STAGE_STAND_IN = "CASE WHEN doy % 10 = 0 THEN NULL ELSE doy/CAST(4 AS DOUBLE) END AS bbch"
FIT_STAND_IN = [
    "vv - 1.5 AS vvs",
    "CAST(0.002 AS DOUBLE) + op*0.001 + angle/CAST(10000 AS DOUBLE) AS s",
    "CAST(0.04 AS DOUBLE) + doy/CAST(10000 AS DOUBLE) AS l",
]
PRED_STAND_IN = "ssm*CAST(0.9 AS DOUBLE) + CAST(0.01 AS DOUBLE)*op AS ssm_pred"


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*READING_COLUMNS)


def scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem")
    order = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    joined = line.join(order, F.col("l_orderkey") == F.col("o_orderkey")).join(
        customer, F.col("o_custkey") == F.col("c_custkey")
    )
    return joined.selectExpr(*SCENE_COLUMNS)


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("row"), "label", F.posexplode("embedding").alias("col", "val")
    ).select("row", F.col("col").cast("bigint").alias("col"), "label", F.exp(F.col("val").cast("double")).alias("v"))


def pheno(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scenes with soil texture and a stand-in crop stage."""
    texture = small(spark, "texture").select("station", "bulk", "sand", "clay")
    return scenes(spark, sf_dir).selectExpr("*", STAGE_STAND_IN).join(texture, "station", "left")


def holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scenes with a stand-in prediction of ssm."""
    return scenes(spark, sf_dir).selectExpr("*", PRED_STAND_IN)


CTE = {
    "readings": f"SELECT {', '.join(READING_COLUMNS)} FROM events",
    "scenes": f"SELECT {', '.join(SCENE_COLUMNS)} FROM lineitem JOIN orders ON l_orderkey = o_orderkey"
    " JOIN customer ON o_custkey = c_custkey",
    "pixels": 'SELECT vec_id AS "row", generate_subscripts(embedding, 1) - 1 AS col, label,'
    " exp(CAST(unnest(embedding) AS DOUBLE)) AS v FROM embeddings",
    "pheno": f"SELECT scenes.*, {STAGE_STAND_IN}, bulk, sand, clay FROM scenes LEFT JOIN texture USING (station)",
    "holdout": f"SELECT *, {PRED_STAND_IN} FROM scenes",
    **{name: literal_sql(name) for name in TABLES},
}
#: first letters of tables that are read more than once and dear to compute
ONCE = ("wet", "ready", "coarse", "near", "fine")
NEEDS = {"pheno": ("texture", "scenes"), "holdout": ("scenes",)}


def with_tables(*names: str, **extra: str) -> str:
    """``WITH`` clause defining the named tables and any ``extra`` ones, in order; those in ``ONCE`` are kept, not expanded."""
    parts: dict[str, str] = {}
    for name in names:
        for dep in (*NEEDS.get(name, ()), name):
            parts[dep] = CTE[dep]
    parts.update(extra)
    kept = {name: " MATERIALIZED" if name.startswith(ONCE) else "" for name in parts}
    return "WITH " + ",\n".join(f"{name} AS{kept[name]} ({sql})" for name, sql in parts.items()) + "\n"
