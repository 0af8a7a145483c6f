"""Queries over phenology and the inversion."""

from __future__ import annotations

from pyspark.sql import functions as F

from tilth.operators import inversion as inv
from tilth.operators import phenology as ph
from tilth.operators.timeseries import asof_nearest
from tilth.plans import bindings as b
from tilth.plans.bindings import with_tables
from tilth.plans.pipeline import iterative_refinement
from tilth.plans.registry import query, rounded
from tilth.session import scratch_path
from tilth.sources.sinks import IterationStore, attach_manifest, latest_manifest

# -- phenology -------------------------------------------------------------


@query(
    "asof_nearest_join",
    with_tables(
        "readings",
        l="SELECT event_id, station, date, value FROM readings",
        r="SELECT station, date AS rdate, value AS airt FROM readings WHERE sensor = 'Air temperature'",
    )
    + """, near AS (SELECT l.event_id, r.airt, row_number() OVER (PARTITION BY l.event_id
            ORDER BY abs(epoch_us(l.date) - epoch_us(r.rdate)), r.rdate) AS rn
          FROM l JOIN r ON l.station = r.station AND abs(epoch_us(l.date) - epoch_us(r.rdate)) <= 7200000000)
      SELECT l.event_id, l.station, l.date, round(l.value, 6) AS value, round(n.airt, 6) AS airt
      FROM l LEFT JOIN near n ON l.event_id = n.event_id AND n.rn = 1""",
)
def asof_nearest_join(spark, sf_dir):
    readings = b.readings(spark, sf_dir)
    left = readings.select("event_id", "station", "date", "value")
    right = readings.filter("sensor = 'Air temperature'").selectExpr("event_id AS rid", "station", "date", "value AS airt")
    out = asof_nearest(left, right, right_ids=["rid"])
    return rounded(out.select("event_id", "station", "date", "value", "airt"))


@query(
    "dropna_subset",
    with_tables("scenes")
    + """SELECT obs_id, round(vv, 6) AS vv, round(vh, 6) AS vh, round(angle, 6) AS angle FROM scenes
      WHERE doy % 5 <> 0 AND angle <> 33""",
)
def dropna_subset(spark, sf_dir):
    gappy = b.scenes(spark, sf_dir).select(
        "obs_id",
        F.when(F.col("doy") % 5 != 0, F.col("vv")).alias("vv"),
        "vh",
        F.when(F.col("angle") != 33, F.col("angle")).alias("angle"),
    )
    return rounded(ph.dropna_subset(gappy))


@query(
    "lookup_base_temp",
    with_tables("scenes", "crop_base")
    + """SELECT obs_id, s.lc, round(base, 6) AS base_temp FROM (SELECT obs_id, CASE WHEN op = 0 AND doy % 50 = 0 THEN '999' ELSE lc END AS lc
        FROM scenes) s LEFT JOIN crop_base c ON s.lc = c.lc""",
)
def lookup_base_temp(spark, sf_dir):
    scenes = b.scenes(spark, sf_dir).select(
        "obs_id", F.when((F.col("op") == 0) & (F.col("doy") % 50 == 0), "999").otherwise(F.col("lc")).alias("lc")
    )
    return rounded(ph.lookup_base_temp(scenes, b.small(spark, "crop_base")).select("obs_id", "lc", "base_temp"))


# Rows of one day are taken in the order of a hash of their id, on both sides.
RUNNING = "OVER (PARTITION BY year ORDER BY date, md5(obs_id) ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
#: every seventh day of the year lacks an air temperature
GAPPY_SQL = "SELECT * REPLACE (CASE WHEN doy % 7 = 0 THEN NULL ELSE mean_airt END AS mean_airt) FROM scenes"
DEGREES_SQL = (
    "SELECT gappy.*, base AS base_temp, CASE WHEN mean_airt > base THEN mean_airt - base WHEN mean_airt IS NOT NULL THEN 0 END AS ga,"
    " CASE WHEN mean_sst > base THEN mean_sst - base ELSE 0 END AS gs FROM gappy JOIN crop_base USING (lc)"
)
SUMMED_SQL = (
    f"SELECT *, CASE WHEN ga IS NOT NULL THEN sum(ga) {RUNNING} END AS cum_gdd_air, sum(gs) {RUNNING} AS cum_gdd_soil,"
    f" sum(ssm) {RUNNING} AS cum_ssm FROM degrees"
)
GROWTH_TABLES = dict(gappy=GAPPY_SQL, degrees=DEGREES_SQL, summed=SUMMED_SQL)
STAGE_TABLES = dict(
    seg="SELECT lc, gdd AS g0, stage AS b0, lead(gdd) OVER w AS g1, lead(stage) OVER w AS b1,"
    " row_number() OVER w = 1 AS is_first FROM crop_stage WINDOW w AS (PARTITION BY lc ORDER BY gdd)",
)


def stage_sql(source: str) -> str:
    return (
        f"SELECT s.*, CASE WHEN s.cum_gdd IS NULL OR s.sst IS NULL OR g.lc IS NULL THEN NULL"
        " WHEN g.is_first AND s.cum_gdd < g.g0 THEN 0 WHEN g.g1 IS NULL THEN g.b0"
        " WHEN s.sst >= 0 THEN round_even(g.b0 + (s.cum_gdd - g.g0)/(g.g1 - g.g0)*(g.b1 - g.b0), 0) END AS bbch"
        f" FROM {source} s LEFT JOIN seg g ON s.lc = g.lc AND ((g.is_first AND s.cum_gdd < g.g0)"
        " OR (g.g1 IS NULL AND s.cum_gdd >= g.g0) OR (s.cum_gdd >= g.g0 AND s.cum_gdd < g.g1))"
    )


def gappy_scenes(spark, sf_dir):
    return b.scenes(spark, sf_dir).withColumn("mean_airt", F.when(F.col("doy") % 7 != 0, F.col("mean_airt")))


@query(
    "cumulative_gdd",
    with_tables("scenes", "crop_base", **GROWTH_TABLES)
    + "SELECT obs_id, year, round(cum_gdd_air, 6) AS cum_gdd_air, round(cum_gdd_soil, 6) AS cum_gdd_soil FROM summed",
)
def cumulative_gdd(spark, sf_dir):
    # running sums write their input, so only what is needed goes in
    read = gappy_scenes(spark, sf_dir).select("obs_id", "year", "date", "lc", "mean_airt", "mean_sst")
    summed = ph.cumulative_gdd(ph.lookup_base_temp(read, b.small(spark, "crop_base")))
    return rounded(summed.select("obs_id", "year", "cum_gdd_air", "cum_gdd_soil"))


@query(
    "mean_of_two_ignore_null",
    with_tables("scenes", gappy=GAPPY_SQL)
    + """SELECT obs_id, round(coalesce((a + s)/2, a, s), 6) AS cum_gdd FROM (
        SELECT obs_id, mean_airt AS a, CASE WHEN doy % 14 = 0 THEN NULL ELSE mean_sst END AS s FROM gappy)""",
)
def mean_of_two_ignore_null(spark, sf_dir):
    two = gappy_scenes(spark, sf_dir).withColumn("mean_sst", F.when(F.col("doy") % 14 != 0, F.col("mean_sst")))
    return rounded(ph.mean_of_two_ignore_null(two, "mean_airt", "mean_sst").select("obs_id", "cum_gdd"))


@query(
    "stage_from_gdd",
    with_tables(
        "scenes",
        "crop_stage",
        rated="SELECT *, CASE WHEN doy % 11 = 0 THEN NULL ELSE doy*180 + angle END AS cum_gdd FROM scenes",
        **STAGE_TABLES,
        staged=stage_sql("rated"),
    )
    + "SELECT obs_id, lc, round(bbch, 6) AS bbch FROM staged",
)
def stage_from_gdd(spark, sf_dir):
    """Degree sums from a stand-in that reaches all cases, cold soil included."""
    rated = b.scenes(spark, sf_dir).withColumn(
        "cum_gdd", F.when(F.col("doy") % 11 != 0, F.col("doy") * 180 + F.col("angle"))
    )
    return rounded(ph.stage_from_gdd(rated, b.small(spark, "crop_stage")).select("obs_id", "lc", "bbch"))


@query(
    "cumulative_ssm",
    with_tables(
        "scenes",
        partial="SELECT obs_id, station, year, date, CASE WHEN angle = 35 THEN NULL ELSE ssm END AS ssm FROM scenes",
    )
    + """SELECT obs_id, station, year, CASE WHEN ssm IS NOT NULL THEN round(sum(ssm) OVER (PARTITION BY station, year
        ORDER BY date, md5(obs_id) ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) END AS cum_ssm FROM partial""",
)
def cumulative_ssm(spark, sf_dir):
    some = b.scenes(spark, sf_dir).select(
        "obs_id", "station", "year", "date", F.when(F.col("angle") != 35, F.col("ssm")).alias("ssm")
    )
    out = ph.cumulative_ssm(some, by=["station", "year"])
    return rounded(out.select("obs_id", "station", "year", "cum_ssm"))


# -- inversion -------------------------------------------------------------

RVI_SQL = (
    "SELECT *, pow(10, vv/10) AS vv_p, pow(10, vh/10) AS vh_p, 4*pow(10, vh/10)/(pow(10, vv/10) + pow(10, vh/10)) AS rvi FROM {src}"
)
HEIGHT_SEG_SQL = (
    "SELECT * FROM (SELECT lc, stage AS x0, k AS k0, b AS b0, lead(stage) OVER w AS x1, lead(k) OVER w AS k1, lead(b) OVER w AS b1,"
    " row_number() OVER w = 1 AS is_first, row_number() OVER (PARTITION BY lc ORDER BY stage DESC) = 2 AS is_last"
    " FROM crop_height WINDOW w AS (PARTITION BY lc ORDER BY stage)) WHERE x1 IS NOT NULL"
)


def height_sql(source: str) -> str:
    return (
        "SELECT *, CASE WHEN raw < 0 THEN 0 ELSE raw END AS height FROM (SELECT *, (k*rvi + b)/100 AS raw FROM ("
        "SELECT s.*, k0 + (bbch - x0)/(x1 - x0)*(k1 - k0) AS k, b0 + (bbch - x0)/(x1 - x0)*(b1 - b0) AS b"
        f" FROM {source} s LEFT JOIN hseg h ON s.lc = h.lc AND (h.is_first OR s.bbch >= h.x0) AND (h.is_last OR s.bbch < h.x1)"
        " AND s.bbch IS NOT NULL))"
    )


@query(
    "radar_vegetation_index",
    with_tables("scenes", r=RVI_SQL.format(src="(SELECT * REPLACE (CASE WHEN doy % 8 = 0 THEN NULL ELSE vh END AS vh) FROM scenes)"))
    + "SELECT obs_id, round(vv_p, 6) AS vv_p, round(vh_p, 6) AS vh_p, round(rvi, 6) AS rvi FROM r",
)
def radar_vegetation_index(spark, sf_dir):
    scenes = b.scenes(spark, sf_dir).withColumn("vh", F.when(F.col("doy") % 8 != 0, F.col("vh")))
    return rounded(inv.radar_vegetation_index(scenes).select("obs_id", "vv_p", "vh_p", "rvi"))


@query(
    "crop_height",
    with_tables("pheno", "crop_height", r=RVI_SQL.format(src="pheno"), hseg=HEIGHT_SEG_SQL, h=height_sql("r"))
    + """SELECT obs_id, lc, round(k, 6) AS k, round(b, 6) AS b, round(height, 6) AS height,
        CASE WHEN height IS NOT NULL THEN round(greatest(height - 0.001, 0), 6) END AS height_lo, round(height + 0.001, 6) AS height_hi FROM h""",
)
def crop_height(spark, sf_dir):
    rated = inv.radar_vegetation_index(b.pheno(spark, sf_dir))
    out = inv.crop_height(rated, b.small(spark, "crop_height"))
    return rounded(out.select("obs_id", "lc", "k", "b", "height", "height_lo", "height_hi"))


@query(
    "route_bare_or_crop",
    with_tables("scenes", "crop_height", "bounds")
    + """SELECT obs_id, lc, CASE WHEN lc IN ('30', '34') OR lc NOT IN (SELECT lc FROM crop_height)
        OR lc NOT IN (SELECT lc FROM bounds) THEN 'bare' ELSE 'crop' END AS route FROM scenes""",
)
def route_bare_or_crop(spark, sf_dir):
    scenes = b.scenes(spark, sf_dir).select("obs_id", "lc")
    return inv.route_bare_or_crop(scenes, b.small(spark, "crop_height"), b.small(spark, "bounds"))


SIDES = [(p, side) for p in ("c", "s", "l", "w") for side in ("lo", "seed", "hi")]
BOUNDS_WIDE = "SELECT lc, " + ", ".join(
    f"max(CASE WHEN param = '{p}' THEN {side} END) AS {p}_{side}" for p, side in SIDES
)


@query(
    "bounds_lookup",
    with_tables("scenes", "bounds", bw=BOUNDS_WIDE + " FROM bounds GROUP BY lc")
    + f"SELECT obs_id, scenes.lc, {', '.join(f'round({p}_{s}, 6) AS {p}_{s}' for p, s in SIDES)} FROM scenes LEFT JOIN bw USING (lc)",
)
def bounds_lookup(spark, sf_dir):
    return rounded(inv.bounds_lookup(b.scenes(spark, sf_dir).select("obs_id", "lc"), b.small(spark, "bounds")))


# Fixed values of the closed forms, as in the cited papers.
K = "(2*pi()*5.4e9/299792458)"
EPS_SQL = (
    "CASE WHEN mixed > 0 THEN pow(mixed, 1/0.65e0) END AS eps FROM (SELECT *, 1 + bulk/2.66e0*(pow(pow(1.01e0 + 0.44e0*2.66e0, 2) - 0.062e0, 0.65e0) - 1)"
    " + pow(ssm, 1.2748e0 - 0.519e0*sand - 0.152e0*clay)*pow(water, 0.65e0) - ssm AS mixed FROM (SELECT *,"
    " 4.9e0 + (88.045e0 - 0.4147e0*sst + 6.295e-4*sst*sst + 1.075e-5*sst*sst*sst - 4.9e0)/(1 + pow((1.1109e-10 - 3.824e-12*sst"
    " + 6.938e-14*sst*sst - 5.096e-16*sst*sst*sst)*5.4e9, 2)) AS water FROM {src}))"
)


def spm_sql(s: str, length: str) -> str:
    sin2, root = "pow(sin(radians(angle)), 2)", "sqrt(eps - pow(sin(radians(angle)), 2))"
    alpha = f"((eps - 1)*({sin2} - eps*(1 + {sin2}))/pow(eps*cos(radians(angle)) + {root}, 2))"
    return (
        f"(8*pow({K}, 4)*pow(cos(radians(angle)), 4)*pow({alpha}, 2)*{s}*{s}*{length}*{length}"
        f"/pow(1 + pow(2*{K}*sin(radians(angle))*{length}, 2), 1.5))"
    )


PARAMS = ("c", "s", "l", "w")


def lut_tables(bounds: str, tag: str = "") -> dict[str, str]:
    """CTEs of one inversion pass over ``pheno`` with the given bounds table; the last is ``done``."""
    def at(p: str, i: str, lo: str, hi: str) -> str:
        return f"{lo.format(p=p)} + ({hi.format(p=p)} - {lo.format(p=p)})*{i}.i/2e0 AS {p}"

    def cells(name: str, source: str, lo: str, hi: str) -> dict[str, str]:
        """Soil terms on the cells of (s, l), canopy terms on those of (c, w), and the best of their pairs."""
        two = lambda p, q: f"{at(p, 'a', lo, hi)}, {at(q, 'b', lo, hi)} FROM {source}, idx{tag} a, idx{tag} b"
        return {
            f"soils_{name}{tag}": f"SELECT n, s, l, {spm_sql('s', 'l')} AS soil FROM (SELECT n, eps, angle, {two('s', 'l')})",
            f"canopies_{name}{tag}": "SELECT n, vv_p, c, w, t, 0.75e0*w*cos(radians(angle))*(1 - t) AS canopy FROM ("
            f"SELECT *, exp(-2e0*c*sqrt(rvi)*height/cos(radians(angle))) AS t FROM (SELECT n, vv_p, rvi, height, angle, {two('c', 'w')}))",
            f"{name}{tag}": "SELECT n, min(struct_pack(cost := pow(vv_p - (soil*t + canopy), 2), c := c, s := s, l := l, w := w)) AS best"
            f" FROM soils_{name}{tag} JOIN canopies_{name}{tag} USING (n) GROUP BY n",
        }

    near_lo = "greatest({p}_lo, best.{p} - ({p}_hi - {p}_lo)*0.25e0)"
    near_hi = "least({p}_hi, best.{p} + ({p}_hi - {p}_lo)*0.25e0)"
    return {
        f"bw{tag}": BOUNDS_WIDE + f" FROM {bounds} GROUP BY lc",
        f"idx{tag}": "SELECT unnest([0, 1, 2]) AS i",
        f"routed{tag}": f"SELECT h.*, bw{tag}.* EXCLUDE (lc), CASE WHEN h.lc IN ('30', '34') OR h.lc NOT IN (SELECT lc FROM crop_height)"
        f" OR h.lc NOT IN (SELECT lc FROM {bounds}) THEN 'bare' ELSE 'crop' END AS route"
        f" FROM h LEFT JOIN bw{tag} ON h.lc = bw{tag}.lc",
        f"ready{tag}": f"SELECT row_number() OVER () AS n, * FROM routed{tag} WHERE height IS NOT NULL AND rvi IS NOT NULL AND eps IS NOT NULL AND c_lo IS NOT NULL",
        **cells("coarse", f"ready{tag}", "{p}_lo", "{p}_hi"),
        f"near{tag}": f"SELECT r.n, r.obs_id, r.vv_p, r.rvi, r.height, r.eps, r.angle, "
        + ", ".join(f"{near_lo.format(p=p)} AS {p}_lo, {near_hi.format(p=p)} AS {p}_hi" for p in PARAMS)
        + f" FROM ready{tag} r JOIN coarse{tag} USING (n)",
        **cells("fine", f"near{tag}", "{p}_lo", "{p}_hi"),
        f"fit{tag}": f"SELECT r.*, best.c AS c, best.s AS s, best.l AS l, best.w AS w FROM routed{tag} r LEFT JOIN (SELECT obs_id, best FROM fine{tag} JOIN near{tag} USING (n)) USING (obs_id)",
        f"parts{tag}": "SELECT * REPLACE (CASE WHEN route = 'bare' THEN 0.01e0 ELSE s END AS s, CASE WHEN route = 'bare' THEN 0.1e0 ELSE l END AS l,"
        " CASE WHEN route = 'crop' THEN c END AS c, CASE WHEN route = 'crop' THEN w END AS w,"
        " CASE WHEN route = 'crop' THEN height END AS height) FROM fit" + tag,
        f"powers{tag}": f"SELECT *, CASE WHEN route = 'bare' AND rvi IS NULL THEN vv_p ELSE {spm_sql('s', 'l')} END AS soil FROM parts{tag}",
        f"split{tag}": "SELECT *, CASE WHEN lc IN ('30', '34') OR (route = 'bare' AND rvi IS NULL) THEN 0 ELSE vv_p - soil END AS veg"
        f" FROM powers{tag}",
        f"decibel{tag}": "SELECT *, CASE WHEN soil > 0 THEN 10*log10(soil) END AS vvs, CASE WHEN veg > 0 THEN 10*log10(CASE WHEN veg > 0 THEN veg ELSE 1 END) END AS vvv"
        f" FROM split{tag}",
        f"done{tag}": f"SELECT * FROM decibel{tag} WHERE vvs > -50",
    }


def pass_inputs() -> dict[str, str]:
    return {
        "rated": RVI_SQL.format(src="pheno"),
        "wet": f"SELECT * EXCLUDE (mixed, water), {EPS_SQL.format(src='rated')}",
        "hseg": HEIGHT_SEG_SQL,
        "h": height_sql("wet"),
    }


def ready_scenes(spark, sf_dir):
    """Scenes with every input of the search."""
    rated = inv.permittivity(inv.radar_vegetation_index(b.pheno(spark, sf_dir)))
    high = inv.crop_height(rated, b.small(spark, "crop_height"))
    routed = inv.route_bare_or_crop(high, b.small(spark, "crop_height"), b.small(spark, "bounds"))
    return inv.bounds_lookup(routed, b.small(spark, "bounds"))


@query(
    "lut_inversion",
    with_tables("pheno", "crop_height", "bounds", **pass_inputs(), **lut_tables("bounds"))
    + """SELECT obs_id, CASE WHEN c IS NOT NULL THEN round(height, 6) END AS d, round(c, 6) AS c, round(s, 6) AS s,
        round(l, 6) AS l, round(w, 6) AS w FROM fit""",
)
def lut_inversion(spark, sf_dir):
    out = inv.lut_inversion(ready_scenes(spark, sf_dir))
    return rounded(out.select("obs_id", "d", "c", "s", "l", "w"))


@query(
    "soil_veg_decompose",
    with_tables("pheno", "crop_height", "bounds", **pass_inputs(), **lut_tables("bounds"))
    + """SELECT obs_id, route, round(vvs, 6) AS vvs, round(vvv, 6) AS vvv, round(s, 6) AS s, round(l, 6) AS l,
        CASE WHEN c IS NOT NULL THEN round(height, 6) END AS height FROM decibel""",
)
def soil_veg_decompose(spark, sf_dir):
    out = inv.soil_veg_decompose(inv.lut_inversion(ready_scenes(spark, sf_dir)))
    return rounded(out.select("obs_id", "route", "vvs", "vvv", "s", "l", "height"))


QUALITY_SQL = (
    "SELECT obs_id, CASE WHEN doy % 13 = 0 THEN NULL ELSE op END AS op, year, doy, angle,"
    " CASE WHEN doy % 6 = 0 THEN NULL ELSE vv*4 END AS vvs FROM scenes"
)


@query(
    "quality_filter",
    with_tables("scenes", q=QUALITY_SQL)
    + "SELECT obs_id, round(vvs, 6) AS vvs FROM q WHERE op IS NOT NULL AND vvs IS NOT NULL AND vvs > -50",
)
def quality_filter(spark, sf_dir):
    scored = b.scenes(spark, sf_dir).select(
        "obs_id",
        F.when(F.col("doy") % 13 != 0, F.col("op")).alias("op"),
        "year",
        "doy",
        "angle",
        F.when(F.col("doy") % 6 != 0, F.col("vv") * 4).alias("vvs"),
    )
    return rounded(inv.quality_filter(scored).select("obs_id", "vvs"))


def derived_sql(done: str, previous: str) -> str:
    """Observed [min, mean, max] over the previous bounds, checked as on load."""
    observed = " UNION ALL ".join(
        f"SELECT lc, '{p}' AS param, min({p}) AS lo, avg({p}) AS seed, max({p}) AS hi FROM {done}"
        f" WHERE route = 'crop' GROUP BY lc HAVING min({p}) IS NOT NULL"
        for p in PARAMS
    )
    return (
        "SELECT lc, param, least(lo, hi) AS lo, greatest(least(lo, hi), least(seed, greatest(lo, hi))) AS seed,"
        " CASE WHEN lo = hi THEN lo + 0.000001 ELSE greatest(lo, hi) END AS hi FROM ("
        "SELECT coalesce(n.lc, o.lc) AS lc, coalesce(n.param, o.param) AS param, coalesce(n.lo, o.lo) AS lo,"
        f" coalesce(n.seed, o.seed) AS seed, coalesce(n.hi, o.hi) AS hi FROM ({observed}) n"
        f" FULL OUTER JOIN {previous} o ON n.lc = o.lc AND n.param = o.param)"
    )


#: fitted values from a stand-in; one growing crop has none
FITTED_SQL = (
    "SELECT lc, CASE WHEN lc IN ('30', '34', '177') THEN 'bare' ELSE 'crop' END AS route,"
    " CASE WHEN lc <> '167' THEN angle/100 END AS c, CASE WHEN lc <> '167' THEN 0.01e0 END AS s,"
    " CASE WHEN lc <> '167' THEN doy/1000e0 END AS l, CASE WHEN lc <> '167' THEN ssm END AS w FROM scenes"
)
BOUNDS_OUT = "lc, param, round(lo, 6) AS lo, round(seed, 6) AS seed, round(hi, 6) AS hi"


@query(
    "derive_bounds",
    with_tables("scenes", "bounds", fitted=FITTED_SQL, derived=derived_sql("fitted", "bounds"))
    + f"SELECT {BOUNDS_OUT} FROM derived",
)
def derive_bounds(spark, sf_dir):
    has_fit = "lc <> '167'"
    fitted = b.scenes(spark, sf_dir).selectExpr(
        "lc",
        "CASE WHEN lc IN ('30', '34', '177') THEN 'bare' ELSE 'crop' END AS route",
        f"CASE WHEN {has_fit} THEN angle/100 END AS c",
        f"CASE WHEN {has_fit} THEN CAST(0.01 AS DOUBLE) END AS s",
        f"CASE WHEN {has_fit} THEN doy/CAST(1000 AS DOUBLE) END AS l",
        f"CASE WHEN {has_fit} THEN ssm END AS w",
    )
    return rounded(inv.derive_bounds(fitted, b.small(spark, "bounds")))


STATION_BOUNDS = (
    "SELECT concat(station, '-', lc) AS lc, 'c' AS param, max(vv) AS lo, avg(vv) AS seed, min(vv) AS hi FROM scenes GROUP BY 1"
)


@query(
    "validate_bounds",
    with_tables("scenes", "raw_bounds", raw=f"SELECT * FROM raw_bounds UNION ALL {STATION_BOUNDS}")
    + """SELECT lc, param, round(least(lo, hi), 6) AS lo, round(greatest(least(lo, hi), least(seed, greatest(lo, hi))), 6) AS seed,
        round(CASE WHEN lo = hi THEN lo + 0.000001 ELSE greatest(lo, hi) END, 6) AS hi FROM raw""",
)
def validate_bounds(spark, sf_dir):
    """The raw table, and reversed triplets found per station and crop."""
    found = b.scenes(spark, sf_dir).groupBy(F.concat_ws("-", "station", "lc").alias("lc")).agg(
        F.lit("c").alias("param"), F.max("vv").alias("lo"), F.avg("vv").alias("seed"), F.min("vv").alias("hi")
    )
    return rounded(inv.validate_bounds(b.small(spark, "raw_bounds").unionByName(found)))


STORED_SQL = "SELECT lc, 's' AS param, min(ssm) AS lo, avg(ssm) AS seed, max(ssm) AS hi FROM scenes WHERE lc <> '110' GROUP BY lc"


@query(
    "merge_bounds",
    with_tables("scenes", "bounds", stored=STORED_SQL)
    + """SELECT coalesce(n.lc, o.lc) AS lc, coalesce(n.param, o.param) AS param, round(coalesce(n.lo, o.lo), 6) AS lo,
        round(coalesce(n.seed, o.seed), 6) AS seed, round(coalesce(n.hi, o.hi), 6) AS hi
      FROM stored n FULL OUTER JOIN bounds o ON n.lc = o.lc AND n.param = o.param""",
)
def merge_bounds(spark, sf_dir):
    stored = b.scenes(spark, sf_dir).filter("lc <> '110'").groupBy("lc").agg(
        F.lit("s").alias("param"), F.min("ssm").alias("lo"), F.avg("ssm").alias("seed"), F.max("ssm").alias("hi")
    )
    return rounded(inv.merge_bounds(stored, b.small(spark, "bounds")))


MODELS = {"RT_s": "SPM", "RT_c": "Diff"}


def store(spark) -> IterationStore:
    return IterationStore(spark, scratch_path(spark, "inversion"), inv.DEFAULT_F_GHZ, "exp", MODELS)


def refine(spark, sf_dir, passes: int, at: IterationStore):
    return iterative_refinement(
        b.pheno(spark, sf_dir), b.small(spark, "crop_height"), b.small(spark, "bounds"), passes, at
    )


TWO_PASSES = {
    **pass_inputs(),
    **lut_tables("bounds"),
    "bounds2": derived_sql("done", "bounds"),
    **lut_tables("bounds2", "2"),
}
FIT_OUT = "obs_id, route, round(c, 6) AS c, round(s, 6) AS s, round(l, 6) AS l, round(w, 6) AS w, round(vvs, 6) AS vvs"


@query(
    "iterative_refinement",
    with_tables("pheno", "crop_height", "bounds", **TWO_PASSES) + f"SELECT {FIT_OUT} FROM done2",
)
def iterative_refinement_query(spark, sf_dir):
    """Two passes; the second searches inside the bounds found by the first."""
    out = refine(spark, sf_dir, 2, store(spark))
    return rounded(out.select("obs_id", "route", "c", "s", "l", "w", "vvs"))


@query(
    "sink_iteration_checkpoint",
    with_tables("pheno", "crop_height", "bounds", **pass_inputs(), **lut_tables("bounds"), derived=derived_sql("done", "bounds"))
    + f"""SELECT concat('config-', substr(sha256(concat_ws(chr(10), 'acf=exp', 'frequency_ghz=5.4', 'model.RT_c=Diff', 'model.RT_s=SPM')), 1, 12)) AS identifier,
        1 AS iteration, {BOUNDS_OUT} FROM derived""",
)
def sink_iteration_checkpoint(spark, sf_dir):
    """One pass written; its bounds read back beside what the manifest says."""
    at = store(spark)
    refine(spark, sf_dir, 1, at)
    bounds = attach_manifest(spark.read.parquet(f"{at.folder}/bounds/iter=1"), latest_manifest(spark, at.root))
    return rounded(
        bounds.select(
            F.col("checkpoint_identifier").alias("identifier"),
            F.col("checkpoint_iteration").cast("int").alias("iteration"),
            *[c for c in bounds.columns if not c.startswith("checkpoint_")],
        )
    )


@query(
    "resume_latest",
    with_tables("pheno", "crop_height", "bounds", **TWO_PASSES) + f"SELECT {FIT_OUT} FROM done2",
)
def resume_latest(spark, sf_dir):
    """A first run stops after one pass; a second run resumes it and does the next."""
    at = store(spark)
    refine(spark, sf_dir, 1, at)
    out = refine(spark, sf_dir, 2, at)
    return rounded(out.select("obs_id", "route", "c", "s", "l", "w", "vvs"))
