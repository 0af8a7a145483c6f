"""Soil and canopy parameters from backscatter, with bounds refined pass by pass."""

from __future__ import annotations

import sys
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilth.functions import physics
from tilth.functions.columns import db_to_power, power_to_db
from tilth.functions.physics import (
    SURFACE_MODELS,
    ArrayMath,
    canopy_gain,
    canopy_path,
    soil_permittivity,
)
from tilth.operators.lookup import open_segments
from tilth.schemas import BARE_CLASSES, FIT_PARAMS

# Bare-ground roughness (m), height band (m) and quality limits.
BARE_S, BARE_L = 0.01, 0.1
HEIGHT_BAND = 0.001
SOIL_DB_FLOOR = -50.0
GROUP_KEYS = ("op", "year", "doy", "angle")
EQUAL_BOUNDS_NUDGE = 1e-6
DEFAULT_F_GHZ = 5.4


# -- closed-form columns ---------------------------------------------------


def radar_vegetation_index(df: DataFrame) -> DataFrame:
    """Linear powers ``vv_p``, ``vh_p`` and ``rvi`` = 4 vh / (vv + vh); NULL when undefined."""
    out = df.withColumns({"vv_p": db_to_power("vv"), "vh_p": db_to_power("vh")})
    denom = F.col("vv_p") + F.col("vh_p")
    sound = (denom > 0) & (denom < float("inf"))
    return out.withColumn("rvi", F.when(sound, F.try_divide(F.lit(4.0) * F.col("vh_p"), denom)))


def crop_height(df: DataFrame, height: DataFrame, stage: str = "bbch") -> DataFrame:
    """Coefficients k and b at the crop's stage, and height (k rvi + b)/100 with its band.

    k and b are linear between the table's stages and beyond its ends. The
    height is floored at 0.
    """
    table = open_segments(height, "lc", "stage", ["k", "b"]).withColumnRenamed("lc", "__lc")
    x = F.col(stage)
    hit = (F.col("is_first") | (x >= F.col("x0"))) & (F.col("is_last") | (x < F.col("x1"))) & x.isNotNull()
    joined = df.join(table, (F.col("lc") == F.col("__lc")) & hit, "left")
    share = (x - F.col("x0")) / (F.col("x1") - F.col("x0"))
    out = joined.select(
        *[F.col(c) for c in df.columns],
        (F.col("k0") + share * (F.col("k1") - F.col("k0"))).alias("k"),
        (F.col("b0") + share * (F.col("b1") - F.col("b0"))).alias("b"),
    )
    raw = (F.col("k") * F.col("rvi") + F.col("b")) / 100.0
    return (
        out.withColumn("height", F.when(raw < 0, 0.0).otherwise(raw))
        .withColumn("height_lo", F.when(F.col("height") < HEIGHT_BAND, 0.0).otherwise(F.col("height") - HEIGHT_BAND))
        .withColumn("height_lo", F.when(F.col("height").isNotNull(), F.col("height_lo")))
        .withColumn("height_hi", F.col("height") + HEIGHT_BAND)
    )


def route_bare_or_crop(df: DataFrame, height: DataFrame, bounds: DataFrame) -> DataFrame:
    """``route`` = bare or crop: bare classes, and crops without coefficients or bounds, are bare."""
    has = lambda table, h, b: table.select("lc", F.lit(h).alias("__h"), F.lit(b).alias("__b"))
    known = has(height, True, False).unionAll(has(bounds, False, True)).groupBy("lc")
    # one join for both: each makes the compiled code of a pass longer
    routed = known.agg((F.max("__h") & F.max("__b")).alias("__crop"))
    bare = F.col("lc").isin(*BARE_CLASSES) | ~F.coalesce("__crop", F.lit(False))
    return (
        df.join(routed, on="lc", how="left")
        .withColumn("route", F.when(bare, "bare").otherwise("crop"))
        .select(*df.columns, "route")
    )


def bounds_wide(bounds: DataFrame) -> DataFrame:
    """One row per crop: ``<param>_lo``, ``<param>_seed``, ``<param>_hi``."""
    return bounds.groupBy("lc").agg(
        *[
            F.max(F.when(F.col("param") == p, F.col(side))).alias(f"{p}_{side}")
            for p in FIT_PARAMS
            for side in ("lo", "seed", "hi")
        ]
    )


def bounds_lookup(df: DataFrame, bounds: DataFrame) -> DataFrame:
    """Each crop's [lo, seed, hi] for c, s, l, w beside its rows."""
    return df.join(bounds_wide(bounds), on="lc", how="left").select(
        *df.columns, *[f"{p}_{side}" for p in FIT_PARAMS for side in ("lo", "seed", "hi")]
    )


# -- lookup-table search ---------------------------------------------------


def with_surface_terms(df: DataFrame, f_ghz: float = DEFAULT_F_GHZ, model: str = "SPM") -> DataFrame:
    """Adds the surface model's terms as columns, so that search and decomposition need not work them out again.

    Filters are moved down to the search and repeat what they rest on; with the terms
    below it that is short enough to be compiled, else each row is interpreted.
    """
    terms = SURFACE_MODELS[model].terms(F.col("eps"), F.col("angle"), f_ghz)
    return df.withColumns({f"__{model}_{name}": term for name, term in terms.items()})


def _surface_terms(df: DataFrame, f_ghz: float, model: str) -> dict[str, Column]:
    """The surface model's terms: the columns of :func:`with_surface_terms` where ``df`` has them."""
    terms = SURFACE_MODELS[model].terms(F.col("eps"), F.col("angle"), f_ghz)
    return {name: F.col(f"__{model}_{name}") if f"__{model}_{name}" in df.columns else term for name, term in terms.items()}


def _darker(ground, canopy, vv, n_soils):
    """How many of a row's sorted soils give less than is observed."""
    n = len(vv)
    low = np.zeros(n, int)
    if n_soils <= 32:  # few: counted
        for k in range(n_soils):
            low += ground[k * n : (k + 1) * n] + canopy < vv
        return low
    rows, high = np.arange(n), np.full(n, n_soils)
    for _ in range(n_soils.bit_length()):
        middle = np.minimum((low + high) >> 1, n_soils - 1)
        less = (ground.take(middle * n + rows) + canopy < vv) & (low < high)
        np.copyto(high, middle, where=~less)
        np.copyto(low, middle + 1, where=less)
    return low


def _first_least(vv, path, gain, axes, soil):
    """Grid cell with the smallest misfit per row, as ``(misfit, c, s, l, w)`` arrays.

    The soil term depends on (s, l) alone and the canopy terms on (c, w) alone.
    Under one (c, w) the simulated power rises with the soil power, so the
    soils are sorted once per row and the two next to the observation are
    found; no other can be nearer. Cells come in (c, s, l, w) order
    and the first of equals wins: where soils beyond those two are equally
    near, as below a canopy that hides the ground, all of them are compared.
    """
    soils = [soil(s, length) for s in axes["s"] for length in axes["l"]]
    n, n_soils, n_w = len(vv), len(soils), len(axes["w"])
    powers = np.stack([np.broadcast_to(p, vv.shape) for p in soils], axis=1)
    order = np.argsort(powers, axis=1, kind="stable")
    # soil by soil from here on, as flat arrays
    ranked = np.take_along_axis(powers, order, axis=1).T.ravel()
    order = order.T.ravel()
    rows, most = np.arange(n), (n_soils - 1) * n
    best, cell = np.full(vv.shape, np.inf), np.full(vv.shape, -1)
    for i, c in enumerate(axes["c"]):
        through = np.exp(path * c)
        ground = (ranked.reshape(n_soils, n) * through).ravel()
        for j, w in enumerate(axes["w"]):
            canopy = w * gain * (1.0 - through)

            def misfit(place):
                found = np.abs(vv - (ground.take(place) + canopy))
                found[np.isnan(found)] = np.inf
                return found

            at = _darker(ground, canopy, vv, n_soils) * n + rows
            below, above = np.maximum(at - n, rows), np.minimum(at, most + rows)
            near, far = misfit(below), misfit(above)
            least = np.minimum(near, far)
            here, there = order.take(below), order.take(above)
            first = np.where(near == far, np.minimum(here, there), np.where(near < far, here, there))
            alike = (misfit(np.maximum(below - n, rows)) == least) & (below >= n)
            alike |= (misfit(np.minimum(above + n, most + rows)) == least) & (above < most)
            level = np.flatnonzero(alike)
            if len(level):
                every = level + n * np.arange(n_soils)[:, None]
                same = np.abs(vv[level] - (ground[every] + canopy[level])) == least[level]
                first[level] = np.where(same, order[every], n_soils).min(axis=0)
            number = (i * n_soils + first) * n_w + j
            better = (least < best) | ((least == best) & (number < cell))
            np.copyto(best, least, where=better)
            np.copyto(cell, number, where=better)
    found = cell >= 0
    steps = (cell // (n_w * n_soils), cell // n_w % n_soils // len(axes["l"]), cell // n_w % len(axes["l"]), cell % n_w)
    out = [best]
    for p, step in zip(FIT_PARAMS, steps):
        values = np.stack([np.broadcast_to(v, vv.shape) for v in axes[p]], axis=1)
        out.append(np.where(found, values[rows, np.maximum(step, 0)], np.nan))
    return out


# the search is sent to the workers whole, so they need not have this package
cloudpickle.register_pickle_by_value(physics)
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _search(model: str, term_names: Sequence[str], levels: int, refinements: int) -> Callable:
    """The coarse-to-fine search over one Arrow batch of observations."""
    power = SURFACE_MODELS[model].power

    def search(vv: pd.Series, path: pd.Series, gain: pd.Series, *rest: pd.Series) -> pd.DataFrame:
        columns = [x.to_numpy(dtype=float) for x in (vv, path, gain, *rest)]
        sound = np.flatnonzero(np.all(np.isfinite(columns), axis=0))
        vv_, path_, gain_, *others = [x[sound] for x in columns]
        lo = dict(zip(FIT_PARAMS, others[: len(FIT_PARAMS)]))
        hi = dict(zip(FIT_PARAMS, others[len(FIT_PARAMS) :]))
        terms = dict(zip(term_names, others[2 * len(FIT_PARAMS) :]))

        def axes(low, high):
            return {p: [low[p] + (high[p] - low[p]) * (i / (levels - 1)) for i in range(levels)] for p in FIT_PARAMS}

        def soil(s, length):
            return power(s, length, terms, ArrayMath)

        best = _first_least(vv_, path_, gain_, axes(lo, hi), soil)
        share = 0.5 / (levels - 1)
        for _ in range(refinements):
            at = dict(zip(FIT_PARAMS, best[1:]))
            low = {p: np.maximum(lo[p], at[p] - (hi[p] - lo[p]) * share) for p in FIT_PARAMS}
            high = {p: np.minimum(hi[p], at[p] + (hi[p] - lo[p]) * share) for p in FIT_PARAMS}
            best = _first_least(vv_, path_, gain_, axes(low, high), soil)
            share /= levels - 1
        out = {name: np.full(len(vv), np.nan) for name in ("misfit", *FIT_PARAMS)}
        for name, values in zip(out, best):
            out[name][sound] = values
        return pd.DataFrame(out)

    fields = ", ".join(f"{name} double" for name in ("misfit", *FIT_PARAMS))
    # marked as not repeatable only so that the optimizer evaluates it once
    # where it stands, instead of again inside every filter on its results
    return F.pandas_udf(search, fields).asNondeterministic()


def lut_inversion(
    df: DataFrame,
    f_ghz: float = DEFAULT_F_GHZ,
    model: str = "SPM",
    levels: int = 3,
    refinements: int = 1,
) -> DataFrame:
    """Fit c, s, l, w by a grid search between their bounds, d held at the crop height.

    Minimises |vv_p - vv_sim| with vv_sim = soil(s, l) T + w gain (1 - T), T the
    canopy's two-way transmission. The first grid has ``levels`` steps per
    parameter between the bounds; each refinement lays the same number of steps
    over one coarse step around the best cell, kept inside the bounds. Each
    observation is solved from its own row: no rows are multiplied and nothing
    is shuffled. Everything that does not depend on the cell is a column; the
    search runs on Arrow batches, since nested higher-order functions are
    interpreted cell by cell.
    Rows lacking an input get NULL parameters. Adds ``d, c, s, l, w, cost``
    (squared misfit) and ``grid_step`` (last step as a share of the range).
    """
    if levels < 2:
        raise ValueError("levels must be at least 2")
    theta = F.col("angle")
    terms = _surface_terms(df, f_ghz, model)
    search = _search(model, list(terms), levels, refinements)
    found = search(
        F.col("vv_p"),
        canopy_path(F.col("rvi"), F.col("height"), theta),
        canopy_gain(theta),
        *[F.col(f"{p}_{side}") for side in ("lo", "hi") for p in FIT_PARAMS],
        *terms.values(),
    )
    out = df.withColumn("__fit", found)
    fitted = F.col("__fit.misfit").isNotNull()
    return out.select(
        *[F.col(c) for c in df.columns],
        F.when(fitted, F.col("height")).alias("d"),
        *[F.col(f"__fit.{p}").alias(p) for p in FIT_PARAMS],
        (F.col("__fit.misfit") * F.col("__fit.misfit")).alias("cost"),
        F.lit((levels - 1.0) ** -(refinements + 1)).alias("grid_step"),
    )


# -- one pass --------------------------------------------------------------


def permittivity(df: DataFrame, f_ghz: float = DEFAULT_F_GHZ) -> DataFrame:
    return df.withColumn(
        "eps",
        soil_permittivity(
            F.col("sand"), F.col("clay"), F.col("bulk"), F.col("ssm"), F.col("sst"), f_ghz
        ),
    )


def soil_veg_decompose(df: DataFrame, f_ghz: float = DEFAULT_F_GHZ, model: str = "SPM") -> DataFrame:
    """Soil and vegetation parts of vv in dB (``vvs``, ``vvv``) from the fitted parameters.

    Bare routes take the fixed roughness; the bare classes have no vegetation
    part. A bare row whose index is undefined keeps vv as its soil part; a crop
    row that could not be fitted has NULL results. No row makes the job fail.
    """
    bare = F.col("route") == "bare"
    broken = bare & F.col("rvi").isNull()
    out = df.withColumns(
        {
            "s": F.when(bare, F.lit(BARE_S)).otherwise(F.col("s")),
            "l": F.when(bare, F.lit(BARE_L)).otherwise(F.col("l")),
            "c": F.when(~bare, F.col("c")),
            "d": F.when(~bare, F.col("d")),
            "w": F.when(~bare, F.col("w")),
        }
    )
    fitted = ~bare & F.col("c").isNotNull()
    for name in ("height", "k", "b"):
        out = out.withColumn(name, F.when(fitted, F.col(name)))
    surface = SURFACE_MODELS[model].power(F.col("s"), F.col("l"), _surface_terms(df, f_ghz, model))
    out = out.withColumn("__soil", F.when(broken, F.col("vv_p")).when(bare | fitted, surface))
    ground = F.col("lc").isin(*BARE_CLASSES) | broken
    out = out.withColumn(
        "__veg", F.when(ground, F.lit(0.0)).otherwise(F.col("vv_p") - F.col("__soil"))
    )
    return (
        out.withColumn("vvv", power_to_db("__veg"))
        .withColumn("vvs", power_to_db("__soil"))
        .withColumn("rvi", F.when(bare | fitted, F.col("rvi")))
        .drop("__soil", "__veg")
    )


def quality_filter(df: DataFrame, keys: Sequence[str] = GROUP_KEYS, floor: float = SOIL_DB_FLOOR) -> DataFrame:
    """Rows with complete keys and a soil part above the floor."""
    return df.dropna(subset=list(keys)).filter(F.col("vvs") > floor)


RESULT_COLUMNS = ("d", "c", "w", "vvv", "vvs", "s", "l", "rvi", "height", "k", "b")


def invert_once(
    pheno: DataFrame,
    height: DataFrame,
    bounds: DataFrame,
    f_ghz: float = DEFAULT_F_GHZ,
    model: str = "SPM",
    levels: int = 3,
    refinements: int = 1,
) -> DataFrame:
    """One inversion pass over ``pheno`` (with texture): input columns, ``route`` and results."""
    base = [c for c in pheno.columns if c not in RESULT_COLUMNS]
    out = radar_vegetation_index(pheno.select(*base).dropna(subset=list(GROUP_KEYS)))
    out = route_bare_or_crop(permittivity(out, f_ghz), height, bounds)
    out = with_surface_terms(bounds_lookup(crop_height(out, height), bounds), f_ghz, model)
    out = lut_inversion(out, f_ghz, model, levels, refinements)
    out = quality_filter(soil_veg_decompose(out, f_ghz, model))
    return out.select(*base, "route", *RESULT_COLUMNS)


# -- bounds algebra --------------------------------------------------------


def validate_bounds(bounds: DataFrame) -> DataFrame:
    """Order each triplet, clamp its seed and open empty intervals; not-finite ones fail the job."""
    bad = F.lit(False)
    for side in ("lo", "seed", "hi"):
        c = F.col(side).cast("double")
        bad = bad | c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    message = F.concat(F.lit("bounds not finite: "), F.coalesce("lc", F.lit("?")), F.lit(":"), F.col("param"))
    lo, hi = F.least("lo", "hi"), F.greatest("lo", "hi")
    seed = F.greatest(lo, F.least(F.col("seed"), hi))
    # in a filter, so that it holds whichever columns are read
    checked = bounds.filter(F.when(bad, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
    return checked.select(
        "lc",
        "param",
        lo.alias("lo"),
        seed.alias("seed"),
        F.when(lo == hi, lo + EQUAL_BOUNDS_NUDGE).otherwise(hi).alias("hi"),
    )


def merge_bounds(stored: DataFrame, base: DataFrame) -> DataFrame:
    """Stored bounds over base bounds, crop by crop and parameter by parameter."""
    new, old = stored.alias("n"), base.alias("o")
    on = (F.col("n.lc") == F.col("o.lc")) & (F.col("n.param") == F.col("o.param"))
    present = F.col("n.lo").isNotNull()
    return validate_bounds(
        new.join(old, on, "full_outer").select(
            F.coalesce("n.lc", "o.lc").alias("lc"),
            F.coalesce("n.param", "o.param").alias("param"),
            *[
                F.when(present, F.col(f"n.{side}")).otherwise(F.col(f"o.{side}")).alias(side)
                for side in ("lo", "seed", "hi")
            ],
        )
    )


def observed_bounds(results: DataFrame) -> DataFrame:
    """[min, mean, max] per crop and parameter over crop-routed rows.

    Bare routes carry constants, not fits, and would otherwise pass their s
    and l on as bounds of crops that have none for c and w.
    """
    sides = {"lo": F.min, "seed": F.avg, "hi": F.max}
    wide = (
        results.filter(F.col("route") == "crop")
        .groupBy("lc")
        .agg(*[agg(p).alias(f"{p}_{side}") for p in FIT_PARAMS for side, agg in sides.items()])
    )
    triplets = F.array(
        *[
            F.struct(F.lit(p).alias("param"), *[F.col(f"{p}_{side}").alias(side) for side in sides])
            for p in FIT_PARAMS
        ]
    )
    return wide.select("lc", F.inline(triplets)).filter("lo is not null")


def derive_bounds(results: DataFrame, previous: DataFrame) -> DataFrame:
    """Bounds for the next pass; crops without fitted values keep their old ones."""
    return merge_bounds(observed_bounds(results), previous)
