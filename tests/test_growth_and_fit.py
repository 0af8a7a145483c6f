"""Stage rules, inversion invariants, bounds algebra and resuming."""

import contextlib
import io
import re
from bisect import bisect_right

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilth.functions.physics import SURFACE_MODELS, ArrayMath, soil_backscatter
from tilth.operators import inversion as inv
from tilth.operators import phenology as ph
from tilth.operators.lookup import non_increasing
from tilth.operators.modelling import predict_holdout
from tilth.plans import bindings as b
from tilth.plans.pipeline import iterative_refinement, run_to_models
from tilth.sources.sinks import checkpoint_id, IterationStore, latest_manifest, read_model

SF = "/root/testdata/sf0.001"


def plain_stage(points, gdd, sst):
    """The rule in words: ends first, then the half-even interpolation unless frozen."""
    if gdd is None or sst is None or not points:
        return None
    if gdd < points[0][0]:
        return 0.0
    if gdd >= points[-1][0]:
        return points[-1][1]
    i = bisect_right([g for g, _ in points], gdd)
    (g0, s0), (g1, s1) = points[i - 1], points[i]
    return None if sst < 0 else float(round(s0 + (gdd - g0) / (g1 - g0) * (s1 - s0)))


def test_stage_rule(spark):
    rng = np.random.default_rng(0)
    table = {"110": [(10.0, 10.0), (20.0, 21.0), (40.0, 60.5)], "122": [(5.0, 9.0), (50.0, 89.0)]}
    points = spark.createDataFrame([(lc, g, s) for lc, ps in table.items() for g, s in ps], "lc string, gdd double, stage double")
    rows = [
        (
            i,
            str(rng.choice(["110", "122", "999"])),
            None if i % 13 == 0 else float(rng.choice([rng.uniform(0, 60), 5, 10, 15, 20, 30, 40, 50])),
            None if i % 17 == 0 else float(rng.uniform(-3, 10)),
        )
        for i in range(1500)
    ]
    got = ph.stage_from_gdd(spark.createDataFrame(rows, "id int, lc string, cum_gdd double, sst double"), points)
    assert got.count() == len(rows)
    for r in got.collect():
        assert r.bbch == plain_stage(table.get(r.lc), r.cum_gdd, r.sst), r


def test_height_extrapolates_and_is_floored(spark):
    table = spark.createDataFrame([("a", 10.0, 2.0, 6.0), ("a", 20.0, 4.0, 2.0), ("b", 5.0, 1.0, 1.0)], "lc string, stage double, k double, b double")
    rows = [("a", 15.0, 1.0), ("a", 30.0, 1.0), ("a", 40.0, 0.0), ("a", None, 1.0), ("b", 5.0, 1.0)]
    out = inv.crop_height(spark.createDataFrame(rows, "lc string, bbch double, rvi double"), table).collect()
    got = {(r.lc, r.bbch): (r.k, r.b, r.height, r.height_lo) for r in out}
    assert got["a", 15.0] == pytest.approx((3.0, 4.0, 0.07, 0.069))
    assert got["a", 30.0] == pytest.approx((6.0, -2.0, 0.04, 0.039))
    assert got["a", 40.0] == (8.0, -6.0, 0.0, 0.0)
    assert got["a", None] == (None, None, None, None)
    assert got["b", 5.0] == (None, None, None, None)  # one point is no line


def test_non_increasing_breakpoints_are_found(spark):
    points = spark.createDataFrame([("a", 0, 1.0), ("a", 1, 2.0), ("b", 0, 2.0), ("b", 1, 2.0)], "lc string, seq int, gdd double")
    assert [r.lc for r in non_increasing(points, "lc", "seq", "gdd").collect()] == ["b"]


def test_bounds_that_are_not_finite_fail(spark):
    bad = spark.createDataFrame([("a", "c", 0.0, float("nan"), 1.0)], "lc string, param string, lo double, seed double, hi double")
    with pytest.raises(Exception, match="not finite: a:c"):
        inv.validate_bounds(bad).collect()


@pytest.mark.parametrize("model", sorted(SURFACE_MODELS))
def test_column_and_array_models_agree(spark, model):
    rows = [(0.003 + 0.001 * i, 0.03 + 0.01 * i, 5.0 + i, 30.0 + i) for i in range(8)]
    table = spark.createDataFrame(rows, "s double, l double, eps double, angle double")
    terms = SURFACE_MODELS[model].terms(F.col("eps"), F.col("angle"), 5.4)
    out = table.select("*", soil_backscatter(model, *map(F.col, ("s", "l", "eps", "angle")), 5.4).alias("p"), *[c.alias(f"t_{k}") for k, c in terms.items()])
    frame = out.toPandas()
    want = SURFACE_MODELS[model].power(frame["s"].to_numpy(), frame["l"].to_numpy(), {k: frame[f"t_{k}"].to_numpy() for k in terms}, ArrayMath)
    assert (frame["p"] > 0).all()
    np.testing.assert_allclose(frame["p"], want, rtol=1e-12)


def ready(spark):
    rated = inv.permittivity(inv.radar_vegetation_index(b.pheno(spark, SF)))
    high = inv.crop_height(rated, b.small(spark, "crop_height"))
    return inv.bounds_lookup(inv.route_bare_or_crop(high, b.small(spark, "crop_height"), b.small(spark, "bounds")), b.small(spark, "bounds"))


@pytest.mark.parametrize("levels", [2, 4])
def test_refining_stays_in_bounds_and_never_fits_worse(spark, levels):
    table = ready(spark)
    coarse = inv.lut_inversion(table, levels=levels, refinements=0).select("obs_id", F.col("cost").alias("coarse"))
    fine = inv.lut_inversion(table, levels=levels, refinements=1)
    assert fine.count() == table.count()
    eps = 1e-12
    outside = F.lit(False)
    for p in ("c", "s", "l", "w"):
        outside = outside | (F.col(p) < F.col(f"{p}_lo") - eps) | (F.col(p) > F.col(f"{p}_hi") + eps)
    assert fine.filter(outside).isEmpty()
    # the fine grid holds the coarse optimum only when its steps are odd; with
    # two or four levels it may miss it, but never by the coarse step's worth
    both = fine.join(coarse, "obs_id").filter("cost is not null")
    assert both.filter("cost > coarse * 4 + 0.01").isEmpty()
    assert both.agg(F.avg(F.col("cost")) - F.avg("coarse")).first()[0] <= 1e-9


def test_odd_levels_never_fit_worse(spark):
    table = ready(spark)
    coarse = inv.lut_inversion(table, refinements=0).select("obs_id", F.col("cost").alias("coarse"))
    worse = inv.lut_inversion(table).join(coarse, "obs_id").filter(F.col("cost") > F.col("coarse") + 1e-15)
    assert worse.isEmpty()


def store(spark, root):
    return IterationStore(spark, root, 5.4, "exp", {"RT_s": "SPM"})


def test_refinement_narrows_bounds_and_resumes(spark, tmp_path):
    args = (b.pheno(spark, SF), b.small(spark, "crop_height"), b.small(spark, "bounds"))
    straight = store(spark, f"{tmp_path}/a")
    want = iterative_refinement(*args, 2, straight)
    stepped = store(spark, f"{tmp_path}/b")
    iterative_refinement(*args, 1, stepped)
    assert stepped.latest(5) == 1 and stepped.latest(0) is None
    got = iterative_refinement(*args, 2, stepped)
    columns = ["obs_id", "c", "s", "l", "w", "vvs"]
    assert got.select(columns).exceptAll(want.select(columns)).isEmpty()
    assert got.count() == want.count()
    again = iterative_refinement(*args, 2, stepped)  # nothing left to do
    assert again.count() == want.count()
    one = spark.read.parquet(f"{straight.folder}/bounds/iter=1").alias("x")
    two = spark.read.parquet(f"{straight.folder}/bounds/iter=2").alias("y")
    wider = one.join(two, ["lc", "param"]).filter("y.lo < x.lo - 1e-9 OR y.hi > x.hi + 2e-6")
    assert wider.isEmpty()
    manifest = latest_manifest(spark, f"{tmp_path}/b").first()
    assert manifest.iteration == 2 and manifest.identifier == stepped.identifier
    assert latest_manifest(spark, f"{tmp_path}/nowhere") is None


def test_no_run_finds_the_passes_of_another(spark, tmp_path):
    args = (b.pheno(spark, SF).limit(50).cache(), b.small(spark, "crop_height"), b.small(spark, "bounds"))
    at = store(spark, f"{tmp_path}/c")
    iterative_refinement(*args, 2, at)
    first = at.folder
    at.begin("another input")  # a job that is lost before its first pass
    assert at.folder != first and at.latest(5) is None
    fewer = iterative_refinement(args[0].limit(20), *args[1:], 1, at)
    assert fewer.count() <= 20 and at.latest(5) == 1
    anew = iterative_refinement(args[0].limit(20), *args[1:], 1, at, resume=False)
    assert at.latest(5) == 1 and anew.count() == fewer.count()


def test_from_phenology_to_stored_models(spark, tmp_path):
    at = store(spark, f"{tmp_path}/passes")
    crops = {"heights": b.small(spark, "crop_height"), "bounds": b.small(spark, "bounds")}
    metrics = run_to_models(b.pheno(spark, SF), crops, at, f"{tmp_path}/out", ("SSM", "s"))
    for target, table in metrics.items():
        row = table.first()
        assert (row.checkpoint_identifier, row.checkpoint_iteration) == (at.identifier, 1) and row.rmse >= 0
        held = spark.read.parquet(f"{tmp_path}/out/{target.lower()}/holdout")
        again = read_model(f"{tmp_path}/out/{target.lower()}/model")
        column = f"{target.lower()}_pred"
        back = predict_holdout(again, held.withColumnRenamed(column, "before"), target)
        assert not held.isEmpty() and back.filter(f"before <> {column}").isEmpty()
        trees = spark.read.option("header", "true").csv(f"{tmp_path}/out/{target.lower()}/trees_csv").collect()
        assert len(trees) == 15 and all("#" in t.tree for t in trees)


def test_checkpoint_id_depends_on_models():
    a, c = checkpoint_id(5.4, "exp", {"RT_s": "SPM", "RT_c": "Diff"}), checkpoint_id(5.4, "exp", {"RT_s": "OH", "RT_c": "Diff"})
    assert a.startswith("config-") and len(a) == 19
    assert a == checkpoint_id(5.4, "exp", {"RT_c": "Diff", "RT_s": "SPM"})
    assert len({a, c, checkpoint_id(5.5, "exp", {"RT_s": "SPM", "RT_c": "Diff"}), checkpoint_id(5.4, "gauss", {"RT_s": "SPM", "RT_c": "Diff"})}) == 4


def test_broken_rows_do_not_fail_the_pass(spark):
    pheno = b.pheno(spark, SF).limit(200)
    broken = pheno.withColumn("vh", F.lit(None).cast("double")).withColumn("obs_id", F.concat("obs_id", F.lit("x")))
    out = inv.invert_once(pheno.unionByName(broken), b.small(spark, "crop_height"), b.small(spark, "bounds"))
    bad = out.filter(F.col("obs_id").endswith("x"))
    # bare ground keeps vv as its soil part, unfitted crops drop out
    assert bad.filter("route = 'crop'").isEmpty()
    assert bad.filter("abs(vvs - vv) > 1e-9 OR vvv IS NOT NULL OR rvi IS NOT NULL").isEmpty()
    assert bad.count() == broken.join(b.small(spark, "bounds").select("lc").distinct().filter("lc <> '177'"), "lc", "left_anti").count()


def every_cell(vv, path, gain, axes, soil):
    """All cells in order; the first of equals stays."""
    best = [np.full(vv.shape, np.inf)] + [np.full(vv.shape, np.nan) for _ in range(4)]
    for c in axes["c"]:
        through = np.exp(path * c)
        for s in axes["s"]:
            for length in axes["l"]:
                ground = soil(s, length) * through
                for w in axes["w"]:
                    misfit = np.abs(vv - (ground + w * gain * (1.0 - through)))
                    better = misfit < best[0]
                    for kept, new in zip(best, (misfit, c, s, length, w)):
                        np.copyto(kept, new, where=better)
    return best


@pytest.mark.parametrize("levels", [2, 3, 7])
@pytest.mark.parametrize("kind", ["SPM", "no length", "undefined"])
def test_sorted_soils_find_the_first_of_the_nearest_cells(levels, kind):
    """Also under a canopy that hides the ground, with equal soils, equal bounds, and soils without a value."""
    rng = np.random.default_rng(levels)
    n = 4000
    axes = {}
    for p, top in (("c", 0.5), ("s", 0.02), ("l", 0.1), ("w", 0.5)):
        low = np.where(rng.random(n) < 0.1, 0.0, rng.random(n) * top)
        width = np.where(rng.random(n) < 0.1, 0.0, rng.random(n) * top)
        axes[p] = [low + width * (i / (levels - 1)) for i in range(levels)]
    vv, gain = rng.random(n) * 0.3, 0.75 * rng.random(n)
    path = -rng.choice([0.0, 1.0, 30.0, 2000.0], n) * rng.random(n)

    def soil(s, length):
        power = 300.0 * s * s * (1.0 if kind == "no length" else length / 0.05)
        return np.where(length > 0.12, np.nan, power) if kind == "undefined" else power

    for got, want in zip(inv._first_least(vv, path, gain, axes, soil), every_cell(vv, path, gain, axes, soil)):
        np.testing.assert_array_equal(got, want)


def largest_methods(df):
    """Bytes of the largest method of each compiled subtree of a plan; above 8000 the JVM interprets it."""
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("codegen")
    return [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text.getvalue())]


def test_a_pass_is_short_enough_to_be_compiled(spark, tmp_path):
    b.pheno(spark, SF).write.parquet(f"{tmp_path}/pheno")
    written = spark.read.parquet(f"{tmp_path}/pheno")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # only a plan that is not adaptive shows its code
    try:
        sizes = largest_methods(inv.invert_once(written, b.small(spark, "crop_height"), b.small(spark, "bounds")))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert sizes and max(sizes) < 8000


def test_passes_read_one_and_the_same_input(spark, tmp_path):
    changing = b.pheno(spark, SF).limit(300).withColumn("obs_id", F.expr("uuid()"))
    at = store(spark, f"{tmp_path}/d")
    second = iterative_refinement(changing, b.small(spark, "crop_height"), b.small(spark, "bounds"), 2, at)
    first = spark.read.parquet(f"{at.folder}/results/iter=1")
    assert not second.isEmpty() and not second.join(first, "obs_id").isEmpty()


def test_routes_need_both_tables_and_a_crop(spark):
    rows = spark.createDataFrame([("110",), ("122",), ("133",), (None,)], "lc string")
    height = spark.createDataFrame([("110",), ("110",), ("122",), (None,)], "lc string")
    bounds = spark.createDataFrame([("110",), ("133",), (None,)], "lc string")
    got = {r["lc"]: r["route"] for r in inv.route_bare_or_crop(rows, height, bounds).collect()}
    assert got == {"110": "crop", "122": "bare", "133": "bare", None: "bare"}
