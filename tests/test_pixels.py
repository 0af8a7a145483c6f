"""Neighbourhood operators against plain loops, across tile borders and masks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilth.operators import pixels as px


def image(seed, rows=23, cols=19, masked=0.0):
    rng = np.random.default_rng(seed)
    img = rng.gamma(4.0, 0.25, (rows, cols))
    img[rng.random(img.shape) < masked] = np.nan
    return img


def to_table(spark, *images):
    rows = [
        (f"s{k}", "VV", r, c, None if np.isnan(v) else float(v))
        for k, img in enumerate(images)
        for (r, c), v in np.ndenumerate(img)
    ]
    return spark.createDataFrame(rows, "scene string, band string, row bigint, col bigint, v double")


def around(img, r, c, members):
    out = []
    for dr, dc in members:
        if 0 <= r + dr < img.shape[0] and 0 <= c + dc < img.shape[1] and not np.isnan(img[r + dr, c + dc]):
            out.append(img[r + dr, c + dc])
    return np.array(out)


BOX = [(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1)]


def plain_lee(img):
    """The filter cell by cell, with kernels as matrices and numpy's own rotation."""
    mean, var = np.full(img.shape, np.nan), np.full(img.shape, np.nan)
    for (r, c), v in np.ndenumerate(img):
        if not np.isnan(v):
            near = around(img, r, c, BOX)
            mean[r, c], var[r, c] = near.mean(), near.var()
    rect = np.zeros((7, 7), int)
    rect[3:] = 1
    diag = np.tril(np.ones((7, 7), int))
    kernels = [np.rot90(k, -turn) for turn in range(4) for k in (rect, diag)]
    out = np.full(img.shape, np.nan)

    def at(a, r, c):
        return a[r, c] if 0 <= r < a.shape[0] and 0 <= c < a.shape[1] else np.nan

    for (r, c), z in np.ndenumerate(img):
        if np.isnan(z):
            continue
        m = [at(mean, r + i, c + j) for i in (-2, 0, 2) for j in (-2, 0, 2)]
        s = [at(var, r + i, c + j) for i in (-2, 0, 2) for j in (-2, 0, 2)]
        if np.isnan(s).any():
            continue
        pairs = [(1, 7), (6, 2), (3, 5), (0, 8)]
        g = [abs(m[a] - m[b]) for a, b in pairs]
        number = sum(
            (i + 1 if m[a] - m[4] > m[4] - m[b] else i + 5) for i, (a, b) in enumerate(pairs) if g[i] == max(g)
        )
        if number > 8:
            continue
        kernel = kernels[number - 1]
        half = around(img, r, c, [(i - 3, j - 3) for i in range(7) for j in range(7) if kernel[i, j]])
        noise = np.mean(sorted(v / u**2 for v, u in zip(s, m))[:5])
        wm, wv = half.mean(), half.var()
        b = (wv - wm * wm * noise) / (noise + 1) / wv
        out[r, c] = wm + b * (z - wm)
    return out


@pytest.mark.parametrize("tile", [5, 64])
def test_focal(spark, tile):
    img = image(1, masked=0.15)
    got = {(r.row, r.col): r for r in px.focal_mean_var_3x3(to_table(spark, img), tile=tile).collect()}
    assert len(got) == int((~np.isnan(img)).sum())
    for (r, c), cell in got.items():
        near = around(img, r, c, BOX)
        assert cell.mean == pytest.approx(near.mean()) and cell.var == pytest.approx(near.var(), abs=1e-12)


@pytest.mark.parametrize("tile,masked", [(6, 0.05), (64, 0.0)])
def test_refined_lee(spark, tile, masked):
    images = [image(2, masked=masked), image(3, 12, 30, masked=masked)]
    rows = px.refined_lee(to_table(spark, *images), tile=tile).collect()
    assert len(rows) == sum(int((~np.isnan(i)).sum()) for i in images)
    want = [plain_lee(i) for i in images]
    assert sum(int((~np.isnan(w)).sum()) for w in want) > 50
    for r in rows:
        expected = want[int(r.scene[1:])][r.row, r.col]
        assert (r.v is None) == np.isnan(expected)
        if r.v is not None:
            assert r.v == pytest.approx(expected, rel=1e-9)


def test_half_windows_turn_clockwise():
    rect = np.zeros((7, 7), int)
    rect[3:] = 1
    kernels = [np.rot90(k, -turn) for turn in range(4) for k in (rect, np.tril(np.ones((7, 7), int)))]
    for members, kernel in zip(px._half_windows(), kernels):
        assert sorted(members) == [(i - 3, j - 3) for i in range(7) for j in range(7) if kernel[i, j]]


def test_buffer_join_on_cell_borders(spark):
    stations = spark.createDataFrame([("a", 10.0, 10.0), ("b", -0.5, 0.0)], "station string, sx double, sy double")
    grid = spark.range(-20, 41).select(F.col("id").cast("double").alias("x")).crossJoin(
        spark.range(-20, 41).select(F.col("id").cast("double").alias("y"))
    )
    got = {(r.station, r.x, r.y) for r in px.buffer_range_join(grid, stations, 5.0).collect()}
    want = {
        (s, float(x), float(y))
        for s, sx, sy in (("a", 10.0, 10.0), ("b", -0.5, 0.0))
        for x in range(-20, 41)
        for y in range(-20, 41)
        if (x - sx) ** 2 + (y - sy) ** 2 <= 25
    }
    assert got == want
    with pytest.raises(ValueError):
        px.buffer_range_join(grid, stations, -1.0)


@pytest.mark.parametrize("most", [1, 7, 100_000])
def test_buffer_join_in_crowded_cells(spark, most):
    """Overlapping buffers, a spot that no cell can split, rows without coordinates, and other columns."""
    rng = np.random.default_rng(5)
    points = [(i, float(a), float(b)) for i, (a, b) in enumerate(rng.normal(0, 30, (300, 2)).round(1))]
    points += [(1000 + i, 3.0, -4.0) for i in range(200)] + [(2000 + i, 3.0 + i / 1000, -4.0) for i in range(50)] + [(3000, None, 1.0), (3001, 1.0, None)]
    places = [(f"s{i}", float(a), float(b)) for i, (a, b) in enumerate(rng.normal(0, 25, (40, 2)).round(1))] + [("spot", 3.0, -4.0), ("spot2", 3.0, 1.0), ("none", None, None)]
    grid = spark.createDataFrame(points, "id long, x double, y double").withColumn("n", F.lit("clash"))
    got = px.buffer_range_join(grid, spark.createDataFrame(places, "station string, sx double, sy double"), 5.0, most=most)
    assert got.columns == ["station", "id", "x", "y", "n"]
    pairs = [(r.station, r.id) for r in got.collect()]
    want = [(s, i) for s, sx, sy in places for i, x, y in points if None not in (sx, x, y) and (x - sx) ** 2 + (y - sy) ** 2 <= 25]
    assert sorted(pairs) == sorted(want)


def test_buffer_join_without_pixels_or_stations(spark):
    grid = spark.createDataFrame([(1.0, 1.0)], "x double, y double")
    stations = spark.createDataFrame([("a", 1.0, 1.0)], "station string, sx double, sy double")
    assert px.buffer_range_join(grid.limit(0), stations, 5.0).count() == 0
    assert px.buffer_range_join(grid, stations.limit(0), 5.0).count() == 0
    assert px.buffer_range_join(grid, stations, 0.0).count() == 1


def test_tiles_of_negative_places_and_narrow_types(spark):
    img = image(7, 20, 20)
    table = to_table(spark, img).select("scene", "band", (F.col("row") - 10).cast("int").alias("row"), (F.col("col") - 7).cast("int").alias("col"), F.col("v").cast("float"))
    got = {(r.row, r.col): r.mean for r in px.focal_mean_var_3x3(table, tile=8).collect()}
    assert len(got) == 400
    for (r, c), mean in got.items():
        assert mean == pytest.approx(around(img, r + 10, c + 7, BOX).mean(), rel=1e-6)
    assert px.refined_lee(table.limit(0)).count() == 0
