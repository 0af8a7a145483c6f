"""Image pixels as a table ``(scene, band, row, col, v)``; NULL v is masked.

Neighbourhood operators cut the image into square tiles. A pixel is copied to
the tiles whose rim it lies in, tiles are shuffled once, and each is worked on
as one dense array, so a scene of any size spreads over all tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilth.functions.columns import db_to_power, doy_of, power_to_db, year_of
from tilth.operators.quantiles import exact_median
from tilth.session import materialize

# Mask threshold in dB and the samples kept for the noise estimate.
EDGE_DB = -30.0
NOISE_SAMPLES = 5
TILE = 64
#: Pixels of a cell in the buffer join before it is quartered, and how often at most.
CELL_POINTS, CELL_DEPTH = 20_000, 6


def buffer_range_join(
    pixels: DataFrame,
    stations: DataFrame,
    distance: float,
    x: str = "x",
    y: str = "y",
    most: int = CELL_POINTS,
) -> DataFrame:
    """Pixels within ``distance`` of a station's point, with the station's id; runs jobs that count pixels.

    ``stations`` has ``station, sx, sy`` in the pixels' units. The plane is cut
    into cells eight distances wide. A cell with more than ``most`` pixels is
    quartered as often as their number asks for, up to ``CELL_DEPTH`` times;
    what is still fuller then (one crowded spot) is dealt over salted copies of
    the cell. Stations go to all cells that their circle can touch, pixels to
    their own, and pairs are told by exact distance. Rows without coordinates
    match nothing.
    """
    if distance < 0:
        raise ValueError("distance must not be negative")
    root = 8.0 * (float(distance) or 1.0)
    whole = lambda c, side: F.floor(c / side).cast("long")
    at = pixels.withColumns({"__bx": whole(F.col(x), F.lit(root)), "__by": whole(F.col(y), F.lit(root))})
    # quarters needed for the pixels of a full cell, were they spread evenly
    depth = F.least(F.ceil(F.log(F.col("n") / most) / F.log(F.lit(4.0))), F.lit(CELL_DEPTH)).cast("int").alias("__level")
    full = at.groupBy("__bx", "__by").agg(F.count("*").alias("n")).where(F.col("n") > most).select("__bx", "__by", depth)
    full = materialize(full, "full-cells")

    def leveled(df: DataFrame) -> DataFrame:
        """Adds the level of the cell ``__bx, __by`` and the width of its parts."""
        out = df.join(full, ["__bx", "__by"], "left").withColumn("__level", F.coalesce("__level", F.lit(0)))
        return out.withColumn("__side", F.lit(root) / F.pow(F.lit(2.0), F.col("__level")))

    placed = leveled(at).withColumns({"__cx": whole(F.col(x), F.col("__side")), "__cy": whole(F.col(y), F.col("__side"))})
    crowds = placed.where("__level > 0").groupBy("__level", "__cx", "__cy").agg(F.count("*").alias("n"))
    salts = F.ceil(F.col("n") / most).cast("int").alias("__salts")
    crowds = materialize(crowds.where(F.col("n") > most).select("__level", "__cx", "__cy", salts), "crowds")

    def salted(df: DataFrame) -> DataFrame:
        return df.join(crowds, ["__level", "__cx", "__cy"], "left").withColumn("__salts", F.coalesce("__salts", F.lit(1)))

    spots = salted(placed).withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.col("__salts")).cast("int"))

    def span(centre: str, side: Column) -> Column:
        return F.sequence(whole(F.col(centre) - distance, side), whole(F.col(centre) + distance, side))

    near = stations.select("station", "sx", "sy").where("sx is not null and sy is not null")
    near = leveled(near.withColumn("__bx", F.explode(span("sx", F.lit(root)))).withColumn("__by", F.explode(span("sy", F.lit(root)))))
    near = near.withColumn("__cx", F.explode(span("sx", F.col("__side")))).withColumn("__cy", F.explode(span("sy", F.col("__side"))))
    parts = F.pow(F.lit(2.0), F.col("__level"))
    inside = (F.floor(F.col("__cx") / parts) == F.col("__bx")) & (F.floor(F.col("__cy") / parts) == F.col("__by"))
    near = salted(near.where(inside)).withColumn("__salt", F.explode(F.sequence(F.lit(0), F.col("__salts") - 1)))
    near = materialize(near.select("station", "sx", "sy", "__level", "__cx", "__cy", "__salt"), "station-cells")

    dx, dy = F.col(x) - F.col("sx"), F.col(y) - F.col("sy")
    found = spots.join(near, on=["__level", "__cx", "__cy", "__salt"]).where(dx * dx + dy * dy <= float(distance) ** 2)
    return found.select("station", *pixels.columns)


def edge_mask(df: DataFrame, col: str = "v", threshold: float = EDGE_DB) -> DataFrame:
    """Mask values below the threshold (dB)."""
    return df.withColumn(col, F.when(F.col(col) >= threshold, F.col(col)))


def to_power(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: db_to_power(c) for c in cols})


def to_db(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: power_to_db(c) for c in cols})


def attach_date_and_crop(
    pixels: DataFrame, crop_maps: DataFrame, ts: str = "date", map_ts: str = "map_date"
) -> DataFrame:
    """Add year, day of year and the class of the year's first crop map.

    ``crop_maps`` has ``map_date, row, col, lc``.
    """
    first = (
        crop_maps.withColumn("year", year_of(map_ts))
        .groupBy("year", "row", "col")
        .agg(F.min_by("lc", map_ts).alias("lc"))
    )
    return pixels.withColumns({"year": year_of(ts), "doy": doy_of(ts)}).join(
        first, on=["year", "row", "col"], how="left"
    )


def _on_tiles(df: DataFrame, halo: int, scene: Sequence[str], tile: int, kernel: Callable, out: dict[str, str]) -> DataFrame:
    """``kernel`` on every tile as a dense array with a rim of ``halo`` pixels, for the tile's own live pixels.

    The kernel gets the array (NaN where masked or absent) and returns one
    array of the tile's size per column of ``out``; NaN becomes NULL. Only rim
    pixels are copied, and the tiles' grouping is the only shuffle.
    """
    size = tile + 2 * halo

    def touched(axis: str) -> Column:
        at = F.col(axis)
        return F.sequence(F.floor((at - halo) / tile), F.floor((at + halo) / tile))

    place = {axis: F.col(axis).cast("long").alias(axis) for axis in ("row", "col")}
    source = df.select(*scene, *place.values(), F.col("v").cast("double").alias("v"))
    tiles = source.withColumn("__tr", F.explode(touched("row"))).withColumn("__tc", F.explode(touched("col")))
    fields = {f.name: f.dataType.simpleString() for f in source.schema.fields if f.name in (*scene, "row", "col")}
    schema = ", ".join(f"`{c}` {kind}" for c, kind in (fields | out).items())

    def run(key: tuple, group: pa.Table) -> pa.Table:
        tr, tc = (k.as_py() for k in key[-2:])
        r = group.column("row").to_numpy() - (tr * tile - halo)
        c = group.column("col").to_numpy() - (tc * tile - halo)
        v = group.column("v").to_numpy(zero_copy_only=False)
        dense = np.full((size, size), np.nan)
        dense[r, c] = v
        own = np.flatnonzero(~np.isnan(v) & (r >= halo) & (r < size - halo) & (c >= halo) & (c < size - halo))
        columns = [group.column(name).take(pa.array(own)) for name in fields]
        with np.errstate(all="ignore"):
            found = kernel(dense)
        columns += [pa.array(a[r[own] - halo, c[own] - halo], from_pandas=True) for a in found]
        return pa.table(columns, names=[*fields, *out])

    return tiles.groupBy(*scene, "__tr", "__tc").applyInArrow(run, schema)


def _shifted(dense: np.ndarray, dr: int, dc: int, halo: int) -> np.ndarray:
    """The array moved by an offset, cut to what lies ``halo`` inside."""
    rows, cols = dense.shape
    return dense[halo + dr : rows - halo + dr, halo + dc : cols - halo + dc]


def _box_stats(dense: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """3x3 mean and population variance one pixel inside the array; NaN where the pixel itself is."""
    near = np.stack([_shifted(dense, dr, dc, 1) for dr in (-1, 0, 1) for dc in (-1, 0, 1)])
    live = ~np.isnan(near)
    n = live.sum(axis=0)
    mean = np.where(live, near, 0.0).sum(axis=0) / n
    var = np.where(live, (near - mean) ** 2, 0.0).sum(axis=0) / n
    masked = ~live[4]
    mean[masked] = var[masked] = np.nan
    return mean, var


def focal_mean_var_3x3(
    pixels: DataFrame, scene: Sequence[str] = ("scene", "band"), tile: int = TILE
) -> DataFrame:
    """Mean and population variance of each live pixel's 3x3 neighbourhood.

    Masked and absent neighbours are left out. A scene has one row per pixel.
    """

    def kernel(dense: np.ndarray) -> tuple[np.ndarray, ...]:
        return (_shifted(dense, 0, 0, 1), *_box_stats(dense))

    return _on_tiles(pixels, 1, scene, tile, kernel, {"v": "double", "mean": "double", "var": "double"})


def _half_windows() -> list[list[tuple[int, int]]]:
    """Members of the eight 7x7 half windows: edge-on and diagonal, by quarter turns.

    The first is the lower half with the centre row, the second the triangle
    below the main diagonal with the diagonal itself; each further pair is the
    previous pair turned by a right angle.
    """
    side = range(-3, 4)
    straight = [(r, c) for r in side for c in side if r >= 0]
    diagonal = [(r, c) for r in side for c in side if c <= r]
    out = []
    for _ in range(4):
        out += [straight, diagonal]
        straight = [(c, -r) for r, c in straight]
        diagonal = [(c, -r) for r, c in diagonal]
    return out


def refined_lee(
    pixels: DataFrame, scene: Sequence[str] = ("scene", "band"), tile: int = TILE
) -> DataFrame:
    """Speckle filter on power values (7x7, edge-aligned half windows).

    Nine 3x3 means sampled two pixels apart give four gradients; the steepest,
    and the side of the edge the centre resembles more, pick one of eight half
    windows. With its mean m and variance var, and the noise level n taken as
    the mean of the five smallest var/mean^2 of the samples, the result is
    m + b (z - m), b = (var - m^2 n) / ((1 + n) var). Equal steepest
    gradients mark several directions, whose numbers add up; a sum above 8 has
    no window. Such pixels, and those with a masked or absent sample, come out
    masked.
    """
    return _on_tiles(pixels, 3, scene, tile, _lee_kernel, {"v": "double"})


# Opposite samples across the centre, in the order of the half windows.
_OPPOSITE = ((1, 7), (6, 2), (3, 5), (0, 8))


def _lee_kernel(dense: np.ndarray) -> tuple[np.ndarray]:
    mean, var = _box_stats(dense)  # two pixels more than the tile on each side
    ring = [(2 * i, 2 * j) for i in (-1, 0, 1) for j in (-1, 0, 1)]
    m = np.stack([_shifted(mean, dr, dc, 2) for dr, dc in ring])
    s = np.stack([_shifted(var, dr, dc, 2) for dr, dc in ring])
    gradients = np.stack([np.abs(m[a] - m[b]) for a, b in _OPPOSITE])
    steepest = gradients.max(axis=0)
    direction = np.zeros(steepest.shape, np.int64)
    for i, (a, b) in enumerate(_OPPOSITE):
        toward = np.where(m[a] - m[4] > m[4] - m[b], i + 1, i + 5)
        direction += np.where(gradients[i] == steepest, toward, 0)
    ratios = np.where(m != 0, s / (m * m), np.nan)
    noise = np.sort(ratios, axis=0)[:NOISE_SAMPLES].sum(axis=0) / NOISE_SAMPLES
    noise[np.isnan(ratios).any(axis=0)] = np.nan
    z = _shifted(dense, 0, 0, 3)
    out = np.full(z.shape, np.nan)
    wanted = ~np.isnan(z) & ~np.isnan(noise)
    for k, members in enumerate(_half_windows()):
        r, c = np.nonzero(wanted & (direction == k + 1))
        near = dense[r[:, None] + [3 + dr for dr, _ in members], c[:, None] + [3 + dc for _, dc in members]]
        live = ~np.isnan(near)
        n = live.sum(axis=1)
        wm = np.where(live, near, 0.0).sum(axis=1) / n
        wv = np.where(live, (near - wm[:, None]) ** 2, 0.0).sum(axis=1) / n
        level = noise[r, c]
        weight = np.where(wv != 0, (wv - wm * wm * level) / (level + 1.0) / wv, np.nan)
        out[r, c] = wm + weight * (z[r, c] - wm)
    return (out,)


def zonal_median(
    pixels: DataFrame, by: Sequence[str] = ("station", "scene", "band"), value: str = "v"
) -> DataFrame:
    """Exact median of each band over each zone."""
    return exact_median(pixels, by, value, out="median")
