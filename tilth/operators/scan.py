"""Ordered running values per key without putting a whole key in one task.

A plain window partitioned by station or by year sends all rows of that key to
one task, and one key may hold a third of the table. Here rows are cut into
sampled ranges of (key, order), sorted and written once, with the running
values inside their range worked out on Arrow batches as they stream by. One
row per (range, key) then tells what the ranges before and after bring along;
that small table is joined back, so rows are shuffled once whatever the keys.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilth.session import materialize

#: one running value: output name -> (kind, input column). Kinds:
#: ``sum``    running total of the non-null inputs, this row included;
#: ``count``  rows so far, this one included (the input is not looked at);
#: ``last``   nearest non-null input at or before this row;
#: ``next``   nearest non-null input at or after this row;
#: ``last_at``, ``next_at``  the same as (p, v) with the place of that row, counted from 1.
Specs = dict[str, tuple[str, str]]

BACKWARD = ("next", "next_at")


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    specs: Specs,
    drop: Sequence[str] = (),
) -> DataFrame:
    """Add the running values ``specs`` over ``keys``, ordered by ``order``; runs jobs.

    The input is written first, so that it is computed once: finding the
    ranges reads it too. ``drop`` names columns that only order the rows and
    are not to be carried on. Order columns tell the rows of a key apart, or a range can't cut between
    them. A row with NULL in a key or order column belongs to no series: it is
    kept, with NULL running values. A task holds a few Arrow batches at a time.
    """
    keys, order = list(keys), list(order)
    placed = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*keys, *order]], F.lit(True))
    forward = {out: s for out, s in specs.items() if s[0] not in BACKWARD}
    backward = {out: s for out, s in specs.items() if s[0] in BACKWARD}
    rows = materialize(df.withColumn("__placed", placed), "rows")
    ranged = rows.repartitionByRange("__placed", *keys, *order).sortWithinPartitions("__placed", *keys, *order)
    ranged = _pass(ranged.drop(*drop), keys, forward, first=True)
    if backward:
        ranged = _pass(ranged.sortWithinPartitions(F.desc("__at")), keys, backward, first=False)
    ranged = materialize(ranged, "ranges")
    carried = materialize(_carried(ranged.where("__placed"), keys, specs), "carried")
    joined = ranged.join(carried, on=["__part", *keys], how="left")
    return joined.select(
        *[c for c in df.columns if c not in specs and c not in drop],
        *[F.when(F.col("__placed"), _combine(kind, out)).alias(out) for out, (kind, _) in specs.items()],
    )


def _kind_of(kind: str, value: T.DataType) -> T.DataType:
    if kind == "count":
        return T.LongType()
    if kind == "sum":
        return value if isinstance(value, T.LongType) else T.DoubleType()
    return T.StructType([T.StructField("p", T.LongType()), T.StructField("v", value)]) if kind.endswith("_at") else value


def _pass(df: DataFrame, keys: list[str], specs: Specs, first: bool) -> DataFrame:
    """Running values inside each partition's stretch of a key, along the order its rows come in.

    The first pass numbers the rows: ``__part``, ``__at`` inside it, and ``__own`` inside (part, key).
    """
    inputs = {f"__in_{out}": F.col(col) for out, (kind, col) in specs.items() if kind != "count"}
    # sums are of doubles unless the input is a long
    for out, (kind, col) in specs.items():
        if kind == "sum" and not isinstance(df.schema[col].dataType, T.LongType):
            inputs[f"__in_{out}"] = F.col(col).cast("double")
    wide = df.withColumns(inputs)
    kept = [f for f in df.schema.fields if f.name not in specs]
    added = [T.StructField(c, T.LongType()) for c in ("__part", "__at", "__own")] if first else []
    added += [T.StructField(out, _kind_of(kind, wide.schema[f"__in_{out}"].dataType if kind != "count" else None)) for out, (kind, _) in specs.items()]
    names = [f.name for f in kept]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stretch = Stretch(keys, specs, TaskContext.get().partitionId(), first)
        for part in parts:
            if part.num_rows:
                new = stretch.add(part)
                columns = [part.column(part.schema.get_field_index(c)) for c in names] + list(new.values())
                yield pa.RecordBatch.from_arrays(columns, names=[*names, *new])

    return wide.mapInArrow(run, T.StructType([*kept, *added]))


class Stretch:
    """The state that one key's rows hand from batch to batch."""

    def __init__(self, keys: list[str], specs: Specs, number: int, first: bool):
        self.keys, self.specs, self.number, self.first = keys, specs, number, first
        self.key: list[pa.Scalar] | None = None
        self.seen = self.own = 0
        self.state: dict[str, object] = {}

    def _starts(self, batch: pa.RecordBatch) -> np.ndarray:
        """Marks rows whose key differs from the row before them."""
        n = batch.num_rows
        new = np.zeros(n, bool)
        key = []
        for c in [*self.keys, "__placed"]:
            column = batch.column(batch.schema.get_field_index(c))
            known = column.is_valid().to_numpy(zero_copy_only=False)
            differs = pc.fill_null(pc.not_equal(column.slice(1), column.slice(0, n - 1)), False).to_numpy(zero_copy_only=False)
            new[1:] |= differs | (known[1:] != known[:-1])
            key.append((column[0], column[n - 1]))
        new[0] = self.key is None or any(a.as_py() != k.as_py() for (a, _), k in zip(key, self.key))
        self.key = [b for _, b in key]
        return new

    def add(self, batch: pa.RecordBatch) -> dict[str, pa.Array]:
        n = batch.num_rows
        new = self._starts(batch)
        rows = np.arange(n)
        start = np.maximum.accumulate(np.where(new, rows, -1))  # -1: the key goes on from the batch before
        out: dict[str, pa.Array] = {}
        if self.first:
            own = np.where(start < 0, self.own + rows + 1, rows - start + 1)
            self.own = int(own[-1])
            out["__part"] = pa.array(np.full(n, self.number, np.int64))
            out["__at"] = pa.array(self.seen + rows)
            out["__own"] = pa.array(own)
            self.seen += n
        else:
            own = batch.column(batch.schema.get_field_index("__own")).to_numpy(zero_copy_only=False)
        for name, (kind, _) in self.specs.items():
            if kind == "count":
                out[name] = pa.array(own)
                continue
            column = batch.column(batch.schema.get_field_index(f"__in_{name}"))
            known = column.is_valid().to_numpy(zero_copy_only=False)
            out[name] = self._sum(name, column, known, start) if kind == "sum" else self._near(name, column, known, start, own, kind.endswith("_at"))
        return out

    def _sum(self, name: str, column: pa.Array, known: np.ndarray, start: np.ndarray) -> pa.Array:
        x = np.where(known, pc.fill_null(column, 0).to_numpy(zero_copy_only=False), 0)
        total = np.cumsum(x)
        whole = bool(np.isfinite(total[-1]))
        if not whole:  # one key's infinity stays its own
            cuts = [0, *np.flatnonzero(start[1:] != start[:-1]) + 1, len(x)]
            total = np.concatenate([np.cumsum(x[a:b]) for a, b in zip(cuts, cuts[1:])])
        times = np.cumsum(known)
        before, had = np.zeros_like(total), np.zeros_like(times)
        inside = start >= 0
        if whole:
            before[inside] = total[start[inside]] - x[start[inside]]
        had[inside] = times[start[inside]] - known[start[inside]]
        held, held_times = self.state.get(name, (x.dtype.type(0), 0))
        total = total - before + np.where(inside, x.dtype.type(0), held)
        times = times - had + np.where(inside, 0, held_times)
        self.state[name] = total[-1], times[-1]
        return pa.array(total, mask=times == 0)

    def _near(self, name: str, column: pa.Array, known: np.ndarray, start: np.ndarray, own: np.ndarray, at: bool) -> pa.Array:
        held = self.state.get(name)
        found = np.maximum.accumulate(np.where(known, np.arange(len(column)), -1))
        inside = found >= np.maximum(start, 0)
        # place 0 is what the batch before hands on
        place = np.where(inside, found + 1, np.where(start < 0, 0, -1))
        if held is None:
            place[place == 0] = -1
        values = pa.concat_arrays([pa.array([held[1].as_py() if held else None], column.type), column])
        places = np.concatenate([[held[0] if held else 0], own])
        taken = values.take(pa.array(place, mask=place < 0))
        last = int(place[-1])
        self.state[name] = (int(places[last]), taken[-1]) if last >= 0 else None
        if not at:
            return taken
        missing = place < 0
        p = pa.array(places[np.maximum(place, 0)], mask=missing)
        return pa.StructArray.from_arrays([p, taken], names=["p", "v"], mask=pa.array(missing))


def _combine(kind: str, out: str) -> Column:
    local, carried, base = F.col(out), F.col(f"__carry_{out}"), F.col("__base")
    if kind == "count":
        return local + base
    if kind == "sum":
        return F.coalesce(local + carried, local, carried)
    if kind.endswith("_at"):
        return F.coalesce(F.when(local.isNotNull(), F.struct((local["p"] + base).alias("p"), local["v"].alias("v"))), carried)
    return F.coalesce(local, carried)


def _carried(ranged: DataFrame, keys: list[str], specs: Specs) -> DataFrame:
    """One row per (range, key): the key's rows in ranges before, and what all other ranges bring into it."""

    def summary(kind: str, col: str) -> Column:
        if kind in ("sum", "count"):
            value = F.col(col) if isinstance(ranged.schema[col].dataType, T.LongType) else F.col(col).cast("double")
            return F.sum(value) if kind == "sum" else F.count(F.lit(1))
        known = F.when(F.col(col).isNotNull(), F.col("__at"))
        value = F.struct(F.col("__own").alias("p"), F.col(col).alias("v")) if kind.endswith("_at") else F.col(col)
        return F.min_by(value, known) if kind in BACKWARD else F.max_by(value, known)

    own = ranged.groupBy("__part", *keys).agg(
        F.count(F.lit(1)).alias("__n"), *[summary(kind, col).alias(f"__sum_{out}") for out, (kind, col) in specs.items()]
    )
    past = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.partitionBy(*keys).orderBy(F.desc("__part")).rowsBetween(Window.unboundedPreceding, -1)
    own = own.withColumn("__base", F.coalesce(F.sum("__n").over(past), F.lit(0)))

    def carry(kind: str, out: str) -> Column:
        value = F.col(f"__sum_{out}")
        if kind == "sum":
            return F.sum(value).over(past)
        if kind == "count":
            return F.lit(None).cast("long")
        if kind.endswith("_at"):
            value = F.when(value["v"].isNotNull(), F.struct((value["p"] + F.col("__base")).alias("p"), value["v"].alias("v")))
        return F.last(value, ignorenulls=True).over(ahead if kind in BACKWARD else past)

    return own.select("__part", *keys, "__base", *[carry(kind, out).alias(f"__carry_{out}") for out, (kind, _) in specs.items()])
