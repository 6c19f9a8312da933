"""Exponential means over long series, by blocks.

y = (1 - a) y' + a x is an affine map of the state before it, and maps compose. Each block of a series gives one map for
each mean; folding the maps in order gives the state at the start of every block, and a second pass over the blocks fills
the values in. So a series is never gathered in one task; only a row a block is.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

Mean = tuple[str, str, float, int]  #: output column, input column, alpha, inputs needed before the first value


def scan(x: np.ndarray, reset: np.ndarray, alpha: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """factor and offset of each place: the value there is factor * state + offset, for the state before the first place.

    x and reset have a row for each mean. Maps are composed in rounds of doubling distance, so work is n log n in arrays;
    a missing input is the identity, a reset forgets the state.
    """
    missing = np.isnan(x)
    a = alpha[:, None]
    factor = np.where(missing, 1.0, np.where(reset, 0.0, 1 - a))
    offset = np.where(missing, 0.0, np.where(reset, 1.0, a) * np.nan_to_num(x))
    step = 1
    while step < x.shape[1]:
        offset[:, step:] += factor[:, step:] * offset[:, :-step]
        factor[:, step:] *= factor[:, :-step]
        step *= 2
    return factor, offset


def _local(t: pa.Table, means: Sequence[Mean], section: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a block in order: factor and offset, inputs so far in the section, the first section's first input, its rows.

    All but the last two have a row for each mean. Counts and maps take the block's first section for one that goes on; a
    section that begins within the block starts with a reset.
    """
    x = np.stack([t.column(m[1]).to_numpy().astype(float) for m in means])
    part = t.column(section).to_numpy()
    given = ~np.isnan(x)
    n = np.cumsum(given, axis=1)
    start = np.flatnonzero(np.r_[False, part[1:] != part[:-1]])
    begun = np.zeros_like(n)
    begun[:, start] = n[:, start - 1]
    n = n - np.maximum.accumulate(begun, axis=1)
    head = part == part[0]
    factor, offset = scan(x, given & (n == 1) & ~head, np.array([m[2] for m in means]))
    ours = given & head
    first = np.where(ours.any(axis=1), x[np.arange(len(x)), ours.argmax(axis=1)], 0.0)
    return factor, offset, n, first, head


def ewm(df: DataFrame, means: Sequence[Mean], keys: Sequence[str] = ("symbol",), time: str = "open_time", section: str = "section", block: str = "day") -> DataFrame:
    """Adds the means. `section` parts a series into runs that start afresh; rows without an input are passed over.

    An output is null until its run has given enough inputs, and where the input is null. Rows are dealt out once, by key
    and block, and both passes read that exchange. A run that has no input before a block starts from the block's first
    one: a state that equals the input stays as it is, so no case of its own is needed.
    """
    rows = df.withColumn("_block", F.date_trunc(block, F.col(time))).repartition(*keys, "_block")
    group = [*keys, "_block"]
    numbered = lambda kind: [f"_{kind}{i}" for i in range(len(means))]
    head = sorted((f for f in rows.schema if f.name in group), key=lambda f: group.index(f.name))
    doubles = lambda kinds: [StructField(c, DoubleType()) for kind in kinds for c in numbered(kind)]
    order = lambda t, by: t.take(pc.sort_indices(t, [(by, "ascending")]))

    def last(t: pa.Table) -> pa.Table:
        """A row for the block: its map, the first input, how many inputs its last section has, and its outer sections."""
        t = order(t, time)
        factor, offset, n, first, _ = _local(t, means, section)
        values = [*factor[:, -1], *offset[:, -1], *first, *n[:, -1].astype(float)]
        ends = t.column(section)
        return pa.Table.from_arrays([*(t.column(c).slice(0, 1) for c in group), ends.slice(0, 1), ends.slice(t.num_rows - 1), *(pa.array([float(v)]) for v in values)], [*group, "_from", "_to", *(c for kind in "foxn" for c in numbered(kind))])

    outer = [StructField(c, rows.schema[section].dataType) for c in ("_from", "_to")]
    blocks = rows.groupBy(*group).applyInArrow(last, StructType([*head, *outer, *doubles("foxn")]))

    def fold(t: pa.Table) -> pa.Table:
        """The state and the section's number of inputs before each block of a series."""
        t = order(t, "_block")
        factor, offset, first, n = (np.stack([t.column(c).to_numpy() for c in numbered(kind)]) for kind in "foxn")
        start, end = t.column("_from").to_pylist(), t.column("_to").to_pylist()
        state, seen = np.zeros_like(factor), np.zeros_like(factor)
        y = count = np.zeros(len(means))
        for k in range(t.num_rows):
            count = count if k and end[k - 1] == start[k] else np.zeros(len(means))
            state[:, k], seen[:, k] = np.where(count > 0, y, first[:, k]), count
            y = factor[:, k] * state[:, k] + offset[:, k]
            count = n[:, k] + (count if start[k] == end[k] else 0)
        return pa.Table.from_arrays([*(t.column(c) for c in group), *map(pa.array, state), *map(pa.array, seen)], [*group, *numbered("s"), *numbered("c")])

    carried = blocks.groupBy(*keys).applyInArrow(fold, StructType([*head, *doubles("sc")]))
    names = df.columns

    def fill(t: pa.Table, before: pa.Table) -> pa.Table:
        t = order(t, time)
        factor, offset, n, _, ours = _local(t, means, section)
        for i, (name, c, _, least) in enumerate(means):
            y = factor[i] * before.column(f"_s{i}")[0].as_py() + offset[i]
            few = n[i] + ours * before.column(f"_c{i}")[0].as_py() < least
            t = t.append_column(name, pa.array(y, mask=few | np.isnan(t.column(c).to_numpy().astype(float))))
        return t.select([*names, *(m[0] for m in means)])

    out = StructType([*df.schema, *(StructField(m[0], DoubleType()) for m in means)])
    return rows.groupBy(*group).cogroup(carried.groupBy(*group)).applyInArrow(fill, out)
