"""Balanced value ranges for distributed running sums and rank selection.

Exact quantiles and exact curves both need, for every distinct value, the
number of rows on one side of it.  Doing that with one window over a group
puts the whole group into one task.  Instead the values are cut into ranges
of similar size and the running sum is split into "offset of the range"
(from a small table of range totals) plus "running sum inside the range"
(a window partitioned by range).

The cut points are approximate quantiles of the values (one sketch job,
bounded result: groups x ranges), so ranges stay balanced whatever the
value distribution.  The number of ranges grows with the number of distinct
values, so a range holds at most about ``RANGE_TARGET`` of them.  The cut
table re-enters the plan as a small literal DataFrame (every branch sees the
same ranges) and a value finds its range with a multi-level search over
``SEGMENT``-sized slices (a few dozen comparisons, built-in functions only).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEGMENT = 32
MIN_RANGES = 256
MAX_RANGES = SEGMENT ** 3          # three search levels
RANGE_TARGET = 20_000_000          # distinct values per range task at most (about)
SINGLE_LIMIT = 1_000_000           # rows per group up to which one window partition is used


def n_ranges_for(distinct: int, minimum: int = MIN_RANGES) -> int:
    """Ranges needed so each holds at most about ``RANGE_TARGET`` distinct values."""
    return int(min(max(minimum, math.ceil(distinct / RANGE_TARGET)), MAX_RANGES))


def _levels(cuts: list[float]) -> list[list[float]]:
    """Search levels, coarsest first: every SEGMENT**k-th cut, ..., every cut."""
    depth = 1
    while SEGMENT ** depth < len(cuts) + 1:
        depth += 1
    return [cuts[SEGMENT ** k - 1::SEGMENT ** k] for k in range(depth - 1, 0, -1)] + [cuts]


def count_below(v: Column, levels: Sequence[Column]) -> Column:
    """Number of cuts strictly below ``v`` given the level arrays (coarsest first).

    At each level the count so far, k, says the first k x SEGMENT entries of the
    next level are below ``v`` and the entry at k x SEGMENT + SEGMENT - 1 is
    not, so only one SEGMENT-long slice needs comparing.
    """
    k = F.size(F.filter(levels[0], lambda c: c < v))
    for arr in levels[1:]:
        seg = F.slice(F.concat(arr, F.array(F.lit(float("inf")))), k * SEGMENT + 1, SEGMENT)
        k = k * SEGMENT + F.size(F.filter(seg, lambda c: c < v))
    return k


def join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` that matches NULL to NULL (group keys may be NULL)."""
    keys = list(keys)
    if not keys:
        return left.crossJoin(right)
    renamed = right.withColumnsRenamed({k: f"__jk_{k}" for k in keys})
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(renamed[f"__jk_{k}"])
        cond = c if cond is None else cond & c
    return left.join(renamed, cond, how).drop(*[f"__jk_{k}" for k in keys])


def assign_ranges(df: DataFrame, keys: Sequence[str], value: str, n_ranges: int,
                  accuracy: int | None = None, out: str = "__r") -> DataFrame:
    """Append the range index (0 = lowest values) of ``value`` within its group."""
    keys = list(keys)
    n_ranges = max(1, int(n_ranges))
    if n_ranges == 1:
        return df.withColumn(out, F.lit(0))
    acc = max(accuracy or 10000, 8 * n_ranges)
    probs = [i / n_ranges for i in range(1, n_ranges)]
    sketch = df.groupBy(*keys).agg(F.percentile_approx(F.col(value), probs, acc).alias("cuts")).collect()
    depth = len(_levels([0.0] * (n_ranges - 1)))
    rows = []
    for r in sketch:
        cuts = [float(c) for c in sorted(r["cuts"] or [])]
        levels = _levels(cuts)
        levels = [[]] * (depth - len(levels)) + levels  # same depth for every group
        rows.append((*[r[k] for k in keys], *levels))
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    schema = ", ".join([f"`{k}` {types[k]}" for k in keys] + [f"__lv{i} array<double>" for i in range(depth)])
    table = F.broadcast(df.sparkSession.createDataFrame(rows, schema))  # groups x ranges doubles
    j = join_on_keys(df, table, keys)
    lv = [F.col(f"__lv{i}") for i in range(depth)]
    return j.withColumn(out, count_below(F.col(value), lv)).drop(*[f"__lv{i}" for i in range(depth)])


def running_sum_desc(df: DataFrame, order: str, cols: Sequence[str], n_ranges: int | None = None,
                     by: Sequence[str] = ()) -> DataFrame:
    """Add ``cum_<c>`` = sum of ``c`` over all rows of the group whose ``order`` is >= this row's.

    ``df`` holds one row per distinct ``order`` value and group (NULL ``order``
    not allowed).  ``n_ranges=None`` counts the rows per group (one small job):
    up to ``SINGLE_LIMIT`` a group is one window partition, beyond it balanced
    ranges split the running sum into range offsets plus a window per range.
    """
    by = list(by)
    if n_ranges is None:
        sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("d")).collect()  # one row per group
        d = max((r["d"] for r in sizes), default=0)
        n_ranges = 1 if d <= SINGLE_LIMIT else n_ranges_for(d)
    c = assign_ranges(df, by, order, n_ranges)  # 0 = lowest values
    totals = c.groupBy(*by, "__r").agg(*[F.sum(x).alias(f"__t_{x}") for x in cols])
    higher = Window.partitionBy(*by).orderBy(F.desc("__r")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*by, "__r",
                            *[F.coalesce(F.sum(f"__t_{x}").over(higher), F.lit(0)).alias(f"__o_{x}") for x in cols])
    # offsets: one row per (group, range), bounded by the group count and the range count
    j = join_on_keys(c, F.broadcast(offsets), [*by, "__r"])
    within = Window.partitionBy(*by, "__r").orderBy(F.desc(order)) \
                   .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    keep = [f for f in df.columns]
    return j.select(*keep, *[(F.col(f"__o_{x}") + F.sum(x).over(within)).alias(f"cum_{x}") for x in cols])
