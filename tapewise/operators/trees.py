"""Exact decision trees and forests, grown level by level on Spark and finished node by node.

Trees come in batches, so that the rows in motion and every task stay bounded
whatever their number:

1. A forest's bootstrap weight is a Poisson draw hashed from tree and row key, so a
   lost task draws the same again.  A table of at most ``local_rows`` rows is packed
   into blocks and dealt to tasks of ``TASK_TREES`` trees each, which draw the weights
   and grow whole trees; rows with the same values and label are one row with their
   summed weight where that halves them.  A larger table of at
   most ``MOST_CELLS`` such cells is summed per tree and cell where its rows lie, and a
   tree grows from its cells.  The rows of other large tables are dealt to the trees of
   a batch.
2. While a node holds more than ``local_rows`` rows, its cuts are searched by
   Spark: rows collapse to one cell per (node, feature, value), a running sum over
   the cells, in ranges of values with offsets, gives both sides of every cut, and
   the best one is an aggregate.  No range, node or feature has to fit one task.
3. A node of fewer rows goes to one task, which grows the subtree under it by the
   same rules (``functions/tree_kernel.py``).  Where the hand-over happens changes
   the work only, not the trees.

Cuts are searched between all distinct values; nothing is binned.  Subtrees and
upper cuts are written to the shared folder.  Scoring sends packed blocks of rows to
the tasks of ``TASK_TREES`` trees, which return the sums of the leaves' shares; with
upper cuts, rows go down them by joins, then meet the subtrees in blocks.  ``root_to_leaf`` returns the
weights and class shares along each row's path, so that any ``max_depth`` or
``min_samples_split`` of a tree is read off the full tree's path.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapewise.functions import tree_kernel
from tapewise.session import stored

cloudpickle.register_pickle_by_value(tree_kernel)

FEATURES, LABEL = "features", "label"
#: Rows of a node that one task takes over (some 200 bytes each there); rows scored in one block.
LOCAL_ROWS = 1 << 20
#: Trees that one task grows or scores.
TASK_TREES = 8
#: Trees whose rows are in motion together.
BATCH_TREES = 200
#: Cells of equal values and label up to which a table of more than ``local_rows`` rows is summed per tree and cell.
MOST_CELLS = 4096
#: Ranges of values per feature for the running sums.
RANGES = 256
SUBTREE = ("tree int, node long, feature array<int>, threshold array<double>, left array<int>, right array<int>, "
           "n array<double>, n1 array<double>, gain array<double>")
KINDS = {"feature": "int32", "threshold": "float64", "left": "int32", "right": "int32", "n": "float64", "n1": "float64"}


@dataclass(frozen=True)
class TreePlan:
    """One tree to grow; ``min_leaf`` and ``min_split`` are row weights, ``max_features`` None means all."""

    tree: int
    seed: int = 0
    bootstrap: bool = False
    max_features: int | None = None
    min_leaf: float = 1.0
    min_split: float = 2.0
    max_depth: int | None = None


def _poisson(draw: Column, most: int = 12) -> Column:
    """Poisson(1) weight of a uniform draw."""
    below, out = 0.0, F.lit(float(most))
    chances = [math.exp(-1) / math.factorial(k) for k in range(most)]
    steps = [sum(chances[:k + 1]) for k in range(most)]
    for k in range(most - 1, -1, -1):
        out = F.when(draw < F.lit(steps[k]), F.lit(float(k))).otherwise(out)
    return out


def _matrix(table: pa.Table, name: str) -> np.ndarray:
    column = table.column(name).combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(table), -1)


def packed(rows: DataFrame, p: int, *lists: str) -> DataFrame:
    """Rows (row long, y double, x array<double> of ``p`` values, where present) as blocks of bytes; columns in ``lists`` as arrays."""
    kinds = {"row": "<i8", "y": "<f8"}
    names = [c for c in ("row", "y") if c in rows.columns]

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            out = [pa.array([table.column(c).to_numpy().astype(kinds[c]).tobytes()], pa.binary()) for c in names]
            out.append(pa.array([np.ascontiguousarray(_matrix(table, "x"), "<f8").tobytes()], pa.binary()))
            for c in lists:
                values = table.column(c).combine_chunks()
                values = values.chunk(0) if isinstance(values, pa.ChunkedArray) else values
                out.append(pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values))
            yield pa.RecordBatch.from_arrays(out, names=[*names, "x", *lists])

    schema = [f"{c} binary" for c in (*names, "x")] + [f"`{c}` array<{rows.schema[c].dataType.simpleString()}>" for c in lists]
    return rows.select(*names, "x", *lists).mapInArrow(run, ", ".join(schema))


def unpacked(table: pa.Table, name: str, kind: str, p: int | None = None) -> np.ndarray:
    """A column of blocks as one array (rows of ``p`` values each)."""
    found = np.frombuffer(b"".join(v.as_py() for v in table.column(name)), kind)
    return found if p is None else found.reshape(-1, p)


def _middle(low: Column, high: Column) -> Column:
    mid = low + (high - low) / 2
    return F.when((mid < high) & (mid > float("-inf")), mid).otherwise(low)


def _with_order(frames, seeds: dict, p: int):
    """Add each node's feature order and its children's ids."""
    for pdf in frames:
        ids = pdf["node"].to_numpy("int64").view(np.uint64)
        seed = pdf["tree"].map(seeds).to_numpy("int64")
        order = np.zeros((len(pdf), p), "int64")
        for s in np.unique(seed):
            order[seed == s] = tree_kernel.feature_order(ids[seed == s], int(s), p)
        yield pdf.assign(order=list(order), left_id=tree_kernel.child_ids(ids, 0).view("int64"),
                         right_id=tree_kernel.child_ids(ids, 1).view("int64"))


def _ranges(frames, cuts: list[np.ndarray]):
    for pdf in frames:
        x = np.stack(pdf["x"]) if len(pdf) else np.zeros((0, len(cuts)))
        found = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
        yield pdf.assign(ranges=list(found.astype("int32")))


def _best_cuts(cells: DataFrame, frontier: DataFrame, limits: DataFrame) -> DataFrame:
    """Per node of ``frontier`` the best cut: feature, threshold; from cells (tree, node, f, r, v, w, w1)."""
    group = ["tree", "node", "f"]
    inside = Window.partitionBy(*group, "r").orderBy("v")
    run = inside.rowsBetween(Window.unboundedPreceding, 0)
    inner = cells.select(*group, "r", "v", F.sum("w").over(run).alias("l"), F.sum("w1").over(run).alias("l1"), F.lead("v").over(inside).alias("next"))
    ranges = cells.groupBy(*group, "r").agg(F.sum("w").alias("w"), F.sum("w1").alias("w1"), F.min("v").alias("least"))
    along = Window.partitionBy(*group).orderBy("r")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(*group, "r", F.coalesce(F.sum("w").over(earlier), F.lit(0.0)).alias("b"),
                           F.coalesce(F.sum("w1").over(earlier), F.lit(0.0)).alias("b1"), F.lead("least").over(along).alias("after"))
    cuts = inner.join(ranges, [*group, "r"]).select(*group, "v", (F.col("b") + F.col("l")).alias("l"), (F.col("b1") + F.col("l1")).alias("l1"),
                                                    F.coalesce("next", "after").alias("next")).filter("next is not null")
    cuts = cuts.join(frontier.select("tree", "node", "n", "n1", "order"), ["tree", "node"]).join(F.broadcast(limits), "tree")
    cuts = cuts.withColumns({"q": F.col("n") - F.col("l"), "q1": F.col("n1") - F.col("l1")}).filter("l >= min_leaf and q >= min_leaf")

    def pure(a, b):
        return (F.col(b) * F.col(b) + (F.col(a) - F.col(b)) * (F.col(a) - F.col(b))) / F.col(a)

    best = F.max(F.struct((pure("l", "l1") + pure("q", "q1")).alias("score"), (-F.col("v")).alias("low"), _middle(F.col("v"), F.col("next")).alias("threshold")))
    per = cuts.groupBy(*group).agg(best.alias("best"), F.first("order").alias("order"), F.first("max_features").alias("max_features"))
    tried = Window.partitionBy("tree", "node").orderBy(F.array_position("order", F.col("f").cast("long")))
    per = per.withColumn("tried", F.row_number().over(tried)).filter("tried <= max_features")
    top = per.groupBy("tree", "node").agg(F.max(F.struct("best.score", (-F.col("f")).alias("f"), "best.threshold")).alias("top"))
    return top.select("tree", "node", (-F.col("top.f")).alias("f"), F.col("top.threshold").alias("threshold"))


def _grow_group(plans: dict, depth: int):
    def run(key, table):
        tree, node = key[0].as_py(), key[1].as_py()
        plan = plans[tree]
        y, w = (table.column(c).to_numpy().astype("float64") for c in ("y", "w"))
        found = tree_kernel.grow(_matrix(table, "x"), y, w, node, depth, plan.seed, plan.max_features, plan.min_leaf, plan.min_split,
                                 plan.max_depth)
        columns = [pa.array([tree], pa.int32()), pa.array([node], pa.int64())]
        columns += [pa.array([found[k].astype(kind)]) for k, kind in KINDS.items()]
        columns.append(pa.array([tree_kernel.importances(found, len(table.column("x")[0]))], pa.list_(pa.float64())))
        return pa.Table.from_arrays(columns, names=["tree", "node", *KINDS, "gain"])

    return run


def _grow_whole(plans: Sequence[TreePlan], seeds: dict, p: int):
    """All trees of one task on a whole packed table."""
    def run(key, table):
        mine = plans[key[0].as_py() * TASK_TREES:][:TASK_TREES]
        row, y, x = unpacked(table, "row", "<i8"), unpacked(table, "y", "<f8"), unpacked(table, "x", "<f8", p)
        codes = tree_kernel.value_codes(x)
        cell = tree_kernel.alike(codes, y)
        if cell is not None:
            first = np.unique(cell, return_index=True)[1]
            x, y, codes = x[first], y[first], codes[first]
        values = tree_kernel.values_of(x, codes)
        out = []
        for plan in mine:
            w = np.ones(len(row))
            if plan.bootstrap:
                draw = tree_kernel.xxhash64(row, seeds[plan.tree]) >> np.uint64(11)
                w = tree_kernel.poisson(draw.astype("float64") / float(1 << 53))
            if cell is not None:
                w = np.bincount(cell, w, len(y))
            own = w > 0
            if own.any():
                found = tree_kernel.grow(None, y[own], w[own], tree_kernel.ROOT, 0, plan.seed, plan.max_features, plan.min_leaf, plan.min_split,
                                         plan.max_depth, codes[own], values)
                gain = tree_kernel.importances(found, p)
                out.append((plan.tree, {k: found[k].astype(kind) for k, kind in KINDS.items()}, gain))
        columns = [pa.array([t for t, *_ in out], pa.int32()), pa.array([tree_kernel.ROOT] * len(out), pa.int64())]
        columns += [pa.array([found[k] for _, found, _ in out], pa.list_(pa.from_numpy_dtype(kind))) for k, kind in KINDS.items()]
        columns.append(pa.array([gain for *_, gain in out], pa.list_(pa.float64())))
        return pa.Table.from_arrays(columns, names=["tree", "node", *KINDS, "gain"])

    return run


def _cells(base: DataFrame) -> DataFrame | None:
    """The distinct (x, y) of a large table with their numbers, if they are few."""
    if base.agg(F.approx_count_distinct(F.xxhash64("x", "y"))).first()[0] > MOST_CELLS:
        return None
    rows = base.select("x", "y").distinct().limit(2 * MOST_CELLS + 1).collect()  # a bounded number: the estimate is within 5 %
    if len(rows) > 2 * MOST_CELLS:
        return None
    return base.sparkSession.createDataFrame([(i, r["x"], r["y"]) for i, r in enumerate(rows)], "cell int, x array<double>, y double")


def _grow_cells(base: DataFrame, cells: DataFrame, plans: Sequence[TreePlan], seeds: dict) -> DataFrame:
    """Subtrees grown from the trees' weights per cell; each row's weight is drawn where the row lies."""
    size, order, drawn = cells.count(), [t.tree for t in plans], [t.tree for t in plans if t.bootstrap]

    def run(batches):
        held, once = {t: np.zeros(size) for t in drawn}, np.zeros(size)
        for batch in batches:
            row, cell = batch.column("row").to_numpy(), batch.column("cell").to_numpy().astype("int64")
            once += np.bincount(cell, minlength=size)
            for t in drawn:
                draw = tree_kernel.xxhash64(row, seeds[t]) >> np.uint64(11)
                held[t] += np.bincount(cell, tree_kernel.poisson(draw.astype("float64") / float(1 << 53)), size)
        for t in order:
            w = held.get(t, once)
            own = np.flatnonzero(w)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), t, "int32")), pa.array(own.astype("int32")), pa.array(w[own])], names=["tree", "cell", "w"])

    placed = base.join(F.broadcast(cells), ["x", "y"]).select("row", "cell")
    summed = placed.mapInArrow(run, "tree int, cell int, w double").groupBy("tree", "cell").agg(F.sum("w").alias("w"))
    rows = summed.join(F.broadcast(cells), "cell").select("tree", F.lit(tree_kernel.ROOT).cast("long").alias("node"), "y", "w", "x")
    return rows.groupBy("tree", "node").applyInArrow(_grow_group({t.tree: t for t in plans}, 0), SUBTREE)


def _bootstrap_seeds(spark, plans: Sequence[TreePlan]) -> dict:
    """Per bootstrapped tree the hash that its rows' draws start from."""
    drawn = [t for t in plans if t.bootstrap]
    kind = "int" if all(-(1 << 31) <= t.seed < 1 << 31 for t in drawn) else "long"
    trees = spark.createDataFrame([(t.tree, t.seed) for t in drawn], f"tree int, seed {kind}")
    return {r["tree"]: r["h"] for r in trees.select("tree", F.xxhash64(F.lit("bootstrap"), "seed", "tree").alias("h")).collect()}  # one row per tree


class TreeModel:
    """Grown trees: upper cuts by level and the subtrees below them, both in the shared folder."""

    def __init__(self, plans: Sequence[TreePlan], levels: list[DataFrame], subtrees: list[DataFrame], p: int, key: str):
        self.plans, self.levels, self.p, self.key = list(plans), levels, p, key
        self.subtrees = subtrees[0]
        for s in subtrees[1:]:
            self.subtrees = self.subtrees.unionByName(s)

    def root_to_leaf(self, df: DataFrame, whole: bool = True) -> DataFrame:
        """Key, ``tree`` and per row the weights ``path_n`` and class-1 shares ``path_p`` from root to leaf; ``whole=False``: the leaf's share ``p`` only."""
        key, trees = self.key, F.explode(F.array(*[F.lit(t.tree) for t in self.plans])).alias("tree")
        empty = F.array().cast("array<double>")
        rows = df.select(F.col(key), vector_to_array(F.col(FEATURES)).alias("x"), trees).select(
            key, "x", "tree", F.lit(tree_kernel.ROOT).cast("long").alias("node"), empty.alias("path_n"), empty.alias("path_p"))
        for cuts in self.levels:
            met = rows.join(cuts, ["tree", "node"], "left")
            inner = F.col("f").isNotNull()
            goes = F.when(F.get("x", F.col("f")) <= F.col("threshold"), F.col("left_id")).otherwise(F.col("right_id"))
            rows = met.select(key, "x", "tree", F.when(inner, goes).otherwise(F.col("node")).alias("node"),
                              F.when(inner, F.array_append("path_n", F.col("n"))).otherwise(F.col("path_n")).alias("path_n"),
                              F.when(inner, F.array_append("path_p", F.col("n1") / F.col("n"))).otherwise(F.col("path_p")).alias("path_p"))
        blocks = max(1, -(-df.count() // LOCAL_ROWS))
        left = rows.withColumn("block", F.pmod(F.xxhash64(key), F.lit(blocks)))
        right = self.subtrees.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
        kind = df.schema[key].dataType.simpleString()
        schema = f"`{key}` {kind}, tree int, " + ("path_n array<double>, path_p array<double>" if whole else "p double")

        def walk(tests, trees_):
            keys, tree = tests.column(key), tests.column("tree")
            if not len(tests):
                tail = [pa.array([], pa.list_(pa.float64()))] * 2 if whole else [pa.array([], pa.float64())]
                return pa.Table.from_arrays([keys, tree, *tail], names=[key, "tree", *(["path_n", "path_p"] if whole else ["p"])])
            nodes = {k: np.asarray(trees_.column(k)[0].values) for k in KINDS}
            steps = tree_kernel.paths(nodes, _matrix(tests, "x"))
            share = nodes["n1"] / nodes["n"]
            if not whole:
                p = np.empty(len(tests))
                for at, node in steps:
                    p[at] = share[node]
                return pa.Table.from_arrays([keys, tree, pa.array(p)], names=[key, "tree", "p"])
            row, node = (np.concatenate([s[k] for s in steps]) for k in (0, 1))
            by = np.argsort(row, kind="stable")
            offsets = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=len(tests))))).astype("int32")
            below = []
            for name, values in (("path_n", nodes["n"]), ("path_p", share)):
                own = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values[node[by]]))
                above = tests.column(name).to_pylist()
                below.append(own if not any(above) else pa.array([a + b for a, b in zip(above, own.to_pylist())], pa.list_(pa.float64())))
            return pa.Table.from_arrays([keys, tree, *below], names=[key, "tree", "path_n", "path_p"])

        group = ["tree", "node", "block"]
        return left.groupBy(*group).cogroup(right.groupBy(*group)).applyInArrow(walk, schema)

    def _share_sums(self, df: DataFrame) -> DataFrame:
        """Key and ``p``, per row and task of whole trees the sum of its leaves' shares."""
        key, p = self.key, self.p
        kind = df.schema[key].dataType.simpleString()
        blocks = max(1, -(-df.count() // LOCAL_ROWS))
        order = {t.tree: i // TASK_TREES for i, t in enumerate(self.plans)}
        tasks = F.explode(F.sequence(F.lit(0), F.lit(max(order.values())))).alias("task")
        rows = df.select(F.col(key).alias("key"), vector_to_array(F.col(FEATURES)).alias("x"), F.pmod(F.xxhash64(key), F.lit(blocks)).alias("block"))
        if blocks > 1:
            rows = rows.repartition(blocks, "block").sortWithinPartitions("block")
        left = packed(rows, p, "key", "block").select("x", "key", "block", tasks)
        numbers = df.sparkSession.createDataFrame(list(order.items()), "tree int, task int")
        right = self.subtrees.join(F.broadcast(numbers), "tree").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        # a packed block of rows goes with the block of its first row; its rows stay together
        left = left.withColumn("block", F.col("block")[0].cast("int"))

        def walk(tests, trees):
            keys = pa.concat_arrays([c.flatten() for c in tests.column("key").chunks]) if len(tests) else pa.array([], tests.schema.field("key").type.value_type)
            x, total = unpacked(tests, "x", "<f8", p), np.zeros(len(keys))
            if len(keys):
                for i in range(len(trees)):
                    nodes = {k: np.asarray(trees.column(k)[i].values) for k in KINDS}
                    total += (nodes["n1"] / nodes["n"])[tree_kernel.leaves(nodes, x)]
            return pa.Table.from_arrays([keys, pa.array(total)], names=[key, "p"])

        group = ["task", "block"]
        return left.groupBy(*group).cogroup(right.groupBy(*group)).applyInArrow(walk, f"`{key}` {kind}, p double")

    def mean_share(self, df: DataFrame) -> DataFrame:
        """Key and ``score``, the mean class-1 share of the trees' leaves; equal vectors of a large table are scored once."""
        key, rows = self.key, df.select(self.key, vector_to_array(F.col(FEATURES)).alias("x"))
        n, vectors = df.select(F.count(F.lit(1)), F.approx_count_distinct(F.xxhash64(vector_to_array(F.col(FEATURES))))).first()
        if n <= LOCAL_ROWS or 2 * vectors > n:
            return self._mean_share(df)
        asked = stored(rows.select("x").distinct().withColumn(key, F.monotonically_increasing_id()), "tree-vectors")
        found = self._mean_share(asked.select(key, array_to_vector("x").alias(FEATURES))).withColumnRenamed("score", "__score")
        scores = stored(asked.join(found, key).select("x", F.col("__score").alias("score")), "tree-vector-scores")
        return rows.join(scores, "x").select(key, "score")

    def _mean_share(self, df: DataFrame) -> DataFrame:
        if not self.levels and self.p:
            return self._share_sums(df).groupBy(self.key).agg((F.sum("p") / len(self.plans)).alias("score"))
        return self.root_to_leaf(df, whole=False).groupBy(self.key).agg((F.sum("p") / len(self.plans)).alias("score"))

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``score`` and ``prediction`` (1 above one half)."""
        found = self.mean_share(df).withColumn("prediction", (F.col("score") > 0.5).cast("int"))
        return df.join(found, self.key)

    def importances(self, names: Sequence[str]) -> DataFrame:
        """``feature, importance``: mean over trees of each tree's normalised Gini decrease."""
        # a subtree's own decreases were summed per feature where it was grown
        found = self.subtrees.select("tree", F.posexplode("gain").alias("f", "gain")).filter("gain > 0")
        for k, cuts in enumerate(self.levels):
            below = (self.levels[k + 1] if k + 1 < len(self.levels) else None)
            kids = self.subtrees.select("tree", "node", F.col("n")[0].alias("n"), F.col("n1")[0].alias("n1"))
            kids = kids if below is None else kids.unionByName(below.select("tree", "node", "n", "n1"))
            impurity = F.col("n") - (F.col("n1") ** 2 + (F.col("n") - F.col("n1")) ** 2) / F.col("n")
            lost = kids.select("tree", F.col("node").alias("kid"), impurity.alias("lost"))
            links = cuts.select("tree", "f", F.explode(F.array("left_id", "right_id")).alias("kid")).join(lost, ["tree", "kid"])
            found = found.unionByName(cuts.select("tree", "f", impurity.alias("gain"))).unionByName(links.select("tree", "f", (-F.col("lost")).alias("gain")))
        per = found.groupBy("tree", "f").agg(F.sum("gain").alias("gain"))
        whole = Window.partitionBy("tree")
        per = per.withColumn("share", F.col("gain") / F.sum("gain").over(whole)).groupBy("f").agg((F.sum("share") / len(self.plans)).alias("importance"))
        labels = F.array(*[F.lit(n) for n in names])
        every = found.sparkSession.range(len(names)).select(F.col("id").cast("int").alias("f"), F.get(labels, F.col("id").cast("int")).alias("feature"))
        return every.join(per, "f", "left").select("feature", F.coalesce("importance", F.lit(0.0)).alias("importance")).orderBy(F.desc("importance"), "feature")


def grow_trees(data: DataFrame, key: str, plans: Sequence[TreePlan], local_rows: int = LOCAL_ROWS, batch_trees: int = BATCH_TREES) -> TreeModel:
    """Grow all planned trees on ``data`` (key, label 0/1, features); the key identifies rows."""
    base = data.select(F.xxhash64(key).alias("row"), F.col(LABEL).cast("double").alias("y"), vector_to_array(F.col(FEATURES)).alias("x"))
    base = stored(base, "tree-rows")
    n = base.count()
    p = len(base.select("x").first()[0]) if n else 0
    seeds = _bootstrap_seeds(data.sparkSession, plans) if any(t.bootstrap for t in plans) else {}
    cells = _cells(base) if n > local_rows else None
    if cells is not None:
        return TreeModel(plans, [], [stored(_grow_cells(base, cells, plans, seeds), "subtrees")], p, key)
    if n > local_rows:  # some node will be cut by Spark
        at = [i / RANGES for i in range(1, RANGES)]
        found = base.agg(*[F.percentile_approx(F.col("x")[f], at, 4 * RANGES).alias(f"q{f}") for f in range(p)]).first()
        cuts = [np.unique(np.array(q, "float64")) for q in found]
        base = stored(base.mapInPandas(lambda frames: _ranges(frames, cuts), "row long, y double, x array<double>, ranges array<int>"), "tree-rows")
    levels, subtrees = {}, []
    if 0 < n <= local_rows:
        tasks = F.explode(F.sequence(F.lit(0), F.lit((len(plans) - 1) // TASK_TREES))).alias("task")
        grown = packed(base, p).select("*", tasks).groupBy("task").applyInArrow(_grow_whole(plans, seeds, p), SUBTREE)
        return TreeModel(plans, [], [stored(grown, "subtrees")], p, key)
    for start in range(0, len(plans), batch_trees):
        _grow_batch(base, n, p, plans[start:start + batch_trees], local_rows, levels, subtrees)
    merged = []
    for _, parts in sorted(levels.items()):
        one = parts[0]
        for other in parts[1:]:
            one = one.unionByName(other)
        merged.append(one)
    return TreeModel(plans, merged, subtrees, p, key)


def _grow_batch(base: DataFrame, n: int, p: int, plans: Sequence[TreePlan], local_rows: int, levels: dict, subtrees: list) -> None:
    spark, by_tree = base.sparkSession, {t.tree: t for t in plans}
    trees = F.explode(F.array(*[F.lit(t.tree) for t in plans])).alias("tree")
    rows = base.select("*", trees)
    bootstrap = [t for t in plans if t.bootstrap]
    if bootstrap:
        seeds = F.element_at(F.create_map(*[F.lit(v) for t in bootstrap for v in (t.tree, t.seed)]), F.col("tree")) \
            if len({t.seed for t in bootstrap}) > 1 else F.lit(bootstrap[0].seed)
        draw = F.shiftrightunsigned(F.xxhash64(F.lit("bootstrap"), seeds, "tree", "row"), 11).cast("double") / F.lit(float(1 << 53))
        drawn = F.lit(True) if len(bootstrap) == len(plans) else F.col("tree").isin([t.tree for t in bootstrap])
        rows = rows.withColumn("w", F.when(drawn, _poisson(draw)).otherwise(F.lit(1.0))).filter("w > 0")
    else:
        rows = rows.withColumn("w", F.lit(1.0))
    active, depth = rows.drop("row").withColumn("node", F.lit(tree_kernel.ROOT).cast("long")), 0
    limits = spark.createDataFrame([(t.tree, float(t.min_leaf), float(t.min_split), 1 << 30 if t.max_depth is None else t.max_depth, min(t.max_features or p, p)) for t in plans],
                                   "tree int, min_leaf double, min_split double, max_depth int, max_features int")
    seeds_of = {t.tree: t.seed for t in plans}
    local = "tree int, node long, y double, w double, x array<double>"
    names = [c.split()[0] for c in local.split(", ")]
    while n > local_rows:
        active = stored(active, "tree-active")
        nodes = active.groupBy("tree", "node").agg(F.count(F.lit(1)).alias("rows"), F.sum("w").alias("n"), F.sum(F.col("w") * F.col("y")).alias("n1"))
        nodes = stored(nodes.join(F.broadcast(limits), "tree"), "tree-nodes")
        small = nodes.filter(F.col("rows") <= local_rows).select("tree", "node")
        subtrees.append(stored(active.join(small, ["tree", "node"], "left_semi").select(names).groupBy("tree", "node")
                               .applyInArrow(_grow_group(by_tree, depth), SUBTREE), "subtrees"))
        large = nodes.filter(F.col("rows") > local_rows)
        cut = F.expr(f"n1 > 0 and n1 < n and n >= min_split and n >= 2 * min_leaf and max_depth > {depth}")
        frontier = large.filter(cut).select("tree", "node", "n", "n1").mapInPandas(
            lambda frames: _with_order(frames, seeds_of, p), "tree int, node long, n double, n1 double, order array<long>, left_id long, right_id long")
        frontier = stored(frontier, "tree-frontier")
        cells = active.join(frontier.select("tree", "node"), ["tree", "node"], "left_semi").select(
            "tree", "node", "w", "y", F.posexplode(F.arrays_zip("x", "ranges")).alias("f", "c"))
        cells = cells.groupBy("tree", "node", "f", F.col("c.ranges").alias("r"), F.col("c.x").alias("v")).agg(
            F.sum("w").alias("w"), F.sum(F.col("w") * F.col("y")).alias("w1"))
        found = _best_cuts(cells, frontier, limits)
        cuts = stored(found.join(frontier, ["tree", "node"]).select("tree", "node", "f", "threshold", "n", "n1", "left_id", "right_id"), "tree-cuts")
        # large nodes without a cut are leaves
        ends = large.join(cuts.select("tree", "node"), ["tree", "node"], "left_anti")
        subtrees.append(stored(ends.select("tree", "node", F.array(F.lit(-1)).alias("feature"), F.array(F.lit(0.0)).alias("threshold"),
                                           F.array(F.lit(-1)).alias("left"), F.array(F.lit(-1)).alias("right"), F.array("n").alias("n"),
                                           F.array("n1").alias("n1"), F.array_repeat(F.lit(0.0), p).alias("gain")), "subtrees"))
        if cuts.isEmpty():
            return
        levels.setdefault(depth, []).append(cuts)
        goes = F.when(F.get("x", F.col("f")) <= F.col("threshold"), F.col("left_id")).otherwise(F.col("right_id"))
        active = active.join(cuts, ["tree", "node"]).select("tree", goes.alias("node"), "y", "w", "x", "ranges")
        depth += 1
    subtrees.append(stored(active.select(names).groupBy("tree", "node").applyInArrow(_grow_group(by_tree, depth), SUBTREE), "subtrees"))


@dataclass
class Forest:
    """Random forest: bootstrapped, fully grown trees, the square root of the features tried per node."""

    num_trees: int = 100
    seed: int = 0
    key: str = "loan_id"
    max_depth: int | None = None
    local_rows: int = LOCAL_ROWS

    def fit(self, data: DataFrame) -> TreeModel:
        first = data.select(FEATURES).first()
        m = max(1, math.isqrt(len(first[0]))) if first else None
        plans = [TreePlan(t, self.seed, True, m, max_depth=self.max_depth) for t in range(self.num_trees)]
        return grow_trees(data, self.key, plans, self.local_rows)


@dataclass
class Tree:
    """One decision tree on all rows."""

    seed: int = 0
    key: str = "loan_id"
    max_features: int | None = None
    min_leaf: float = 1.0
    min_split: float = 2.0
    max_depth: int | None = None
    local_rows: int = LOCAL_ROWS

    def fit(self, data: DataFrame) -> TreeModel:
        plan = TreePlan(0, self.seed, False, self.max_features, self.min_leaf, self.min_split, self.max_depth)
        return grow_trees(data, self.key, [plan], self.local_rows)
