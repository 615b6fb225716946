"""Random forest of regression trees over binned rows: one pass per level, all trees at once.

The rows are written once as blocks of bins, a byte for each feature. In a pass a task holds the
blocks of its part, draws each tree's bag anew (a block and a tree seed the draws), sends the
rows down the levels that are known and counts those of the smaller child of each split; the
other child is what the parent's counts leave. Counts of a node are added up in one place,
which picks its split, so the driver gets a few numbers per node. Rows of a part are in the
order of their nodes while they are counted, and features are counted several at a time as
long as their joint bins are few, so that the counts at work stay in a cache.

Bags, splits and stops are those of Spark's forest with all features at each split: Poisson
counts with mean one, thresholds between neighbouring values or
at equal shares of the rows, the greatest loss of variance, the first feature in a tie. The
fitted model is Spark's own.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.session import cut_lineage, work_folder

# Parameters that `fit` knows; with others Spark's own fit is the one to call.
PARAMS = {"numTrees", "maxDepth", "maxBins", "minInstancesPerNode", "minInfoGain", "seed", "bootstrap"}
# Rows of a block and of a task, parents in a record, records that a task adds up.
BLOCK_ROWS = 16_384
PART_ROWS = 1_500_000
CHUNK = 16
RECORDS = 256
# Values that stand for the rows of a run when thresholds are looked for, and runs held before they are merged.
POINTS = 1024
RUN_ROWS = 65_536
RUNS = 64
# Joint bins of the features that are counted at once, for all nodes of a record.
CELLS = 32_768
# Rows that go down the trees together.
STEP_ROWS = 4096
# Nanoseconds of counting a row, and of a cell.
_ROW_COST, _CELL_COST = 10, 12
# A gain below this share of the mean square is rounding.
_ROUNDING = 1e-15
_MARK = 255


@dataclass
class _Tree:
    """Nodes by level; the children of a split node follow each other. A leaf has feature -1."""

    features: list[np.ndarray] = field(default_factory=list)
    bins: list[np.ndarray] = field(default_factory=list)
    left: list[np.ndarray] = field(default_factory=list)
    stats: list[np.ndarray] = field(default_factory=list)  # n, sum, sum of squares, gain
    # Of the children that the next pass counts: which side is counted, and the chunks of their parents.
    sides: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    keys: list[int] = field(default_factory=lambda: [0])
    starts: list[int] = field(default_factory=lambda: [0])

    def add(self, found: list[tuple[int, np.ndarray]]) -> None:
        """The nodes of a level, by chunk of their parents."""
        told = np.concatenate([nodes for _, nodes in found]) if found else np.zeros((0, 7))
        if not found and not self.features:
            told = np.array([[0.0, 0.0, 0.0, -1.0, 0.0, 0.0, 0.0]])  # no row is in the bag
        cut = told[:, 3] >= 0
        below = sum(map(len, self.features)) + len(told)
        self.features.append(told[:, 3].astype(np.intp))
        self.bins.append(told[:, 4].astype(np.intp))
        self.left.append(np.where(cut, below + 2 * (np.cumsum(cut) - 1), 0).astype(np.intp))
        self.stats.append(told[:, [0, 1, 2, 5]])
        self.sides = (2 * told[cut, 6] > told[cut, 0]).astype(np.int64)
        self.keys, self.starts, parents = [], [], 0
        for key, nodes in found:
            own = int((nodes[:, 3] >= 0).sum())
            for sub, low in enumerate(range(0, own, CHUNK)):
                self.keys.append(2 * key + sub)
                self.starts.append(parents + low)
            parents += own


@dataclass
class _Layout:
    """What the tasks know of the rows: bins of each feature, trees, and the rules of a split."""

    sizes: list[int]
    trees: int
    depth: int
    least: int
    gain: float
    seed: int
    bags: bool

    @property
    def shape(self) -> tuple[int, int]:
        return len(self.sizes), max(self.sizes)

    @property
    def kind(self) -> type:
        return np.uint8 if max(self.sizes) <= 256 else np.uint32


@dataclass
class Extent:
    """Rows, mean of the label, and least and greatest value of each feature."""

    rows: int
    mean: float
    ends: list[tuple[float, float]]


def extent(df: DataFrame, features: list[str], label: str) -> Extent:
    ends = [f(F.col(c).cast("double")) for c in features for f in (F.min, F.max)]
    rows, mean, *found = df.agg(F.count(F.lit(1)), F.avg(F.col(label).cast("double")), *ends).first()
    return Extent(rows, mean, list(zip(found[::2], found[1::2], strict=True)))


def fit(df: DataFrame, estimator: RandomForestRegressor, features: list[str], label: str, size: Extent) -> RandomForestRegressionModel:
    """The forest that `estimator` (all features at each split, other parameters among `PARAMS`) stands for.

    `features` are numeric columns without nulls or NaN; the model reads them as a vector in this order.
    """
    spark = df.sparkSession
    rows = df.select(*[F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(features)], F.col(label).cast("double").alias("y"))
    # Sums of whole labels stay exact.
    center = float(round(size.mean)) if math.isfinite(size.mean) else 0.0
    cuts = _thresholds(rows, len(features), min(estimator.getMaxBins(), size.rows) - 1)
    layout = _Layout(
        [len(c) + 1 for c in cuts], estimator.getNumTrees(), estimator.getMaxDepth(), estimator.getMinInstancesPerNode(),
        estimator.getMinInfoGain(), estimator.getSeed() % 2**64, estimator.getBootstrap(),
    )
    blocks = cut_lineage(rows.mapInArrow(_blocks(cuts, center, layout.kind), "id long, n int, bins binary, labels binary"))
    dealt, parts = _dealt(blocks, spark.sparkContext.defaultParallelism)
    trees, sums = [_Tree() for _ in range(layout.trees)], None
    for level in range(layout.depth + 1):
        open_ = {i: tree for i, tree in enumerate(trees) if tree.keys}
        if not open_:
            break
        counted = dealt.mapInArrow(_count(level, open_, layout), _COUNTS)
        # The parents' counts are those of the level above.
        known = counted if sums is None else counted.unionByName(sums.filter("counts is not null").select(*counted.columns))
        records = sum(len(tree.keys) for tree in open_.values())
        places = max(min(records, spark.sparkContext.defaultParallelism), -(-records * (parts + 1) // RECORDS))
        sums = cut_lineage(known.repartition(places, "tree", "chunk").mapInArrow(_split(level, open_, layout), _SUMS))
        found: dict[int, list[tuple[int, np.ndarray]]] = {i: [] for i in open_}
        for r in sums.filter("nodes is not null").select("tree", "chunk", "nodes").collect():  # seven numbers per node
            found[r["tree"]].append((r["chunk"], np.frombuffer(r["nodes"]).reshape(-1, 7)))
        for i, nodes in found.items():
            trees[i].add(sorted(nodes, key=lambda pair: pair[0]))
    return _model(df, estimator, trees, cuts, center)


_COUNTS = "tree int, chunk long, whole boolean, counts binary, sums binary, squares binary"
_SUMS = "tree int, chunk long, whole boolean, nodes binary, counts binary, sums binary, squares binary"


def _runs(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[list[np.ndarray]]:
    """Columns of so many rows at a time."""
    held, n = [], 0
    for batch in batches:
        low = 0
        while low < batch.num_rows:
            held.append(batch.slice(low, rows - n))
            n, low = n + held[-1].num_rows, low + held[-1].num_rows
            if n == rows:
                yield [c.to_numpy() for c in pa.Table.from_batches(held).columns]
                held, n = [], 0
    if held:
        yield [c.to_numpy() for c in pa.Table.from_batches(held).columns]


def _merged(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising distinct values and the sums of their counts."""
    distinct, place = np.unique(values, return_inverse=True)
    return distinct, np.bincount(place, counts, len(distinct))


def _points(values: np.ndarray, counts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """At most so many values that stand for equal shares of the rows; all of them if they are no more."""
    if len(values) <= most:
        return values, counts
    stops = np.cumsum(counts)
    at = np.searchsorted(stops, (np.arange(most) + 0.5) * (stops[-1] / most))
    return _merged(values[at], np.full(most, stops[-1] / most))


def _cuts(values: np.ndarray, counts: np.ndarray, most: int) -> np.ndarray:
    """Thresholds between all neighbouring values, or where equal shares of the rows end."""
    middles = values[:-1] / 2 + values[1:] / 2
    if len(middles) <= most:
        return middles
    stops, stride, out = np.cumsum(counts), counts.sum() / (most + 1), []
    target = stride
    for i, middle in enumerate(middles):
        if abs(stops[i] - target) < abs(stops[i + 1] - target):
            out.append(middle)
            target += stride
    return np.array(out)


def _thresholds(rows: DataFrame, features: int, most: int) -> list[np.ndarray]:
    """At most so many thresholds of each feature, from all rows: each run of them is summed up as shares of its rows."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[] for _ in range(features)]

        def joined(parts: list) -> tuple[np.ndarray, np.ndarray]:
            return _points(*_merged(*[np.concatenate(x) for x in zip(*parts, strict=True)]), POINTS)

        for run in _runs(batches, RUN_ROWS):
            for parts, values in zip(held, run, strict=False):
                parts.append(_points(*np.unique(values, return_counts=True), POINTS))
                if len(parts) == RUNS:
                    parts[:] = [joined(parts)]
        for i, parts in enumerate(held):
            if parts:
                values, counts = joined(parts)
                yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (i, values.tobytes(), counts.astype(float).tobytes())], ["feature", "vals", "counts"])

    def cut(table: pa.Table) -> pa.Table:
        values, counts = (np.concatenate([np.frombuffer(x) for x in table[c].to_pylist()]) for c in ("vals", "counts"))
        return pa.table({"feature": table["feature"][:1], "cuts": [_cuts(*_merged(values, counts), most).tobytes()]})

    told = rows.mapInArrow(summed, "feature long, vals binary, counts binary").groupBy("feature").applyInArrow(cut, "feature long, cuts binary")
    found = {r["feature"]: np.frombuffer(r["cuts"]) for r in told.collect()}  # one row per feature
    return [found[i] for i in range(features)]


def _blocks(cuts: list[np.ndarray], center: float, kind: type):
    """Blocks of rows: their bins row by row, and their labels less the center."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        for i, columns in enumerate(_runs(batches, BLOCK_ROWS)):
            bins = np.stack([np.searchsorted(c, x).astype(kind) for c, x in zip(cuts, columns, strict=False)], axis=1)
            told = (first + i, len(bins), bins.tobytes(), (columns[-1] - center).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([first + i]), pa.array([len(bins)], pa.int32()), *[pa.array([x]) for x in told[2:]]], ["id", "n", "bins", "labels"])

    return run


def _dealt(blocks: DataFrame, cores: int) -> tuple[DataFrame, int]:
    """Blocks in parts of about equally many rows, and the number of parts.

    With fewer parts than cores a part goes to several tasks, each for some of the trees.
    """
    spark, sizes = blocks.sparkSession, blocks.select("id", "n").collect()  # two numbers per 16,384 rows
    parts = max(-(-sum(r["n"] for r in sizes) // PART_ROWS), 1)
    shares = max(cores // parts, 1)
    # As many tasks as cores, or a multiple of them, are done together.
    parts = min(cores // shares if parts <= cores else -(-parts // cores) * cores, len(sizes))
    loads, placed = [(0, p) for p in range(parts)], []
    for r in sorted(sizes, key=lambda r: (-r["n"], r["id"])):
        n, p = heapq.heappop(loads)
        placed.append((r["id"], p))
        heapq.heappush(loads, (n + r["n"], p))
    places = spark.createDataFrame(pa.table(dict(zip(["id", "part"], map(list, zip(*placed, strict=True)), strict=True))))
    shared = blocks.join(F.broadcast(places), "id").withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
    slot = (F.col("part") * shares + F.col("share")).cast("int")
    return shared.repartitionById(parts * shares, slot).select("id", "share", F.lit(shares).alias("shares"), "bins", "labels"), parts


def _poisson() -> tuple[np.ndarray, np.ndarray]:
    """Distribution with mean one, and what 16 random bits say of a draw; marked where they don't settle it."""
    edges = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(20)])
    cell = np.arange(65_536)
    low, high = np.searchsorted(edges, cell / 65_536, "right"), np.searchsorted(edges, (cell + 1) / 65_536, "left")
    return edges, np.where(low == high, low, _MARK).astype(np.uint8)


_EDGES, _TABLE = _poisson()


def _draws(seed: int, tree: int, block: int, rows: int) -> np.ndarray:
    """How often each row of a block is in the bag of a tree: the same in every pass."""
    random = np.random.Generator(np.random.SFC64([seed, tree, block]))
    cell = random.integers(0, 65_536, rows, dtype=np.uint16)
    times = _TABLE.take(cell)
    unsettled = np.flatnonzero(times == _MARK)
    times[unsettled] = np.searchsorted(_EDGES, (cell[unsettled] + random.random(len(unsettled))) / 65_536, "right")
    return times


def _grouped(sizes: list[int], most: int) -> list[list[int]]:
    """Features to be counted at once: no group has more joint bins than `most`, but for a single feature."""
    groups: list[tuple[int, list[int]]] = []
    for f in sorted(range(len(sizes)), key=lambda f: -sizes[f]):
        for i, (joint, members) in enumerate(groups):
            if joint * sizes[f] <= most:
                groups[i] = (joint * sizes[f], [*members, f])
                break
        else:
            groups.append((sizes[f], [f]))
    return [members for _, members in groups]


def _chosen(sizes: list[int], rows: float, nodes: float) -> tuple[int, list[list[int]]]:
    """Bound of joint bins, and groups, at which counting so many rows of so many nodes takes least."""
    options, most = [], max(sizes)
    while most <= max(CELLS // max(min(nodes, CHUNK), 1), max(sizes)):
        groups = _grouped(sizes, most)
        options.append((len(groups) * (rows * _ROW_COST + nodes * most * _CELL_COST), most, groups))
        most *= 2
    return min(options)[1:]


def _codes(bins: np.ndarray, sizes: list[int], groups: list[list[int]], most: int) -> list[np.ndarray]:
    """The joint bin of each row in each group."""
    out = []
    for members in groups:
        code = bins[:, members[0]].astype(np.min_scalar_type(most - 1))
        for f in members[1:]:
            code = code * code.dtype.type(sizes[f]) + bins[:, f].astype(code.dtype)
        out.append(code)
    return out


def _ends(tree: _Tree) -> dict[int, tuple[int, int]]:
    """First and last parent of each chunk."""
    return {key: (low, high) for key, low, high in zip(tree.keys, tree.starts, [*tree.starts[1:], len(tree.sides)], strict=True)}


def _count(level: int, trees: dict[int, _Tree], layout: _Layout):
    """Counts of the smaller children of a part, chunk by chunk; of the last level only how many rows a node has."""
    last = level == layout.depth
    sizes = [1] if last else layout.sizes
    plans = {}
    for i, tree in trees.items():
        base = sum(map(len, tree.features))
        counted = np.ones(1, bool)
        if level:
            counted = np.zeros(2 * len(tree.sides), bool)
            counted[2 * np.arange(len(tree.sides)) + tree.sides] = True
        features, bins, left = (np.concatenate(x) if x else np.zeros(0, np.intp) for x in (tree.features, tree.bins, tree.left))
        leaves = [bool((f < 0).any()) for f in tree.features]
        plans[i] = features, bins.astype(layout.kind), left, leaves, base, counted, _ends(tree)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sorted(((*r,) for b in batches for r in zip(*[c.to_pylist() for c in b.columns], strict=True)), key=lambda r: r[0])
        if not held:
            return
        ids, _, _, bins, labels = zip(*held, strict=True)
        share, shares = held[0][1:3]
        del held
        bins = [np.frombuffer(x, layout.kind) for x in bins]
        labels = np.concatenate([np.frombuffer(x) for x in labels])
        rows = [len(x) // len(layout.sizes) for x in bins]
        mine = [i for i in plans if i % shares == share]
        if not mine:
            return
        nodes = max(len(plans[i][5]) / 2 for i in mine)
        most, groups = _chosen(sizes, len(labels) * (0.3 if level else 0.6), max(nodes, 1))
        whole = np.zeros((len(labels), 1), layout.kind) if last else np.concatenate(bins).reshape(len(labels), -1)
        codes = _codes(whole, sizes, groups, most)
        del whole
        for i in mine:
            yield from counts(i, ids, rows, bins, labels, most, groups, codes)

    def bagged(i: int, ids: tuple, rows: list[int], bins: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of the part in the children to be counted, their parents, and how often they are in the bag."""
        features, cuts, left, leaves, base, counted, _ = plans[i]
        width, offset, out = len(layout.sizes), 0, []
        for block, n, flat in zip(ids, rows, bins, strict=True):
            times = _draws(layout.seed, i, block, n) if layout.bags else np.ones(n, np.uint8)
            at = np.flatnonzero(times)
            node = np.zeros(len(at), np.intp)
            for step in range(level):
                by = features.take(node)
                if leaves[step]:
                    on = np.flatnonzero(by >= 0)
                    at, node, by = at.take(on), node.take(on), by.take(on)
                right = flat.take(at * width + by) > cuts.take(node)
                node = left.take(node) + right
            node -= base
            on = np.flatnonzero(counted.take(node))
            at = at.take(on)
            out.append((at + offset, node.take(on) >> 1, times.take(at)))
            offset += n
        at, parent, times = (np.concatenate(x) for x in zip(*out, strict=True))
        if len(counted) > 2:
            order = np.argsort(parent.astype(np.min_scalar_type(len(counted))), kind="stable")
            at, parent, times = at.take(order), parent.take(order), times.take(order)
        return at, parent, times.astype(float)

    def counts(i, ids, rows, bins, labels, most, groups, codes) -> Iterator[pa.RecordBatch]:
        at, parent, times = bagged(i, ids, rows, bins)
        y = labels.take(at)
        weighted = times * y
        squares = np.bincount(parent, weighted * y, max(len(plans[i][5]) // 2, 1))
        for key, (low, high) in plans[i][6].items():
            start, stop = np.searchsorted(parent, [low, high])
            if start == stop:
                continue
            n, s = (np.zeros((high - low, len(sizes), max(sizes))) for _ in range(2))
            for begin in range(start, stop, RUN_ROWS):
                part = slice(begin, min(begin + RUN_ROWS, stop))
                node, own = (parent[part] - low) * most, at[part]
                for members, code in zip(groups, codes, strict=True):
                    place = node + code.take(own)
                    for into, weight in ((n, times), (s, weighted)):
                        _spread(np.bincount(place, weight[part], (high - low) * most), most, members, sizes, into)
            told = i, key, False, n.astype(np.uint32).tobytes(), s.tobytes(), squares[low:high].tobytes()
            yield _record(told, ["tree", "chunk", "whole", "counts", "sums", "squares"])

    return run


def _spread(joint: np.ndarray, most: int, members: list[int], sizes: list[int], into: np.ndarray) -> None:
    """Add joint counts of nodes to those of each feature."""
    dims = [sizes[f] for f in members]
    joint = joint.reshape(-1, most)[:, : math.prod(dims)].reshape(-1, *dims)
    for axis, f in enumerate(members, 1):
        into[:, f, : sizes[f]] += joint.sum(axis=tuple(x for x in range(1, joint.ndim) if x != axis))


def _record(row: tuple, names: list[str]) -> pa.RecordBatch:
    kinds = {"tree": pa.int32(), "chunk": pa.int64(), "whole": pa.bool_()}
    return pa.RecordBatch.from_arrays([pa.array([x], kinds.get(name, pa.binary())) for name, x in zip(names, row, strict=True)], names)


def _split(level: int, trees: dict[int, _Tree], layout: _Layout):
    """Nodes of a level with their best splits, and the counts of those that split: the parents of the next level."""
    last = level == layout.depth
    sides, ends = {i: t.sides for i, t in trees.items()}, {i: _ends(t) for i, t in trees.items()}
    shape = (1, 1) if last else layout.shape
    names = ["tree", "chunk", "whole", "nodes", "counts", "sums", "squares"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parents: dict[tuple[int, int], list[np.ndarray]] = {}
        small: dict[tuple[int, int], list[np.ndarray]] = {}
        for batch in batches:
            for tree, chunk, whole, *arrays in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                n, s, q = (np.frombuffer(x, kind) for x, kind in zip(arrays, (float if whole else np.uint32, float, float), strict=True))
                n, s = (x.reshape(len(q), *(layout.shape if whole else shape)) for x in (n, s))
                if whole:
                    parents[tree, chunk] = [x[:, :1].sum(axis=2, keepdims=True) if last else x for x in (n, s)] + [q]
                elif (tree, chunk) in small:
                    for x, more in zip(small[tree, chunk], (n, s, q), strict=True):
                        x += more
                else:
                    small[tree, chunk] = [x.astype(float) for x in (n, s, q)]
        for (tree, chunk), found in small.items():
            if (tree, chunk) in parents:
                low, high = ends[tree][chunk]
                found = _children(parents[tree, chunk], found, sides[tree][low:high])
            nodes = _best(*found, layout, last)
            yield _record((tree, chunk, None, nodes.tobytes(), None, None, None), names)
            on = np.flatnonzero(nodes[:, 3] >= 0)
            for sub, low in enumerate(range(0, len(on), CHUNK)):
                yield _record((tree, 2 * chunk + sub, True, None, *[x[on[low : low + CHUNK]].tobytes() for x in found]), names)

    return run


def _children(parent: list[np.ndarray], small: list[np.ndarray], sides: np.ndarray) -> list[np.ndarray]:
    """Both children of each parent, the left one first."""
    out, at = [], 2 * np.arange(len(sides))
    for whole, part in zip(parent, small, strict=True):
        both = np.empty((2 * len(sides), *whole.shape[1:]))
        both[at + sides], both[at + 1 - sides] = part, whole - part
        out.append(both)
    return out


def _best(counts: np.ndarray, sums: np.ndarray, squares: np.ndarray, layout: _Layout, last: bool) -> np.ndarray:
    """Per node: n, sum, sum of squares, feature (-1 in a leaf), bin, gain, n on the left."""
    n, s = counts[:, 0].sum(axis=1), sums[:, 0].sum(axis=1)
    out = np.stack([n, s, squares, np.full(len(n), -1.0), np.zeros(len(n)), np.full(len(n), -1.0), np.zeros(len(n))], axis=1)
    if last:
        return out
    left, below = (np.cumsum(x, axis=2)[:, :, :-1] for x in (counts, sums))
    right, above = n[:, None, None] - left, s[:, None, None] - below
    fits = (left >= layout.least) & (right >= layout.least)
    with np.errstate(divide="ignore", invalid="ignore"):
        # What the variance loses, written as a square: children with the same mean gain nothing.
        gains = np.where(fits, left * right / (n * n)[:, None, None] * (below / left - above / right) ** 2, -1.0).reshape(len(n), -1)
    if not gains.shape[1]:
        return out
    at = gains.argmax(axis=1)
    gain = gains[np.arange(len(n)), at]
    cut = (gain > 0) & (gain >= layout.gain) & (gain > _ROUNDING * squares / n)
    out[cut, 3], out[cut, 4] = np.divmod(at[cut], left.shape[2])
    out[cut, 5], out[cut, 6] = gain[cut], left.reshape(len(n), -1)[np.arange(len(n)), at][cut]
    return out


def _model(df: DataFrame, estimator: RandomForestRegressor, trees: list[_Tree], cuts: list[np.ndarray], center: float) -> RandomForestRegressionModel:
    """The nodes as Spark's model, by way of the files that it is saved as."""
    spark, path = df.sparkSession, f"{work_folder(df.sparkSession)}/forest"
    ends = [(Vectors.dense([x] * len(cuts)), x) for x in (0.0, 1.0)]
    # The parameters come from a model of two rows, its nodes are replaced.
    estimator.fit(spark.createDataFrame(ends, [estimator.getFeaturesCol(), estimator.getLabelCol()])).write().save(path)
    table = pa.concat_tables(_nodes(i, tree, cuts, center) for i, tree in enumerate(trees))
    spark.createDataFrame(table).write.mode("overwrite").parquet(f"{path}/data")
    return RandomForestRegressionModel.load(path)


def _nodes(i: int, tree: _Tree, cuts: list[np.ndarray], center: float) -> pa.Table:
    """Rows of a tree in Spark's layout; leaves beside each other that say the same are one."""
    features, bins, left = (np.concatenate(x) for x in (tree.features, tree.bins, tree.left))
    n, s, q, gain = np.concatenate(tree.stats).T
    mean = s / np.maximum(n, 1)
    said = mean + center
    for k in np.flatnonzero(features >= 0)[::-1]:
        a, b = left[k], left[k] + 1
        if features[a] < 0 and features[b] < 0 and said[a] == said[b]:
            features[k] = -1
    kept, reached = [0], 0
    while reached < len(kept):
        if features[k := kept[reached]] >= 0:
            kept += [left[k], left[k] + 1]
        reached += 1
    at = np.array(kept)
    place = np.zeros(len(features), np.int64)
    place[at] = np.arange(len(at))
    inner = features[at] >= 0
    children = [np.where(inner, place[np.minimum(left[at] + side, len(place) - 1)], -1) for side in (0, 1)]
    thresholds = [[float(cuts[f][b])] if f >= 0 else [] for f, b in zip(features[at], bins[at], strict=True)]
    stats = np.stack([n, s + n * center, q + 2 * center * s + n * center * center], axis=1)[at]
    split = pa.StructArray.from_arrays(
        [pa.array(np.where(inner, features[at], -1), pa.int32()), pa.array(thresholds, pa.list_(pa.float64())), pa.array(np.full(len(at), -1), pa.int32())],
        ["featureIndex", "leftCategoriesOrThreshold", "numCategories"],
    )
    data = pa.StructArray.from_arrays(
        [
            pa.array(np.arange(len(at)), pa.int32()), pa.array(said[at]), pa.array(np.maximum(q / np.maximum(n, 1) - mean * mean, 0.0)[at]),
            pa.array(stats.tolist(), pa.list_(pa.float64())), pa.array(n[at].astype(np.int64)), pa.array(np.where(inner, gain[at], -1.0)),
            *[pa.array(c, pa.int32()) for c in children], split,
        ],
        ["id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild", "split"],
    )
    return pa.table({"treeID": pa.array(np.full(len(at), i), pa.int32()), "nodeData": data})


def prediction(df: DataFrame, model: RandomForestRegressionModel, features: list[str]) -> Column:
    """What the model says of rows with these columns as its features: the same sums as its own, for many rows at a time."""
    path = f"{work_folder(df.sparkSession)}/forest"
    model.write().save(path)
    table = df.sparkSession.read.parquet(f"{path}/data").select("treeID", "nodeData.*").toArrow().sort_by([("treeID", "ascending"), ("id", "ascending")])
    tree, left, right, said = (table[c].to_numpy() for c in ("treeID", "leftChild", "rightChild", "prediction"))
    first = np.searchsorted(tree, np.arange(tree[-1] + 1))
    base, leaf = first.take(tree), left < 0
    split = table["split"].combine_chunks()
    # A leaf leads to itself.
    by = np.where(leaf, 0, split.field("featureIndex").to_numpy(zero_copy_only=False)).astype(np.intp)
    cut = np.full(len(by), np.inf)
    cut[~leaf] = split.field("leftCategoriesOrThreshold").flatten().to_numpy()
    own = np.arange(len(by))
    children = np.stack([np.where(leaf, own, base + side) for side in (left, right)], axis=1).astype(np.intp).ravel()
    depth, width, trees = model.getMaxDepth(), len(features), len(first)

    @F.arrow_udf("double")
    def told(values: pa.Array) -> pa.Array:
        flat = values.flatten().to_numpy(zero_copy_only=False)
        out = np.zeros(len(values))
        for low in range(0, len(out), STEP_ROWS):
            high = min(low + STEP_ROWS, len(out))
            start = np.arange(low * width, high * width, width)
            for root in first:
                node = np.full(high - low, root)
                for _ in range(depth):
                    above = flat.take(start + by.take(node)) > cut.take(node)
                    node = children.take(2 * node + above)
                out[low:high] += said.take(node)
        return pa.array(out / trees)

    return told(F.array(*[F.col(c).cast("double") for c in features]))
