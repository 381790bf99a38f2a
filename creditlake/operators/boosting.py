"""Gradient-boosted trees with a branch for nulls and a limit on leaves, grown from histograms that tasks add up.

Every tree is at most `depth` levels deep. A level is one pass: tasks reduce their rows to sums of gradients for each node,
feature and bin, and only these sums move. A node's best split depends on its own rows alone, so the splits of all nodes are
found level by level, and the tree then takes them in the order of their gain until it has `leaves` leaves, which is the tree
that grows leaf by leaf. Of two nodes below a split, only the one with fewer rows is added up; the other is what its parent has more.

A tree's first pass adds up the nodes below the splits that are expected from the tree before. The sums of a node are those of the nodes
below it, so they tell whether the expected splits are the best ones; below those that are, a level needs no pass of its own.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..settings import ship_package, stage

#: Bins of a feature besides that for nulls, at most 254.
BINS = 64
#: Features share a code of two bytes while it has no more than so many values, so that a histogram of it stays in a core's cache.
CELLS = 4_300
#: Rows of a block: codes column by column, labels with weights, and scores of so many rows, or up to twice as many, are one row of the written table.
BLOCK = 1 << 15
#: A block has a megabyte or two, so row groups are kept short. It is read some 40 times: unpacking it each time costs more than its bytes.
WRITTEN = {
    "compression": "uncompressed", "parquet.enable.dictionary": "false", "parquet.block.size": str(16 << 20),
    "parquet.block.size.row.check.min": "4", "parquet.block.size.row.check.max": "4",
}
#: Few blocks are an Arrow batch. They are dealt to a file for each core, of equal size, and each file is a task.
READ = {"spark.sql.execution.arrow.maxRecordsPerBatch": "4", "spark.sql.files.maxPartitionBytes": "1g"}
#: Values of a feature that stand for the others of many rows, and the rows looked at exactly before. Each of two steps is off by a row in so many.
POINTS, SORTED = 20_000, 1 << 18
#: Scores are written with the rows after so many trees, so a pass applies fewer than that.
KEPT_TREES = 10
#: Histograms of more tasks than this are added up by so many tasks before the driver gets them.
MERGERS = 64
LEAST_HESSIAN = 1e-3
NODES = "arbol int, nodo int, feature string, umbral double, nulos_izquierda boolean, valor double, filas bigint, ganancia double"


@dataclass
class Tree:
    """Nodes numbered as in a heap: those below node i are 2i and 2i + 1. `feature` is -1 in leaves and unused places."""

    depth: int
    feature: np.ndarray = field(init=False)
    threshold: np.ndarray = field(init=False)
    bin: np.ndarray = field(init=False)
    nulls_left: np.ndarray = field(init=False)
    value: np.ndarray = field(init=False)
    rows: np.ndarray = field(init=False)
    gain: np.ndarray = field(init=False)

    def __post_init__(self):
        n = 2 << self.depth
        self.feature, self.bin, self.rows = np.full(n, -1, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.threshold, self.value, self.gain = np.zeros(n), np.zeros(n), np.zeros(n)
        self.nulls_left = np.zeros(n, bool)

    def reached(self) -> list[int]:
        """The nodes of the tree, each after the one above it."""
        found = [1]
        for i in found:
            found += [2 * i, 2 * i + 1] if self.feature[i] >= 0 else []
        return found

    def split(self, i: int) -> tuple[int, int, bool]:
        return int(self.feature[i]), int(self.bin[i]), bool(self.nulls_left[i])

    def leaf_of(self, x: np.ndarray, null: np.ndarray) -> np.ndarray:
        """The node where each row of `x` ends; a row goes left if it is not above the threshold of its node."""
        at, rows = np.ones(len(x), np.int64), np.arange(len(x))
        for _ in range(self.depth):
            f = self.feature[at]
            inner = f >= 0
            left = np.where(null[rows, f], self.nulls_left[at], x[rows, f] <= self.threshold[at])
            at = np.where(inner, 2 * at + ~left, at)
        return at

    def leaf_of_bins(self, x: np.ndarray, missing: int) -> np.ndarray:
        """The same for bins [feature, row]: each split is one comparison of small numbers, `missing` being above all other bins."""
        return self._leaf(x, [missing] * len(x), x.shape[1])

    def _leaf(self, x: Mapping[int, np.ndarray] | np.ndarray, missing: Sequence[int], rows: int) -> np.ndarray:
        """The same for the `rows` bins x[f] of each feature, with a bin of its own for nulls.

        Masks go down the tree and leave the number of the leaf: choosing between numbers row by row takes several times as long.
        """
        at = np.zeros(rows, np.min_scalar_type(len(self.feature) - 1))

        def below(i: int, mask: np.ndarray) -> None:
            nonlocal at
            f = int(self.feature[i])
            if f < 0:
                at |= mask.view(np.uint8) * at.dtype.type(i)
                return
            left = x[f] <= int(self.bin[i])
            if self.nulls_left[i]:
                left |= x[f] == missing[f]
            right = ~left
            left &= mask
            right &= mask
            below(2 * i, left)
            below(2 * i + 1, right)

        below(1, np.ones(rows, bool))
        return at


@dataclass(frozen=True)
class Codes:
    """Bins of all features as fewer codes: those of a group are the digits of one code. A feature's last bin is that for nulls."""

    sizes: list[int]
    groups: list[list[int]]

    @staticmethod
    def of(sizes: Sequence[int]) -> Codes:
        """Groups of features whose bins, `sizes` of them, make up to CELLS codes; the largest feature first."""
        groups: list[list[int]] = []
        for f in sorted(range(len(sizes)), key=lambda f: -sizes[f]):
            fits = (g for g in groups if sizes[f] * math.prod(sizes[o] for o in g) <= CELLS)
            if (g := next(fits, None)) is None:
                groups.append(g := [])
            g.append(f)
        return Codes([*sizes], groups)

    @property
    def cells(self) -> list[int]:
        return [math.prod(self.sizes[f] for f in g) for g in self.groups]

    @property
    def missing(self) -> list[int]:
        return [n - 1 for n in self.sizes]

    def encode(self, bins: Sequence[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(self.groups), len(bins[0])), np.uint16)
        for code, g in zip(out, self.groups):
            for f in g:
                code *= self.sizes[f]
                code += bins[f].astype(np.uint16)
        return out

    def bins(self, codes: np.ndarray) -> Mapping[int, np.ndarray]:
        """The bins of each feature, worked out when first asked for."""
        return _Digits(self, codes)

    def by_feature(self, sums: Sequence[np.ndarray], bins: int) -> np.ndarray:
        """[node, feature, bin, quantity], nulls last, from the sums [quantity, node and code] of each group."""
        kinds, nodes = len(sums[0]), sums[0].shape[1] // self.cells[0]
        out = np.zeros((nodes, len(self.sizes), bins + 1, kinds))
        for total, g in zip(sums, self.groups):
            cube = total.reshape(kinds, nodes, *(self.sizes[f] for f in g))
            for i, f in enumerate(g):
                own = np.moveaxis(cube.sum(axis=tuple(2 + j for j in range(len(g)) if j != i)), 0, -1)
                out[:, f, : self.sizes[f] - 1], out[:, f, -1] = own[:, :-1], own[:, -1]
        return out


class _Digits(dict):
    def __init__(self, codes: Codes, written: np.ndarray):
        super().__init__()
        self.codes, self.written = codes, written

    def __missing__(self, f: int) -> np.ndarray:
        sizes = self.codes.sizes
        row, g = next((row, g) for row, g in zip(self.written, self.codes.groups) if f in g)
        at = g.index(f)
        after = math.prod(sizes[o] for o in g[at + 1 :])
        digit = row // after if after > 1 else row
        self[f] = digit - digit // sizes[f] * sizes[f] if at else digit
        return self[f]


@contextmanager
def _reading_blocks(spark: SparkSession) -> Iterator[None]:
    before = {k: spark.conf.get(k) for k in READ}
    try:
        for k, v in READ.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _buffers(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Buffer]]:
    for b in batches:
        for i in range(b.num_rows):
            yield [c[i].as_buffer() for c in b.columns]


def _blocks(batches: Iterator[pa.RecordBatch], groups: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Codes [group, row], weights and scores of each block."""
    for codes, y, raw in _buffers(batches):
        yield np.frombuffer(codes, np.uint16).reshape(groups, -1), np.frombuffer(y), np.frombuffer(raw)


def _as_batch(**columns: np.ndarray) -> pa.RecordBatch:
    """One row, whose values are the arrays' own memory."""
    whole = [np.ascontiguousarray(a) for a in columns.values()]
    values = [pa.Array.from_buffers(pa.binary(), 1, [None, pa.py_buffer(np.array([0, a.nbytes], np.int32)), pa.py_buffer(a)]) for a in whole]
    return pa.RecordBatch.from_arrays(values, names=[*columns])


def _counted(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different values that are not NaN, in order, and the rows of each."""
    v, n = np.unique(x[~np.isnan(x)], return_counts=True)
    return v, n


def _joined(parts: Sequence[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    values, rows = (np.concatenate(c) for c in zip(*parts))
    v, of = np.unique(values, return_inverse=True)
    return v, np.bincount(of, rows, len(v)).astype(np.int64)


def _thinned(v: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of many values those that end one of POINTS equal shares of the rows; they count the rows since the one before."""
    if len(v) <= POINTS:
        return v, rows
    upto = np.cumsum(rows)
    kept = np.diff(upto * POINTS // upto[-1], prepend=0) > 0
    return v[kept], np.diff(upto[kept], prepend=0)


def _edges(blocks: DataFrame, features: int, bins: int) -> tuple[list[np.ndarray], float, float]:
    """Upper ends of the bins of each feature: quantiles off by a row in 10,000, which are values of the column. And the weight of label 1 and of all.

    Tasks thin out the sorted values of each feature, and a task for each feature joins what they kept.
    """

    def thinned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, kept, weights = [], [[] for _ in range(features)], np.zeros(2)

        def sort() -> None:
            for f, parts in enumerate(kept):
                parts.append(_thinned(*_counted(np.concatenate([x[f] for x in held]))))
            held.clear()

        for x, y in _buffers(batches):
            y = np.frombuffer(y)
            weights += y[y > 0].sum(), np.abs(y).sum()
            held.append(np.frombuffer(x).reshape(features, -1))
            if sum(x.shape[1] for x in held) >= SORTED:
                sort()
        if held:
            sort()
        rows = [(-1, weights.tobytes(), b"")]
        rows += [(f, *(a.tobytes() for a in _thinned(*_joined(parts)))) for f, parts in enumerate(kept) if parts]
        for r in rows:
            yield pa.RecordBatch.from_arrays([pa.array([r[0]], pa.int32()), pa.array([r[1]], pa.binary()), pa.array([r[2]], pa.binary())], names=["feature", "v", "n"])

    def ends(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        if key[0] < 0:
            found = sum(np.frombuffer(v) for v in parts["v"])
        else:
            v, rows = _joined([(np.frombuffer(v), np.frombuffer(n, np.int64)) for v, n in zip(parts["v"], parts["n"])])
            upto = np.cumsum(rows)
            found = np.unique(v[np.searchsorted(upto, np.ceil(np.arange(1, bins + 1) / bins * upto[-1]))]) if len(v) else np.zeros(0)
        return pd.DataFrame({"feature": [key[0]], "ends": [found.tobytes()]})

    summaries = blocks.mapInArrow(thinned, "feature int, v binary, n binary")
    found = {r["feature"]: np.frombuffer(r["ends"]) for r in summaries.groupBy("feature").applyInPandas(ends, "feature int, ends binary").collect()}
    positive, every = found[-1]
    return [e if len(e := found.get(f, ())) else np.zeros(1) for f in range(features)], float(positive), float(every)


def _histograms(state: DataFrame, tasks: int, recent: list[Tree], tree: Tree, nodes: list[int], codes: Codes, bins: int) -> np.ndarray:
    """Sums over the rows of each node: [node, feature, bin, (gradient, hessian, count)], the last bin for nulls."""
    shape = (len(nodes), len(codes.sizes), bins + 1, 3)
    place = np.full(2 << tree.depth, -1, np.int64)
    place[nodes] = np.arange(len(nodes))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros((3, len(nodes) * n)) for n in codes.cells]
        for x, y, raw in _blocks(batches, len(codes.groups)):
            found = codes.bins(x)
            raw = _advance(raw, recent, codes, found)
            p = 1 / (1 + np.exp(-raw))
            node = place[tree._leaf(found, codes.missing, len(y))]
            w = np.abs(y)
            g, h = w * (p - (y > 0)), w * p * (1 - p)
            own = np.flatnonzero(node >= 0)
            if len(own) < len(y):
                x, g, h, node = x[:, own], g[own], h[own], node[own]
            for code, n, total in zip(x, codes.cells, totals):
                at = node * n + code if len(nodes) > 1 else code
                for i, weights in enumerate((g, h, None)):
                    total[i] += np.bincount(at, weights, len(nodes) * n)
        yield _as_batch(sums=codes.by_feature(totals, bins))

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for (x,) in _buffers(batches):
            total += np.frombuffer(x).reshape(shape)
        yield _as_batch(sums=total)

    found = state.mapInArrow(sums, "sums binary")
    if tasks > MERGERS:
        found = found.repartition(MERGERS).mapInArrow(merged, "sums binary")
    return sum((np.frombuffer(r.sums).reshape(shape) for r in found.collect()), np.zeros(shape))


def _advance(raw: np.ndarray, trees: list[Tree], codes: Codes, bins: Mapping[int, np.ndarray]) -> np.ndarray:
    """Scores after some more trees."""
    for t in trees:
        raw = raw + t.value[t._leaf(bins, codes.missing, len(raw))]
    return raw


def _best_split(sums: np.ndarray, least_rows: int) -> tuple[float, int, int, bool] | None:
    """(gain, feature, last bin on the left, whether nulls go left) of one node, the first of equal ones; None without a gain.

    Both sides hold `least_rows` rows or more. Without nulls on the way to the node, nulls go right.
    """
    g, h, n = (sums[:, :, i] for i in range(3))
    total = sums[0].sum(axis=0)
    whole = total[0] ** 2 / total[1] if total[1] > 0 else 0.0
    best = None
    for nulls_left in (False, True):
        left = np.stack([np.cumsum(c[:, :-1], axis=1) + (c[:, -1:] if nulls_left else 0.0) for c in (g, h, n)])
        right = total[:, None, None] - left
        # Values are cut between bins that differ; the last bin may be cut off from the nulls alone.
        allowed = (left[2] >= least_rows) & (right[2] >= least_rows) & (left[1] > LEAST_HESSIAN) & (right[1] > LEAST_HESSIAN)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where(allowed, left[0] ** 2 / left[1] + right[0] ** 2 / right[1] - whole, 0.0)
        f, b = np.unravel_index(np.argmax(gain), gain.shape)
        if gain[f, b] > (best[0] if best else 1e-12):
            best = float(gain[f, b]), int(f), int(b), nulls_left
    return best


def _rest(whole: np.ndarray, part: np.ndarray) -> np.ndarray:
    """The histograms of a node without those of a node below it; what is left of sums without rows is nothing."""
    rest = whole - part
    rest[rest[..., 2] == 0] = 0.0
    return rest


def _below(i: int, node: int) -> bool:
    return i > node and i >> (i.bit_length() - node.bit_length()) == node


def _expected(full: Tree, known: dict[int, np.ndarray], rate: float, least_rows: int) -> Tree:
    """The next tree's first splits, if each node without known ones below it had one leaf: its gradients change by its hessians times the value."""
    guess, after = Tree(full.depth), {}
    for i in sorted(known, reverse=True):
        if 2 * i in known:
            after[i] = after[2 * i] + after[2 * i + 1]
        else:
            after[i] = known[i].copy()
            g, h, _ = known[i][0].sum(axis=0)
            after[i][..., 0] -= rate * g / h * known[i][..., 1] if h > 0 else 0.0
    waiting = [1]
    for i in waiting:
        found = _best_split(after[i], least_rows) if i.bit_length() < full.depth else None
        if found:
            _, guess.feature[i], guess.bin[i], guess.nulls_left[i] = found
            if found[1:] == full.split(i) and 2 * i in known:
                waiting += [2 * i, 2 * i + 1]
    return guess


def _grow(
    state: DataFrame, tasks: int, recent: list[Tree], full: Tree, edges: list[np.ndarray], codes: Codes, bins: int, leaves: int, least_rows: int, rate: float
) -> tuple[Tree, Tree]:
    """One tree, and what is expected of the next: candidates for all nodes, taken in the order of their gain.

    `full` has the splits that are expected; those that are not the best ones are replaced, with all below them.
    """
    depth, known, settled, splits, totals = full.depth, {}, set(), {}, {}
    asked = sorted(i for i in full.reached() if full.feature[i] < 0)
    while asked:
        for i, own in zip(asked, _histograms(state, tasks, recent, full, asked, codes, bins)):
            known[i] = own
            if i // 2 in settled:
                known[i ^ 1] = _rest(known[i // 2], own)
        if not settled:
            for i in reversed(full.reached()):
                if i not in known:
                    known[i] = known[2 * i] + known[2 * i + 1]
        asked = []
        for node in sorted(known):
            if node in settled or node not in known:
                continue
            settled.add(node)
            own = known[node]
            totals[node] = own[0].sum(axis=0)
            found = _best_split(own, least_rows)
            if not found or found[1:] != full.split(node):
                for i in range(2 * node, len(full.feature)):
                    if _below(i, node):
                        known.pop(i, None)
                        full.feature[i] = -1
                full.feature[node] = -1
            if found:
                gain, f, b, nulls_left = splits[node] = found
                full.feature[node], full.bin[node], full.nulls_left[node] = f, b, nulls_left
                left = own[f, : b + 1].sum(axis=0) + (own[f, -1] if nulls_left else 0.0)
                totals[2 * node], totals[2 * node + 1] = left, totals[node] - left
                rows = [round(totals[i][2]) for i in (2 * node, 2 * node + 1)]
                # Fewer rows are not split, nor are nodes at the last level.
                if 2 * node not in known and node.bit_length() < depth and max(rows) >= 2 * least_rows:
                    asked.append(2 * node + (rows[1] < rows[0]))
    tree, waiting, n = Tree(depth), [], 1
    push = lambda i: i in splits and heapq.heappush(waiting, (-splits[i][0], i))
    push(1)
    while waiting and n < leaves:
        _, i = heapq.heappop(waiting)
        tree.gain[i], tree.feature[i], tree.bin[i], tree.nulls_left[i] = splits[i]
        own = edges[tree.feature[i]]
        tree.threshold[i] = own[tree.bin[i]] if tree.bin[i] < len(own) - 1 else np.inf  # nulls apart from all values
        n += 1
        push(2 * i), push(2 * i + 1)
    for i in tree.reached():
        tree.rows[i] = round(totals[i][2])
        if tree.feature[i] < 0 and totals[i][1] > 0:
            tree.value[i] = -rate * totals[i][0] / totals[i][1]
    return tree, _expected(full, known, rate, least_rows)


def boost(
    rows: DataFrame, features: Sequence[str], label: str, weight: str, trees: int, rate: float, depth: int, leaves: int, least_rows: int, bins: int = BINS
) -> tuple[float, list[Tree]]:
    """The starting score (log odds of the weighted rows) and the trees, for a label of 0 and 1 under log loss.

    Rows without a label or weight are left out. Features are doubles; null and NaN are missing, for which each split learns a side. Values are put into `bins` bins
    by quantiles, several features to a code of two bytes, and written once, in blocks of rows; so are the scores after each `KEPT_TREES` trees. Weights
    are not negative. The driver holds the histograms of a tree: 2^depth nodes by features by bins.
    """
    if not 2 <= bins <= 254:
        raise ValueError("bins are 2 to 254")
    spark = rows.sparkSession
    ship_package(spark)
    named = [F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)]
    plain = rows.select(*named, F.col(label).cast("double").alias("y"), F.col(weight).cast("double").alias("w")).where("y IS NOT NULL AND w IS NOT NULL")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                *columns, y, w = (c.to_numpy(zero_copy_only=False) for c in b.columns)
                x = np.empty((len(columns), b.num_rows))
                for f, c in enumerate(columns):
                    x[f] = c
                yield _as_batch(x=x, y=np.where(y > 0, w, -w))

    blocks = stage(plain.mapInArrow(packed, "x binary, y binary"), "features", **WRITTEN | {"compression": "snappy"})
    with _reading_blocks(spark):
        edges, positive, every = _edges(blocks, len(features), bins)
        base = float(np.log(positive / (every - positive)))
        codes = Codes.of([len(e) + 1 for e in edges])

        def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, n = [], 0
            for x, y in _buffers(batches):
                held.append((codes.encode([_bins_of(v, e, len(e) - 1, len(e)) for v, e in zip(np.frombuffer(x).reshape(len(edges), -1), edges)]), np.frombuffer(y)))
                n += len(held[-1][1])
                if n >= BLOCK:
                    yield whole(held, n)
                    held, n = [], 0
            if n:
                yield whole(held, n)

        def whole(held: list, n: int) -> pa.RecordBatch:
            x, y = (np.concatenate(a, axis=-1) for a in zip(*held))
            return _as_batch(bins=x, y=y, raw=np.full(n, base))

        schema = "bins binary, y binary, raw binary"
        dealt = blocks.mapInArrow(binned, schema).repartition(spark.sparkContext.defaultParallelism)
        state = stage(dealt, "bins", **WRITTEN)
        tasks = state.rdd.getNumPartitions()
        done: list[Tree] = []
        recent: list[Tree] = []
        expected = Tree(depth)
        for _ in range(trees):
            grown, expected = _grow(state, tasks, recent, expected, edges, codes, bins, leaves, least_rows, rate)
            recent.append(grown)
            done.append(grown)
            if len(recent) == KEPT_TREES and len(done) < trees:
                state = stage(_advanced(state, recent, codes, schema), "bins", **WRITTEN)
                tasks = state.rdd.getNumPartitions()
                recent = []
    return base, done


def _bins_of(x: np.ndarray, ends: np.ndarray, last: int, missing: int) -> np.ndarray:
    """The first of the `ends` not below each value, the `last` one at most; `missing` for NaN."""
    return np.where(np.isnan(x), missing, np.minimum(np.searchsorted(ends, x), last))


def _advanced(state: DataFrame, trees: list[Tree], codes: Codes, schema: str) -> DataFrame:
    def advance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x, y, raw in _blocks(batches, len(codes.groups)):
            yield _as_batch(bins=x, y=y, raw=_advance(raw, trees, codes, codes.bins(x)))

    return state.mapInArrow(advance, schema)


def probability(base: float, trees: list[Tree], features: Sequence[Column]) -> Column:
    """The probability of label 1 of a row with these features, in the order of training.

    Values are bins between the thresholds that the trees have for a feature, so a split is a comparison of small numbers.
    """
    cuts = [np.unique([v for t in trees for v in t.threshold[t.feature == f]]) for f in range(len(features))]
    missing = [len(c) + 1 for c in cuts]
    kinds = [np.min_scalar_type(m) for m in missing]
    cut = []
    for t in trees:
        own = Tree(t.depth)
        own.feature, own.nulls_left, own.value = t.feature, t.nulls_left, t.value
        for i in np.flatnonzero(t.feature >= 0):
            own.bin[i] = np.searchsorted(cuts[t.feature[i]], t.threshold[i])
        cut.append(own)

    @F.pandas_udf("double")
    def score(*columns: pd.Series) -> pd.Series:
        bins = {
            f: _bins_of(columns[f].to_numpy(dtype=float, na_value=np.nan), c, len(c), missing[f]).astype(kinds[f]) for f, c in enumerate(cuts) if len(c)
        }
        raw = np.full(len(columns[0]), base)
        for t in cut:
            raw += t.value[t._leaf(bins, missing, len(raw))]
        return pd.Series(1 / (1 + np.exp(-raw)))

    return score(*[c.cast("double") for c in features])


def node_rows(trees: list[Tree], features: Sequence[str]) -> list[tuple]:
    """The nodes of all trees, as rows of NODES; feature, threshold and gain are null in leaves."""
    out = []
    for number, t in enumerate(trees):
        for i in t.reached():
            f = int(t.feature[i])
            split = (features[f], float(t.threshold[i]), bool(t.nulls_left[i])) if f >= 0 else (None, None, None)
            out.append((number, i, *split, float(t.value[i]), int(t.rows[i]), float(t.gain[i]) if f >= 0 else None))
    return out


def trees_from_rows(rows: Sequence[tuple], features: Sequence[str], depth: int) -> list[Tree]:
    """The inverse of `node_rows`; such trees score rows, but know no bins."""
    trees: dict[int, Tree] = {}
    for number, i, feature, threshold, nulls_left, value, n, gain in rows:
        t = trees.setdefault(number, Tree(depth))
        t.value[i], t.rows[i] = value, n
        if feature is not None:
            t.feature[i], t.threshold[i], t.nulls_left[i], t.gain[i] = features.index(feature), threshold, nulls_left, gain
    return [trees[k] for k in sorted(trees)]
