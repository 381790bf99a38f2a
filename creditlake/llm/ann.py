"""Approximate nearest neighbours by several shifted Hilbert orders of projected vectors."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditlake.llm.common import ranked, small_batches
from creditlake.settings import stage

#: Orders, and the directions and bits of each.
CURVES = 8
DIRECTIONS = 8
BITS = 7
#: Part of the true neighbours of the sample that the windows must hold, and the queries of the sample.
TARGET = 0.96
SAMPLE = 128
#: Rows of a block, and about as many queries that meet it in one task.
BLOCK = 2048
#: Vectors kept beyond those asked for, so that the last bits of block products leave none out that the exact cosine prefers.
SPARE = 8


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of non-negative coordinates below 2^bits along the Hilbert curve (Skilling, 2004)."""
    x = cells.astype(np.int64).copy()
    m = x.shape[1]
    for level in range(bits - 1, 0, -1):
        q, p = 1 << level, (1 << level) - 1
        for i in range(m):
            high = (x[:, i] & q) != 0
            swap = np.where(high, 0, (x[:, 0] ^ x[:, i]) & p)
            x[:, 0] ^= np.where(high, p, swap)
            if i:
                x[:, i] ^= swap
    for i in range(1, m):
        x[:, i] ^= x[:, i - 1]
    turn = np.zeros(len(x), np.int64)
    for level in range(bits - 1, 0, -1):
        turn = np.where((x[:, m - 1] >> level) & 1, turn ^ ((1 << level) - 1), turn)
    x ^= turn[:, None]
    keys = np.zeros(len(x), np.int64)
    for level in range(bits - 1, -1, -1):
        for i in range(m):
            keys = (keys << 1) | ((x[:, i] >> level) & 1)
    return keys


def _usable(v: Column) -> Column:
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1, scaled first so that no square overflows or vanishes."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _best(queries: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, k: int, allowed: np.ndarray | None = None):
    """For each query, places of its up to k best rows with their cosines to 13 digits, ties to the smaller id."""
    by_id = np.argsort(row_ids, kind="stable")
    cos = np.round(queries @ rows[by_id].T, 13)  # the last bits depend on the shape of the block
    if allowed is not None:
        cos = np.where(allowed[:, by_id], cos, -np.inf)
    order = np.argsort(-cos, axis=1, kind="stable")[:, :k]
    best = np.take_along_axis(cos, order, axis=1)
    return by_id[order], best


def _curves(vectors: DataFrame, dim: int, curves: int, seed: int) -> DataFrame:
    """(curve, vid, key): each vector's place on each curve, from a random rotation and shift of its direction."""
    m = min(DIRECTIONS, dim)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns = []
        for c in range(curves):
            rng = np.random.default_rng([seed, c])
            turns.append((np.linalg.qr(rng.normal(size=(dim, m)))[0], rng.uniform(-0.1, 0.1, m)))
        for b in small_batches(batches):
            unit = _unit(_matrix(b.column(1), dim))
            for c, (turn, shift) in enumerate(turns):
                at = np.clip(unit @ turn * (math.sqrt(dim) / 8) + 0.5 + shift, 0, 1 - 1e-9)
                key = hilbert_keys((at * (1 << BITS)).astype(np.int64), BITS)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), c, np.int32)), b.column(0), pa.array(key)], names=["curve", "vid", "key"])

    return vectors.select("vid", "embedding").mapInArrow(keys, "curve int, vid long, key long")


def _window(vectors: DataFrame, places: DataFrame, wanted: DataFrame, n: int, dim: int, k: int, target: float) -> int:
    """Ranks to either side in which, on the nearest of the curves, `target` of the sampled queries' true neighbours lie.

    The sample is compared with all vectors; tasks keep k each, so sample times k rows are ranked.
    """
    if n <= BLOCK:
        return n
    picked = wanted.orderBy(F.xxhash64("vid"), "vid").limit(SAMPLE)
    picked = vectors.join(F.broadcast(picked.withColumnRenamed("vid", "picked")), F.col("vid") == F.col("picked"))
    sample = [(r["vid"], r["embedding"]) for r in picked.select("vid", "embedding").collect()]  # SAMPLE vectors
    names, units = np.array([v for v, _ in sample]), _unit(np.array([e for _, e in sample], np.float64))

    def brute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, 4 << 20):
            own = b.column(0).to_numpy()
            at, cos = _best(units, _unit(_matrix(b.column(1), dim)), own, k + 1)
            columns = [np.repeat(names, at.shape[1]), own[at.ravel()], cos.ravel()]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["a", "b", "cos"])

    near = vectors.select("vid", "embedding").mapInArrow(brute, "a long, b long, cos double").where("a != b")
    near = near.withColumn("n", F.row_number().over(Window.partitionBy("a").orderBy(F.desc("cos"), "b"))).where(F.col("n") <= k)
    pairs = [(r["a"], r["b"]) for r in near.collect()]  # SAMPLE times k
    if not pairs:
        return 1
    ids = near.sparkSession.createDataFrame([(x,) for x in {x for p in pairs for x in p}], "id long")
    found: dict[tuple[int, int], int] = {}
    for r in places.join(F.broadcast(ids), F.col("vid") == F.col("id")).collect():
        found[r["curve"], r["vid"]] = r["place"]
    curves = {c for c, _ in found}
    gaps = sorted(min(abs(found[c, a] - found[c, b]) for c in curves) for a, b in pairs)
    return max(1, gaps[min(len(gaps) - 1, math.ceil(target * len(gaps)))])


def nearest(table: DataFrame, k: int = 5, every: int = 50, curves: int = CURVES, target: float = TARGET, seed: int = 11) -> DataFrame:
    """The k nearest found of each query, by cosine: (query_id, rank, vec_id, score).

    Queries are the rows whose vec_id is divisible by `every`; candidates are all rows but the query's own. Equal vectors are
    indexed once, with their k + 1 smallest ids, which are all that any query can need of them. Each vector's direction
    is projected by `curves` random rotations and shifts, and ranked along a Hilbert curve in each, range partitioned.
    A query takes the vectors whose rank on a curve is at most a window from its own; windows are cut into blocks of rows, which
    meet the queries in groups of bounded size on both sides; the best of all windows and curves are merged and their
    cosines kept. The width of the window is measured: a sample of queries is compared with all vectors, and the window
    holds `target` of their true neighbours on at least one curve. So recall holds at any size, and the work follows
    how well the data cluster: where directions carry no order, the windows grow until they cover most of the table.

    The cosines of what is found are computed again from the original vectors, one pair at a time in one order, so they do not
    depend on how rows met in blocks.

    Vectors that are null, empty, zero or hold null or non-finite components take no part, nor do null ids. A vector's neighbours
    have its length: vectors of each length are searched by themselves. A repeated row counts once. Ties go to the smaller
    id. An empty table gives an empty result; other columns are not read.
    """
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.where(F.col("vec_id").isNotNull() & _usable(F.col("embedding")))
    first = Window.partitionBy("embedding").orderBy("vec_id")
    equal = rows.withColumn("n", F.dense_rank().over(first)).where(F.col("n") <= k + 1)
    equal = equal.groupBy("embedding").agg(F.array_sort(F.collect_set("vec_id")).alias("ids"))
    vectors = stage(equal.select(F.element_at("ids", 1).alias("vid"), "embedding", "ids"), "vectors")
    lengths = sorted((r[0], r[1]) for r in vectors.groupBy(F.size("embedding")).agg(F.count("*")).collect())
    asked = rows.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("asked")).distinct()
    asked = stage(asked.join(vectors, F.col("asked") == F.col("embedding")).select("query_id", "vid", F.size("asked").alias("dim")), "asked")
    result = table.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for dim, n in lengths:
        own, queries = vectors, asked
        if len(lengths) > 1:
            own, queries = vectors.where(F.size("embedding") == dim), asked.where(F.col("dim") == dim)
        found = _search(own, queries.select("query_id", "vid"), n, dim, k, curves, target, seed)
        result = found if len(lengths) == 1 else result.union(found)
    return result


def _search(vectors: DataFrame, asked: DataFrame, n: int, dim: int, k: int, curves: int, target: float, seed: int) -> DataFrame:
    """`nearest` among n different vectors of one length."""
    wanted = asked.select("vid").distinct()
    n_wanted = wanted.count()
    places = stage(ranked(_curves(vectors, dim, curves, seed), ["curve"], [F.col("key"), F.col("vid")], "place").select("curve", "vid", "place"), "places")
    width = _window(vectors, places, wanted, n, dim, k, target)
    chunks = max(1, math.ceil(n_wanted * min(1.0, (2 * width + BLOCK) / n) / BLOCK))

    named = vectors.select(F.col("vid").alias("of"), "embedding")
    placed = places.join(named, F.col("vid") == F.col("of")).select("curve", "vid", "place", "embedding")
    keys = ["curve", "block", "chunk"]
    held = placed.withColumn("block", F.floor(F.col("place") / BLOCK)).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    sought = placed.join(wanted.withColumnRenamed("vid", "wanted"), F.col("vid") == F.col("wanted"), "left_semi")
    low = F.floor(F.greatest(F.col("place") - width, F.lit(0)) / BLOCK)
    high = F.floor(F.least(F.col("place") + width, F.lit(n - 1)) / BLOCK)
    sought = sought.withColumn("block", F.explode(F.sequence(low, high))).withColumn("chunk", F.pmod(F.xxhash64("vid"), F.lit(chunks)).cast("int"))

    def search(blocks: pa.Table, queries: pa.Table) -> pa.Table:
        ids, names = blocks["vid"].to_numpy(), queries["q_vid"].to_numpy()
        out = {"query": np.empty(0, np.int64), "found": np.empty(0, np.int64), "cos": np.empty(0)}
        if len(ids) and len(names):
            x, q = _unit(_matrix(blocks["embedding"], dim)), _unit(_matrix(queries["q_embedding"], dim))
            here, there = blocks["place"].to_numpy(), queries["q_place"].to_numpy()
            parts = []
            for i in range(0, len(q), 512):
                near = np.abs(there[i : i + 512, None] - here[None, :]) <= width
                at, cos = _best(q[i : i + 512], x, ids, k + 1 + SPARE, near)
                keep = np.isfinite(cos).ravel()
                parts.append((np.repeat(names[i : i + 512], at.shape[1])[keep], ids[at.ravel()[keep]], cos.ravel()[keep]))
            out = {c: np.concatenate([p[j] for p in parts]) for j, c in enumerate(out)}
        return pa.table(out)

    sought = sought.select(*(F.col(c).alias(f"q_{c}") for c in (*keys, "vid", "place", "embedding")))
    hits = held.groupBy(*keys).cogroup(sought.groupBy(*(f"q_{c}" for c in keys))).applyInArrow(search, "query long, found long, cos double")
    hits = hits.groupBy("query", "found").agg(F.max("cos").alias("cos"))
    best = Window.partitionBy("query").orderBy(F.desc("cos"), F.asc("found"))
    hits = hits.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1 + SPARE).select("query", "found")

    def cosines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            cos = (_unit(_matrix(b.column(2), dim)) * _unit(_matrix(b.column(3), dim))).sum(axis=1)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cos), b.column(1)], names=["query", "cos", "ids"])

    pairs = hits.join(vectors, F.col("found") == F.col("vid")).select("query", "ids", "embedding")
    pairs = pairs.join(vectors.select("vid", F.col("embedding").alias("asked")), F.col("query") == F.col("vid")).select("query", "ids", "embedding", "asked")
    hits = pairs.mapInArrow(cosines, "query long, cos double, ids array<long>").select("query", "cos", F.explode("ids").alias("id"))
    lists = hits.groupBy("query").agg(F.array_sort(F.collect_list(F.struct((-F.col("cos")).alias("far"), "id"))).alias("near"))
    others = F.slice(F.filter("near", lambda x: x["id"] != F.col("query_id")), 1, k)
    result = asked.join(lists, F.col("vid") == F.col("query")).select("query_id", F.posexplode(others).alias("at", "hit"))
    return result.select("query_id", (F.col("at") + 1).alias("rank"), F.col("hit.id").alias("vec_id"), (-F.col("hit.far")).alias("score"))
