"""Unit vectors and cosine top-k, exact and approximate."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..settings import stage

MAX_QUERIES_PER_TASK = 2_048
QUERY_BLOCK_BYTES = 32 * 2**20
SCORE_DIGITS = 9
SCORES_AT_ONCE = 2_000_000


def unit(v: Column) -> Column:
    """`v` scaled to length one, in double; a zero vector stays as it is."""
    v = v.cast("array<double>")
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
    return F.when(norm > 0, F.transform(v, lambda x: x / norm)).otherwise(v)


def normalize_vectors(df: DataFrame, vector: str = "embedding") -> DataFrame:
    return df.withColumn(vector, unit(F.col(vector)))


def _unit_rows(m: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(norm > 0, norm, 1.0)


class _Best:
    """The k best rows per query among the batches seen so far, equal scores by lower id."""

    def __init__(self, queries: np.ndarray, k: int):
        self.queries, self.k = queries, k
        self.kept: list[list[tuple]] = [[] for _ in range(len(queries))]

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        step = max(SCORES_AT_ONCE // len(self.queries), 1)
        for start in range(0, len(ids), step):
            self._add(ids[start : start + step], vectors[start : start + step])

    def _add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        scores = np.round(self.queries @ _unit_rows(vectors).T, SCORE_DIGITS)
        for q, row in enumerate(scores):
            if len(row) > self.k:
                floor = np.partition(row, -self.k)[-self.k]
                hits = np.flatnonzero(row >= floor)
            else:
                hits = np.arange(len(row))
            merged = self.kept[q] + [(-row[i], ids[i]) for i in hits]
            self.kept[q] = heapq.nsmallest(self.k, merged)

    def columns(self, query_ids: list) -> tuple[list, list, list]:
        flat = [(query_ids[q], i, -s) for q, best in enumerate(self.kept) for s, i in best]
        return [f[0] for f in flat], [f[1] for f in flat], [float(f[2]) for f in flat]


def knn_exact(
    corpus: DataFrame,
    queries: DataFrame,
    k: int = 3,
    id_col: str = "vec_id",
    query_col: str = "query_id",
    vector: str = "embedding",
    max_queries: int = MAX_QUERIES_PER_TASK,
) -> DataFrame:
    """query_id, id, score, rank: the k corpus rows with the highest cosine per query.

    Queries are cut into blocks of at most `max_queries` and QUERY_BLOCK_BYTES, each of which is broadcast and scanned
    against the corpus where that is read; tasks keep k rows per query, so k rows per query and partition are all that is
    shuffled, and the corpus never is. More queries take more scans, by the same path. Ids must be unique. A null
    vector takes no part; vectors of different length, among queries or between them and the corpus, are an error.
    """
    id_type, query_type = dict(corpus.dtypes)[id_col], dict(queries.dtypes)[query_col]
    out_schema = f"{query_col} {_wide(query_type)}, {id_col} {_wide(id_type)}, score double"

    def typed(df: DataFrame, key: str) -> DataFrame:
        values = F.col(vector).cast("array<double>").alias(vector)
        return df.select(F.col(key).cast(_wide(dict(df.dtypes)[key])).alias(key), values).where(F.col(vector).isNotNull())

    rows, candidates = typed(corpus, id_col), None
    for ids, matrix in _query_blocks(typed(queries, query_col), query_col, vector, max_queries):
        found = _against(rows, ids, matrix, k, id_col, query_col, out_schema)
        candidates = found if candidates is None else candidates.union(found)
    if candidates is None:
        return rows.sparkSession.createDataFrame([], f"{query_col} {query_type}, {id_col} {id_type}, score double, rank int")
    w = Window.partitionBy(query_col).orderBy(F.desc("score"), id_col)
    best = candidates.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return best.withColumns({query_col: F.col(query_col).cast(query_type), id_col: F.col(id_col).cast(id_type)})


def _query_blocks(known: DataFrame, query_col: str, vector: str, max_queries: int) -> Iterator[tuple[list, np.ndarray]]:
    """Ids and unit vectors of the queries; one block at a time is on the driver."""
    ids, held, dim = [], [], None
    for r in known.toLocalIterator():
        dim = len(r[vector]) if dim is None else dim
        if len(r[vector]) != dim:
            raise ValueError(f"query vectors of {dim} and {len(r[vector])} components")
        if ids and (len(ids) == max_queries or (len(ids) + 1) * dim * 8 > QUERY_BLOCK_BYTES):
            yield ids, _unit_rows(np.array(held, dtype=float))
            ids, held = [], []
        ids.append(r[query_col])
        held.append(r[vector])
    if ids:
        yield ids, _unit_rows(np.array(held, dtype=float))


def _wide(spark_type: str) -> str:
    """Ids travel through Python as bigint or string."""
    return "bigint" if spark_type in ("tinyint", "smallint", "int", "bigint") else "string"


def _against(rows, query_ids, matrix, k, id_col, query_col, out_schema) -> DataFrame:
    """The k best rows of each partition for each query of a block."""
    shared = rows.sparkSession.sparkContext.broadcast((query_ids, matrix))
    dim = matrix.shape[1]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of_queries, q = shared.value
        best = _Best(q, k)
        for batch in batches:
            if batch.num_rows:
                sizes = np.diff(batch.column(1).offsets.to_numpy())
                if (sizes != dim).any():
                    raise ValueError(f"corpus vectors of {sizes[sizes != dim][0]} components, queries of {dim}")
                flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
                best.add(np.array(batch.column(0).to_pylist(), dtype=object), flat.reshape(-1, dim))
        a, b, c = best.columns(ids_of_queries)
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(c)], [query_col, id_col, "score"])

    return rows.mapInArrow(search, out_schema)


def knn_approx(
    corpus: DataFrame,
    queries: DataFrame,
    k: int = 3,
    id_col: str = "vec_id",
    query_col: str = "query_id",
    vector: str = "embedding",
    cells: int | None = None,
    recall: float = 0.95,
    sample: int = 64,
    seed: int = 42,
) -> DataFrame:
    """As `knn_exact`, but only scores rows in the cells nearest to the query.

    Cells are those of k-means on unit vectors, by default the square root of the rows, 1 024 at most, so their centres
    are small enough to broadcast. How many cells a query visits is measured: up to `sample` queries are searched
    exactly, and the cells visited are those that hold `recall` of what was found. On data without clusters that is
    most of them. Queries travel to the rows as in `knn_exact`; k rows per query and partition are shuffled.
    """

    def units(df: DataFrame, key: str) -> DataFrame:
        return df.where(F.col(vector).isNotNull()).select(key, unit(F.col(vector)).alias(vector))

    rows, asked = units(corpus, id_col), units(queries, query_col)
    n = rows.count()
    if not n or asked.isEmpty():
        return knn_exact(corpus, queries, k, id_col, query_col, vector)
    cells = max(1, min(cells or math.isqrt(n), 1024))
    known = rows.withColumn("_vector", array_to_vector(vector))
    model = KMeans(k=cells, seed=seed, maxIter=10, featuresCol="_vector", predictionCol="_cell").fit(
        known.where(F.pmod(F.xxhash64(id_col), F.lit(max(1, n // 200_000))) == 0)
    )
    placed = model.transform(known).drop("_vector")
    centres = np.array(model.clusterCenters())

    few = asked.orderBy(F.xxhash64(query_col), query_col).limit(sample)
    hits = knn_exact(rows, few, k, id_col, query_col, vector).select(query_col, id_col)
    cell_of = {(r[0], r[1]): r[2] for r in placed.select(id_col, "_cell").join(F.broadcast(hits), id_col).select(query_col, id_col, "_cell").collect()}
    order = {r[query_col]: np.argsort(-(centres @ np.array(r[vector])), kind="stable").tolist() for r in few.collect()}
    needed = sorted(order[q].index(c) + 1 for (q, _), c in cell_of.items())
    probes = needed[min(len(needed) - 1, math.ceil(recall * len(needed)) - 1)] if needed else 1

    id_type, query_type = dict(rows.dtypes)[id_col], dict(asked.dtypes)[query_col]
    schema = f"{query_col} {_wide(query_type)}, {id_col} {_wide(id_type)}, score double"
    spread = placed.select(F.col(id_col).cast(_wide(id_type)).alias(id_col), vector, "_cell")
    candidates = None
    for ids, matrix in _query_blocks(asked.withColumn(query_col, F.col(query_col).cast(_wide(query_type))), query_col, vector, MAX_QUERIES_PER_TASK):
        visited = np.argsort(-(matrix @ centres.T), axis=1, kind="stable")[:, :probes]
        found = _in_cells(spread, ids, matrix, visited, cells, k, id_col, query_col, schema)
        candidates = found if candidates is None else candidates.union(found)
    w = Window.partitionBy(query_col).orderBy(F.desc("score"), id_col)
    best = candidates.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return best.withColumns({query_col: F.col(query_col).cast(query_type), id_col: F.col(id_col).cast(id_type)})


def _in_cells(rows, query_ids, matrix, visited, cells, k, id_col, query_col, schema) -> DataFrame:
    """The k best rows of each partition for each query, among the rows of the cells that the query visits."""
    of_cell = [np.flatnonzero((visited == c).any(axis=1)) for c in range(cells)]
    shared = rows.sparkSession.sparkContext.broadcast((query_ids, matrix, of_cell))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of_queries, q, askers = shared.value
        best = [_Best(q[own], k) if len(own) else None for own in askers]
        for batch in batches:
            own = batch.column(2).to_numpy()
            ids = np.array(batch.column(0).to_pylist(), dtype=object)
            vectors = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, q.shape[1])
            for c in np.unique(own):
                if best[c] is not None:
                    best[c].add(ids[own == c], vectors[own == c])
        for c, b in enumerate(best):
            if b is not None:
                x, y, z = b.columns([ids_of_queries[i] for i in askers[c]])
                if x:
                    yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y), pa.array(z)], [query_col, id_col, "score"])

    return rows.mapInArrow(search, schema)


def contexts(
    hits: DataFrame,
    texts: DataFrame,
    queries: DataFrame,
    id_col: str,
    text_col: str,
    fallback: str,
    query_col: str = "query_id",
    max_broadcast_rows: int = 1_000_000,
) -> DataFrame:
    """query_id, contexto: the texts of each query's hits in rank order, one per line.

    A query without any text gets `fallback`. The hits, a few narrow rows per query, are staged and counted; up to
    `max_broadcast_rows` they are broadcast, so texts are read where they lie and only those found are shuffled.
    """
    hits = stage(hits.select(query_col, id_col, "rank"), "hits")
    few = F.broadcast(hits) if hits.count() <= max_broadcast_rows else hits
    found = (
        texts.select(id_col, F.col(text_col).alias("_text"))
        .join(few, id_col)
        .groupBy(query_col)
        .agg(F.array_sort(F.collect_list(F.struct("rank", "_text"))).alias("_ranked"))
        .select(query_col, F.array_join(F.transform("_ranked", lambda s: s["_text"]), "\n").alias("contexto"))
    )
    return (
        queries.select(query_col)
        .join(found, query_col, "left")
        .withColumn("contexto", F.coalesce(F.when(F.col("contexto") != "", F.col("contexto")), F.lit(fallback)))
    )
