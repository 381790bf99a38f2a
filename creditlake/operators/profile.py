"""Exploratory statistics: histograms, box plots, correlations, frequent values."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from .ranks import exact_quantiles

# Columns left out of the correlation matrix.
NOT_CORRELATED = ("cliente_id", "credito_id", "pago_id", "mes_desembolso", "dia_semana_desembolso")


def value_counts(df: DataFrame, column: str, k: int | None = None) -> DataFrame:
    """Frequency of each non-null value, most frequent first, ties by value."""
    counts = (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), column)
    )
    return counts if k is None else counts.limit(k)


def histogram(df: DataFrame, columns: Mapping[str, tuple[Column, int]]) -> DataFrame:
    """Equal-width histograms: variable, bin, desde, hasta, n; empty bins included.

    `columns` maps a name to (column, number of bins). The top edge belongs to the last bin, and a
    constant column gets a range of one around its value. A column of nulls has no bins.
    """
    values = {name: c.cast("double") for name, (c, _) in columns.items()}
    extent = df.agg(
        *[f(c).alias(f"{f.__name__}_{name}") for name, c in values.items() for f in (F.min, F.max)]
    ).first()
    hits, empty = [], []
    for name, (_, bins) in columns.items():
        lo, hi = extent[f"min_{name}"], extent[f"max_{name}"]
        if lo is None:
            continue
        if lo == hi:
            lo, hi = lo - 0.5, hi + 0.5
        position = F.floor((values[name] - lo) * bins / F.lit(hi - lo))
        top_edge_last = F.when(position >= bins, bins - 1).otherwise(position)
        hits.append(F.struct(F.lit(name).alias("variable"), top_edge_last.alias("bin")))
        empty += [(name, b, lo + b * (hi - lo) / bins, lo + (b + 1) * (hi - lo) / bins) for b in range(bins)]
    schema = "variable string, bin bigint, desde double, hasta double"
    if not hits:
        return df.sparkSession.createDataFrame([], f"{schema}, n bigint")
    counts = (
        df.select(F.inline(F.array(*hits))).where("bin IS NOT NULL").groupBy("variable", "bin").agg(F.count(F.lit(1)).alias("n"))
    )
    edges = df.sparkSession.createDataFrame(empty, schema)
    return edges.join(counts, ["variable", "bin"], "left").fillna(0, ["n"])


def box_stats(df: DataFrame, label: str, column: str, most_labels: int = 100) -> DataFrame:
    """Quartiles, whiskers (outermost values within 1.5 IQR) and outlier count per label.

    The labels are on the driver; more than `most_labels` are an error.
    """
    labels = [r[0] for r in df.where(F.col(label).isNotNull()).groupBy(label).count().limit(most_labels + 1).collect()]
    if len(labels) > most_labels:
        raise ValueError(f"{label} has more than {most_labels} values")
    x = F.col(column)
    quartiles = exact_quantiles(df, {str(v): F.when(F.col(label) == v, x) for v in labels}, [0.25, 0.5, 0.75])
    q1 = q2 = q3 = F.lit(None).cast("double")
    for v in labels:
        here = F.col(label) == v
        a, b, c = quartiles[str(v)]
        q1, q2, q3 = F.when(here, a).otherwise(q1), F.when(here, b).otherwise(q2), F.when(here, c).otherwise(q3)
    reach = 1.5 * (q3 - q1)
    inside = x.between(q1 - reach, q3 + reach)
    return (
        df.where(F.col(label).isNotNull())
        .groupBy(label)
        .agg(
            F.count(column).alias("n"),
            F.min(F.when(inside, x)).alias("bigote_inf"),
            F.max(F.when(inside, x)).alias("bigote_sup"),
            F.count_if(~inside).alias("atipicos"),
        )
        .select(label, "n", q1.alias("q1"), q2.alias("mediana"), q3.alias("q3"), "bigote_inf", "bigote_sup", "atipicos")
    )


def numeric_columns(df: DataFrame, exclude: Sequence[str] = NOT_CORRELATED) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, NumericType) and f.name not in exclude]


def corr_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of every pair of columns, rows with either side null left out of the pair.

    Each task reduces its rows to the pairwise sums with matrix products, so the shuffle carries
    columns² numbers per task whatever the row count. Columns are centred first to keep the sums exact.
    """
    columns = list(columns or numeric_columns(df))
    data = df.select([F.col(c).cast("double").alias(c) for c in columns])
    means = data.agg(*[F.avg(c).alias(c) for c in columns]).first()
    centred = data.select([(F.col(c) - F.lit(means[c] if means[c] is not None else 0.0)).alias(c) for c in columns])
    d = len(columns)

    def partial_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sx, sxx, sxy = (np.zeros((d, d)) for _ in range(4))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float)
            present = ~np.isnan(x)
            x, m = np.where(present, x, 0.0), present.astype(float)
            n += m.T @ m
            sx += x.T @ m
            sxx += (x * x).T @ m
            sxy += x.T @ x
        i, j = np.divmod(np.arange(d * d), d)
        columns_out = [i, j, n.ravel(), sx.ravel(), sx.T.ravel(), sxx.ravel(), sxx.T.ravel(), sxy.ravel()]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns_out], ["i", "j", "n", "sx", "sy", "sxx", "syy", "sxy"])

    sums = ("n", "sx", "sy", "sxx", "syy", "sxy")
    total = (
        centred.mapInArrow(partial_sums, "i bigint, j bigint, " + ", ".join(f"{s} double" for s in sums))
        .groupBy("i", "j")
        .agg(*[F.sum(s).alias(s) for s in sums])
    )
    n, sx, sy, sxx, syy, sxy = (F.col(s) for s in sums)
    spread = F.sqrt(F.greatest(n * sxx - sx * sx, F.lit(0.0))) * F.sqrt(F.greatest(n * syy - sy * sy, F.lit(0.0)))
    name = F.array(*[F.lit(c) for c in columns])
    return total.select(
        F.get(name, F.col("i").cast("int")).alias("x"),
        F.get(name, F.col("j").cast("int")).alias("y"),
        F.try_divide(n * sxy - sx * sy, spread).alias("corr"),
    )
