"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot from half a partition's fair share of the rows on, but from 1 % at most and 0.1 % at least.
HOT_SHARE, LEAST_SHARE = 0.01, 0.001
SALTS_PER_PARTITION, MAX_SALTS = 4, 10_000


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_weights(df: DataFrame, key: str, share: float | None = None) -> dict:
    """The values of `key` that hold at least `share` of the rows, so at most 1 / share of them, with their shares.

    A bounded summary of one column names the candidates without a shuffle of the rows; a second
    scan of that column counts just those. `share` defaults to what would unbalance the shuffle partitions.
    """
    share = share or min(HOT_SHARE, max(LEAST_SHARE, 0.5 / _partitions(df)))
    keys = df.select(key).where(F.col(key).isNotNull())
    frequent = keys.freqItems([key], share).first()
    if not frequent or not frequent[0]:
        return {}
    counts = keys.groupBy(F.when(F.col(key).isin(frequent[0]), F.col(key)).alias("k")).count().collect()
    total = sum(r["count"] for r in counts)
    hot = [(r["k"], r["count"] / total) for r in counts if r["k"] is not None and r["count"] >= share * total]
    return dict(sorted(hot))


def hot_keys(df: DataFrame, key: str, share: float | None = None) -> list:
    """Just the keys of `hot_weights`."""
    return list(hot_weights(df, key, share))


def lookup_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], hot_key: str, hot: Mapping | Sequence, how: str = "left"
) -> DataFrame:
    """Equi join of a large `left` with a `right` that is (nearly) unique on `on`.

    Left rows of the hot keys are spread over salts, several for each partition's share of rows that a key holds,
    and only the right rows of that key are copied to each of its salts. Keys given without shares count as
    holding all rows.
    """
    if not hot:
        return left.join(right, list(on), how)
    shares = hot if isinstance(hot, Mapping) else dict.fromkeys(hot, 1.0)
    partitions = _partitions(left)
    salts = {k: max(2, min(math.ceil(SALTS_PER_PARTITION * partitions * w), MAX_SALTS)) for k, w in shares.items()}
    number = F.element_at(F.create_map(*(F.lit(x) for pair in salts.items() for x in pair)), F.col(hot_key))
    is_hot = F.col(hot_key).isin(list(salts))
    spread = F.pmod(F.xxhash64(*left.columns), number).cast("int")
    left = left.withColumn("_salt", F.when(is_hot, spread).otherwise(0))
    copies = F.when(is_hot, F.sequence(F.lit(0), number - 1)).otherwise(F.array(F.lit(0)))
    right = right.withColumn("_salt", F.explode(copies))
    return left.join(right, [*on, "_salt"], how).drop("_salt")
