"""Data-quality checks: keys, references, declared limits, nulls."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.schemas import FOREIGN_KEYS, PRIMARY_KEYS, TYPE_LIMITS


def _union_all(parts: Sequence[DataFrame]) -> DataFrame:
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def pk_check(tables: Mapping[str, DataFrame], keys: Mapping[str, str] = PRIMARY_KEYS) -> DataFrame:
    """Rows, distinct and null keys per table; a repeated null also makes a key not unique."""
    return _union_all([_pk_check(tables[t], t, k) for t, k in keys.items() if t in tables])


def _pk_check(df: DataFrame, table: str, key: str) -> DataFrame:
    rows, nulls = F.sum("count"), F.sum(F.when(F.col(key).isNull(), F.col("count")).otherwise(0))
    return df.groupBy(key).count().agg(
        F.lit(table).alias("tabla"),
        F.lit(key).alias("clave"),
        F.coalesce(rows, F.lit(0)).alias("filas"),
        F.count(key).alias("distintos"),
        F.coalesce(nulls, F.lit(0)).alias("nulos"),
        (F.coalesce(F.max("count"), F.lit(1)) == 1).alias("es_unica"),
    )


def fk_orphans(tables: Mapping[str, DataFrame], foreign_keys=FOREIGN_KEYS) -> DataFrame:
    """Rows whose reference has no parent; a null reference counts as one.

    Children are counted per key before the anti join, so a key with very many children is one row.
    """
    return _union_all(
        [
            tables[child]
            .groupBy(F.col(fk).alias("k"))
            .count()
            .join(tables[parent].select(F.col(pk).alias("k")).distinct(), "k", "left_anti")
            .agg(
                F.lit(child).alias("tabla"),
                F.lit(fk).alias("clave"),
                F.coalesce(F.sum("count"), F.lit(0)).alias("huerfanos"),
            )
            for child, fk, parent, pk in foreign_keys
        ]
    )


def null_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Null count of every column that has any; one scan per table."""

    def one(name: str, df: DataFrame) -> DataFrame:
        rows = F.array(
            *[F.struct(F.lit(c).alias("columna"), F.col(c).alias("nulos")) for c in df.columns]
        )
        return (
            df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
            .select(F.lit(name).alias("tabla"), F.inline(rows))
            .where("nulos > 0")
        )

    return _union_all([one(name, df) for name, df in tables.items()])


def table_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Position, name and type of every column, with the table's row count."""

    def one(name: str, df: DataFrame) -> DataFrame:
        rows = F.array(
            *[
                F.struct(F.lit(i).alias("posicion"), F.lit(c).alias("columna"), F.lit(t).alias("tipo"))
                for i, (c, t) in enumerate(df.dtypes, start=1)
            ]
        )
        return df.agg(F.count(F.lit(1)).alias("filas")).select(F.lit(name).alias("tabla"), "filas", F.inline(rows))

    return _union_all([one(name, df) for name, df in tables.items()])


def type_limits(tables: Mapping[str, DataFrame], limits: Mapping[str, Mapping] = TYPE_LIMITS) -> DataFrame:
    """Values that would not fit the declared VARCHAR(n) or NUMERIC(p,s), per limited column."""

    def breaks(column: str, limit) -> tuple[str, object]:
        if isinstance(limit, int):
            return f"VARCHAR({limit})", F.length(F.col(column).cast("string")) > limit
        precision, scale = limit
        rounded = F.round(F.col(column).cast("double"), scale)
        return f"NUMERIC({precision},{scale})", F.abs(rounded) >= float(10 ** (precision - scale))

    def one(name: str, df: DataFrame) -> DataFrame:
        checks = [(c, *breaks(c, limit)) for c, limit in limits[name].items() if c in df.columns]
        rows = F.array(
            *[
                F.struct(F.lit(c).alias("columna"), F.lit(text).alias("limite"), F.col(c).alias("violaciones"))
                for c, text, _ in checks
            ]
        )
        counted = df.agg(*[F.count_if(bad).alias(c) for c, _, bad in checks])
        return counted.select(F.lit(name).alias("tabla"), F.inline(rows))

    return _union_all([one(name, tables[name]) for name in limits if name in tables])
