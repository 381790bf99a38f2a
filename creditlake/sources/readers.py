"""CSV, Parquet and table scans."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from .schemas import DATE_COLUMNS, SOURCE_DDL, SOURCE_FILES

#: Day before month where both could be meant.
DATE_FORMATS = ("yyyy-MM-dd", "yyyy/MM/dd", "yyyyMMdd", "dd-MM-yyyy", "dd/MM/yyyy")

log = logging.getLogger(__name__)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: str | StructType | None = None,
    date_cols: list[str] | None = None,
    multi_line: bool = False,
    date_formats: Sequence[str] = DATE_FORMATS,
) -> DataFrame:
    """Typed CSV scan by header name; a value that does not parse becomes null.

    A date is read by the first of `date_formats` that fits; `lost_dates` counts those that none fits.

    Columns missing from `schema` stay strings, an absent date column is only warned about, and an
    absent file raises. `multi_line` allows line breaks inside quotes but makes files unsplittable.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    raw = reader.csv(path)
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    types = {f.name: f.dataType.simpleString() for f in schema} if schema else {}
    for name in date_cols or []:
        if name in raw.columns:
            types[name] = "date"
        else:
            log.warning("date column %s is absent from %s", name, path)
    return raw.select(
        [_typed(c, types.get(c, "string"), date_formats).alias(c) for c in raw.columns]
    )


def _typed(name: str, dtype: str, date_formats: Sequence[str]) -> Column:
    c = F.col(name)
    if dtype == "string":
        return c
    if dtype == "date":
        # The calendar date of a time stamp, then the formats in turn; a format must fit the whole text.
        fits = [F.try_to_timestamp(F.when(F.length(F.trim(c)) == len(f), F.trim(c)), F.lit(f)).cast("date") for f in date_formats]
        return F.coalesce(F.when(c.rlike(r"^\s*\d{4}-"), c.try_cast("date")), *fits)
    return c.try_cast(dtype)


def lost_dates(spark: SparkSession, path: str, date_cols: Sequence[str], date_formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """columna, perdidas: texts in each date column that `read_csv` turns to null."""
    raw = spark.read.option("header", True).option("escape", '"').csv(path)
    found = [c for c in date_cols if c in raw.columns]
    lost = [F.count_if(F.col(c).isNotNull() & _typed(c, "date", date_formats).isNull()).alias(c) for c in found]
    rows = F.array(*[F.struct(F.lit(c).alias("columna"), F.col(c).alias("perdidas")) for c in found])
    return raw.agg(*lost).select(F.inline(rows))


def load_all(spark: SparkSession, raw_dir: str, register: bool = True) -> dict[str, DataFrame]:
    """The four sources by name, also registered as temp views `raw_<name>`."""
    sources = {
        name: read_csv(spark, f"{raw_dir}/{file}", SOURCE_DDL[name], DATE_COLUMNS[name])
        for name, file in SOURCE_FILES.items()
    }
    if register:
        for name, df in sources.items():
            df.createOrReplaceTempView("raw_eventos_app" if name == "eventos" else f"raw_{name}")
    return sources


def read_table(spark: SparkSession, name: str, jdbc: Mapping[str, str] | None = None) -> DataFrame:
    """A catalog table or view; with `jdbc` options (url, partitionColumn, bounds...) a database one."""
    if jdbc:
        return spark.read.format("jdbc").options(**jdbc, dbtable=name).load()
    return spark.table(name)


def read_abt(spark: SparkSession, path: str, schema: str | StructType | None = None) -> DataFrame:
    """The base table from CSV or Parquet, told apart by suffix; a CSV without `schema` gets the known types by name."""
    if path.rstrip("/").endswith(".csv"):
        if schema is None:
            header = spark.read.option("header", True).csv(path).columns
            schema = StructType([f for f in _abt_fields(header) if f.name in header])
        return read_csv(spark, path, schema)
    return spark.read.parquet(path)


def _abt_fields(header: Sequence[str]) -> list[StructField]:
    """Types of loans, clients and event counts, whole numbers for the label and calendar parts, else double."""
    known = {f.name: f for name in ("clientes", "creditos") for f in StructType.fromDDL(SOURCE_DDL[name])}
    whole = ("es_moroso", "prediccion_mora", "antiguedad_cliente_dias", "mes_desembolso", "dia_semana_desembolso")
    fields = [f for c, f in known.items()]
    fields += [StructField(c, LongType()) for c in whole]
    fields += [StructField(c, DoubleType()) for c in header if c.startswith(("prev_evento_", "probabilidad_"))]
    return fields


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: tabla, filas."""
    parts = [df.agg(F.lit(name).alias("tabla"), F.count(F.lit(1)).alias("filas")) for name, df in tables.items()]
    return _union_all(parts)


def table_counts(spark: SparkSession, names: list[str]) -> DataFrame:
    """Row count of each catalog table or view; null where it does not exist."""
    parts = []
    for name in names:
        if spark.catalog.tableExists(name):
            parts.append(row_counts({name: spark.table(name)}))
        else:
            parts.append(spark.sql("SELECT :name AS tabla, CAST(NULL AS BIGINT) AS filas", args={"name": name}))
    return _union_all(parts)


def _union_all(parts: list[DataFrame]) -> DataFrame:
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
