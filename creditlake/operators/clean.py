"""Cleaning of the sources, in the two dialects `py` and `sql`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import city_py, city_sql
from .ranks import exact_medians

UNKNOWN = "Desconocido"
# Fills of the SQL dialect.
SQL_INCOME, SQL_SCORE, SQL_AGE = 2_200_000.0, 580.0, 35
REQUIRED_LOAN_COLUMNS = ("credito_id", "cliente_id", "monto_credito")
MIN_AGE, MAX_AGE = 18, 110


def _present(df: DataFrame, names) -> list[str]:
    return [c for c in names if c in df.columns]


def impute_median(df: DataFrame, names) -> DataFrame:
    """Fill nulls of each column with its exact median."""
    return df.fillna({c: m for c, m in exact_medians(df, names).items() if m is not None})


def impute_constant(df: DataFrame, values: dict) -> DataFrame:
    return df.fillna({c: v for c, v in values.items() if c in df.columns})


def repair_age(df: DataFrame, replacement: float | int) -> DataFrame:
    """Replace ages outside 18..110; a null age stays null."""
    age = F.col("edad")
    bad = (age < MIN_AGE) | (age > MAX_AGE)
    return df.withColumn("edad", F.when(bad, F.lit(replacement)).otherwise(age))


def clean_clientes_py(df: DataFrame) -> DataFrame:
    """Median fill of income and score, city names, median in place of impossible ages.

    The age median is taken over the whole column, impossible ages included.
    """
    medians = exact_medians(df, _present(df, ("ingreso_mensual_estimado", "score_externo", "edad")))
    age = medians.pop("edad", None)
    df = df.fillna({c: m for c, m in medians.items() if m is not None})
    if age is not None:
        df = repair_age(df, age)
    if "ciudad" in df.columns:
        df = df.withColumn("ciudad", city_py(F.col("ciudad")))
    return df


def clean_clientes_sql(df: DataFrame) -> DataFrame:
    """The same with constants and the shorter city list; the e-mail hash is left out."""
    df = impute_constant(df, {"ingreso_mensual_estimado": SQL_INCOME, "score_externo": SQL_SCORE})
    if "edad" in df.columns:
        df = repair_age(df, SQL_AGE)
    if "ciudad" in df.columns:
        df = df.withColumn("ciudad", city_sql(F.col("ciudad")))
    return df.drop("email_hash")


def clean_creditos(df: DataFrame) -> DataFrame:
    """Unknown product made explicit; loans without id, client or amount dropped."""
    if "producto_credito" in df.columns:
        df = df.fillna({"producto_credito": UNKNOWN})
    for c in _present(df, REQUIRED_LOAN_COLUMNS):
        df = df.where(F.col(c).isNotNull())
    return df


def clean_pagos(df: DataFrame) -> DataFrame:
    """Missing paid amount 0, missing means of payment made explicit, negative arrears 0 (null stays)."""
    for amount in _present(df, ("monto_pago", "valor_pagado"))[:1]:
        df = df.fillna({amount: 0.0})
    if "medio_pago" in df.columns:
        df = df.fillna({"medio_pago": UNKNOWN})
    if "dias_mora" in df.columns:
        late = F.col("dias_mora")
        df = df.withColumn("dias_mora", F.when(late < 0, 0).otherwise(late))
    return df
