"""Risk reports over the base table. Rates are percentages rounded to two digits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import AMOUNT_BANDS, amount_band, score_band
from ..settings import Settings
from .ranks import numeric_key, with_ntile

# Fixed value: the state of a late payment in the data.
LATE_PAYMENT = "Pagado tardío"
#: Columns of the base table that the reports read.
INSIGHT_A = ("ocupacion", "estrato", "es_moroso", "monto_credito")
INSIGHT_B = ("score_externo", "es_moroso", "score_interno_originacion")
INSIGHT_C = ("producto_credito", "canal_originacion", "es_moroso", "relacion_cuota_ingreso")


def _rows() -> Column:
    return F.count(F.lit(1))


def _defaults() -> Column:
    return F.sum("es_moroso").cast("bigint")


def _rate_pct() -> Column:
    return F.round(F.lit(100.0) * F.sum("es_moroso") / _rows(), 2)


def insight_a(abt: DataFrame, min_loans: int = 10) -> DataFrame:
    """Default rate by occupation and stratum, groups above `min_loans` loans."""
    return (
        abt.groupBy("ocupacion", "estrato")
        .agg(
            _rows().alias("total_creditos"),
            _defaults().alias("creditos_morosos"),
            _rate_pct().alias("tasa_mora_pct"),
            F.round(F.avg("monto_credito"), 0).alias("monto_promedio"),
        )
        .where(F.col("total_creditos") > min_loans)
        .orderBy(F.desc("tasa_mora_pct"), "ocupacion", "estrato")
    )


def insight_b(abt: DataFrame) -> DataFrame:
    """Default rate by band of the external score."""
    return (
        abt.groupBy(score_band(F.col("score_externo")).alias("rango_score_externo"))
        .agg(
            _rows().alias("total_clientes"),
            _defaults().alias("creditos_morosos"),
            _rate_pct().alias("tasa_mora_pct"),
            F.round(F.avg("score_interno_originacion"), 0).alias("promedio_score_interno"),
        )
        .orderBy("rango_score_externo")
    )


def insight_c(abt: DataFrame) -> DataFrame:
    """Default rate and mean instalment-to-income by product and channel."""
    return (
        abt.groupBy("producto_credito", "canal_originacion")
        .agg(
            _rows().alias("total_creditos"),
            _defaults().alias("creditos_morosos"),
            _rate_pct().alias("tasa_mora_pct"),
            F.round(F.avg("relacion_cuota_ingreso") * 100, 2).alias("relacion_cuota_ingreso_avg_pct"),
        )
        .orderBy(F.desc("tasa_mora_pct"), "producto_credito", "canal_originacion")
    )


def session_quintiles(abt: DataFrame, tie_break: Column | None = None) -> DataFrame:
    """`quintil_sesion`: NTILE(5) by session seconds before the loan, ties by loan id (a text id by its hash)."""
    tie_break = numeric_key(abt, "credito_id") if tie_break is None else tie_break
    return with_ntile(abt, 5, "prev_evento_sesion_seg_tot", tie_break, "quintil_sesion")


def insight_d(abt: DataFrame, tie_break: Column | None = None) -> DataFrame:
    """Default rate and prior app behaviour by quintile of session time."""
    simulations = next(c for c in abt.columns if c.startswith("prev_evento_simulacion"))
    return (
        session_quintiles(abt, tie_break)
        .groupBy("quintil_sesion")
        .agg(
            _rows().alias("total_clientes"),
            _defaults().alias("morosos"),
            _rate_pct().alias("tasa_mora_pct"),
            F.round(F.avg("prev_evento_pago_fallido"), 2).alias("promedio_pagos_fallidos_previos"),
            F.round(F.avg(simulations), 2).alias("promedio_simulaciones_previas"),
        )
        .orderBy("quintil_sesion")
    )


def insight_e(pagos: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Late payments and mean arrears by instalment number, instalments due by the cutoff."""
    late = F.count_if(F.col("estado_pago") == LATE_PAYMENT)
    return (
        pagos.where(F.col("fecha_vencimiento") <= F.lit(settings.cutoff_date).cast("date"))
        .groupBy("numero_cuota")
        .agg(
            _rows().alias("total_cuotas_evaluadas"),
            late.alias("total_pagos_tardios"),
            F.round(F.avg("dias_mora"), 1).alias("dias_mora_promedio"),
            F.round(F.lit(100.0) * late / _rows(), 2).alias("tasa_pago_tardio_pct"),
        )
        .orderBy("numero_cuota")
    )


def portfolio_totals(scored: DataFrame) -> DataFrame:
    """One row: loans, defaulters, rate, amount, amount at risk and its share, healthy amount."""
    amount = F.sum("monto_credito")
    at_risk = F.sum(F.when(F.col("es_moroso") == 1, F.col("monto_credito")).otherwise(0.0))
    return scored.agg(
        _rows().alias("total"),
        _defaults().alias("morosos"),
        F.try_divide(F.sum("es_moroso"), _rows()).alias("tasa_mora"),
        amount.alias("monto_total"),
        at_risk.alias("monto_en_riesgo"),
        F.try_divide(at_risk, amount).alias("tasa_monto_en_riesgo"),
        (amount - at_risk).alias("monto_sano"),
    )


def portfolio_by_product(scored: DataFrame) -> DataFrame:
    """Loans without a product are left out, as in the other portfolio breakdowns."""
    return (
        scored.where("producto_credito IS NOT NULL")
        .groupBy("producto_credito")
        .agg(
            F.count("credito_id").alias("creditos"),
            _defaults().alias("morosos"),
            F.avg("monto_credito").alias("monto_prom"),
        )
        .orderBy("producto_credito")
    )


def portfolio_by_channel(scored: DataFrame) -> DataFrame:
    return (
        scored.where("canal_originacion IS NOT NULL")
        .groupBy("canal_originacion")
        .agg(F.count("credito_id").alias("creditos"), _defaults().alias("morosos"))
        .orderBy("canal_originacion")
    )


def top_departments(scored: DataFrame, k: int = 8) -> DataFrame:
    """The k departments with the most defaulters, ties by name."""
    return (
        scored.where("departamento IS NOT NULL")
        .groupBy("departamento")
        .agg(F.count("credito_id").alias("creditos"), _defaults().alias("morosos"))
        .orderBy(F.desc("morosos"), "departamento")
        .limit(k)
    )


def default_rate(abt: DataFrame) -> DataFrame:
    return abt.agg(F.avg("es_moroso").alias("tasa_mora"))


def rate_by(abt: DataFrame, column: str) -> DataFrame:
    """Mean label per value of a column; null values are left out."""
    return abt.where(F.col(column).isNotNull()).groupBy(column).agg(F.avg("es_moroso").alias("tasa_mora"))


def rate_by_amount_band(abt: DataFrame, bands=AMOUNT_BANDS) -> DataFrame:
    """Loans, defaulters and rate per amount band, with a total row."""
    return (
        abt.select("es_moroso", amount_band(F.col("monto_credito"), bands).alias("rango"))
        .rollup("rango")
        .agg(
            F.grouping("rango").alias("es_total"),
            _rows().alias("creditos"),
            _defaults().alias("en_mora"),
            F.round(F.lit(100.0) * F.sum("es_moroso") / _rows(), 1).alias("tasa_mora_pct"),
        )
        .select(
            F.when(F.col("es_total") == 1, "Total").otherwise(F.col("rango")).alias("rango"),
            "creditos",
            "en_mora",
            "tasa_mora_pct",
        )
    )


def segment_rate(abt: DataFrame, **segment: str) -> DataFrame:
    """Loans, defaulters and rate of one segment, e.g. `producto_credito='...', ciudad='...'`."""
    for column, value in segment.items():
        abt = abt.where(F.col(column) == value)
    return abt.agg(
        _rows().alias("creditos"),
        F.coalesce(_defaults(), F.lit(0)).alias("morosos"),
        F.round(F.try_divide(F.lit(100.0) * F.sum("es_moroso"), _rows()), 2).alias("tasa_mora_pct"),
    )


def event_means_by_label(abt: DataFrame) -> DataFrame:
    """Mean of every prior-event column per label, one row per column."""
    names = [c for c in abt.columns if "prev_evento" in c]
    means = [
        F.avg(F.when(F.col("es_moroso") == label, F.col(c))).alias(f"{c}__{label}") for c in names for label in (0, 1)
    ]
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("variable"), F.col(f"{c}__0").alias("media_0"), F.col(f"{c}__1").alias("media_1"))
            for c in names
        ]
    )
    return abt.agg(*means).select(F.inline(rows))
