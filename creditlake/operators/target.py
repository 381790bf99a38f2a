"""The default label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..settings import Settings


def default_label(pagos: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """credito_id, es_moroso: 1 if any instalment due up to the cutoff was late beyond the limit.

    Only instalments due by the cutoff count; an undated one does not. `max` combines before the
    shuffle, so a loan with very many instalments costs one row per input partition.
    """
    if "dias_mora" not in pagos.columns:
        raise ValueError("payments lack the column dias_mora")
    if "fecha_vencimiento" in pagos.columns:
        pagos = pagos.where(F.col("fecha_vencimiento") <= F.lit(settings.cutoff_date).cast("date"))
    return (
        pagos.where("credito_id IS NOT NULL")
        .groupBy("credito_id")
        .agg(F.coalesce((F.max("dias_mora") > settings.default_after_days).cast("int"), F.lit(0)).alias("es_moroso"))
    )
