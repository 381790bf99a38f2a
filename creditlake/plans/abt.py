"""The analytical base table: one row per loan, label and leakage-free features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import weekday_monday0, weekday_monday1
from ..operators.clean import clean_clientes_py, clean_clientes_sql, clean_creditos, clean_pagos
from ..operators.prior_events import SQL_EVENT_COLUMNS, event_features_py, event_features_sql
from ..operators.skew import hot_weights, lookup_join
from ..operators.target import default_label
from ..settings import Settings

SESSION_COLUMNS = ("prev_evento_sesion_seg_tot", "prev_evento_sesion_seg_avg")
# Column order of the SQL dialect's table.
SQL_COLUMNS = (
    "credito_id", "cliente_id", "fecha_desembolso", "producto_credito", "monto_credito",
    "plazo_meses", "tasa_interes_mensual", "valor_cuota_pactada", "canal_originacion",
    "score_interno_originacion", "relacion_cuota_ingreso", "politica_aprobacion", "fecha_registro",
    "departamento", "ciudad", "edad", "genero", "estrato", "nivel_educativo", "ocupacion",
    "ingreso_mensual_estimado", "canal_adquisicion", "score_externo", "tiene_producto_ahorro",
    "numero_dependientes", "dispositivo_principal", "antiguedad_cliente_dias", "mes_desembolso",
    "dia_semana_desembolso", *SQL_EVENT_COLUMNS.values(), *SESSION_COLUMNS, "es_moroso",
)


def build_abt(
    clientes: DataFrame,
    creditos: DataFrame,
    pagos: DataFrame,
    eventos: DataFrame | None = None,
    event_types: Sequence[str] | None = None,
    settings: Settings = Settings(),
) -> DataFrame:
    """Base table from cleaned sources, `py` dialect.

    Each lookup side is unique on its key; loans of clients with very many loans are salted.
    """
    hot = hot_weights(creditos, "cliente_id")
    abt = _with_label(creditos, pagos, settings)
    if eventos is not None:
        features = event_features_py(creditos, eventos, event_types, hot)
    abt_columns = list(abt.columns)
    client_columns = [c for c in clientes.columns if c != "cliente_id"]
    derived = []
    feature_columns = []
    if eventos is not None:
        feature_columns = [c for c in features.columns if c != "credito_id"]
        if feature_columns:
            abt = abt.join(features, "credito_id", "left").fillna(0, feature_columns)
    abt = lookup_join(abt, clientes, ["cliente_id"], "cliente_id", hot)
    if "fecha_desembolso" in abt.columns and "fecha_registro" in abt.columns:
        granted = F.col("fecha_desembolso")
        derived = [
            F.datediff(granted, "fecha_registro").alias("antiguedad_cliente_dias"),
            F.month(granted).alias("mes_desembolso"),
            weekday_monday0(granted).alias("dia_semana_desembolso"),
        ]
    return abt.select(*abt_columns, *client_columns, *derived, *feature_columns)


def _with_label(creditos: DataFrame, pagos: DataFrame, settings: Settings) -> DataFrame:
    """Loans without an instalment due by the cutoff get label 0."""
    return creditos.join(default_label(pagos, settings), "credito_id", "left").withColumn(
        "es_moroso", F.coalesce("es_moroso", F.lit(0))
    )


def abt_py(
    sources: dict[str, DataFrame], event_types: Sequence[str] | None = None, settings: Settings = Settings()
) -> DataFrame:
    """Clean the raw sources and build the base table, `py` dialect."""
    return build_abt(
        clean_clientes_py(sources["clientes"]),
        clean_creditos(sources["creditos"]),
        clean_pagos(sources["pagos"]),
        sources.get("eventos"),
        event_types,
        settings,
    )


def abt_sql(
    sources: dict[str, DataFrame], settings: Settings = Settings(), columns: Sequence[str] | None = None
) -> DataFrame:
    """The base table of the SQL dialect. Events are looked up from the raw loans.

    With `columns`, only these and what they need: events and clients are not read, nor their hot keys
    looked for, if none of their columns is asked for.
    """
    raw_creditos = sources["creditos"]
    wanted = set(SQL_COLUMNS if columns is None else columns)
    if unknown := wanted - set(SQL_COLUMNS):
        raise ValueError(f"no columns of the base table: {sorted(unknown)}")
    abt = _with_label(clean_creditos(raw_creditos), sources["pagos"], settings)
    events = wanted & {*SQL_EVENT_COLUMNS.values(), *SESSION_COLUMNS}
    clients = wanted & ({*sources["clientes"].columns, "antiguedad_cliente_dias"} - set(abt.columns))
    hot = hot_weights(raw_creditos, "cliente_id") if events or clients else {}
    if events:
        features = event_features_sql(raw_creditos, sources["eventos"], hot)
        feature_columns = [c for c in features.columns if c != "credito_id"]
        abt = abt.join(features, "credito_id", "left").fillna(0, feature_columns)
    if clients:
        abt = lookup_join(abt, clean_clientes_sql(sources["clientes"]), ["cliente_id"], "cliente_id", hot)
    granted = F.col("fecha_desembolso")
    age = {"antiguedad_cliente_dias": F.datediff(granted, "fecha_registro")} if clients else {}
    abt = abt.withColumns(
        {
            **age,
            "mes_desembolso": F.month(granted),
            "dia_semana_desembolso": weekday_monday1(granted),
        }
    )
    return abt.select([c for c in SQL_COLUMNS if c in abt.columns and c in wanted])


def base_table(sources: dict[str, DataFrame], mode: str = "py", settings: Settings = Settings()) -> DataFrame:
    """The base table in the dialect `mode`, "py" or "sql"."""
    if mode not in ("py", "sql"):
        raise ValueError(f"unknown dialect: {mode}")
    return abt_py(sources, settings=settings) if mode == "py" else abt_sql(sources, settings)


def create_abt_table(
    sources: dict[str, DataFrame], name: str, path: str | None = None, settings: Settings = Settings()
) -> None:
    """Create the SQL dialect's table in the catalog unless it exists; `path` makes it an external one."""
    spark = sources["creditos"].sparkSession
    if not spark.catalog.tableExists(name):
        writer = abt_sql(sources, settings).write.format("parquet")
        (writer.option("path", path) if path else writer).saveAsTable(name)
