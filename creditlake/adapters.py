"""The given TPC-H-like tables dressed as the four credit sources.

The texts are plain SQL that Spark and DuckDB both run; `{table}` marks an input table. Dates move
by 9131 days so that loans overlap the events, and key arithmetic puts in the nulls and dirt that
the given tables lack.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .settings import Settings

CUTOFF = "2024-06-30"
TEST_SETTINGS = Settings(cutoff_date=CUTOFF)

RAW_SQL = {
    "clientes": """
SELECT c_custkey AS cliente_id,
  CAST(DATE '2018-01-01' + CAST(c_custkey % 700 AS INT) AS DATE) AS fecha_registro,
  n_name AS departamento,
  CASE CAST(c_custkey % 9 AS INT) WHEN 0 THEN 'bogot' WHEN 1 THEN ' Bogota D.C.' WHEN 2 THEN 'medellin '
    WHEN 3 THEN 'BARRANQUILA' WHEN 4 THEN 'cali' WHEN 5 THEN 'santa marta' WHEN 6 THEN 'puerto-lopez'
    WHEN 7 THEN NULL ELSE 'villa 2da etapa' END AS ciudad,
  CAST(CASE WHEN c_custkey % 101 = 0 THEN 7 WHEN c_custkey % 103 = 0 THEN 130 ELSE 18 + c_custkey % 60 END AS INT) AS edad,
  CASE CAST(c_custkey % 3 AS INT) WHEN 0 THEN 'F' WHEN 1 THEN 'M' ELSE 'Otro' END AS genero,
  CAST(CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE 1 + c_custkey % 6 END AS INT) AS estrato,
  CASE CAST(c_custkey % 4 AS INT) WHEN 0 THEN 'Bachiller' WHEN 1 THEN 'Técnico' WHEN 2 THEN 'Universitario'
    ELSE NULL END AS nivel_educativo,
  c_mktsegment AS ocupacion,
  CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE CAST(c_acctbal + 1000 AS DOUBLE) END AS ingreso_mensual_estimado,
  CASE CAST(c_custkey % 2 AS INT) WHEN 0 THEN 'web' ELSE 'referido' END AS canal_adquisicion,
  CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE CAST(300 + c_custkey % 551 AS DOUBLE) END AS score_externo,
  c_custkey % 5 < 2 AS tiene_producto_ahorro,
  CAST(c_custkey % 5 AS INT) AS numero_dependientes,
  CASE CAST(c_custkey % 3 AS INT) WHEN 0 THEN 'iOS' ELSE 'Android' END AS dispositivo_principal,
  concat('h', CAST(c_custkey AS VARCHAR(20))) AS email_hash
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey""",
    "creditos": """
SELECT o_orderkey AS credito_id, CASE WHEN o_orderkey % 997 = 0 THEN NULL ELSE o_custkey END AS cliente_id,
  CAST(CAST(o_orderdate AS DATE) + 9131 AS DATE) AS fecha_desembolso,
  CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE o_orderpriority END AS producto_credito,
  o_totalprice AS monto_credito,
  CAST(6 + o_orderkey % 43 AS INT) AS plazo_meses,
  CAST(100 + o_orderkey % 250 AS DOUBLE) / 10000 AS tasa_interes_mensual,
  CAST(FLOOR(o_totalprice / (6 + o_orderkey % 43)) AS DOUBLE) AS valor_cuota_pactada,
  o_orderstatus AS canal_originacion,
  CAST(400 + o_orderkey % 400 AS INT) AS score_interno_originacion,
  CAST(o_orderkey % 60 AS DOUBLE) / 100 AS relacion_cuota_ingreso,
  CASE CAST(o_orderkey % 3 AS INT) WHEN 0 THEN 'Automática' WHEN 1 THEN 'Manual' ELSE 'Excepción' END AS politica_aprobacion,
  CASE CAST(o_orderkey % 4 AS INT) WHEN 0 THEN 'Castigado' WHEN 1 THEN 'Pagado' ELSE 'Vigente' END AS estado_credito_operativo
FROM {orders}""",
    "pagos": """
SELECT l_orderkey * 10 + l_linenumber AS pago_id, l_orderkey AS credito_id, l_suppkey AS cliente_id,
  l_linenumber AS numero_cuota,
  CAST(CAST(l_shipdate AS DATE) + 9131 AS DATE) AS fecha_vencimiento,
  CASE WHEN l_returnflag = 'R' THEN NULL
    ELSE CAST(CAST(l_shipdate AS DATE) + 9121 + CAST(l_quantity AS INT) AS DATE) END AS fecha_pago,
  l_extendedprice AS valor_cuota,
  CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_extendedprice END AS valor_pagado,
  CASE CAST(l_linenumber % 4 AS INT) WHEN 0 THEN 'PSE' WHEN 1 THEN 'Efectivo' WHEN 2 THEN 'Tarjeta' ELSE NULL END AS medio_pago,
  CASE l_returnflag WHEN 'A' THEN 'Pagado tardío' WHEN 'N' THEN 'Pagado' ELSE 'Vencido' END AS estado_pago,
  CAST(l_quantity AS INT) - 10 AS dias_mora
FROM {lineitem}""",
    "eventos": """
SELECT event_id AS evento_id, user_id AS cliente_id, CAST(ts AS DATE) AS fecha_evento,
  CASE event_type WHEN 'click' THEN 'login' WHEN 'view' THEN 'simulacion_credito' WHEN 'error' THEN 'pago_fallido'
    WHEN 'purchase' THEN 'pago_exitoso' ELSE 'solicitud_soporte' END AS tipo_evento,
  CASE CAST(event_id % 2 AS INT) WHEN 0 THEN 'app' ELSE 'web' END AS canal,
  CASE WHEN event_type = 'error' THEN 'fallido' ELSE 'ok' END AS resultado_evento,
  CASE CAST(event_id % 3 AS INT) WHEN 0 THEN 'iOS' ELSE 'Android' END AS dispositivo,
  CAST(FLOOR(value) AS INT) AS duracion_sesion_seg
FROM {events}""",
}
_INPUTS = {"clientes": ("customer", "nation"), "creditos": ("orders",), "pagos": ("lineitem",), "eventos": ("events",)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One credit source over the given tables."""
    return spark.sql(RAW_SQL[name], **{t: table(spark, sf_dir, t) for t in _INPUTS[name]})


def sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: source(spark, sf_dir, name) for name in RAW_SQL}


def with_stand_in_score(abt: DataFrame) -> DataFrame:
    """A reproducible score in place of a model's, so that results can be compared exactly."""
    p = ((F.col("credito_id") * 7919) % 1000).cast("double") / 1000
    return abt.withColumn("probabilidad_mora", p).withColumn("prediccion_mora", (p >= 0.5).cast("bigint"))
