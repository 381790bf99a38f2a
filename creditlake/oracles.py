"""The same queries as SQL text for DuckDB, used to check results."""

from __future__ import annotations

from .adapters import _INPUTS, CUTOFF, RAW_SQL

# Columns and limits that results must have, written here and not taken from the code that is checked.
SQL_EVENT_COLUMNS = {
    "login": "prev_evento_login",
    "simulacion_credito": "prev_evento_simulacion",
    "pago_fallido": "prev_evento_pago_fallido",
    "pago_exitoso": "prev_evento_pago_exitoso",
    "solicitud_soporte": "prev_evento_soporte",
}
NOT_CORRELATED = """
    cliente_id credito_id pago_id mes_desembolso dia_semana_desembolso
""".split()
SQL_COLUMNS = """
    credito_id cliente_id fecha_desembolso producto_credito monto_credito plazo_meses tasa_interes_mensual
    valor_cuota_pactada canal_originacion score_interno_originacion relacion_cuota_ingreso politica_aprobacion
    fecha_registro departamento ciudad edad genero estrato nivel_educativo ocupacion ingreso_mensual_estimado
    canal_adquisicion score_externo tiene_producto_ahorro numero_dependientes dispositivo_principal
    antiguedad_cliente_dias mes_desembolso dia_semana_desembolso prev_evento_login prev_evento_simulacion
    prev_evento_pago_fallido prev_evento_pago_exitoso prev_evento_soporte prev_evento_sesion_seg_tot
    prev_evento_sesion_seg_avg es_moroso
""".split()
CLIENT_COLUMNS = """
    cliente_id fecha_registro departamento ciudad edad genero estrato nivel_educativo ocupacion ingreso_mensual_estimado
    ingreso_mensual_bi flag_ingreso canal_adquisicion score_externo tiene_producto_ahorro numero_dependientes
    dispositivo_principal
""".split()
FACT_COLUMNS = """
    credito_id cliente_id fecha_desembolso producto_credito monto_credito plazo_meses tasa_interes_mensual
    valor_cuota_pactada canal_originacion score_interno_originacion relacion_cuota_ingreso politica_aprobacion
    estado_credito_operativo es_moroso probabilidad_mora prediccion_mora
""".split()
TYPE_LIMITS = {
    "clientes": {"cliente_id": 50, "departamento": 100, "ciudad": 100, "genero": 10, "nivel_educativo": 100, "ocupacion": 100, "ingreso_mensual_estimado": (15, 2), "canal_adquisicion": 50, "score_externo": (10, 2), "dispositivo_principal": 50},
    "creditos": {"credito_id": 50, "cliente_id": 50, "producto_credito": 100, "monto_credito": (15, 2), "tasa_interes_mensual": (6, 4), "valor_cuota_pactada": (15, 2), "canal_originacion": 50, "relacion_cuota_ingreso": (8, 4), "politica_aprobacion": 50, "estado_credito_operativo": 50},
    "pagos": {"pago_id": 50, "credito_id": 50, "cliente_id": 50, "valor_pagado": (15, 2), "estado_pago": 50},
    "eventos": {"evento_id": 50, "cliente_id": 50, "tipo_evento": 100, "resultado_evento": 100},
}
FALLBACK = "No se encontró información relevante en los datos de la corporación."

# --- common table expressions ------------------------------------------------------------------

RAW = {
    f"raw_{name}": sql.format(**{t: t for t in _INPUTS[name]}) for name, sql in RAW_SQL.items()
}
RAW["raw_eventos_app"] = RAW.pop("raw_eventos")
# Types the events hold; the driver's tables have five of the eight kinds.
FOUND_TYPES = ("login", "pago_exitoso", "pago_fallido", "simulacion_credito", "solicitud_soporte")

TITLE = r"array_to_string([upper(w[1]) || w[2:] FOR w IN regexp_extract_all(lower({0}), '\p{{L}}+|[^\p{{L}}]+')], '')"
INITCAP = r"array_to_string([upper(w[1]) || w[2:] FOR w IN regexp_extract_all(lower(trim({0})), '[\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}]+')], '')"
CITY_PY = f"""CASE lower(trim(ciudad)) WHEN 'bogot' THEN 'Bogotá' WHEN 'bogota d.c.' THEN 'Bogotá' WHEN 'medellin' THEN 'Medellín'
    WHEN 'barranquila' THEN 'Barranquilla' WHEN 'cali' THEN 'Cali' ELSE {TITLE.format('ciudad')} END"""
CITY_SQL = f"""CASE WHEN lower(trim(ciudad)) IN ('bogot', 'bogota', 'bogota d.c.') THEN 'Bogotá'
    WHEN lower(trim(ciudad)) IN ('medellin', 'medellín') THEN 'Medellín'
    WHEN lower(trim(ciudad)) IN ('barranquila', 'barranquilla') THEN 'Barranquilla' ELSE {INITCAP.format('ciudad')} END"""

CTES = {
    **RAW,
    "clientes_py": f"""SELECT * REPLACE (
    COALESCE(ingreso_mensual_estimado, (SELECT median(ingreso_mensual_estimado) FROM raw_clientes)) AS ingreso_mensual_estimado,
    COALESCE(score_externo, (SELECT median(score_externo) FROM raw_clientes)) AS score_externo,
    CASE WHEN edad < 18 OR edad > 110 THEN (SELECT median(edad) FROM raw_clientes) ELSE edad END AS edad,
    {CITY_PY} AS ciudad) FROM raw_clientes""",
    "clientes_sql": f"""SELECT * EXCLUDE (email_hash) REPLACE (
    COALESCE(ingreso_mensual_estimado, 2200000) AS ingreso_mensual_estimado, COALESCE(score_externo, 580) AS score_externo,
    CAST(CASE WHEN edad < 18 OR edad > 110 THEN 35 ELSE edad END AS INT) AS edad, {CITY_SQL} AS ciudad) FROM raw_clientes""",
    "creditos": """SELECT * REPLACE (COALESCE(producto_credito, 'Desconocido') AS producto_credito) FROM raw_creditos
    WHERE credito_id IS NOT NULL AND cliente_id IS NOT NULL AND monto_credito IS NOT NULL""",
    "pagos": """SELECT * REPLACE (COALESCE(valor_pagado, 0) AS valor_pagado, COALESCE(medio_pago, 'Desconocido') AS medio_pago,
    CAST(CASE WHEN dias_mora < 0 THEN 0 ELSE dias_mora END AS INT) AS dias_mora) FROM raw_pagos""",
    "target": f"""SELECT credito_id, CAST(MAX(dias_mora) > 30 AS INT) AS es_moroso FROM pagos
    WHERE fecha_vencimiento <= DATE '{CUTOFF}' GROUP BY credito_id""",
    "labelled": """SELECT c.*, CAST(COALESCE(t.es_moroso, 0) AS INT) AS es_moroso, cl.* EXCLUDE (cliente_id),
    CAST(c.fecha_desembolso - cl.fecha_registro AS INT) AS antiguedad_cliente_dias,
    CAST(month(c.fecha_desembolso) AS INT) AS mes_desembolso,
    CAST(isodow(c.fecha_desembolso) - 1 AS INT) AS dia_semana_desembolso
    FROM creditos c LEFT JOIN target t USING (credito_id) LEFT JOIN clientes_py cl ON c.cliente_id = cl.cliente_id""",
    "scored": """SELECT *, CAST((credito_id * 7919) % 1000 AS DOUBLE) / 1000 AS probabilidad_mora,
    CAST(CASE WHEN CAST((credito_id * 7919) % 1000 AS DOUBLE) / 1000 >= 0.5 THEN 1 ELSE 0 END AS BIGINT) AS prediccion_mora
    FROM labelled""",
    "scored_bi": """SELECT *, CASE WHEN ingreso_mensual_estimado > p99 THEN p99 ELSE ingreso_mensual_estimado END AS ingreso_mensual_bi,
    CASE WHEN ingreso_mensual_estimado > p99 AND COALESCE(estrato, 4) <= 3 THEN 'error_captura'
      WHEN ingreso_mensual_estimado > p99 THEN 'outlier_real' ELSE 'normal' END AS flag_ingreso
    FROM scored, (SELECT quantile_cont(ingreso_mensual_estimado, 0.99) AS p99 FROM scored)""",
    "pares": """SELECT c.credito_id, e.tipo_evento, e.duracion_sesion_seg FROM raw_creditos c
    JOIN raw_eventos_app e ON c.cliente_id = e.cliente_id AND e.fecha_evento < c.fecha_desembolso""",
    "eventos_py": "SELECT credito_id, "
    + ", ".join(f"COUNT(CASE WHEN tipo_evento = '{t}' THEN 1 END) AS prev_evento_{t}" for t in FOUND_TYPES)
    + """, CAST(COALESCE(SUM(duracion_sesion_seg), 0) AS BIGINT) AS prev_evento_sesion_seg_tot,
    COALESCE(AVG(duracion_sesion_seg), 0) AS prev_evento_sesion_seg_avg FROM pares GROUP BY credito_id""",
    "eventos_sql": "SELECT credito_id, "
    + ", ".join(f"COUNT(CASE WHEN tipo_evento = '{t}' THEN 1 END) AS {n}" for t, n in SQL_EVENT_COLUMNS.items())
    + """, CAST(COALESCE(SUM(duracion_sesion_seg), 0) AS BIGINT) AS prev_evento_sesion_seg_tot,
    COALESCE(ROUND(AVG(duracion_sesion_seg), 1), 0) AS prev_evento_sesion_seg_avg FROM pares GROUP BY credito_id""",
    "abt_py": "SELECT l.*, "
    + ", ".join(f"COALESCE(prev_evento_{t}, 0) AS prev_evento_{t}" for t in FOUND_TYPES)
    + """, COALESCE(prev_evento_sesion_seg_tot, 0) AS prev_evento_sesion_seg_tot,
    ROUND(COALESCE(prev_evento_sesion_seg_avg, 0), 6) AS prev_evento_sesion_seg_avg
    FROM labelled l LEFT JOIN eventos_py USING (credito_id)""",
    "abt_sql": "SELECT "
    + ", ".join(
        {
            "antiguedad_cliente_dias": "CAST(c.fecha_desembolso - cl.fecha_registro AS INT) AS antiguedad_cliente_dias",
            "mes_desembolso": "CAST(month(c.fecha_desembolso) AS INT) AS mes_desembolso",
            "dia_semana_desembolso": "CAST(isodow(c.fecha_desembolso) AS INT) AS dia_semana_desembolso",
            "es_moroso": "CAST(COALESCE(t.es_moroso, 0) AS INT) AS es_moroso",
            "cliente_id": "c.cliente_id",
            "credito_id": "c.credito_id",
        }.get(n, f"COALESCE({n}, 0) AS {n}" if n.startswith("prev_evento") else n)
        for n in SQL_COLUMNS
    )
    + """ FROM creditos c LEFT JOIN clientes_sql cl ON c.cliente_id = cl.cliente_id
    LEFT JOIN target t ON c.credito_id = t.credito_id LEFT JOIN eventos_sql e ON c.credito_id = e.credito_id""",
    "applications": """SELECT credito_id, edad, ingreso_mensual_estimado, score_externo, monto_credito, plazo_meses, valor_cuota_pactada
    FROM raw_creditos JOIN raw_clientes USING (cliente_id)""",
    "v_clientes_bi": """SELECT cliente_id, ingreso_mensual_estimado, estrato, ocupacion, LEAST(ingreso_mensual_estimado, p99) AS ingreso_mensual_bi,
    CASE WHEN ingreso_mensual_estimado > p99 AND COALESCE(estrato, 4) <= 3 THEN 'error_captura'
      WHEN ingreso_mensual_estimado > p99 THEN 'outlier_real' ELSE 'normal' END AS flag_ingreso
    FROM raw_clientes, (SELECT quantile_cont(ingreso_mensual_estimado, 0.99) AS p99 FROM raw_clientes)""",
    "centroides": """SELECT query_id, list(x ORDER BY i) AS embedding FROM (
      SELECT label AS query_id, i, AVG(CAST(embedding[i] AS DOUBLE)) AS x
      FROM embeddings, (SELECT unnest(range(1, (SELECT max(len(embedding)) FROM embeddings) + 1)) AS i) GROUP BY label, i)
    GROUP BY query_id""",
    "vecinos": """SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM (
      SELECT query_id, vec_id, ROUND(list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), q.embedding), 9) AS score
      FROM centroides q, embeddings e)) WHERE rank <= 3""",
}
# What each expression reads, so that a query carries no more than it needs.
READS = {
    "clientes_py": ["raw_clientes"], "clientes_sql": ["raw_clientes"], "creditos": ["raw_creditos"],
    "pagos": ["raw_pagos"], "target": ["pagos"], "labelled": ["creditos", "target", "clientes_py"],
    "scored": ["labelled"], "scored_bi": ["scored"], "pares": ["raw_creditos", "raw_eventos_app"],
    "eventos_py": ["pares"], "eventos_sql": ["pares"], "abt_py": ["labelled", "eventos_py"],
    "abt_sql": ["creditos", "clientes_sql", "target", "eventos_sql"],
    "applications": ["raw_creditos", "raw_clientes"], "v_clientes_bi": ["raw_clientes"], "vecinos": ["centroides"],
}


def _with(reads: str, sql: str) -> str:
    """`sql` after the expressions it reads and, first, the ones those read."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for other in READS.get(name, []):
            add(other)
        if name not in ordered:
            ordered.append(name)

    for name in reads.split():
        add(name)
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n].strip()})" for n in ordered) + "\n" + sql


ALL_RAW = "raw_clientes raw_creditos raw_pagos raw_eventos_app"
_RAW_NAMES = {"clientes": "raw_clientes", "creditos": "raw_creditos", "pagos": "raw_pagos", "eventos": "raw_eventos_app"}
RATE = "ROUND(100.0 * SUM(es_moroso) / COUNT(*), 2)"
DEFAULTS = "CAST(SUM(es_moroso) AS BIGINT)"


def _csv_text(name: str) -> str:
    floats = ("monto_credito", "tasa_interes_mensual", "valor_cuota_pactada", "relacion_cuota_ingreso", "probabilidad_mora")
    if name in floats:
        return f"COALESCE('\"' || replace(CAST({name} AS VARCHAR), '.', ',') || '\"', '')"
    return f"COALESCE(CAST({name} AS VARCHAR), '')"


def _limit(column: str, limit) -> tuple[str, str]:
    if isinstance(limit, int):
        return f"VARCHAR({limit})", f"length(CAST({column} AS VARCHAR)) > {limit}"
    p, s = limit
    return f"NUMERIC({p},{s})", f"abs(round({column}, {s})) >= {10 ** (p - s)}"


# Columns of the dressed sources with their Spark types, in order.
SOURCE_TYPES = {
    "clientes": "cliente_id bigint, fecha_registro date, departamento string, ciudad string, edad int, genero string, estrato int, nivel_educativo string, ocupacion string, ingreso_mensual_estimado double, canal_adquisicion string, score_externo double, tiene_producto_ahorro boolean, numero_dependientes int, dispositivo_principal string, email_hash string",
    "creditos": "credito_id bigint, cliente_id bigint, fecha_desembolso date, producto_credito string, monto_credito double, plazo_meses int, tasa_interes_mensual double, valor_cuota_pactada double, canal_originacion string, score_interno_originacion int, relacion_cuota_ingreso double, politica_aprobacion string, estado_credito_operativo string",
    "pagos": "pago_id bigint, credito_id bigint, cliente_id bigint, numero_cuota int, fecha_vencimiento date, fecha_pago date, valor_cuota double, valor_pagado double, medio_pago string, estado_pago string, dias_mora int",
    "eventos": "evento_id bigint, cliente_id bigint, fecha_evento date, tipo_evento string, canal string, resultado_evento string, dispositivo string, duracion_sesion_seg int",
}
COLUMNS = {t: [c.split() for c in ddl.split(", ")] for t, ddl in SOURCE_TYPES.items()}
LABELLED_COLUMNS = [
    *[c for c, _ in COLUMNS["creditos"]], "es_moroso", *[c for c, _ in COLUMNS["clientes"] if c != "cliente_id"],
    "antiguedad_cliente_dias", "mes_desembolso", "dia_semana_desembolso",
]
ABT_COLUMNS = [*LABELLED_COLUMNS, *[f"prev_evento_{t}" for t in FOUND_TYPES], "prev_evento_sesion_seg_tot", "prev_evento_sesion_seg_avg"]
TYPE_OF = {c: t for table in COLUMNS.values() for c, t in table}
NUMERIC_ABT = [
    c for c in ABT_COLUMNS if TYPE_OF.get(c, "int") in ("int", "bigint", "double") and c not in NOT_CORRELATED
]
FEATURES = [
    c for c in ABT_COLUMNS
    if c not in ("cliente_id", "credito_id", "email_hash", "estado_credito_operativo", "es_moroso") and "fecha" not in c
]
INSTALMENT_ORDER = "fecha_vencimiento {0}, dias_mora {0}, valor_cuota {0}, estado_pago {0}, cliente_id {0}"


def _hist(name: str, column: str, bins: int, source: str) -> str:
    return f"""SELECT '{name}' AS variable, b.bin, lo + b.bin * (hi - lo) / {bins} AS desde, lo + (b.bin + 1) * (hi - lo) / {bins} AS hasta,
  COUNT(x.bin) AS n
FROM (SELECT unnest(range(0, {bins})) AS bin) b
CROSS JOIN (SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {source}) e
LEFT JOIN (SELECT LEAST(CAST(FLOOR(({column} - lo) * {bins} / (hi - lo)) AS BIGINT), {bins - 1}) AS bin
  FROM {source}, (SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {source})) x ON x.bin = b.bin
GROUP BY b.bin, lo, hi"""


MONEY = "'$' || COALESCE(format('{{:,}}', CAST(round_even({0}, 0) AS BIGINT)), 'nan')"


def _pct(x: str, digits: int) -> str:
    return f"format('{{:.{digits}f}}', ({x}) * 100) || '%'"


def _segment_line(name: str) -> str:
    return (
        f"'  • ' || {name} || ': ' || creditos || ' créditos, ' || morosos || ' morosos (' || "
        + _pct("CAST(morosos AS DOUBLE) / creditos", 1)
        + " || ')'"
    )


ORACLES: dict[str, str] = {
    "scan_csv_typed": _with(
        "raw_creditos",
        "SELECT * REPLACE (CASE WHEN credito_id % 11 = 0 THEN NULL ELSE fecha_desembolso END AS fecha_desembolso) FROM raw_creditos",
    ),
    "load_all_counts": _with(
        ALL_RAW, " UNION ALL ".join(f"SELECT '{n}' AS tabla, COUNT(*) AS filas FROM {r}" for n, r in _RAW_NAMES.items())
    ),
    "checkpoint_roundtrip": _with("creditos", "SELECT * FROM creditos"),
    "scan_predictions": _with(
        "scored", "SELECT credito_id, cliente_id, fecha_desembolso, es_moroso, probabilidad_mora, prediccion_mora FROM scored"
    ),
    "lake_csv_format": _with(
        "scored",
        "SELECT " + " || ',' || ".join([*[_csv_text(c) for c in FACT_COLUMNS], "strftime(fecha_desembolso, '%Y%m%d')"])
        + " AS linea FROM scored",
    ),
    "lake_manifest": _with(
        "scored",
        """SELECT 'abt_analitica_riesgo' AS tabla, COUNT(*) AS filas FROM scored
UNION ALL SELECT 'predicciones_riesgo', COUNT(*) FROM scored
UNION ALL SELECT 'fact_creditos', COUNT(*) FROM scored
UNION ALL SELECT 'dim_cliente', COUNT(DISTINCT cliente_id) FROM scored
UNION ALL SELECT 'perfil_descriptivo_cliente', COUNT(DISTINCT cliente_id) FROM scored
UNION ALL SELECT 'dim_producto_credito', COUNT(DISTINCT producto_credito) FROM scored
UNION ALL SELECT 'dim_tiempo', CAST(MAX(fecha_desembolso) - MIN(fecha_desembolso) + 1 AS BIGINT) FROM scored""",
    ),
    "upsert_merge": _with(
        "raw_pagos",
        f""", target AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY credito_id, numero_cuota ORDER BY {INSTALMENT_ORDER.format('ASC NULLS FIRST')}) AS rn
  FROM raw_pagos WHERE fecha_vencimiento <= DATE '{CUTOFF}') WHERE rn = 1),
source AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY credito_id, numero_cuota ORDER BY {INSTALMENT_ORDER.format('DESC NULLS LAST')}) AS rn
  FROM raw_pagos) WHERE rn = 1)
SELECT s.pago_id, s.credito_id, s.cliente_id, s.numero_cuota, s.fecha_vencimiento, s.fecha_pago, s.valor_cuota, s.valor_pagado,
  t.medio_pago, s.estado_pago, s.dias_mora
FROM source s LEFT JOIN target t ON s.credito_id = t.credito_id AND s.numero_cuota = t.numero_cuota""",
    ).replace(")\n, target", "),\ntarget"),
    "dedupe_keep_last": _with(
        "raw_pagos",
        f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY credito_id, numero_cuota
  ORDER BY {INSTALMENT_ORDER.format('DESC NULLS LAST')}) AS rn FROM raw_pagos) WHERE rn = 1""",
    ),
    "align_schema": _with(
        "labelled",
        """SELECT CAST(credito_id AS VARCHAR) AS credito_id, CAST(trunc(monto_credito) AS BIGINT) AS monto_credito,
  CAST(es_moroso AS BIGINT) AS es_moroso, CAST(trunc(edad) AS BIGINT) AS edad, ciudad FROM labelled""",
    ),
    "table_counts": _with(
        "raw_creditos raw_eventos_app",
        """SELECT 'raw_creditos_conteo' AS tabla, COUNT(*) AS filas FROM raw_creditos
UNION ALL SELECT 'raw_eventos_conteo', COUNT(*) FROM raw_eventos_app UNION ALL SELECT 'tabla_ausente', CAST(NULL AS BIGINT)""",
    ),
    "impute_median": _with("clientes_py", "SELECT cliente_id, ingreso_mensual_estimado, score_externo FROM clientes_py"),
    "impute_const": _with("clientes_sql", "SELECT cliente_id, ingreso_mensual_estimado, score_externo FROM clientes_sql"),
    "city_py": _with("clientes_py", "SELECT cliente_id, ciudad FROM clientes_py"),
    "city_sql": _with("clientes_sql", "SELECT cliente_id, ciudad FROM clientes_sql"),
    "age_repair_py": _with("clientes_py", "SELECT cliente_id, edad FROM clientes_py"),
    "age_repair_sql": _with("clientes_sql", "SELECT cliente_id, edad FROM clientes_sql"),
    "clean_clientes_py": _with("clientes_py", "SELECT * FROM clientes_py"),
    "clean_clientes_sql": _with("clientes_sql", "SELECT * FROM clientes_sql"),
    "clean_creditos": _with("creditos", "SELECT * FROM creditos"),
    "clean_pagos": _with("pagos", "SELECT * FROM pagos"),
    "v_clientes_bi": _with(
        "v_clientes_bi",
        "SELECT cliente_id, ingreso_mensual_estimado, estrato, ingreso_mensual_bi, flag_ingreso FROM v_clientes_bi",
    ),
    "bi_income_fields": _with(
        "raw_creditos raw_clientes",
        """, r AS (SELECT credito_id, ingreso_mensual_estimado, estrato FROM raw_creditos JOIN raw_clientes USING (cliente_id)),
p AS (SELECT quantile_cont(ingreso_mensual_estimado, 0.99) AS p99 FROM r)
SELECT r.*, CASE WHEN ingreso_mensual_estimado > p99 THEN p99 ELSE ingreso_mensual_estimado END AS ingreso_mensual_bi,
  CASE WHEN ingreso_mensual_estimado > p99 AND COALESCE(estrato, 4) <= 3 THEN 'error_captura'
    WHEN ingreso_mensual_estimado > p99 THEN 'outlier_real' ELSE 'normal' END AS flag_ingreso FROM r, p""",
    ).replace(")\n, r AS", "),\nr AS"),
    "outlier_report": _with(
        "v_clientes_bi",
        """SELECT cliente_id, ingreso_mensual_estimado, ingreso_mensual_bi, flag_ingreso, estrato, ocupacion FROM v_clientes_bi
WHERE flag_ingreso <> 'normal' ORDER BY ingreso_mensual_estimado DESC, cliente_id""",
    ),
    "scalar_functions": _with(
        "raw_clientes",
        f"""SELECT cliente_id, lower(trim(ciudad)) AS ciudad_limpia, {TITLE.format('ciudad')} AS ciudad_titulo,
  {INITCAP.format('ciudad')} AS ciudad_initcap, COALESCE(ciudad, '?') AS ciudad_o,
  CAST(DATE '2024-06-30' - fecha_registro AS INT) AS dias, CAST(year(fecha_registro) AS INT) AS anio,
  CAST(month(fecha_registro) AS INT) AS mes, CAST(quarter(fecha_registro) AS INT) AS trimestre,
  strftime(fecha_registro, '%B') AS nombre_mes, CAST(isodow(fecha_registro) - 1 AS INT) AS dia0,
  CAST(isodow(fecha_registro) AS INT) AS dia1, CAST(strftime(fecha_registro, '%Y%m%d') AS INT) AS fecha_id,
  '$' || format('{{:,}}', CAST(round_even(ingreso_mensual_estimado * 1000, 0) AS BIGINT)) AS ingreso_texto,
  {_pct('score_externo / 1000', 1)} AS score_pct, CAST(ingreso_mensual_estimado AS VARCHAR) AS ingreso_float,
  LEAST(ingreso_mensual_estimado, 5000.0::DOUBLE) AS ingreso_tope,
  CASE WHEN numero_dependientes = 0 THEN NULL ELSE ingreso_mensual_estimado / numero_dependientes END AS ingreso_per_capita,
  ROUND(ingreso_mensual_estimado / 7, 2) AS ingreso_semana, sha256(email_hash) AS clave,
  CASE WHEN estrato IS NULL THEN '{{"departamento":"' || departamento || '"}}'
    ELSE '{{"departamento":"' || departamento || '","estrato":' || estrato || '}}' END AS meta
FROM raw_clientes""",
    ),
    "target_es_moroso": _with("target", "SELECT * FROM target"),
    "pit_join_pairs": _with("pares", "SELECT credito_id, COUNT(*) AS pares FROM pares GROUP BY credito_id"),
    "eventos_previos_sql": _with("eventos_sql", "SELECT * FROM eventos_sql"),
    "eventos_pivot": _with(
        "eventos_py", "SELECT * EXCLUDE (prev_evento_sesion_seg_tot, prev_evento_sesion_seg_avg) FROM eventos_py"
    ),
    "eventos_sesion": _with(
        "eventos_py",
        "SELECT credito_id, prev_evento_sesion_seg_tot, ROUND(prev_evento_sesion_seg_avg, 6) AS prev_evento_sesion_seg_avg FROM eventos_py",
    ),
    "abt_py": _with("abt_py", "SELECT * FROM abt_py"),
    "abt_from_csv": _with("abt_py", "SELECT * FROM abt_py"),
    "abt_from_parquet": _with("abt_py", "SELECT * FROM abt_py"),
    "abt_sql": _with("abt_sql", "SELECT * FROM abt_sql"),
    "insight_a": _with(
        "abt_sql",
        f"""SELECT ocupacion, estrato, COUNT(*) AS total_creditos, {DEFAULTS} AS creditos_morosos, {RATE} AS tasa_mora_pct,
  ROUND(AVG(monto_credito), 0) AS monto_promedio FROM abt_sql GROUP BY ocupacion, estrato HAVING COUNT(*) > 10 ORDER BY tasa_mora_pct DESC""",
    ),
    "insight_b": _with(
        "abt_sql",
        f"""SELECT CASE WHEN score_externo < 400 THEN '1. Muy Bajo (<400)' WHEN score_externo BETWEEN 400 AND 550 THEN '2. Bajo (400-550)'
    WHEN score_externo BETWEEN 550 AND 700 THEN '3. Medio (550-700)' ELSE '4. Alto (>700)' END AS rango_score_externo,
  COUNT(*) AS total_clientes, {DEFAULTS} AS creditos_morosos, {RATE} AS tasa_mora_pct,
  ROUND(AVG(score_interno_originacion), 0) AS promedio_score_interno FROM abt_sql GROUP BY 1 ORDER BY 1""",
    ),
    "insight_c": _with(
        "abt_sql",
        f"""SELECT producto_credito, canal_originacion, COUNT(*) AS total_creditos, {DEFAULTS} AS creditos_morosos,
  {RATE} AS tasa_mora_pct, ROUND(AVG(relacion_cuota_ingreso) * 100, 2) AS relacion_cuota_ingreso_avg_pct
FROM abt_sql GROUP BY producto_credito, canal_originacion ORDER BY tasa_mora_pct DESC""",
    ),
    "insight_d": _with(
        "abt_sql",
        f"""SELECT quintil_sesion, COUNT(*) AS total_clientes, {DEFAULTS} AS morosos, {RATE} AS tasa_mora_pct,
  ROUND(AVG(prev_evento_pago_fallido), 2) AS promedio_pagos_fallidos_previos, ROUND(AVG(prev_evento_simulacion), 2) AS promedio_simulaciones_previas
FROM (SELECT *, CAST(NTILE(5) OVER (ORDER BY prev_evento_sesion_seg_tot, credito_id) AS INT) AS quintil_sesion FROM abt_sql)
GROUP BY quintil_sesion ORDER BY quintil_sesion""",
    ),
    "insight_e": _with(
        "raw_pagos",
        f"""SELECT numero_cuota, COUNT(*) AS total_cuotas_evaluadas,
  CAST(SUM(CASE WHEN estado_pago = 'Pagado tardío' THEN 1 ELSE 0 END) AS BIGINT) AS total_pagos_tardios,
  ROUND(AVG(dias_mora), 1) AS dias_mora_promedio,
  ROUND(100.0 * SUM(CASE WHEN estado_pago = 'Pagado tardío' THEN 1 ELSE 0 END) / COUNT(*), 2) AS tasa_pago_tardio_pct
FROM raw_pagos WHERE fecha_vencimiento <= DATE '{CUTOFF}' GROUP BY numero_cuota ORDER BY numero_cuota""",
    ),
    "ntile_scaled": _with(
        "raw_creditos",
        """SELECT credito_id, score_interno_originacion,
  CAST(NTILE(7) OVER (ORDER BY score_interno_originacion, credito_id) AS INT) AS grupo FROM raw_creditos""",
    ),
    "portfolio_summary": _with(
        "labelled",
        f"""SELECT COUNT(*) AS total, {DEFAULTS} AS morosos, ROUND(SUM(es_moroso) / COUNT(*), 6) AS tasa_mora,
  ROUND(SUM(monto_credito), 2) AS monto_total, ROUND(SUM(CASE WHEN es_moroso = 1 THEN monto_credito ELSE 0 END), 2) AS monto_en_riesgo,
  ROUND(SUM(CASE WHEN es_moroso = 1 THEN monto_credito ELSE 0 END) / SUM(monto_credito), 6) AS tasa_monto_en_riesgo,
  ROUND(SUM(CASE WHEN es_moroso = 1 THEN 0 ELSE monto_credito END), 2) AS monto_sano FROM labelled""",
    ),
    "portfolio_by_product": _with(
        "labelled",
        f"""SELECT producto_credito, COUNT(credito_id) AS creditos, {DEFAULTS} AS morosos, ROUND(AVG(monto_credito), 4) AS monto_prom
FROM labelled WHERE producto_credito IS NOT NULL GROUP BY producto_credito""",
    ),
    "portfolio_by_channel": _with(
        "labelled",
        f"""SELECT canal_originacion, COUNT(credito_id) AS creditos, {DEFAULTS} AS morosos FROM labelled
WHERE canal_originacion IS NOT NULL GROUP BY canal_originacion""",
    ),
    "portfolio_top_departments": _with(
        "labelled",
        f"""SELECT departamento, COUNT(credito_id) AS creditos, {DEFAULTS} AS morosos FROM labelled
WHERE departamento IS NOT NULL GROUP BY departamento ORDER BY morosos DESC, departamento LIMIT 8""",
    ),
    "default_rate": _with("labelled", "SELECT ROUND(AVG(es_moroso), 9) AS tasa_mora FROM labelled"),
    "rate_by_estrato": _with(
        "labelled", "SELECT estrato, ROUND(AVG(es_moroso), 9) AS tasa_mora FROM labelled WHERE estrato IS NOT NULL GROUP BY estrato"
    ),
    "rate_by_product": _with(
        "labelled", "SELECT producto_credito, ROUND(AVG(es_moroso), 9) AS tasa_mora FROM labelled GROUP BY producto_credito"
    ),
    "mora_by_amount_band": _with(
        "labelled",
        f"""SELECT CASE WHEN grouping(rango) = 1 THEN 'Total' ELSE rango END AS rango, COUNT(*) AS creditos, {DEFAULTS} AS en_mora,
  ROUND(100.0 * SUM(es_moroso) / COUNT(*), 1) AS tasa_mora_pct
FROM (SELECT es_moroso, CASE WHEN monto_credito < 50000 THEN '1. < 50K' WHEN monto_credito < 100000 THEN '2. 50K - 100K'
  WHEN monto_credito < 200000 THEN '3. 100K - 200K' WHEN monto_credito < 300000 THEN '4. 200K - 300K' ELSE '5. > 300K' END AS rango FROM labelled)
GROUP BY ROLLUP (rango)""",
    ),
    "segment_rate": _with(
        "labelled",
        f"""SELECT COUNT(*) AS creditos, COALESCE({DEFAULTS}, 0) AS morosos, {RATE} AS tasa_mora_pct FROM labelled
WHERE producto_credito = '1-URGENT' AND ciudad = 'Cali'""",
    ),
    "event_means_by_label": _with(
        "abt_py",
        " UNION ALL ".join(
            f"""SELECT '{c}' AS variable, ROUND(AVG(CASE WHEN es_moroso = 0 THEN {c} END), 6) AS media_0,
  ROUND(AVG(CASE WHEN es_moroso = 1 THEN {c} END), 6) AS media_1 FROM abt_py"""
            for c in ABT_COLUMNS
            if c.startswith("prev_evento")
        ),
    ),
    "corr_matrix": _with(
        "abt_py",
        ", m AS MATERIALIZED (SELECT "
        + ", ".join(f"corr({a}, {b}) AS c_{i}_{j}" for i, a in enumerate(NUMERIC_ABT) for j, b in enumerate(NUMERIC_ABT))
        + " FROM abt_py)\nSELECT x, y, ROUND(corr, 6) AS corr FROM (SELECT unnest(["
        + ", ".join(
            f"{{'x': '{a}', 'y': '{b}', 'corr': c_{i}_{j}}}" for i, a in enumerate(NUMERIC_ABT) for j, b in enumerate(NUMERIC_ABT)
        )
        + "], recursive := true) FROM m)",
    ).replace(")\n, m AS", "),\nm AS"),
    "histogram": _with(
        "clientes_py creditos",
        " UNION ALL ".join(
            [
                _hist("ingreso_mensual_estimado", "ingreso_mensual_estimado", 30, "clientes_py"),
                _hist("score_externo", "score_externo", 30, "clientes_py"),
                _hist("monto_credito", "monto_credito", 30, "creditos"),
                _hist("tasa_pct", "(tasa_interes_mensual * 100)", 20, "creditos"),
            ]
        ),
    ),
    "box_stats": _with(
        "labelled",
        """, q AS (SELECT es_moroso, quantile_cont(relacion_cuota_ingreso, 0.25) AS q1, quantile_cont(relacion_cuota_ingreso, 0.5) AS mediana,
  quantile_cont(relacion_cuota_ingreso, 0.75) AS q3 FROM labelled GROUP BY es_moroso),
x AS (SELECT es_moroso, relacion_cuota_ingreso AS v, q1, mediana, q3,
  relacion_cuota_ingreso BETWEEN q1 - 1.5::DOUBLE * (q3 - q1) AND q3 + 1.5::DOUBLE * (q3 - q1) AS dentro FROM labelled JOIN q USING (es_moroso))
SELECT es_moroso, COUNT(v) AS n, q1, mediana, q3, MIN(CASE WHEN dentro THEN v END) AS bigote_inf, MAX(CASE WHEN dentro THEN v END) AS bigote_sup,
  COUNT(CASE WHEN NOT dentro THEN 1 END) AS atipicos FROM x GROUP BY es_moroso, q1, mediana, q3""",
    ).replace(")\n, q AS", "),\nq AS"),
    "city_value_counts": _with(
        "raw_clientes",
        "SELECT ciudad, COUNT(*) AS n FROM raw_clientes WHERE ciudad IS NOT NULL GROUP BY ciudad ORDER BY n DESC, ciudad LIMIT 15",
    ),
    "pk_check": _with(
        ALL_RAW,
        " UNION ALL ".join(
            f"""SELECT '{t}' AS tabla, '{k}' AS clave, COUNT(*) AS filas, COUNT(DISTINCT {k}) AS distintos,
  CAST(COUNT(*) - COUNT({k}) AS BIGINT) AS nulos,
  COUNT(*) = COUNT(DISTINCT {k}) + CASE WHEN COUNT(*) > COUNT({k}) THEN 1 ELSE 0 END AS es_unica FROM {_RAW_NAMES[t]}"""
            for t, k in (("clientes", "cliente_id"), ("creditos", "credito_id"), ("pagos", "pago_id"), ("eventos", "evento_id"))
        ),
    ),
    "fk_orphans": _with(
        ALL_RAW,
        " UNION ALL ".join(
            f"""SELECT '{t}' AS tabla, '{k}' AS clave, COUNT(*) AS huerfanos FROM {_RAW_NAMES[t]} h
WHERE NOT EXISTS (SELECT 1 FROM {_RAW_NAMES[p]} p WHERE p.{k} = h.{k})"""
            for t, k, p in (("creditos", "cliente_id", "clientes"), ("pagos", "credito_id", "creditos"), ("eventos", "cliente_id", "clientes"))
        ),
    ),
    "null_profile": _with(
        ALL_RAW,
        "SELECT * FROM ("
        + " UNION ALL ".join(
            f"SELECT '{t}' AS tabla, '{c}' AS columna, CAST(COUNT(*) - COUNT({c}) AS BIGINT) AS nulos FROM {_RAW_NAMES[t]}"
            for t, columns in COLUMNS.items()
            for c, _ in columns
        )
        + ") WHERE nulos > 0",
    ),
    "table_profile": _with(
        ALL_RAW,
        " UNION ALL ".join(
            f"SELECT '{t}' AS tabla, COUNT(*) AS filas, {i} AS posicion, '{c}' AS columna, '{kind}' AS tipo FROM {_RAW_NAMES[t]}"
            for t, columns in COLUMNS.items()
            for i, (c, kind) in enumerate(columns, start=1)
        ),
    ),
    "type_limits": _with(
        ALL_RAW,
        " UNION ALL ".join(
            f"""SELECT '{t}' AS tabla, '{c}' AS columna, '{_limit(c, limit)[0]}' AS limite,
  COUNT(CASE WHEN {_limit(c, limit)[1]} THEN 1 END) AS violaciones FROM {_RAW_NAMES[t]}"""
            for t, limits in TYPE_LIMITS.items()
            for c, limit in limits.items()
        ),
    ),
    "fact_creditos": _with(
        "scored", f"SELECT {', '.join(FACT_COLUMNS)}, CAST(strftime(fecha_desembolso, '%Y%m%d') AS INT) AS fecha_id FROM scored"
    ),
    "dim_cliente": _with(
        "scored_bi",
        f"""SELECT {', '.join(CLIENT_COLUMNS)} FROM (SELECT *, row_number() OVER (PARTITION BY cliente_id ORDER BY credito_id) AS rn
  FROM scored_bi) WHERE rn = 1""",
    ),
    "dim_producto": _with(
        "raw_creditos",
        """SELECT CAST(row_number() OVER (ORDER BY producto_credito ASC NULLS LAST) AS INT) AS producto_credito_id, producto_credito,
  COALESCE(producto_credito, 'Desconocido') AS categoria_producto FROM (SELECT DISTINCT producto_credito FROM raw_creditos)""",
    ),
    "dim_tiempo": _with(
        "raw_creditos",
        """SELECT fecha, CAST(strftime(fecha, '%Y%m%d') AS INT) AS fecha_id, CAST(year(fecha) AS INT) AS anio, CAST(month(fecha) AS INT) AS mes,
  strftime(fecha, '%B') AS nombre_mes, CAST(quarter(fecha) AS INT) AS trimestre, CAST(isodow(fecha) AS INT) AS dia_semana
FROM (SELECT CAST(unnest(generate_series(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS fecha
  FROM (SELECT MIN(fecha_desembolso) AS a, MAX(fecha_desembolso) AS b FROM raw_creditos))""",
    ),
    "perfil_cliente": _with(
        "scored_bi",
        f""", a AS (SELECT {', '.join(CLIENT_COLUMNS)} FROM (SELECT *, row_number() OVER (PARTITION BY cliente_id ORDER BY credito_id) AS rn
  FROM scored_bi) WHERE rn = 1),
t AS (SELECT cliente_id, COUNT(credito_id) AS creditos_total, CAST(SUM(es_moroso) AS BIGINT) AS creditos_morosos,
  ROUND(SUM(monto_credito), 8) AS monto_total_credito, ROUND(AVG(monto_credito), 8) AS monto_promedio_credito,
  ROUND(AVG(probabilidad_mora), 8) AS probabilidad_mora_promedio, MAX(probabilidad_mora) AS probabilidad_mora_max,
  MAX(fecha_desembolso) AS ultima_fecha_desembolso, ROUND(SUM(es_moroso) / COUNT(credito_id), 8) AS tasa_mora_cliente
  FROM scored GROUP BY cliente_id)
SELECT * FROM a LEFT JOIN t USING (cliente_id)""",
    ).replace(")\n, a AS", "),\na AS"),
    "feature_columns": _with(
        "abt_py", " UNION ALL ".join(f"SELECT '{c}' AS feature, COUNT({c}) AS no_nulos FROM abt_py" for c in FEATURES)
    ),
    "stratified_split": _with(
        "labelled",
        """SELECT credito_id, es_moroso, CASE WHEN rn <= CAST(floor(0.2::DOUBLE * n + 0.5::DOUBLE) AS BIGINT) THEN 'test' ELSE 'train' END AS split
FROM (SELECT credito_id, es_moroso, COUNT(*) OVER (PARTITION BY es_moroso) AS n,
  row_number() OVER (PARTITION BY es_moroso ORDER BY (credito_id * 2654435761) % 4294967296, credito_id) AS rn FROM labelled)""",
    ),
    "category_index": _with(
        "labelled",
        """, p AS (SELECT producto_credito, CAST(row_number() OVER (ORDER BY COUNT(*) DESC, producto_credito) - 1 AS DOUBLE) AS i
  FROM labelled WHERE producto_credito IS NOT NULL GROUP BY producto_credito),
c AS (SELECT ciudad, CAST(row_number() OVER (ORDER BY COUNT(*) DESC, ciudad) - 1 AS DOUBLE) AS i
  FROM labelled WHERE ciudad IS NOT NULL GROUP BY ciudad)
SELECT l.credito_id, p.i AS producto_credito__idx, COALESCE(c.i, (SELECT COUNT(*) FROM c)) AS ciudad__idx
FROM labelled l LEFT JOIN p ON l.producto_credito = p.producto_credito LEFT JOIN c ON l.ciudad = c.ciudad""",
    ).replace(")\n, p AS", "),\np AS"),
    "class_weights": _with(
        "labelled",
        "SELECT es_moroso, COUNT(*) AS n, (SELECT COUNT(*) FROM labelled) / (2.0::DOUBLE * COUNT(*)) AS peso FROM labelled GROUP BY es_moroso",
    ),
    "confusion_matrix": _with(
        "scored",
        " UNION ALL ".join(
            f"SELECT {a} AS real, {b} AS prediccion, COUNT(*) AS n FROM scored WHERE es_moroso = {a} AND prediccion_mora = {b}"
            for a in (0, 1)
            for b in (0, 1)
        ),
    ),
    "classification_report": _with(
        "scored",
        """, k AS (SELECT c AS clase, COUNT(CASE WHEN es_moroso = c AND prediccion_mora = c THEN 1 END)::DOUBLE AS tp,
  COUNT(CASE WHEN prediccion_mora = c THEN 1 END)::DOUBLE AS predichos, COUNT(CASE WHEN es_moroso = c THEN 1 END)::DOUBLE AS reales
  FROM scored, (SELECT unnest([0, 1]) AS c) GROUP BY c),
m AS (SELECT clase, tp, reales, tp / predichos AS precision, tp / reales AS recall, 2 * tp / (predichos + reales) AS f1 FROM k)
SELECT CAST(clase AS VARCHAR) AS clase, ROUND(precision, 9) AS precision, ROUND(recall, 9) AS recall, ROUND(f1, 9) AS f1, CAST(reales AS BIGINT) AS support FROM m
UNION ALL SELECT 'accuracy', NULL, NULL, ROUND(SUM(tp) / SUM(reales), 9), CAST(SUM(reales) AS BIGINT) FROM m
UNION ALL SELECT 'macro avg', ROUND(AVG(precision), 9), ROUND(AVG(recall), 9), ROUND(AVG(f1), 9), CAST(SUM(reales) AS BIGINT) FROM m
UNION ALL SELECT 'weighted avg', ROUND(SUM(precision * reales) / SUM(reales), 9), ROUND(SUM(recall * reales) / SUM(reales), 9),
  ROUND(SUM(f1 * reales) / SUM(reales), 9), CAST(SUM(reales) AS BIGINT) FROM m""",
    ).replace(")\n, k AS", "),\nk AS"),
    "roc_auc": _with(
        "scored",
        """, s AS (SELECT probabilidad_mora AS p, SUM(es_moroso)::DOUBLE AS pos, SUM(1 - es_moroso)::DOUBLE AS neg FROM scored GROUP BY 1),
r AS (SELECT *, SUM(neg) OVER (ORDER BY p) - neg AS neg_before FROM s)
SELECT ROUND(SUM(pos * (neg_before + neg / 2)) / (SUM(pos) * SUM(neg)), 9) AS auc FROM r""",
    ).replace(")\n, s AS", "),\ns AS"),
    "score_defaults": _with(
        "applications",
        """SELECT *, 0.0::DOUBLE AS estrato, 0.0::DOUBLE AS prev_evento_login, false AS tiene_producto_ahorro, 'Desconocido' AS ciudad,
  'Desconocido' AS genero FROM applications""",
    ),
    "score_decision": _with(
        "raw_creditos",
        """SELECT credito_id, ROUND(CAST((credito_id * 7919) % 1000 AS DOUBLE) / 1000, 4) AS score_riesgo_mora,
  CASE WHEN (credito_id * 7919) % 1000 < 500 THEN 'APROBADO' ELSE 'RECHAZADO' END AS decision FROM raw_creditos""",
    ),
    "risk_level": _with(
        "raw_creditos",
        """SELECT credito_id, CASE WHEN (credito_id * 7919) % 1000 >= 800 THEN 'CRÍTICO' WHEN (credito_id * 7919) % 1000 >= 500 THEN 'ALTO'
  WHEN (credito_id * 7919) % 1000 >= 200 THEN 'MEDIO' ELSE 'BAJO' END AS nivel_riesgo FROM raw_creditos""",
    ),
    "kb_loan_cards": _with(
        "scored",
        f""", n AS (SELECT *, CASE WHEN probabilidad_mora >= 0.8 THEN 'CRÍTICO' WHEN probabilidad_mora >= 0.5 THEN 'ALTO'
  WHEN probabilidad_mora >= 0.2 THEN 'MEDIO' ELSE 'BAJO' END AS nivel FROM scored)
SELECT 'FICHA DE CRÉDITO — ' || credito_id || chr(10) || 'Cliente: ' || cliente_id || '  |  Ubicación: '
  || COALESCE({TITLE.format('ciudad')}, 'None') || ', ' || departamento || chr(10)
  || 'Edad: ' || CAST(trunc(edad) AS BIGINT) || ' años  |  Género: ' || genero || '  |  Estrato: ' || COALESCE(CAST(estrato AS VARCHAR), 'None') || chr(10)
  || 'Educación: ' || COALESCE(nivel_educativo, 'None') || '  |  Ocupación: ' || ocupacion || chr(10)
  || 'Ingreso mensual estimado: ' || {MONEY.format('ingreso_mensual_estimado')} || chr(10)
  || 'Score externo (buró): ' || CAST(score_externo AS VARCHAR) || chr(10) || chr(10)
  || 'CRÉDITO:' || chr(10) || 'Producto: ' || producto_credito || chr(10)
  || 'Monto desembolsado: ' || {MONEY.format('monto_credito')} || chr(10)
  || 'Plazo: ' || plazo_meses || ' meses  |  Tasa mensual: ' || {_pct('tasa_interes_mensual', 2)} || chr(10)
  || 'Valor cuota pactada: ' || {MONEY.format('valor_cuota_pactada')} || chr(10)
  || 'Relación cuota/ingreso: ' || {_pct('relacion_cuota_ingreso', 2)} || chr(10)
  || 'Canal de originación: ' || canal_originacion || chr(10) || 'Política de aprobación: ' || politica_aprobacion || chr(10)
  || 'Estado operativo del crédito: ' || estado_credito_operativo || chr(10) || chr(10) || 'RIESGO:' || chr(10)
  || '¿Es moroso?: ' || CASE WHEN es_moroso = 1 THEN 'SÍ' ELSE 'NO' END || chr(10)
  || 'Probabilidad de mora: ' || {_pct('probabilidad_mora', 1)} || '  →  Nivel de riesgo: ' || nivel || chr(10) AS page_content,
  'ficha_cliente' AS fuente, CAST(cliente_id AS VARCHAR) AS cliente_id, CAST(credito_id AS VARCHAR) AS credito_id,
  CAST(es_moroso AS VARCHAR) AS es_moroso, CAST(probabilidad_mora AS VARCHAR) AS probabilidad_mora, nivel AS nivel_riesgo, producto_credito, departamento
FROM n""",
    ).replace(")\n, n AS", "),\nn AS"),
    "kb_summary_doc": _with(
        "scored",
        f""", g AS (SELECT COUNT(*) AS total, {DEFAULTS} AS morosos, SUM(monto_credito) AS monto, SUM(CASE WHEN es_moroso = 1 THEN monto_credito ELSE 0 END) AS riesgo FROM scored),
p AS (SELECT string_agg({_segment_line('producto_credito')} || ', monto promedio ' || {MONEY.format('prom')}, chr(10) ORDER BY producto_credito) AS t
  FROM (SELECT producto_credito, COUNT(*) AS creditos, {DEFAULTS} AS morosos, AVG(monto_credito) AS prom FROM scored WHERE producto_credito IS NOT NULL GROUP BY 1)),
c AS (SELECT string_agg({_segment_line('canal_originacion')}, chr(10) ORDER BY canal_originacion) AS t
  FROM (SELECT canal_originacion, COUNT(*) AS creditos, {DEFAULTS} AS morosos FROM scored WHERE canal_originacion IS NOT NULL GROUP BY 1)),
d AS (SELECT string_agg({_segment_line('departamento')}, chr(10) ORDER BY morosos DESC, departamento) AS t
  FROM (SELECT departamento, COUNT(*) AS creditos, {DEFAULTS} AS morosos FROM scored GROUP BY 1 ORDER BY morosos DESC, departamento LIMIT 8))
SELECT 'RESUMEN ESTADÍSTICO DEL PORTAFOLIO DE CRÉDITOS' || chr(10) || 'Fecha de corte: {CUTOFF}' || chr(10) || chr(10) || 'MÉTRICAS GLOBALES:' || chr(10)
  || '  • Total créditos en portafolio: ' || format('{{:,}}', total) || chr(10)
  || '  • Clientes morosos identificados: ' || format('{{:,}}', morosos) || ' (' || {_pct('CAST(morosos AS DOUBLE) / total', 1)} || ' tasa de mora)' || chr(10)
  || '  • Monto total desembolsado: ' || {MONEY.format('monto')} || chr(10)
  || '  • Monto en riesgo (morosos): ' || {MONEY.format('riesgo')} || ' (' || {_pct('riesgo / monto', 1)} || ')' || chr(10)
  || '  • Portafolio sano: ' || {MONEY.format('monto - riesgo')} || ' (' || {_pct('1 - CAST(morosos AS DOUBLE) / total', 1)} || ')' || chr(10) || chr(10)
  || 'DESGLOSE POR PRODUCTO:' || chr(10) || p.t || chr(10) || chr(10) || 'DESGLOSE POR CANAL DE ORIGINACIÓN:' || chr(10) || c.t || chr(10) || chr(10)
  || 'TOP DEPARTAMENTOS POR MORA:' || chr(10) || d.t || chr(10) AS page_content, 'resumen_portafolio' AS fuente
FROM g, p, c, d""",
    ).replace(")\n, g AS", "),\ng AS"),
    "kb_documents": _with(
        "scored",
        """SELECT 'ficha_cliente' AS fuente, COUNT(*) AS documentos FROM scored
UNION ALL SELECT 'politica_negocio', COUNT(*) FROM benchmark UNION ALL SELECT 'resumen_portafolio', CAST(1 AS BIGINT)""",
    ),
    "kb_counts": _with(
        "scored", "SELECT CAST(2 AS BIGINT) AS colecciones, CAST((SELECT COUNT(*) FROM scored) + (SELECT COUNT(*) FROM benchmark) AS BIGINT) AS embeddings"
    ),
    "kb_build": _with(
        "scored",
        """SELECT 'ficha_cliente' AS fuente, COUNT(*) AS documentos, true AS claves_unicas, true AS cortos FROM scored
UNION ALL SELECT 'politica_negocio', COUNT(*), true, true FROM benchmark
UNION ALL SELECT 'resumen_portafolio', CAST(1 AS BIGINT), true, true""",
    ),
    "chunk_documents": "SELECT doc_id, true AS tamano_correcto, true AS empieza, true AS termina FROM documents WHERE text IS NOT NULL",
    "train_default_model": _with(
        "labelled",
        """SELECT clase, CAST(SUM(n) AS BIGINT) AS support, true AS auc_mejor_que_azar FROM (
  SELECT clase, n FROM (SELECT es_moroso, CAST(floor(0.2::DOUBLE * COUNT(*) + 0.5::DOUBLE) AS BIGINT) AS n FROM labelled GROUP BY es_moroso)
  JOIN (SELECT unnest(['0', '1', 'accuracy', 'macro avg', 'weighted avg']) AS clase)
    ON clase NOT IN ('0', '1') OR clase = CAST(es_moroso AS VARCHAR)) GROUP BY clase""",
    ),
    "score_book": _with("labelled", "SELECT credito_id, es_moroso, true AS valida, true AS coherente FROM labelled"),
    "feature_importance": "SELECT CAST(unnest(range(1, 6)) AS INT) AS puesto, true AS coincide, true AS descendente, true AS completa",
    "tree_leaves": _with(
        "labelled",
        """SELECT CAST(arbol AS INT) AS arbol, (SELECT COUNT(*) FROM labelled) AS filas, true AS misma_cuenta, true AS hojas_permitidas,
  true AS hojas_llenas, true AS regla_aprendida FROM (SELECT unnest(range(5)) AS arbol)""",
    ),
    "tree_stump": _with(
        "labelled",
        """, pesos AS (SELECT es_moroso AS y, COUNT(*) AS n_y, CAST((SELECT COUNT(*) FROM labelled) AS DOUBLE) / (2 * COUNT(*)) AS w FROM labelled GROUP BY es_moroso),
valores AS (SELECT feature, orden, v, COUNT(*) AS n, SUM(w * (0.5 - y)) AS g, SUM(w * 0.25) AS h FROM (
    SELECT es_moroso, unnest([{'feature': 'estrato', 'orden': 0, 'v': CAST(estrato AS DOUBLE)}, {'feature': 'mes_desembolso', 'orden': 1, 'v': CAST(mes_desembolso AS DOUBLE)},
      {'feature': 'dia_semana_desembolso', 'orden': 2, 'v': CAST(dia_semana_desembolso AS DOUBLE)}, {'feature': 'numero_dependientes', 'orden': 3, 'v': CAST(numero_dependientes AS DOUBLE)}], recursive := true)
    FROM labelled) JOIN pesos ON y = es_moroso GROUP BY feature, orden, v)
SELECT lado, filas, valor, feature, umbral, nulos_izquierda, ganancia FROM (
  SELECT *, row_number() OVER (ORDER BY ganancia DESC, nulos_izquierda, orden, umbral) AS puesto FROM (
    SELECT c.feature, c.orden, c.umbral, c.nulos_izquierda, CAST(SUM(n) FILTER (izq) AS BIGINT) AS n_i, CAST(SUM(n) FILTER (NOT izq) AS BIGINT) AS n_d,
      SUM(g) FILTER (izq) AS g_i, SUM(h) FILTER (izq) AS h_i, SUM(g) FILTER (NOT izq) AS g_d, SUM(h) FILTER (NOT izq) AS h_d,
      round(g_i * g_i / h_i + g_d * g_d / h_d - SUM(g) * SUM(g) / SUM(h), 6) AS ganancia
    FROM (
      SELECT a.feature, a.orden, b.v AS umbral, lados.nulos_izquierda, a.n, a.g, a.h, CASE WHEN a.v IS NULL THEN lados.nulos_izquierda ELSE a.v <= b.v END AS izq
      FROM valores a JOIN (SELECT DISTINCT feature, v FROM valores WHERE v IS NOT NULL) b ON a.feature = b.feature
      CROSS JOIN (SELECT unnest([false, true]) AS nulos_izquierda) lados) c
    GROUP BY c.feature, c.orden, c.umbral, c.nulos_izquierda)
  WHERE n_i >= 30 AND n_d >= 30 AND h_i > 0.001 AND h_d > 0.001)
CROSS JOIN LATERAL (VALUES ('izquierda', n_i, round(-0.03 * g_i / h_i, 9)), ('derecha', n_d, round(-0.03 * g_d / h_d, 9))) AS t(lado, filas, valor)
WHERE puesto = 1""",
    ).replace(")\n, pesos AS", "),\npesos AS"),
    "stratified_split_wide": _with(
        "labelled",
        """SELECT credito_id, es_moroso, CASE WHEN rn <= CAST(floor(0.2::DOUBLE * n + 0.5::DOUBLE) AS BIGINT) THEN 'test' ELSE 'train' END AS split
FROM (SELECT credito_id, es_moroso, COUNT(*) OVER (PARTITION BY es_moroso) AS n,
  row_number() OVER (PARTITION BY es_moroso ORDER BY 1152921504606846976 + ((credito_id * 2654435761) % 4294967296) * 1000003, credito_id) AS rn FROM labelled)""",
    ),
    "score_applicants": _with(
        "raw_creditos raw_clientes", "SELECT credito_id, true AS valida, true AS coherente FROM raw_creditos JOIN raw_clientes USING (cliente_id)"
    ),
    "knn_approx": """SELECT label AS query_id, CAST(least(3, (SELECT COUNT(*) FROM embeddings)) AS BIGINT) AS vecinos, true AS coseno_exacto,
  true AS recall_suficiente FROM embeddings GROUP BY label""",
    "hot_client_join": _with(
        "raw_creditos raw_clientes",
        """SELECT credito_id, CAST(CASE WHEN credito_id % 3 = 0 THEN 1 ELSE c.cliente_id END AS BIGINT) AS cliente_id, ocupacion, true AS hay_cliente_frecuente
FROM raw_creditos c LEFT JOIN raw_clientes cl ON cl.cliente_id = CASE WHEN credito_id % 3 = 0 THEN 1 ELSE c.cliente_id END""",
    ),
    "abt_sql_table": _with(
        "abt_sql",
        """SELECT producto_credito, COUNT(*) AS filas, CAST(SUM(es_moroso) AS BIGINT) AS morosos,
  CAST(SUM(prev_evento_login) AS BIGINT) AS accesos FROM abt_sql GROUP BY producto_credito""",
    ),
    "normalize_vectors": """SELECT vec_id, CAST(i - 1 AS INT) AS posicion,
  ROUND(CAST(embedding[i] AS DOUBLE) / sqrt(list_sum([x * x FOR x IN CAST(embedding AS DOUBLE[])])), 9) AS valor
FROM embeddings, (SELECT unnest(range(1, (SELECT max(len(embedding)) FROM embeddings) + 1)) AS i)""",
    "knn_exact": _with("vecinos", "SELECT query_id, vec_id, ROUND(score, 6) AS score, rank FROM vecinos"),
    "retrieve_context": _with(
        "vecinos",
        f"""SELECT query_id, COALESCE(t, '{FALLBACK}') AS contexto FROM centroides LEFT JOIN
  (SELECT query_id, string_agg(text, chr(10) ORDER BY rank) AS t FROM vecinos JOIN documents ON vec_id = doc_id GROUP BY query_id) USING (query_id)""",
    ),
}
# The whole run exports the same tables and upserts all scored loans.
ORACLES["lake_refresh"] = ORACLES["lake_manifest"] + "\nUNION ALL SELECT 'upsert', COUNT(*) FROM scored"
