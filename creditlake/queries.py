"""Every operator as a query over the given tables: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import adapters
from .adapters import CUTOFF, TEST_SETTINGS, sources, table, with_stand_in_score
from .functions import dates, numbers, text
from .operators import boosting, chunks, clean, dedupe, metrics, prior_events, profile, quality, ranks, reports, skew, vectors
from .operators.target import default_label
from .plans import abt as abt_plan
from .plans import knowledge, model, refresh, star
from .settings import scratch_path, ship_package, stage
from .sources import bi_export, readers, upsert
from .sources.schemas import EVENT_TYPES, PREDICTION_COLUMNS, SOURCE_FILES

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return f(spark, sf_dir)

    QUERIES[f.__name__] = run
    return f


def _source(name: str) -> Query:
    return lambda spark, sf_dir: adapters.source(spark, sf_dir, name)


clientes, creditos, pagos, eventos = (_source(n) for n in ("clientes", "creditos", "pagos", "eventos"))


def _abt(spark, sf_dir) -> DataFrame:
    return abt_plan.abt_py(sources(spark, sf_dir), settings=TEST_SETTINGS)


def _abt_sql(spark, sf_dir, columns=None) -> DataFrame:
    return abt_plan.abt_sql(sources(spark, sf_dir), TEST_SETTINGS, columns)


def _labelled(spark, sf_dir) -> DataFrame:
    """Cleaned loans with label and client attributes, without the event features."""
    s = sources(spark, sf_dir)
    return abt_plan.build_abt(
        clean.clean_clientes_py(s["clientes"]), clean.clean_creditos(s["creditos"]), clean.clean_pagos(s["pagos"]),
        settings=TEST_SETTINGS,
    )


def _loans_with_clients(spark, sf_dir) -> DataFrame:
    s = sources(spark, sf_dir)
    hot = skew.hot_weights(s["creditos"], "cliente_id")
    return skew.lookup_join(s["creditos"], s["clientes"], ["cliente_id"], "cliente_id", hot, "inner")


def _scored(spark, sf_dir) -> DataFrame:
    return with_stand_in_score(_labelled(spark, sf_dir))


def _label_centroids(spark, sf_dir) -> DataFrame:
    """One query vector per label: the mean of all its embeddings."""
    e = table(spark, sf_dir, "embeddings")
    mean = Summarizer.mean(array_to_vector(F.col("embedding").cast("array<double>")))
    return e.groupBy("label").agg(vector_to_array(mean).alias("embedding")).withColumnRenamed("label", "query_id")


# --- scans and sinks ---------------------------------------------------------------------------


@query
def scan_csv_typed(spark, sf_dir):
    path = scratch_path(spark, "creditos.csv")
    text_date = F.when(F.col("credito_id") % 11 == 0, "sin fecha").otherwise(F.col("fecha_desembolso").cast("string"))
    creditos(spark, sf_dir).withColumn("fecha_desembolso", text_date).write.options(header=True, escape='"').csv(path)
    schema = """credito_id bigint, cliente_id bigint, monto_credito double, plazo_meses int,
        tasa_interes_mensual double, valor_cuota_pactada double, score_interno_originacion int,
        relacion_cuota_ingreso double"""
    return readers.read_csv(spark, path, schema, ["fecha_desembolso", "fecha_ausente"])


@query
def load_all_counts(spark, sf_dir):
    base = scratch_path(spark, "raw")
    for name, df in sources(spark, sf_dir).items():
        df.write.options(header=True, escape='"').csv(f"{base}/{SOURCE_FILES[name]}")
    return readers.row_counts(readers.load_all(spark, base, register=False))


@query
def checkpoint_roundtrip(spark, sf_dir):
    return stage(clean.clean_creditos(creditos(spark, sf_dir)), "creditos_clean")


@query
def scan_predictions(spark, sf_dir):
    scored = _scored(spark, sf_dir)
    stage(scored.select([c for c in PREDICTION_COLUMNS if c in scored.columns]), "predicciones").createOrReplaceTempView(
        "predicciones_riesgo"
    )
    return readers.read_table(spark, "predicciones_riesgo").select(
        "credito_id", "cliente_id", "fecha_desembolso", "es_moroso", "probabilidad_mora", "prediccion_mora"
    )


def _rounded(abt: DataFrame) -> DataFrame:
    return abt.withColumn("prev_evento_sesion_seg_avg", F.round("prev_evento_sesion_seg_avg", 6))


@query
def abt_from_csv(spark, sf_dir):
    """The base table written as plain CSV and read back by its suffix."""
    path, abt = scratch_path(spark, "abt") + ".csv", _abt(spark, sf_dir)
    bi_export.write_plain_csv(abt, path)
    return _rounded(readers.read_abt(spark, path, abt.schema))


@query
def abt_from_parquet(spark, sf_dir):
    """The base table read back by the other suffix."""
    path = scratch_path(spark, "abt") + ".parquet"
    _abt(spark, sf_dir).write.parquet(path)
    return _rounded(readers.read_abt(spark, path))


@query
def lake_csv_format(spark, sf_dir):
    path = scratch_path(spark, "fact_creditos.csv")
    bi_export.write_bi_csv(star.fact_creditos(_scored(spark, sf_dir)), path)
    header = f"^{bi_export.BOM}?credito_id,"
    return spark.read.text(path).where(~F.col("value").rlike(header)).withColumnRenamed("value", "linea")


@query
def lake_manifest(spark, sf_dir):
    path = scratch_path(spark, "bi")
    abt = stage(_abt(spark, sf_dir), "abt")
    star.export_star(abt, with_stand_in_score(abt), path)
    manifest = spark.read.schema("tablas map<string,bigint>").json(f"{path}/manifest.json")
    return manifest.select(F.explode("tablas").alias("tabla", "filas"))


INSTALMENT = ["credito_id", "numero_cuota"]


def _instalment_order(df: DataFrame) -> list[str]:
    return [c for c in ("fecha_vencimiento", "dias_mora", "valor_cuota", "estado_pago", "cliente_id") if c in df.columns]


@query
def upsert_merge(spark, sf_dir):
    everything = pagos(spark, sf_dir).drop("medio_pago")
    loaded = pagos(spark, sf_dir).where(F.col("fecha_vencimiento") <= F.lit(CUTOFF).cast("date"))
    loaded = dedupe.keep_first(loaded, INSTALMENT, [*_instalment_order(loaded)])
    store = upsert.KeyedTable(spark, scratch_path(spark, "pagos"), loaded.schema, tuple(INSTALMENT), 50_000)
    store.replace(loaded)
    store.upsert(everything, _instalment_order(everything))
    return store.read()


@query
def dedupe_keep_last(spark, sf_dir):
    rows = pagos(spark, sf_dir)
    return dedupe.keep_last(rows, INSTALMENT, _instalment_order(rows))


@query
def align_schema(spark, sf_dir):
    abt = _labelled(spark, sf_dir)
    target = spark.createDataFrame(
        [], "credito_id string, monto_credito bigint, es_moroso bigint, edad bigint, ciudad string, probabilidad_mora double"
    ).schema
    return upsert.align_schema(abt, target)[0]


@query
def table_counts(spark, sf_dir):
    creditos(spark, sf_dir).createOrReplaceTempView("raw_creditos_conteo")
    eventos(spark, sf_dir).createOrReplaceTempView("raw_eventos_conteo")
    return readers.table_counts(spark, ["raw_creditos_conteo", "raw_eventos_conteo", "tabla_ausente"])


# --- cleaning ----------------------------------------------------------------------------------


@query
def impute_median(spark, sf_dir):
    df = clean.impute_median(clientes(spark, sf_dir), ["ingreso_mensual_estimado", "score_externo"])
    return df.select("cliente_id", "ingreso_mensual_estimado", "score_externo")


@query
def impute_const(spark, sf_dir):
    fills = {"ingreso_mensual_estimado": clean.SQL_INCOME, "score_externo": clean.SQL_SCORE}
    df = clean.impute_constant(clientes(spark, sf_dir), fills)
    return df.select("cliente_id", *fills)


@query
def city_py(spark, sf_dir):
    return clientes(spark, sf_dir).select("cliente_id", text.city_py(F.col("ciudad")).alias("ciudad"))


@query
def city_sql(spark, sf_dir):
    return clientes(spark, sf_dir).select("cliente_id", text.city_sql(F.col("ciudad")).alias("ciudad"))


@query
def age_repair_py(spark, sf_dir):
    df = clientes(spark, sf_dir)
    return clean.repair_age(df, ranks.exact_medians(df, ["edad"])["edad"]).select("cliente_id", "edad")


@query
def age_repair_sql(spark, sf_dir):
    return clean.repair_age(clientes(spark, sf_dir), clean.SQL_AGE).select("cliente_id", "edad")


@query
def clean_clientes_py(spark, sf_dir):
    return clean.clean_clientes_py(clientes(spark, sf_dir))


@query
def clean_clientes_sql(spark, sf_dir):
    return clean.clean_clientes_sql(clientes(spark, sf_dir))


@query
def clean_creditos(spark, sf_dir):
    return clean.clean_creditos(creditos(spark, sf_dir))


@query
def clean_pagos(spark, sf_dir):
    return clean.clean_pagos(pagos(spark, sf_dir))


@query
def v_clientes_bi(spark, sf_dir):
    star.create_clients_bi_view(clientes(spark, sf_dir))
    return spark.table("v_clientes_bi").select(
        "cliente_id", "ingreso_mensual_estimado", "estrato", "ingreso_mensual_bi", "flag_ingreso"
    )


@query
def bi_income_fields(spark, sf_dir):
    rows = _loans_with_clients(spark, sf_dir)
    return star.with_bi_income(rows).select(
        "credito_id", "ingreso_mensual_estimado", "estrato", "ingreso_mensual_bi", "flag_ingreso"
    )


@query
def outlier_report(spark, sf_dir):
    return star.outlier_report(star.clients_bi(clientes(spark, sf_dir)))


@query
def scalar_functions(spark, sf_dir):
    d, income, city = F.col("fecha_registro"), F.col("ingreso_mensual_estimado"), F.col("ciudad")
    return clientes(spark, sf_dir).select(
        "cliente_id",
        F.lower(text.strip_py(city)).alias("ciudad_limpia"),
        text.title_py(city).alias("ciudad_titulo"),
        text.initcap_pg(F.trim(city)).alias("ciudad_initcap"),
        F.coalesce(city, F.lit("?")).alias("ciudad_o"),
        F.datediff(F.lit("2024-06-30").cast("date"), d).alias("dias"),
        F.year(d).alias("anio"),
        F.month(d).alias("mes"),
        F.quarter(d).alias("trimestre"),
        dates.month_name(d).alias("nombre_mes"),
        dates.weekday_monday0(d).alias("dia0"),
        dates.weekday_monday1(d).alias("dia1"),
        dates.date_key(d).alias("fecha_id"),
        F.concat(F.lit("$"), numbers.grouped_int(income * 1000)).alias("ingreso_texto"),
        numbers.percent(F.col("score_externo") / 1000, 1).alias("score_pct"),
        numbers.float_text(income).alias("ingreso_float"),
        F.least(income, F.lit(5000.0)).alias("ingreso_tope"),
        F.try_divide(income, F.col("numero_dependientes")).alias("ingreso_per_capita"),
        F.round(income / 7, 2).alias("ingreso_semana"),
        F.sha2(F.col("email_hash"), 256).alias("clave"),
        F.to_json(F.struct("departamento", "estrato")).alias("meta"),
    )


# --- label, events, base table -----------------------------------------------------------------


@query
def target_es_moroso(spark, sf_dir):
    return default_label(clean.clean_pagos(pagos(spark, sf_dir)), TEST_SETTINGS)


@query
def pit_join_pairs(spark, sf_dir):
    counts = prior_events.prior_event_counts(creditos(spark, sf_dir), eventos(spark, sf_dir), [])
    return counts.select("credito_id", F.col(prior_events.PAIRS).alias("pares"))


@query
def eventos_previos_sql(spark, sf_dir):
    return prior_events.event_features_sql(creditos(spark, sf_dir), eventos(spark, sf_dir))


@query
def eventos_pivot(spark, sf_dir):
    features = prior_events.event_features_py(clean.clean_creditos(creditos(spark, sf_dir)), eventos(spark, sf_dir))
    return features.drop("prev_evento_sesion_seg_tot", "prev_evento_sesion_seg_avg")


@query
def eventos_sesion(spark, sf_dir):
    loans = clean.clean_creditos(creditos(spark, sf_dir))
    features = prior_events.event_features_py(loans, eventos(spark, sf_dir), EVENT_TYPES)
    return features.select(
        "credito_id", "prev_evento_sesion_seg_tot", F.round("prev_evento_sesion_seg_avg", 6).alias("prev_evento_sesion_seg_avg")
    )


@query
def abt_py(spark, sf_dir):
    return _rounded(_abt(spark, sf_dir))


@query
def abt_sql(spark, sf_dir):
    return _abt_sql(spark, sf_dir)


# --- reports -----------------------------------------------------------------------------------


@query
def insight_a(spark, sf_dir):
    return reports.insight_a(_abt_sql(spark, sf_dir, reports.INSIGHT_A))


@query
def insight_b(spark, sf_dir):
    return reports.insight_b(_abt_sql(spark, sf_dir, reports.INSIGHT_B))


@query
def insight_c(spark, sf_dir):
    return reports.insight_c(_abt_sql(spark, sf_dir, reports.INSIGHT_C))


@query
def insight_d(spark, sf_dir):
    return reports.insight_d(stage(_abt_sql(spark, sf_dir), "abt"))


@query
def insight_e(spark, sf_dir):
    return reports.insight_e(pagos(spark, sf_dir), TEST_SETTINGS)


@query
def ntile_scaled(spark, sf_dir):
    loans = stage(
        creditos(spark, sf_dir).select("credito_id", "score_interno_originacion"), "scores"
    )
    return ranks.with_ntile(loans, 7, "score_interno_originacion", F.col("credito_id"), "grupo")


@query
def portfolio_summary(spark, sf_dir):
    totals = reports.portfolio_totals(_labelled(spark, sf_dir))
    return totals.select(
        "total", "morosos",
        *[F.round(c, 6).alias(c) for c in ("tasa_mora", "tasa_monto_en_riesgo")],
        *[F.round(c, 2).alias(c) for c in ("monto_total", "monto_en_riesgo", "monto_sano")],
    )


@query
def portfolio_by_product(spark, sf_dir):
    return reports.portfolio_by_product(_labelled(spark, sf_dir)).withColumn("monto_prom", F.round("monto_prom", 4))


@query
def portfolio_by_channel(spark, sf_dir):
    return reports.portfolio_by_channel(_labelled(spark, sf_dir))


@query
def portfolio_top_departments(spark, sf_dir):
    return reports.top_departments(_labelled(spark, sf_dir))


@query
def default_rate(spark, sf_dir):
    return reports.default_rate(_labelled(spark, sf_dir)).select(F.round("tasa_mora", 9).alias("tasa_mora"))


@query
def rate_by_estrato(spark, sf_dir):
    return reports.rate_by(_labelled(spark, sf_dir), "estrato").withColumn("tasa_mora", F.round("tasa_mora", 9))


@query
def rate_by_product(spark, sf_dir):
    return reports.rate_by(_labelled(spark, sf_dir), "producto_credito").withColumn("tasa_mora", F.round("tasa_mora", 9))


# Bands for the given amounts, which run up to about 500 000.
TEST_BANDS = ((0, "1. < 50K"), (50_000, "2. 50K - 100K"), (100_000, "3. 100K - 200K"), (200_000, "4. 200K - 300K"), (300_000, "5. > 300K"))


@query
def mora_by_amount_band(spark, sf_dir):
    return reports.rate_by_amount_band(_labelled(spark, sf_dir), TEST_BANDS)


@query
def segment_rate(spark, sf_dir):
    return reports.segment_rate(_labelled(spark, sf_dir), producto_credito="1-URGENT", ciudad="Cali")


@query
def event_means_by_label(spark, sf_dir):
    means = reports.event_means_by_label(_abt(spark, sf_dir))
    return means.select("variable", *[F.round(c, 6).alias(c) for c in ("media_0", "media_1")])


# --- profiling and quality ---------------------------------------------------------------------


@query
def corr_matrix(spark, sf_dir):
    return profile.corr_matrix(stage(_abt(spark, sf_dir), "abt")).withColumn("corr", F.round("corr", 6))


@query
def histogram(spark, sf_dir):
    s = sources(spark, sf_dir)
    clients = profile.histogram(
        clean.clean_clientes_py(s["clientes"]),
        {c: (F.col(c), 30) for c in ("ingreso_mensual_estimado", "score_externo")},
    )
    loans = profile.histogram(
        clean.clean_creditos(s["creditos"]),
        {"monto_credito": (F.col("monto_credito"), 30), "tasa_pct": (F.col("tasa_interes_mensual") * 100, 20)},
    )
    return clients.unionByName(loans)


@query
def box_stats(spark, sf_dir):
    rows = stage(_labelled(spark, sf_dir).select("es_moroso", "relacion_cuota_ingreso"), "labelled")
    return profile.box_stats(rows, "es_moroso", "relacion_cuota_ingreso")


@query
def city_value_counts(spark, sf_dir):
    return profile.value_counts(clientes(spark, sf_dir), "ciudad", 15)


@query
def pk_check(spark, sf_dir):
    return quality.pk_check(sources(spark, sf_dir))


@query
def fk_orphans(spark, sf_dir):
    return quality.fk_orphans(sources(spark, sf_dir))


@query
def null_profile(spark, sf_dir):
    return quality.null_profile(sources(spark, sf_dir))


@query
def table_profile(spark, sf_dir):
    return quality.table_profile(sources(spark, sf_dir))


@query
def type_limits(spark, sf_dir):
    return quality.type_limits(sources(spark, sf_dir))


# --- star schema -------------------------------------------------------------------------------


@query
def fact_creditos(spark, sf_dir):
    return star.fact_creditos(_scored(spark, sf_dir))


@query
def dim_cliente(spark, sf_dir):
    return star.dim_cliente(star.with_bi_income(stage(_scored(spark, sf_dir), "scored")))


@query
def dim_producto(spark, sf_dir):
    return star.dim_producto(creditos(spark, sf_dir))


@query
def dim_tiempo(spark, sf_dir):
    return star.dim_tiempo(creditos(spark, sf_dir))


@query
def perfil_cliente(spark, sf_dir):
    profile_rows = star.perfil_cliente(star.with_bi_income(stage(_scored(spark, sf_dir), "scored")))
    means = ("monto_total_credito", "monto_promedio_credito", "probabilidad_mora_promedio", "tasa_mora_cliente")
    return profile_rows.withColumns({c: F.round(c, 8) for c in means})


# --- model -------------------------------------------------------------------------------------


@query
def feature_columns(spark, sf_dir):
    abt = _abt(spark, sf_dir)
    names = model.feature_columns(abt.schema)
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("no_nulos")) for c in names])
    return abt.agg(*[F.count(c).alias(c) for c in names]).select(F.inline(rows))


def _hash() -> Column:
    return (F.col("credito_id") * 2654435761) % 4294967296


@query
def stratified_split(spark, sf_dir):
    rows = stage(_labelled(spark, sf_dir).select("credito_id", "es_moroso"), "labelled")
    return model.split_train_test(rows, _hash(), F.col("credito_id"))


@query
def stratified_split_wide(spark, sf_dir):
    """The split by a hash beyond 2^53, where the sketch's doubles are rounded."""
    rows = stage(_labelled(spark, sf_dir).select("credito_id", "es_moroso"), "labelled")
    return model.split_train_test(rows, F.lit(2**60) + _hash() * F.lit(1_000_003), F.col("credito_id"))


@query
def category_index(spark, sf_dir):
    rows = _labelled(spark, sf_dir).select("credito_id", "producto_credito", "ciudad")
    indexed = model.category_indexer(["producto_credito", "ciudad"]).fit(rows).transform(rows)
    return indexed.select("credito_id", "producto_credito__idx", "ciudad__idx")


@query
def class_weights(spark, sf_dir):
    return metrics.class_weights(_labelled(spark, sf_dir))


@query
def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(_scored(spark, sf_dir))


@query
def classification_report(spark, sf_dir):
    report = metrics.classification_report(_scored(spark, sf_dir))
    return report.withColumns({c: F.round(c, 9) for c in ("precision", "recall", "f1")})


@query
def roc_auc(spark, sf_dir):
    return metrics.roc_auc_table(_scored(spark, sf_dir).select("es_moroso", "probabilidad_mora")).select(F.round("auc", 9).alias("auc"))


_models: dict[tuple, tuple] = {}


def _trained(spark, sf_dir):
    """Base table with split, features and model; fitted once per session and data set."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _models:
        rows = model.split_train_test(stage(_abt(spark, sf_dir), "abt"))  # a comparison for each row, sooner made again than read
        features = [c for c in model.feature_columns(rows.schema) if c != "split"]
        _models[key] = rows, features, model.train(rows.where("split = 'train'"), features)
    return _models[key]


@query
def train_default_model(spark, sf_dir):
    rows, _, fitted = _trained(spark, sf_dir)
    test = stage(model.score_book(fitted, rows.where("split = 'test'")), "test_scored")
    report = metrics.classification_report(test).select("clase", "support")
    learnt = metrics.roc_auc(stage(model.score_book(fitted, rows.where("split = 'train'")), "train_scored"))
    return report.withColumn("auc_mejor_que_azar", F.lit(metrics.roc_auc(test) > 0.48 and learnt > 0.52))


#: Whole numbers of few values, which a bin holds each on its own.
STUMP_FEATURES = ["estrato", "mes_desembolso", "dia_semana_desembolso", "numero_dependientes"]


@query
def tree_stump(spark, sf_dir):
    """The one best split over a few columns, and what it says on both sides: SQL tries every cut of every column."""
    rows = _labelled(spark, sf_dir).select("es_moroso", *STUMP_FEATURES)
    weights = {r["es_moroso"]: r["peso"] for r in metrics.class_weights(rows).collect()}
    weighted = rows.withColumn("peso", F.when(F.col("es_moroso") == 1, weights[1]).otherwise(weights[0]))
    _, trees = boosting.boost(weighted, STUMP_FEATURES, "es_moroso", "peso", trees=1, rate=0.03, depth=1, leaves=2, least_rows=30)
    nodes = spark.createDataFrame(boosting.node_rows(trees, STUMP_FEATURES), boosting.NODES)
    top = nodes.where("nodo = 1").select("feature", "umbral", "nulos_izquierda", F.round("ganancia", 6).alias("ganancia"))
    leaves = nodes.where("nodo > 1").select(F.when(F.col("nodo") == 2, "izquierda").otherwise("derecha").alias("lado"), "filas", F.round("valor", 9).alias("valor"))
    return leaves.join(F.broadcast(top))  # one row


#: A default that is known: no external score, or a long term of a client in a low stratum.
KNOWN = "CAST(score_externo IS NULL OR coalesce(plazo_meses >= 24 AND estrato <= 3, false) AS INT)"


@query
def tree_leaves(spark, sf_dir):
    """A model of a known rule with nulls in it: rows in the leaves of each tree, recounted by its splits as SQL."""
    rows = _labelled(spark, sf_dir).select("credito_id", "plazo_meses", "estrato", "edad", F.when(F.col("credito_id") % 3 > 0, F.col("score_externo")).alias("score_externo"))
    rows = stage(rows.withColumn("es_moroso", F.expr(KNOWN)), "known")
    fitted = model.train(rows, ["plazo_meses", "estrato", "edad", "score_externo"], trees=5)
    nodes = stage(fitted.nodes(), "nodes")
    splits = {(r["arbol"], r["nodo"]): r for r in nodes.where("feature IS NOT NULL").collect()}

    def leaf(tree: int, node: int) -> str:
        if (tree, node) not in splits:
            return str(node)
        r = splits[tree, node]
        goes = f"{r['feature']} IS NULL" if r["nulos_izquierda"] else "false"
        cut = "true" if r["umbral"] == math.inf else f"{r['feature']} <= {r['umbral']!r}D"
        return f"CASE WHEN coalesce({cut} AND {r['feature']} IS NOT NULL, false) OR {goes} THEN {leaf(tree, 2 * node)} ELSE {leaf(tree, 2 * node + 1)} END"

    reached = rows.select(F.inline(F.array(*[F.struct(F.lit(t).alias("t"), F.expr(leaf(t, 1)).alias("n")) for t in range(5)])))
    recount = reached.groupBy("t", "n").agg(F.count("*").alias("contadas"))
    same = nodes.where("feature IS NULL").join(recount, (F.col("arbol") == F.col("t")) & (F.col("nodo") == F.col("n")), "left")
    auc = metrics.roc_auc(model.score_book(fitted, rows))
    return same.groupBy("arbol").agg(
        F.sum("filas").alias("filas"), F.bool_and(F.col("contadas") == F.col("filas")).alias("misma_cuenta"), (F.count("*") <= 15).alias("hojas_permitidas"),
        (F.min("filas") >= 30).alias("hojas_llenas"), F.lit(auc > 0.99).alias("regla_aprendida"),
    )


@query
def score_book(spark, sf_dir):
    rows, _, fitted = _trained(spark, sf_dir)
    p = F.col("probabilidad_mora")
    return model.score_book(fitted, rows).select(
        "credito_id", "es_moroso", p.between(0, 1).alias("valida"), ((p > 0.5) == (F.col("prediccion_mora") == 1)).alias("coherente")
    )


@query
def feature_importance(spark, sf_dir):
    """The five features with most splits, next to a count over the table of nodes; and whether all splits are counted."""
    fitted = _trained(spark, sf_dir)[2]
    ranked = stage(model.feature_importance(fitted), "importance")
    nodes = stage(fitted.nodes(), "nodes")
    recount = nodes.groupBy("feature").agg(F.count("*").alias("n")).where("feature IS NOT NULL").withColumnRenamed("feature", "f")
    inner = nodes.agg(F.count_if(F.col("feature").isNotNull()) == F.count_if(F.col("feature").isNull()) - F.count_distinct("arbol")).first()[0]
    total = ranked.agg(F.sum("importancia") == nodes.where("feature IS NOT NULL").count()).first()[0]
    w = Window.orderBy(F.desc("importancia"), "feature")  # a row for each feature
    top = ranked.withColumns({"puesto": F.row_number().over(w), "antes": F.lag("importancia").over(w)}).where("puesto <= 5")
    top = top.join(recount, F.col("feature") == F.col("f"), "left")
    return top.select(
        "puesto", (F.col("importancia") == F.coalesce("n", F.lit(0))).alias("coincide"),
        F.coalesce(F.col("antes") >= F.col("importancia"), F.lit(True)).alias("descendente"), F.lit(bool(inner and total)).alias("completa"),
    )


APPLICATION_FIELDS = (
    "edad", "ingreso_mensual_estimado", "score_externo", "monto_credito", "plazo_meses", "valor_cuota_pactada",
)


def _applications(spark, sf_dir) -> DataFrame:
    """One application per loan, with only the fields an applicant states."""
    return _loans_with_clients(spark, sf_dir).select("credito_id", *APPLICATION_FIELDS)


@query
def score_applicants(spark, sf_dir):
    _, features, fitted = _trained(spark, sf_dir)
    scored = model.score_applicants(fitted, features, _applications(spark, sf_dir), "credito_id")
    p = F.col("score_riesgo_mora")
    agrees = (p == 0.5) | ((p < 0.5) == (F.col("decision") == "APROBADO"))  # the score is rounded, the decision is not
    return scored.select("credito_id", p.between(0, 1).alias("valida"), agrees.alias("coherente"))


@query
def score_defaults(spark, sf_dir):
    features = [*APPLICATION_FIELDS, "estrato", "prev_evento_login", "tiene_producto_ahorro", "ciudad", "genero"]
    return model.with_default_features(_applications(spark, sf_dir), ["credito_id", *features])


@query
def score_decision(spark, sf_dir):
    p = F.col("probabilidad_mora")
    return with_stand_in_score(creditos(spark, sf_dir)).select(
        "credito_id", F.round(p, 4).alias("score_riesgo_mora"), numbers.decision(p).alias("decision")
    )


@query
def risk_level(spark, sf_dir):
    return with_stand_in_score(creditos(spark, sf_dir)).select(
        "credito_id", numbers.risk_level(F.col("probabilidad_mora")).alias("nivel_riesgo")
    )


# --- knowledge base ----------------------------------------------------------------------------


@query
def kb_loan_cards(spark, sf_dir):
    cards = knowledge.loan_cards(_scored(spark, sf_dir))
    keys = ("fuente", "cliente_id", "credito_id", "es_moroso", "probabilidad_mora", "nivel_riesgo", "producto_credito", "departamento")
    return cards.select("page_content", *[F.col("metadata")[k].alias(k) for k in keys])


def _summary(spark, sf_dir) -> DataFrame:
    return knowledge.summary_document(stage(_scored(spark, sf_dir), "scored"), settings=TEST_SETTINGS)


@query
def kb_summary_doc(spark, sf_dir):
    return _summary(spark, sf_dir).select("page_content", F.col("metadata")["fuente"].alias("fuente"))


def _documents(spark, sf_dir) -> DataFrame:
    policies = knowledge.policy_documents(table(spark, sf_dir, "benchmark"), "item_id", "text")
    return knowledge.all_documents(stage(_scored(spark, sf_dir), "scored"), policies, settings=TEST_SETTINGS)


@query
def kb_documents(spark, sf_dir):
    return (
        _documents(spark, sf_dir)
        .groupBy(F.col("metadata")["fuente"].alias("fuente"))
        .agg(F.count(F.lit(1)).alias("documentos"))
    )


@query
def kb_build(spark, sf_dir):
    store = knowledge.build_store(_documents(spark, sf_dir), scratch_path(spark, "kb"))
    rows = store.groupBy(F.col("metadata")["fuente"].alias("fuente")).agg(
        F.count_if(F.col("chunk") == 0).alias("documentos"),
        (F.count("id") == F.count_distinct("id")).alias("claves_unicas"),
        (F.max(F.length("page_content")) <= 1000).alias("cortos"),
    )
    return rows


@query
def kb_counts(spark, sf_dir):
    """Counts of a store that was just built, from loan cards and policies, each of which is one chunk."""
    policies = knowledge.policy_documents(table(spark, sf_dir, "benchmark"), "item_id", "text")
    cards = knowledge.build_store(knowledge.loan_cards(_scored(spark, sf_dir)), scratch_path(spark, "kb_cards"))
    return knowledge.store_counts({"fichas": cards, "politicas": knowledge.build_store(policies, scratch_path(spark, "kb_policies"))})


@query
def abt_sql_table(spark, sf_dir):
    """The base table created in the catalog, as an external one in the scratch folder, and counted from there."""
    name = f"abt_{uuid.uuid4().hex}"
    abt_plan.create_abt_table(sources(spark, sf_dir), name, scratch_path(spark, "ctas"), TEST_SETTINGS)
    rows = spark.table(name).groupBy("producto_credito").agg(
        F.count(F.lit(1)).alias("filas"), F.sum("es_moroso").cast("bigint").alias("morosos"), F.sum("prev_evento_login").cast("bigint").alias("accesos")
    )
    result = stage(rows, "abt_counts")
    spark.sql(f"DROP TABLE {name}")
    return result


@query
def hot_client_join(spark, sf_dir):
    """Loans of which one client holds a third, joined with clients over the salted branch."""
    s = sources(spark, sf_dir)
    loans = s["creditos"].select("credito_id", F.when(F.col("credito_id") % 3 == 0, 1).otherwise(F.col("cliente_id")).alias("cliente_id"))
    hot = skew.hot_weights(loans, "cliente_id")
    joined = skew.lookup_join(loans, s["clientes"].select("cliente_id", "ocupacion"), ["cliente_id"], "cliente_id", hot)
    return joined.select("credito_id", "cliente_id", "ocupacion", F.lit(1 in hot).alias("hay_cliente_frecuente"))


@query
def chunk_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return _chunk_facts(chunks.chunk_documents(docs.withColumn("whole", F.col("text")), "text"))


def _chunk_facts(parts: DataFrame) -> DataFrame:
    """Each chunk is compared with its document where it was cut, so that no text is shuffled or sorted."""
    whole, trimmed = F.col("whole"), F.trim("text")
    compared = parts.select(
        "doc_id", "chunk", F.length("text").alias("size"), (F.length(whole) <= 1000).alias("short"),
        F.startswith(F.ltrim(whole), trimmed).alias("starts"), F.endswith(F.rtrim(whole), trimmed).alias("ends"),
    )
    return compared.groupBy("doc_id").agg(
        F.when(F.first("short"), F.count(F.lit(1)) == 1).otherwise(F.max("size") <= 800).alias("tamano_correcto"),
        F.min_by("starts", "chunk").alias("empieza"),
        F.max_by("ends", "chunk").alias("termina"),
    )


@query
def normalize_vectors(spark, sf_dir):
    unit = vectors.normalize_vectors(table(spark, sf_dir, "embeddings")).select("vec_id", F.posexplode("embedding"))
    return unit.select("vec_id", F.col("pos").alias("posicion"), F.round("col", 9).alias("valor"))


@query
def knn_exact(spark, sf_dir):
    hits = vectors.knn_exact(table(spark, sf_dir, "embeddings"), _label_centroids(spark, sf_dir))
    return hits.withColumn("score", F.round("score", 6))


@query
def knn_approx(spark, sf_dir):
    rows, asked = table(spark, sf_dir, "embeddings"), _label_centroids(spark, sf_dir)
    hits = stage(vectors.knn_approx(rows, asked), "approx")
    exact = stage(vectors.knn_exact(rows, asked), "exact")
    same = hits.join(exact.select("query_id", "vec_id"), ["query_id", "vec_id"], "left_semi").count()
    unit_rows = vectors.normalize_vectors(rows).select("vec_id", F.col("embedding").alias("r"))
    unit_asked = vectors.normalize_vectors(asked).select("query_id", F.col("embedding").alias("q"))
    dot = F.aggregate(F.zip_with("r", "q", lambda a, b: a * b), F.lit(0.0), lambda total, x: total + x)
    scored = hits.join(unit_rows, "vec_id").join(unit_asked, "query_id").withColumn("right", F.abs(dot - F.col("score")) < 1e-8)
    return scored.groupBy("query_id").agg(
        F.count(F.lit(1)).alias("vecinos"), F.bool_and("right").alias("coseno_exacto"), F.lit(same >= 0.9 * exact.count()).alias("recall_suficiente")
    )


@query
def retrieve_context(spark, sf_dir):
    asked = _label_centroids(spark, sf_dir)
    hits = vectors.knn_exact(table(spark, sf_dir, "embeddings"), asked)
    texts = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("vec_id"), "text")
    return vectors.contexts(hits, texts, asked, "vec_id", "text", knowledge.FALLBACK)


# --- the whole batch run -----------------------------------------------------------------------


@query
def lake_refresh(spark, sf_dir):
    result = refresh.refresh(spark, sources(spark, sf_dir), scratch_path(spark, "refresh"), TEST_SETTINGS)
    rows = [*result.lake_counts.items(), ("upsert", result.upserted)]
    return spark.createDataFrame(rows, "tabla string, filas bigint")
