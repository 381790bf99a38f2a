"""The knowledge base: loan cards, portfolio summary, user documents, chunks, store."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import float_text, grouped_int, percent, risk_level
from ..functions.text import title_py
from ..operators.chunks import chunk_documents
from ..operators.reports import portfolio_by_channel, portfolio_by_product, portfolio_totals, top_departments
from ..settings import Settings

FALLBACK = "No se encontró información relevante en los datos de la corporación."
DOCUMENT = "page_content string, metadata map<string,string>"


def _text(c: str | Column) -> Column:
    return F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("None"))


def _money(c: str) -> Column:
    return F.concat(F.lit("$"), F.coalesce(grouped_int(F.col(c)), F.lit("nan")))


def _share(c: str | Column, digits: int) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(percent(c, digits), F.lit("nan%"))


def loan_cards(scored: DataFrame) -> DataFrame:
    """page_content, metadata: one text card per scored loan."""
    p = F.col("probabilidad_mora").cast("double")
    yes_no = F.when(F.col("es_moroso") == 1, "SÍ").otherwise("NO")
    # Wording and layout of the card.
    text = F.concat(
        F.lit("FICHA DE CRÉDITO — "), _text("credito_id"),
        F.lit("\nCliente: "), _text("cliente_id"),
        F.lit("  |  Ubicación: "), _text(title_py(F.col("ciudad"))), F.lit(", "), _text("departamento"),
        F.lit("\nEdad: "), _text(F.col("edad").cast("bigint")), F.lit(" años  |  Género: "), _text("genero"),
        F.lit("  |  Estrato: "), _text("estrato"),
        F.lit("\nEducación: "), _text("nivel_educativo"), F.lit("  |  Ocupación: "), _text("ocupacion"),
        F.lit("\nIngreso mensual estimado: "), _money("ingreso_mensual_estimado"),
        F.lit("\nScore externo (buró): "), F.coalesce(float_text(F.col("score_externo")), F.lit("nan")),
        F.lit("\n\nCRÉDITO:\nProducto: "), _text("producto_credito"),
        F.lit("\nMonto desembolsado: "), _money("monto_credito"),
        F.lit("\nPlazo: "), _text("plazo_meses"),
        F.lit(" meses  |  Tasa mensual: "), _share("tasa_interes_mensual", 2),
        F.lit("\nValor cuota pactada: "), _money("valor_cuota_pactada"),
        F.lit("\nRelación cuota/ingreso: "), _share("relacion_cuota_ingreso", 2),
        F.lit("\nCanal de originación: "), _text("canal_originacion"),
        F.lit("\nPolítica de aprobación: "), _text("politica_aprobacion"),
        F.lit("\nEstado operativo del crédito: "), _text("estado_credito_operativo"),
        F.lit("\n\nRIESGO:\n¿Es moroso?: "), yes_no,
        F.lit("\nProbabilidad de mora: "), _share(p, 1),
        F.lit("  →  Nivel de riesgo: "), risk_level(p), F.lit("\n"),
    )
    metadata = F.create_map(
        F.lit("fuente"), F.lit("ficha_cliente"),
        F.lit("cliente_id"), _text("cliente_id"),
        F.lit("credito_id"), _text("credito_id"),
        F.lit("es_moroso"), _text("es_moroso"),
        F.lit("probabilidad_mora"), float_text(F.round(p, 4)),
        F.lit("nivel_riesgo"), risk_level(p),
        F.lit("producto_credito"), _text("producto_credito"),
        F.lit("departamento"), _text("departamento"),
    )
    return scored.select(text.alias("page_content"), metadata.alias("metadata"))


def _lines(report: DataFrame, order: Sequence[str], line: Column) -> Column:
    """The rows of a short report as one text, as a scalar subquery."""
    rows = F.array_sort(F.collect_list(F.struct(*order, line.alias("_line"))))
    return report.agg(F.array_join(F.transform(rows, lambda r: r["_line"]), "\n").alias("t")).scalar()


def _counts(name: str) -> list[Column]:
    rate = F.col("morosos") / F.col("creditos")
    return [
        F.lit("  • "), F.col(name), F.lit(": "), F.col("creditos").cast("string"), F.lit(" créditos, "),
        F.col("morosos").cast("string"), F.lit(" morosos ("), _share(rate, 1), F.lit(")"),
    ]


def summary_document(
    scored: DataFrame, organisation: str = "", model_lines: Sequence[str] = (), settings: Settings = Settings()
) -> DataFrame:
    """page_content, metadata: one document of portfolio figures.

    `model_lines` describe the model in use. Pass a staged input: four short reports scan it.
    """
    products = _lines(
        portfolio_by_product(scored),
        ["producto_credito"],
        F.concat(*_counts("producto_credito"), F.lit(", monto promedio "), _money("monto_prom")),
    )
    channels = _lines(
        portfolio_by_channel(scored), ["canal_originacion"], F.concat(*_counts("canal_originacion"))
    )
    departments = _lines(
        top_departments(scored).withColumn("_order", -F.col("morosos")),
        ["_order", "departamento"],
        F.concat(*_counts("departamento")),
    )
    title = "RESUMEN ESTADÍSTICO DEL PORTAFOLIO DE CRÉDITOS" + (f" — {organisation}" if organisation else "")
    model = "".join(f"  • {line}\n" for line in model_lines)
    # Wording and layout of the summary.
    text = F.concat(
        F.lit(f"{title}\nFecha de corte: {settings.cutoff_date}\n\nMÉTRICAS GLOBALES:\n"),
        F.lit("  • Total créditos en portafolio: "), grouped_int(F.col("total")),
        F.lit("\n  • Clientes morosos identificados: "), grouped_int(F.col("morosos")),
        F.lit(" ("), _share("tasa_mora", 1), F.lit(" tasa de mora)"),
        F.lit("\n  • Monto total desembolsado: "), _money("monto_total"),
        F.lit("\n  • Monto en riesgo (morosos): "), _money("monto_en_riesgo"),
        F.lit(" ("), _share("tasa_monto_en_riesgo", 1), F.lit(")"),
        F.lit("\n  • Portafolio sano: "), _money("monto_sano"),
        F.lit(" ("), _share(1 - F.col("tasa_mora"), 1), F.lit(")\n\n"),
        F.lit(f"MODELO PREDICTIVO:\n{model}\n" if model else ""),
        F.lit("DESGLOSE POR PRODUCTO:\n"), products,
        F.lit("\n\nDESGLOSE POR CANAL DE ORIGINACIÓN:\n"), channels,
        F.lit("\n\nTOP DEPARTAMENTOS POR MORA:\n"), departments, F.lit("\n"),
    )
    metadata = F.create_map(
        F.lit("fuente"), F.lit("resumen_portafolio"), F.lit("tipo"), F.lit("estadisticas_globales")
    )
    return portfolio_totals(scored).select(text.alias("page_content"), metadata.alias("metadata"))


def policy_documents(texts: DataFrame, title: str, text: str) -> DataFrame:
    """page_content, metadata: the user's own policy and glossary texts."""
    metadata = F.create_map(
        F.lit("fuente"), F.lit("politica_negocio"), F.lit("titulo"), F.col(title).cast("string")
    )
    return texts.select(F.col(text).alias("page_content"), metadata.alias("metadata"))


def all_documents(scored: DataFrame, policies: DataFrame, include_cards: bool = True, **summary) -> DataFrame:
    docs = summary_document(scored, **summary).unionByName(policies)
    return docs.unionByName(loan_cards(scored)) if include_cards else docs


def keyed_chunks(docs: DataFrame) -> DataFrame:
    """id, page_content, metadata, chunk: chunks with a key that a rerun reproduces."""
    key = F.sha2(F.concat_ws("\u001f", F.to_json(F.map_entries("metadata")), F.col("chunk").cast("string"), "page_content"), 256)
    return chunk_documents(docs).select(key.alias("id"), "page_content", "metadata", "chunk")


def build_store(docs: DataFrame, root: str, reset: bool = True) -> DataFrame:
    """Chunk `docs` into the Parquet store at `root`, replacing or extending it; the store's rows."""
    chunks = keyed_chunks(docs)
    chunks.write.mode("overwrite" if reset else "append").parquet(root)
    return docs.sparkSession.read.schema(chunks.schema).parquet(root)


def store_counts(collections: dict[str, DataFrame]) -> DataFrame:
    """One row: number of collections and of chunks in all of them."""
    first, *rest = [df.agg(F.count(F.lit(1)).alias("n")) for df in collections.values()]
    for df in rest:
        first = first.unionByName(df)
    return first.agg(F.count("n").alias("colecciones"), F.sum("n").alias("embeddings"))
