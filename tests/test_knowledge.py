import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from creditlake.operators import vectors
from creditlake.operators.chunks import SEPARATORS, chunk_documents, split_text
from creditlake.plans import knowledge
from creditlake.settings import Settings


def reference_split(text, size, overlap, separators):
    """The same rules written plainly with strings, to compare against."""
    at = next((i for i, s in enumerate(separators) if s == "" or s in text), None)
    if at is None:
        return [text]
    sep, finer = separators[at], separators[at + 1 :]
    if sep == "":
        pieces = list(text)
    else:
        head, *tail = text.split(sep)
        pieces = [p for p in [head, *[sep + t for t in tail]] if p]
    out, run = [], []

    def flush():
        window = []
        for piece in run:
            if sum(map(len, window)) + len(piece) > size and window:
                out.append("".join(window).strip())
                while window and (sum(map(len, window)) > overlap or sum(map(len, window)) + len(piece) > size):
                    window.pop(0)
            window.append(piece)
        if window:
            out.append("".join(window).strip())
        run.clear()

    for piece in pieces:
        if len(piece) < size:
            run.append(piece)
        else:
            flush()
            out.extend(reference_split(piece, size, overlap, finer) if finer else [piece])
    flush()
    return [c for c in out if c]


texts = st.text(alphabet="ab \n", max_size=300) | st.lists(st.sampled_from(["uno", "dos tres", "\n\n", "\n", " ", "x" * 70, "ñ"]), max_size=60).map("".join)


@settings(max_examples=300, deadline=None)
@given(texts, st.sampled_from([(40, 10), (60, 0), (25, 24)]))
def test_chunks_follow_the_rules(text, limits):
    size, overlap = limits
    chunks = split_text(text, size, overlap)
    assert chunks == reference_split(text, size, overlap, SEPARATORS)
    assert all(0 < len(c) <= size and c == c.strip() for c in chunks)
    position = 0  # chunks appear in order and nothing but white space is lost
    for c in chunks:
        position = text.index(c, max(position - size, 0))
    assert set("".join(text.split())) == set("".join("".join(chunks).split()))


def test_long_documents_only(spark, rows_of):
    words = " ".join(f"palabra{i}" for i in range(400))
    docs = spark.createDataFrame([(1, "y" * 1000), (2, "x" * 1001), (3, words), (4, None), (5, "")], "id int, page_content string")
    chunks = rows_of(chunk_documents(docs), "id", "chunk")
    assert [c for c in chunks if c[0] == 1] == [(1, 0, "y" * 1000)]
    assert [len(c[2]) for c in chunks if c[0] == 2] == [800, 301]
    assert [c[2] for c in chunks if c[0] == 3] == split_text(words)
    assert [c for c in chunks if c[0] in (4, 5)] == [(5, 0, "")]


def vector_frames(spark, n=400, queries=7, dim=16):
    rng = np.random.default_rng(1)
    data = rng.normal(size=(n, dim))
    data[5] = data[9]  # duplicates
    data[11] = 0.0  # zero vector
    asked = np.vstack([rng.normal(size=(queries - 1, dim)), data[9]])
    corpus = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id bigint, embedding array<double>")
    asks = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(asked)], "query_id int, embedding array<double>")

    def normal(m):
        norm = np.linalg.norm(m, axis=1, keepdims=True)
        return m / np.where(norm > 0, norm, 1)

    scores = np.round(normal(asked) @ normal(data).T, 9)
    top = {(q, int(i), r + 1) for q, row in enumerate(scores) for r, i in enumerate(sorted(range(n), key=lambda i: (-row[i], i))[:3])}
    return corpus.repartition(5), asks, top


def test_exact_search_equals_brute_force(spark):
    corpus, asks, top = vector_frames(spark)
    for limit in (vectors.MAX_QUERIES_PER_TASK, 4):  # 4: more queries than a task takes
        hits = vectors.knn_exact(corpus, asks, max_queries=limit)
        assert {(r["query_id"], r["vec_id"], r["rank"]) for r in hits.collect()} == top
    assert dict(hits.dtypes)["query_id"] == "int"


def test_search_edges(spark):
    corpus, asks, _ = vector_frames(spark)
    assert vectors.knn_exact(corpus.where("vec_id < 2"), asks).groupBy("query_id").count().where("count <> 2").isEmpty()
    assert vectors.knn_exact(corpus.limit(0), asks).isEmpty()
    assert vectors.knn_exact(corpus, asks.limit(0)).isEmpty()
    named = corpus.withColumn("vec_id", F.concat(F.lit("v"), F.col("vec_id")))
    assert vectors.knn_exact(named, asks, k=1).where("query_id = 6").first()["vec_id"] in ("v5", "v9")


def test_approximate_search_recall(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(10, 32))
    data = np.repeat(centres, 60, axis=0) + rng.normal(scale=0.2, size=(600, 32))
    corpus = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id bigint, embedding array<double>")
    asks = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(centres)], "query_id bigint, embedding array<double>")
    key = lambda df: {(r["query_id"], r["vec_id"]) for r in df.collect()}
    exact, approx = key(vectors.knn_exact(corpus, asks)), key(vectors.knn_approx(corpus, asks))
    assert len(exact & approx) / len(exact) >= 0.9


def test_context_and_fallback(spark, rows_of):
    hits = spark.createDataFrame([(1, 10, 2), (1, 11, 1), (2, 99, 1)], "query_id int, vec_id int, rank int")
    texts = spark.createDataFrame([(10, "segundo"), (11, "primero")], "vec_id int, text string")
    asks = spark.createDataFrame([(1,), (2,), (3,)], "query_id int")
    found = vectors.contexts(hits, texts, asks, "vec_id", "text", "nada")
    assert rows_of(found, "query_id") == [(1, "primero\nsegundo"), (2, "nada"), (3, "nada")]


def test_unit_vectors(spark):
    df = spark.createDataFrame([(1, [3.0, 4.0]), (2, [0.0, 0.0])], "id int, embedding array<float>")
    assert [r["embedding"] for r in vectors.normalize_vectors(df).orderBy("id").collect()] == [[0.6, 0.8], [0.0, 0.0]]


CARD = dict(
    credito_id="CR1", cliente_id="CL1", ciudad="Bogotá D.C.", departamento="Cundinamarca", edad=30.0, genero="F", estrato=3,
    nivel_educativo=None, ocupacion="Médica", ingreso_mensual_estimado=2_200_000.5, score_externo=580.0, producto_credito="Microcrédito",
    monto_credito=1_500_000.0, plazo_meses=12, tasa_interes_mensual=0.0185, valor_cuota_pactada=140_000.0, relacion_cuota_ingreso=0.0636,
    canal_originacion="app", politica_aprobacion="Manual", estado_credito_operativo="Vigente", es_moroso=1, probabilidad_mora=0.81,
)


def test_loan_card(spark):
    types = {str: "string", float: "double", int: "int", type(None): "string"}
    scored = spark.createDataFrame([tuple(CARD.values())], ", ".join(f"{k} {types[type(v)]}" for k, v in CARD.items()))
    card = knowledge.loan_cards(scored).first()
    assert card["page_content"].splitlines() == [
        "FICHA DE CRÉDITO — CR1", "Cliente: CL1  |  Ubicación: Bogotá D.C., Cundinamarca",
        "Edad: 30 años  |  Género: F  |  Estrato: 3", "Educación: None  |  Ocupación: Médica",
        "Ingreso mensual estimado: $2,200,000", "Score externo (buró): 580.0", "", "CRÉDITO:", "Producto: Microcrédito",
        "Monto desembolsado: $1,500,000", "Plazo: 12 meses  |  Tasa mensual: 1.85%", "Valor cuota pactada: $140,000",
        "Relación cuota/ingreso: 6.36%", "Canal de originación: app", "Política de aprobación: Manual",
        "Estado operativo del crédito: Vigente", "", "RIESGO:", "¿Es moroso?: SÍ",
        "Probabilidad de mora: 81.0%  →  Nivel de riesgo: CRÍTICO",
    ]
    assert card["metadata"] == {
        "fuente": "ficha_cliente", "cliente_id": "CL1", "credito_id": "CR1", "es_moroso": "1", "probabilidad_mora": "0.81",
        "nivel_riesgo": "CRÍTICO", "producto_credito": "Microcrédito", "departamento": "Cundinamarca",
    }


def test_store_reset_append_and_stable_keys(spark, tmp_path):
    types = {str: "string", float: "double", int: "int", type(None): "string"}
    scored = spark.createDataFrame([tuple(CARD.values())], ", ".join(f"{k} {types[type(v)]}" for k, v in CARD.items()))
    policies = knowledge.policy_documents(spark.createDataFrame([("t", "z " * 700)], "titulo string, texto string"), "titulo", "texto")
    docs = knowledge.all_documents(scored, policies, organisation="ACME", model_lines=["Algoritmo: GBT"], settings=Settings("2024-01-01"))
    summary = docs.where(F.col("metadata")["fuente"] == "resumen_portafolio").first()["page_content"]
    assert summary.startswith("RESUMEN ESTADÍSTICO DEL PORTAFOLIO DE CRÉDITOS — ACME\nFecha de corte: 2024-01-01\n")
    assert "MODELO PREDICTIVO:\n  • Algoritmo: GBT\n\nDESGLOSE POR PRODUCTO:\n  • Microcrédito: 1 créditos, 1 morosos (100.0%), monto promedio $1,500,000\n" in summary
    root = str(tmp_path / "kb")
    first = {r["id"] for r in knowledge.build_store(docs, root).collect()}
    assert len(first) == 4  # card, summary, two chunks of the policy
    assert {r["id"] for r in knowledge.build_store(docs, root).collect()} == first
    assert knowledge.build_store(docs, root, reset=False).count() == 8
    assert knowledge.store_counts({"kb": knowledge.build_store(docs, root)}).first() == (1, 4)
    assert knowledge.all_documents(scored, policies, include_cards=False).count() == 2


def test_vectors_of_different_length_are_an_error(spark):
    rows = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0])], "vec_id bigint, embedding array<double>")
    asked = spark.createDataFrame([(0, [1.0, 0.5]), (1, [0.5, 1.0])], "query_id int, embedding array<double>")
    for most in (1, 2_048):
        with pytest.raises(Exception, match="components"):
            vectors.knn_exact(rows, asked, max_queries=most).collect()
        hits = vectors.knn_exact(rows.where("vec_id < 3"), asked, k=1, max_queries=most)
        assert {(r["query_id"], r["vec_id"]) for r in hits.collect()} == {(0, 1), (1, 2)}


def test_exact_search_does_not_shuffle_the_corpus(spark, capsys):
    corpus, asks, _ = vector_frames(spark)
    vectors.knn_exact(corpus, asks, max_queries=3).explain()
    plan = capsys.readouterr().out
    assert plan.count("hashpartitioning(") == 1 and "Join" not in plan  # only the hits, by query


def test_cells_prune_clustered_data(spark, monkeypatch):
    rng = np.random.default_rng(5)
    data = np.repeat(rng.normal(size=(30, 16)), 40, axis=0) + rng.normal(scale=0.05, size=(1200, 16))
    corpus = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id bigint, embedding array<double>")
    asks = spark.createDataFrame([(i, data[i * 40].tolist()) for i in range(30)], "query_id bigint, embedding array<double>")
    shares = []
    search = vectors._in_cells

    def watched(rows, ids, matrix, visited, *rest):
        sizes = {r["_cell"]: r["count"] for r in rows.groupBy("_cell").count().collect()}
        shares.append(np.mean([sum(sizes.get(int(c), 0) for c in own) for own in visited]) / 1200)
        return search(rows, ids, matrix, visited, *rest)

    monkeypatch.setattr(vectors, "_in_cells", watched)
    key = lambda df: {(r["query_id"], r["vec_id"]) for r in df.collect()}
    exact, approx = key(vectors.knn_exact(corpus, asks)), key(vectors.knn_approx(corpus, asks))
    assert len(exact & approx) / len(exact) >= 0.9 and max(shares) <= 0.1


def test_chunks_are_compared_without_a_shuffle_of_texts(spark, tmp_path):
    from creditlake.queries import QUERIES

    texts = [(1, "corto"), (2, "  una frase de prueba. " * 400), (3, "x" * 5_000), (4, None), (5, "\n\n".join(["linea " * 100] * 30)), (6, "")]
    spark.createDataFrame(texts, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    facts = QUERIES["chunk_documents"](spark, str(tmp_path))
    assert sorted(facts.collect()) == [(i, True, True, True) for i in (1, 2, 3, 5, 6)]
    plan = facts._jdf.queryExecution().executedPlan().toString()
    assert "min_by(starts" in plan and "SortAggregate" not in plan  # flags and numbers are hashed, texts would be sorted
