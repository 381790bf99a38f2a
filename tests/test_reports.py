import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditlake.operators import metrics, profile, quality, reports
from creditlake.plans import star

D = dt.date


def test_amount_bands_reproduce_known_totals(spark, rows_of):
    # loans and defaulters per band as published for one run of the reference data
    published = [(78, 19, 24.4), (234, 80, 34.2), (496, 125, 25.2), (553, 144, 26.0), (139, 41, 29.5), (27, 7, 25.9)]
    amounts = (100.0, 5e5, 1e6, 2e6, 5e6, 1e7)
    rows = [(a, int(i < bad)) for a, (n, bad, _) in zip(amounts, published) for i in range(n)]
    report = rows_of(reports.rate_by_amount_band(spark.createDataFrame(rows, "monto_credito double, es_moroso int")), "rango")
    assert [r[1:] for r in report] == [*published, (1527, 416, 27.2)]


def test_insight_a_drops_small_groups(spark, rows_of):
    rows = [("a", 1, int(i < 3), 10.0) for i in range(11)] + [("b", None, 1, 5.0)] * 10 + [("c", None, 0, 5.0)] * 12
    df = spark.createDataFrame(rows, "ocupacion string, estrato int, es_moroso int, monto_credito double")
    assert rows_of(reports.insight_a(df)) == [("a", 1, 11, 3, 27.27, 10.0), ("c", None, 12, 0, 0.0, 5.0)]


def test_insight_d_with_text_ids(spark):
    rows = [(f"CR{i:05d}", i % 2, i % 3, 0, 0 if i < 60 else i) for i in range(101)]
    abt = spark.createDataFrame(rows, "credito_id string, es_moroso int, prev_evento_pago_fallido int, prev_evento_simulacion_credito int, prev_evento_sesion_seg_tot int")
    found = reports.insight_d(abt).collect()
    assert [(r["quintil_sesion"], r["total_clientes"]) for r in found] == [(1, 21), (2, 20), (3, 20), (4, 20), (5, 20)]
    assert sum(r["morosos"] for r in found) == 50
    assert reports.session_quintiles(abt).where("quintil_sesion = 5").agg(F.min("prev_evento_sesion_seg_tot")).first()[0] == 81


def test_segment_without_loans(spark):
    df = spark.createDataFrame([("x", 1)], "ciudad string, es_moroso int")
    assert reports.segment_rate(df, ciudad="y").first() == (0, 0, None)


def test_portfolio_breakdowns_skip_null_groups(spark, rows_of):
    df = spark.createDataFrame(
        [("1", None, "d1", 1, 10.0, "p"), ("2", "web", "d2", 1, 30.0, None), ("3", "web", "d2", 0, 20.0, "p")],
        "credito_id string, canal_originacion string, departamento string, es_moroso int, monto_credito double, producto_credito string",
    )
    assert rows_of(reports.portfolio_by_channel(df)) == [("web", 2, 1)]
    assert rows_of(reports.portfolio_by_product(df)) == [("p", 2, 1, 15.0)]
    assert rows_of(reports.top_departments(df, 1)) == [("d1", 1, 1)]
    total = reports.portfolio_totals(df).first()
    assert (total["total"], total["morosos"], total["monto_total"], total["monto_en_riesgo"], total["monto_sano"]) == (3, 2, 60.0, 40.0, 20.0)


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0, 5.0), (1.0, 5.0), (9.99, None), (10.0, 5.0), (None, 5.0)], "x double, c double")
    h = profile.histogram(df, {"x": (F.col("x"), 10), "c": (F.col("c"), 2)})
    x = {r["bin"]: r["n"] for r in h.where("variable = 'x'").collect()}
    counts, _ = np.histogram([0.0, 1.0, 9.99, 10.0], bins=10)
    assert [x[b] for b in range(10)] == counts.tolist()
    c = [(r["bin"], r["desde"], r["hasta"], r["n"]) for r in h.where("variable = 'c'").orderBy("bin").collect()]
    assert c == [(0, 4.5, 5.0, 0), (1, 5.0, 5.5, 4)]


def test_correlation_is_pairwise_complete(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(1e6, 1.0, 500)
    y, z = x + rng.normal(0, 1, 500), rng.normal(0, 5, 500)
    rows = [(float(a), None if i % 7 == 0 else float(b), float(c), 1.0) for i, (a, b, c) in enumerate(zip(x, y, z))]
    df = spark.createDataFrame(rows, "x double, y double, z double, fijo double")
    got = {(r["x"], r["y"]): r["corr"] for r in profile.corr_matrix(df).collect()}
    assert len(got) == 16
    keep = np.arange(500) % 7 != 0
    assert got["x", "z"] == pytest.approx(np.corrcoef(x, z)[0, 1], abs=1e-9)
    assert got["y", "x"] == got["x", "y"] == pytest.approx(np.corrcoef(x[keep], y[keep])[0, 1], abs=1e-9)
    assert got["x", "x"] == pytest.approx(1.0) and got["x", "fijo"] is None


def test_box_statistics(spark):
    values = [1.0, 2.0, 3.0, 4.0, 100.0]
    df = spark.createDataFrame([(0, v) for v in values] + [(1, 7.0)], "es_moroso int, r double")
    zero, one = profile.box_stats(df, "es_moroso", "r").orderBy("es_moroso").collect()
    assert tuple(zero) == (0, 5, 2.0, 3.0, 4.0, 1.0, 4.0, 1)
    assert tuple(one) == (1, 1, 7.0, 7.0, 7.0, 7.0, 7.0, 0)


def test_quality_checks(spark, rows_of):
    a = spark.createDataFrame([("1", "x"), ("2", None), ("2", "y"), (None, "z")], "cliente_id string, ciudad string")
    b = spark.createDataFrame([("L1", "1", 1e13), ("L2", None, 9_999_999_999_999.99), ("L3", "7", None)], "credito_id string, cliente_id string, monto_credito double")
    tables = {"clientes": a, "creditos": b}
    assert rows_of(quality.pk_check(tables), "tabla") == [("clientes", "cliente_id", 4, 2, 1, False), ("creditos", "credito_id", 3, 3, 0, True)]
    assert rows_of(quality.fk_orphans(tables, [("creditos", "cliente_id", "clientes", "cliente_id")])) == [("creditos", "cliente_id", 2)]
    assert rows_of(quality.null_profile(tables), "tabla", "columna") == [
        ("clientes", "ciudad", 1), ("clientes", "cliente_id", 1), ("creditos", "cliente_id", 1), ("creditos", "monto_credito", 1),
    ]
    limits = {"clientes": {"ciudad": 0, "ausente": 3}, "creditos": {"monto_credito": (15, 2)}}
    assert rows_of(quality.type_limits(tables, limits), "tabla") == [
        ("clientes", "ciudad", "VARCHAR(0)", 3), ("creditos", "monto_credito", "NUMERIC(15,2)", 1),
    ]
    assert rows_of(quality.table_profile({"clientes": a}), "posicion") == [
        ("clientes", 4, 1, "cliente_id", "string"), ("clientes", 4, 2, "ciudad", "string"),
    ]


def test_two_null_keys_are_not_unique_but_one_is(spark):
    one = spark.createDataFrame([("a",), (None,)], "cliente_id string")
    assert quality.pk_check({"clientes": one}).first()["es_unica"]
    assert not quality.pk_check({"clientes": one.union(one.limit(0)).unionAll(spark.createDataFrame([(None,)], "cliente_id string"))}).first()["es_unica"]


SCORED = "es_moroso int, prediccion_mora bigint, probabilidad_mora double"


def test_auc_edges(spark):
    def auc(rows):
        return metrics.roc_auc(spark.createDataFrame([(y, 0, p) for y, p in rows], SCORED))

    assert auc([(1, 0.9), (0, 0.1)]) == 1.0
    assert auc([(0, 0.9), (1, 0.1)]) == 0.0
    assert auc([(1, 0.5), (0, 0.5), (0, 0.5)]) == 0.5
    assert auc([(1, 0.5), (1, 0.7)]) is None
    rng = np.random.default_rng(5)
    rows = [(int(rng.random() < 0.3), round(float(rng.random()), 1)) for _ in range(300)]
    pos, neg = [p for y, p in rows if y], [p for y, p in rows if not y]
    brute = np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])
    assert auc(rows) == pytest.approx(brute)


def test_confusion_and_report(spark, rows_of):
    df = spark.createDataFrame([(1, 1, 0.9)] * 3 + [(1, 0, 0.1)] + [(0, 1, 0.8)] * 2 + [(0, 0, 0.2)] * 4, SCORED)
    assert rows_of(metrics.confusion_matrix(df), "real", "prediccion") == [(0, 0, 4), (0, 1, 2), (1, 0, 1), (1, 1, 3)]
    report = {r["clase"]: r for r in metrics.classification_report(df).collect()}
    assert (report["1"]["precision"], report["1"]["recall"], report["1"]["support"]) == (0.6, 0.75, 4)
    assert report["accuracy"]["f1"] == 0.7 and report["weighted avg"]["recall"] == pytest.approx(0.7)
    one_class = metrics.classification_report(df.where("es_moroso = 0 AND prediccion_mora = 0")).collect()
    assert one_class[1]["precision"] == 0.0
    weights = rows_of(metrics.class_weights(df))
    assert weights == [(0, 6, pytest.approx(10 / 12)), (1, 4, 1.25)]


def test_income_cap_per_dialect(spark):
    rows = [(f"c{i}", float(i), 2) for i in range(101)] + [("rich3", 500.0, 3), ("rich4", 501.0, 4), ("rich0", 502.0, None), ("none", None, 1)]
    df = spark.createDataFrame(rows, "cliente_id string, ingreso_mensual_estimado double, estrato int")
    p99 = float(np.quantile([r[1] for r in rows if r[1] is not None], 0.99))
    py = {r["cliente_id"]: r for r in star.with_bi_income(df).collect()}
    sql = {r["cliente_id"]: r for r in star.clients_bi(df).collect()}
    for by in (py, sql):
        flagged = {k: r["flag_ingreso"] for k, r in by.items() if r["flag_ingreso"] != "normal"}
        assert flagged == {k: ("error_captura" if k == "rich3" else "outlier_real") for k in flagged} and "rich4" in flagged
        assert by["rich4"]["ingreso_mensual_bi"] == pytest.approx(p99)
    assert py["none"]["ingreso_mensual_bi"] is None and sql["none"]["ingreso_mensual_bi"] == pytest.approx(p99)


def test_dimensions(spark, rows_of):
    df = spark.createDataFrame(
        [("L2", "c1", D(2024, 3, 1), "b", "Cali"), ("L1", "c1", D(2024, 2, 28), None, "Pasto"), ("L3", "c2", None, "a", "Neiva")],
        "credito_id string, cliente_id string, fecha_desembolso date, producto_credito string, ciudad string",
    )
    assert rows_of(star.dim_producto(df), "producto_credito_id") == [(1, "a", "a"), (2, "b", "b"), (3, None, "Desconocido")]
    assert rows_of(star.dim_cliente(df), "cliente_id") == [("c1", "Pasto"), ("c2", "Neiva")]
    days = rows_of(star.dim_tiempo(df), "fecha")
    assert [d[1] for d in days] == [20240228, 20240229, 20240301]
    assert days[1] == (D(2024, 2, 29), 20240229, 2024, 2, "February", 1, 4)
    assert star.dim_tiempo(df.where("fecha_desembolso IS NULL")).count() == 0
    profile_rows = star.perfil_cliente(df.withColumns({"es_moroso": F.lit(1), "monto_credito": F.lit(2.0), "probabilidad_mora": F.lit(0.5)}))
    c1 = profile_rows.where("cliente_id = 'c1'").first()
    assert (c1["creditos_total"], c1["creditos_morosos"], c1["monto_total_credito"], c1["tasa_mora_cliente"], c1["ultima_fecha_desembolso"]) == (2, 2, 4.0, 1.0, D(2024, 3, 1))
