import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from creditlake.operators import clean, prior_events
from creditlake.operators.dedupe import keep_first
from creditlake.operators.skew import hot_keys, lookup_join
from creditlake.operators.target import default_label
from creditlake.plans import abt
from creditlake.settings import Settings

D = dt.date
CUT = Settings(cutoff_date="2024-06-30")


def day(n):
    return D(2024, 1, 1) + dt.timedelta(days=n)


def loans_and_events(spark, hot=False, seed=3):
    rng = random.Random(seed)
    client = (lambda: "c0" if hot and rng.random() < 0.4 else f"c{rng.randrange(12)}")
    loans = [(f"L{i}", client(), day(rng.randrange(60))) for i in range(300)]
    events = [(client(), day(rng.randrange(60)), rng.choice(["login", "pago_fallido", None]), rng.choice([None, rng.randrange(500)])) for _ in range(900)]
    return (
        spark.createDataFrame(loans, "credito_id string, cliente_id string, fecha_desembolso date"),
        spark.createDataFrame(events, "cliente_id string, fecha_evento date, tipo_evento string, duracion_sesion_seg int"),
    )


def brute_force(loans, events):
    return (
        loans.join(events, "cliente_id")
        .where("fecha_evento < fecha_desembolso")
        .groupBy("credito_id")
        .agg(
            F.count_if(F.col("tipo_evento") == "login").alias("prev_evento_login"),
            F.count_if(F.col("tipo_evento") == "pago_fallido").alias("prev_evento_pago_fallido"),
            F.coalesce(F.sum("duracion_sesion_seg"), F.lit(0)).alias("prev_evento_sesion_seg_tot"),
            F.coalesce(F.avg("duracion_sesion_seg"), F.lit(0.0)).alias("prev_evento_sesion_seg_avg"),
        )
    )


@pytest.mark.parametrize("hot", [False, True])
def test_prior_events_equal_the_pair_join(spark, same_rows, hot):
    loans, events = loans_and_events(spark, hot)
    found = prior_events.event_features_py(loans, events)
    expected = brute_force(loans, events).select(found.columns)
    assert same_rows(found, expected)


def test_hot_clients_are_found_and_salted(spark, same_rows, capsys):
    loans, events = loans_and_events(spark, hot=True)
    assert "c0" in hot_keys(loans, "cliente_id", 0.2)
    assert hot_keys(loans, "cliente_id", 0.2) == ["c0"]
    clients = spark.createDataFrame([(f"c{i}", i) for i in range(12)], "cliente_id string, n int")
    joined = lookup_join(loans, clients, ["cliente_id"], "cliente_id", ["c0"])
    assert joined.count() == 300
    assert same_rows(joined, loans.join(clients, "cliente_id", "left"))
    joined.explain()
    assert "_salt" in capsys.readouterr().out


def test_salting_balances_the_tasks(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        left = spark.range(60_000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
        right = spark.range(60_000).select(F.col("id").alias("k"), F.lit(1).alias("v"))
        largest = {}
        for name, hot in (("plain", []), ("salted", hot_keys(left, "k"))):
            joined = lookup_join(left, right, ["k"], "k", hot)
            sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
            assert sum(sizes) == 60_000
            largest[name] = max(sizes)
        assert largest["plain"] > 28_000 and largest["salted"] < 24_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_label_scan_reads_three_columns_and_pushes_the_cutoff(spark, tmp_path, capsys):
    rows = [("L1", D(2024, 1, 1), 31, 5.0, "PSE")]
    spark.createDataFrame(rows, "credito_id string, fecha_vencimiento date, dias_mora int, valor_pagado double, medio_pago string").write.parquet(str(tmp_path / "p"))
    default_label(clean.clean_pagos(spark.read.parquet(str(tmp_path / "p"))), CUT).explain("formatted")
    plan = capsys.readouterr().out
    assert "LessThanOrEqual(fecha_vencimiento,2024-06-30)" in plan
    assert "ReadSchema: struct<credito_id:string,fecha_vencimiento:date,dias_mora:int>" in plan


def test_events_on_or_after_the_loan_never_matter(spark, same_rows):
    loans, events = loans_and_events(spark)
    late = loans.select("cliente_id", F.col("fecha_desembolso").alias("fecha_evento")).withColumns(
        {"tipo_evento": F.lit("login"), "duracion_sesion_seg": F.lit(99)}
    )
    last = loans.groupBy("cliente_id").agg(F.max("fecha_desembolso").alias("fecha_evento")).withColumns(
        {"tipo_evento": F.lit("futuro"), "duracion_sesion_seg": F.lit(99)}
    )
    one_loan = keep_first(loans, ["cliente_id"], ["credito_id"])
    before = prior_events.event_features_py(one_loan, events)
    same_day = late.join(one_loan.select("cliente_id", F.col("fecha_desembolso").alias("fecha_evento")), ["cliente_id", "fecha_evento"], "left_semi")
    after = prior_events.event_features_py(one_loan, events.unionByName(same_day))
    assert same_rows(before, after)
    assert "futuro" not in prior_events.prior_event_types(loans, events.unionByName(last))


def test_no_prior_events_add_no_columns_unless_types_are_given(spark):
    loans = spark.createDataFrame([("L1", "c1", day(5))], "credito_id string, cliente_id string, fecha_desembolso date")
    events = spark.createDataFrame([("c1", day(5), "login", 10)], "cliente_id string, fecha_evento date, tipo_evento string, duracion_sesion_seg int")
    pagos = spark.createDataFrame([], "credito_id string, fecha_vencimiento date, dias_mora int")
    clientes = spark.createDataFrame([("c1", day(0))], "cliente_id string, fecha_registro date")
    assert not [c for c in abt.build_abt(clientes, loans, pagos, events).columns if "prev_evento" in c]
    fixed = abt.build_abt(clientes, loans, pagos, events, ["login"])
    row = fixed.first()
    assert (row["prev_evento_login"], row["prev_evento_sesion_seg_tot"], row["prev_evento_sesion_seg_avg"]) == (0, 0, 0.0)
    assert (row["antiguedad_cliente_dias"], row["mes_desembolso"], row["dia_semana_desembolso"], row["es_moroso"]) == (5, 1, day(5).weekday(), 0)


def test_untyped_events_only_count_for_the_session(spark, rows_of):
    loans = spark.createDataFrame([("L1", "c1", day(5))], "credito_id string, cliente_id string, fecha_desembolso date")
    events = spark.createDataFrame([("c1", day(1), None, 10), ("c1", day(2), None, None)], "cliente_id string, fecha_evento date, tipo_evento string, duracion_sesion_seg int")
    found = prior_events.event_features_py(loans, events)
    assert found.columns == ["credito_id", "prev_evento_sesion_seg_tot", "prev_evento_sesion_seg_avg"]
    assert rows_of(found) == [("L1", 10, 10.0)]


def test_label_edges(spark, rows_of):
    rows = [
        ("on cutoff", D(2024, 6, 30), 31), ("after cutoff", D(2024, 7, 1), 90), ("undated", None, 90),
        ("limit", D(2024, 1, 1), 30), ("early", D(2024, 1, 1), -5), ("unknown", D(2024, 1, 1), None), (None, D(2024, 1, 1), 90),
        ("worst of two", D(2024, 1, 1), 1), ("worst of two", D(2024, 2, 1), 40),
    ]
    pagos = spark.createDataFrame(rows, "credito_id string, fecha_vencimiento date, dias_mora int")
    assert rows_of(default_label(clean.clean_pagos(pagos), CUT), "credito_id") == [
        ("early", 0), ("limit", 0), ("on cutoff", 1), ("unknown", 0), ("worst of two", 1),
    ]
    undated = default_label(pagos.drop("fecha_vencimiento"), CUT)
    assert dict(rows_of(undated))["after cutoff"] == 1
    with pytest.raises(ValueError):
        default_label(pagos.drop("dias_mora"), CUT)


def test_clean_clients(spark, rows_of):
    df = spark.createDataFrame(
        [("a", None, 17, None), ("b", 10.0, 18, " Bogota D.C."), ("c", 20.0, 110, "bogotá"), ("d", None, 111, "o'brien"), ("e", 40.0, None, "villa 2da")],
        "cliente_id string, ingreso_mensual_estimado double, edad int, ciudad string",
    )
    py = rows_of(clean.clean_clientes_py(df), "cliente_id")  # median age of 17, 18, 110, 111 is 64
    assert py == [("a", 20.0, 64.0, None), ("b", 10.0, 18.0, "Bogotá"), ("c", 20.0, 110.0, "Bogotá"), ("d", 20.0, 64.0, "O'Brien"), ("e", 40.0, None, "Villa 2Da")]
    sql = rows_of(clean.clean_clientes_sql(df), "cliente_id")
    assert [r[1:3] for r in sql] == [(2_200_000.0, 35), (10.0, 18), (20.0, 110), (2_200_000.0, 35), (40.0, None)]
    assert sql[4][3] == "Villa 2da"


def test_all_null_income_stays_null(spark):
    df = spark.createDataFrame([("a", None), ("b", None)], "cliente_id string, ingreso_mensual_estimado double")
    assert clean.clean_clientes_py(df).where("ingreso_mensual_estimado IS NOT NULL").isEmpty()


def test_clean_loans_and_payments(spark, rows_of):
    loans = spark.createDataFrame(
        [("a", "x", 1.0, None), (None, "x", 1.0, "p"), ("b", None, 1.0, "p"), ("c", "x", None, "p")],
        "credito_id string, cliente_id string, monto_credito double, producto_credito string",
    )
    assert rows_of(clean.clean_creditos(loans)) == [("a", "x", 1.0, "Desconocido")]
    assert clean.clean_creditos(loans.drop("monto_credito")).count() == 2
    pagos = spark.createDataFrame([(None, None, -1), (5.0, "PSE", None)], "valor_pagado double, medio_pago string, dias_mora int")
    assert rows_of(clean.clean_pagos(pagos)) == [(0.0, "Desconocido", 0), (5.0, "PSE", None)]
    both = pagos.withColumn("monto_pago", F.lit(None).cast("double"))
    assert [r["monto_pago"] for r in clean.clean_pagos(both).collect()] == [0.0, 0.0]
    assert clean.clean_pagos(both).where("valor_pagado IS NULL").count() == 1


def test_dialects_differ_where_documented(spark):
    clientes = spark.createDataFrame([("c", D(2024, 1, 1), "cali", 30, None)], "cliente_id string, fecha_registro date, ciudad string, edad int, score_externo double").withColumn("ingreso_mensual_estimado", F.lit(5.0)).withColumn("email_hash", F.lit("h"))
    creditos = spark.createDataFrame([("L", "c", D(2024, 1, 8), "p", 1.0)], "credito_id string, cliente_id string, fecha_desembolso date, producto_credito string, monto_credito double").withColumn("estado_credito_operativo", F.lit("x"))
    pagos = spark.createDataFrame([("L", D(2024, 2, 1), 31)], "credito_id string, fecha_vencimiento date, dias_mora int")
    eventos = spark.createDataFrame(
        [("c", D(2024, 1, 2), "simulacion_credito", 10), ("c", D(2024, 1, 3), "simulacion_credito", 11), ("c", D(2024, 1, 4), "otro", 12)],
        "cliente_id string, fecha_evento date, tipo_evento string, duracion_sesion_seg int",
    )
    sources = {"clientes": clientes, "creditos": creditos, "pagos": pagos, "eventos": eventos}
    py, sql = (abt.base_table(sources, mode, CUT).first().asDict() for mode in ("py", "sql"))
    with pytest.raises(ValueError):
        abt.base_table(sources, "r")
    assert (py["dia_semana_desembolso"], sql["dia_semana_desembolso"]) == (0, 1)
    assert py["prev_evento_simulacion_credito"] == sql["prev_evento_simulacion"] == 2
    assert py["prev_evento_otro"] == 1 and "prev_evento_otro" not in sql
    assert (py["score_externo"], sql["score_externo"]) == (None, 580.0)
    assert {"email_hash", "estado_credito_operativo"} <= set(py) and not {"email_hash", "estado_credito_operativo"} & set(sql)
    assert py["es_moroso"] == sql["es_moroso"] == 1


def test_create_table_only_once(spark, tmp_path):
    from creditlake import adapters

    sources = adapters.sources(spark, "/root/testdata/sf0.001")
    try:
        abt.create_abt_table(sources, "abt_una_vez", str(tmp_path / "abt"), adapters.TEST_SETTINGS)
        n = spark.table("abt_una_vez").count()
        abt.create_abt_table({**sources, "creditos": sources["creditos"].limit(0)}, "abt_una_vez", str(tmp_path / "abt"))
        assert spark.table("abt_una_vez").count() == n > 0
        assert spark.table("abt_una_vez").columns == [c for c in abt.SQL_COLUMNS]
    finally:
        spark.sql("DROP TABLE IF EXISTS abt_una_vez")


def test_reports_read_only_what_they_need(spark, capsys):
    from creditlake import adapters
    from creditlake.operators import reports
    from creditlake.plans.abt import abt_sql
    from creditlake.settings import Settings

    tables = adapters.sources(spark, "/root/testdata/sf0.001")
    for report, columns, clients in ((reports.insight_a, reports.INSIGHT_A, True), (reports.insight_b, reports.INSIGHT_B, True), (reports.insight_c, reports.INSIGHT_C, False)):
        report(abt_sql(tables, Settings(), columns)).explain("formatted")
        plan = capsys.readouterr().out
        assert "events.parquet" not in plan and ("customer.parquet" in plan) == clients and "orders.parquet" in plan
    with pytest.raises(ValueError):
        abt_sql(tables, columns=["nada"])


def test_salts_follow_the_weight_of_a_key(spark):
    from creditlake.operators.skew import hot_weights

    loans = spark.range(10_000).selectExpr("id", "CASE WHEN id % 2 = 0 THEN 1 WHEN id % 10 = 1 THEN 2 ELSE 100 + id END AS k")
    weights = hot_weights(loans, "k", 0.05)
    assert weights.keys() == {1, 2} and abs(weights[1] - 0.5) < 1e-9 and abs(weights[2] - 0.1) < 1e-9
    joined = lookup_join(loans, spark.createDataFrame([(1, "a"), (2, "b")], "k bigint, v string"), ["k"], "k", weights)
    assert joined.count() == 10_000 and joined.where("v = 'a'").count() == 5_000 and joined.where("v = 'b'").count() == 1_000


def test_histogram_of_nulls_is_empty(spark):
    from creditlake.operators.profile import histogram

    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert histogram(df, {"x": (F.col("x"), 4)}).columns == ["variable", "bin", "desde", "hasta", "n"]
    assert histogram(df, {"x": (F.col("x"), 4)}).count() == 0
