import datetime as dt

import pytest
from pyspark.sql import functions as F

from creditlake.functions import dates, numbers, text

CITIES = [" Bogota D.C.", "bogotá", "o'brien", "villa 2da etapa", "SANTA marta", "medellin ", " cali\t", "puerto-lopez", "", "ñandú 3x"]


def column(spark, values, kind, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.select("i", f(F.col("x")).alias("y")).orderBy("i").select("y").collect()]


def test_title_is_pythons(spark):
    assert column(spark, CITIES + [None], "string", text.title_py) == [c.title() for c in CITIES] + [None]


def test_strip_is_pythons(spark):
    assert column(spark, CITIES, "string", text.strip_py) == [c.strip() for c in CITIES]


def test_initcap_keeps_digits_in_the_word(spark):
    assert column(spark, ["villa 2da", "o'brien", "bogota d.c."], "string", text.initcap_pg) == ["Villa 2da", "O'Brien", "Bogota D.C."]


def test_city_dialects(spark):
    values = ["bogot", " Bogota D.C.", "medellin ", "\tcali ", "cali", "ibagué", "villa 2da", None]
    assert column(spark, values, "string", text.city_py) == [
        "Bogotá", "Bogotá", "Medellín", "Cali", "Cali", "Ibagué", "Villa 2Da", None,
    ]
    assert column(spark, values, "string", text.city_sql)[:3] == ["Bogotá", "Bogotá", "Medellín"]
    assert column(spark, values, "string", text.city_sql)[4:] == ["Cali", "Ibagué", "Villa 2da", None]
    # untrimmed original in the py fallback
    assert column(spark, [" santa marta "], "string", text.city_py) == [" Santa Marta "]
    assert column(spark, [" santa marta "], "string", text.city_sql) == ["Santa Marta"]


FLOATS = [0.0, 1.0, -2.5, 0.1, 1234.5, 9999999.0, 1e7, 120000000.0, 123456789.125, 1e15, 1e16, 1.5e22, 0.001, 0.0005, 1e-4, 1e-5, 2.5e-7, -1e-12]


def test_float_text_is_pythons_repr(spark):
    assert column(spark, FLOATS + [None], "double", numbers.float_text) == [repr(x) for x in FLOATS] + [None]


def test_money_and_percent_round_half_to_even(spark):
    amounts = [0.5, 1.5, 2.5, 12345.5, 1e6, 999.4999]
    assert column(spark, amounts, "double", numbers.grouped_int) == [f"{x:,.0f}" for x in amounts]
    shares = [0.125, 0.1, 0.3333, 12.5, 0.0]
    assert column(spark, shares, "double", lambda c: numbers.percent(c, 1)) == [f"{x:.1%}" for x in shares]
    assert column(spark, shares, "double", lambda c: numbers.percent(c, 2)) == [f"{x:.2%}" for x in shares]


@pytest.mark.parametrize("f,values,bands", [
    (numbers.score_band, [399.0, 400.0, 550.0, 551.0, 700.0, 701.0, None], [0, 1, 1, 2, 2, 3, 3]),
])
def test_score_bands(spark, f, values, bands):
    assert column(spark, values, "double", f) == [numbers.SCORE_BANDS[b] for b in bands]


def test_risk_levels_and_decision(spark):
    p = [0.0, 0.1999, 0.2, 0.4999, 0.5, 0.8, 1.0]
    assert column(spark, p, "double", numbers.risk_level) == ["BAJO", "BAJO", "MEDIO", "MEDIO", "ALTO", "CRÍTICO", "CRÍTICO"]
    assert column(spark, [0.4999, 0.5], "double", numbers.decision) == ["APROBADO", "RECHAZADO"]


def test_amount_bands_are_closed_on_the_left(spark):
    edges = [1.0, 499_999.0, 500_000.0, 1e6, 2e6, 5e6, 1e7, None]
    labels = [b for _, b in numbers.AMOUNT_BANDS]
    expected = [labels[0], labels[0], *labels[1:], None]
    assert column(spark, edges, "double", numbers.amount_band) == expected


def test_calendar_fields(spark):
    days = [dt.date(2024, 2, 29), dt.date(2023, 12, 31), dt.date(2024, 1, 1)]
    assert column(spark, days, "date", dates.date_key) == [20240229, 20231231, 20240101]
    assert column(spark, days, "date", dates.month_name) == ["February", "December", "January"]
    assert column(spark, days, "date", dates.weekday_monday0) == [d.weekday() for d in days]
    assert column(spark, days, "date", dates.weekday_monday1) == [d.isoweekday() for d in days]
