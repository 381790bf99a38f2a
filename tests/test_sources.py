import datetime as dt
import json
import logging
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from creditlake.sources import bi_export, readers
from creditlake.sources.upsert import KeyedTable, align_schema, merge_rows

D = dt.date


def test_csv_types_dates_bom_and_quotes(spark, tmp_path, caplog):
    path = tmp_path / "x.csv"
    path.write_text('﻿id,fecha,monto,nota\n1,2024-02-29,10.5,"a, ""b"""\n2,no es fecha,x,\n3,2024-01-05 10:00:00,,c\n', encoding="utf-8")
    with caplog.at_level(logging.WARNING):
        df = readers.read_csv(spark, str(path), "id int, monto double", ["fecha", "fecha_ausente"])
    assert "fecha_ausente" in caplog.text
    assert dict(df.dtypes) == {"id": "int", "fecha": "date", "monto": "double", "nota": "string"}
    assert [tuple(r) for r in df.orderBy("id").collect()] == [
        (1, D(2024, 2, 29), 10.5, 'a, "b"'), (2, None, None, None), (3, D(2024, 1, 5), None, "c"),
    ]
    with pytest.raises(Exception):
        readers.read_csv(spark, str(tmp_path / "absent.csv"))


def test_csv_columns_go_by_name(spark, tmp_path):
    (tmp_path / "x.csv").write_text("b,a\n2,1\n")
    assert readers.read_csv(spark, str(tmp_path / "x.csv"), "a int, b int").first().asDict() == {"b": 2, "a": 1}


def test_read_abt_by_suffix(spark, tmp_path):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    df.write.parquet(str(tmp_path / "abt.parquet"))
    bi_export.write_plain_csv(df, str(tmp_path / "abt.csv"))
    assert readers.read_abt(spark, str(tmp_path / "abt.parquet")).first() == (1, "x")
    assert readers.read_abt(spark, str(tmp_path / "abt.csv"), "a int, b string").first() == (1, "x")


def test_table_counts_with_missing_table(spark):
    spark.range(3).createOrReplaceTempView("tres")
    assert {r["tabla"]: r["filas"] for r in readers.table_counts(spark, ["tres", "ninguna"]).collect()} == {"tres": 3, "ninguna": None}


def lines_of(folder):
    return [line for part in sorted(Path(folder).glob("part-*")) for line in part.read_text(encoding="utf-8").splitlines()]


def test_bi_csv_bytes(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, 1234.5, True, "a,b", D(2024, 1, 2)), (2, 120000000.0, False, None, None), (3, None, None, ' "x" ', None)],
        "id int, monto double, si boolean, texto string, fecha date",
    )
    for _ in range(2):  # a rerun replaces the files
        bi_export.write_bi_csv(df.coalesce(1), str(tmp_path / "t.csv"))
    assert lines_of(tmp_path / "t.csv") == [
        "﻿id,monto,si,texto,fecha", '1,"1234,5",True,"a,b",2024-01-02', '2,"120000000,0",False,,', '3,,," ""x"" ",',
    ]


def test_manifest_file(spark, tmp_path):
    counts = bi_export.manifest({"b": spark.range(2), "a": spark.range(5)})
    assert bi_export.write_manifest(counts, str(tmp_path / "manifest.json")) == {"b": 2, "a": 5}
    assert json.loads("".join(lines_of(tmp_path / "manifest.json")))["tablas"] == {"b": 2, "a": 5}


TARGET = "k int, a string, b double"


def test_align_schema(spark):
    target = spark.createDataFrame([], TARGET).schema
    aligned, missing = align_schema(spark.createDataFrame([("x", 1, 9)], "a string, k bigint, extra int"), target)
    assert aligned.dtypes == [("k", "int"), ("a", "string")] and missing == ["b"]
    nan, _ = align_schema(spark.createDataFrame([(1, float("nan")), (2, 0.5)], "k int, b double"), target)
    assert [r["b"] for r in nan.orderBy("k").collect()] == [None, 0.5]
    with pytest.raises(ValueError):
        align_schema(spark.createDataFrame([(1,)], "z int"), target)


def test_merge_edges(spark, rows_of):
    target = spark.createDataFrame([(1, "old", 1.0), (2, "keep", 2.0)], TARGET)
    source = spark.createDataFrame([(1, "first", 1), (1, None, 2), (3, "new", 1)], "k int, a string, seq int")
    merged = merge_rows(target, source, ["k"], ["seq"])
    # the last duplicate wins even with a null; b is not in the source and stays
    assert rows_of(merged, "k") == [(1, None, 1.0), (2, "keep", 2.0), (3, "new", None)]
    assert rows_of(merge_rows(merged, source, ["k"], ["seq"]), "k") == rows_of(merged, "k")
    keys_only = merge_rows(target, spark.createDataFrame([(2,), (4,)], "k int"), ["k"], ["k"])
    assert rows_of(keys_only, "k") == [(1, "old", 1.0), (2, "keep", 2.0), (4, None, None)]
    with pytest.raises(ValueError):
        merge_rows(target, source.drop("k"), ["k"], ["seq"])


def test_upsert_writes_only_touched_ranges(spark, tmp_path, rows_of):
    path = tmp_path / "t"
    schema = spark.createDataFrame([], TARGET).schema
    table = KeyedTable(spark, str(path), schema, ("k",), 10)
    assert table.read().count() == 0  # nothing was written yet
    assert table.upsert(spark.createDataFrame([(1, "x"), (12, "x"), (25, "x"), (-3, "n")], "k int, a string")) == 4
    table.upsert(spark.createDataFrame([(1, 1.0), (12, 2.0)], "k int, b double"))
    files = {f: f.stat().st_mtime_ns for f in path.rglob("*.parquet")}
    assert table.upsert(spark.createDataFrame([], "k int, a string")) == 0
    late = spark.createDataFrame([(12, "old", 1), (12, "new", 2), (17, None, 1), (None, "null key", 1)], "k int, a string, seq int")
    assert table.upsert(late, ["seq"]) == 3
    assert rows_of(table.read(), F.col("k").asc_nulls_first()) == [
        (None, "null key", None), (-3, "n", None), (1, "x", 1.0), (12, "new", 2.0), (17, None, None), (25, "x", None)
    ]
    now = {f: f.stat().st_mtime_ns for f in path.rglob("*.parquet")}
    kept = {f: t for f, t in files.items() if f.parent.name in ("_part=0", "_part=2")}
    assert len(kept) >= 2 and all(now.get(f) == t for f, t in kept.items())
    assert not [f for f in files if f.parent.name == "_part=1" and f in now]
    assert {f.name for f in path.iterdir() if not f.name.startswith("_part=")} <= {"_SUCCESS", "._SUCCESS.crc"}


def test_upsert_edges(spark, tmp_path, rows_of):
    schema = spark.createDataFrame([], "k string, a string").schema
    table = KeyedTable(spark, str(tmp_path / "t"), schema, ("k",), 4)
    table.replace(spark.createDataFrame([(f"C{i}", "x") for i in range(9)], schema))
    assert table.upsert(spark.createDataFrame([("C3",), ("C99",)], "k string")) == 1  # of keys alone, only new ones count
    assert table.read().count() == 10 and table.read().where("a IS NULL").count() == 1
    with pytest.raises(ValueError, match="last"):
        table.upsert(spark.createDataFrame([("C5", "a"), ("C5", "b")], schema))
    with pytest.raises(ValueError, match="missing"):
        table.upsert(spark.createDataFrame([("a",)], "a string"))
    table.replace(spark.createDataFrame([("Z", "z")], schema))
    assert rows_of(table.read()) == [("Z", "z")]


def test_hot_duplicate_keys_are_dropped_before_the_shuffle(spark, capsys):
    from creditlake.operators.dedupe import keep_last

    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    last = keep_last(df, ["k"], ["id"])
    assert sorted(tuple(r) for r in last.collect()) == [(0, 999), (1, 997), (2, 998)]
    last.explain()
    plan = capsys.readouterr().out
    assert plan.rindex("WindowGroupLimit") > plan.index("Exchange")  # the partial limit sits below the exchange


def test_dates_in_several_formats(spark, tmp_path, rows_of):
    lines = ["id,d", "1,2024-01-15", "2,2024/01/15", "3,20240115", "4,15-01-2024", "5,15/01/2024", "6,2024-13-45", "7,", "8,2024-01-15 10:00:00"]
    (tmp_path / "d.csv").write_text("\n".join(lines))
    read = readers.read_csv(spark, str(tmp_path / "d.csv"), "id int", ["d"])
    assert [str(r.d) for r in read.orderBy("id").collect()] == ["2024-01-15"] * 5 + ["None", "None", "2024-01-15"]
    assert rows_of(readers.lost_dates(spark, str(tmp_path / "d.csv"), ["d", "absent"])) == [("d", 1)]


def test_base_table_types_from_csv(spark, tmp_path):
    (tmp_path / "abt.csv").write_text("credito_id,monto_credito,edad,es_moroso,prev_evento_login,otra\nC1,10.5,30,1,2,x\n")
    types = dict(readers.read_abt(spark, str(tmp_path / "abt.csv")).dtypes)
    assert types["es_moroso"] == "bigint" and types["prev_evento_login"] == "double" and types["edad"] == "int"
    assert types["monto_credito"] == "double" and types["otra"] == types["credito_id"] == "string"


def test_text_of_floats_is_worked_out_by_one_expression(spark):
    """However many float columns there are, their order and types, so that the code for a row stays short."""
    df = spark.range(3).selectExpr("CAST(id AS DOUBLE) + 0.5 AS a", "id", "CAST(id AS FLOAT) AS b", "id = 1 AS t", "CAST(id AS DECIMAL(5, 2)) AS c", *[f"IF(id = 1, 'NaN', id * 1e17) AS d{i}" for i in range(5)])
    df = df.withColumns({f"d{i}": F.col(f"d{i}").cast("double") for i in range(5)})
    text = bi_export.localised(df)
    assert text.columns == df.columns and {t for _, t in text.dtypes} == {"string"}
    assert [tuple(r) for r in text.collect()] == [("0,5", "0", "0,0", "False", "0,0", *["0,0"] * 5), ("1,5", "1", "1,0", "True", "1,0", *[None] * 5), ("2,5", "2", "2,0", "False", "2,0", *["2e+17"] * 5)]
    assert text._jdf.queryExecution().optimizedPlan().toString().count("lpad") == 1


def test_first_upsert_joins_nothing(spark, tmp_path, rows_of, monkeypatch):
    """Into a table without files go the last rows by key, absent columns null, without the join of a merge."""
    from creditlake.sources import upsert

    merges = []
    monkeypatch.setattr(upsert, "merge_rows", lambda *a: merges.append(a) or merge_rows(*a))
    schema = spark.createDataFrame([], "k bigint, a string, b double").schema
    table = KeyedTable(spark, str(tmp_path / "t"), schema, ("k",), 10)
    source = spark.createDataFrame([(1, 1, "x"), (1, 2, "y"), (25, 1, None), (None, 1, "n")], "k bigint, at int, a string")
    assert table.read().count() == 0
    assert table.upsert(source, ["at"]) == 3 and not merges
    assert sorted(rows_of(table.read()), key=str) == sorted([(1, "y", None), (25, None, None), (None, "n", None)], key=str)
    assert table.upsert(spark.createDataFrame([(25, 2.5)], "k bigint, b double")) == 1 and len(merges) == 1
    assert (25, None, 2.5) in rows_of(table.read()) and table.read().count() == 3
