import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from creditlake.operators import ranks


def frame(spark, values, kind="double"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"id bigint, x {kind}")


SAMPLES = {
    "random": [random.Random(1).gauss(0, 100) for _ in range(997)],
    "two values": [0.0] * 700 + [1.0] * 301,
    "thirds": [0.0] * 300 + [1.0] * 300 + [2.0] * 300,
    "zero heavy": [0.0] * 600 + [float(i) for i in range(400)],
    "one": [3.5],
    "pair": [1.0, 2.0],
    "with nulls": [None, 1.0, None, 4.0, 2.0],
}


@pytest.mark.parametrize("name", SAMPLES)
@pytest.mark.parametrize("limit", [ranks.MAX_VALUES_ON_DRIVER, 20])
def test_order_statistics_are_exact(spark, name, limit):
    values = sorted(v for v in SAMPLES[name] if v is not None)
    n = len(values)
    wanted = sorted({0, n // 3, n // 2, n - 1, int(n * 0.99)})
    found_n, found = ranks.order_statistics(
        frame(spark, SAMPLES[name]), {"x": F.col("x")}, {"x": lambda n: wanted}, values_limit=limit
    )["x"]
    assert found_n == n
    assert found == {r: values[r] for r in wanted}


@pytest.mark.parametrize("limit", [ranks.MAX_VALUES_ON_DRIVER, 20])
def test_order_statistics_of_64_bit_hashes(spark, limit):
    df = spark.range(2000).select(F.xxhash64("id").alias("x"))
    values = sorted(r[0] for r in df.collect())
    wanted = [0, 1, 400, 999, 1999]
    assert ranks.order_statistics(df, {"x": F.col("x")}, {"x": lambda n: wanted}, limit)["x"][1] == {r: values[r] for r in wanted}


def test_quantiles_match_numpy(spark):
    df = frame(spark, SAMPLES["random"]).withColumn("y", F.col("x") * 3 + 1)
    got = ranks.exact_quantiles(df, {"x": F.col("x"), "y": F.col("y")}, [0.25, 0.5, 0.99])
    x = np.array(SAMPLES["random"])
    assert got["x"] == pytest.approx(np.quantile(x, [0.25, 0.5, 0.99]).tolist())
    assert got["y"] == pytest.approx(np.quantile(x * 3 + 1, [0.25, 0.5, 0.99]).tolist())


def test_quantiles_of_nothing_and_of_other_types(spark):
    assert ranks.exact_medians(frame(spark, [None, None]), ["x"]) == {"x": None}
    assert ranks.exact_medians(frame(spark, [1, 2, 3, 10], "int"), ["x"]) == {"x": 2.5}
    assert ranks.exact_medians(frame(spark, [Decimal("1.50"), Decimal("2.25")], "decimal(15,2)"), ["x"]) == {"x": 1.875}
    assert ranks.exact_medians(frame(spark, [1.0, float("nan"), 3.0]), ["x"]) == {"x": 2.0}


@pytest.mark.parametrize("n,k", [(1003, 5), (10, 5), (3, 5), (1000, 7), (1, 2)])
def test_ntile_equals_sparks(spark, same_rows, n, k):
    rng = random.Random(n)
    df = spark.createDataFrame([(i, rng.choice([0, 0, 0, rng.randrange(50)])) for i in range(n)], "id bigint, v int")
    plain = df.withColumn("b", F.ntile(k).over(Window.orderBy("v", "id")))
    assert same_rows(ranks.with_ntile(df, k, "v", F.col("id"), "b"), plain)


def test_ntile_has_no_single_partition_step(spark, capsys):
    df = frame(spark, SAMPLES["zero heavy"])
    ranks.with_ntile(df, 5, "x", F.col("id")).explain()
    plan = capsys.readouterr().out
    assert "Exchange" not in plan and "Window" not in plan


def test_stratified_split_sizes_and_stability(spark, same_rows):
    rows = [(i, int(i % 10 == 0), i * 7919 % 1009) for i in range(1000)]
    df = spark.createDataFrame(rows, "id bigint, y int, h bigint")
    split = ranks.stratified_split(df, "y", F.col("h"), F.col("id"))
    counts = {(r["y"], r["split"]): r["count"] for r in split.groupBy("y", "split").count().collect()}
    assert counts == {(0, "test"): 180, (0, "train"): 720, (1, "test"): 20, (1, "train"): 80}
    again = ranks.stratified_split(df.repartition(7), "y", F.col("h"), F.col("id"))
    assert same_rows(split, again)
    brute = {y: sorted((h, i) for i, t, h in rows if t == y) for y in (0, 1)}
    expected = {i for y in (0, 1) for _, i in brute[y][: round(0.2 * len(brute[y]))]}
    assert {r["id"] for r in split.where("split = 'test'").collect()} == expected


def test_many_ranks_over_many_partitions(spark):
    """Brackets from the sketches of many groups of tasks, heavy ties included, under a small limit in all."""
    rng = np.random.default_rng(3)
    data = np.concatenate([rng.normal(size=9_000).round(3), np.full(9_000, 0.25), rng.integers(-5, 5, 2_000)])
    df = spark.createDataFrame([(float(x),) for x in rng.permutation(data)], "x double").repartition(90)
    wanted = sorted({len(data) * i // 100 for i in range(100)} | {len(data) - 1})
    for limit in (100_000, 500):
        n, at = ranks.order_statistics(df, {"x": F.col("x")}, {"x": lambda n: wanted}, limit)["x"]
        ordered = np.sort(data)
        assert n == len(data) and all(at[r] == ordered[r] for r in wanted)


def test_values_that_a_double_rounds(spark):
    """One value, many equal values, and neighbours beyond 2^53."""
    big = 2**60 + 123
    for values in ([big], [big] * 500, [big + i % 7 for i in range(700)], [-big] * 3 + [big]):
        df = spark.createDataFrame([(v,) for v in values], "v bigint").repartition(3)
        n, at = ranks.order_statistics(df, {"v": F.col("v")}, {"v": lambda n: range(0, n, max(1, n // 9))})["v"]
        assert n == len(values) and all(v == sorted(values)[r] for r, v in at.items())
