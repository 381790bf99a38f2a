import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditlake import adapters
from creditlake.operators import boosting
from creditlake.plans import model, refresh
from creditlake.sources.schemas import SOURCE_FILES


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(0)
    data = []
    for i in range(600):
        x = rng.random()
        data.append((f"CR{i}", x, None if rng.random() < 0.2 else rng.random(), rng.choice(["a", "b", None]), rng.random() < 0.5, int(x + rng.gauss(0, 0.2) > 0.6)))
    df = spark.createDataFrame(data, "credito_id string, score_externo double, monto_credito double, ciudad string, tiene_producto_ahorro boolean, es_moroso int")
    return df.withColumn("fecha_desembolso", F.lit("2024-01-01").cast("date")).withColumn("estado_credito_operativo", F.lit("x"))


def test_feature_columns_exclude_ids_dates_and_leaks(rows):
    extra = rows.withColumns({"fecha_texto": F.lit("x"), "alta": F.current_timestamp(), "email_hash": F.lit("h"), "probabilidad_mora": F.lit(0.1)})
    assert model.feature_columns(extra.schema) == ["score_externo", "monto_credito", "ciudad", "tiene_producto_ahorro"]


def test_train_score_save_load(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(model, "TREES", 8)
    monkeypatch.setattr(model, "LEARNING_RATE", 0.3)
    split = model.split_train_test(rows).cache()
    assert split.where("split = 'test'").count() in (119, 120, 121)
    features = model.feature_columns(rows.schema)
    fitted = model.train(split.where("split = 'train'"), features)
    from creditlake.operators.metrics import roc_auc

    test = model.score_book(fitted, split.where("split = 'test'"))
    assert roc_auc(test) > 0.85
    assert model.feature_importance(fitted, 1).first()["feature"] == "score_externo"
    counts = {r["feature"]: r["importancia"] for r in model.feature_importance(fitted).collect()}
    assert set(counts) == set(features) and sum(counts.values()) == fitted.nodes().where("feature IS NOT NULL").count()
    model.save_model(fitted, features, str(tmp_path / "m"))
    loaded, names = model.load_model(spark, str(tmp_path / "m"))
    assert names == features
    a = [r[0] for r in model.score_book(fitted, rows).orderBy("credito_id").select("probabilidad_mora").collect()]
    b = [r[0] for r in model.score_book(loaded, rows).orderBy("credito_id").select("probabilidad_mora").collect()]
    assert a == b
    applicants = spark.createDataFrame([("s1", 0.95, "nunca visto"), ("s2", 0.05, None)], "id string, score_externo double, ciudad string")
    scored = {r["id"]: r for r in model.score_applicants(loaded, names, applicants, "id").collect()}
    assert scored["s1"]["decision"] == "RECHAZADO" and scored["s2"]["decision"] == "APROBADO"
    assert scored["s1"]["score_riesgo_mora"] == round(scored["s1"]["score_riesgo_mora"], 4)


def test_one_class_cannot_be_trained(rows):
    with pytest.raises(ValueError):
        model.train(rows.where("es_moroso = 1"))


def test_defaults_for_absent_fields(spark):
    row = model.with_default_features(spark.createDataFrame([(30,)], "edad int"), ["edad", "estrato", "tiene_producto_ahorro", "ciudad"]).first()
    assert tuple(row) == (30, 0.0, False, "Desconocido")


def test_refresh_from_csv(spark, tmp_path, monkeypatch):
    """The whole run on CSV files, whose ids are text."""
    monkeypatch.setattr(model, "TREES", 3)
    sf = "/root/testdata/sf0.001"
    for name, df in adapters.sources(spark, sf).items():
        df.write.options(header=True, escape='"').csv(f"{tmp_path}/raw/{SOURCE_FILES[name]}")
    result = refresh.refresh_from_csv(spark, f"{tmp_path}/raw", f"{tmp_path}/out", adapters.TEST_SETTINGS)
    loans = adapters.source(spark, sf, "creditos").where("cliente_id IS NOT NULL").count()
    assert result.upserted == loans
    assert result.lake_counts["fact_creditos"] == result.lake_counts["abt_analitica_riesgo"] == loans
    assert result.lake_counts["dim_producto_credito"] == 5
    assert 0.0 <= result.test_auc <= 1.0
    stored = spark.read.parquet(f"{tmp_path}/out/predicciones_riesgo").drop("_part")
    assert stored.count() == loans and not [c for c in stored.columns if c.startswith("prev_evento")]


def test_raw_load_is_idempotent(spark, tmp_path):
    sources = adapters.sources(spark, "/root/testdata/sf0.001")
    small = {n: sources[n] for n in ("clientes", "creditos", "pagos", "eventos")}
    refresh.load_raw(spark, small, str(tmp_path))
    counts = {n: spark.read.parquet(f"{tmp_path}/{n}").count() for n in small}
    refresh.load_raw(spark, small, str(tmp_path))
    assert {n: spark.read.parquet(f"{tmp_path}/{n}").count() for n in small} == counts


def test_nulls_that_training_never_saw(spark, rows):
    """Scoring rows may lack any value, also of columns that were complete, or empty, in training."""
    complete = rows.fillna(0.5, ["score_externo"]).withColumn("vacia", F.lit(None).cast("double"))
    features = [c for c in model.feature_columns(complete.schema)]
    fitted = model.train(complete, features)
    blank = complete.limit(20).select(*[F.lit(None).cast(t).alias(c) if c in features else F.col(c) for c, t in complete.dtypes])
    scored = model.score_book(fitted, blank.withColumn("vacia", F.lit(3.0))).collect()
    assert len(scored) == 20 and all(0 <= r["probabilidad_mora"] <= 1 for r in scored)


def plain_tree(x, y, w, depth, leaves, least, rate):
    """[(rows, value)] of the leaves of the first tree, grown leaf by leaf over all cuts of all columns."""
    g, h = w * (0.5 - y), w * 0.25

    def best(rows):
        found = None
        for left_nulls in (False, True):
            for f in range(x.shape[1]):
                v = x[rows, f]
                for t in np.unique(v[~np.isnan(v)]):
                    left = np.where(np.isnan(v), left_nulls, v <= t)
                    if min(left.sum(), (~left).sum()) < least:
                        continue
                    parts = [(g[rows][m].sum(), h[rows][m].sum()) for m in (left, ~left)]
                    gain = sum(a * a / b for a, b in parts) - g[rows].sum() ** 2 / h[rows].sum()
                    if gain > 1e-9 and (found is None or gain > found[0] + 1e-9):
                        found = gain, rows[left], rows[~left]
        return found

    done, waiting = [], [(np.arange(len(y)), 0)]
    while len(done) + len(waiting) < leaves:
        candidates = [(best(r) if d < depth else None, r, d) for r, d in waiting]
        candidates = [c for c in candidates if c[0]]
        if not candidates:
            break
        (_, a, b), rows, d = max(candidates, key=lambda c: c[0][0])
        waiting = [q for q in waiting if q[0] is not rows] + [(a, d + 1), (b, d + 1)]
    return sorted((len(r), round(-rate * g[r].sum() / h[r].sum(), 9)) for r, _ in waiting)


@pytest.mark.parametrize("leaves", [2, 5, 15])
def test_trees_grow_like_a_plain_one(spark, leaves):
    rng = np.random.default_rng(leaves)
    x = rng.integers(0, 12, (500, 3)).astype(float)
    x[rng.random((500, 3)) < 0.15] = np.nan
    y = ((np.nan_to_num(x[:, 0], nan=9) > 6) ^ (np.nan_to_num(x[:, 1], nan=2) > 3) ^ (rng.random(500) < 0.1)).astype(float)
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    df = spark.createDataFrame([(*(None if np.isnan(v) else float(v) for v in r), float(a), float(b)) for r, a, b in zip(x, y, w)], "a double, b double, c double, y double, w double")
    base, trees = boosting.boost(df.repartition(3), ["a", "b", "c"], "y", "w", trees=1, rate=0.1, depth=4, leaves=leaves, least_rows=30)
    nodes = boosting.node_rows(trees, ["a", "b", "c"])
    found = sorted((n[6], round(n[5], 9)) for n in nodes if n[2] is None)
    assert abs(base) < 1e-9 and len(found) <= leaves
    assert found == plain_tree(x, y, w, 4, leaves, 30, 0.1)


def test_more_tasks_than_mergers_and_kept_scores(spark, monkeypatch):
    df = spark.range(400).selectExpr("CAST(id % 20 AS DOUBLE) AS a", "CAST(id % 20 > 11 OR id % 7 = 0 AS DOUBLE) AS y", "1.0D AS w")
    ask = lambda: boosting.boost(df.repartition(6), ["a"], "y", "w", trees=4, rate=0.3, depth=2, leaves=4, least_rows=5)
    first = boosting.node_rows(ask()[1], ["a"])
    monkeypatch.setattr(boosting, "MERGERS", 2)
    monkeypatch.setattr(boosting, "KEPT_TREES", 2)
    second = boosting.node_rows(ask()[1], ["a"])
    assert [n[:5] for n in first] == [n[:5] for n in second]
    assert np.allclose([n[5] for n in first], [n[5] for n in second])


def test_many_categories_and_nulls_are_learnt(spark, monkeypatch):
    """A text column of 20,000 values, most of them once, and a number whose null means default."""
    monkeypatch.setattr(model, "TREES", 5)
    monkeypatch.setattr(model, "LEARNING_RATE", 0.5)
    df = spark.range(40_000).selectExpr(
        "CAST(id AS STRING) AS credito_id", "CAST(IF(id % 2 = 0, id % 10, id) AS STRING) AS ciudad", "IF(id % 4 = 1, NULL, CAST(id % 97 AS DOUBLE)) AS monto_credito",
        "CAST(IF(id % 2 = 0, id % 10 IN (2, 6), id % 4 = 1) AS INT) AS es_moroso",
    )
    fitted = model.train(df)
    from creditlake.operators.metrics import roc_auc

    assert roc_auc(model.score_book(fitted, df)) > 0.97
    unknown = spark.createDataFrame([("x", None, None), ("y", "nunca visto", 5.0)], "credito_id string, ciudad string, monto_credito double")
    assert all(0 < r["probabilidad_mora"] < 1 for r in model.score_book(fitted, unknown).collect())


def test_bins_are_blocks_and_their_leaves_those_of_the_values(spark, monkeypatch):
    """Bins of many rows are one row of the written table; a tree sends bins where it sends the values they hold."""
    kept = []
    plain = boosting.stage
    monkeypatch.setattr(boosting, "stage", lambda df, name, **o: kept.append((name, plain(df, name, **o))) or kept[-1][1])
    df = spark.range(50_000).selectExpr("IF(id % 11 = 0, NULL, CAST(id % 20 AS DOUBLE)) AS a", "CAST(id % 7 AS DOUBLE) AS b", "CAST(id % 20 > 11 OR id % 7 = 0 AS DOUBLE) AS y", "1.0D AS w")
    _, trees = boosting.boost(df.coalesce(2), ["a", "b"], "y", "w", trees=1, rate=0.3, depth=3, leaves=8, least_rows=5)
    blocks = next(found for name, found in kept if name == "bins").collect()
    assert len(blocks) < 8 and sum(len(r["bins"]) for r in blocks) == 100_000 and sum(len(r["y"]) for r in blocks) == 400_000
    values = np.array([[np.nan, *range(20)], [0.0] * 21]).T
    as_bins = np.vstack([np.array([boosting.BINS, *range(20)], np.uint8), np.zeros(21, np.uint8)])
    assert trees[0].leaf_of_bins(as_bins, boosting.BINS).tolist() == trees[0].leaf_of(values, np.isnan(values)).tolist()


def test_means_over_the_other_folds_are_columns_of_the_category(spark, monkeypatch):
    kept = {}
    plain = model.stage
    monkeypatch.setattr(model, "stage", lambda df, name, **o: kept.setdefault(name + str(len(kept)), plain(df, name, **o)))
    df = spark.range(3_000).selectExpr("CAST(id AS STRING) AS credito_id", "CAST(id % 3 AS STRING) AS ciudad", "CAST(id % 97 AS DOUBLE) AS edad", "CAST(id % 5 = 0 AS INT) AS es_moroso")
    model.train(df, trees=1)
    for r in kept["categories1"].collect():
        for i in range(model.FOLDS):
            n, positive = (sum(r["folds"][f][c] for f in r["folds"] if f != i) for c in ("n", "positivos"))
            assert r["media"][i] == (pytest.approx((positive + model.SMOOTHING * 0.2) / (n + model.SMOOTHING)) if i in r["folds"] else None)
    assert {r["value"] for r in kept["categories1"].collect()} == {"0", "1", "2"}


def test_codes_give_back_bins_and_histograms_of_each_feature(spark):
    """Features share codes of a bounded number of values; sums of a code hold those of its features, nulls last."""
    rng = np.random.default_rng(0)
    sizes = [65, 5, 255, 2, 65, 13, 4, 65]
    codes = boosting.Codes.of(sizes)
    assert sorted(f for g in codes.groups for f in g) == [*range(8)] and len(codes.groups) < 6 and max(codes.cells) <= boosting.CELLS
    bins = np.stack([rng.integers(0, n, 1000) for n in sizes])
    written = codes.encode(bins)
    assert written.dtype == np.uint16 and all((codes.bins(written)[f] == bins[f]).all() for f in range(8))
    node, weight = rng.integers(0, 3, 1000), rng.random(1000)
    sums = [np.stack([np.bincount(node * n + c, v, 3 * n) for v in (weight, None)]) for c, n in zip(written, codes.cells)]
    found = codes.by_feature(sums, 254)
    assert found.shape == (3, 8, 255, 2)
    for f, n in enumerate(sizes):
        for i in range(3):
            own = np.bincount(bins[f][node == i], weight[node == i], n)
            assert np.allclose(found[i, f, : n - 1, 0], own[:-1]) and np.isclose(found[i, f, -1, 0], own[-1]) and found[i, f, :, 1].sum() == (node == i).sum()


def test_only_the_smaller_node_below_a_split_is_added_up(spark, monkeypatch):
    asked = []
    plain = boosting._histograms
    monkeypatch.setattr(boosting, "_histograms", lambda state, tasks, recent, tree, nodes, *rest: asked.append([*nodes]) or plain(state, tasks, recent, tree, nodes, *rest))
    df = spark.range(1_000).selectExpr("CAST(id % 20 AS DOUBLE) AS a", "CAST(id % 7 AS DOUBLE) AS b", "CAST(id % 20 > 11 AND id % 7 > 1 AS DOUBLE) AS y", "1.0D AS w")
    _, trees = boosting.boost(df, ["a", "b"], "y", "w", trees=1, rate=0.3, depth=3, leaves=8, least_rows=5)
    assert asked[0] == [1] and all(len({i // 2 for i in level}) == len(level) for level in asked[1:])
    inner = [r for r in boosting.node_rows(trees, ["a", "b"]) if r[2] is not None]
    leaves = {r[1]: r[6] for r in boosting.node_rows(trees, ["a", "b"])}
    assert inner and all(leaves[2 * r[1]] + leaves[2 * r[1] + 1] == r[6] for r in inner)


def test_edges_of_many_values_are_nearly_exact_quantiles(spark, monkeypatch):
    """Thinned in short steps, on four tasks; few values are exact however many rows they have."""
    monkeypatch.setattr(boosting, "POINTS", 1_000)
    monkeypatch.setattr(boosting, "SORTED", 5_000)
    rng = np.random.default_rng(1)
    many, few = rng.normal(size=40_000), rng.integers(0, 3, 40_000).astype(float)
    many[:100] = np.nan
    parts = [boosting._as_batch(x=np.stack([many[i : i + 2_000], few[i : i + 2_000], np.full(2_000, np.nan)]), y=np.full(2_000, 2.0 if i else -1.0)) for i in range(0, 40_000, 2_000)]
    blocks = spark.createDataFrame([(bytes(b["x"][0].as_py()), bytes(b["y"][0].as_py())) for b in parts], "x binary, y binary").repartition(4)
    edges, positive, every = boosting._edges(blocks, 3, 64)
    rank = np.searchsorted(np.sort(many[100:]), edges[0], "right") / 39_900
    assert len(edges[0]) == 64 and np.abs(rank - np.arange(1, 65) / 64).max() < 2 / 1_000 + 1e-9 and set(edges[0]) <= set(many)
    assert edges[1].tolist() == [0.0, 1.0, 2.0] and edges[2].tolist() == [0.0] and (positive, every) == (76_000.0, 78_000.0)


def test_scores_are_those_of_the_thresholds(spark):
    """Trees score by bins between their thresholds; the same as by comparing the values, at the thresholds and beyond too."""
    trees = []
    for k in range(3):
        t = boosting.Tree(2)
        t.feature[1:4], t.threshold[1:4], t.nulls_left[1:4] = [0, 1, 0], [k, np.inf, k - 1.5], [k == 1, False, True]
        t.value[:] = np.arange(8) / 10 * (k + 1)
        t.feature[3 if k else 2] = -1
        trees.append(t)
    values = [(a, b) for a in (None, -2.0, -1.5, 0.0, 0.5, 1.0, 2.0, float("inf")) for b in (None, 7.0, float("inf"))]
    df = spark.createDataFrame([(i, *v) for i, v in enumerate(values)], "i int, a double, b double")
    x = np.array([[np.nan if v is None else v for v in r] for r in values])
    raw = 0.25
    for t in trees:
        raw = raw + t.value[t.leaf_of(x, np.isnan(x))]
    found = df.select("i", boosting.probability(0.25, trees, [F.col("a"), F.col("b")]).alias("p")).orderBy("i").collect()
    assert [r["p"] for r in found] == (1 / (1 + np.exp(-raw))).tolist()


def test_expected_splits_save_passes_and_change_no_tree(spark, monkeypatch):
    """Trees grown from what is expected of them, from nothing, and from a wrong guess are the same."""
    passes = []
    plain = boosting._histograms
    monkeypatch.setattr(boosting, "_histograms", lambda *a: passes.append(len(a[4])) or plain(*a))
    df = spark.range(6_000).selectExpr(
        "CAST(id % 97 AS DOUBLE) AS a", "IF(id % 9 = 0, NULL, CAST(id % 31 AS DOUBLE)) AS b", "CAST(id % 13 AS DOUBLE) AS c",
        "CAST(id * 7919 % 1000 < 5 * (id % 97) + 10 * (id % 31) AS DOUBLE) AS y", "1.0D AS w",
    )

    def grown() -> tuple[list[tuple], int]:
        passes.clear()
        _, trees = boosting.boost(df, ["a", "b", "c"], "y", "w", trees=6, rate=0.1, depth=4, leaves=15, least_rows=30)
        return boosting.node_rows(trees, ["a", "b", "c"]), len(passes)

    def wrong(full, *_):
        guess = boosting.Tree(full.depth)
        guess.feature[1:4], guess.bin[1:4] = 2, [6, 2, 9]
        return guess

    expected, fewer = grown()
    monkeypatch.setattr(boosting, "_expected", lambda full, *_: boosting.Tree(full.depth))
    without, most = grown()
    monkeypatch.setattr(boosting, "_expected", wrong)
    misled, also = grown()
    assert most == 4 * 6 and fewer < most and also <= most
    for other in (expected, misled):
        assert [n[:5] + n[6:7] for n in other] == [n[:5] + n[6:7] for n in without]
        assert np.allclose([n[5] for n in other], [n[5] for n in without])
