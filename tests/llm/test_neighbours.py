"""Approximate neighbours against brute force."""

import numpy as np
from creditlake.llm import ann


def brute(rows, k=5, every=50):
    rows = {i: np.array(v, float) for i, v in rows if i is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for q in rows:
        if q % every == 0:
            cos = [(-round(float(rows[q] @ v / np.linalg.norm(v) / np.linalg.norm(rows[q])), 12), i) for i, v in rows.items() if i != q]
            out[q] = [(i, -s) for s, i in sorted(cos)[:k]]
    return out


def test_hilbert_keys_visit_neighbours():
    for m, bits in ((2, 4), (3, 3), (4, 2), (1, 5)):
        cells = np.array(np.meshgrid(*[np.arange(1 << bits)] * m)).reshape(m, -1).T
        keys = ann.hilbert_keys(cells, bits)
        assert sorted(keys) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_edge_vectors_and_copies(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=4).round(3).tolist()) for i in range(120)]
    rows += [(200 + i, [1.0, 2.0, 0.5, 0.0]) for i in range(60)]  # one vector many times, queries among them
    rows += [(900, None), (950, []), (1000, [0.0] * 4), (1050, [1.0, None, 0.0, 0.0]), (1100, [float("nan")] * 4), (1150, [float("inf"), 0.0, 0.0, 1.0]), (None, [1.0] * 4), rows[7], rows[50]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "vec_id AS vid", "1 AS place", "2 AS curve")
    exact = [(r.vec_id, r.embedding) for r in df.collect()]
    found = {}
    for r in ann.nearest(df).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    expected = brute(exact)
    assert found.keys() == expected.keys()
    for q, hits in expected.items():
        own = sorted(found[q])
        assert [h[0] for h in own] == [1, 2, 3, 4, 5]
        assert [h[1] for h in own] == [i for i, _ in hits]
        assert np.allclose([h[2] for h in own], [s for _, s in hits], atol=1e-9)
    assert ann.nearest(df.limit(0)).count() == 0
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in ann.nearest(few).collect()] == [(0, 1, 1, 0.0)]
    mixed = few.union(spark.createDataFrame([(2, [1.0]), (50, [2.0]), (100, [1.0, 1.0, 0.5]), (51, [-1.0])], "vec_id long, embedding array<float>"))
    # A query's neighbours have its length; one without any has no row.
    assert sorted(tuple(r) for r in ann.nearest(mixed).collect()) == [(0, 1, 1, 0.0), (50, 1, 2, 1.0), (50, 2, 51, -1.0)]


def test_scores_do_not_depend_on_blocks(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=33).tolist()) for i in range(700)]
    rows += [(1000 + i, [x * (i + 2) / 3 for x in rows[50][1]]) for i in range(30)]  # cosines that differ in the last bit at most
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    answers = []
    for block in (2048, 64):
        monkeypatch.setattr(ann, "BLOCK", block)
        found = ann.nearest(df, target=1.0).collect()
        answers.append(sorted(tuple(r) for r in found if r.query_id == 50 or block == 2048 or r["rank"] == 1))
    exact = {}
    unit = {i: ann._unit(np.array([v]))[0] for i, v in rows}
    for q in (50, 0, 650):
        cos = sorted((-(unit[q] * unit[i]).sum(), i) for i in unit if i != q)[:5]
        exact[q] = [(i, -c) for c, i in cos]
    got = {q: [(v, s) for a, _, v, s in answers[0] if a == q] for q in exact}
    assert got == exact
    assert {r for r in answers[1] if r[1] == 1} <= set(answers[0])


def test_recall_with_windows(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(60, 24))
    rows = [(i, (centres[i % 60] + 0.4 * rng.normal(size=24)).tolist()) for i in range(6000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {}
    for r in ann.nearest(df).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    expected = brute(rows)
    assert found.keys() == expected.keys()
    assert np.mean([len(found[q] & {i for i, _ in hits}) / 5 for q, hits in expected.items()]) >= 0.9
