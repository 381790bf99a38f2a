"""The pipeline's stages on small tables, and every query of the subpackage."""

import corpus_pipeline as pipeline
import pytest
from creditlake.llm import queries
from creditlake.settings import stage

SMALL = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    planted = spark.read.parquet(f"{SMALL}/benchmark.parquet").first().text
    extra = [(10_001, "12 ?? 34", "en", "src0", 8), (10_002, None, None, None, None), (10_003, f"x y z {planted} a b c", "en", "src1", 1)]
    docs = docs.union(docs.limit(5)).union(spark.createDataFrame(extra, docs.schema))
    sizes = [docs.count()]
    for name, step in pipeline.STAGES:
        out = stage(step(spark, docs, SMALL), name)
        if name != "tokens":
            assert out.columns == docs.columns
            ids = {r.doc_id for r in out.select("doc_id").collect()}
            assert not {10_001, 10_002} & ids
            assert (10_003 in ids) == (name in ("language", "near_duplicates"))
            docs = out
        sizes.append(out.count())
    assert sizes[0] - 2 == sizes[1] and sizes[2] <= sizes[1] - 5 and sizes[3] < sizes[2] and sizes[5] == sizes[4]
    empty = docs.limit(0)
    for _, step in pipeline.STAGES:
        assert step(spark, empty, SMALL).count() == 0


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_run(spark, name):
    df = queries.QUERIES[name](spark, SMALL)
    assert df.count() >= (0 if name.startswith("op6") else 1)
    assert all(t not in ("void",) for c, t in df.dtypes)
