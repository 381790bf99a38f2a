import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def words():
    rng = random.Random(5)
    syllables = ["ta", "ro", "mi", "ken", "sul", "pa", "vor", "lin", "da", "gru", "be", "chi"]
    return lambda n: " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="session")
def edge_docs(spark, words):
    """Nulls in every column, empty and long texts, ties, repeated rows, and columns named like those of the operators."""
    long_text, plain = words(30_000), words(120)
    rows = [
        (1, plain, "aa", "s1", 1), (1, plain, "aa", "s1", 1), (2, plain, "aa", "s2", 2), (3, plain.upper(), "aa", None, 3),
        (4, None, "aa", "s1", 4), (5, "", None, "s1", None), (6, " \n\t ", "bb", "s2", 6), (7, long_text, "bb", "s2", 7),
        (None, words(80), "bb", "s3", 8), (None, None, None, None, None), (8, "123 !!! ---", "bb", "s3", 9), (9, "one", "bb", "s3", 10),
        (10, "one two", "bb", "s3", 11), *[(20 + i, words(60), "ab"[i % 2] * 2, f"s{i % 3}", i) for i in range(20)],
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    clashing = "size place copies target key bits node component rank shard slot part first ids score predicted lang_pred replaced kinds doc pair number edits item_id text_key"
    for name in clashing.split():
        df = df.selectExpr("*", f"doc_id AS {name}")
    return df


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session", autouse=True)
def _shared_folder(spark, tmp_path_factory):
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
