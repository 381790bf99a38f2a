"""SimHash groups and links against plain versions."""

import itertools
import random

import xxhash
from creditlake.llm import simhash
from creditlake.llm.common import components, ranked
from pyspark.sql import functions as F


def plain_fingerprint(text, words=3):
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    shingles = [b" ".join(parts[i : i + words]) for i in range(max(1, len(parts) - words + 1))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups_of(prints, radius):
    """{fingerprint: smallest fingerprint reachable}."""
    root = {p: p for p in prints}
    changed = True
    while changed:
        changed = False
        for a, b in itertools.combinations(prints, 2):
            if bin(a ^ b).count("1") <= radius and root[a] != root[b]:
                root[a] = root[b] = min(root[a], root[b])
                changed = True
    return root


def test_fingerprint_bits(words, spark):
    for text in ("", None, "A", "a B  c", "x\x0by\x1cz", "É é É", words(200), words(3) + "\n" + words(2)):
        assert simhash.fingerprint(text) == plain_fingerprint(text)
    spark_hash = spark.sql("SELECT xxhash64('a b c') h").first().h
    assert spark_hash % (1 << 64) == xxhash.xxh64_intdigest(b"a b c", 42)


def test_masks_cover_every_pair():
    masks = simhash.covering_masks(2)
    assert len(masks) == 7
    for i, j in itertools.combinations_with_replacement(range(64), 2):
        assert any(not m >> i & 1 and not m >> j & 1 for m in masks)


def test_links_small_and_large_buckets(spark):
    rng = random.Random(3)
    prints = set()
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(12):
            prints.add(base ^ sum({1 << rng.randrange(64) for _ in range(rng.randint(0, 4))}))
    prints = sorted(simhash._signed(p) for p in prints)
    df = spark.createDataFrame([(p,) for p in prints], "bits long")
    expected = groups_of([p % (1 << 64) for p in prints], 2)
    for small in (2, 4, 1000):
        found = {r.node: r.component for r in components(simhash.links(df, 2, small)).collect()}
        mine = {}
        for p in prints:
            mine.setdefault(found.get(p, p), set()).add(p % (1 << 64))
        wanted = {}
        for p, r in expected.items():
            wanted.setdefault(r, set()).add(p)
        assert sorted(map(sorted, mine.values())) == sorted(map(sorted, wanted.values()))


def test_groups_of_edge_documents(edge_docs, no_docs):
    rows = simhash.near_duplicates(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    texts = [(r.doc_id, r.text) for r in edge_docs.select("doc_id", "text").collect()]
    root = groups_of(sorted({plain_fingerprint(t) for _, t in texts}), 2)
    first = {}
    for i, t in texts:
        r = root[plain_fingerprint(t)]
        first[r] = min((x for x in (first.get(r), i) if x is not None), default=None)
    expected = sorted(((i, first[root[plain_fingerprint(t)]]) for i, t in texts), key=str)
    assert sorted(((r.doc_id, r.component_id) for r in rows), key=str) == expected
    assert simhash.near_duplicates(no_docs).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, x) for x in range(101, 160)]
    found = {r.node: r.component for r in components(spark.createDataFrame(chain + star + [(7, 7)], "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_ranks_run_through_partitions(spark):
    df = spark.createDataFrame([(None if i % 5 == 0 else i % 2, (i * 7919) % 1000) for i in range(1000)], "g int, v int")
    rows = ranked(df, ["g"], [F.col("v")]).collect()
    by_group = {}
    for r in rows:
        by_group.setdefault(r.g, []).append((r.rank, r.v))
    for g, pairs in by_group.items():
        assert [p[0] for p in sorted(pairs)] == list(range(len(pairs)))
        assert [p[1] for p in sorted(pairs)] == sorted(p[1] for p in pairs)


def test_one_of_each_group_stays(spark, words, edge_docs, no_docs):
    rng, rows = random.Random(9), []
    for g in range(12):
        base = words(400).split()
        for c in range(4):
            own = list(base)
            if c > 1:
                own[rng.randrange(400)] = "zz" + str(rng.random())
            rows.append((g * 10 + c, ("\n" if c else " ").join(own).upper()))
    rows += [(1000 + i, words(100)) for i in range(20)] + [(500 + i, rows[0][1]) for i in range(300)] + rows[:3]
    root = groups_of(sorted({plain_fingerprint(t) for _, t in rows}), 2)
    expected = {}
    for i, t in sorted(rows):
        expected.setdefault(root[plain_fingerprint(t)], i)
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(expected.values())
    edge = simhash.keep_one(edge_docs)
    assert edge.columns == edge_docs.columns
    ids = [r.doc_id for r in edge.collect()]
    assert 1 in ids and not {2, 3} & set(ids) and ids.count(1) == 1
    assert {7, 8, 9, 10, *range(20, 40)} <= set(ids)
    assert simhash.keep_one(no_docs).count() == 0
