"""Mixing and sharding against plain versions."""

import random
from collections import Counter

from creditlake.llm import mixing, sharding
from pyspark.sql import functions as F


def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, capped = 1.5 * sum(sizes.values()), set()
    while True:
        level = (left - sum(2 * sizes[s] for s in capped)) / max(1, sum(weight[s] for s in names if s not in capped))
        above = {s for s in names if s not in capped and weight[s] * level > 2 * sizes[s]}
        if not above:
            return {s: 2.0 * sizes[s] if s in capped else weight[s] * level for s in names}
        capped |= above


def test_targets_and_copies(edge_docs, no_docs):
    rows = mixing.mix(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    sizes = Counter()
    for r in rows:
        sizes[r.source] += r.size
    goals = plain_targets(dict(sizes))
    largest = max(r.size for r in rows)
    for s in sizes:
        own = [r for r in rows if r.source == s]
        assert all(abs(r.target - goals[s]) < 1e-6 * max(1, goals[s]) and r.source_size == sizes[s] for r in own)
        assert abs(sum(r.copies * r.size for r in own) - goals[s]) <= largest
    assert all(0 <= r.copies <= 2 for r in rows)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(edge_docs).collect()))
    assert mixing.mix(no_docs).count() == 0


def test_the_mix_repeats_whole_rows(edge_docs, no_docs):
    plan = Counter()
    for r in mixing.mix(edge_docs).collect():
        plan[r.doc_id, r.source, r.size] += r.copies
    mixed = mixing.mixed(edge_docs)
    assert mixed.columns == edge_docs.columns
    found = Counter((r.doc_id, r.source, len((r.text or "").split())) for r in mixed.collect())
    assert found == Counter({k: n for k, n in plan.items() if n})
    assert mixing.mixed(no_docs).count() == 0


def test_shards_are_even_and_slots_have_no_gap(spark, edge_docs, no_docs):
    docs = spark.createDataFrame([(i, "x" * (i * 37 % 900)) for i in range(3000)], "doc_id long, text string")
    rows = sharding.shard(docs, 24).collect()
    loads, slots = Counter(), {}
    for r in rows:
        loads[r.shard] += r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert len(rows) == 3000 and len(loads) == 24
    assert max(loads.values()) - min(loads.values()) <= 908
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sorted(map(str, rows)) == sorted(map(str, sharding.shard(docs, 24).collect()))
    edge = sharding.shard(edge_docs).collect()
    assert len(edge) == edge_docs.count() and min(r.size for r in edge) == 8
    assert sharding.shard(no_docs).count() == 0


def test_bounded_loads_move_little():
    loads = {c: 100 + c % 7 for c in range(4096)}
    before = sharding.place_cells(loads, sharding.Ring(24))
    after = sharding.place_cells(loads, sharding.Ring(25))
    full = Counter()
    for c, s in before.items():
        full[s] += loads[c]
    assert max(full.values()) - min(full.values()) <= 2 * 106
    # All would move under a plain modulus; the ring moves a part, most of it towards the new shard or away from full ones.
    assert sum(before[c] != after[c] for c in loads) < 0.5 * len(loads)


def plain_place(loads, shards, virtual):
    """Each cell walks over the nodes of the ring one by one."""
    nodes = sorted((sharding._spot(f"{s}/{v}"), s) for s in range(shards) for v in range(virtual))
    full, used, placed = -(-sum(loads.values()) // shards), [0] * shards, {}
    for cell, load in sorted(loads.items(), key=lambda x: (-x[1].bit_length(), x[0])):
        at = sharding._spot(f"cell {cell}")
        walk = [s for p, s in nodes if p >= at] + [s for p, s in nodes if p < at]
        fits = [s for s in walk if used[s] + load <= full]
        least = min(used)
        placed[cell] = fits[0] if fits else next(s for s in walk if used[s] == least)
        used[placed[cell]] += load
    return placed


def test_cells_go_where_a_plain_walk_takes_them():
    rng = random.Random(6)
    for shards, virtual in ((1, 3), (5, 4), (24, 8)):
        for _ in range(6):
            loads = {c: rng.choice([8, 30, 100, rng.randint(8, 5000)]) for c in rng.sample(range(2000), 150)}
            assert sharding.place_cells(loads, sharding.Ring(shards, virtual)) == plain_place(loads, shards, virtual)


def test_documents_follow_the_cells(spark):
    """Shards of documents, as the plain walk gives them for cells made from id and text."""
    docs = spark.createDataFrame([(i % 90, "y" * (i * 31 % 400)) for i in range(400)], "doc_id long, text string")
    cell = F.pmod(F.xxhash64("doc_id", "text"), F.lit(64)).cast("int")
    loads, cells = Counter(), {}
    for r in docs.select("doc_id", F.crc32("text").alias("crc"), F.length("text").alias("n"), cell.alias("cell")).collect():
        loads[r.cell] += r.n + 8
        cells[r.doc_id, r.crc] = r.cell
    expected = plain_place(loads, 6, 4)
    rows = sharding.shard(docs, 6, cells=64, virtual=4).collect()
    assert len(rows) == 400 and all(r.shard == expected[cells[r.doc_id, r.text_crc32]] for r in rows)
