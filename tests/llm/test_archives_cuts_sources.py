"""Archives, fill-in-the-middle cuts and source divergence against plain versions."""

import hashlib
import io
import random
import re
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
import zstandard
from creditlake.llm import divergence, fim, warc
from creditlake.settings import scratch_path
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def pages(spark, words):
    copy, short = "<p>" + words(60), "x" * 99
    rows = [(i, f"https://h.example/{i}", "<h1>é 𝒳" + words(5 + i)) for i in range(40)]
    rows += [(100 + i, "https://h.example/c", copy) for i in range(60)] + [(99, None, copy), (99, None, copy), (None, "u", copy)]
    rows += [(200 + i, "a b\r\nX: y é", short) for i in range(3)] + [(210 + i, "u", short + "y") for i in range(2)]
    rows += [(220, None, None), (221, "", ""), (None, None, None), (None, "u", "only nulls " * 20), (None, "u", "only nulls " * 20)]
    rows += [(99, "other", "another text of the same id " * 9), (230, "u", "another text of the same id " * 9), (240, "u", words(3000))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for name in ("digest", "first", "n", "payload", "revisit", "record_type", "hot", "few", "file", "at"):
        df = df.withColumn(name, F.col("page_id"))
    return df


def plain_records(rows):
    """(page_id, bytes, digest, type, refers_to), by comparing payloads."""
    least = {}
    for r in rows:
        if r.page_id is not None:
            least[r.html] = min(r.page_id, least.get(r.html, r.page_id))
    out = []
    for r in rows:
        data = (r.html or "").encode()
        first = least.get(r.html)
        revisit = len(data) >= 100 and r.page_id != first
        out.append((r.page_id, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


def test_archives_round_trip(spark, pages):
    path = scratch_path(spark, "warc")
    index = warc.write_archives(pages, path, frame_bytes=3000, bundle_bytes=9000).collect()
    rows = pages.collect()
    found = warc.read_archives(spark, path).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found), key=str) == plain_records(rows)
    texts = Counter((r.page_id, r.html or "") for r in rows)
    assert all((r.payload is None) == (r.record_type == "revisit") for r in found)
    assert not Counter((r.page_id, r.payload.decode()) for r in found if r.payload is not None) - texts
    # Any reader of Zstandard sees one stream of all records, and the index points into it.
    files = sorted({r.file for r in index})
    assert len(files) > 2 and len(index) == len(rows)
    for name in files:
        data = Path(path, name).read_bytes()
        stream = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
        assert stream.count(b"WARC/1.1\r\n") == sum(r.file == name for r in index)
        frames = {(r.frame_offset, r.frame_length) for r in index if r.file == name}
        assert frames == set(warc.seek_table(warc.fs.LocalFileSystem(), f"{path}/{name}"))
        for r in index:
            if r.file == name:
                raw = zstandard.ZstdDecompressor().decompress(data[r.frame_offset : r.frame_offset + r.frame_length])
                one, end = warc.parse(raw, r.at)
                assert (one["page_id"], one["record_type"], end - r.at) == (r.page_id, r.record_type, r.length)


def test_archives_by_id(spark, pages):
    path = scratch_path(spark, "warc")
    warc.write_archives(pages, path, frame_bytes=2000)
    asked = [0, 7, 99, 120, 120, 159, 220, 230, 9999, None]
    got = warc.fetch(spark, path, spark.createDataFrame([(i,) for i in asked], "id long")).collect()
    expected = [(r.page_id, r.html or "") for r in pages.collect() if r.page_id in set(asked) - {None}]
    assert sorted((r.page_id, r.payload.decode()) for r in got) == sorted(expected)


def test_archives_without_rows_and_damaged(spark, pages):
    assert warc.archive_facts(pages.limit(0)).count() == 0
    data = warc.record(1, "u", b"some payload", hashlib.sha256(b"some payload").hexdigest(), None)
    with pytest.raises(ValueError, match="damaged"):
        warc.parse(data.replace(b"some", b"gone"))


def test_wavelet_ranks_and_places():
    rng = np.random.default_rng(2)
    for n in (0, 1, 63, 64, 65, 1000):
        s = rng.integers(0, 5, n).astype(np.uint8)
        m, at = fim.WaveletMatrix(s), np.arange(n + 1)
        for symbols in ((0,), (4,), (0, 2, 3)):
            before = np.array([np.isin(s[:i], symbols).sum() for i in at])
            assert (m.boundaries(symbols, at) == before).all()
            k = np.arange(n + 3)
            places = m.locate(symbols, k, np.zeros_like(k), np.full_like(k, n))
            assert places.tolist() == [next((i for i in at if before[i] >= j), n) for j in k]


def plain_cut(doc_id, text):
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, z = sorted((h[0] % (len(text) + 1), h[1] % (len(text) + 1)))
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return len(text), "plain", None, None, text
    p, m, s = text[:a], text[a:z], text[z:]
    out = f"<S>{s}<P>{p}<M>{m}" if h[3] % 100 < 20 else f"<P>{p}<S>{s}<M>{m}"
    return len(text), "spm" if h[3] % 100 < 20 else "psm", a, z - a, out


def test_cuts(spark, words, edge_docs, no_docs):
    rng = random.Random(1)
    rows = [(i, "".join(rng.choice("aé日𝒳 \n<>PSM") for _ in range(rng.randint(0, 200)))) for i in range(300)]
    rows += [(300, "has <M> inside"), (301, "<P"), (302, "S><"), (-5, "negative")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("h0", F.lit(1)).withColumn("output", F.lit("x"))
    for docs in (df, edge_docs):
        cut = fim.fill_in_middle(docs).withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
        given = [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
        assert sorted([(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in cut], key=str) == sorted(
            [(i, *plain_cut(i, t)) for i, t in given], key=str
        )
        assert Counter(r.back for r in cut) == Counter(t for _, t in given)
    assert fim.fill_in_middle(no_docs).count() == 0


@pytest.mark.parametrize("units", ["words", "lines"])
def test_cuts_between_larger_units(spark, units):
    rng = random.Random(8)
    texts = ["".join(rng.choice(["é", "b", " ", "\n", "日"]) for _ in range(60)) for _ in range(150)] + ["", "x", "\n", " "]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in fim.fill_in_middle(df, units).withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect():
        pattern = r"[^ \n]+" if units == "words" else r"\n"
        found = [m.start() if units == "words" else m.end() for m in re.finditer(pattern, r.text)]
        assert r.n == len(found) and r.back == r.text
        if r.form != "plain":
            places = {0, len(r.text), *found}
            assert r.prefix_chars in places and r.prefix_chars + r.middle_chars in places


def plain_audit(rows, least=10):
    rows = [tuple(x or "" for x in r) for r in rows]
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    split = [(lang, source, re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t.translate(low))) for t, lang, source in rows]
    out = []
    for lang in {x for x, _, _ in split}:
        docs = Counter(t for x, _, terms in split if x == lang for t in set(terms))
        kept = {t for t, n in docs.items() if n >= least}
        counts = {s: Counter() for x, s, _ in split if x == lang}
        for x, s, terms in split:
            if x == lang:
                counts[s].update(t for t in terms if t in kept)
        total = sum(counts.values(), Counter())

        def share(c):
            n = sum(c.values())
            return {t: 1 + 10**9 * (c[t] + 2) // (n + 2 * len(kept)) for t in kept}

        q, shares = share(total), {s: share(c) for s, c in counts.items()}
        cost = lambda a, b: (a - b) ** 2 // (a + b)
        for s, p in shares.items():
            parts = {
                "pair": [(o, sum(cost(p[t], x[t]) for t in kept)) for o, x in shares.items() if o != s],
                "term": [(t, cost(p[t], q[t])) for t in kept if counts[s][t] > 0 and p[t] > q[t]],
            }
            for part, items in parts.items():
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, t, v, i) for i, (t, v) in enumerate(items, 1) if part == "pair" or i <= 10]
    return sorted(out)


def test_gallop():
    rng = np.random.default_rng(3)
    for na, nb in ((0, 5), (5, 0), (1, 1), (3, 400), (400, 3), (200, 200)):
        a, b = (np.unique(rng.integers(0, 500, n)) for n in (na, nb))
        i, j = divergence.gallop(a, b)
        assert a[i].tolist() == b[j].tolist() == sorted(set(a.tolist()) & set(b.tolist()))


def test_shares_are_exact():
    for count, total, kept in ((0, 0, 1), (5, 9, 3), (4 * 10**15, 4 * 10**15, 10**6), (10**12 + 7, 3 * 10**13 + 1, 12345)):
        assert divergence.scaled(np.array([count]), total, kept)[0] == 1 + 10**9 * (count + 2) // (total + 2 * kept)


def test_divergence(spark, words, edge_docs, no_docs):
    rng = random.Random(6)
    vocabulary = ["É", "é", "naïve", "日本", "ab-cd", "x1y", "Zz"] + words(30).split()
    rows = [(" ".join(rng.choices(vocabulary[: rng.randint(3, 37)], k=rng.randint(0, 30))), rng.choice(["l1", "l2"]), rng.choice("abcd")) for _ in range(300)]
    rows += [(None, None, None), ("rare", "l3", "a"), ("", "l3", "b"), ("12 !!", "l1", "no terms"), *[("same same", None, "a")] * 12, ("other", None, None)]
    df = spark.createDataFrame(rows, "text string, lang string, source string").withColumn("term", F.lit("x")).withColumn("n", F.lit(1))
    for block, held in ((1 << 16, 10**6), (7, 20)):
        found = divergence.audit(df, block=block)
        assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
        assert sorted(map(tuple, found.collect())) == plain_audit(rows)
        counts = divergence.term_counts(df, held)
        assert counts.where("term IS NULL").agg(F.sum("docs")).first()[0] == len(rows)
    edge = [tuple(r) for r in edge_docs.select("text", "lang", "source").collect()]
    assert sorted(map(tuple, divergence.audit(edge_docs).collect())) == plain_audit(edge)
    assert divergence.audit(no_docs).count() == 0
