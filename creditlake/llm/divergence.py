"""How far the sources of a language diverge in their words: pairs of sources, and the terms a source has too often."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditlake.llm.common import ranked, small_batches
from creditlake.settings import stage

#: A term is kept if so many documents of its language hold it.
LEAST_DOCS = 10
#: Probabilities are whole numbers in units of one in SCALE.
SCALE = 1_000_000_000
#: Term ids in one block: a pair of groups is priced block by block, so no task holds a whole vocabulary.
BLOCK = 1 << 16
#: Different (group, term) that a Python worker counts before it hands them on.
HELD = 200_000
TOP = 10

#: Terms are runs of ASCII letters and of all characters beyond ASCII; only A-Z change their case.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
COUNTS = "lang string, source string, term binary, n long, docs long"


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, in order, repeats included."""
    return text.translate(_FOLD).split()


def term_counts(docs: DataFrame, held: int = HELD) -> DataFrame:
    """(lang, source, term, n, docs): occurrences of each term in each group, and the rows that hold it.

    A row with a null term stands for the group itself, docs being its rows. Tasks add up what they can hold, `held` different
    pairs at most, so that common terms and large groups reach the shuffle as a few rows of each task.
    """
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()), ("n", pa.int64()), ("docs", pa.int64())])

    def batch_of(counts: dict[tuple, tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in counts.items():
            terms = list(docs)
            columns = [[lang] * len(terms), [source] * len(terms), terms, [n[t] for t in terms], [docs[t] for t in terms]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple, tuple[Counter, Counter]] = {}
        for b in small_batches(batches):
            for lang, source, text in zip(*(c.to_pylist() for c in b.columns)):
                n, docs = counts.setdefault((lang, source), (Counter(), Counter()))
                own = Counter(terms_of(text))
                n.update(own)
                docs.update(own.keys())
                docs[None] += 1
            if sum(len(d) for _, d in counts.values()) > held:
                yield from batch_of(counts)
                counts = {}
        yield from batch_of(counts)

    empty = F.lit("")
    rows = docs.select(F.coalesce("lang", empty).alias("lang"), F.coalesce("source", empty).alias("source"), F.coalesce("text", empty).cast("binary").alias("text"))
    return rows.mapInArrow(count, COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def scaled(count: np.ndarray, total: int, kept: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 2) / (total + 2 * kept)), exactly, by long division in steps of a thousand."""
    below = total + 2 * kept
    whole, rest = np.divmod(count.astype(np.int64) + 2, below)
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, below)
        whole = whole * 1000 + more
    return whole + 1


def priced(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def gallop(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in the sorted arrays a and b of the ids that both hold.

    The shorter one's ids are sought in the longer one, all at once: each starts where an even spread would have it, strides
    double until they reach it, and bisection does the rest.
    """
    if len(a) > len(b):
        return gallop(b, a)[::-1]
    if not len(a):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    low = np.zeros(len(a), np.int64)
    high = np.minimum(np.arange(len(a), dtype=np.int64) * len(b) // len(a), len(b) - 1)
    step = np.ones(len(a), np.int64)
    while (behind := (b[high] < a) & (high < len(b) - 1)).any():
        low = np.where(behind, high + 1, low)
        high = np.where(behind, np.minimum(high + step, len(b) - 1), high)
        step = np.where(behind, step * 2, step)
    while (open_ := low < high).any():
        mid = (low + high) >> 1
        right = b[mid] < a
        low = np.where(open_ & right, mid + 1, low)
        high = np.where(open_ & ~right, mid, high)
    hit = b[low] == a
    return np.flatnonzero(hit), low[hit]


def pair_price(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], totals: tuple[int, int], kept: int) -> tuple[int, int]:
    """Of two groups' sorted (ids, counts): the sum of prices over the ids of either, and how many ids those are."""
    (ids_a, n_a), (ids_b, n_b) = a, b
    p, q = scaled(n_a, totals[0], kept), scaled(n_b, totals[1], kept)
    none = np.zeros(1, np.int64)
    p_none, q_none = scaled(none, totals[0], kept), scaled(none, totals[1], kept)
    at, to = gallop(ids_a, ids_b)
    only_a, only_b = np.ones(len(ids_a), bool), np.ones(len(ids_b), bool)
    only_a[at] = only_b[to] = False
    value = priced(p[at], q[to]).sum() + priced(p[only_a], q_none).sum() + priced(p_none, q[only_b]).sum()
    return int(value), len(ids_a) + len(ids_b) - len(at)


def _share(count: str, total: str, kept: str) -> Column:
    """`scaled` for rows, in decimals, so that no product overflows."""
    return F.expr(f"1 + ({SCALE} * CAST({count} + 2 AS DECIMAL(20,0))) div CAST(greatest({total} + 2 * {kept}, 1) AS DECIMAL(20,0))")


def _price(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int | None = TOP, block: int = BLOCK) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source of a language is from the others, and by which terms.

    Each language keeps the terms that `least_docs` of its rows hold. A group (lang, source) gives each kept term
    p = 1 + floor(10^9 (count + 2) / (N + 2 V)), N being the group's occurrences of kept terms and V their number. Two
    shares cost floor((p - q)^2 / (p + q)). Part `pair` has the cost over all kept terms between a source and each other one of its
    language, part `term` that of each term the source has more often than its language, the `top` largest (None: all).

    Null lang, source and text count as empty, and empty names are groups like others. A group without terms has pairs with
    all others. Ties are ranked by the item's UTF-8 bytes. Repeated rows count each time. An empty table gives an empty
    result. Other columns are not read. Sums stay exact up to 4 * 10^15 occurrences in a language.

    Texts are counted in one pass; afterwards only (group, term, count) moves. Terms get numbers in their order, and each
    group's sorted (id, count) arrays are cut into blocks of `block` ids, so that a task prices one block of one pair of groups.
    """
    counts = stage(term_counts(docs), "terms")
    words = counts.where("term IS NOT NULL")
    kept = words.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs)
    kept = stage(ranked(kept.drop("docs"), ["lang"], [F.col("term").asc()], "id"), "vocabulary")
    own = words.select("lang", "source", "term", "n").join(kept, ["lang", "term"])
    columns = F.struct(F.pmod("id", F.lit(block)).cast("int").alias("id"), "n", "lang_n", "term")
    chunks = own.groupBy("lang", "source", F.floor(F.col("id") / block).cast("long").alias("block")).agg(F.sort_array(F.collect_list(columns)).alias("entries"))
    chunks = stage(chunks, "chunks")

    sizes = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"))
    totals = chunks.groupBy("lang", "source").agg(F.sum(F.aggregate("entries", F.lit(0).cast("long"), lambda x, e: x + e["n"])).alias("total"))
    groups = counts.where("term IS NULL").select("lang", "source").join(sizes, ["lang"], "left").join(totals, ["lang", "source"], "left")
    groups = stage(groups.fillna(0, ["kept", "lang_total", "total"]), "groups")

    terms = chunks.join(groups, ["lang", "source"]).select("lang", "source", "total", "kept", "lang_total", F.inline("entries"))
    terms = terms.withColumn("p", _share("n", "total", "kept")).withColumn("q", _share("lang_n", "lang_total", "kept")).where("p > q")
    terms = terms.select("lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), _price("p", "q").alias("value"))
    pairs = _pairs(chunks, groups)
    way = lambda a, b: F.struct(F.col(a).alias("source"), F.lit("pair").alias("part"), F.col(b).alias("item"))
    pairs = pairs.select("lang", F.inline(F.array(way("a", "b"), way("b", "a"))), "value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = terms.withColumn("rank", F.row_number().over(order))
    terms = terms if top is None else terms.where(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(terms)


def _pairs(chunks: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, a, b, value) of each unordered pair of a language's groups, a before b."""
    first = groups.select("lang", F.col("source").alias("a"), F.col("total").alias("total_a"), "kept")
    second = groups.select(F.col("lang").alias("of"), F.col("source").alias("b"), F.col("total").alias("total_b"))
    pairs = stage(first.join(second, (F.col("lang") == F.col("of")) & (F.col("a") < F.col("b"))).drop("of"), "pairs")
    arrays = chunks.select(
        "lang", "source", "block", F.col("entries")["id"].alias("ids"), F.col("entries")["n"].alias("counts")
    )
    key = ["lang", "a", "b", "block"]

    def side(name: str) -> DataFrame:
        rows = pairs.join(arrays.withColumnRenamed("source", name), ["lang", name])
        return rows.select(*(F.col(c).alias(c) for c in (*key, "total_a", "total_b", "kept", "ids", "counts")))

    schema = pa.schema([("lang", pa.string()), ("a", pa.string()), ("b", pa.string()), ("value", pa.int64()), ("seen", pa.int64())])

    def entries(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        if not t.num_rows:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return t.column("ids")[0].values.to_numpy().astype(np.int64), t.column("counts")[0].values.to_numpy()

    def price(left: pa.Table, right: pa.Table) -> pa.Table:
        row = (left if left.num_rows else right).select(["lang", "a", "b", "total_a", "total_b", "kept"]).slice(0, 1).to_pylist()[0]
        value, seen = pair_price(entries(left), entries(right), (row["total_a"], row["total_b"]), row["kept"])
        return pa.table([pa.array([x], f.type) for x, f in zip((row["lang"], row["a"], row["b"], value, seen), schema)], schema=schema)

    tasks = side("a").groupBy(*key).cogroup(side("b").groupBy(*key)).applyInArrow(price, "lang string, a string, b string, value long, seen long")
    priced_pairs = tasks.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))
    pairs = pairs.join(priced_pairs, ["lang", "a", "b"], "left").fillna(0, ["value", "seen"])
    # Terms that neither group has cost the same each.
    pairs = pairs.withColumn("none", F.lit(0)).withColumn("p", _share("none", "total_a", "kept")).withColumn("q", _share("none", "total_b", "kept"))
    absent = (F.col("kept") - F.col("seen")) * _price("p", "q")
    return pairs.select("lang", "a", "b", F.when(F.col("kept") > 0, F.col("value") + absent).otherwise(F.lit(0)).cast("long").alias("value"))
