"""Near duplicates by SimHash fingerprints, found with a covering family of bit masks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditlake.llm.common import components, may_hold, small_batches
from creditlake.operators.skew import hot_weights, lookup_join
from creditlake.settings import stage

WORDS = 3
RADIUS = 2
SEED = 42
#: Buckets of up to so many fingerprints are compared pair by pair; larger ones by shared neighbours. Both are exact.
SMALL = 32


def fingerprint(text: str | None, words: int = WORDS, seed: int = SEED) -> int:
    """64-bit SimHash of a text's word shingles, repeats included; 0 without words.

    A-Z are lower-cased, words lie between ASCII white space, and a bit is set if it is set in more than half of the
    shingles' XXH64 values. A text of fewer words is one shingle.
    """
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    joined, hashed = b" ".join(parts), xxhash.xxh64_intdigest
    ends = np.cumsum([len(p) + 1 for p in parts])
    starts, stops = [0, *ends[:-1].tolist()], (ends - 1).tolist()
    n = max(1, len(parts) - words + 1)
    last = min(words, len(parts)) - 1
    bits = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 14):  # bounded memory for long texts
        run = [hashed(joined[starts[i] : stops[i + last]], seed) for i in range(at, min(n, at + (1 << 14)))]
        own = np.array(run, "<u8").view(np.uint8).reshape(-1, 8)
        bits += np.unpackbits(own, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = WORDS, seed: int = SEED, carry: Sequence[str] = ()) -> DataFrame:
    """(doc_id, bits): the fingerprint of each whole text as a signed 64-bit number. Columns named in `carry` go along."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            found = np.array([fingerprint(t, words, seed) for t in b.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found), *b.columns[2:]], names=["doc_id", "bits", *carry])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *carry)
    carried = "".join(f", {c} {rows.schema[c].dataType.simpleString()}" for c in carry)
    return rows.mapInArrow(of, f"doc_id long, bits long{carried}")


def covering_masks(radius: int, width: int = 64) -> list[int]:
    """Masks such that any two words that differ in up to `radius` of `width` bits agree under at least one (Pagh, 2016).

    Each bit has a vector other than zero of radius + 1 binary digits, and there is a mask for each such vector v, which keeps
    the bits whose vector has an odd product with v. The vectors of `radius` differing bits do not span the whole
    space, so some v is orthogonal to all of them and its mask hides them.
    """
    size = 1 << (radius + 1)
    vectors = [1 + i % (size - 1) for i in range(width)]
    return [sum(1 << i for i, x in enumerate(vectors) if (x & v).bit_count() % 2) for v in range(1, size)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(prints: DataFrame, radius: int = RADIUS, small: int = SMALL) -> DataFrame:
    """Links (a, b) that connect just the fingerprints within `radius` of each other, directly or in steps.

    `prints` holds distinct fingerprints in the column bits. Each meets others in one bucket for each mask. Buckets up to
    `small` give the pairs within the radius. In larger ones each fingerprint is written under itself and under
    all that differ from it in one bit that the mask hides; those which share such a neighbour are at most two bits
    apart, and all that are so share one. They are tied to the least of them, so no bucket gives all its pairs,
    whatever its size. That needs a radius of 2 or less.
    """
    masks = covering_masks(radius)
    tables = F.array(*(F.struct(F.lit(t).alias("t"), F.lit(_signed(m)).alias("mask")) for t, m in enumerate(masks)))
    rows = prints.select("bits", F.explode(tables).alias("m"))
    rows = rows.select(F.col("m.t").alias("t"), F.col("bits").bitwiseAND(F.col("m.mask")).alias("key"), "bits")
    shared = rows.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
    shared = shared.select(F.col("t").alias("st"), F.col("key").alias("sk"), "n")
    met = stage(rows.join(shared, (F.col("t") == F.col("st")) & (F.col("key") == F.col("sk"))).select("t", "key", "bits", "n"), "met")

    left = met.where(F.col("n") <= small).select("t", "key", F.col("bits").alias("a"))
    right = left.select(F.col("t").alias("rt"), F.col("key").alias("rk"), F.col("a").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    pairs = left.join(right, (F.col("t") == F.col("rt")) & (F.col("key") == F.col("rk")) & (F.col("a") > F.col("b")) & near)
    return pairs.select("a", "b").union(_large(met.where(F.col("n") > small), masks))


def _large(met: DataFrame, masks: list[int]) -> DataFrame:
    hidden = F.array(*(F.array(F.lit(0), *(F.lit(_signed(1 << i)) for i in range(64) if not m >> i & 1)).cast("array<bigint>") for m in masks))
    flips = met.select("bits", F.explode(F.element_at(hidden, F.col("t") + 1)).alias("flip"))
    rows = flips.select("bits", F.col("bits").bitwiseXOR(F.col("flip")).alias("spot")).distinct()
    least = rows.groupBy("spot").agg(F.min("bits").alias("b"), F.count("*").alias("n")).where("n > 1").withColumnRenamed("spot", "at")
    tied = rows.join(least, F.col("spot") == F.col("at")).where(F.col("bits") != F.col("b"))
    return tied.select(F.col("bits").alias("a"), "b")


def near_duplicates(docs: DataFrame, words: int = WORDS, radius: int = RADIUS, seed: int = SEED, carry: Sequence[str] = ()) -> DataFrame:
    """Fingerprint and group of each document: (doc_id, bits, component_id, root), and the columns named in `carry`.

    Documents are linked if their fingerprints differ in `radius` bits or less, 2 at most; component_id is the smallest
    doc_id that links reach, itself included, and root the smallest fingerprint. Equal fingerprints meet once, so copies cost
    nothing more; rows of a fingerprint that many documents have are spread over several tasks.

    Null and empty texts have the fingerprint 0 and link like others. A null doc_id is never the smallest; a group of nulls
    alone has component_id null. Repeated rows stay. An empty table gives an empty result. Other columns are not read.
    """
    if not 0 <= radius <= 2:
        raise ValueError("large buckets are exact for a radius of 0 to 2")
    all_bits = stage(fingerprints(docs, words, seed, carry), "fingerprints")
    prints = stage(all_bits.groupBy("bits").agg(F.min("doc_id").alias("first")), "prints")
    joined = components(links(prints.select("bits"), radius))
    members = joined.join(prints, F.col("node") == F.col("bits")).select("node", "component", "first")
    firsts = members.groupBy("component").agg(F.min("first").alias("component_id")).withColumnRenamed("component", "root")
    linked = members.join(firsts, F.col("component") == F.col("root")).select("node", "component_id", "root")
    groups = prints.join(linked, F.col("bits") == F.col("node"), "left").select(
        "bits", F.when(F.col("node").isNull(), F.col("first")).otherwise(F.col("component_id")).alias("component_id"), F.coalesce("root", "bits").alias("root")
    )
    found = lookup_join(all_bits, groups, ["bits"], "bits", hot_weights(all_bits, "bits"))
    return found.select("doc_id", "bits", "component_id", "root", *carry)


def as_hex(bits: Column) -> Column:
    return F.lower(F.lpad(F.hex(bits), 16, "0"))


def keep_one(docs: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """The rows of `docs`, of each group of near duplicates only the one with the smallest doc_id.

    Groups are those of `near_duplicates`. Null texts count as empty. A null doc_id comes last; of several rows with the
    smallest id one stays, which is the same in each run unless they are equal in id and text. Decisions are made on
    digests of id and text. A fixed-size filter then tells the rows that surely stay, which are not shuffled, from those
    that may go or repeat; these are brought together by digest, combined before the shuffle. All columns are kept. An
    empty table gives an empty result.
    """
    own = F.unhex(F.md5(F.concat(F.md5(F.coalesce("text", F.lit(""))), F.lit("|"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")))))
    groups = near_duplicates(docs.select("doc_id", "text", own.alias("pair")), words, radius, carry=["pair"])
    groups = stage(groups.select("doc_id", "root", "pair"), "groups")
    best = groups.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "pair")).alias("best"))
    chosen = best.select(F.col("best.pair").alias("kept"))
    counted = groups.groupBy("pair").agg(F.count("*").alias("n")).join(chosen, F.col("pair") == F.col("kept"), "left")
    special = stage(counted.where("kept IS NULL OR n > 1").select("pair", F.col("kept").isNotNull().alias("stays")), "special")
    rows = docs.select(F.struct("*").alias("doc"), own.alias("own"))
    rows = rows.withColumn("unsure", may_hold(special.select("pair"))(F.col("own")))
    unsure = rows.where("unsure").groupBy("own").agg(F.first("doc").alias("doc"))  # rows not in `special` have no equal
    unsure = unsure.join(special, F.col("own") == F.col("pair"), "left").where("stays IS NULL OR stays")
    return rows.where("NOT unsure").select("doc.*").union(unsure.select("doc.*"))
