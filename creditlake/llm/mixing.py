"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creditlake.llm.common import ranked, word_count
from creditlake.settings import stage

#: Fixed values of the mix: weights of the sources in turn, share of all words, most copies of a source.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
SEED = "mix-1"


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Words to take of each source: rows (source, source_size, target) from (source, source_size).

    Sources in the order of their code points, null last, weigh as `weights` says, over and over. They share `share`
    times all words in proportion; a target stops at `most` times the size of its source, and what is above is
    shared again among the others until none is above. Each pass needs three sums, so the sources themselves
    never come to the driver.
    """
    whole = sizes.withColumn("_all", F.lit(1))
    numbered = ranked(whole, ["_all"], [F.col("source").asc_nulls_last()], "place")
    turn = F.array(*(F.lit(float(w)) for w in weights))
    weighed = stage(
        numbered.select("source", "source_size", F.element_at(turn, (F.col("place") % len(weights) + 1).cast("int")).alias("weight")),
        "sources",
    )
    cap = F.col("source_size").cast("double") * most
    total = weighed.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level, full = 0.0, -1
    while True:
        above = F.col("weight") * level > cap
        n, taken, rest = weighed.agg(
            F.coalesce(F.sum(above.cast("int")), F.lit(0)),
            F.coalesce(F.sum(F.when(above, cap)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0)),
        ).first()
        if n == full or not rest:
            break
        level, full = (share * total - taken) / rest, n
    target = F.when(F.col("weight") * level > cap, cap).otherwise(F.col("weight") * level)
    return weighed.select("source", "source_size", target.cast("double").alias("target"))


def mix(docs: DataFrame, seed: str = SEED, share: float = SHARE, most: float = MOST, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """How many copies of each document the mix takes: (doc_id, source, text_key, size, source_size, target, copies).

    Within a source, documents stand in the order of their size, then id, then text. All expect the same number of
    copies, target over source size; the expected copies are summed along the order, the sum is shifted by one
    offset between 0 and 1 that depends on seed and source, and a document is taken once for each whole number that
    the sum crosses at it. As neighbours have nearly the same size, the words taken differ from the target by
    about one large document at most. The expectation is 2 or less, so no document is taken more than twice.

    A null text has size 0, a null source is a source of its own, repeated rows are documents of their own, and
    reruns take the same. An empty table gives an empty result. A source without words has the target 0 and gives
    nothing. Only doc_id, source and text are read.
    """
    text = F.col("text")
    rows = docs.select("doc_id", "source", F.md5(text).alias("text_key"), word_count(text).alias("size"))
    order = [F.col("size"), F.col("doc_id"), F.col("text_key")]
    placed = stage(ranked(rows, ["source"], order, "place"), "placed")
    goals = targets(placed.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    goals = goals.withColumn("expected", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    drawn = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("source"), F.lit("")))), 1, 5), 16, 10)
    goals = goals.withColumn("offset", drawn.cast("double") / F.lit(1048576.0)).withColumnRenamed("source", "_source")
    crossed = lambda k: F.floor(k * F.col("expected") + F.col("offset"))
    copies = (crossed(F.col("place") + 1) - crossed(F.col("place"))).cast("int")
    return placed.join(goals, F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id", "source", "text_key", "size", "source_size", "target", copies.alias("copies")
    )


def mixed(docs: DataFrame) -> DataFrame:
    """The mix itself: rows of `docs` with all their columns, each as often as `mix` takes it.

    Texts are shuffled once, to meet their copies by a digest of id, source and text. Rows equal in these three
    share their copies as evenly as whole numbers allow.
    """
    key = F.md5(F.to_json(F.struct(F.col("doc_id"), F.col("source"), F.col("text_key"))))
    plan = mix(docs).select(key.alias("key"), "copies").groupBy("key").agg(F.sum("copies").alias("copies"), F.count("*").alias("rows"))
    plan = plan.where("copies > 0").withColumnRenamed("key", "plan_key")
    rows = docs.select(F.struct("*").alias("doc"), "doc_id", "source", F.md5("text").alias("text_key"))
    rows = rows.select("doc", key.alias("key")).join(plan, F.col("key") == F.col("plan_key"))
    number = F.row_number().over(Window.partitionBy("key").orderBy("key"))
    share = lambda n: F.floor(F.col("copies") * n / F.col("rows"))
    rows = rows.withColumn("number", number).withColumn("own", (share(F.col("number")) - share(F.col("number") - 1)).cast("int"))
    copies = F.explode(F.expr("IF(own > 0, sequence(1, own), CAST(array() AS array<int>))"))
    return rows.select("doc", copies.alias("copy")).select("doc.*")
