"""Language identification by rank-order profiles of n-grams (Cavnar and Trenkle, 1994)."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditlake.llm.common import in_training, small_batches

#: Length of a profile, and the longest n-gram. The most languages that training takes before it stops with an error.
TOP = 300
LONGEST = 3
MOST_LANGUAGES = 1_000
UNKNOWN = "und"

_NOT_LETTERS = re.compile(r"[\W\d_]+")


def _grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of one to three characters in the words of a text, as numbers of 21 bits each, and their counts."""
    words = _NOT_LETTERS.sub(" ", text.lower()).strip()
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    c = np.frombuffer(f" {words} ".encode("utf-32-le", "surrogatepass"), np.int32).astype(np.int64)
    two = (c[:-1] << 21) | c[1:]
    three = (two[:-1] << 21) | c[2:]
    # A lone space says nothing, and no n-gram spans two words.
    return np.unique(np.concatenate([c[c != 32], two, three[c[1:-1] != 32]]), return_counts=True)


def _top(grams: np.ndarray, counts: np.ndarray, top: int) -> np.ndarray:
    """The most frequent n-grams, most frequent first, ties by their number."""
    if len(grams) > 4 * top:
        least = np.partition(counts, len(counts) - top)[len(counts) - top]
        grams, counts = grams[counts >= least], counts[counts >= least]
    return grams[np.lexsort((grams, -counts))][:top]


@dataclass(frozen=True)
class Profiles:
    """Languages and, of each, the n-grams of its profile in rising order with their ranks."""

    languages: tuple[str, ...]
    grams: tuple[np.ndarray, ...]
    ranks: tuple[np.ndarray, ...]
    top: int = TOP

    def predict(self, text: str | None) -> tuple[str, float]:
        """The nearest language and 1 minus its distance as a part of the largest possible."""
        own = _top(*_grams(text or ""), self.top)
        if not len(own) or not self.languages:
            return UNKNOWN, 0.0
        places, best = np.arange(len(own)), (UNKNOWN, -1.0)
        for lang, grams, ranks in zip(self.languages, self.grams, self.ranks):
            at = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
            out = np.where(grams[at] == own, np.abs(ranks[at] - places), self.top)
            score = 1.0 - float(out.sum()) / (self.top * len(own))
            if score > best[1]:
                best = (lang, score)
        return best


def learn_profiles(docs: DataFrame, learn_from: Column, top: int = TOP, most_languages: int = MOST_LANGUAGES) -> Profiles:
    """One profile for each language, from the n-grams of all texts that `learn_from` keeps.

    Tasks count the n-grams of their rows, sums meet by language and n-gram, and each language's `top` n-grams reach the
    driver: its only load, bounded by `top` times `most_languages`. More languages than that is an error.
    """
    rows = docs.where(learn_from & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0

        def merged() -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
            for lang, found in held.items():
                grams, where = np.unique(np.concatenate([g for g, _ in found]), return_inverse=True)
                yield lang, grams, np.bincount(where, np.concatenate([n for _, n in found])).astype(np.int64)

        def rows_of(sums) -> Iterator[pa.RecordBatch]:
            for lang, grams, counts in sums:
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(counts)], names=["lang", "gram", "n"])

        for b in small_batches(batches):
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                grams, counts = _grams(text)
                held.setdefault(lang, []).append((grams, counts))
                size += len(grams)
                if size > 1_000_000:
                    sums = list(merged())
                    size = sum(len(g) for _, g, _ in sums)
                    if size > 500_000:  # mostly new ones: pass them on
                        yield from rows_of(sums)
                        held, size = {}, 0
                    else:
                        held = {lang: [(g, n)] for lang, g, n in sums}
        yield from rows_of(merged())

    sums = rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    by_count = Window.partitionBy("lang").orderBy(F.desc("n"), F.asc("gram"))
    best = sums.withColumn("rank", F.row_number().over(by_count)).where(F.col("rank") <= top).select("lang", "gram", "rank")
    found: dict[str, list[tuple[int, int]]] = {}
    for lang, gram, rank in best.limit(top * most_languages + 1).collect():
        found.setdefault(lang, []).append((gram, rank - 1))
    if len(found) > most_languages:
        raise ValueError(f"more than {most_languages} languages in the training rows")
    languages = tuple(sorted(found))
    tables = [np.array(sorted(found[x]), np.int64) for x in languages]
    return Profiles(languages, tuple(t[:, 0] for t in tables), tuple(t[:, 1] for t in tables), top)


def identify(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """The columns of `docs` plus lang_pred and score, from whole texts.

    A text that is null, empty or without letters is `und` with score 0, and so is every text when nothing was learnt.
    Equal distances go to the language whose name comes first. Columns of the input that are called lang_pred or score are
    replaced. An empty table gives an empty result; repeated rows are predicted alike.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(profiles)  # `top` n-grams for each language
    rows = docs.drop("lang_pred", "score")

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts):
        import pandas as pd

        known = shared.value
        return pd.DataFrame([known.predict(t) for t in texts], columns=["lang_pred", "score"])

    return rows.withColumn("_found", predict("text")).select(*rows.columns, "_found.lang_pred", "_found.score")


def predict_languages(docs: DataFrame) -> DataFrame:
    """Profiles from four fifths of `docs`, predictions for all: (doc_id, held_out, lang_pred, score)."""
    profiles = learn_profiles(docs, in_training("doc_id"))
    rows = docs.select("doc_id", "text", (~in_training("doc_id")).alias("held_out"))
    return identify(rows, profiles).select("doc_id", "held_out", "lang_pred", "score")
