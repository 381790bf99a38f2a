"""Toxicity by non-negative positive-unlabelled learning (Kiryo et al., 2017)."""

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditlake.llm.common import in_training, small_batches
from creditlake.settings import stage

#: The most labelled toxic documents and documents of all kinds that the classifiers are fitted on, those with the least hash of their id.
POSITIVES = 6_000
UNLABELLED = 18_000
#: Classifiers, each fitted without one of as many parts of the sample.
BAGS = 4
BUCKETS = 1 << 18
FEATURES = 512
LEAST_Z = 5.0

_LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> np.ndarray:
    """Hashes of the distinct words of a whole text, words being runs of letters in lower case."""
    found = set(_LETTERS.findall((text or "").lower()))
    return np.unique(np.fromiter((zlib.crc32(w.encode()) & (BUCKETS - 1) for w in found), np.int32, len(found)))


@dataclass(frozen=True)
class Model:
    """A logistic score of which listed words a text holds; no word lowers it."""

    words: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, own: np.ndarray) -> float:
        if not len(self.words):
            return 0.0
        at = np.minimum(np.searchsorted(self.words, own), len(self.words) - 1)
        z = self.bias + float(self.weights[at[self.words[at] == own]].sum())
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _mixed(words: np.ndarray) -> np.ndarray:
    """Other hashes of words, for an order that has nothing to do with the words' own."""
    return (words.astype(np.int64) * 2654435761) & 0xFFFFFFFF


def risk(zx: np.ndarray, zu: np.ndarray, prior: float) -> tuple[float, float]:
    """Both parts of the risk at the scores of toxic and of unlabelled documents, with the logistic loss l and the class prior p.

    The first is p E_toxic l(z). The second, E_all l(-z) - p E_toxic l(-z), estimates that of the clean documents
    among the unlabelled ones.
    """
    return prior * np.logaddexp(0, -zx).mean(), np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zx).mean()


def slopes(zx: np.ndarray, zu: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """The direction to leave by, for each score: the slope of both parts, or, when the second is negative, of its negative alone."""
    clean_u, clean_x = _sigmoid(zu) / len(zu), -prior * _sigmoid(zx) / len(zx)
    if risk(zx, zu, prior)[1] < 0:
        return -clean_x, -clean_u
    return clean_x - prior * (1 - _sigmoid(zx)) / len(zx), clean_u


def threshold(zx: np.ndarray, zu: np.ndarray, prior: float) -> float:
    """The score from which a document counts as toxic, so that the same risk with the zero-one loss is least."""
    both = np.concatenate([zx, zu])
    order = np.argsort(-both, kind="stable")
    values, of_toxic = both[order], order < len(zx)
    hit, all_above = np.cumsum(of_toxic) / len(zx), np.cumsum(~of_toxic) / len(zu)
    ends = np.flatnonzero(np.append(values[:-1] != values[1:], True))
    wrong = prior * (1 - hit[ends]) + np.maximum(all_above[ends] - prior * hit[ends], 0)
    best = ends[np.argmin(wrong)]
    below = values[best + 1] if best + 1 < len(values) else values[best] - 1
    return (values[best] + below) / 2


def fit(toxic: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, seed: int = 0, epochs: int = 80) -> Model:
    """A classifier from confirmed toxic documents and a sample of all documents, given as hashes of their words.

    Words are kept if they are more frequent in toxic documents by `LEAST_Z` standard errors, at most `FEATURES` of them;
    for this choice alone, documents with the same eight least hashes count once, or a text with many copies would choose its words. `risk` is made
    least batch by batch; when its second part is negative, that part's slope is followed upwards instead. No label of a clean
    document is used: the bias is set by `threshold`.
    """
    n, m = len(toxic), len(unlabelled)
    if not n or not m:
        return Model(np.empty(0, np.int32), np.empty(0), 0.0)
    kinds = [list({x[np.argsort(_mixed(x), kind="stable")[:8]].tobytes(): x for x in docs}.values()) for docs in (toxic, unlabelled)]
    in_toxic, in_other = (np.bincount(np.concatenate(docs), minlength=BUCKETS) for docs in kinds)
    n, m = map(len, kinds)
    share = (in_toxic + in_other) / (n + m)
    z = (in_toxic / n - in_other / m) / np.sqrt(np.maximum(share * (1 - share) * (1 / n + 1 / m), 1e-12))
    z[in_toxic + in_other < 5] = 0
    words = np.argsort(-z, kind="stable")[:FEATURES]
    words = np.sort(words[z[words] >= LEAST_Z]).astype(np.int32)
    if not len(words):
        return Model(words, np.empty(0), 0.0)

    def matrix(docs: list[np.ndarray]) -> np.ndarray:
        x = np.zeros((len(docs), len(words)), np.float32)
        for i, own in enumerate(docs):
            x[i, np.searchsorted(words, np.intersect1d(words, own, assume_unique=True))] = 1
        return x

    x, u = matrix(toxic), matrix(unlabelled)
    n, m = len(x), len(u)
    rng = np.random.default_rng(seed)
    w, b = np.zeros(len(words)), np.log(prior / (1 - prior))
    mean, square, steps = np.zeros(len(words) + 1), np.zeros(len(words) + 1), 0
    for _ in range(epochs):
        parts = max(1, m // 1000)
        for i, j in zip(np.array_split(rng.permutation(n), parts), np.array_split(rng.permutation(m), parts)):
            if not len(i):
                continue
            gx, gu = slopes(x[i] @ w + b, u[j] @ w + b, prior)
            g = np.append(u[j].T @ gu + x[i].T @ gx + 1e-4 * w, gu.sum() + gx.sum())
            steps += 1
            mean, square = 0.9 * mean + 0.1 * g, 0.999 * square + 0.001 * g * g
            step = 0.05 * (mean / (1 - 0.9**steps)) / (np.sqrt(square / (1 - 0.999**steps)) + 1e-8)
            w, b = np.maximum(w - step[:-1], 0), b - step[-1]

    return Model(words, w, -float(threshold(x @ w, u @ w, prior)))


def learn(docs: DataFrame, labels: DataFrame) -> list[Model]:
    """Classifiers from the training rows of `docs` and `labels`.

    The sample has at most `POSITIVES` documents labelled toxic, and at most `UNLABELLED` of all training documents whatever their
    label, as the risk asks for; the others of the table are scored but not learnt from. The sample's ids
    are broadcast, and each part of it is fitted in a task of its own. The prior is the share of toxic ones among all
    labelled training rows. Without toxic rows or texts the list is empty.
    """
    marked = labels.select(F.col("doc_id").cast("long").alias("id"), "toxic").where(F.col("toxic").isNotNull() & in_training("id"))
    marked = marked.groupBy("id").agg(F.max("toxic").alias("toxic"))
    counted = marked.agg(F.count("*"), F.sum("toxic")).first()
    if not counted[0] or not counted[1]:
        return []
    prior = min(max(counted[1] / counted[0], 1e-4), 0.5)
    by_hash = F.xxhash64("id")
    toxic = marked.where("toxic = 1").orderBy(by_hash, "id").limit(POSITIVES).select("id", F.lit(1).alias("toxic"))
    ids = docs.select(F.col("doc_id").cast("long").alias("id")).where(in_training("id") & F.col("text").isNotNull())
    ids = ids.orderBy(by_hash, "id").limit(UNLABELLED).distinct().select("id", F.lit(0).alias("toxic"))
    chosen = stage(toxic.unionByName(ids), "sample")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            found = [words_of(t) for t in b.column(2).to_pylist()]
            columns = [b.column(0), b.column(1), pa.array([x.tobytes() for x in found], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "toxic", "words"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.col("text").isNotNull())
    rows = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("id")).select("id", "toxic", "text")
    rows = rows.mapInArrow(hashed, "id long, toxic int, words binary")
    bags = F.array(*(F.lit(k) for k in range(BAGS)))
    own = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(BAGS)).cast("int")
    rows = rows.select(F.explode(F.array_remove(bags, own)).alias("bag"), "id", "toxic", "words")

    def train(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["id", "toxic"])
        docs_of = lambda rows: [np.frombuffer(x, np.int32) for x in rows["words"]]
        m = fit(docs_of(part[part.toxic == 1]), docs_of(part[part.toxic == 0]), prior, int(part.bag.iloc[0]))
        return pd.DataFrame({"bag": part.bag.iloc[:1], "words": [m.words.tolist()], "weights": [m.weights.tolist()], "bias": [m.bias]})

    fitted = rows.groupBy("bag").applyInPandas(train, "bag int, words array<int>, weights array<double>, bias double")
    models = [Model(np.array(r.words, np.int32), np.array(r.weights), r.bias) for r in fitted.orderBy("bag").collect()]
    return [m for m in models if len(m.words)]


def score(docs: DataFrame, models: list[Model]) -> DataFrame:
    """(doc_id, score, predicted): the classifiers' mean score of each whole text, and 1 from one half up.

    Null and empty texts have the score of no word; without classifiers all scores are 0. Repeated rows are scored alike,
    an empty table gives an empty result, and other columns are not read.
    """

    @F.pandas_udf("double")
    def toxic(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            found = [words_of(t) for t in batch]
            yield pd.Series([float(np.mean([m.score(x) for m in models])) if models else 0.0 for x in found], dtype=float)

    rows = docs.select("doc_id", "text").withColumn("score", toxic("text"))
    return rows.select("doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores from classifiers learnt on four fifths of the rows: (doc_id, held_out, score, predicted)."""
    scored = score(docs, learn(docs, labels))
    return scored.select("doc_id", (~in_training("doc_id")).alias("held_out"), "score", "predicted")
