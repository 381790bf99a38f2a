"""Benchmark passages in documents, with a few edits: pigeonhole pieces verified by Myers' bit-parallel distance."""

from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditlake.llm.common import small_batches

#: Edits allowed, as a part of the item's length. Items shorter than the second number, after normalising, allow none, and must
#: stand between word borders.
ERRORS = 0.1
SHORTEST = 40
#: Characters of benchmark text that one pass over the documents searches; more text takes more passes.
BLOCK = 8 << 20


def normalise(text: str) -> str:
    """Lower case, and one space for each run of white space."""
    return " ".join(text.lower().split())


def myers(pattern: str, text: str, most: int) -> tuple[int, int] | None:
    """Least edits between `pattern` and any part of `text`, with the end of the first such part; None if over `most`.

    Myers' bit-parallel columns, with Python's integers as words of the pattern's length.
    """
    m = len(pattern)
    if not m:
        return 0, 0
    rows: dict[str, int] = {}
    for i, c in enumerate(pattern):
        rows[c] = rows.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best, end = full, 0, m, m, 0
    for j, c in enumerate(text):
        eq = rows.get(c, 0)
        x = eq | down
        d = ((((eq & up) + up) ^ up) | eq) & full
        right = down | (full & ~(d | up))
        left = up & d
        if right & top:
            score += 1
        elif left & top:
            score -= 1
        right, left = (right << 1) & full, (left << 1) & full
        up = left | (full & ~(x | right))
        down = right & x
        if score < best:
            best, end = score, j + 1
            if not best:
                break
    return (best, end) if best <= most else None


@dataclass
class Item:
    """A test item and its pieces: a binary tree whose leaves allow no edit, and whose nodes allow those of their parts and one."""

    item_id: int
    text: str
    budget: int
    leaves: list[tuple[int, int, list[tuple[int, int, int]]]] = field(default_factory=list)

    def __post_init__(self):
        self._split(0, len(self.text), self.budget, [])

    def _split(self, start: int, stop: int, budget: int, above: list[tuple[int, int, int]]) -> None:
        """`budget` edits in a range leave one of its parts within that part's budget, so one leaf is met exactly."""
        if budget == 0:
            self.leaves.append((start, stop, above))
            return
        first = (budget - 1) // 2
        at = start + (stop - start) * (first + 1) // (budget + 1)
        above = [(start, stop, budget), *above]
        self._split(start, at, first, above)
        self._split(at, stop, budget - 1 - first, above)

    def verify(self, text: str, at: int, above: list[tuple[int, int, int]], leaf: int) -> tuple[int, int] | None:
        """Edits and end of the item near the leaf that was met at `at`: ever larger ranges, up to the whole item."""
        found = (0, 0)
        for start, stop, budget in above:
            left = max(0, at - (leaf - start) - budget)
            right = min(len(text), at - (leaf - start) + (stop - start) + budget)
            part = self.text[start:stop]
            exact = text.find(part, left, right)
            found = (0, exact + len(part) - left) if exact >= 0 else myers(part, text[left:right], budget)
            if found is None:
                return None
            found = (found[0], found[1] + left)
        return found if above else (0, at + len(self.text))


class Searcher:
    """All pieces of a block of items in one automaton."""

    def __init__(self, items: list[tuple[int, str]], errors: float, shortest: int):
        import ahocorasick

        self.items = [Item(i, t, int(len(t) * errors) if len(t) >= shortest else 0) for i, t in items if t]
        self.short = [len(t) < shortest for _, t in items if t]
        pieces: dict[str, list[tuple[int, int]]] = {}
        for n, item in enumerate(self.items):
            for k, (start, stop, _) in enumerate(item.leaves):
                pieces.setdefault(item.text[start:stop], []).append((n, k))
        self.automaton = ahocorasick.Automaton()
        for piece, owners in pieces.items():
            self.automaton.add_word(piece, owners)
        if pieces:
            self.automaton.make_automaton()

    def search(self, text: str) -> dict[int, tuple[int, int]]:
        """The items found in a normalised text: the place of each in the block, with edits and end of its best part."""
        best: dict[int, tuple[int, int]] = {}
        tried: dict[int, set[int]] = {}
        if not self.items:
            return best
        for end, owners in self.automaton.iter(text):
            for n, k in owners:
                if n in best and best[n][0] == 0:
                    continue
                item = self.items[n]
                start, stop, above = item.leaves[k]
                at = end + 1 - (stop - start)
                if self.short[n] and (text[at - 1 : at].isalnum() or text[end + 1 : end + 2].isalnum()):
                    continue
                # One item, one diagonal, one leaf: repeated words of a leaf are tried at each place, others once.
                seen = tried.setdefault(n, set())
                spot = (at - start) * len(item.leaves) + k
                if spot in seen:
                    continue
                seen.add(spot)
                found = item.verify(text, at, above, start)
                if found and (n not in best or found < best[n]):
                    best[n] = found
        return best


def matches(docs: DataFrame, benchmark: DataFrame, errors: float = ERRORS, shortest: int = SHORTEST, block: int = BLOCK) -> DataFrame:
    """Items that occur in documents: (doc_id, item_id, edits, allowed, end), one row for each document and item.

    Texts are compared in lower case with single spaces. An item of n characters may differ by up to `errors` times n edits,
    rounded down. It is cut into one piece more than that, one of which must then occur as it is; pieces are searched all at
    once, and a hit is verified over twice the range again and again, by Myers' distance with the edits that range may
    have, up to the whole item. `edits` is the least found and `end` where that part ends in the compared text. Items shorter
    than `shortest` are found where they stand as they are, with no letter or digit beside them.

    The test items are broadcast in blocks of `block` characters, each of which is one more pass over the documents, so
    a large benchmark takes longer but no more memory. Whole texts are searched and all items reported.

    Null and empty texts contain nothing; null and empty items are not searched. Repeated documents
    and items give repeated rows. Empty tables give an empty result. Other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.col("text").isNotNull())
    schema = "doc_id long, item_id long, edits int, allowed int, end int"
    result = None
    for items in _blocks(benchmark, block):
        shared = spark.sparkContext.broadcast(items)

        def find(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            searcher = Searcher(shared.value, errors, shortest)
            for b in small_batches(batches):
                out = []
                for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    for n, (edits, end) in searcher.search(normalise(text)).items():
                        out.append((i, searcher.items[n].item_id, edits, searcher.items[n].budget, end))
                types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
                columns = [pa.array([r[c] for r in out], t) for c, t in enumerate(types)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "item_id", "edits", "allowed", "end"])

        found = rows.mapInArrow(find, schema)
        result = found if result is None else result.unionByName(found)
    return result if result is not None else spark.createDataFrame([], schema)


def _blocks(benchmark: DataFrame, block: int) -> Iterator[list[tuple[int, str]]]:
    """The test items on the driver, never more than `block` characters and one item at a time."""
    held, size = [], 0
    for item_id, text in benchmark.select(F.col("item_id").cast("long"), "text").where(F.col("text").isNotNull()).toLocalIterator():
        text = normalise(text)
        if held and size + len(text) > block:
            yield held
            held, size = [], 0
        held.append((item_id, text))
        size += len(text)
    if held:
        yield held


def contaminated(docs: DataFrame, benchmark: DataFrame, errors: float = ERRORS) -> DataFrame:
    """Documents with test items: (doc_id, item_ids, least_edits), the items in rising order."""
    found = matches(docs, benchmark, errors)
    return found.groupBy("doc_id").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"), F.min("edits").alias("least_edits"))


def clean(docs: DataFrame, benchmark: DataFrame, errors: float = ERRORS) -> DataFrame:
    """The rows of `docs` in which no test item occurs, with all their columns; texts are neither cut nor shuffled."""
    spark = docs.sparkSession
    for items in _blocks(benchmark, BLOCK):
        docs = docs.where(~_holds(spark.sparkContext.broadcast(items), errors)("text"))
    return docs


def _holds(shared: Broadcast, errors: float):
    @F.pandas_udf("boolean")
    def holds(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        searcher = Searcher(shared.value, errors, SHORTEST)
        for batch in texts:
            yield pd.Series([t is not None and bool(searcher.search(normalise(t))) for t in batch], dtype=bool)

    return holds
