"""Fill-in-the-middle rearrangement of texts, cut with a wavelet matrix over character classes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditlake.llm.common import small_batches

# Marks of the parts, and the shares of the forms in percent.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
CHANGED, SUFFIX_FIRST = 90, 20

#: Classes of the bytes of a UTF-8 text. A byte that goes on with a character is none of the others.
INNER, GO_ON, SPACE, LINE_FEED, WORD_START = range(5)
#: What begins a unit: boundaries are counted by adding the ranks of these classes.
UNITS = {"characters": (INNER, SPACE, LINE_FEED, WORD_START), "words": (WORD_START,), "lines": (LINE_FEED,)}
_TABLE = np.full(256, INNER, np.uint8)
_TABLE[0x80:0xC0] = GO_ON
_TABLE[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = SPACE
_TABLE[0x0A] = LINE_FEED


def classes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The class of each byte of several texts in a row that begin at `starts`. White space is that of ASCII."""
    own = _TABLE[data]
    white = (own == SPACE) | (own == LINE_FEED)
    before = np.empty(len(own), bool)
    before[1:] = white[:-1]
    before[starts[starts < len(own)]] = True
    own[before & (own == INNER)] = WORD_START
    return own


class WaveletMatrix:
    """Ranks of symbols below 2**bits in a sequence, in one step for each bit, for many places at once (Claude, Navarro, Ordonez, 2015).

    Level by level, from the highest bit, the sequence is parted stably by that bit: zeros first. A level keeps its bits packed,
    eight to a byte, and the ones before each block of 64 bits.
    """

    def __init__(self, symbols: np.ndarray, bits: int = 3):
        self.n, self.bits, self.levels = len(symbols), bits, []
        for b in range(bits - 1, -1, -1):
            bit = (symbols >> b & 1).astype(bool)
            packed = np.packbits(bit, bitorder="little")
            words = np.zeros(self.n // 64 + 1, "<u8")
            words.view(np.uint8)[: len(packed)] = packed
            ones = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
            self.levels.append((b, words, ones, self.n - int(ones[-1])))
            symbols = np.concatenate([symbols[~bit], symbols[bit]])

    @staticmethod
    def _ones(level, at: np.ndarray) -> np.ndarray:
        """Set bits before each place."""
        _, words, ones, _ = level
        block, rest = at >> 6, (at & 63).astype(np.uint64)
        mask = (np.uint64(1) << rest) - np.uint64(1)
        return ones[block] + np.bitwise_count(words[block] & mask)

    def rank(self, symbol: int, at: np.ndarray) -> np.ndarray:
        """How often `symbol` occurs before each place."""
        low, at = np.zeros_like(at), at.copy()
        for level in self.levels:
            b, _, _, zeros = level
            low_ones, at_ones = self._ones(level, low), self._ones(level, at)
            low, at = (zeros + low_ones, zeros + at_ones) if symbol >> b & 1 else (low - low_ones, at - at_ones)
        return at - low

    def boundaries(self, symbols: tuple[int, ...], at: np.ndarray) -> np.ndarray:
        """How many of the symbols occur before each place: the sum of their ranks."""
        return sum((self.rank(s, at) for s in symbols), np.zeros_like(at))

    def locate(self, symbols: tuple[int, ...], k: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The smallest place in [low, high] with `k` of the symbols before it, by bisection on the ranks; `high` if there is none."""
        low, high = low.copy(), high.copy()
        while (open_ := low < high).any():
            mid = (low + high) >> 1
            enough = self.boundaries(symbols, mid) >= k
            high = np.where(open_ & enough, mid, high)
            low = np.where(open_ & ~enough, mid + 1, low)
        return low


def cut_texts(texts: list[bytes], shares: np.ndarray, units: str = "characters") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of UTF-8 texts: their units, the units before both cuts, and the bytes before both cuts.

    `shares` has two numbers h for each text: its cuts are at h mod (units + 1), in rising order. In words and lines a cut is just
    before the unit's first byte or after the line feed that ends it; all bytes after the last cut belong to the last part.
    """
    symbols = UNITS[units]
    lengths = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    data = np.frombuffer(b"".join(texts), np.uint8)
    matrix = WaveletMatrix(classes(data, starts[lengths > 0]))
    base = matrix.boundaries(symbols, starts)
    n = matrix.boundaries(symbols, ends) - base
    at = np.sort(shares % (n + 1)[:, None], axis=1)
    places = np.empty_like(at)
    for j in (0, 1):
        if units == "lines":  # after the k-th line feed
            places[:, j] = matrix.locate(symbols, base + at[:, j], starts, ends)
        else:  # before unit k + 1, which is one byte before the place with one more unit behind it
            after = matrix.locate(symbols, base + at[:, j] + 1, starts, ends)
            places[:, j] = np.where(at[:, j] < n, after - 1, ends)
    return n, at, places - starts[:, None]


def _hashes(doc_id: Column) -> list[Column]:
    """The first four groups of eight digits of the SHA-256 of "1:" and the id, as numbers."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(docs: DataFrame, units: str = "characters", changed: int = CHANGED, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output, text): each whole text cut twice and put in another order.

    n is the number of units; prefix_chars and middle_chars are code points. Of 100 ids, `changed` are cut; of these
    `suffix_first` of 100 take the form spm (suffix, prefix, middle), the others psm (prefix, suffix, middle). Cuts and forms
    come from a hash of the id, so reruns agree. Texts that are empty or hold one of the marks stay as they are, form plain,
    as do those not drawn; their counts of code points are null.

    A null text is an empty one. A null id is hashed as an empty string. Repeated rows stay. An empty table gives an empty
    result. Other columns are not read. Tasks work on one run of texts at a time, of about 4 MB or a single text.
    """
    if units not in UNITS:
        raise ValueError(f"units are one of {sorted(UNITS)}")
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "text"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    p, s, m = marks

    def rearrange(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, 4 << 20):
            texts = b.column(1).to_pylist()
            h = [b.column(i).to_numpy() for i in (2, 3, 4, 5)]
            n, _, cuts = cut_texts(texts, np.stack(h[:2], axis=1), units)
            out, forms, heads, middles = [], [], [], []
            for i, t in enumerate(texts):
                if not t or h[2][i] % 100 >= changed or any(x in t for x in marks):
                    out.append(t), forms.append("plain"), heads.append(None), middles.append(None)
                    continue
                a, z = cuts[i].tolist()
                head, middle, tail = t[:a], t[a:z], t[z:]
                spm = h[3][i] % 100 < suffix_first
                out.append(s + tail + p + head + m + middle if spm else p + head + s + tail + m + middle)
                forms.append("spm" if spm else "psm")
                heads.append(len(head.decode("utf-8", "replace")) if units != "characters" else None)
                middles.append(len(middle.decode("utf-8", "replace")) if units != "characters" else None)
            if units == "characters":  # the cuts are code points already
                at = np.sort(np.stack(h[:2], axis=1) % (n + 1)[:, None], axis=1)
                heads = [None if f == "plain" else int(a) for f, a in zip(forms, at[:, 0])]
                middles = [None if f == "plain" else int(d) for f, d in zip(forms, at[:, 1] - at[:, 0])]
            columns = [b.column(0), pa.array(n), pa.array(forms), pa.array(heads, pa.int64()), pa.array(middles, pa.int64())]
            columns += [pa.array(out, pa.binary()).cast(pa.string()), b.column(1).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([c.cast(k) for c, k in zip(columns, kinds)], names=names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text"), *(c.alias(f"h{i}") for i, c in enumerate(_hashes(F.col("doc_id").cast("long")))))
    return rows.mapInArrow(rearrange, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string, text string")


def restored(output: Column, form: Column) -> Column:
    """The text that was rearranged, from its output and form alone. The marks cannot be in a text that was cut, nor overlap."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    part = lambda i: F.get(parts, F.lit(i))
    return F.when(form == "psm", F.concat(part(1), part(3), part(2))).when(form == "spm", F.concat(part(2), part(3), part(1))).otherwise(output)
