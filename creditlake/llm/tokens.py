"""Token ids in ORC files, written in the order of the documents and read back."""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditlake.llm.common import partitions, small_batches
from creditlake.settings import scratch_path

END_ID = 0
#: Bytes of texts that are encoded at once, or one longer text.
RUN_BYTES = 4 << 20
#: Distinct pieces whose ids a Python worker holds, about 200 bytes each.
PIECES = 800_000
_WORD = re.compile(r"[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")
#: Signs after a word, without the apostrophe, which may belong to the word.
_SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_encoders: dict[tuple[str, int], "Encoder"] = {}
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallel ones

SCHEMA = "doc_id long, part int, first long, n_tokens int, ids array<int>"


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """The tokenizers library, asked once for each distinct piece between spaces.

    A byte-level pre-tokenizer always starts a new token at a space that is followed by a character that is no white
    space, so such texts are the pieces' ids in a row. Other texts are encoded whole, among them those that hold one of the
    vocabulary's added tokens, which the library reads as that token. `most` bounds the pieces held; the rest are encoded
    again each time.
    """

    def __init__(self, file: str, most: int = PIECES):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(file)
        added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.added = "|".join(map(re.escape, added)) or r"[^\s\S]"
        self.most = most
        self.kind = np.dtype(np.uint16 if self.tok.get_vocab_size() <= 1 << 16 else np.uint32)
        pre = self.tok.pre_tokenizer
        self.by_piece = pre is not None and self.tok.normalizer is None and "ByteLevel" in repr(pre) and "use_regex=True" in repr(pre)
        self.bytes_of = np.zeros(self.tok.get_vocab_size(), np.int64)
        for token, i in self.tok.get_vocab().items():
            self.bytes_of[i] = len(token)
        self.inner: dict[str, bytes] = {}
        self.first: dict[str, bytes] = {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.kind).tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece after a space, from one text of all of them, cut by the bytes that tokens stand for."""
        if not pieces:
            return []
        ids = np.array(self.tok.encode_batch_fast([" " + " ".join(pieces)], add_special_tokens=False)[0].ids, self.kind)
        ends = np.cumsum(pc.binary_length(pa.array(pieces, pa.string())).to_numpy().astype(np.int64) + 1)
        cuts = (np.searchsorted(np.cumsum(self.bytes_of[ids]), ends) + 1) * self.kind.itemsize
        raw, cuts = ids.tobytes(), cuts.tolist()
        return [raw[start:stop] for start, stop in zip([0, *cuts], cuts)]

    def _new(self, pieces: list[str]) -> list[bytes]:
        """The same for distinct pieces not held. A word and the ASCII signs after it are asked for apart, as they are tokens apart."""
        words, tails, is_word = [], [], _WORD.fullmatch
        for p in pieces:
            w = p.rstrip(_SIGNS)
            apart = len(w) < len(p) and (w.isalpha() if w.isascii() else is_word(w))
            words.append(w if apart else p)
            tails.append(p[len(w) :] if apart else "")
        asked = list(dict.fromkeys(words))
        found = list(map(self.inner.get, asked))
        missing = [w for w, ids in zip(asked, found) if ids is None]
        fresh = iter(self._pieces(missing))
        known = dict(zip(asked, (next(fresh) if ids is None else ids for ids in found)))
        if len(self.inner) + len(missing) <= self.most:
            self.inner.update(known)
        missing = [t for t in dict.fromkeys(tails) if t and t not in self.first]
        if missing:
            self.first.update(zip(missing, self._whole(missing)))
        return [known[w] + self.first[t] if t else known[w] for w, t in zip(words, tails)]

    def _bytes(self, pieces: list[str]) -> list[bytes]:
        """The ids of distinct pieces that follow a space."""
        found = list(map(self.inner.get, pieces))
        missing = [p for p, ids in zip(pieces, found) if ids is None]
        if missing:
            fresh = self._new(missing)
            if len(self.inner) + len(fresh) <= self.most:
                self.inner.update(zip(missing, fresh))
            rest = iter(fresh)
            found = [next(rest) if ids is None else ids for ids in found]
        return found

    def encode(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, as numbers of `kind`, and how many each text has."""
        if len(self.first) > self.most // 4:
            self.first.clear()
        split = pc.split_pattern(texts, " ")
        offsets = split.offsets.to_numpy().astype(np.int64)
        coded = split.values.dictionary_encode()
        pieces, place = coded.dictionary.to_numpy(zero_copy_only=False), coded.indices.to_numpy().astype(np.int64)
        heads = offsets[:-1]
        # White space that runs over a cut, an added token, or no text at all: such texts are encoded whole.
        opens = pc.utf8_slice_codeunits(coded.dictionary, 0, 1).dictionary_encode()
        odd = np.array([c == "" or c.isspace() for c in opens.dictionary.to_pylist()], bool)[opens.indices.to_numpy()][place]
        odd[heads] = False
        whole = np.add.reduceat(odd, heads) > 0 if len(heads) else np.zeros(0, bool)
        whole |= pc.equal(texts, "").to_numpy(zero_copy_only=False) | pc.match_substring_regex(texts, self.added).to_numpy(zero_copy_only=False)
        whole |= not self.by_piece
        n_pieces = np.diff(offsets)
        inner = np.repeat(~whole, n_pieces)
        inner[heads] = False
        is_used = np.zeros(len(pieces), bool)
        is_used[place[inner]] = True
        used = np.flatnonzero(is_used)
        first, back = np.unique(place[heads[~whole]], return_inverse=True)
        as_whole = np.flatnonzero(whole)
        found = self._bytes(pieces[used].tolist())
        found += self._whole(pieces[first].tolist() + [texts[i].as_py() for i in as_whole.tolist()])
        # A whole text stands at the place of its first piece, and its other pieces are left out.
        number = np.full(len(place), -1, np.int64)
        renumbered = np.zeros(len(pieces), np.int64)
        renumbered[used] = np.arange(len(used))
        number[inner] = renumbered[place[inner]]
        number[heads[~whole]] = len(used) + back
        number[heads[as_whole]] = len(used) + len(first) + np.arange(len(as_whole))
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // self.kind.itemsize
        ids, starts = np.frombuffer(b"".join(found), self.kind), np.cumsum(sizes) - sizes
        n = np.where(number >= 0, sizes[number], 0) if len(found) else np.zeros(0, np.int64)
        out = []
        for i in range(0, len(number), 1 << 19):  # bounded memory for long texts
            own, turn = n[i : i + (1 << 19)], number[i : i + (1 << 19)]
            shift = starts[turn] - (np.cumsum(own) - own)
            out.append(ids[np.repeat(shift, own) + np.arange(own.sum())])
        return np.concatenate(out) if out else np.empty(0, self.kind), np.add.reduceat(n, heads) if len(heads) else n


def _encoder(file: str, most: int) -> Encoder:
    """One encoder for each Python worker, which runs many tasks."""
    if (file, most) not in _encoders:
        _encoders[file, most] = Encoder(file, most)
    return _encoders[file, most]


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID, parts: int | None = None, pieces: int = PIECES) -> None:
    """Encode whole texts and write one row for each document as ORC, ordered by doc_id over all files.

    Texts are range partitioned by id, then encoded, so they are shuffled once and each file holds a range of ids. A
    row has the id, the number of its file, the ids before it in that file, and its own ids with the end id. ORC packs
    the ids by its integer run-length encoding; row indexes each 1,000 rows and Bloom filters on doc_id let a reader of
    few documents skip stripes and rows, and stripes of 16 MB are read in parallel.

    A null text is encoded as an empty one and has the end id only. Null ids come first; equal ids are ordered by a hash of the text.
    An empty table gives files without rows. Other columns are not read.
    """
    spark = docs.sparkSession
    file = tokenizer or tokenizer_path()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    keys = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    rows = rows.repartitionByRange(max(2, parts or partitions(spark)), *keys).sortWithinPartitions(*keys)
    schema = pa.schema(
        [("doc_id", pa.int64()), ("part", pa.int32()), ("first", pa.int64()), ("n_tokens", pa.int32()), ("ids", pa.list_(pa.int32()))]
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(file, pieces)
        part, first = TaskContext.get().partitionId(), 0
        for b in small_batches(batches, RUN_BYTES):
            values, n = encoder.encode(b.column(1))
            ends = np.cumsum(n + 1)
            values = np.insert(values.astype(np.int32), np.cumsum(n), end_id)
            columns = [
                b.column(0),
                pa.array(np.full(b.num_rows, part, np.int32)),
                pa.array(first + ends - n - 1),
                pa.array((n + 1).astype(np.int32)),
                pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(values)),
            ]
            first += int(ends[-1])
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    encoded = rows.mapInArrow(encode, SCHEMA)
    options = {
        "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01", "orc.create.index": "true",
        "orc.row.index.stride": "1000", "orc.stripe.size": str(16 << 20), "compression": "zstd",
    }
    encoded.write.options(**options).orc(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The written rows; filters on doc_id are pushed to the files' statistics and Bloom filters."""
    return spark.read.schema(SCHEMA).orc(path)


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """Of each written document, from the files: (doc_id, start, n_tokens, ids_crc32).

    start counts the ids of all documents before it. The ids in each file are one small row for each file, whose
    number is an argument of the writer; their running sum is broadcast.
    """

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("ids")
            offsets, values = ids.offsets.to_numpy(), ids.values.to_numpy().astype("<u4")
            crc = [zlib.crc32(values[a:z].tobytes()) for a, z in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            n = pa.array(np.diff(offsets).astype(np.int64))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("part"), b.column("first"), n, pa.array(crc, pa.int64())], names=["doc_id", "part", "first", "n_tokens", "ids_crc32"])

    files = read_tokens(spark, path)
    rows = files.select("doc_id", "part", "first", "ids").mapInArrow(sums, "doc_id long, part int, first long, n_tokens long, ids_crc32 long")
    parts = sorted(files.groupBy("part").agg(F.max(F.col("first") + F.col("n_tokens"))).collect())
    starts, total = [], 0
    for part, n in parts:
        starts.append((part, total))
        total += n
    before = F.broadcast(spark.createDataFrame(starts, "of_part int, before long"))
    rows = rows.join(before, F.col("part") == F.col("of_part"))
    return rows.select("doc_id", (F.col("first") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def encode_documents(docs: DataFrame, path: str | None = None, tokenizer: str | None = None, pieces: int = PIECES) -> DataFrame:
    """Write the ids of `docs` under `path`, by default in the shared folder, and return their index from the files."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "tokens")
    write_tokens(docs, path, tokenizer, pieces=pieces)
    return token_index(spark, path)
