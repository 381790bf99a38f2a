"""Pages as WARC records in seekable Zstandard bundles, and random access to them."""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditlake.llm.common import partitions, small_batches
from creditlake.settings import scratch_path, stage

#: Bytes of records in a frame, before compression; a longer record has a frame of its own.
FRAME_BYTES = 1 << 20
#: A bundle is closed once it has so many bytes.
BUNDLE_BYTES = 64 << 20
#: Shorter payloads are always written in full.
LEAST_SHARED = 100

# Marks of the Zstandard seekable format, and the profile of WARC revisit records.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
URN = "urn:x-page:"

INDEX = (
    "page_id long, record_type string, refers_to long, digest string, file string, frame_offset long, frame_length long, at long, length long"
)
RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One WARC/1.1 record: a response with its payload, or, if `refers_to` names a record, a revisit without it.

    The HTTP header of a revisit keeps the length of the payload it stands for.
    """
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if refers_to else 'response'}", f"WARC-Record-ID: <{urn(page_id)}>", "WARC-Date: 1970-01-01T00:00:00Z"]
    if url:
        # What is printable ASCII stays; the rest could break the header.
        head.append("WARC-Target-URI: " + quote(url, safe="".join(map(chr, range(33, 127))), errors="surrogatepass"))
    if refers_to:
        head += [f"WARC-Profile: {SAME_PAYLOAD}", f"WARC-Refers-To: <{refers_to}>"]
    head += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def urn(page_id: int | None) -> str:
    return f"{URN}{'null' if page_id is None else page_id}"


def _page_of(name: str) -> int | None:
    tail = name.strip("<>").removeprefix(URN)
    return None if tail == "null" else int(tail)


def parse(data: bytes, at: int = 0) -> tuple[dict, int]:
    """The record that starts at `at`, as the columns of RECORD, and where the next one starts.

    The digest of a response is computed from its payload; another one in its header is an error.
    """
    end = data.index(b"\r\n\r\n", at)
    version, *lines = data[at:end].decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"no WARC record at byte {at}")
    fields = dict(line.split(": ", 1) for line in lines)
    start = end + 4
    stop = start + int(fields["Content-Length"])
    if data[stop : stop + 4] != b"\r\n\r\n":
        raise ValueError(f"the record at byte {at} is cut off")
    body = data.index(b"\r\n\r\n", start, stop) + 4
    http = dict(line.split(": ", 1) for line in data[start : body - 4].decode().split("\r\n")[1:])
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha256:")
    found = {
        "page_id": _page_of(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "record_type": kind, "refers_to": None,
        "payload_bytes": int(http["Content-Length"]), "payload_digest": digest, "payload": None,
    }
    if kind == "revisit":
        found["refers_to"] = _page_of(fields["WARC-Refers-To"])
    else:
        payload = data[body:stop]
        if len(payload) != found["payload_bytes"] or hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"the payload of {fields['WARC-Record-ID']} is damaged")
        found["payload"] = payload
    return found, stop + 4


class Bundle:
    """Writes records into frames of one file, which ends with the seek table: a frame that readers of plain Zstandard skip."""

    def __init__(self, store: fs.FileSystem, path: str):
        self.out, self.frames, self.bytes = store.open_output_stream(path, compression=None), [], 0
        self.packer = zstandard.ZstdCompressor(level=3)

    def frame(self, records: list[bytes]) -> tuple[int, int]:
        """Write the records as one frame; where it starts and how long it is."""
        raw = b"".join(records)
        packed = self.packer.compress(raw)
        self.out.write(packed)
        self.frames.append((len(packed), len(raw)))
        start, self.bytes = self.bytes, self.bytes + len(packed)
        return start, len(packed)

    def close(self) -> None:
        table = b"".join(struct.pack("<II", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.out.close()


def seek_table(store: fs.FileSystem, path: str) -> list[tuple[int, int]]:
    """(offset, length) of the frames of a bundle, from its footer alone."""
    with store.open_input_file(path) as f:
        size = f.size()
        n, flags, mark = struct.unpack("<IBI", f.read_at(9, size - 9))
        if mark != SEEKABLE or flags:
            raise ValueError(f"{path} has no seek table")
        lengths = [a for a, _ in struct.iter_unpack("<II", f.read_at(8 * n, size - 9 - 8 * n))]
    frames, at = [], 0
    for length in lengths:
        frames.append((at, length))
        at += length
    return frames


def _frame(f, offset: int, length: int) -> bytes:
    return zstandard.ZstdDecompressor().decompress(f.read_at(length, offset))


def _with_first(pages: DataFrame, least: int) -> DataFrame:
    """Pages with payload, digest, and, where equal payloads are shared, `first`: the smallest page_id of them.

    Only (digest, count, smallest id) are aggregated, combined before the shuffle. Digests that hold more rows than a
    quarter of a partition's share are at most four for each partition, so they are broadcast, and their rows are dealt
    by the task they come from; the rest meet their first record by digest. So no digest makes a large partition.
    """
    n = partitions(pages.sparkSession)
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.cast("binary").alias("payload"), F.sha2(html, 256).alias("digest"))
    shared = rows.where(F.octet_length("payload") >= least).groupBy("digest").agg(F.count("*").alias("n"), F.min("page_id").alias("first"))
    groups = stage(shared.where("n > 1"), "payloads")
    total = groups.agg(F.sum("n")).first()[0] or 0
    hot = F.col("n") > total / (4 * n)
    often = F.broadcast(groups.where(hot).select(F.col("digest").alias("hot"), F.col("first").alias("hot_first")))
    few = groups.where(~hot).select(F.col("digest").alias("few"), F.col("first").alias("few_first"))
    dealt = F.when(F.col("hot").isNull(), F.col("digest")).otherwise(F.concat(F.lit("task "), F.spark_partition_id().cast("string")))
    rows = rows.join(often, F.col("digest") == F.col("hot"), "left").withColumn("dealt", dealt)
    rows = rows.join(few, F.col("dealt") == F.col("few"), "left").withColumn("first", F.coalesce("hot_first", "few_first"))
    in_group = F.col("hot").isNotNull() | F.col("few").isNotNull()
    return rows.withColumn("revisit", in_group & ~F.col("page_id").eqNullSafe(F.col("first")))


def write_archives(
    pages: DataFrame, path: str, least_shared: int = LEAST_SHARED, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES
) -> DataFrame:
    """Write a record for each row of (page_id, url, html) under `path` and return the index of the records.

    Bundles are files `archive/*.warc.zst`; several frames of about `frame_bytes` each are compressed on their own and listed
    in the footer. The index has, for each record, the file, the place and length of its frame, and its place and length
    inside the unpacked frame; it is ordered by page_id. Every attempt of a task writes under a new name and only
    files in the index count, so a lost executor leaves at most a file that nobody reads. `path` lies in a folder that
    executors share, by a scheme that pyarrow opens.

    Of equal payloads of `least_shared` bytes or more, the records with the smallest page_id are responses; the others
    are revisits of it. Rows repeated with that id are all responses. A null id comes after all others; if all ids are null,
    all are responses. Null html is an empty payload. An empty table gives an empty index. Other columns are not read.
    """
    store, root = fs.FileSystem.from_uri(path)
    store.create_dir(f"{root}/archive", recursive=True)
    schema = pa.schema(
        [("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("digest", pa.string()), ("file", pa.string())]
        + [(c, pa.int64()) for c in ("frame_offset", "frame_length", "at", "length")]
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(path)
        bundle, name, waiting, held, size = None, "", [], [], 0

        def flush() -> pa.RecordBatch:
            start, length = bundle.frame(waiting)
            at, rows = 0, []
            for (page_id, refers_to, revisit, digest), data in zip(held, waiting):
                rows.append((page_id, "revisit" if revisit else "response", refers_to, digest, name, start, length, at, len(data)))
                at += len(data)
            waiting.clear(), held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        for b in small_batches(batches):
            for page_id, url, payload, digest, first, revisit in zip(*(c.to_pylist() for c in b.columns)):
                if bundle is None:
                    name = f"archive/{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.zst"
                    bundle = Bundle(store, f"{root}/{name}")
                data = record(page_id, url, payload, digest, urn(first) if revisit else None)
                if size and size + len(data) > frame_bytes:
                    yield flush()
                    size = 0
                waiting.append(data)
                held.append((page_id, first if revisit else None, revisit, digest))
                size += len(data)
                if bundle.bytes + size >= bundle_bytes:
                    yield flush()
                    bundle.close()
                    bundle, size = None, 0
        if waiting:
            yield flush()
        if bundle:
            bundle.close()

    rows = _with_first(pages, least_shared).select("page_id", "url", "payload", "digest", "first", "revisit")
    written = stage(rows.mapInArrow(write, INDEX), "records")
    n = max(1, partitions(pages.sparkSession))
    written.repartitionByRange(n, F.col("page_id").asc_nulls_first()).sortWithinPartitions("page_id").write.parquet(f"{path}/index")
    return read_index(pages.sparkSession, path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(f"{path}/index")


def _records(frames: DataFrame, path: str, with_payload: bool, wanted: bool) -> DataFrame:
    """The records of frames (file, frame_offset, frame_length); if `wanted`, only those at the places in `ats`."""
    names = [c.split()[0] for c in RECORD.split(", ")][: None if with_payload else -1]
    kinds = dict(page_id=pa.int64(), refers_to=pa.int64(), payload_bytes=pa.int64(), payload=pa.binary())
    schema = pa.schema([(c, kinds.get(c, pa.string())) for c in names])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(path)
        name, f = None, None
        for b in batches:
            for row in b.to_pylist():
                if row["file"] != name:
                    if f:
                        f.close()
                    name, f = row["file"], store.open_input_file(f"{root}/{row['file']}")
                data = _frame(f, row["frame_offset"], row["frame_length"])
                found, at = [], 0
                if wanted:
                    found = [parse(data, at)[0] for at in row["ats"]]
                while not wanted and at < len(data):
                    one, at = parse(data, at)
                    found.append(one)
                yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in found], schema.field(c).type) for c in names], schema=schema)
        if f:
            f.close()

    return frames.mapInArrow(read, ", ".join(RECORD.split(", ")[: len(names)]))


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """All records under `path`, as RECORD or without payload. Tasks read footers first, then share out the frames."""

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(path)
        for b in batches:
            for name in b.column(0).to_pylist():
                found = seek_table(store, f"{root}/{name}")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(found)), *(pa.array(c, pa.int64()) for c in zip(*found))], names=["file", "frame_offset", "frame_length"]
                )

    files = read_index(spark, path).select("file").distinct()
    found = files.mapInArrow(frames, "file string, frame_offset long, frame_length long")
    n = max(1, partitions(spark))
    found = found.repartition(n, "file", F.col("frame_offset")).sortWithinPartitions("file", "frame_offset")
    return _records(found, path, with_payload, wanted=False)


def fetch(spark: SparkSession, path: str, ids: DataFrame) -> DataFrame:
    """(page_id, payload) of the ids in the only column of `ids`, revisits with the payload of their response.

    The index tells the frames, each of which is read and unpacked once; nothing else of the bundles is read. An id without
    a record gives no row, a repeated id one row for each of its records.
    """
    index = read_index(spark, path)
    asked = ids.select(F.col(ids.columns[0]).cast("long").alias("asked")).distinct()
    found = index.join(asked, F.col("page_id") == F.col("asked")).select("asked", F.coalesce("refers_to", "page_id").alias("holder"), "digest")
    holders = found.select(F.col("holder").alias("h"), F.col("digest").alias("d")).distinct()
    places = index.where("record_type = 'response'").join(holders, (F.col("page_id") == F.col("h")) & (F.col("digest") == F.col("d")))
    frames = places.groupBy("file", "frame_offset", "frame_length").agg(F.sort_array(F.collect_list("at")).alias("ats"))
    payloads = _records(frames, path, True, wanted=True).select(F.col("page_id").alias("p"), F.col("payload_digest").alias("of"), "payload")
    payloads = stage(payloads.dropDuplicates(["p", "of"]), "payloads")
    return found.join(payloads, (F.col("holder") == F.col("p")) & (F.col("digest") == F.col("of"))).select(F.col("asked").alias("page_id"), "payload")


def archive_facts(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write `pages` under `path`, by default in the shared folder, and return what the archives say of each record."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_archives(pages, path)
    return read_archives(spark, path, with_payload=False)
