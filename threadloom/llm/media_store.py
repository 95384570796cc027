"""Media columns: payloads in a container, cut into chunks by content, equal chunks stored once.

A payload becomes a WAV file of 8-bit samples. Its samples are cut where a rolling gear hash of the last 32 bytes is
low, so that an insertion moves only the cuts around it; its header follows from their number and isn't kept. Digests of all chunks are counted by a
shuffle of digests alone; what occurs again goes to the table of shared chunks, once, by a grouped join on digests; the
rest stays inside its medium's row, so most payloads are never shuffled. Each medium keeps the ordered list of its
chunks. Reading puts media together from both, and checks each chunk's digest and the medium's.

Which chunks occur again is known to the tasks by a bitmap of hash positions with a fixed bound. A chunk whose position
another one shares counts as shared too: it only takes the longer way, so nothing depends on the bitmap being large.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.llm.common import shared_dir

#: Payloads are padded to multiples of so many bytes; the tail that a checksum covers is as long (fixed values).
UNIT, RATE = 64, 8000
#: Bytes of a chunk: at least, about 2**AVERAGE_BITS more, at most. The least is above the hash's window of 32.
LEAST, AVERAGE_BITS, MOST = 512, 11, 16384
#: Positions of the bitmap of chunks that occur again: 8 MB at most, whatever the data.
POSITIONS = 1 << 26
_PAGE = 1 << 15
#: Bytes of payloads that a task cuts at a time.
SLICE = 4 << 20
DIGEST = 16
CHUNKS = T.ArrayType(T.StructType([T.StructField("digest", T.BinaryType()), T.StructField("size", T.IntegerType()), T.StructField("own", T.BooleanType())]))
_GEAR = np.frombuffer(b"".join(hashlib.blake2b(bytes([i]), digest_size=4).digest() for i in range(256)), "<u4")


@dataclass
class MediaStore:
    """media: k, n_bytes, media_sha (of the whole medium), chunks (in order), own (the bytes of its own chunks).
    shared: digest, bytes, each once."""

    media: DataFrame
    shared: DataFrame


def header(payload_bytes: int) -> bytes:
    """Of a WAV file with one channel of 8-bit samples."""
    return struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + payload_bytes, b"WAVE", b"fmt ", 16, 1, 1, RATE, RATE, 1, 8, b"data", payload_bytes)


HEADER = len(header(0))


def padded(text: str | None) -> tuple[int, bytes]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return len(raw), raw + bytes(max(-len(raw) % UNIT, UNIT if not raw else 0))


def low_places(data: np.ndarray) -> np.ndarray:
    """Ends (exclusive) of the places where the gear hash of the last 32 bytes is low. Each step doubles how many bytes
    the hashes cover."""
    h = _GEAR[data]
    for s in (1, 2, 4, 8, 16):
        h[s:] += h[:-s] << np.uint32(s)
    return np.flatnonzero(h < np.uint32(1 << (32 - AVERAGE_BITS))) + 1


def cuts(low: list[int], begin: int, end: int) -> list[int]:
    """Ends of the chunks of data[begin:end]. A chunk's least length keeps what lies before it out of the hash."""
    out, at = [], begin
    while end - at > LEAST:
        most = min(at + MOST, end)
        i = bisect_left(low, at + LEAST)
        at = low[i] if i < len(low) and low[i] < most else most
        out.append(at)
    if at < end:
        out.append(end)
    return out


def _slices(column) -> Iterator[list[str | None]]:
    """The texts of a batch's column, some 4 MB at a time."""
    held: list[str | None] = []
    size = 0
    for x in column:
        held.append(x.as_py())
        size += len(held[-1] or "")
        if size >= SLICE:
            yield held
            held, size = [], 0
    if held:
        yield held


def chunked(texts: list[str | None]) -> Iterator[tuple[int, bytes, list[tuple[bytes, bytes]]]]:
    """For each text its bytes' number, its medium, and the chunks of the medium's samples (digest, bytes) in order."""
    payloads = [padded(x) for x in texts]
    data = b"".join(p for _, p in payloads)
    low, at = low_places(np.frombuffer(data, np.uint8)).tolist() if data else [], 0
    for n, p in payloads:
        parts, begin = [], at
        for end in cuts(low, at, at + len(p)):
            parts.append(data[begin:end])
            begin = end
        at += len(p)
        yield n, header(len(p)) + p, [(hashlib.blake2b(x, digest_size=DIGEST).digest(), x) for x in parts]


def _position(digest: bytes, positions: int) -> int:
    return int.from_bytes(digest[:8], "little") % positions


def repeated(docs: DataFrame, text: str = "text", positions: int = POSITIONS) -> np.ndarray:
    """The bitmap of the positions whose chunks occur more than once in all media: an eighth of `positions` bytes."""

    def run(it):
        import pyarrow as pa

        for b in it:
            for texts in _slices(b.column(0)):
                yield pa.RecordBatch.from_arrays([pa.array([_position(d, positions) for _, _, chunks in chunked(texts) for d, _ in chunks], pa.int64())], ["p"])

    places = docs.select(F.col(text)).mapInArrow(run, "p long").groupBy("p").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    pages = places.groupBy(F.floor(F.col("p") / _PAGE).alias("page")).agg(F.bitmap_construct_agg(F.col("p") % _PAGE).alias("bits"))
    bitmap = np.zeros(-(-positions // _PAGE) * _PAGE // 8, np.uint8)
    for r in pages.toLocalIterator():  # positions / _PAGE rows of 4 KB at most
        bitmap[r.page * _PAGE // 8 : (r.page + 1) * _PAGE // 8] = np.frombuffer(r.bits, np.uint8)
    return bitmap


def write_media(docs: DataFrame, folder: str, key: str = "doc_id", text: str = "text", positions: int = POSITIONS) -> MediaStore:
    """Every text as a medium in `folder`. Null texts count as empty; an empty payload is one unit of zeros; repeated
    rows and null keys stay; equal texts share all chunks; no rows give an empty store."""
    spark = docs.sparkSession
    bitmap = spark.sparkContext.broadcast(zlib.compress(repeated(docs, text, positions).tobytes(), 1))
    kind = docs.schema[key].dataType

    def again():
        bits = np.frombuffer(zlib.decompress(bitmap.value), np.uint8)
        return lambda d: bool(bits[(p := _position(d, positions)) >> 3] >> (p & 7) & 1)

    def media(it):
        import pyarrow as pa

        is_shared = again()
        for b in it:
            at = 0
            for texts in _slices(b.column(1)):
                n, shas, lists, own = [], [], [], []
                for size, medium, chunks in chunked(texts):
                    marks = [is_shared(d) for d, _ in chunks]
                    n.append(size)
                    shas.append(hashlib.sha256(medium).digest())
                    lists.append([{"digest": d, "size": len(x), "own": not m} for (d, x), m in zip(chunks, marks, strict=True)])
                    own.append(b"".join(x for (_, x), m in zip(chunks, marks, strict=True) if not m))
                kinds = pa.list_(pa.struct([("digest", pa.binary()), ("size", pa.int32()), ("own", pa.bool_())]))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(texts)), pa.array(n, pa.int64()), pa.array(shas, pa.binary()), pa.array(lists, kinds), pa.array(own, pa.binary())], ["k", "n_bytes", "media_sha", "chunks", "own"])
                at += len(texts)

    def copies(it):
        import pyarrow as pa

        is_shared = again()
        for b in it:
            for texts in _slices(b.column(0)):
                found = {d: x for _, _, chunks in chunked(texts) for d, x in chunks if is_shared(d)}
                yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.binary())], ["digest", "bytes"])

    schema = T.StructType([T.StructField("k", kind), T.StructField("n_bytes", T.LongType()), T.StructField("media_sha", T.BinaryType()), T.StructField("chunks", CHUNKS), T.StructField("own", T.BinaryType())])
    docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(media, schema).write.option("compression", "zstd").parquet(f"{folder}/media")
    docs.select(F.col(text).alias("t")).mapInArrow(copies, "digest binary, bytes binary").dropDuplicates(["digest"]).write.option("compression", "zstd").parquet(f"{folder}/shared")
    return open_media(spark, folder)


def open_media(spark: SparkSession, folder: str) -> MediaStore:
    return MediaStore(spark.read.parquet(f"{folder}/media"), spark.read.parquet(f"{folder}/shared"))


def _assemble(it):
    """(who, media_sha, chunks, own, got) to (who, media): chunks in order, each checked, then the whole. got: the bytes
    of shared chunks by their place."""
    import pyarrow as pa

    for b in it:
        for row in range(b.num_rows):  # one medium at a time: a batch of them need not fit twice
            who, sha, chunks, own, got = (b.column(i)[row].as_py() for i in range(5))
            there = {g["at"]: g["bytes"] for g in got or ()}
            parts, at = [], 0
            for i, c in enumerate(chunks):
                part = own[at : at + c["size"]] if c["own"] else there.get(i, b"")
                at += c["size"] if c["own"] else 0
                if hashlib.blake2b(part, digest_size=DIGEST).digest() != c["digest"]:
                    raise ValueError("a chunk is not what its digest says")
                parts.append(part)
            medium = b"".join([header(sum(map(len, parts))), *parts])
            if hashlib.sha256(medium).digest() != sha:
                raise ValueError("a medium is not what its digest says")
            yield pa.RecordBatch.from_arrays([b.column(0).slice(row, 1), pa.array([medium], pa.binary())], ["who", "media"])


def _put_together(rows: DataFrame) -> DataFrame:
    """who's columns and media, for rows of who, media_sha, chunks, own and got."""
    kind = T.StructType([rows.schema["who"], T.StructField("media", T.BinaryType())])
    return rows.mapInArrow(_assemble, kind).select("who.*", "media")


def read_whole(store: MediaStore) -> DataFrame:
    """k, n_bytes, media of the media that share no chunk: put together where they lie."""
    own = store.media.where(F.forall("chunks", lambda c: c["own"]))
    return _put_together(own.select(F.struct("k", "n_bytes").alias("who"), "media_sha", "chunks", "own", F.lit(None).cast("array<struct<at:int,bytes:binary>>").alias("got")))


def read_shared(store: MediaStore) -> DataFrame:
    """media_sha, media: each medium with shared chunks once, however many rows have it. Its chunks come together by a
    join on digests; places of copies are told apart before, so that chunks travel once for each different medium."""
    some = store.media.where(~F.forall("chunks", lambda c: c["own"]))
    asked = some.select("media_sha", F.posexplode("chunks").alias("at", "c")).where(~F.col("c.own")).groupBy("media_sha", "at").agg(F.first("c.digest").alias("digest"))
    got = asked.join(store.shared, "digest").groupBy("media_sha").agg(F.collect_list(F.struct("at", "bytes")).alias("got"))
    lists = some.groupBy("media_sha").agg(F.first(F.struct("chunks", "own")).alias("m"))
    return _put_together(lists.join(got, "media_sha").select(F.struct("media_sha").alias("who"), "media_sha", "m.chunks", "m.own", "got"))


def read_media(store: MediaStore) -> DataFrame:
    """k, n_bytes, media: every row's verified medium."""
    some = store.media.where(~F.forall("chunks", lambda c: c["own"])).select("k", "n_bytes", "media_sha")
    return read_whole(store).unionByName(some.join(read_shared(store), "media_sha").select("k", "n_bytes", "media"))


#: What `describe` adds.
FEATURES = {"payload_bytes": T.LongType(), "payload_sha256": T.StringType(), "tail_crc32": T.LongType(), "media_bytes": T.LongType(), "media_sha256": T.StringType(), "feature": T.StringType()}


def describe(media: DataFrame) -> DataFrame:
    """Features of the column `media` in its place: sizes and digests of medium and payload, the checksum of the last
    unit, and `feature`: samples in each eighth of the levels, the sum of steps between samples, and how often the
    middle level is crossed. Equal media have equal features."""
    rest = [c for c in media.columns if c != "media"]

    def run(it):
        import pyarrow as pa

        for b in it:
            found: list[list] = [[] for _ in FEATURES]
            column = b.column(b.schema.get_field_index("media"))
            for x in column:
                medium = x.as_py()
                if medium[:HEADER] != header(len(medium) - HEADER):
                    raise ValueError("not the header that was written")
                payload = medium[HEADER:]
                level = np.frombuffer(payload, np.uint8)
                steps = int(np.abs(np.diff(level.astype(np.int16))).sum(dtype=np.int64))
                crossed = int(np.count_nonzero(np.diff(level >> 7)))
                feature = ",".join(map(str, [*np.bincount(level >> 5, minlength=8).tolist(), steps, crossed]))
                for into, v in zip(found, (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-UNIT:]), len(medium), hashlib.sha256(medium).hexdigest(), feature), strict=True):
                    into.append(v)
            kinds = [pa.int64() if isinstance(t, T.LongType) else pa.string() for t in FEATURES.values()]
            yield pa.RecordBatch.from_arrays([*[b.column(b.schema.get_field_index(c)) for c in rest], *[pa.array(v, k) for v, k in zip(found, kinds, strict=True)]], [*rest, *FEATURES])

    schema = T.StructType([*[media.schema[c] for c in rest], *[T.StructField(c, t) for c, t in FEATURES.items()]])
    return media.mapInArrow(run, schema)


def media_features(docs: DataFrame, folder: str | None = None, key: str = "doc_id", text: str = "text", positions: int = POSITIONS) -> DataFrame:
    """key, n_bytes and the features of every text's medium, written to the store and read back from it. Media that many
    rows have are read once; edge cases as in `write_media`."""
    store = write_media(docs, folder or shared_dir(docs.sparkSession, "media"), key, text, positions)
    some = store.media.where(~F.forall("chunks", lambda c: c["own"])).select("k", "n_bytes", "media_sha")
    again = some.join(describe(read_shared(store)), "media_sha").drop("media_sha")
    return describe(read_whole(store)).unionByName(again).withColumnRenamed("k", key)
