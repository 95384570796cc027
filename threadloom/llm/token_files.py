"""Token files: independent zstandard frames, a document index, and a trailing seek table with checksums.

A shard holds the ids of documents in ascending order of their key:

    frame*            zstandard frames, each by itself: the ids of one or more whole documents, little-endian
                      unsigned integers of `width` bytes
    index             a skippable frame (0x184D2A50): u8 width, u64 n_docs, then zstandard of n_docs int64 keys,
                      n_docs u8 key-is-null, n_docs u32 counts of ids, n_docs u32 frame numbers
    seek table        a skippable frame (0x184D2A5E) as in the public seekable format: a frame's compressed size,
                      decompressed size and checksum (low 32 bits of XXH64 of the content) as u32 each, the index
                      last; then u32 number of frames, u8 descriptor (0x80: with checksums), u32 0x8F92EAB1

A reader fetches the tail, then the index, then only the frames that hold the documents asked for, and checks each
frame's checksum. Any zstandard reader can decompress a shard: it skips the two last frames.

A shard's name holds the attempt that wrote it, so a task that is run again or twice never meets another's file. The
manifest (shard, path, n_docs, n_tokens) is a Parquet table that Spark commits as a whole: it names one whole shard a
task; what a lost attempt left is named by nothing.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadloom.llm.chunks import LONGEST, Known, distinct_ranges, text_slices
from threadloom.llm.common import keep, partitions, ranges, written

INDEX_MAGIC, TABLE_MAGIC, FOOTER_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
#: A frame is closed when it holds this many ids; a longer document has a frame of its own.
FRAME_IDS = 1 << 16
#: A task closes a shard that holds so many documents, or ids, and goes on with another: shards follow the data, and
#: what a writer or reader holds of a shard's index is some 30 MB at most.
SHARD_DOCS, SHARD_IDS = 1 << 18, 1 << 29


class Shard:
    """Writes one shard to a binary stream."""

    def __init__(self, out, width: int, level: int = 3):
        import zstandard

        self.out, self.dtype, self.width = out, {2: "<u2", 4: "<u4"}[width], width
        self.zstd = zstandard.ZstdCompressor(level=level, write_checksum=False)
        self.frames: list[tuple[int, int, int]] = []
        self.keys: list[int | None] = []
        self.counts: list[int] = []
        self.where: list[int] = []
        self.open: list[bytes] = []
        self.held = 0

    def _checksum(self, raw: bytes) -> int:
        import xxhash

        return xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF

    def add(self, key: int | None, packed: bytes) -> None:
        """packed: the document's ids as little-endian integers of this shard's width."""
        if self.held and self.held + len(packed) // self.width > FRAME_IDS:
            self._close_frame()
        self.keys.append(key)
        self.counts.append(len(packed) // self.width)
        self.where.append(len(self.frames))
        self.open.append(packed)
        self.held += len(packed) // self.width

    def _close_frame(self) -> None:
        raw = b"".join(self.open)
        self.out.write(data := self.zstd.compress(raw))
        self.frames.append((len(data), len(raw), self._checksum(raw)))
        self.open, self.held = [], 0

    def close(self) -> None:
        if self.open:
            self._close_frame()
        n = len(self.keys)
        body = b"".join((np.array([k or 0 for k in self.keys], "<i8").tobytes(), np.array([k is None for k in self.keys], "u1").tobytes(), np.array(self.counts, "<u4").tobytes(), np.array(self.where, "<u4").tobytes()))
        index = struct.pack("<BQ", self.width, n) + self.zstd.compress(body)
        self.out.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        self.frames.append((len(index) + 8, 0, self._checksum(index)))
        table = b"".join(struct.pack("<III", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), 0x80, FOOTER_MAGIC)
        self.out.write(struct.pack("<II", TABLE_MAGIC, len(table)) + table)


class ShardReader:
    """Random access to a shard: an open seekable file."""

    def __init__(self, file):
        self.file = file
        size = file.seek(0, 2)
        file.seek(size - 9)
        n, descriptor, magic = struct.unpack("<IBI", file.read(9))
        if magic != FOOTER_MAGIC or descriptor != 0x80:
            raise ValueError("not a token shard")
        file.seek(size - 9 - 12 * n)
        self.frames = np.frombuffer(file.read(12 * n), "<u4").reshape(n, 3)
        self.offsets = np.concatenate(([0], np.cumsum(self.frames[:, 0], dtype=np.int64)))
        index = self._read(n - 1)[8:]
        self._check(n - 1, index)
        self.width, docs = struct.unpack_from("<BQ", index)
        body = self._inflate(index[9:], 17 * docs) if docs else b""
        self.keys = np.frombuffer(body, "<i8", docs, 0)
        self.is_null = np.frombuffer(body, "u1", docs, 8 * docs)
        self.counts = np.frombuffer(body, "<u4", docs, 9 * docs)
        self.where = np.frombuffer(body, "<u4", docs, 13 * docs)

    @staticmethod
    def _inflate(data: bytes, size: int) -> bytes:
        import zstandard

        return zstandard.ZstdDecompressor().decompress(data, max_output_size=size)

    def _read(self, frame: int) -> bytes:
        self.file.seek(int(self.offsets[frame]))
        return self.file.read(int(self.frames[frame, 0]))

    def _check(self, frame: int, raw: bytes) -> None:
        import xxhash

        if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != int(self.frames[frame, 2]):
            raise ValueError(f"checksum of frame {frame} does not match")

    def frame(self, frame: int) -> bytes:
        size = int(self.frames[frame, 1])
        raw = self._inflate(self._read(frame), size) if size else b""
        self._check(frame, raw)
        return raw

    def documents(self, wanted: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
        """(place in the shard, ids) of the wanted places, or all; only frames that hold some are read."""
        places = np.arange(len(self.counts)) if wanted is None else np.sort(wanted)
        first = np.searchsorted(self.where, np.arange(len(self.frames)))
        held, raw, at = -1, b"", None
        for i in places.tolist():
            f = int(self.where[i])
            if f != held:
                held, raw = f, self.frame(f)
                stop = int(first[f + 1])
                at = np.concatenate(([0], np.cumsum(self.counts[first[f] : stop], dtype=np.int64)))
            a = int(at[i - first[f]])
            yield i, np.frombuffer(raw, f"<u{self.width}", int(self.counts[i]), a * self.width)


class ChunkEncoder:
    """Ids by the tokenizers library for a byte-level file, remembered by chunk.

    A text is cut before each U+0020, where that surely begins a piece: not inside a run of white space. Texts where
    that can't be told so simply, or that hold the string of an added token, go to the library whole. Chunks of a
    batch are told apart by two 64-bit hashes of their bytes, worked out for all of them at once; only unknown ones
    go to the library, once each, and all ids are then gathered. Chunks of more than LONGEST bytes aren't remembered.
    """

    INSIDE_RUN = re.compile(r"\s (?=\s|$)")
    #: Chunks in a text for the library.
    CALL = 256
    # bytes that are or may begin white space
    _SPACE, _MAYBE = np.zeros(256, bool), np.zeros(256, bool)
    _SPACE[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] = True
    _MAYBE[[0xC2, 0xE1, 0xE2, 0xE3]] = True

    def __init__(self, path: str, width: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.own = Tokenizer.from_file(path)
        self.own.no_padding()
        self.own.no_truncation()
        self.specials = [t.content.encode() for t in self.own.get_added_tokens_decoder().values()]
        self.dtype, self.known = f"<u{width}", Known(f"<u{width}")
        # a byte-level token has a character for each of its bytes
        vocabulary = self.own.get_vocab(with_added_tokens=False)
        self.bytes = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        self.bytes[list(vocabulary.values())] = list(map(len, vocabulary))

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.dtype) for e in self.own.encode_batch_fast(texts, add_special_tokens=False)]

    def _whole(self, data: np.ndarray, raw: bytes, begin: np.ndarray, stop: np.ndarray) -> list[int]:
        """Places of texts that can't be cut at their spaces."""
        space = np.flatnonzero(data == 0x20)
        before, after = data[np.maximum(space - 1, 0)], data[np.minimum(space + 1, len(data) - 1)]
        able = (self._SPACE[before] | (before >= 0x80)) & (self._SPACE[after] | self._MAYBE[after])
        of = np.searchsorted(stop, space, "right")
        able |= space + 1 == stop[of]
        out = {i for i in np.unique(of[able]).tolist() if self.INSIDE_RUN.search(raw[begin[i] : stop[i]].decode())}
        if any(s in raw for s in self.specials):
            out.update(i for i, (a, b) in enumerate(zip(begin.tolist(), stop.tolist(), strict=True)) if any(s in raw[a:b] for s in self.specials))
        return sorted(out)

    def _learn(self, raw: bytes, begin: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks, one after the other, and how many each has. Chunks of a space and something else that isn't
        white space are put after each other, as in a text; the places of the spaces among the bytes of all tokens
        tell where each begins. The others go one by one."""
        chunks = [raw[a:b].decode() for a, b in zip(begin.tolist(), stop.tolist(), strict=True)]
        usual = np.array([len(c) > 1 and c[0] == " " and not c[1].isspace() for c in chunks], bool)
        follow, alone = [c for c, u in zip(chunks, usual, strict=True) if u], [c for c, u in zip(chunks, usual, strict=True) if not u]
        groups = ["".join(follow[i : i + self.CALL]) for i in range(0, len(follow), self.CALL)]
        found = self._library(groups)
        counts = [np.zeros(0, np.int64)]
        for text, ids in zip(groups, found, strict=True):
            first = np.flatnonzero(np.frombuffer(text.encode(), np.uint8) == 0x20)
            counts.append(np.diff(np.searchsorted(np.cumsum(self.bytes[ids]), first, "right"), append=len(ids)))
        single = self._library(alone)
        n = np.zeros(len(chunks), np.int64)
        n[usual], n[~usual] = np.concatenate(counts), list(map(len, single))
        # first all that follow, then the others: back to the chunks' order
        ids = np.concatenate([*found, *single, np.zeros(0, self.dtype)])
        place = np.cumsum(n[order := np.concatenate([np.flatnonzero(usual), np.flatnonzero(~usual)])]) - n[order]
        at = np.empty(len(chunks), np.int64)
        at[order] = place
        return ids[ranges(at, n)], n

    def encode(self, data: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """data: UTF-8 of texts one after the other, at begin to stop. All ids, and how many each text has."""
        if not len(data):
            return np.zeros(0, self.dtype), np.zeros(len(begin), np.int64)
        raw, cut = data.tobytes(), data == 0x20
        whole = self._whole(data, raw, begin, stop)
        for i in whole:
            cut[begin[i] : stop[i]] = False
        cut[begin[begin < stop]] = True
        first = np.flatnonzero(cut)
        last = np.append(first[1:], len(data))
        direct = last - first > LONGEST
        direct[np.searchsorted(first, begin[whole])] = True
        at, n = np.zeros(len(first), np.int64), np.zeros(len(first), np.int64)
        usual = np.flatnonzero(~direct)
        found = distinct_ranges(data, first[usual], last[usual])
        if found is None:
            direct[:], usual = True, usual[:0]
        extra = self._library([raw[a:b].decode() for a, b in zip(first[direct].tolist(), last[direct].tolist(), strict=True)])
        n[direct] = list(map(len, extra))
        if len(usual):
            u, g, one, of = found
            ua, un, good = self.known.find(u, g)
            new = np.flatnonzero(~good)
            ids, counts = self._learn(raw, first[usual][one[new]], last[usual][one[new]])
            un[new] = counts
            ua[new] = self.known.put(ids) + np.cumsum(counts) - counts
            at[usual], n[usual] = ua[of], un[of]
        else:
            new = ids = counts = ()
        kept = self.known.filled
        self.known.filled += len(ids)
        at[direct] = self.known.put(np.concatenate([*extra, np.zeros(0, self.dtype)])) + np.cumsum(n[direct]) - n[direct]
        out = self.known.ids[ranges(at, n)]
        self.known.filled = kept
        if len(new):
            self.known.keep(u[new], g[new], ua[new], counts, len(ids))
        total = np.append(0, np.cumsum(n))
        return out, total[np.searchsorted(first, stop)] - total[np.searchsorted(first, begin)]

    def encode_packed(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian integers."""
        import pyarrow as pa

        return [x for some in self.packed(pa.array(texts, pa.string())) for x in some]

    def packed(self, column) -> Iterator[list[bytes]]:
        """column: an Arrow string array without nulls. Ids of texts, slice by slice of bounded size."""
        w = int(self.dtype[-1])
        for data, begin, stop in text_slices(column):
            ids, n = self.encode(data, begin, stop)
            packed, end = ids.tobytes(), np.cumsum(n) * w
            yield [packed[a:b] for a, b in zip((end - n * w).tolist(), end.tolist(), strict=True)]


def _open(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_token_files(docs: DataFrame, tokenizer: str, folder: str, end_id: int | None = None, key: str = "doc_id", text: str = "text", width: int = 2, shards: int | None = None, most_docs: int = SHARD_DOCS) -> DataFrame:
    """Encode the texts and write shards below `folder` (shared storage); returns the manifest.

    Documents are in ascending key order over all shards: null keys last, equal keys by a hash of the text and then
    the text. Null texts count as empty; each document gets `end_id` appended if one is given. width: bytes an id
    (2 where the vocabulary fits). Very long texts are written whole, in a frame of their own; an empty table gives
    no shards and an empty manifest; further columns are ignored. shards: tasks that write; most_docs: documents of a
    shard at most.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("k"), F.coalesce(text, F.lit("")).alias("t")).withColumn("h", F.xxhash64("t"))
    n = shards or partitions(spark)
    # the hash splits a key that many rows share
    dealt = rows.repartitionByRange(n, F.col("k").asc_nulls_last(), F.col("h")).sortWithinPartitions(F.col("k").asc_nulls_last(), "h", "t")
    tail = b"" if end_id is None else np.array([end_id], f"<u{width}").tobytes()

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        encoder, task = keep("token_files", (tokenizer, width), lambda: ChunkEncoder(tokenizer, width)), TaskContext.get()
        shard, out, name, made, n_tokens = None, None, "", 0, 0
        fs, top = _open(folder)

        def closed():
            n_docs = len(shard.keys)
            shard.close()
            out.close()
            number = (task.partitionId() << 20) + made - 1
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([f"{folder}/{name}"]), pa.array([n_docs], pa.int64()), pa.array([n_tokens], pa.int64())], ["shard", "path", "n_docs", "n_tokens"])

        for b in batches:
            keys, at = b.column(0).to_pylist(), 0
            for some in encoder.packed(b.column(1)):
                for k, packed in zip(keys[at : at + len(some)], some, strict=True):
                    if shard is not None and (len(shard.keys) >= most_docs or n_tokens >= SHARD_IDS):
                        yield closed()
                        shard = None
                    if shard is None:
                        fs.create_dir(top, recursive=True)
                        name = f"shard-{task.partitionId():06d}-{made:06d}-{task.taskAttemptId()}.zst"
                        shard, made, n_tokens = Shard(out := fs.open_output_stream(f"{top}/{name}", compression=None), width), made + 1, 0
                    shard.add(k, packed + tail)
                    n_tokens += shard.counts[-1]
                at += len(some)
        if shard is not None:
            yield closed()

    made = dealt.select("k", "t").mapInArrow(run, "shard long, path string, n_docs long, n_tokens long")
    return written(spark, made, "manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """One row per document of the shards: shard, place, k (its key), ids_offset (in its shard), n_tokens, ids_crc32.

    ids_crc32 is the unsigned CRC-32 of the ids as little-endian unsigned 32-bit integers. Null and repeated keys come
    as they were written, documents without ids with their end id alone or with none; an empty manifest gives no row.
    A frame whose checksum doesn't match is an error. A document's frame is held whole.
    """

    def run(batches):
        import pyarrow as pa

        for b in batches:
            for shard, path in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                fs, p = _open(path)
                with fs.open_input_file(p) as f:
                    r = ShardReader(f)
                    crc = np.fromiter((zlib.crc32(ids.astype("<u4").tobytes()) for _, ids in r.documents()), np.int64, len(r.counts))
                    counts = r.counts.astype(np.int64)
                    for i in range(0, len(counts), 8192):
                        s = slice(i, i + 8192)
                        before = np.cumsum(counts[:i]).max(initial=0) + np.cumsum(counts[s]) - counts[s]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(counts[s]), shard)), pa.array(np.arange(len(counts))[s]), pa.array(r.keys[s], mask=r.is_null[s].astype(bool)), pa.array(before), pa.array(counts[s]), pa.array(crc[s])],
                            ["shard", "place", "k", "ids_offset", "n_tokens", "ids_crc32"],
                        )

    spark = manifest.sparkSession
    tasks = manifest.select("shard", "path").repartition(partitions(spark), "shard")
    return tasks.mapInArrow(run, "shard long, place long, k long, ids_offset long, n_tokens long, ids_crc32 long")


def fetch(manifest: DataFrame, wanted: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, ids array<int> of the documents whose keys are in `wanted`: each shard is opened once, and only frames
    that hold a wanted document are decompressed. Keys that no shard has give no row; null keys are not looked up."""
    spans = manifest.select("shard", "path")
    keys = wanted.select(F.col(key).cast("long").alias("k")).where("k is not null").distinct()

    def firsts(batches):
        import pyarrow as pa

        for b in batches:
            for shard, path in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                fs, p = _open(path)
                with fs.open_input_file(p) as f:
                    r = ShardReader(f)
                keys = np.flatnonzero(r.is_null == 0)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), shard)), pa.array([path] * len(keys), pa.string()), pa.array(r.keys[keys], pa.int64()), pa.array(keys, pa.int64())], ["shard", "path", "k", "place"])

    places = spans.mapInArrow(firsts, "shard long, path string, k long, place long").join(keys, "k", "left_semi")

    def read(_, table):
        import pyarrow as pa

        fs, p = _open(table.column("path")[0].as_py())
        with fs.open_input_file(p) as f:
            r = ShardReader(f)
            got = list(r.documents(table.column("place").to_numpy()))
        return pa.table({"k": pa.array([int(r.keys[i]) for i, _ in got], pa.int64()), "ids": pa.array([x.astype(np.int32) for _, x in got], pa.list_(pa.int32()))})

    # at most so many documents a group: a group is one task's memory
    out = places.groupBy("shard", F.floor(F.col("place") / 4096)).applyInArrow(lambda key, t: read(key, t), "k long, ids array<int>")
    return out.withColumnRenamed("k", key)


def with_starts(rows: DataFrame, manifest: DataFrame) -> DataFrame:
    """rows of read_token_files with `start`: ids of all documents before. The prefix sum runs over the manifest,
    which has a row a shard, not over documents. Empty tables give none; rows of shards that the manifest lacks go."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = manifest.select("shard", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))
    # a row a shard of up to SHARD_DOCS documents: some 16 bytes for each 262,144 documents
    return rows.join(F.broadcast(base), "shard").select("*", (F.col("base") + F.col("ids_offset")).alias("start"))


def round_trip(docs: DataFrame, tokenizer: str, folder: str, end_id: int | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the documents' token files and read them back: key, start, n_tokens, ids_crc32."""
    manifest = write_token_files(docs, tokenizer, folder, end_id, key, text)
    rows = with_starts(read_token_files(manifest), manifest)
    return rows.select(F.col("k").alias(key), "start", "n_tokens", "ids_crc32")
