"""Byte-level BPE: encoding and decoding.

Pre-tokenising works on whole batches without regex. Every code point gets a symbol (its class, and what follows
it where that matters); an eight-state automaton over these symbols tells where a piece begins. Its transition
functions compose associatively, so the batch is cut into blocks: each block's function is built for all states at
once, an exclusive scan composes the blocks' functions, and a second sweep marks the boundaries. The slices between
boundaries go to pair merging by rank, memoised by slice. Offsets are kept beside the ids: where each slice begins,
in code points and in ids. Decoding takes the token bytes by id and joins them; with the offsets it checks every
slice's length, and it can decode a span of code points without the rest.

Semantics of the pattern (fixed, as the public pattern has it): contractions `'s 't 're 've 'm 'll 'd` in lower
case; an optional space before a run of letters, of numbers, or of other non-space characters; a run of white space
leaves its last character to what follows.
"""

from __future__ import annotations

import base64
import hashlib
import sys
import unicodedata

import numpy as np
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.llm.common import Memo, keep

# Unicode's White_Space.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

#: Code point classes.
LETTER, NUMBER, OTHER, SPACE = range(4)
#: Symbols: the classes, and white space before white space or the end, a U+0020 or another before something else,
#: an apostrophe that a one- or two-letter contraction may follow, and the end of a text.
S_LETTER, S_NUMBER, S_OTHER, S_RUN, S_PREFIX, S_LAST, S_SHORT, S_LONG, S_END = range(9)
#: States: in a run of letters, numbers, others; after a prefix space; in white space; one or two letters of a
#: contraction to come; a piece has ended.
IN_LETTER, IN_NUMBER, IN_OTHER, AFTER_PREFIX, IN_SPACE, ONE_MORE, TWO_MORE, ENDED = range(8)
STATES = 8


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """next[symbol, state] and begins[symbol, state]."""
    move, begins = np.zeros((9, STATES), np.uint8), np.ones((9, STATES), bool)
    for run, symbol in ((IN_LETTER, S_LETTER), (IN_NUMBER, S_NUMBER), (IN_OTHER, S_OTHER)):
        move[symbol, :] = run
        begins[symbol, [run, AFTER_PREFIX]] = False
    move[S_LETTER, ONE_MORE], move[S_LETTER, TWO_MORE] = ENDED, ONE_MORE
    begins[S_LETTER, [ONE_MORE, TWO_MORE]] = False
    for symbol, after in ((S_SHORT, ONE_MORE), (S_LONG, TWO_MORE)):
        move[symbol, :] = after
        move[symbol, [IN_OTHER, AFTER_PREFIX]] = IN_OTHER
        begins[symbol, [IN_OTHER, AFTER_PREFIX]] = False
    move[S_RUN, :], move[S_PREFIX, :], move[S_LAST, :], move[S_END, :] = IN_SPACE, AFTER_PREFIX, ENDED, ENDED
    begins[S_RUN, IN_SPACE] = False
    return move, begins


MOVE, BEGINS = _automaton()
#: Length of a block of the scan, and code points scanned at once.
BLOCK, SCAN = 128, 1 << 18
#: Bytes of pieces and their ids that a worker remembers.
MEMO = 48 << 20


def _classes() -> np.ndarray:
    kinds = {"L": LETTER, "N": NUMBER}
    of = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(sys.maxunicode + 1)), np.uint8, sys.maxunicode + 1)
    of[WHITE_SPACE] = SPACE
    return of


def classes() -> np.ndarray:
    """The class of every code point; built once a worker."""
    return keep("byte_bpe", "classes", _classes)


def symbols(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """points: code points of all texts, each text followed by one separator, at `ends`."""
    of = classes()[points]
    of[ends] = SPACE
    last = np.zeros(len(of) + 3, bool)
    last[ends] = True
    sym = of.copy()  # letters, numbers and others are their own symbols
    nxt = np.append(of[1:], np.uint8(SPACE))
    space = of == SPACE
    before = space & (nxt != SPACE)
    sym[space] = S_RUN
    sym[before] = S_LAST
    sym[before & (points == 0x20)] = S_PREFIX
    quotes = np.flatnonzero(points == 0x27)
    if len(quotes):
        padded = np.append(points, np.zeros(3, points.dtype))
        a, b = padded[quotes + 1], padded[quotes + 2]
        # the separator is never one of these letters
        sym[quotes[np.isin(a, [ord(c) for c in "stmd"])]] = S_SHORT
        two = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
        sym[quotes[two]] = S_LONG
    sym[ends] = S_END
    return sym


def starts(sym: np.ndarray) -> np.ndarray:
    """Where pieces begin (and at each S_END): blocked scan over transition functions."""
    n = len(sym)
    blocks = -(-n // BLOCK)
    grid = np.full(blocks * BLOCK, S_END, np.uint8)
    grid[:n] = sym
    grid = np.ascontiguousarray(grid.reshape(blocks, BLOCK).T)
    flat, flags = MOVE.ravel(), BEGINS.ravel()
    rows = grid.astype(np.intp) * STATES
    # up: each block's function, for all states at once
    f = np.broadcast_to(np.arange(STATES, dtype=np.uint8)[:, None], (STATES, blocks)).copy()
    for row in rows:
        f = flat[row + f]
    # across: inclusive scan of the functions by doubling; (f, then g)[s] = g[f[s]]
    step = 1
    while step < blocks:
        g = f.copy()
        g[:, step:] = np.take_along_axis(f[:, step:], f[:, :-step].astype(np.intp), 0)
        f, step = g, step * 2
    state = np.append(np.uint8(ENDED), f[ENDED, :-1])
    # down: with the state before each block known
    out = np.empty((BLOCK, blocks), bool)
    for i, row in enumerate(rows):
        at = row + state
        out[i] = flags[at]
        state = flat[at]
    return np.flatnonzero(out.T.ravel()[:n])


def split(texts: list[str]) -> list[tuple[list[str], np.ndarray]]:
    """The pieces of each text, and the code point at which each begins."""
    out: list[tuple[list[str], np.ndarray]] = []
    i = 0
    while i < len(texts):  # a bounded number of code points at once; one text is never cut
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) < SCAN):
            size += len(texts[j]) + 1
            j += 1
        text = "\0".join(texts[i:j]) + "\0"
        ends = np.cumsum([len(t) + 1 for t in texts[i:j]]) - 1
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        at = starts(symbols(points, ends))
        bounds = at.tolist()
        pieces = [text[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
        first = 0
        for k in np.searchsorted(at, ends).tolist():
            out.append((pieces[first:k], at[first:k] - at[first]))
            first = k + 1
        i = j
    return out


class ByteBpe:
    """Encoder and decoder for a rank file (base64 token, rank)."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.pairs = tiktoken.Encoding("pairs", pat_str=r"[\s\S]+", mergeable_ranks=self.ranks, special_tokens={})
        self.apart = tiktoken.Encoding("apart", pat_str=r"[^\x00]+|\x00", mergeable_ranks=self.ranks, special_tokens={})
        self.nul = self.ranks[b"\0"]
        self.tokens = np.empty(max(self.ranks.values()) + 1, object)
        for token, i in self.ranks.items():
            self.tokens[i] = token
        self.sizes = np.array([len(t or b"") for t in self.tokens.tolist()], np.int64)
        self.decimal = np.array([str(i) for i in range(len(self.tokens))], object)
        self.memo = Memo(MEMO)

    def merge(self, pieces: list[str]) -> list[bytes]:
        """Packed ids of each piece: pairs merge by rank. Pieces go to the library in one call, kept apart by NUL,
        whose token is that one byte; those that hold a NUL go alone."""
        plain = [p for p in pieces if "\0" not in p]
        got: dict[str, bytes] = {p: np.array(self.pairs.encode_ordinary(p), "<u4").tobytes() for p in pieces if "\0" in p}
        for i in range(0, len(plain), 4096):
            some = plain[i : i + 4096]
            ids = np.array(self.apart.encode_ordinary("\0".join(some)), "<u4")
            cuts = (np.flatnonzero(ids == self.nul) * 4).tolist()
            packed = ids.tobytes()
            got.update((p, packed[a:b]) for p, a, b in zip(some, [0, *(c + 4 for c in cuts)], [*cuts, len(packed)], strict=True))
        return [got[p] for p in pieces]

    def encode_pieces(self, texts: list[str]) -> list[tuple[list[bytes], np.ndarray]]:
        """Of each text the packed ids (little-endian uint32) of its pieces, and the code points where these begin."""
        cut = split(texts)
        get = self.memo.of(set().union(*[pieces for pieces, _ in cut]), self.merge).__getitem__
        return [(list(map(get, pieces)), at) for pieces, at in cut]

    def encode_packed(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian uint32."""
        return [b"".join(pieces) for pieces, _ in self.encode_pieces(texts)]

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_packed([text])[0], "<u4").tolist()

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(self.tokens[ids].tolist())

    def decode_whole(self, ids: np.ndarray, id_at: np.ndarray, char_at: np.ndarray) -> bytes:
        """The bytes of a text. Each slice must begin where its offsets say, in ids and in code points."""
        raw = self.decode(ids)
        size = np.append(0, np.cumsum(self.sizes[ids]))
        begun = np.append(0, np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80))
        if not np.array_equal(begun[size[id_at]], char_at):
            raise ValueError("offsets and ids do not belong together")
        return raw

    def decode_span(self, ids: np.ndarray, id_at: np.ndarray, char_at: np.ndarray, first: int, last: int) -> str:
        """Code points first to last (exclusive) of a text, from the ids of the pieces that hold them. A piece whose
        ids don't give as many code points as the offsets say is an error."""
        i = max(0, int(np.searchsorted(char_at, first, "right")) - 1)
        j = int(np.searchsorted(char_at, last))
        if j <= i:
            return ""
        starts, stops = id_at[i:j], np.append(id_at[i + 1 : j], id_at[j] if j < len(id_at) else len(ids))
        pieces = [self.decode(ids[a:b]).decode() for a, b in zip(starts.tolist(), stops.tolist(), strict=True)]
        held = np.diff(char_at[i : j + 1])
        if any(len(p) != n for p, n in zip(pieces, held.tolist(), strict=False)):
            raise ValueError("offsets and ids do not belong together")
        return "".join(pieces)[first - int(char_at[i]) : max(0, last - int(char_at[i]))]


def coder(path: str) -> ByteBpe:
    return keep("byte_bpe", path, lambda: ByteBpe(path))


def _batches(it, rows: int = 256):
    """Batches of at most so many rows: bounds what a worker holds at once."""
    for b in it:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


_OFFSETS = T.ArrayType(T.IntegerType())


def encode(docs: DataFrame, ranks: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: key, ids, id_at and char_at, each array<int>: of every slice that was merged by
    itself, the place of its first id and of its first code point.

    Null texts count as empty and have no ids; very long texts are encoded whole; repeated rows and null keys stay;
    further columns are ignored; an empty table gives none. ranks: a file each executor reads at that path.
    """

    def run(it):
        import pyarrow as pa

        bpe = coder(ranks)
        for b in _batches(it):
            got = bpe.encode_pieces(b.column(1).to_pylist())
            ids = [np.frombuffer(b"".join(p), "<u4").astype(np.int32) for p, _ in got]
            sizes = [np.fromiter(map(len, p), np.int32, len(p)) // 4 for p, _ in got]
            columns = [ids, [np.cumsum(n, dtype=np.int32) - n for n in sizes], [at.astype(np.int32) for _, at in got]]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, pa.list_(pa.int32())) for c in columns]], ["k", "ids", "id_at", "char_at"])

    kind = docs.schema[key].dataType
    rows = docs.select(F.col(key).alias("k"), F.coalesce(text, F.lit("")).alias("t"))
    out = rows.mapInArrow(run, T.StructType([T.StructField("k", kind), *[T.StructField(c, _OFFSETS) for c in ("ids", "id_at", "char_at")]]))
    return out.withColumnRenamed("k", key)


def decode(rows: DataFrame, ranks: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """One row per row: key, bytes binary. Null ids count as none, repeated rows and null keys stay, an empty table
    gives none; further columns are ignored; an id without a token is an error."""

    def run(it):
        import pyarrow as pa

        bpe = coder(ranks)
        for b in _batches(it):
            got = [bpe.decode(np.array(x or [], np.int64)) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, pa.binary())], ["k", "bytes"])

    kind = rows.schema[key].dataType
    out = rows.select(F.col(key).alias("k"), F.col(ids).alias("ids")).mapInArrow(run, T.StructType([T.StructField("k", kind), T.StructField("bytes", T.BinaryType())]))
    return out.withColumnRenamed("k", key)


def decode_spans(rows: DataFrame, ranks: str, first: str = "first", last: str = "last", key: str = "doc_id") -> DataFrame:
    """rows: as `encode` gives them, with two more columns: code points from `first` to before `last` are asked for.
    key, text: only ids of the slices that hold some of the span are decoded. Beyond the text's end there is nothing;
    a null in one of the columns gives a null text. Repeated rows and null keys stay; an empty table gives none."""

    def run(it):
        import pyarrow as pa

        bpe = coder(ranks)
        for b in _batches(it):
            got = []
            for ids, id_at, char_at, lo, hi in zip(*[b.column(i).to_pylist() for i in range(1, 6)], strict=True):
                known = None not in (ids, id_at, char_at, lo, hi)
                got.append(bpe.decode_span(*[np.array(x, np.int64) for x in (ids, id_at, char_at)], max(0, lo), max(0, hi)) if known else None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, pa.string())], ["k", "text"])

    kind = rows.schema[key].dataType
    asked = rows.select(F.col(key).alias("k"), "ids", "id_at", "char_at", F.col(first).cast("long").alias("lo"), F.col(last).cast("long").alias("hi"))
    out = asked.mapInArrow(run, T.StructType([T.StructField("k", kind), T.StructField("text", T.StringType())]))
    return out.withColumnRenamed("k", key)


def round_trip(docs: DataFrame, ranks: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_tokens, ids_sha256 (of the decimal ids joined by commas), decoded_sha256 (of the bytes that the ids
    decode to): `encode` and `decode` in one pass, so that ids don't travel between processes; slices are decoded by the
    offsets that encoding kept of them. Edge cases as there.
    """

    def run(it):
        import pyarrow as pa

        bpe = coder(ranks)
        for b in _batches(it):
            n, shas, decoded = [], [], []
            for pieces, char_at in bpe.encode_pieces(b.column(1).to_pylist()):
                ids = np.frombuffer(b"".join(pieces), "<u4")
                sizes = np.fromiter(map(len, pieces), np.int64, len(pieces)) // 4
                n.append(len(ids))
                shas.append(hashlib.sha256(",".join(bpe.decimal[ids].tolist()).encode()).hexdigest())
                decoded.append(hashlib.sha256(bpe.decode_whole(ids, np.cumsum(sizes) - sizes, char_at)).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(shas), pa.array(decoded)], ["k", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[key].dataType
    out = docs.select(F.col(key).alias("k"), F.coalesce(text, F.lit("")).alias("t")).mapInArrow(
        run, T.StructType([T.StructField("k", kind), T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])
    )
    return out.withColumnRenamed("k", key)
