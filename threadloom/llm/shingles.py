"""Sets of word shingles as sorted 64-bit hashes, for whole batches of texts at once.

A-Z are lower-cased; words are runs of anything but U+0020 and U+0009 to U+000D. A text's set holds its distinct runs
of `n` words; with fewer words, the whole sequence as one; without words or text it is empty. Hashes are 64-bit: two
different shingles of a corpus of 10^9 distinct ones share a hash with a chance of 3 %, and a text pair is misjudged
only if such a pair meets in it.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
#: Bytes handled at once; a longer text is handled alone.
CHUNK = 1 << 19
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers with good avalanche."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _byte_values(seed: int) -> np.ndarray:
    return mix((np.arange(256, dtype=np.uint64) + U(256 * seed + 1)) * U(_BASE))


def _lowered(values: np.ndarray) -> np.ndarray:
    """A-Z count as a-z."""
    values = values.copy()
    values[65:91] = values[97:123]
    return values


#: Two arrays of a fixed length.
_powers: dict[str, np.ndarray] = {}
_VALUES = [_byte_values(0), _byte_values(1), _byte_values(2)]
_LOWERED = _lowered(_VALUES[0])


def _power(name: str, base: int, n: int) -> np.ndarray:
    """base^0 ... base^(n-1) modulo 2^64; those that most chunks need are kept."""

    def make(n: int) -> np.ndarray:
        p = np.full(n, U(base))
        p[0] = 1
        return np.cumprod(p)

    usual = 2 * CHUNK + 4096
    if n > usual:
        return make(n)
    if name not in _powers:
        _powers[name] = make(usual)
    return _powers[name][:n]


def ranged_hashes(data: np.ndarray, begin: np.ndarray, stop: np.ndarray, seed: int = 0, values: np.ndarray | None = None) -> np.ndarray:
    """A 64-bit hash of each range of bytes; ranges with equal bytes have equal ones. By prefix sums, so the cost is
    that of the data, not of the ranges."""
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_VALUES[seed] if values is None else values)[data] * _power("up", _BASE, len(data)), out=total[1:])
    # empty ranges at the end have no power
    h = (total[stop] - total[begin]) * _power("down", _INVERSE, len(data) + 1)[begin]
    return mix(h + (stop - begin).astype(np.uint64))


def _word_hashes(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """data: bytes of texts, each followed by a separator at `ends`. Hash of every word, words of every text."""
    gap = _SEPARATOR[data]
    word = ~gap
    edge = np.flatnonzero(np.diff(word.astype(np.int8), prepend=0, append=0))
    begin, stop = edge[0::2], edge[1::2]
    counts = np.diff(np.searchsorted(begin, ends), prepend=0)
    return ranged_hashes(data, begin, stop, values=_LOWERED), counts


def shingle_sets(column, n: int = 5) -> list[np.ndarray]:
    """column: an Arrow string array. The sorted distinct shingle hashes of each text; none for null."""
    import pyarrow as pa

    out: list[np.ndarray] = []
    at, sizes = 0, np.array([len(x) if x is not None else 0 for x in column.cast(pa.binary()).to_pylist()], np.int64)
    while at < len(column):
        upto = max(at + 1, int(np.searchsorted(np.cumsum(sizes[at:]), CHUNK, "right")) + at)
        data = np.frombuffer(b"\n".join(x or b"" for x in column.slice(at, upto - at).cast(pa.binary()).to_pylist()) + b"\n", np.uint8)
        ends = np.cumsum(sizes[at:upto] + 1) - 1
        words, counts = _word_hashes(data, ends)
        run = np.zeros(max(0, len(words) - n + 1), np.uint64)
        for i, c in enumerate(_power("up", _BASE, n + 1)[1:]):
            run += words[i : i + len(run)] * c
        run = mix(run)
        first = 0
        for c in counts.tolist():
            if c >= n:
                out.append(np.unique(run[first : first + c - n + 1]))
            elif c:
                few = (words[first : first + c] * _power("up", _BASE, n + 1)[1 : c + 1]).sum(dtype=np.uint64)
                out.append(mix(np.array([few + U(c)], np.uint64)))
            else:
                out.append(np.zeros(0, np.uint64))
            first += c
        at = upto
    return out


def set_id(s: np.ndarray) -> int:
    """Of equal sets the same signed 64-bit number; of different ones another but for a 64-bit collision."""
    h = mix(mix(s * U(0xD1342543DE82EF95) + U(len(s))).sum(dtype=np.uint64, keepdims=True) + U(len(s)))
    return int(h.astype(np.int64)[0])
