"""Chunks of texts, for whole batches at once: hashes of byte ranges, and what a worker knows of them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from threadloom.llm.common import ranges
from threadloom.llm.shingles import ranged_hashes

#: Chunks that a worker remembers (some 40 bytes each), the longest that it does, and bytes of text handled at once.
MEMO, LONGEST, SLICE = 2_000_000, 64, 1 << 20


def text_slices(column) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """column: an Arrow string array without nulls. UTF-8 of some texts on end, and where each begins and ends; a slice
    has at most SLICE bytes or one text."""
    import pyarrow as pa

    i, size = 0, np.cumsum(np.diff(_offsets(column))) if len(column) else np.zeros(0, np.int64)
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(size, (size[i - 1] if i else 0) + SLICE, "right")))
        part = column.slice(i, j - i).cast(pa.large_binary())
        o = _offsets(part)
        data = np.frombuffer(part.buffers()[2], np.uint8)[o[0] : o[-1]] if o[-1] > o[0] else np.zeros(0, np.uint8)
        yield data, o[:-1] - o[0], o[1:] - o[0]
        i = j


def _offsets(column) -> np.ndarray:
    import pyarrow as pa

    column = column.cast(pa.large_binary())
    return np.frombuffer(column.buffers()[1], np.int64)[column.offset :][: len(column) + 1]


def distinct_ranges(data: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, ...] | None:
    """Two hashes of each distinct range (the first ascending), a range that has them, and for every range which it is.
    None where two ranges share only the first hash."""
    h, g = (ranged_hashes(data, begin, stop, seed) for seed in (1, 2))
    u, one, of = np.unique(h, return_index=True, return_inverse=True)
    return None if (g != g[one][of]).any() else (u, g[one], one, of)


class Known:
    """Ids of chunks, or only how many, by their 128-bit hash: sorted arrays, so that a batch is looked up at once. New
    ones go to a small table, which joins the large one now and then. At MEMO entries those not asked for since the
    last time go, and all if that are more than half."""

    COLUMNS = ("h", "g", "at", "n", "used")

    def __init__(self, dtype: str = "<u2"):
        self.ids, self.filled = np.zeros(1 << 16, dtype), 0
        none = dict(zip(self.COLUMNS, (np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int32, bool)), strict=True))
        self.tables = [none, none]

    def find(self, h: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """h ascending. Where the ids of each begin, how many there are, and whether it is known."""
        at, n, good = np.zeros(len(h), np.int64), np.zeros(len(h), np.int64), np.zeros(len(h), bool)
        for t in self.tables:
            if len(t["h"]):
                i = np.minimum(np.searchsorted(t["h"], h), len(t["h"]) - 1)
                hit = (t["h"][i] == h) & (t["g"][i] == g)
                i = i[hit]
                at[hit], n[hit], good[hit], t["used"][i] = t["at"][i], t["n"][i], True, True
        return at, n, good

    def put(self, ids: np.ndarray) -> int:
        """Place ids behind those that are filled; `filled` stays, so what isn't kept is written over."""
        if self.filled + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.filled], np.zeros(self.filled + 2 * len(ids), self.ids.dtype)])
        self.ids[self.filled : self.filled + len(ids)] = ids
        return self.filled

    def keep(self, h: np.ndarray, g: np.ndarray, at: np.ndarray, n: np.ndarray, size: int) -> None:
        """h ascending and unknown; their ids are the `size` ones put last."""
        self.filled += size
        self.tables[1] = self._merged(self.tables[1], dict(zip(self.COLUMNS, (h, g, at, n.astype(np.int32), np.ones(len(h), bool)), strict=True)))
        if 8 * len(self.tables[1]["h"]) > len(self.tables[0]["h"]):
            big = self._merged(*self.tables)
            if len(big["h"]) > MEMO:
                big = {c: v[big["used"]] for c, v in big.items()}
                big["used"][:] = False
                if len(big["h"]) > MEMO // 2:
                    big = {c: v[:0] for c, v in big.items()}
                if self.filled:
                    self.ids = self.ids[ranges(big["at"], big["n"])]
                    self.filled, big["at"] = len(self.ids), np.cumsum(big["n"], dtype=np.int64) - big["n"]
            self.tables = [big, {c: v[:0] for c, v in big.items()}]

    def _merged(self, a: dict, b: dict) -> dict:
        where = np.searchsorted(a["h"], b["h"])
        return {c: np.insert(a[c], where, b[c]) for c in self.COLUMNS}
