"""Words of many texts at once: NumPy over the UTF-8 bytes of an Arrow column, no Python object per word."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row limits (one more than rows) of a text column; null is empty."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    array = pc.fill_null(array.cast(pa.large_string()), "")
    _, offsets, data = array.buffers()
    limits = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[limits[0] : limits[-1]], limits - limits[0]


def mixed(keys: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words in which each input bit reaches all output bits."""
    keys = (keys ^ (keys >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    keys = (keys ^ (keys >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return keys ^ (keys >> np.uint64(31))


class Hasher:
    """64-bit hashes of byte ranges, from one running sum over the bytes."""

    def __init__(self) -> None:
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def _reach(self, size: int) -> None:
        if len(self.up) <= size:
            size = max(size + 1, 1 << 20)
            self.up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, _BASE)]))
            self.down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, _INVERSE)]))

    def __call__(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        self._reach(len(raw))
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * self.up[: len(raw)], out=sums[1:])
        return mixed((sums[ends] - sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))


def runs(classes: np.ndarray, limits: np.ndarray, single: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of one class other than 0, cut at the texts' limits.

    Each element of class ``single`` is a run of its own.
    """
    size = len(classes)
    change = np.ones(size + 1, bool)
    change[1:size] = classes[1:] != classes[:-1]
    if single is not None:
        own = classes == single
        change[:size] |= own
        change[1:] |= own
    change[limits[limits < size]] = True
    at = np.flatnonzero(change[:size])
    after = np.append(at[1:], size)
    inside = classes[at] != 0
    return at[inside], after[inside]


_SPACE = np.ones(256, np.uint8)
_SPACE[[9, 10, 11, 12, 13, 32]] = 0


def word_hashes(raw: np.ndarray, limits: np.ndarray, hasher: Hasher) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words between ASCII white space, and each text's range of words (one more than texts)."""
    starts, ends = runs(_SPACE[raw], limits)
    return hasher(raw, starts, ends), np.searchsorted(starts, limits)
