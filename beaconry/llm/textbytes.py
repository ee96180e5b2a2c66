"""Words of many texts as NumPy arrays, without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BASE = 0x9E3779B97F4A7C55  # odd, so that it has an inverse modulo 2**64
INVERSE = pow(BASE, -1, 2**64)
CHUNK = 1 << 20

IS_BLANK = np.zeros(256, bool)
IS_BLANK[[9, 10, 11, 12, 13, 32]] = True
#: ASCII letters and digits and all bytes of other characters make up tokens
IS_GAP = np.ones(256, bool)
IS_GAP[list(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = False
IS_GAP[128:] = False


class Powers:
    """Powers of the hash base and of its inverse, extended as texts demand."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) <= n:
            size = max(n + 1, 1 << 16)
            for name, base in (("up", BASE), ("down", INVERSE)):
                factors = np.full(size, base, np.uint64)
                factors[0] = 1
                setattr(cls, name, np.multiply.accumulate(factors))
        return cls.up, cls.down


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 bits."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def spans_hash(values: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Polynomial hashes of ``values[start:stop]``, from one running sum."""
    up, down = Powers.upto(len(values))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values + np.uint64(1)) * up[:len(values)], out=sums[1:])
    return mixed((sums[stops] - sums[starts]) * down[starts])


def windows_hash(values: np.ndarray, size: int) -> np.ndarray:
    """Polynomial hashes of all windows of ``size`` values."""
    count = max(0, len(values) - size + 1)
    starts = np.arange(count)
    return spans_hash(values, starts, starts + size)


def word_bounds(raw: np.ndarray, gap: np.ndarray = IS_BLANK) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes that are no gaps."""
    solid = np.concatenate(([False], ~gap[raw], [False]))
    edges = np.flatnonzero(solid[1:] != solid[:-1])
    return edges[::2], edges[1::2]


def word_hashes(raw: np.ndarray, gap: np.ndarray = IS_BLANK) -> np.ndarray:
    """One 64-bit hash per word of a text of any length, worked off in pieces that end between words."""
    starts, stops = word_bounds(raw, gap)
    found, at = [], 0
    while at < len(starts):
        end = max(at + 1, int(np.searchsorted(stops, starts[at] + CHUNK, "right")))
        low = starts[at]
        found.append(spans_hash(raw[low:stops[end - 1]].astype(np.uint64), starts[at:end] - low, stops[at:end] - low))
        at = end
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def chunked(sizes: list[int], limit: int = CHUNK) -> Iterator[slice]:
    """Runs of rows of up to ``limit`` bytes together; a larger row is a run of its own."""
    begin = total = 0
    for n, size in enumerate(sizes):
        if n > begin and total + size > limit:
            yield slice(begin, n)
            begin, total = n, 0
        total += size
    if begin < len(sizes):
        yield slice(begin, len(sizes))


def folded(raw: np.ndarray) -> np.ndarray:
    """A-Z in lower case."""
    return raw + (32 * ((raw >= 65) & (raw <= 90))).astype(np.uint8)


def word_stream(texts: list[bytes], gap: np.ndarray = IS_BLANK, fold: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts in a row, and where each text's words begin (one entry more than texts)."""
    joined = np.frombuffer(b"\n".join(texts), np.uint8)
    begins = np.cumsum([0] + [len(t) + 1 for t in texts])
    starts, _ = word_bounds(joined, gap)
    return word_hashes(folded(joined) if fold else joined, gap), np.searchsorted(starts, begins)


def word_ids(raw: np.ndarray, starts: np.ndarray, stops: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Equal numbers for equal words, compared by their bytes; the hashes only bring them together."""
    _, first, ids = np.unique(hashes, return_index=True, return_inverse=True)
    like = first[ids]
    sizes = stops - starts
    if (sizes == sizes[like]).all():
        step = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        if (raw[np.repeat(starts, sizes) + step] == raw[np.repeat(starts[like], sizes) + step]).all():
            return ids
    known: dict[bytes, int] = {}
    return np.array([known.setdefault(raw[a:b].tobytes(), len(known)) for a, b in zip(starts, stops)], np.int64)


def pair_ids(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Equal numbers for equal pairs."""
    if not len(left):
        return np.zeros(0, np.int64)
    return np.unique(left.astype(np.int64) * (int(right.max()) + 1) + right, return_inverse=True)[1]
