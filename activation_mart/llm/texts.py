"""Texts as arrays: words, their hashes and rolling hashes of n-grams, in numpy."""

from __future__ import annotations

import numpy as np

STEP = np.uint64(0x9E3779B97F4A7C15)  # odd, hence invertible modulo 2**64
BACK = np.uint64(pow(int(STEP), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_tables: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """STEP**i and STEP**-i for i below n; the tables grow as needed."""
    if len(_tables.get("up", ())) < n:
        size = 1 << max(12, int(n - 1).bit_length())
        _tables["up"], _tables["down"] = _powers(STEP, size), _powers(BACK, size)
    return _tables["up"][:n], _tables["down"][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def prefix_hashes(values: np.ndarray) -> np.ndarray:
    """Sums of value x STEP**i before each place, modulo 2**64; one more than values."""
    up, _ = powers(len(values) + 1)
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[:-1], out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of spans, alike wherever they stand."""
    _, down = powers(len(prefix))
    return mixed((prefix[ends] - prefix[starts]) * down[starts])


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], mask, [False])).view(np.int8)))
    return edge[::2], edge[1::2]


def codes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)


def ngrams(words: np.ndarray, lengths: range):
    """(n, hashes of all n-grams of word hashes) for rising n, each from the one before."""
    rolled = words
    for n in range(1, lengths.stop):
        if n > 1:
            if len(words) < n:
                return
            rolled = rolled[:-1] * STEP + words[n - 1 :]
        if n >= lengths.start:
            yield n, rolled


def repeated(hashes: np.ndarray) -> np.ndarray | None:
    """Mask of the hashes that occur twice or more; None if none does."""
    ordered = np.sort(hashes)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return None
    at = np.searchsorted(twice, hashes)
    return twice[np.minimum(at, len(twice) - 1)] == hashes


def covered(mask: np.ndarray, n: int, size: int) -> np.ndarray:
    """Places inside any of the n-long windows that the mask marks."""
    edge = np.zeros(size + 1, np.int64)
    starts = np.flatnonzero(mask)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + n, -1)
    return np.cumsum(edge[:-1]) > 0
