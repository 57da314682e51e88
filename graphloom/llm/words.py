"""Word hashing inside tasks: one 64-bit hash a word, and polynomial hashes of runs of words, many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Odd multipliers of the polynomial hashes of bytes and of words; wrap-around in 64 bits is meant.
OF_BYTES, OF_WORDS = 0xC2B2AE3D27D4EB4F, 0x9E3779B97F4A7C15
#: Bytes hashed at once, if no word is longer.
_PIECE = 1 << 20
#: About how many bytes of texts are taken apart together.
SOME_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads the entropy of 64-bit values over all bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _power(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i for i up to n (at least), modulo 2**64."""
    got = _powers.get(base)
    if got is None or len(got[0]) <= n:
        size = max(4096, 2 * n)
        ups, downs = np.full(size, base, np.uint64), np.full(size, pow(base, -1, 1 << 64), np.uint64)
        ups[0] = downs[0] = 1
        got = _powers[base] = (np.cumprod(ups), np.cumprod(downs))
    return got


class Runs:
    """Hashes of runs of a sequence of 64-bit values, from prefix sums."""

    def __init__(self, values: np.ndarray, base: int = OF_WORDS):
        self.n = len(values)
        up, self.down = _power(base, self.n)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * up[: self.n])])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Of the values from start to end (exclusive)."""
        return mixed((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))


class Tokens:
    """The words of some texts: runs of bytes other than space and U+0009..U+000D.

    ``bytes`` holds all words, each with one space behind it; word i is bytes[starts[i]:ends[i]] and has hashes[i].
    The words of text t are those from begins[t] on, counts[t] of them.
    """

    def __init__(self, texts: list[str | None], lower: bool = False):
        data = [t.encode() if t else b"" for t in texts]
        raw = np.frombuffer(b" ".join([*data, b""]), np.uint8)
        space = _SPACE[raw]
        before = np.concatenate([np.ones(1, bool), space[:-1]]) if len(raw) else space
        sizes = np.fromiter(map(len, data), np.int64, len(data)) + 1
        text = np.searchsorted(np.cumsum(sizes) - sizes, np.flatnonzero(~space & before), "right") - 1
        self.counts = np.bincount(text, minlength=len(texts))
        self.begins = np.cumsum(self.counts) - self.counts
        self.bytes = np.where(space, np.uint8(32), _LOWER[raw] if lower else raw)[~(space & before)]
        self.ends = np.flatnonzero(self.bytes == 32)
        self.starts = np.concatenate([np.zeros(1, np.int64), self.ends[:-1] + 1])[: len(self.ends)]
        self.hashes = self._hashes()

    def _hashes(self) -> np.ndarray:
        out, lo = np.empty(len(self.ends), np.uint64), 0
        while lo < len(self.ends):
            hi = max(lo + 1, int(np.searchsorted(self.ends, self.starts[lo] + _PIECE)))
            at = self.starts[lo]
            runs = Runs(self.bytes[at : self.ends[hi - 1]].astype(np.uint64), OF_BYTES)
            out[lo:hi] = runs.hash(self.starts[lo:hi] - at, self.ends[lo:hi] - at)
            lo = hi
        return out

    def spelled(self, lo: int, hi: int) -> memoryview:
        """The words from lo to hi (exclusive) with one space between."""
        return self.bytes[self.starts[lo] : self.ends[hi - 1]].data if hi > lo else memoryview(b"")


def together(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    """Rows whose first value is a text, in lists of about SOME_BYTES."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[0] or "")
        if size > SOME_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def shingle_sets(texts: list[str | None], size: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its lower-cased (A-Z) word shingles; of the whole sequence if it is shorter."""
    out = []
    for held in together((t,) for t in texts):
        tokens = Tokens([t for t, in held], lower=True)
        runs = Runs(tokens.hashes)
        n = np.where(tokens.counts > 0, np.maximum(1, tokens.counts - size + 1), 0)
        first = np.cumsum(n) - n
        start = np.arange(n.sum()) + np.repeat(tokens.begins - first, n)
        h = runs.hash(start, np.minimum(start + size, np.repeat(tokens.begins + tokens.counts, n)))
        out += [np.unique(h[a : a + m]) for a, m in zip(first.tolist(), n.tolist(), strict=True)]
    return out


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
