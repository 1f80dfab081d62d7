"""Array kernels over whole texts: words, lines and their 64-bit hashes, many texts at a time.

Texts are laid end to end as code points; words and lines are found with lookup tables, and every
span's hash comes from one running polynomial, so the cost per character does not depend on how
many spans there are. Hashes depend on nothing but the characters, so all workers agree on them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np

CODES = 0x110000
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
CHUNK = 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the finaliser of splitmix64)."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _values() -> np.ndarray:
    return mix(np.arange(1, CODES + 1, dtype=np.uint64) * np.uint64(BASE))


@cache
def _powers(bits: int, base: int) -> np.ndarray:
    steps = np.full(1 << bits, base, np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


def powers(n: int, base: int = BASE) -> np.ndarray:
    return _powers(max(16, int(n).bit_length()), base)[:n]


@cache
def table(kind: str) -> np.ndarray:
    """A truth value for each code point: ``word`` (letters, digits, _), ``letter``, ``digit``,
    ``upper``, or ``blank`` (space, tab to carriage return)."""
    if kind == "blank":
        out = np.zeros(CODES, bool)
        out[[0x20, *range(0x09, 0x0E)]] = True
        return out
    test = {
        "word": lambda c: c.isalnum() or c == "_",
        "letter": str.isalpha,
        "digit": str.isdigit,
        "upper": str.isupper,
    }[kind]
    return np.fromiter((test(chr(i)) for i in range(CODES)), bool, CODES)


def only(characters: str) -> np.ndarray:
    out = np.zeros(CODES, bool)
    out[[ord(c) for c in characters]] = True
    return out


def chunks(texts: list[str], limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts that hold about ``limit`` characters; a longer text is a run alone."""
    start = held = 0
    for i, text in enumerate(texts):
        if i > start and held + len(text) > limit:
            yield start, i
            start, held = i, 0
        held += len(text)
    if texts:
        yield start, len(texts)


class Laid:
    """Texts laid end to end, with one line feed after each, and hashes of their spans."""

    def __init__(self, texts: list[str]):
        joined = "\n".join([*texts, ""])
        self.codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
        lengths = np.fromiter((len(t) for t in texts), np.int64, len(texts))
        self.starts = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1]
        self.ends = self.starts + lengths
        self._sums: np.ndarray | None = None

    def owner(self, positions: np.ndarray) -> np.ndarray:
        """Which text each position belongs to."""
        return np.searchsorted(self.starts, positions, side="right") - 1

    def runs(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the longest stretches where ``inside`` holds."""
        edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
        return edges[::2], edges[1::2]

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        return self.runs(table("word")[self.codes])

    def lines(self) -> tuple[np.ndarray, np.ndarray]:
        """Every text split at line feeds; n line feeds make n + 1 lines."""
        ends = np.flatnonzero(self.codes == 10)
        return np.concatenate([[0], ends[:-1] + 1]).astype(np.int64), ends

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if self._sums is None:
            n = len(self.codes)
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(_values()[self.codes] * powers(n), out=sums[1:])
            self._sums = sums
        spans = (self._sums[ends] - self._sums[starts]) * powers(len(self.codes) + 1, INVERSE)[starts]
        return mix(spans + (ends - starts).astype(np.uint64))

    def count(self, inside: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How many positions of each span are inside."""
        sums = np.concatenate([[0], np.cumsum(inside, dtype=np.int64)])
        return sums[ends] - sums[starts]


def windows(hashes: np.ndarray, owner: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every ``size`` neighbouring items of one owner, and where each window starts."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out = out * np.uint64(BASE) + hashes[i : i + n]
    whole = np.flatnonzero(owner[:n] == owner[size - 1 :])
    return mix(out[whole]), whole


def per_owner(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(owner, weights=values, minlength=n).astype(np.int64)
