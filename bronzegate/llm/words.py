"""Words of whole texts as numpy arrays: offsets and 64-bit hashes, without a loop per word.

A word is a run of bytes other than the six ASCII white-space bytes, as ``bytes.split``
has it; A-Z may be lower-cased first (``bytes.lower`` changes nothing else).  Work
goes in blocks of about a megabyte cut at white space, so memory follows the
block and the number of words, not the bytes of the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
SPACES = np.zeros(256, bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_rng.integers(1, 2**60)) * 8 + 5
_STEPS = _rng.integers(1, 2**63, 512, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``n`` powers of the hash base and of its inverse."""
    if not _powers or len(_powers["up"]) < n:
        size = max(n, BLOCK + 4096)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
            t = np.full(size, base, np.uint64)
            t[0] = 1
            _powers[name] = np.multiply.accumulate(t)
    return _powers["up"], _powers["down"]


def _spans(data: np.ndarray, spaces: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~spaces[data]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    up, down = powers(len(data) + 1)
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE[data] * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def words(raw: bytes, spaces: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, hash) of the words of ``raw``; starts and ends are byte offsets.

    ``spaces`` marks the bytes that part words.
    """
    data = np.frombuffer(raw, np.uint8)
    out, at = [], 0
    while at < len(data):
        to = min(len(data), at + BLOCK)
        if to < len(data):  # back to white space, or on to the next
            back = np.flatnonzero(spaces[data[at:to]])
            if len(back):
                to = at + int(back[-1]) + 1
            while to < len(data) and not spaces[data[to - 1]]:
                ahead = np.flatnonzero(spaces[data[to : to + BLOCK]])
                to = to + int(ahead[0]) + 1 if len(ahead) else min(len(data), to + BLOCK)
        part = data[at:to]
        s, e = _spans(part, spaces)
        out.append((s + at, e + at, _hashes(part, s, e)))
        at = to
    if not out:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64)
    return out[0] if len(out) == 1 else tuple(np.concatenate(x) for x in zip(*out))


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every ``k`` consecutive words (empty if there are fewer)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for j in range(k):
        h += hashes[j : j + n] * _STEPS[j]
    return mix(h)


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null is empty."""
    return [b"" if t is None else t for t in column.cast(pa.large_binary()).to_pylist()]


def joined(parts: list[bytes], limit: int = BLOCK) -> Iterator[tuple[int, int, bytes, np.ndarray]]:
    """Runs of consecutive texts of about ``limit`` bytes together: (first, last, bytes, starts).

    Texts are parted by one newline, so no word reaches over; a long text is alone.
    """
    first = 0
    while first < len(parts):
        last, size = first, 0
        while last < len(parts) and (last == first or size + len(parts[last]) <= limit):
            size += len(parts[last]) + 1
            last += 1
        lengths = np.fromiter((len(p) + 1 for p in parts[first:last]), np.int64, last - first)
        yield first, last, b"\n".join(parts[first:last]), np.cumsum(lengths) - lengths
        first = last
