"""Words of many texts at once, as NumPy arrays over one buffer of bytes."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

#: Bytes of text worked on together; a longer text makes a block of its own.
BLOCK = 1 << 19
_BASE = 0x9E3779B97F4A7C15 | 1

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Classes of bytes; beyond ASCII counts as a letter.
KIND = np.full(256, 4, np.uint8)
KIND[[*range(97, 123), *range(128, 256)]] = 0
KIND[65:91] = 1
KIND[48:58] = 2
KIND[[*b".,;:?'\"()-"]] = 3


def blocks(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first, texts) of runs of at most BLOCK bytes."""
    at, size = 0, 0
    for k, t in enumerate(texts):
        if size and size + len(t) > BLOCK:
            yield at, texts[at:k]
            at, size = k, 0
        size += len(t) + 1
    if at < len(texts):
        yield at, texts[at:]


def words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """buffer, starts, ends, and the text each word is of."""
    buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    space = SPACES[buf]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edge = np.r_[0, edge]
    starts, ends = edge[::2], edge[1::2]
    first = np.cumsum([0] + [len(t) + 1 for t in texts])
    return buf, starts, ends, np.searchsorted(first, starts, "right") - 1


def counts(mask: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many bytes of each word are in the mask."""
    total = np.zeros(len(mask) + 1, np.int32)
    np.cumsum(mask, dtype=np.int32, out=total[1:])
    return total[ends] - total[starts]


@lru_cache(maxsize=4)
def _powers(log2: int) -> tuple[np.ndarray, np.ndarray]:
    n = 1 << log2
    inverse = pow(_BASE, -1, 1 << 64)
    out = []
    for x in (_BASE, inverse):
        p = np.full(n, x, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit words."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, the same wherever the word stands."""
    up, down = _powers(max(12, len(buf).bit_length()))
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * up[: len(buf)], out=total[1:])
    return mixed((total[ends] - total[starts]) * down[starts])
