"""Hashed word shingles of whole batches of texts, computed with numpy over the UTF-8 bytes.

Words are runs of bytes other than space and the controls 0x09-0x0D, after lower-casing A-Z. A word's hash is a
polynomial of its bytes modulo 2**64 and a finaliser, a shingle's hash mixes those of its words in order. Two different
shingles of one comparison share a hash with a chance of about 2**-64; everything built on top treats equal hashes as
equal shingles.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
UNBASE = np.uint64(pow(int(BASE), -1, 1 << 64))
# Bytes of text hashed at once; a longer text is a batch of its own.
BATCH_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts in order, and where each text's words start (one more entry than texts)."""
    data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    space = _SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).astype(np.int8)))
    first, last = edge[0::2], edge[1::2]
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * _powers(BASE, len(data)), dtype=np.uint64)))
    hashes = mix((total[last] - total[first]) * _powers(UNBASE, len(data) + 1)[first] + (last - first).astype(np.uint64))
    return hashes, np.concatenate(([0], np.searchsorted(first, ends)))


def shingle_sets(texts: Sequence[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, back to back; and the number in each text.

    A text with fewer than ``width`` words has one shingle of all its words; one without words has none.
    """
    words, start = word_hashes(texts)
    count = np.diff(start)
    made = np.where(count >= width, count - width + 1, (count > 0).astype(count.dtype))
    owner = np.repeat(np.arange(len(texts)), made)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(made) - made, made) + start[:-1][owner]
    length = np.minimum(count, width)[owner]
    out = length.astype(np.uint64)
    for k in range(width):
        has = length > k
        out[has] = mix(out[has] * BASE + words[at[has] + k])
    order = np.lexsort((out, owner))
    out, owner = out[order], owner[order]
    fresh = np.ones(len(out), bool)
    fresh[1:] = (out[1:] != out[:-1]) | (owner[1:] != owner[:-1])
    return out[fresh], np.bincount(owner[fresh], minlength=len(texts))


def batches(texts: Sequence[str | None]) -> Iterator[tuple[int, int, list[bytes]]]:
    """Cut a column of texts into runs of some megabytes: ``(from, to, encoded texts)``. A null counts as empty."""
    held, size, first = [], 0, 0
    for i, text in enumerate(texts):
        held.append((text or "").encode("utf-8", "surrogatepass"))
        size += len(held[-1])
        if size >= BATCH_BYTES:
            yield first, i + 1, held
            held, size, first = [], 0, i + 1
    if held:
        yield first, len(texts), held
