"""Word shingles of whole texts as 64-bit hashes, a batch of texts at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Texts are hashed in runs of about this many bytes, which bounds the arrays at work.
RUN_BYTES = 1 << 20
_MULTIPLIER = 0x9E3779B97F4A7C15
_SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def mix(x: np.ndarray) -> np.ndarray:
    """A well-spread bijection of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _lowered() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(_SPACES)] = True
# A hash value per byte, equal for both cases of A-Z.
_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULTIPLIER))[_lowered()]


class _Powers:
    """Powers of an odd number and of its inverse modulo 2^64, grown on demand."""

    def __init__(self) -> None:
        self.base = np.uint64(0xD6E8FEB86659FD93)
        self.inverse = np.uint64(pow(int(self.base), -1, 1 << 64))
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            for name, factor in (("up", self.base), ("down", self.inverse)):
                steps = np.full(n, factor, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def _word_hashes(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words in `data`, and the number of words before each text's edge."""
    solid = ~_IS_SPACE[data]
    opens, closes = solid.copy(), solid.copy()
    opens[1:] &= ~solid[:-1]
    closes[:-1] &= ~solid[1:]
    inner = edges[(edges > 0) & (edges < len(data))]
    opens[inner] = solid[inner]
    closes[inner - 1] = solid[inner - 1]
    first, last = np.flatnonzero(opens), np.flatnonzero(closes)
    up, down = _POWERS.upto(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_VALUE[data] * up[:-1], out=sums[1:])
    words = (sums[last + 1] - sums[first]) * down[first]
    words = mix(words + (last - first + 1).astype(np.uint64) * np.uint64(_MULTIPLIER))
    return words, np.searchsorted(first, edges)


def _shingles(words: np.ndarray, before: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a shorter text is one shingle of all its words."""
    factors = mix(np.arange(11, 11 + size, dtype=np.uint64) * np.uint64(_MULTIPLIER)) | np.uint64(1)
    n = max(0, len(words) - size + 1)
    rolled = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        rolled += words[k : k + n] * factors[k]
    rolled = mix(rolled)
    for start, end in zip(before[:-1], before[1:]):
        count = end - start
        if count >= size:
            found = np.sort(rolled[start : end - size + 1])
            yield found[np.concatenate(([True], found[1:] != found[:-1]))]
        elif count:
            part = words[start:end] * factors[:count]
            yield mix(np.array([part.sum(dtype=np.uint64) + np.uint64(count)], dtype=np.uint64))
        else:
            yield np.zeros(0, dtype=np.uint64)


def runs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch (column text) in runs of about RUN_BYTES of text, one row at least."""
    size = np.asarray(pc.fill_null(pc.binary_length(batch.column("text")), 0), dtype=np.int64)
    ends = np.concatenate(([0], np.cumsum(size)))
    at = 0
    while at < batch.num_rows:
        upto = max(at + 1, int(np.searchsorted(ends, ends[at] + RUN_BYTES, side="right")) - 1)
        yield batch.slice(at, upto - at)
        at = upto


def batch_shingles(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """For each text (null: empty) the sorted distinct hashes of its `size`-word shingles.

    A-Z are lower-cased and words stand between ASCII white space.
    """
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
    valid = np.asarray(texts.is_valid())
    at = 0
    while at < len(texts):
        upto = max(at + 1, int(np.searchsorted(offsets, offsets[at] + RUN_BYTES, side="right")) - 1)
        edges = offsets[at : upto + 1]
        data = whole[edges[0] : edges[-1]]
        if len(data):
            words, before = _word_hashes(data, edges - edges[0])
        else:
            words, before = np.zeros(0, dtype=np.uint64), np.zeros(len(edges), dtype=np.int64)
        for ok, found in zip(valid[at:upto], _shingles(words, before, size)):
            yield found if ok else found[:0]
        at = upto
