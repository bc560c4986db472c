"""HyperMinHash sketches: per bucket the leading zeros and a few mantissa bits of the minimum."""

from __future__ import annotations

import numpy as np

from riskengine.llm.shingles import mix

BANDS, ROWS = 48, 6
BUCKETS = BANDS * ROWS
MANTISSA_BITS = 10
PARITY_BITS = 2048
_VALUE_BITS = 52
_ROUND_STEP = np.uint64(0xA0761D6478BD642F)
# Elements hashed at once when empty buckets are filled.
_FILL = 4096


def _registers(least: np.ndarray) -> np.ndarray:
    """Leading zeros (6 bits) and mantissa (10 bits) of 52-bit values."""
    fraction, exponent = np.frexp(least.astype(np.float64))
    mantissa = np.clip((fraction - 0.5) * (2 << MANTISSA_BITS), 0, (1 << MANTISSA_BITS) - 1).astype(np.uint16)
    return ((_VALUE_BITS - exponent).astype(np.uint16) << np.uint16(MANTISSA_BITS)) | mantissa


def sketch(elements: np.ndarray) -> np.ndarray:
    """Registers (uint16) of a set of 64-bit hashes with one element or more.

    Elements fall into buckets and the least value of each bucket is kept. Buckets that stay empty
    are filled from further rounds of hashing until none is left: the first round with an element
    in a bucket decides, so that two sets agree there with a chance of their Jaccard similarity.
    """
    kept = np.zeros(BUCKETS, dtype=np.uint64)
    empty = np.ones(BUCKETS, dtype=bool)
    done = 0
    while empty.any():
        rounds = max(1, _FILL // len(elements))
        turns = np.arange(done, done + rounds, dtype=np.uint64)[:, None] * _ROUND_STEP
        hashed = mix(elements[None, :] + turns)
        bucket = ((hashed >> np.uint64(40)) * np.uint64(BUCKETS) >> np.uint64(24)).astype(np.int64)
        value = mix(hashed) >> np.uint64(64 - _VALUE_BITS)
        least = np.full((rounds, BUCKETS), np.iinfo(np.uint64).max, dtype=np.uint64)
        flat = bucket + np.arange(rounds)[:, None] * BUCKETS
        np.minimum.at(least.reshape(-1), flat.reshape(-1), value.reshape(-1))
        filled = least != np.iinfo(np.uint64).max
        first = filled.argmax(axis=0)
        now = empty & filled.any(axis=0)
        kept[now] = least[first[now], np.flatnonzero(now)]
        empty &= ~now
        done += rounds
    return _registers(kept)


_BAND_FACTORS = mix(np.arange(101, 101 + ROWS, dtype=np.uint64)) | np.uint64(1)
_BAND_SALTS = mix(np.arange(901, 901 + BANDS, dtype=np.uint64))


def band_keys(registers: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of ROWS registers; keys of different bands do not meet."""
    rows = registers.reshape(BANDS, ROWS).astype(np.uint64) + np.uint64(1)
    return mix((mix(rows) * _BAND_FACTORS).sum(axis=1, dtype=np.uint64) + _BAND_SALTS).view(np.int64)


def low_bits(registers: np.ndarray) -> np.ndarray:
    """The last mantissa bit of the first 256 registers as four 64-bit words."""
    bits = (registers[:256] & np.uint16(1)).astype(np.uint8)
    return np.packbits(bits).view(np.int64)


def chance_agreement(size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Probability that registers of disjoint sets agree by accident, summed over leading zeros."""
    zeros = np.arange(_VALUE_BITS)

    def share(size: np.ndarray) -> np.ndarray:
        rate = np.maximum(size[:, None] / BUCKETS, 1.0)
        return np.exp(-rate * 2.0 ** -(zeros + 1)) - np.exp(-rate * 2.0**-zeros)

    return (share(size_a) * share(size_b)).sum(axis=1) / (1 << MANTISSA_BITS)


def estimated_jaccard(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Share of agreeing registers (rows of `a` and `b`), corrected for accidental agreement."""
    agree = (a == b).mean(axis=1)
    chance = chance_agreement(size_a.astype(float), size_b.astype(float))
    return (agree - chance) / (1 - chance)


def parity_words(elements: np.ndarray) -> np.ndarray:
    """Parity of the number of elements in each of PARITY_BITS hash cells, as 64-bit words.

    Each element of the symmetric difference of two sets flips one cell, so that the cells that
    differ are never more than the elements that do.
    """
    cells = (elements >> np.uint64(64 - PARITY_BITS.bit_length() + 1)).astype(np.int64)
    return np.packbits((np.bincount(cells, minlength=PARITY_BITS) & 1).astype(np.uint8)).view(np.int64)
