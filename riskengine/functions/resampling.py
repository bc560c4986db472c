"""Exact bootstrap weights as pure functions of (seed, resample, row), on numpy arrays.

A resample of n rows out of n is drawn in two steps. Every row draws a Poisson count with a mean
just below 1, a pure function of its rank; given their sum, such counts are a uniform draw of that
many rows. What the sum lacks to n is drawn row by row. Together these are exactly n uniform draws
with replacement, while almost all of a row's weight can be computed wherever the row is.
"""

from __future__ import annotations

import math
from itertools import accumulate

import numpy as np

# The increment and the multipliers of the SplitMix64 generator.
GAMMA = 0x9E3779B97F4A7C15
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
# A counter is resample * 2^40 + rank (or number of the extra draw).
REP_SHIFT = 40
# The sum of the counts stays this many standard deviations below n.
RESERVE = 5.0
# Terms of the Poisson distribution, beyond what 53 bits can tell from 1.
TERMS = 20


def mix64(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(30))) * np.uint64(MIX[0])
    z = (z ^ (z >> np.uint64(27))) * np.uint64(MIX[1])
    return z ^ (z >> np.uint64(31))


def stream(seed: int, purpose: int, attempt: int) -> int:
    """Where the numbers of a purpose (0 weights, 1 extra draws) and attempt begin."""
    z = np.array([seed, purpose, attempt], np.uint64)
    state = np.zeros(1, np.uint64)
    for part in z:
        state = mix64(state + part + np.uint64(GAMMA))
    return int(state[0])


def uniforms(start: int, reps: np.ndarray, counters: np.ndarray) -> np.ndarray:
    """Uniform numbers in [0, 1) of 53 bits, (reps, counters)."""
    at = (reps.astype(np.uint64) << np.uint64(REP_SHIFT))[:, None] + counters.astype(np.uint64)[None, :]
    return (mix64(np.uint64(start) + at * np.uint64(GAMMA)) >> np.uint64(11)).astype(np.float64) * 2.0**-53


def mean_of(n_rows: int) -> float:
    """The mean of a row's count; 0 where the reserve would take all rows."""
    return max(0.0, 1.0 - RESERVE / math.sqrt(n_rows))


def poisson_cdf(mean: float) -> list[float]:
    return list(accumulate(math.exp(-mean) * mean**k / math.factorial(k) for k in range(TERMS)))


def counts(start: int, cdf: np.ndarray, reps: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The rows' counts by inversion, (reps, ranks)."""
    return np.searchsorted(cdf, uniforms(start, reps, ranks)).astype(np.int64)
