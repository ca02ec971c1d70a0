"""CGK embedding of word sequences and bit-sampling keys.

The embedding (Chakraborty, Goldenberg, Koucky) walks a sequence: each of its 3n steps emits the
current symbol and moves on if a random bit of that step and symbol says so; behind the end it
emits a padding symbol. Two sequences at a small edit distance mostly emit the same symbols, since
their walks meet again by chance after an edit, so edit distance becomes Hamming distance. A key
samples a few of the steps; equal keys make a candidate. Each repetition walks with bits of its own.
"""

from __future__ import annotations

import numpy as np

from bikenet.llm.text_arrays import mix

REPETITIONS = 32
#: Steps that a key samples: (longest sequence, steps). The more edits a sequence may have, the less
#: often two walks agree at a step, so fewer steps keep the chance of an equal key up.
SAMPLED = ((60, 3), (250, 2), (None, 1))
_MOST = max(steps for _, steps in SAMPLED)

_RANDOM = mix(np.arange(1, 1 + 3 * REPETITIONS, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_PLACE = _RANDOM[:_MOST] | np.uint64(1)
_OWN = _RANDOM[REPETITIONS : 2 * REPETITIONS]


def sampled_steps(size: int) -> np.ndarray:
    """For each repetition the steps of its key, (REPETITIONS, steps sampled at that size).

    Half the steps move on, so a walk of n symbols is over after 2n steps or so. Keys sample the
    first 1.6n of the 3n steps; later ones are padding in most walks and would tell nothing.
    """
    sampled = next(steps for longest, steps in SAMPLED if longest is None or size <= longest)
    draw = mix(np.arange(REPETITIONS * _MOST, dtype=np.uint64) + np.uint64(0xA5A5)) >> np.uint64(11)
    places = (draw.astype(np.float64) / 2.0**53 * 1.6 * size).astype(np.int64)
    return places.reshape(REPETITIONS, _MOST)[:, :sampled]


def keys(windows: np.ndarray, size: int) -> np.ndarray:
    """(windows, REPETITIONS) keys of the first ``size`` symbols of each row; 0 is the padding."""
    rows = len(windows)
    steps = sampled_steps(size)
    padded = np.zeros((rows, size + 1), dtype=np.uint64)
    padded[:, :size] = windows[:, :size]
    flat = padded.ravel()
    base = np.arange(rows, dtype=np.int64) * (size + 1)
    at = np.zeros((REPETITIONS, rows), dtype=np.int64)
    out = np.zeros((REPETITIONS, rows), dtype=np.uint64)
    for step in range(int(steps.max()) + 1):
        symbol = flat[at + base]
        for repetition, place in zip(*np.nonzero(steps == step)):
            out[repetition] += symbol[repetition] * _PLACE[place]
        bits = mix(_OWN + np.uint64(step)) | np.uint64(1)
        at += ((symbol * bits[:, None]) >> np.uint64(63)).astype(np.int64)
        np.minimum(at, size, out=at)
    return mix(out + _OWN[:, None] + np.uint64(size)).T
