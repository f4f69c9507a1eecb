"""DartMinHash signatures of weighted sets.

Over every element lies a strip as wide as its weight. Darts fall on the strips as a
Poisson process of rate one, along an axis of ranks; where they fall depends on the
element alone. A set sees the darts within its weights, each of which belongs to one
of ``k`` coordinates by hash; the earliest dart of a coordinate is its sample. Two
sets share a coordinate's dart with the probability of their weighted Jaccard
similarity. About ``k ln k + 2 k`` darts fill all coordinates, however many elements
there are: ranks are thrown up to that many over the set's weight, and further only
for sets with a coordinate still empty.
"""

from __future__ import annotations

import math

import numpy as np

from gapledger.llm.shingles import mix

_CELL, _GAP, _PLACE, _ACROSS = (
    np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)
)


def _uniform(x: np.ndarray) -> np.ndarray:
    """In (0, 1)."""
    return ((mix(x) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def dart_signatures(
    elements: np.ndarray, weights: np.ndarray, owner: np.ndarray, sets: int, k: int
) -> np.ndarray:
    """Signatures (set, coordinate). Set ``owner[i]`` has ``elements[i]`` with ``weights[i]`` above 0.

    An element may occur once in a set. Each set in 0..sets-1 needs an element.
    """
    total = np.bincount(owner, weights, sets)
    reach = (k * math.log(k) + 2 * k) / total
    # Strips are cut to cells of width one; the last may be narrower.
    widths = np.ceil(weights).astype(np.int64)
    cell = np.repeat(np.arange(len(elements)), widths)
    step = np.arange(len(cell)) - np.repeat(np.cumsum(widths) - widths, widths)
    narrow = weights[cell] - step
    seed = mix(elements[cell] + step.astype(np.uint64) * _CELL)
    of = owner[cell]
    thrown = np.zeros(len(seed), np.uint64)
    rank = -np.log(_uniform(seed ^ _GAP))
    best = np.full(sets * k, np.inf)
    signature = np.zeros(sets * k, np.uint64)
    while len(seed):
        active = np.flatnonzero(rank <= reach[of])
        while len(active):
            dart = mix(seed[active] + thrown[active] * _CELL)
            slot = of[active] * k + (mix(dart ^ _PLACE) % np.uint64(k)).astype(np.int64)
            hit = narrow[active] >= 1
            if not hit.all():
                hit |= _uniform(dart ^ _ACROSS) <= narrow[active]
            at, when = slot[hit], rank[active[hit]]
            np.minimum.at(best, at, when)
            first = when == best[at]
            signature[at[first]] = dart[hit][first]
            thrown[active] += np.uint64(1)
            rank[active] -= np.log(_uniform((seed[active] + thrown[active] * _CELL) ^ _GAP))
            active = active[rank[active] <= reach[of[active]]]
        open_sets = np.isinf(best).reshape(sets, k).any(1)
        reach[open_sets] *= 2
        going = open_sets[of]
        seed, of, thrown, rank, narrow = (x[going] for x in (seed, of, thrown, rank, narrow))
    return signature.reshape(sets, k)


def band_hashes(signatures: np.ndarray, rows: int) -> np.ndarray:
    """One hash for each run of ``rows`` coordinates."""
    sets, k = signatures.shape
    parts = signatures.reshape(sets, k // rows, rows)
    joined = np.zeros(parts.shape[:2], np.uint64)
    for i in range(rows):
        joined = mix(joined * _CELL + parts[:, :, i])
    return joined
