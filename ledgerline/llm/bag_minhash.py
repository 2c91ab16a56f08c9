"""BagMinHash signatures of weighted sets.

Each element owns a random set of points over (weight, value): a Poisson process. A set takes the points that lie
below the weights of its elements, each point falls into one of the signature's slots, and a slot keeps its smallest
value. Two sets agree in a slot with the probability of their weighted Jaccard similarity (sum of smaller weights by
sum of larger ones).

The weights, whole numbers, are cut into the levels [0, 1), [1, 2), [2, 4), [4, 8) and so on, each with a process of
its own, whose points come in ascending order of value; a level that the weight covers in part keeps the points
below the weight. A level is left as soon as its next value exceeds the largest one in its set's signature, so a
level of a large set costs little more than its first point. All sets of a batch advance together.
"""

from __future__ import annotations

import numpy as np

from ledgerline.llm.scan import mixed

_STEP, _OTHER = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)
#: Points generated at a time, over all levels that are still open.
AT_ONCE = 4096


def signatures(owner: np.ndarray, element: np.ndarray, weight: np.ndarray, sets: int, slots: int) -> np.ndarray:
    """[sets, slots] of values; ``owner`` is the set of each (element, weight). A set without elements has infinity."""
    best = np.full((sets, slots), np.inf)
    if not len(owner):
        return best
    levels = np.frexp(weight.astype(np.float64))[1].astype(np.int64)  # levels that begin below the weight
    levels += weight > (1 << np.maximum(levels - 1, 0))
    levels = np.where(weight == 1, 1, levels)
    row = np.repeat(np.arange(len(owner)), levels)
    level = np.arange(len(row)) - np.repeat(np.cumsum(levels) - levels, levels)
    low = np.where(level == 0, 0, 1 << np.maximum(level - 1, 0)).astype(np.float64)
    width = np.where(level == 0, 1.0, low)
    seed = mixed(element[row] + (level.astype(np.uint64) + np.uint64(1)) * _OTHER)
    doc, most = owner[row], weight[row].astype(np.float64)
    value, turn = np.zeros(len(row)), np.zeros(len(row), dtype=np.uint64)
    flat = best.reshape(-1)
    while len(doc):
        many = int(min(64, max(1, AT_ONCE // len(doc))))
        turns = turn[:, None] + np.arange(1, many + 1, dtype=np.uint64)
        first = mixed(seed[:, None] + turns * _STEP)
        second = mixed(first ^ _OTHER)
        gap = -np.log(((first >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / width[:, None]
        gap[:, 0] += value
        at = np.cumsum(gap, axis=1)
        slot = ((second >> np.uint64(32)) * np.uint64(slots)) >> np.uint64(32)
        place = low[:, None] + np.floor((second & np.uint64(0xFFFFFFFF)).astype(np.float64) * 2.0**-32 * width[:, None])
        take = place < most[:, None]
        cell = doc[:, None] * slots + slot.astype(np.int64)
        np.minimum.at(flat, cell[take], at[take])
        value, turn = at[:, -1], turn + np.uint64(many)
        worst = best.max(axis=1)
        go = value <= worst[doc]
        doc, seed, low, width, most, value, turn = (a[go] for a in (doc, seed, low, width, most, value, turn))
    return best


def band_keys(values: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """[sets, bands] of 64-bit keys, each a hash of ``rows`` slots and the band's number."""
    bits = mixed(values[:, : bands * rows].copy().view(np.uint64)).reshape(len(values), bands, rows)
    key = np.zeros(bits.shape[:2], dtype=np.uint64)
    for i in range(rows):
        key = key * _STEP + bits[:, :, i]
    return mixed(key + np.arange(1, bands + 1, dtype=np.uint64) * _OTHER)
