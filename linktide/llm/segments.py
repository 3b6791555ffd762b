"""All maximal scoring segments of a sequence, in linear time."""

from __future__ import annotations

import numpy as np


def maximal_segments(positive: list[int], before: np.ndarray, after: np.ndarray) -> list[tuple[int, int, float]]:
    """``(start, end, score)`` of the maximal scoring segments, in order.

    ``positive`` lists the places with a score above 0, ``before`` and ``after`` have the
    sums of all scores up to each of them, without and with it. The segments are disjoint
    and every positive place is in one; no segment can be made longer or shorter for more.
    Places that are not positive only enter through the sums.
    """
    # Per candidate: sum before it, sum at its end, first and last place, and the nearest
    # candidate to the left with a smaller sum before it (-1: none).
    found: list[tuple[float, float, int, int, int]] = []
    for place, left, right in zip(positive, before.tolist(), after.tolist(), strict=True):
        first, at = place, len(found) - 1
        while True:
            while at >= 0 and found[at][0] >= left:
                at = found[at][4]
            if at < 0 or found[at][1] >= right:
                found.append((left, right, first, place + 1, at))
                break
            left, _, first, _, below = found[at]
            del found[at:]
            at = below
    return [(first, end, right - left) for left, right, first, end, _ in found]
