"""Thresholds of trees on numbers that are cut into bins."""

from __future__ import annotations

import numpy as np

# Bins of a feature, and rows from which their borders are found; both as in Spark's own trees.
BINS = 32
BORDER_ROWS = 10_000


def split_points(values: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Ascending thresholds that cut `values` into at most `bins` bins of about equal size.

    As Spark's trees do: every midpoint between neighbouring values if these are few, else those nearest to
    equal shares.
    """
    found, counts = np.unique(values, return_counts=True)
    middle = (found[:-1] + found[1:]) / 2
    if len(middle) <= bins - 1:
        return middle
    stride, until = len(values) / bins, np.cumsum(counts)
    target, chosen = stride, []
    for i in range(1, len(found)):
        if abs(until[i - 1] - target) < abs(until[i] - target):
            chosen.append(i - 1)
            target += stride
    return middle[chosen]
