"""A union-find over the rows of one task, fed with arrays of links."""

from __future__ import annotations

import numpy as np


class Forest:
    """Rows 0 to n-1; the root of a tree is its least row."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        parent = self.parent
        while len(a):
            ra, rb = parent[a], parent[b]
            apart = ra != rb
            if not apart.any():
                return
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:
                above = parent[parent]
                if np.array_equal(above, parent):
                    break
                parent[:] = above

    def members(self) -> tuple[np.ndarray, np.ndarray]:
        """Rows that are not roots, and their roots."""
        below = np.flatnonzero(self.parent != np.arange(len(self.parent)))
        return below, self.parent[below]
