"""Sums over the subtrees of a forest by centroid decomposition, in numpy and in Spark rounds.

Every node has a mass, and the mass of a subtree is known beforehand: here it is the
number of rows at or below a node, which one grouping gives.  A component is a
connected part with one top.  Its centroid is the deepest node with at least half of
the component's mass below it.  Without it the component falls into the part above
and one part per child, each with at most half of the mass, so depth and shape of the
forest don't matter: there are at most log2(mass) rounds.  In every round

* the total T of the values at and below the centroid is added up,
* T goes to the centroid and to every node on the path from it to the top,
* those on the path lose the centroid's mass.

What a node has been given at the end is the sum over its subtree: any two nodes are
parted once, by a centroid between them, and T holds the lower one's value.
"""

from __future__ import annotations

import numpy as np


def subtree_sums(parent: np.ndarray, depth: np.ndarray, mass: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of the rows of ``values`` over each node's subtree; ``parent`` is -1 for tops.

    All components are split at once, so a chunk of many small ones costs as many
    rounds as its largest.
    """
    n = len(parent)
    mass, sums, alive = mass.astype(np.int64).copy(), np.zeros_like(values), np.ones(n, bool)
    up = np.where(parent < 0, np.arange(n), parent)

    def tops(cut: np.ndarray) -> np.ndarray:
        """The highest node that each node reaches without passing a cut one."""
        to = np.where((parent < 0) | cut | cut[up], np.arange(n), up)
        while True:
            further = to[to]
            if (further == to).all():
                return to
            to = further

    dead = np.zeros(n, bool)
    component = tops(dead)
    while alive.any():
        at = np.flatnonzero(alive)
        at = at[2 * mass[at] >= mass[component[at]]]
        at = at[np.lexsort((-depth[at], mass[at], component[at]))]
        centre = at[np.r_[True, component[at][1:] != component[at][:-1]]]
        dead[centre], alive[centre] = True, False
        tops_now, old_top = tops(dead), component[centre]
        of_component = np.full(n, -1)
        of_component[old_top] = np.arange(len(centre))
        below = alive & (parent[tops_now] >= 0) & dead[up[tops_now]]
        k = of_component[component]
        below &= (k >= 0) & (up[tops_now] == centre[k])  # tops under centroids of earlier rounds are tops still
        total = values[centre].copy()
        np.add.at(total, k[below], values[below])
        sums[centre] += total
        lost, who = mass[centre], np.arange(len(centre))
        who, at = who[centre != old_top], centre[centre != old_top]
        while len(who):
            at = up[at]
            sums[at] += total[who]
            mass[at] -= lost[who]
            more = at != old_top[who]
            who, at = who[more], at[more]
        component = tops_now
    return sums
