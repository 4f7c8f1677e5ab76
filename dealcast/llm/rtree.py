"""R-tree over count vectors inside one task: pairs of points that may overlap enough.

A point is a set's number of elements in each of some groups. Two sets share at most the sum of
the groups' smaller counts, and two nodes' sets at most the sum of the smaller of the nodes' greatest
counts; a pair of nodes whose bound falls short of what their smallest sets need is left whole.
"""

from __future__ import annotations

#: Points of a leaf.
LEAF = 32


def enough(shared, total, threshold: int):
    """Whether sets of ``total`` elements together may reach the Jaccard threshold (percent) if ``shared`` are common."""
    return (100 + threshold) * shared >= threshold * total


class Node:
    """Points with their greatest counts, smallest and greatest sizes, and group if all have the same one."""

    __slots__ = ("at", "top", "least", "most", "root", "parts")

    def __init__(self, at, counts, sizes, roots):
        self.at, self.top = at, counts[at].max(axis=0)
        self.least, self.most = int(sizes[at].min()), int(sizes[at].max())
        first = roots[at[0]]
        self.root = first if (roots[at] == first).all() else None
        self.parts = []


def grown(at, counts, sizes, roots) -> Node:
    """Bulk-loaded tree: halved on the widest group until a leaf holds the points."""
    import numpy as np
    top = Node(at, counts, sizes, roots)
    open_ = [top]
    while open_:
        node = open_.pop()
        if len(node.at) > LEAF:
            mine = counts[node.at]
            widest = int((mine.max(axis=0) - mine.min(axis=0)).argmax())
            order = node.at[np.argsort(mine[:, widest], kind="stable")]
            half = len(order) // 2
            node.parts = [Node(part, counts, sizes, roots) for part in (order[:half], order[half:])]
            open_.extend(node.parts)
    return top


def _may(a: Node, b: Node, threshold: int) -> bool:
    import numpy as np
    if a.root is not None and a.root == b.root:
        return False
    if 100 * a.most < threshold * b.least or 100 * b.most < threshold * a.least:
        return False
    return bool(enough(int(np.minimum(a.top, b.top).sum()), a.least + b.least, threshold))


def pairs(a: Node, b: Node, counts, sizes, roots, threshold: int):
    """Indices (x, y) of points of a and b of different groups that pass the bound; a may be b."""
    import numpy as np
    xs, ys, open_ = [], [], [(a, b)]
    while open_:
        a, b = open_.pop()
        if not _may(a, b, threshold):
            continue
        if not a.parts and not b.parts:
            p, q = a.at, b.at
            shared = np.minimum(counts[p][:, None, :], counts[q][None, :, :]).sum(axis=2)
            n, m = sizes[p][:, None], sizes[q][None, :]
            on = enough(shared, n + m, threshold) & (roots[p][:, None] != roots[q][None, :]) & (100 * np.minimum(n, m) >= threshold * np.maximum(n, m))
            if a is b:
                on &= np.tri(len(p), k=-1, dtype=bool)
            i, j = np.nonzero(on)
            xs.append(p[i])
            ys.append(q[j])
        elif a is b:
            open_.extend([(a.parts[0], a.parts[0]), (a.parts[1], a.parts[1]), (a.parts[0], a.parts[1])])
        elif not b.parts or (a.parts and len(a.at) >= len(b.at)):
            open_.extend((part, b) for part in a.parts)
        else:
            open_.extend((a, part) for part in b.parts)
    none = np.empty(0, np.int64)
    return np.concatenate([none, *xs]), np.concatenate([none, *ys])
