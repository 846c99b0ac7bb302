"""The lookup rules, followed literally and one level at a time, in plain Python."""

from __future__ import annotations


def returned_edges(edges, starts, max_depth, direction):
    """``{edge index: depth}`` for one traversal from a set of starts.

    Each level looks at every edge that touches the current vertices; an edge keeps the level at
    which it was first met, and a vertex is expanded once.
    """
    found, visited, current = {}, set(starts), set(starts)
    for depth in range(max_depth + 1):
        following = set()
        for i, (source, target) in enumerate(edges):
            for near, far in [(source, target)] + [(target, source)] * (direction == "bi"):
                if near is not None and near in current:
                    found.setdefault(i, depth)
                    if far is not None and far not in visited:
                        following.add(far)
        visited |= following
        current = following
    return found


def ends(edges, found):
    return {v for i in found for v in edges[i] if v is not None}
