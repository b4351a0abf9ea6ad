"""Karmarkar-Karp multiway differencing (largest differencing method for k parts)."""

from __future__ import annotations

import heapq

import numpy as np


def difference(sizes: list[int], parts: int) -> list[list[int]]:
    """Split item indices into ``parts`` bins of near-equal total size.

    A partial partition is a vector of ``parts`` bin sums, largest first and shifted so that the
    least is 0. The two partial partitions with the largest spread are merged again and again, the
    fullest bin of one with the emptiest of the other, so that opposing imbalances cancel. Bins are
    nodes of a forest (leaf: item; inner node: two merged bins), read out at the end.
    """
    if parts == 1:
        return [list(range(len(sizes)))]
    left, right = [-1] * len(sizes), [-1] * len(sizes)
    heap: list[tuple[int, int]] = []
    state: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for item, size in enumerate(sizes):
        sums, nodes = np.zeros(parts, np.int64), np.full(parts, -1, np.int64)
        sums[0], nodes[0] = size, item
        state[item] = (sums, nodes)
        heap.append((-size, item))
    heapq.heapify(heap)
    following = len(sizes)
    while len(heap) > 1:
        a_sums, a_nodes = state.pop(heapq.heappop(heap)[1])
        b_sums, b_nodes = state.pop(heapq.heappop(heap)[1])
        b_sums, b_nodes = b_sums[::-1], b_nodes[::-1]
        sums = a_sums + b_sums
        nodes = np.where(a_nodes < 0, b_nodes, a_nodes)
        for i in np.flatnonzero((a_nodes >= 0) & (b_nodes >= 0)):
            nodes[i] = len(left)
            left.append(int(a_nodes[i]))
            right.append(int(b_nodes[i]))
        order = np.argsort(-sums, kind="stable")
        sums, nodes = sums[order], nodes[order]
        sums -= sums[-1]
        state[following] = (sums, nodes)
        heapq.heappush(heap, (-int(sums[0]), following))
        following += 1
    bins = []
    for root in state[heap[0][1]][1]:
        items, stack = [], [int(root)] if root >= 0 else []
        while stack:
            node = stack.pop()
            if left[node] < 0:
                items.append(node)
            else:
                stack += [right[node], left[node]]
        bins.append(items)
    return bins


def near_equal_windows(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins from :func:`difference`, none above ``capacity``; the bin count rises until that holds.

    Every size must be in 1..capacity. The count starts at the least possible, and each retry adds
    as many bins as the overflow calls for (at least one), so the loop ends: with one bin an item
    every bin holds one item.
    """
    if not sizes:
        return []
    parts = -(-sum(sizes) // capacity)
    while True:
        parts = min(parts, len(sizes))
        bins = [b for b in difference(sizes, parts) if b]
        over = sum(max(0, sum(sizes[i] for i in b) - capacity) for b in bins)
        if not over:
            return bins
        parts += 1 + over // (4 * capacity)
