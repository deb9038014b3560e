"""Double-array tries over numbered symbols, and walks that advance many places at once."""

from __future__ import annotations

import numpy as np


def trie(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The trie of ``rows`` (one sequence of symbols 0, 1, ... each, padded with -1 on the right).

    Returns ``base``, ``check`` and each row's final state. State 0 is the root. The child of state s by
    symbol c is ``t = base[s] + c`` if ``check[t] == s``; t is always inside the arrays. Equal rows share a
    state. Rows must not be empty sequences.
    """
    n_symbols = int(rows.max(initial=-1)) + 1
    node = np.zeros(len(rows), np.int64)  # each row's node at the present depth; 0 is the root
    parents, symbols = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    n_nodes = 1
    for depth in range(rows.shape[1]):
        alive = np.flatnonzero(rows[:, depth] >= 0)
        if not len(alive):
            break
        edges, inverse = np.unique(node[alive] * n_symbols + rows[alive, depth], return_inverse=True)
        parents.append(edges // n_symbols)
        symbols.append(edges % n_symbols)
        node[alive] = n_nodes + inverse
        n_nodes += len(edges)
    parent, symbol = np.concatenate(parents), np.concatenate(symbols)  # of nodes 1, 2, ...
    slot, offset = _placed(parent, symbol, n_nodes, n_symbols)
    size = int(max(slot.max(), offset.max())) + n_symbols + 1
    base, check = np.zeros(size, np.int32), np.full(size, -1, np.int32)
    base[slot] = offset
    check[slot[1:]] = slot[parent]
    return base, check, slot[node].astype(np.int32)


def _placed(parent, symbol, n_nodes: int, n_symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """A slot per node, and a base per node with children: the children with most siblings first.

    Slots below ``n_symbols`` stay free (but for the root), so that no base is negative. A node with one child
    takes any free slot, so these are placed all at once.
    """
    slot, offset = np.zeros(n_nodes, np.int64), np.zeros(n_nodes, np.int64)
    first = np.flatnonzero(np.diff(parent, prepend=-1))  # children of a node stand together
    count = np.diff(np.append(first, len(parent)))
    low = max(n_symbols, 1)
    used = np.zeros(low + 2 * len(parent) + n_symbols + 1024, bool)
    start = low
    for k in np.argsort(-count, kind="stable"):
        if count[k] == 1:
            break
        cs = symbol[first[k] : first[k] + count[k]]
        rel, at, width = cs - cs[0], start, 64
        while True:
            if at + width + rel[-1] >= len(used):
                used = np.append(used, np.zeros(len(used) + width + int(rel[-1]), bool))
            free = at + np.flatnonzero(~used[at : at + width])
            fits = free[~used[free[:, None] + rel].any(1)] if len(free) else free
            if len(fits):
                break
            at, width = at + width, min(width * 2, 4096)
        spots = fits[0] + rel
        used[spots] = True
        slot[1 + first[k] : 1 + first[k] + count[k]] = spots
        offset[parent[first[k]]] = fits[0] - cs[0]
        if used[start : start + 64].all():  # full here: the next search need not look again
            start += 64
        elif at - start > 1 << 14:
            start = at
    single = first[count == 1]
    free = low + np.flatnonzero(~used[low:])
    if len(free) < len(single):
        free = np.append(free, len(used) + np.arange(len(single) - len(free)))
    slot[1 + single] = free[: len(single)]
    offset[parent[single]] = free[: len(single)] - symbol[single]
    return slot, offset


def step(base: np.ndarray, check: np.ndarray, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """The next state of every place, -1 where there is none. ``symbols`` are of the trie's range."""
    to = base.take(states) + symbols
    return np.where(check.take(to) == states, to, -1)
