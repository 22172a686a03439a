"""Deep-shallow ordering of short byte strings: multikey sorting to a shallow depth, blind tries below it."""

from __future__ import annotations

import numpy as np

#: Eight-byte keys that are sorted before strings with a longer common prefix go to a blind trie.
SHALLOW_KEYS = 2


class BlindTrie:
    """A Patricia tree that keeps at each branch only its depth and the bytes that differ there."""

    def __init__(self, strings: list[bytes]):
        self.strings = strings
        self.root: int | list = 0  # a leaf is a string's number, a branch is [depth, {byte: child}]
        for n in range(1, len(strings)):
            self._insert(n)

    def _insert(self, n: int) -> None:
        s, node = self.strings[n], self.root
        while isinstance(node, list):  # blind descent: bytes between branches aren't looked at
            node = node[1].get(s[node[0]], next(iter(node[1].values())))
        other = self.strings[node]
        depth = next((i for i in range(0, len(s), 16) if s[i : i + 16] != other[i : i + 16]), None)
        depth = next(i for i in range(depth, len(s)) if s[i] != other[i])
        above, node = None, self.root
        while isinstance(node, list) and node[0] < depth:
            above, node = node, node[1][s[node[0]]]
        if isinstance(node, list) and node[0] == depth:
            node[1][s[depth]] = n
            return
        branch = [depth, {s[depth]: n, other[depth]: node}]
        if above is None:
            self.root = branch
        else:
            above[1][s[above[0]]] = branch

    def ordered(self) -> list[int]:
        out, stack = [], [self.root]
        while stack:
            node = stack.pop()
            if isinstance(node, list):
                stack += [node[1][b] for b in sorted(node[1], reverse=True)]
            else:
                out.append(node)
        return out


def suffix_order(groups: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order ``rows`` (one string of equal width each) within ``groups``; returns the order and, for each place, the
    common prefix with the string before it (-1 where a group begins)."""
    n, width = rows.shape
    keys = np.zeros((n, -(-width // 8) * 8), np.uint8)
    keys[:, :width] = rows
    words = keys.view(">u8").astype(np.uint64)
    order = np.argsort(groups, kind="stable")
    bucket = _numbered(groups[order])
    for d in range(min(SHALLOW_KEYS, words.shape[1])):
        tied = _tied(bucket)
        if not len(tied):
            break
        sub = np.lexsort((words[order[tied], d], bucket[tied]))
        order[tied] = order[tied][sub]
        new = np.ones(n, bool)
        new[1:] = bucket[1:] != bucket[:-1]
        key = words[order, d]
        new[1:] |= key[1:] != key[:-1]
        bucket = np.cumsum(new)
    tied = _tied(bucket)
    if len(tied):
        starts = np.nonzero(np.diff(bucket[tied], prepend=-1))[0]
        for places in np.split(tied, starts[1:]):
            twins: dict[bytes, list[int]] = {}
            for r in order[places]:
                twins.setdefault(keys[r].tobytes(), []).append(r)
            if len(twins) > 1:
                strings = list(twins)
                order[places] = [r for k in BlindTrie(strings).ordered() for r in twins[strings[k]]]
    common = np.full(n, -1)
    if n > 1:
        differ = rows[order[1:]] != rows[order[:-1]]
        lcp = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        common[1:] = np.where(groups[order[1:]] == groups[order[:-1]], lcp, -1)
    return order, common


def _numbered(x: np.ndarray) -> np.ndarray:
    new = np.ones(len(x), bool)
    new[1:] = x[1:] != x[:-1]
    return np.cumsum(new)


def _tied(bucket: np.ndarray) -> np.ndarray:
    """Places in buckets of more than one."""
    same = bucket[1:] == bucket[:-1]
    return np.nonzero(np.append(same, False) | np.insert(same, 0, False))[0]
