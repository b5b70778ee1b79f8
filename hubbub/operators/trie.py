"""Many words at once: a trie in sorted arrays, walked from all places of a text together.

A node is a number; an edge is its parent's number and a character in one 64-bit key. All edges lie in one sorted array, in
which the place of an edge names the node it leads to, so a node takes eight bytes and four for the word that ends there. A
walk takes one step at all places that are still inside some word, so the cost is that of the matching characters.
"""

import numpy as np

_CHARACTER_BITS = 21


def code_points(text):
    """The characters of a text as numbers."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)


class Trie:
    """Distinct, non-empty words, numbered in the order given."""

    def __init__(self, words):
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        codes, first = code_points("".join(words)), np.cumsum(sizes) - sizes
        edges, ends, node, count = [], [], np.zeros(len(words), np.int64), 0
        alive, depth = np.arange(len(words)), 0
        while len(alive):
            keys, to = np.unique(node[alive] << _CHARACTER_BITS | codes[first[alive] + depth], return_inverse=True)
            node[alive] = count + 1 + to
            edges.append(keys)
            count += len(keys)
            depth += 1
            done = sizes[alive] == depth
            ends.append(alive[done])
            alive = alive[~done]
        self.edges = np.concatenate([*edges, np.zeros(0, np.int64)])
        self.word = np.full(count + 1, -1, np.int32)
        for own in ends:
            self.word[node[own]] = own

    def __len__(self):
        return int((self.word >= 0).sum())

    @property
    def nbytes(self):
        return self.edges.nbytes + self.word.nbytes

    def matches(self, codes, stop, starts=None):
        """(start, end, word number) of every word in ``codes`` that begins at one of ``starts`` (all places) and does not
        reach beyond ``stop``, a place for each place. Sorted by start, then end."""
        at = np.arange(len(codes)) if starts is None else starts
        node, depth, found = np.zeros(len(at), np.int64), 0, []
        while len(at) and len(self.edges):
            inside = at + depth < stop[at]
            at, node = at[inside], node[inside]
            keys = node << _CHARACTER_BITS | codes[at + depth]
            edge = np.minimum(np.searchsorted(self.edges, keys), len(self.edges) - 1)
            on = self.edges[edge] == keys
            at, node, depth = at[on], edge[on] + 1, depth + 1
            word = self.word[node]
            hit = word >= 0
            if hit.any():
                found.append((at[hit], at[hit] + depth, word[hit]))
        if not found:
            return tuple(np.zeros(0, np.int64) for _ in range(3))
        start, end, word = (np.concatenate(c) for c in zip(*found))
        order = np.lexsort((end, start))
        return start[order], end[order], word[order]
