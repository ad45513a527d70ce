"""Signature trees: OR-combined bitmaps and size ranges over sets, and the dual
traversal that finds the pairs of sets which may still reach a Jaccard bound.

A set's bitmap has one bit per hashed element.  An inner node keeps the OR of its
children's bitmaps, the range of their set sizes, their largest ``slack`` (set
size minus set bits) and the range of their component labels.  No two sets below
nodes A and B can share more than

    min(largest size of A, largest size of B,
        slack(A) + common bits, slack(B) + common bits)

elements, and a Jaccard of t needs t / (1 + t) * (smallest size of A + smallest
size of B), so a node pair that misses this is cut off with all pairs below it,
as is one whose sets all carry the same label."""
from __future__ import annotations

import numpy as np

WORDS = 8                     # 64-bit words in a bitmap (512 bits)
LEAF = 32                     # sets in a leaf
FAN = 4                       # children of an inner node


def bitmap(hashes: np.ndarray, words: int = WORDS) -> np.ndarray:
    bits = np.zeros(words * 64, np.uint8)
    bits[(hashes >> np.uint64(17)) % np.uint64(words * 64)] = 1
    return np.packbits(bits, bitorder="little").view(np.uint64)


def bits_of(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).sum(axis=-1, dtype=np.int64)


class Tree:
    """Levels of nodes over sets ordered by size; level 0 holds the leaves."""

    def __init__(self, bits: np.ndarray, sizes: np.ndarray, labels: np.ndarray):
        self.order = np.lexsort((labels, sizes))
        self.bits, self.sizes, self.labels = bits[self.order], sizes[self.order], labels[self.order]
        self.levels = []
        slack = self.sizes - bits_of(self.bits)
        node = (self.bits, self.sizes, self.sizes, slack, self.labels, self.labels)
        step = LEAF
        while True:
            at = np.arange(0, len(node[1]), step)
            node = tuple(f.reduceat(v, at, axis=0) for f, v in zip(
                (np.bitwise_or, np.minimum, np.maximum, np.maximum, np.minimum, np.maximum), node))
            self.levels.append(node)
            if len(at) == 1:
                return
            step = FAN


def _need(total, num: int, den: int):
    """Smallest overlap with num / den Jaccard, for the sum of the two set sizes."""
    return -(-num * total // (num + den))


def _possible(tree: Tree, level: int, a: np.ndarray, b: np.ndarray, num: int, den: int) -> np.ndarray:
    bits, low, high, slack, first, last = tree.levels[level]
    common = bits_of(bits[a] & bits[b])
    most = np.minimum(np.minimum(high[a], high[b]), np.minimum(slack[a], slack[b]) + common)
    ok = most >= _need(low[a] + low[b], num, den)
    ok &= (high[a] * den >= low[b] * num) & (high[b] * den >= low[a] * num)
    one = (first[a] == last[a]) & (first[b] == last[b]) & (first[a] == first[b])
    return ok & ~one


def leaf_pairs(tree: Tree, num: int, den: int):
    """Dual traversal from the root against itself, level by level: leaf pairs left over."""
    a = b = np.zeros(1, np.int64)
    for level in range(len(tree.levels) - 1, -1, -1):
        ok = _possible(tree, level, a, b, num, den)
        a, b = a[ok], b[ok]
        if level:
            n = len(tree.levels[level - 1][1])
            ka = (a[:, None] * FAN + np.arange(FAN))[:, :, None]
            kb = (b[:, None] * FAN + np.arange(FAN))[:, None, :]
            ka, kb = np.broadcast_arrays(ka, kb)
            ka, kb = ka.ravel(), kb.ravel()
            keep = (ka <= kb) & (kb < n)
            both = np.unique(np.stack([ka[keep], kb[keep]]), axis=1)
            a, b = both[0], both[1]
    return a, b


def may_reach(x, y, nx, ny, num: int, den: int) -> np.ndarray:
    """Leaf test: each bit that only one set has costs it an element of the overlap."""
    most = np.minimum(nx - bits_of(x & ~y), ny - bits_of(y & ~x))
    return most >= _need(nx + ny, num, den)


_PAIRS = {m: np.triu_indices(m, 1) for m in range(2, LEAF + 1)}


def candidate_pairs(bits: np.ndarray, sizes: np.ndarray, labels: np.ndarray, num: int, den: int):
    """Positions (i, j) of all pairs with different labels that may reach num / den."""
    if len(sizes) <= LEAF:                       # a tree of one leaf
        i, j = _PAIRS[len(sizes)]
        ok = (labels[i] != labels[j]) & may_reach(bits[i], bits[j], sizes[i], sizes[j], num, den)
        return i[ok], j[ok]
    tree = Tree(bits, sizes, labels)
    left, right = [], []
    for a, b in zip(*leaf_pairs(tree, num, den)):
        i = np.arange(a * LEAF, min((a + 1) * LEAF, len(sizes)))
        j = np.arange(b * LEAF, min((b + 1) * LEAF, len(sizes)))
        i, j = np.broadcast_arrays(i[:, None], j[None, :])
        i, j = i.ravel(), j.ravel()
        keep = (tree.labels[i] != tree.labels[j]) & (i < j if a == b else True)
        i, j = i[keep], j[keep]
        ok = may_reach(tree.bits[i], tree.bits[j], tree.sizes[i], tree.sizes[j], num, den)
        left.append(tree.order[i[ok]])
        right.append(tree.order[j[ok]])
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


FINE = 8                      # bits an element gets in a fine bitmap


def fine_bitmap(hashes: np.ndarray) -> bytes:
    """A bitmap that grows with its set: the power of two above FINE bits an element."""
    bits = 1 << max(6, int(FINE * len(hashes) - 1).bit_length())
    out = np.zeros(bits, np.uint8)
    out[(hashes >> np.uint64(17)) & np.uint64(bits - 1)] = 1
    return np.packbits(out, bitorder="little").tobytes()


def fine_may_reach(a: bytes, b: bytes, na: int, nb: int, num: int, den: int) -> bool:
    """The leaf test on fine bitmaps; the longer one is folded to the shorter."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    while len(x) > len(y):
        x = x[:len(x) // 2] | x[len(x) // 2:]
    while len(y) > len(x):
        y = y[:len(y) // 2] | y[len(y) // 2:]
    most = min(na - int(np.bitwise_count(x & ~y).sum()), nb - int(np.bitwise_count(y & ~x).sum()))
    return most >= -(-num * (na + nb) // (num + den))
