"""Minimal perfect hashes over byte strings, with stored keys.

Keys fall through levels of bit arrays (BBHash): a key that is alone at its
position in a level takes it, the others go on to the next level. The number
of taken positions before a key's own is its slot, so n keys have the slots 0
to n - 1 and cost a few bits each. Keys that no level parts (equal 64-bit
hashes) get the last slots and are found by their bytes.

Any other string falls on some slot too; the keys are stored in slot order,
and a look-up compares them byte by byte. All work is on whole arrays.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from lodestone.llm.blocks import mix64

ROOM, LEVELS = 1.5, 24  # positions for each key of a level; levels at most


def hashes(keys: pa.Array) -> np.ndarray:
    """64-bit hashes of byte strings, as signed numbers (a column type)."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys.to_pylist()), np.uint64, len(keys)).view(np.int64)


class PerfectHash(NamedTuple):
    sizes: np.ndarray  # positions of each level
    bits: np.ndarray   # taken or not, all levels in a row
    keys: pa.Array     # in slot order
    rest: int          # how many keys at the end no level parted


def _positions(h: np.ndarray, level: int, size: int) -> np.ndarray:
    salt = np.uint64(0x9E3779B97F4A7C15 * (level + 1) % (1 << 64))
    return (mix64(h + salt) % np.uint64(size)).astype(np.int64)


def build(keys: pa.Array, h: np.ndarray) -> PerfectHash:
    """The hash of distinct ``keys`` with the ``hashes`` h."""
    h, left = h.view(np.uint64), np.arange(len(keys))
    sizes, bits, order = [], [], []
    while len(left) and len(sizes) < LEVELS:
        size = max(1, int(ROOM * len(left)))
        at = _positions(h[left], len(sizes), size)
        taken = np.bincount(at, minlength=size) == 1
        alone = taken[at]
        order.append(left[alone][np.argsort(at[alone])])
        sizes.append(size)
        bits.append(taken)
        left = left[~alone]
    slots = np.concatenate([*order, left]).astype(np.int64)
    return PerfectHash(np.array(sizes, np.int64), np.concatenate(bits) if bits else np.zeros(0, bool), keys.take(pa.array(slots)), len(left))


class Lookup:
    """A perfect hash made ready for questions."""

    def __init__(self, of: PerfectHash):
        self.of = of
        self.before = np.cumsum(of.bits, dtype=np.int32) - of.bits
        n = len(of.keys)
        self.rest = {k: n - of.rest + i for i, k in enumerate(of.keys[n - of.rest:].to_pylist())}

    def slots(self, asked: pa.Array, h: np.ndarray) -> np.ndarray:
        """The slot of each asked string; -1 if it is not a key."""
        h, out, left, base = h.view(np.uint64), np.full(len(asked), -1, np.int64), np.arange(len(asked)), 0
        for level, size in enumerate(self.of.sizes.tolist()):
            at = base + _positions(h[left], level, size)
            hit = self.of.bits[at]
            out[left[hit]] = self.before[at[hit]]
            left, base = left[~hit], base + size
        hit = np.flatnonzero(out >= 0)
        same = pc.equal(self.of.keys.take(pa.array(out[hit])), asked.take(pa.array(hit)))
        out[hit[~np.asarray(same, bool)]] = -1
        if self.rest and len(left):
            out[left] = [self.rest.get(k, -1) for k in asked.take(pa.array(left)).to_pylist()]
        return out
