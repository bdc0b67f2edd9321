"""SuperMinHash signatures (Ertl 2017) of many sets at once.

Each element owns a random permutation of the ``m`` signature positions and one uniform number per step; at step ``j``
it offers the value ``j + r_j`` to position ``p_j``, and a position keeps the least value offered. The published
algorithm goes through one element after another and stops within an element once ``j`` exceeds the largest value in
the signature. Here all elements take step ``j`` together: after it every filled position holds a value below
``j + 1``, so a set whose positions are all filled is finished. This gives the same signature.
"""

from __future__ import annotations

import numpy as np

from .text_arrays import GOLDEN, U, mix

EMPTY = np.iinfo(np.uint64).max
ELEMENTS = 1 << 16


def _draw(elements: np.ndarray, j: int, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Step ``j``: the value offered (``j`` above 32 random bits) and the place in the permutation to swap with."""
    x = mix(elements + U((int(GOLDEN) * (j + 1)) & 0xFFFFFFFFFFFFFFFF))
    return (U(j) << U(32)) | (x & U(0xFFFFFFFF)), j + (((x >> U(32)) * U(m - j)) >> U(32)).astype(np.int64)


def _finish(sig: np.ndarray, todo: np.ndarray, sets: list[np.ndarray], m: int) -> None:
    """Steps 1, 2, ... of the sets ``todo``, whose step 0 is done."""
    owner = np.repeat(todo, [len(sets[i]) for i in todo])
    elements = np.concatenate([sets[i] for i in todo])
    perm = np.tile(np.arange(m, dtype=np.uint8 if m <= 256 else np.uint16), (len(elements), 1))
    _, k = _draw(elements, 0, m)
    for j in range(1, m):
        at = np.arange(len(elements))
        perm[at, k], perm[at, j - 1] = perm[at, j - 1], perm[at, k]
        open_ = (sig[owner] == EMPTY).any(axis=1) if len(owner) < 4096 else np.isin(owner, np.flatnonzero((sig == EMPTY).any(axis=1)))
        if not open_.all():
            owner, elements, perm = owner[open_], elements[open_], perm[open_]
            if not len(owner):
                return
        value, k = _draw(elements, j, m)
        np.minimum.at(sig, (owner, perm[np.arange(len(elements)), k]), value)


def signatures(sets: list[np.ndarray], m: int) -> np.ndarray:
    """A row of ``m`` 64-bit values for each set of 64-bit hashes; an empty set has ``EMPTY`` everywhere."""
    sig = np.full((len(sets), m), EMPTY, np.uint64)
    size = np.array([len(s) for s in sets], np.int64)
    if not size.sum():
        return sig
    elements = np.concatenate(sets)
    value, k = _draw(elements, 0, m)
    np.minimum.at(sig, (np.repeat(np.arange(len(sets)), size), k), value)
    todo = np.flatnonzero((sig == EMPTY).any(axis=1) & (size > 0))
    group = np.cumsum(size[todo]) // ELEMENTS
    for g in np.unique(group):
        _finish(sig, todo[group == g], sets, m)
    return sig


def bands(sig: np.ndarray, rows: int) -> np.ndarray:
    """A hash of each run of ``rows`` positions, with the band's number in it."""
    n, m = sig.shape
    count = m // rows
    acc = np.broadcast_to(np.arange(1, count + 1, dtype=np.uint64) * GOLDEN, (n, count)).copy()
    for r in range(rows):
        acc = mix(acc ^ sig[:, r:count * rows:rows]) + GOLDEN
    return acc


def sketch(sig: np.ndarray) -> np.ndarray:
    """One byte per position: two sets agree in a position with chance J + (1 - J) / 256."""
    return (mix(sig) >> U(56)).astype(np.uint8)
