"""Spark's ``xxhash64`` of a row of longs, for use inside Python workers, over whole arrays."""

from __future__ import annotations

import numpy as np

_SPARK_SEED = 42
# The primes of XXH64.
P1, P2, P3, P4, P5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _turn(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _finish(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * P2
    h = (h ^ (h >> np.uint64(29))) * P3
    return h ^ (h >> np.uint64(32))


def hash_longs(columns: list[np.ndarray], last_int: int | None = None) -> np.ndarray:
    """``xxhash64(c1, c2, ..., lit(last_int))`` as Spark computes it: each value's hash seeds the next one's."""
    with np.errstate(over="ignore"):
        h = np.full(len(columns[0]), _SPARK_SEED, np.uint64)
        for c in columns:
            h = (h + P5 + np.uint64(8)) ^ (_turn(c.astype(np.int64).view(np.uint64) * P2, 31) * P1)
            h = _finish(_turn(h, 27) * P1 + P4)
        if last_int is not None:
            h = (h + P5 + np.uint64(4)) ^ (np.uint64(last_int & 0xFFFFFFFF) * P1)
            h = _finish(_turn(h, 23) * P2 + P3)
        return h.view(np.int64)
