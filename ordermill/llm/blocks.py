"""Arrow batches of rows sorted by key, given out again as one array per key."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def key_runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables that hold whole keys: consecutive batches, cut where the key changes.

    Rows must come sorted by the whole-number column `key`.  A table holds many small keys at once;
    only a key that spans batches is held until it ends.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        changes = np.flatnonzero(keys[1:] != keys[:-1])
        if held and held[-1].column(key)[-1].as_py() != keys[0]:
            yield pa.Table.from_batches(held)
            held = []
        if len(changes) == 0:
            held.append(batch)
            continue
        cut = int(changes[-1]) + 1
        yield pa.Table.from_batches([*held, batch.slice(0, cut)])
        held = [batch.slice(cut)]
    if held:
        yield pa.Table.from_batches(held)


def bounds(keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys starts, and the end of the last."""
    return np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]))


def star_edges(n: int, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Components of the links left[i]-right[i] among n points: (members, the lowest of theirs)."""
    low = np.arange(n)
    while len(left):
        least = np.minimum(low[left], low[right])
        before = low.copy()
        np.minimum.at(low, left, least)
        np.minimum.at(low, right, least)
        low = low[low]
        if np.array_equal(before, low):
            break
    members = np.flatnonzero(low != np.arange(n))
    return members, low[members]
