"""Runs of equal keys in Arrow batches of a sorted partition, so that a task holds one run at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole runs of equal keys, from batches that are sorted by the keys; the last run of a batch waits."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        new = np.zeros(batch.num_rows, bool)
        for k in keys:
            col = np.asarray(batch.column(k))
            new[1:] |= col[1:] != col[:-1]
        starts = np.flatnonzero(new)
        if held and any(held[-1].column(k)[-1] != batch.column(k)[0] for k in keys):
            yield pa.Table.from_batches(held)
            held = []
        if len(starts):
            cut_at = int(starts[-1])
            yield pa.Table.from_batches([*held, batch.slice(0, cut_at)])
            held = [batch.slice(cut_at)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def run_starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Where runs of equal keys begin, and the number of rows at the end."""
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for k in keys:
        col = table.column(k).to_numpy()
        new[1:] |= col[1:] != col[:-1]
    return np.append(np.flatnonzero(new), table.num_rows)
