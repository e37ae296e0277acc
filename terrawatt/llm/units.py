"""Work on runs of rows inside tasks, for data that is dealt and sorted by the run's key."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa


def each_unit(
    keys: list[str], work: Callable[[pa.Table], pa.RecordBatch], fold: Callable[[pa.Table], pa.RecordBatch] | None = None, held_bytes: int = 64 << 20
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for `mapInArrow` that calls `work` once for each run of equal `keys`.

    Only the rows of the current run are held; whoever deals the rows bounds the size of a run, or
    gives `fold`, which replaces the rows held by fewer whenever they exceed `held_bytes`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        current, limit = None, held_bytes
        for batch in batches:
            if not len(batch):
                continue
            at = [np.asarray(batch.column(c)) for c in keys]
            cuts = np.flatnonzero(np.any([x[1:] != x[:-1] for x in at], axis=0)) + 1
            bounds = [0, *cuts.tolist(), len(batch)]
            for a, b in zip(bounds, bounds[1:], strict=False):
                unit = tuple(int(x[a]) for x in at)
                if held and unit != current:
                    yield work(pa.Table.from_batches(held))
                    held.clear()
                    limit = held_bytes
                current = unit
                held.append(batch.slice(a, b - a))
                if fold and sum(x.nbytes for x in held) > limit:
                    held = [fold(pa.Table.from_batches(held))]
                    limit = max(held_bytes, 2 * held[0].nbytes)
        if held:
            yield work(pa.Table.from_batches(held))

    return run
