"""Rank sums of many scored copies of a table: scores leave each task as sorted counts.

A copy's rows are cut into ranges of scores; a task sends, per copy and range, its
distinct scores with how many rows and positives have them; one task a range merges
these. What travels is a few bytes a scored row, and no copy is sorted as a whole.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

from pyspark import cloudpickle

# executors need not have this package: its functions travel with the tasks
cloudpickle.register_pickle_by_value(sys.modules[__name__])

COUNTED = "feature int, repeat int, range int, scores array<double>, n array<bigint>, pos array<bigint>"
MERGED = "feature int, repeat int, range int, n bigint, pos bigint, twice_wins bigint"
#: Rows a task holds before it counts them.
ROWS_PER_BLOCK = 100_000
#: The copy nothing was shuffled in.
UNTOUCHED = -1


def logistic(parts):
    """Probability from what each feature adds, summed in one order for all copies."""
    import numpy as np

    margin = parts[:, 0].copy()
    for i in range(1, parts.shape[1]):
        margin += parts[:, i]
    with np.errstate(over="ignore"):
        return 1.0 - 1.0 / (1.0 + np.exp(margin))


def _counts(feature: int, repeat: int, score, y, cuts) -> Iterator[tuple]:
    import numpy as np

    values, at = np.unique(score, return_inverse=True)
    n, pos = np.bincount(at, minlength=len(values)), np.bincount(at, weights=y, minlength=len(values)).astype(np.int64)
    edges = [0, *np.searchsorted(values, cuts).tolist(), len(values)]
    for i, (a, b) in enumerate(zip(edges, edges[1:])):
        if b > a:
            yield feature, repeat, i, values[a:b], n[a:b], pos[a:b]


def _batch(rows: list[tuple]):
    import numpy as np
    import pyarrow as pa

    plain = [pa.array([r[i] for r in rows], pa.int32()) for i in range(3)]
    starts = pa.array(np.cumsum([0, *(len(r[3]) for r in rows)]), pa.int32())
    lists = [pa.ListArray.from_arrays(starts, pa.array(np.concatenate([r[i] for r in rows]) if rows else [], kind))
             for i, kind in ((3, pa.float64()), (4, pa.int64()), (5, pa.int64()))]
    return pa.RecordBatch.from_arrays([*plain, *lists], names=[c.split()[0] for c in COUNTED.split(", ")])


def _blocks(batches: Iterator) -> Iterator:
    import pyarrow as pa

    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= ROWS_PER_BLOCK:
            yield pa.Table.from_batches(held).combine_chunks()
            held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held).combine_chunks()


def count_pairs(cuts: list[float]) -> Callable[[Iterator], Iterator]:
    """(repeat, y, own, other) → counts: own parts with one feature's taken from ``other``."""
    def run(batches: Iterator) -> Iterator:
        import numpy as np

        for block in _blocks(batches):
            repeat, y = block["repeat"].to_numpy(), block["y"].to_numpy()
            matrix = lambda name: block[name].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(block.num_rows, -1)
            own, other = matrix("own"), matrix("other")
            for r in np.unique(repeat).tolist():
                mine = repeat == r
                mixed, theirs, label, rows = own[mine], other[mine], y[mine], []
                if r == UNTOUCHED:
                    yield _batch(list(_counts(UNTOUCHED, r, logistic(mixed), label, cuts)))
                    continue
                for f in range(1, mixed.shape[1]):
                    kept = mixed[:, f].copy()
                    mixed[:, f] = theirs[:, f]
                    rows += _counts(f - 1, r, logistic(mixed), label, cuts)
                    mixed[:, f] = kept
                yield _batch(rows)

    return run


def count_scored(cuts: list[float]) -> Callable[[Iterator], Iterator]:
    """(feature, repeat, score, y) → counts."""
    def run(batches: Iterator) -> Iterator:
        import numpy as np

        for block in _blocks(batches):
            feature, repeat, score, y = (block[c].to_numpy() for c in ("feature", "repeat", "score", "y"))
            rows = []
            for f, r in sorted(set(zip(feature.tolist(), repeat.tolist()))):
                mine = (feature == f) & (repeat == r)
                rows += _counts(f, r, score[mine], y[mine], cuts)
            yield _batch(rows)

    return run


def merge_range(table):
    """All counts of one copy's range → its rows, positives, and twice the pairs won inside it."""
    import numpy as np
    import pyarrow as pa

    flat = lambda name: table[name].combine_chunks().flatten().to_numpy()
    values, at = np.unique(flat("scores"), return_inverse=True)
    total = lambda name: np.bincount(at, weights=flat(name), minlength=len(values)).astype(np.int64)
    n, pos = total("n"), total("pos")
    neg = n - pos
    wins = int((pos * (2 * (np.cumsum(neg) - neg) + neg)).sum())
    keys = {c: [table[c][0].as_py()] for c in ("feature", "repeat", "range")}
    kinds = [pa.int32()] * 3 + [pa.int64()] * 3
    row = {**keys, "n": [int(n.sum())], "pos": [int(pos.sum())], "twice_wins": [wins]}
    return pa.table({name: pa.array(v, kind) for (name, v), kind in zip(row.items(), kinds)})
