"""Word shingles, their MinHash bands and odd sketches, for a batch of texts."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

BANDS, ROWS = 40, 6
SKETCH_BITS = 512
#: Bits of the parity bitmap of a whole set.
PARITY_BITS = 1024
#: Bytes of text that are hashed at once (a longer text is hashed alone).
CHUNK = 1 << 20

_MASK = (1 << 64) - 1
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True


def _constants(seed: int, count: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 64, count, np.uint64)


_BYTE = _constants(1, 256)
_BASE = 0x9E3779B97F4A7C15
_FOLLOW = _constants(2, 64) | np.uint64(1)
_PERMUTE = _constants(3, BANDS * ROWS) | np.uint64(1)
_BAND = _constants(4, ROWS) | np.uint64(1)
_SAMPLE = _constants(5, BANDS * ROWS)


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of a 64-bit number over all of them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, as many as were needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            def powers(base):
                full = np.full(2 * n, base, np.uint64)
                full[0] = 1
                return np.cumprod(full)
            self.up, self.down = powers(_BASE), powers(pow(_BASE, -1, 1 << 64))
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def shingle_sets(texts: Sequence[str | None], size: int) -> Iterator[np.ndarray]:
    """The distinct shingle hashes of each text, ascending. A-Z count as a-z; words are
    runs of other than ASCII white space; fewer than ``size`` words are one shingle."""
    held, weight = [], 0
    for text in texts:
        raw = (text or "").encode().lower()
        if held and weight + len(raw) > CHUNK:
            yield from _sets(held, size)
            held, weight = [], 0
        held.append(raw)
        weight += len(raw) + 1
    if held:
        yield from _sets(held, size)


def _sets(raws: list[bytes], size: int) -> Iterator[np.ndarray]:
    buffer = np.frombuffer(b" ".join(raws) + b" ", np.uint8)
    white = _WHITE[buffer]
    edge = np.flatnonzero(np.diff(white, prepend=True, append=True))
    starts, ends = edge[::2], edge[1::2]
    up, down = _POWERS.upto(len(buffer))
    sums = np.zeros(len(buffer) + 1, np.uint64)
    np.cumsum(_BYTE[buffer] * up, out=sums[1:])
    words = mixed((sums[ends] - sums[starts]) * down[starts] if len(starts) else np.zeros(0, np.uint64))
    limits = np.cumsum([len(r) + 1 for r in raws])
    bounds = np.concatenate([[0], np.searchsorted(starts, limits)])
    runs = np.zeros(max(0, len(words) - size + 1), np.uint64)
    for j in range(size):
        runs += words[j:j + len(runs)] * _FOLLOW[j]
    runs = mixed(runs)
    for first, last in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        count = last - first
        if count >= size:
            yield np.unique(runs[first:last - size + 1])
        elif count:
            short = (words[first:last] * _FOLLOW[size + 1:size + 1 + count]).sum(dtype=np.uint64)
            yield mixed(np.array([short + np.uint64(count)], np.uint64))
        else:
            yield np.zeros(0, np.uint64)


def set_key(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits that do not depend on order: equal sets, equal keys."""
    low = hashes.sum(dtype=np.uint64)
    high = mixed(hashes ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return int(low.astype(np.int64)), int(high.astype(np.int64))


def min_hashes(hashes: np.ndarray) -> np.ndarray:
    best = np.full(len(_PERMUTE), _MASK, np.uint64)
    for at in range(0, len(hashes), 512):
        np.minimum(best, (hashes[at:at + 512, None] * _PERMUTE).min(axis=0), out=best)
    return best


def band_keys(samples: np.ndarray) -> np.ndarray:
    return mixed((samples.reshape(BANDS, ROWS) * _BAND).sum(axis=1, dtype=np.uint64)).view(np.int64)


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Every sample toggles one bit: a bit tells whether an odd number of samples fell
    on it, so equal samples cancel in the XOR of two sketches."""
    return _parities(mixed(samples + _SAMPLE), SKETCH_BITS)


def set_parity(hashes: np.ndarray) -> np.ndarray:
    """The same over all shingles: two sets differ in at least as many shingles as their
    bitmaps differ in bits."""
    return _parities(hashes, PARITY_BITS)


def _parities(values: np.ndarray, bits: int) -> np.ndarray:
    at = (values & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8)).view(np.int64)


def most_odd_bits(similarity: float) -> int:
    """Expected population count of the XOR of two sketches at this similarity."""
    different = 2 * BANDS * ROWS * (1 - similarity)
    return int(SKETCH_BITS / 2 * (1 - (1 - 2 / SKETCH_BITS) ** different))


def signatures(size: int):
    """Arrow batches (doc_id, text, more) → ids, set sizes, keys, bands, sketches, and
    the columns after the text as they are."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                sizes, low, high, bands, sketches, parities = [], [], [], [], [], []
                for s in shingle_sets(part.column(1).to_pylist(), size):
                    a, b = set_key(s)
                    sizes.append(len(s)), low.append(a), high.append(b)
                    samples = min_hashes(s) if len(s) else None
                    bands.append(band_keys(samples) if len(s) else [])
                    sketches.append(odd_sketch(samples) if len(s) else [])
                    parities.append(set_parity(s) if len(s) else [])
                longs = pa.list_(pa.int64())
                more = dict(zip(part.schema.names[2:], part.columns[2:]))
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column(0), "n_shingles": pa.array(sizes, pa.int64()),
                    "low": pa.array(low, pa.int64()), "high": pa.array(high, pa.int64()),
                    "bands": pa.array(bands, longs), "sketch": pa.array(sketches, longs),
                    "parity": pa.array(parities, longs), **more})
    return run


def full_sets(size: int):
    """Arrow batches (text) → keys and the sets themselves."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                sets = list(shingle_sets(batch.slice(at, 1024).column(0).to_pylist(), size))
                keys = [set_key(s) for s in sets]
                yield pa.RecordBatch.from_pydict({
                    "low": pa.array([k[0] for k in keys], pa.int64()), "high": pa.array([k[1] for k in keys], pa.int64()),
                    "shingles": pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))})
    return run
