"""Word shingles of whole batches of texts, in numpy over their bytes.

Words are what white space (space, U+0009 to U+000D) separates, with A-Z lower-cased; both are
bytes of UTF-8 that no other character contains, so batches are read as bytes and no word becomes a
Python object. A word's hash is a polynomial of its bytes: prefix sums of ``TABLE[byte] * BASE**place`` give the sum over
any word, and the inverse power takes its place out again. Words of more than ``LONG`` bytes are
hashed by xxhash, since polynomials modulo 2**64 are weak for long ones.

A shingle's hash mixes its words' hashes; a set holds the distinct ones in order. A text of fewer words than a
shingle has one, of all its words; a text without words has the empty set.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Bytes worked on at once, and the longest word hashed as a polynomial.
SEGMENT, LONG = 1 << 18, 256
#: Rows and bytes of text of one batch; a longer text is a batch of its own.
MOST_ROWS, MOST_BYTES = 2048, 1 << 20
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93


def mixed(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every input bit reaches every output bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(base: int) -> np.ndarray:
    out = np.full(SEGMENT + LONG, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


with np.errstate(over="ignore"):
    _POWER, _INVERSE = _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))
    TABLE = mixed(np.arange(1, 257, dtype=np.uint64) * _MULTIPLIER)
TABLE[ord("A") : ord("Z") + 1] = TABLE[ord("a") : ord("z") + 1]
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True


@dataclass
class Sets:
    """Sorted distinct members (int64) of several sets, one after the other."""

    values: np.ndarray
    ends: np.ndarray

    def __len__(self) -> int:
        return len(self.ends) - 1

    def __getitem__(self, i: int) -> np.ndarray:
        return self.values[self.ends[i] : self.ends[i + 1]]

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.ends)

    def keys(self) -> list[tuple[int, int] | None]:
        """128-bit identity of each set, from all of its members, as two longs; None for the empty set."""
        out: list[tuple[int, int] | None] = []
        for i in range(len(self)):
            own = self[i]
            digest = hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else b""
            out.append((int.from_bytes(digest[:8], signed=True), int.from_bytes(digest[8:], signed=True)) if digest else None)
        return out


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words, place of each text's first word and the number of all) of texts that lie at ``bounds`` in ``data``."""
    if not len(data):
        return np.empty(0, np.uint64), np.zeros(len(bounds), np.int64)
    blank = BLANK[data]
    left, right = np.ones(len(data), bool), np.ones(len(data), bool)
    left[1:], right[:-1] = blank[:-1], blank[1:]
    left[bounds[:-1][bounds[:-1] < len(data)]] = True
    right[bounds[1:][bounds[1:] > 0] - 1] = True
    starts, ends = np.flatnonzero(~blank & left), np.flatnonzero(~blank & right) + 1
    out = np.empty(len(starts), np.uint64)
    at = 0
    with np.errstate(over="ignore"):
        while at < len(starts):
            to = max(at + 1, int(np.searchsorted(ends, starts[at] + SEGMENT, "right")))
            if to > at + 1 or ends[at] - starts[at] <= LONG:
                piece = data[starts[at] : ends[to - 1]]
                sums = np.zeros(len(piece) + 1, np.uint64)
                np.cumsum(TABLE[piece] * _POWER[: len(piece)], out=sums[1:])
                a, b = starts[at:to] - starts[at], ends[at:to] - starts[at]
                out[at:to] = mixed((sums[b] - sums[a]) * _INVERSE[a] + (b - a).astype(np.uint64))
            at = to
        for i in np.flatnonzero(ends - starts > LONG).tolist():
            out[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].tobytes().lower())
    return out, np.searchsorted(starts, bounds)


def combined(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of so many words."""
    n = len(hashes) - size + 1
    out = np.full(max(0, n), size, np.uint64)
    if n > 0:
        with np.errstate(over="ignore"):
            for i in range(size):
                out = out * _MULTIPLIER + hashes[i : n + i]
            out = mixed(out)
    return out


def sets(texts: pa.Array, size: int) -> Sets:
    """The shingle sets of a column of texts (null: empty)."""
    texts = texts.cast(pa.large_string())
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8)[offsets[0] : offsets[-1]] if buffers[2] is not None else np.empty(0, np.uint8)
    hashes, first = words(data, offsets - offsets[0])
    count = np.diff(first)
    n = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    ends = np.concatenate([[0], np.cumsum(n)])
    runs = combined(hashes, size)
    values = np.empty(ends[-1], np.uint64)
    full = np.repeat(count >= size, n)
    place = np.arange(ends[-1]) + np.repeat(first[:-1] - ends[:-1], n)
    values[full] = runs[place[full]]
    for i in np.flatnonzero((count > 0) & (count < size)).tolist():
        values[ends[i]] = combined(hashes[first[i] : first[i + 1]], int(count[i]))[0]
    values = values.view(np.int64)
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        values[a:b].sort()
    keep = np.ones(len(values), bool)
    keep[1:] = values[1:] != values[:-1]
    keep[ends[:-1][ends[:-1] < len(values)]] = True
    return Sets(values[keep], np.concatenate([[0], np.cumsum(keep)])[ends])


def pieces(batches: Iterator[pa.RecordBatch], column: int, rows: int = MOST_ROWS) -> Iterator[pa.RecordBatch]:
    """Slices of at most so many rows and of about ``MOST_BYTES`` of text, so that memory stays bounded."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(size, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            before = total[at - 1] if at else 0
            to = max(at + 1, min(at + rows, int(np.searchsorted(total, before + MOST_BYTES, "right"))))
            yield batch.slice(at, to - at)
            at = to
