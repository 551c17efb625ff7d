"""Packing of tokenised documents into sequences by bounded-space online best-fit.

A document's token ids, closed by an end id, are cut into pieces of at most one
sequence; only longer documents are cut, and the short remainder comes first. Pieces
shorter than a sequence go to the open bin with the least free space that still takes them.
The open bins are a bitset keyed by free space (one Python integer, the lowest set bit above the
need is the best fit); their number is fixed, and when a further one is needed the fullest closes.

Each partition packs on its own as it reads, so there is no shuffle of texts and memory is that
of the open bins. What is still open when a partition ends is packed once more, as blocks, in
larger groups; that moves a few numbers per bin only.

Defined cases: null or empty text: the end id alone; repeated rows are packed each; an empty table
gives an empty result; very long texts give as many full pieces as they need; among bins of equal free space the latest takes a piece; extra columns are ignored.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import common

SEQUENCE, END_ID, OPEN_BINS = 1024, 2, 256
LIBRARY_FILE, RANKS_FILE = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
#: Longer runs without a break go to the library itself, whose merge time doesn't grow with the square of a run.
LONGEST_RUN = 1500

SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, bin long, place long, fill long"
ARROW = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("bin", pa.int64()), ("place", pa.int64()), ("fill", pa.int64())])


class OpenBins:
    """At most ``most`` open bins; ``put`` gives (bin, offset) and closes the fullest when needed."""

    def __init__(self, size: int, most: int, first: int = 0):
        self.size, self.most, self.next = size, most, first
        self.bits, self.count = 0, 0
        self.by_free: dict[int, list[int]] = {}

    def put(self, length: int) -> tuple[int, int]:
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            which = self._take(free)
        else:
            if self.count == self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
            which, free, self.next = self.next, self.size, self.next + 1
        if free > length:
            self._keep(which, free - length)
        return which, self.size - free

    def _take(self, free: int) -> int:
        stack = self.by_free[free]
        which = stack.pop()
        if not stack:
            self.bits &= ~(1 << free)
        self.count -= 1
        return which

    def _keep(self, which: int, free: int) -> None:
        self.by_free.setdefault(free, []).append(which)
        self.bits |= 1 << free
        self.count += 1

    def left(self) -> dict[int, int]:
        """Bins still open, with what they hold."""
        return {b: self.size - free for free, stack in self.by_free.items() for b in stack}


@lru_cache(maxsize=1)
def fast_encoder(ranks_path: str):
    """The same vocabulary as merge ranks; encodes plain texts to the same ids, several times as fast."""
    import public_tokenizers
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


common.caches.append(fast_encoder)


def runs_short(text: str) -> bool:
    """Are runs of both white space and other characters short enough for the fast encoder?"""
    if len(text) <= LONGEST_RUN:
        return True
    words = text.split()
    return len(text) - sum(map(len, words)) - len(words) <= LONGEST_RUN and max(map(len, words), default=0) <= LONGEST_RUN


def encode(text: str, library_path: str, ranks_path: str) -> list[int]:
    """Token ids as the library gives them, without the end id."""
    if "<|endoftext|>" not in text and runs_short(text):
        return fast_encoder(ranks_path).encode_ordinary(text)
    return common.tokenizer(library_path).encode(text, add_special_tokens=False).ids


def pieces_of(n: int, size: int) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of n ids: a remainder first, then full ones."""
    at = n % size or size
    yield 0, min(n, at)
    while at < n:
        yield at, size
        at += size


def cut_and_place(docs: DataFrame, doc_id: str, text: str, size: int, end_id: int, open_bins: int, library_path: str, ranks_path: str) -> DataFrame:
    """Pieces with bin and place; ``fill``: what the piece's bin holds if it was still open at the end, else null."""

    @common.trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = OpenBins(size, open_bins, TaskContext.get().partitionId() << 40)
        held: list[tuple] = []
        for batch in common.rows(batches, 256):
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.array([*encode(value, library_path, ranks_path), end_id], dtype="<u4")
                for number, (start, length) in enumerate(pieces_of(len(ids), size)):
                    held.append((key, number, start, length, zlib.crc32(ids[start : start + length].tobytes()), *bins.put(length)))
            if len(held) >= 20_000:
                is_open = bins.left()
                yield table_of([h for h in held if h[5] not in is_open], {})
                held = [h for h in held if h[5] in is_open]
        yield table_of(held, bins.left())

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), common.utf8(text).alias("text")).mapInArrow(run, SCHEMA)


def table_of(held: list[tuple], fill: dict[int, int]) -> pa.RecordBatch:
    columns = [*zip(*held, strict=True)] or [()] * 7
    names = ARROW.names[:-1]
    return common.batch_of(ARROW, **dict(zip(names, columns, strict=True)), fill=[fill.get(b) for b in columns[5]])


def again(left: DataFrame, size: int, open_bins: int, tasks: int, level: int) -> DataFrame:
    """Pack blocks (bin, fill) once more; gives bin, fill, new bin and the block's offset in it."""

    @common.trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = OpenBins(size, open_bins, level << 60 | TaskContext.get().partitionId() << 40)
        for batch in batches:
            placed = [bins.put(n) for n in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([p[0] for p in placed], pa.int64()), pa.array([p[1] for p in placed], pa.int64())], ["bin", "fill", "to_bin", "shift"])

    # larger blocks first: best-fit decreasing within each task
    return left.repartition(tasks, "bin").sortWithinPartitions(F.desc("fill"), "bin").mapInArrow(run, "bin long, fill long, to_bin long, shift long")


def pack(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SEQUENCE, end_id: int = END_ID, open_bins: int = OPEN_BINS,
    library_path: str | None = None, ranks_path: str | None = None,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    library_path, ranks_path = library_path or common.vocabulary(LIBRARY_FILE), ranks_path or common.vocabulary(RANKS_FILE)
    pieces = common.cut(cut_and_place(docs, doc_id, text, size, end_id, open_bins, library_path, ranks_path))
    done = pieces.where("fill IS NULL")
    # bins still open when their task ended: one block each, packed again by about one task for 64
    left = pieces.where("fill IS NOT NULL")
    blocks = left.groupBy("bin").agg(F.first("fill").alias("fill"))
    tasks = max(1, pieces.rdd.getNumPartitions() // 64)
    moved = again(blocks, size, 8 * open_bins, tasks, 1)
    left = left.drop("fill").join(moved.drop("fill"), "bin").select(*(c for c in pieces.columns if c not in ("bin", "place", "fill")), F.col("to_bin").alias("bin"), (F.col("place") + F.col("shift")).alias("place"))
    return done.drop("fill").unionByName(left).withColumnsRenamed({"bin": "sequence_id", "place": "offset"})


def op9_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(common.table(spark, sf_dir, "documents"))
