"""Benchmark decontamination by edit distance, through the CGK embedding.

Texts and items are compared as sequences of words (A-Z lowered, ASCII punctuation is white space).
A random walk over a sequence (Chakraborty, Goldenberg, Koucky 2016: at each step the current
word is written out, and a random bit of word and step decides whether to go on) maps edit distance to
Hamming distance. Windows of the items' own lengths are embedded, a few positions are
sampled as a bucket key, and that is repeated ``REPEATS`` times. Every
window that falls in an item's bucket is verified by exact edit distance (bit-parallel, any
length): an item leaks when some stretch of the text is within ``EDITS`` of its length.

Windows are embedded only where they can match at all: an edit breaks at most two word pairs, so a
stretch within ``k`` edits of an ``n``-word item keeps ``n - 1 - 2k`` of its pairs. A running
count of benchmark pairs tells that for every window of a whole batch; no region is lost by it. A window there
need not lie as the item does, though (edits in the item's first words shift it), so buckets alone miss
items. Therefore the same count is then taken item by item within those regions, and every item
that reaches it is verified as well, whatever its buckets say: the result doesn't rest on the buckets' luck.

The benchmark goes to the tasks in blocks of bounded size (a stated query set against all rows).

Defined cases: null or empty texts leak nothing; null or empty items match nothing; equal items are each
reported; repeated rows are each reported; items of under five words match exactly only; an empty table
on either side gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import common
from .set_join import mixed

#: Share of an item's words that may differ; samples a key; keys a window.
EDITS, SAMPLES, REPEATS = 0.2, 2, 16
#: Characters of benchmark text that go to the tasks at a time.
BLOCK_CHARS = 8_000_000
#: (place, item) rows counted at a time, about.
COUNTED = 2_000_000

WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
SCHEMA = "doc_id long, item_id long, start_word long, end_word long, edits long, item_words long"
ARROW = pa.schema([(c, pa.int64()) for c in re.findall(r"(\w+) long", SCHEMA)])


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(WORDS).split()


def allowed(n: int) -> int:
    return math.floor(EDITS * n)


def best_stretch(item: list[int], region: list[int]) -> tuple[int, int]:
    """(least edit distance of the item to any stretch of the region, end of that stretch); Myers' bit vectors."""
    m = len(item)
    masks: dict[int, int] = defaultdict(int)
    for i, w in enumerate(item):
        masks[w] |= 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best, end = full, 0, m, m, 0
    for j, w in enumerate(region):
        eq = masks.get(w, 0)
        xv = eq | down
        xh = (((eq & up) + up) ^ up) | eq
        plus, minus = down | ~(xh | up) & full, up & xh
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus, minus = plus << 1 & full, minus << 1 & full
        up, down = minus | ~(xv | plus) & full, plus & xv
        if score < best:
            best, end = score, j + 1
    return best, end


class Index:
    """Items of one block: vocabulary, pairs, and buckets for each length."""

    def __init__(self, items: list[tuple[int | None, str]], seed: int = 7):
        self.items = [(i, w) for i, t in items if t and (w := words_of(t))]
        self.ids: dict[bytes, int] = {}
        self.coded = [[self.ids.setdefault(w, len(self.ids) + 1) for w in ws] for _, ws in self.items]
        width = len(self.ids) + 1
        self.width = width
        self.pairs = np.unique(np.array([a * width + b for c in self.coded for a, b in zip(c, c[1:], strict=False)], np.int64))
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[self.slot(self.pairs)] = True
        random = np.random.default_rng(seed)
        self.word_hash = random.integers(1, 1 << 63, width, dtype=np.uint64)
        self.longest = max(map(len, self.coded), default=0)
        self.step_hash = random.integers(1, 1 << 63, (REPEATS, 3 * self.longest + 1), dtype=np.uint64)
        self.by_length: dict[int, list[int]] = defaultdict(list)
        for k, c in enumerate(self.coded):
            self.by_length[len(c)].append(k)
        self.pairs_of, self.holders = {}, {}
        for n, which in self.by_length.items():
            rows = np.unique(np.array([(a * width + b, k) for k in which for a, b in zip(self.coded[k], self.coded[k][1:], strict=False)], np.int64).reshape(-1, 2), axis=0)
            self.pairs_of[n], first = np.unique(rows[:, 0], return_index=True)
            self.holders[n] = np.append(first, len(rows)), rows[:, 1]  # the items of each pair, one after another
        self.sampled, self.buckets = {}, {}
        for n, which in sorted(self.by_length.items()):
            self.sampled[n] = np.sort(random.integers(0, 2 * n, (REPEATS, SAMPLES)), axis=1)
            keys = self.keys(np.array([self.coded[k] for k in which], np.int64), n)
            found: dict[int, list[int]] = defaultdict(list)
            for k, row in zip(which, keys, strict=True):
                for key in row.tolist():
                    found[key].append(k)
            self.buckets[n] = found

    def slot(self, codes: np.ndarray) -> np.ndarray:
        return (codes * 0x9E3779B1 >> 7) & ((1 << 22) - 1)

    def keys(self, windows: np.ndarray, n: int) -> np.ndarray:
        """Bucket keys [windows, REPEATS]: the walk's words at the sampled steps."""
        count = len(windows)
        at = np.zeros((count, REPEATS), np.int64)
        rows, reps = np.arange(count)[:, None], np.arange(REPEATS)
        padded = np.concatenate([windows, np.full((count, 1), -1)], axis=1)
        positions = self.sampled[n]
        key = np.broadcast_to(mixed(np.arange(1, REPEATS + 1, dtype=np.uint64) * np.uint64(n + 1)), (count, REPEATS)).copy()
        with np.errstate(over="ignore"):
            for step in range(int(positions.max()) + 1):
                word = padded[rows, at]
                for s in range(SAMPLES):
                    if (hit := positions[:, s] == step).any():
                        key[:, hit] = mixed(key[:, hit] * np.uint64(31) + word[:, hit].astype(np.uint64))
                bit = mixed(self.word_hash[np.maximum(word, 0)] ^ self.step_hash[reps, step]) & np.uint64(1)
                at = np.minimum(at + bit.astype(np.int64), n)
        return key

    def counted(self, n: int, at: np.ndarray, codes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
        """(item, start) wherever at least ``n - 1 - 2k`` of the places from start on hold pairs of that item.

        ``at``: ascending places (below ``most``) of pairs of items of this length, with their codes.
        """
        reach, need = n + allowed(n) - 1, max(1, n - 1 - 2 * allowed(n))
        first, items = self.holders[n]
        place = np.searchsorted(self.pairs_of[n], codes)
        count = first[place + 1] - first[place]
        part = np.cumsum(count) // COUNTED
        for a, b in zip(cuts := [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(at)], cuts[1:], strict=False):
            if a == b:
                continue
            end = int(np.searchsorted(at, at[b - 1] + reach))
            c = count[a:end]
            row = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c) + np.repeat(first[place[a:end]], c)
            spots = np.sort(items[row] * (most + reach) + np.repeat(at[a:end], c))
            enough = np.searchsorted(spots, spots + reach) - np.arange(len(spots)) >= need
            item, start = np.divmod(spots[enough], most + reach)
            mine = start <= at[b - 1]
            yield from zip(item[mine].tolist(), start[mine].tolist(), strict=True)

    def find(self, texts: list[str]) -> Iterator[tuple[int, int, int, int, int]]:
        """(text, item, start, end, edits) of the best stretch for each leaking pair."""
        if not self.items:
            return
        words: list[bytes] = []
        lengths = np.zeros(len(texts), np.int64)
        for t, text in enumerate(texts):
            found = words_of(text)
            lengths[t] = len(found) + 1
            words += found
            words.append(b"")  # no word of an item: parts the texts
        stream = np.fromiter(map(self.ids.get, words, repeat(0)), np.int64, len(words))
        del words
        ends = np.cumsum(lengths)
        code = stream[:-1] * self.width + stream[1:]
        known = (stream[:-1] > 0) & (stream[1:] > 0) & self.maybe[self.slot(code)] if len(stream) > 1 else np.zeros(0, bool)
        hits = np.flatnonzero(known)
        if len(self.pairs) and len(hits):
            place = np.minimum(np.searchsorted(self.pairs, code[hits]), len(self.pairs) - 1)
            hits = hits[self.pairs[place] == code[hits]]
        else:
            hits = hits[:0]
        hit_codes = code[hits]
        tried: set[tuple[int, int, int]] = set()
        best: dict[tuple[int, int], tuple[int, int, int]] = {}

        def look(t: int, item: int, start: int) -> None:
            """Verify the item around a start, once for each half of its length."""
            n = len(self.coded[item])
            k, begin = allowed(n), int(ends[t] - lengths[t])
            lo = max(begin, start - n)
            spot = (t, item, (start - begin) // max(1, n // 2))
            if spot in tried:
                return
            tried.add(spot)
            region = stream[lo : min(int(ends[t]) - 1, start + 2 * n + k)].tolist()
            edits, end = best_stretch(self.coded[item], region)
            if edits <= k and (t, item) not in best or edits < best.get((t, item), (k + 1,))[0]:
                # the stretch read backwards gives its start
                _, length = best_stretch(self.coded[item][::-1], region[:end][::-1])
                best[t, item] = (edits, lo - begin + end - length, lo - begin + end)

        for n in self.by_length:
            k = allowed(n)
            if n == 1:
                starts = np.flatnonzero(np.isin(stream, [self.coded[i][0] for i in self.by_length[1]]))
            else:
                # pairs of items of this length that begin within the window and its slack, counted from each pair on
                own = self.pairs_of[n]
                at = hits[own[np.minimum(np.searchsorted(own, hit_codes), len(own) - 1)] == hit_codes]
                inside = np.searchsorted(at, at + n + k - 1) - np.arange(len(at))
                need = max(1, n - 1 - 2 * k)
                starts = at[inside >= need]
            if not len(starts):
                continue
            text = np.searchsorted(ends, starts, "right")
            for a in range(0, len(starts), 4096):
                part = starts[a : a + 4096]
                index = part[:, None] + np.arange(n)
                last = ends[text[a : a + 4096]] - 1
                windows = np.where(index < last[:, None], stream[np.minimum(index, len(stream) - 1)], -1)
                found = self.buckets[n]
                for row, (start, t) in enumerate(zip(part.tolist(), text[a : a + 4096].tolist(), strict=True)):
                    if row == 0:
                        keys = self.keys(windows, n).tolist()
                    for item in {i for key in keys[row] for i in found.get(key, ())}:
                        look(t, item, start)
            if n > 1:
                # places within reach of a start that is left
                begins = np.flatnonzero(inside >= need)
                change = np.zeros(len(at) + 1, np.int64)
                np.add.at(change, begins, 1)
                np.add.at(change, begins + inside[begins], -1)
                live = at[np.cumsum(change[:-1]) > 0]
                for item, start in self.counted(n, live, code[live], len(stream)):
                    look(int(np.searchsorted(ends, start, "right")), item, start)
        for (t, item), (edits, start, end) in sorted(best.items()):
            yield t, item, start, end, edits


_INDEXES: dict[str, Index] = {}


def index_of(items: list[tuple[int | None, str]]) -> Index:
    """The index of a block; a worker keeps the last one."""
    key = hashlib.sha256(repr(items).encode("utf-8", "surrogatepass")).hexdigest()
    if key not in _INDEXES:
        _INDEXES.clear()
        _INDEXES[key] = Index(items)
    return _INDEXES[key]


def item_blocks(benchmark: DataFrame, item_id: str, item_text: str) -> Iterator[list[tuple[int | None, str]]]:
    """The distinct items that have a text, in blocks of about BLOCK_CHARS characters."""
    items = benchmark.select(F.col(item_id).cast("long").alias("item_id"), common.utf8(item_text).alias("text")).where("text <> ''").distinct()
    blocks = max(1, math.ceil((items.agg(F.sum(F.length("text"))).first()[0] or 0) / BLOCK_CHARS))
    for b in range(blocks):
        yield sorted(((r.item_id, r.text) for r in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()), key=repr)


def leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row for each (document row, item) pair that leaks, at its best stretch."""
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), common.utf8(text).alias("text"))
    out = None
    for block in item_blocks(benchmark, item_id, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        @common.trimmed
        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = index_of(shared.value)
            for batch in common.rows(batches, 4096):
                ids = batch.column(0).to_pylist()
                rows = [(ids[t], index.items[i][0], start, end, edits, len(index.items[i][1])) for t, i, start, end, edits in index.find(batch.column(1).to_pylist())]
                yield common.batch_of(ARROW, **dict(zip(ARROW.names, [*zip(*rows, strict=True)] or [()] * len(ARROW), strict=True)))

        part = docs.mapInArrow(run, SCHEMA)
        out = part if out is None else out.unionByName(part)
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents that leak no item, all columns kept."""
    out = docs
    for block in item_blocks(benchmark, item_id, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        @common.trimmed
        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = index_of(shared.value)
            for batch in common.rows(batches, 4096):
                leaking = {t for t, *_ in index.find([t or "" for t in batch.column(text).to_pylist()])}
                yield batch.filter(pa.array([t not in leaking for t in range(batch.num_rows)], pa.bool_()))

        out = out.mapInArrow(run, docs.schema)
    return out


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))
