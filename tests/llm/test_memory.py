"""What tasks of Python workers take, and what they leave behind in workers that live on."""

import tracemalloc

import numpy as np
import psutil
import pyarrow as pa
from seqloom.llm import common, packing, shingles


def test_shingling_takes_little_besides_its_batch():
    texts = [" ".join(f"w{j}" for j in range(i, i + 400)) for i in range(6000)]
    batch = pa.record_batch([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    tracemalloc.start()
    n = sum(len(shingles.sets(piece.column(1), 4)) for piece in shingles.pieces(iter([batch]), 1))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == len(texts) and most < 25e6, most


def test_workers_give_memory_and_caches_back():
    pinned = []

    def run(batches):
        np.ones(30 << 17)  # from now on the allocator maps no block below 30 MB by itself
        blocks = [np.ones(1 << 17) for _ in range(150)]
        pinned.append(np.ones(100))  # lies above them
        yield len(blocks)

    def used():
        return psutil.Process().memory_info().rss

    text, ranks = (common.vocabulary(f) for f in (packing.LIBRARY_FILE, packing.RANKS_FILE))
    assert packing.encode("a b", text, ranks) and packing.fast_encoder.cache_info().currsize == 1
    before = used()
    assert list(common.trimmed(run)(iter([]))) == [150]
    assert used() - before < 60e6 and packing.fast_encoder.cache_info().currsize == 1
    list(common.lean(run)(iter([])))
    assert used() - before < 60e6 and packing.fast_encoder.cache_info().currsize == 0
