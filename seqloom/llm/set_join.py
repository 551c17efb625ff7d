"""Exact Jaccard self-join of shingle sets by set-relation skipping: components, and every set's number of links.

Sets hold the distinct word shingles of a document (``shingles``). A set is known by a 128-bit hash of all its
members, shortened to 64 bits where that is unique in the corpus (checked; the few that clash get other
numbers). Equal sets are one node with so many copies.

*Index.* Shingles have one global order: plain ones by hash, the most frequent ones last (by a census of all
texts; it only sets the order, never the result, so its table may be bounded). Two sets that reach the threshold
share a shingle among the first ``n - ceil(t * n) + 1`` of each, so only those are indexed. Where they first
meet, at places i and j, they can share no more than ``min(n - i, m - j)``.

*Block skipping.* An index list is in order of size and place. A list none of whose entries stands early
enough for a partner, or entries without a neighbour of fitting size, go before anything is joined. Long lists are cut into
blocks by size class and place; which pairs of blocks can hold a pair of sets is decided on the blocks' least and
greatest sizes and places, before any row is dealt to them. In a task the same bounds skip tiles of 64 by 64 entries; what is
left is held against parity bitmaps, whose Hamming distance is at most the symmetric difference.

*Answers from similar sets.* In each list the least node is the leader. Nodes are verified against the leaders they
share most entries with; verified links give first components, and only lists that still hold several
components go on. First a forest of the closest pairs of each block pair is verified, which joins most of what belongs
together, then every pair still between components. Every link lies within a component, whose sets are near copies of
each other: in each pair of blocks of a component one set's answers (what it shares with each of the others) are computed, and
every other set's answers are derived from them by the members it has gained and lost, without a look at what both share.

No task meets a whole group: entries of frequent shingles, the sets verified against one leader and the
sets of a component are all dealt in bounded portions, and the one set that they share goes with each portion.

Defined cases: null or empty texts and texts without words have the empty set, size 0, and
are linked with nothing (component_id: their own doc_id); equal rows fall in one component and are linked; the same
doc_id with several texts is several sets; null doc_ids count as no candidate for the smallest
id; ties between leaders go to the least node; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.sql.window import Window

from . import common
from .common import cut, drop, written
from .components import components, small
from .shingles import Sets, mixed, pieces, sets

#: Of the frequent shingles kept for the order (16 bytes each); those beyond it are ordered by hash.
MOST_FREQUENT, FREQUENT_FROM = 65_536, 32
#: Entries of a frequent shingle's list, sets verified against one leader, and entries of a block, that meet in one task (about).
PORTION, GROUP, BLOCK = 1024, 128, 256
#: Leaders that a node is verified against, and the share of its index entries (one in so many) that it must have in common.
LEADERS, SHARED = 2, 4
#: Sets of a component's block, and members looked at together, when links are counted.
LINK_BLOCK, COLUMNS = 256, 8192
#: Side of a tile, parts of a set's indexed places, nodes that a task remembers to have indexed.
TILE, PLACES, MOST_SEEN = 64, 8, 1_000_000
#: Sets whose 64-bit hashes clash, at most (a few are expected at 10**10 sets).
MOST_CLASHES = 10_000
#: Bits of a set's parity bitmap, by the size of the set; larger bitmaps fold onto smaller ones.
WIDTHS = ((640, 512), (1536, 1024), (6_000, 4096), (float("inf"), 16_384))
#: Places of an id in a Bloom filter, and bits that one has at most (64 MB); beyond, more texts than needed pass it.
PROBES, MOST_BITS = 16, 1 << 29

Names = dict[tuple[int, int], int]


def bitmap(found: np.ndarray) -> bytes:
    """Parity bitmap: each member flips one bit."""
    width = next(w for most, w in WIDTHS if len(found) <= most)
    return np.packbits(np.bincount((found >> 20) & (width - 1), minlength=width) & 1).tobytes()


def folded(bitmaps: list[bytes], width: int) -> np.ndarray:
    """[rows, words of 64 bits] at one width; rows of narrower bitmaps stay zero."""
    out = np.zeros((len(bitmaps), width // 64), np.uint64)
    for size in {len(b) for b in bitmaps}:
        if size * 8 >= width:
            at = [i for i, b in enumerate(bitmaps) if len(b) == size]
            rows = np.frombuffer(b"".join(bitmaps[i] for i in at), np.uint64).reshape(len(at), size * 8 // width, width // 64)
            out[at] = np.bitwise_xor.reduce(rows, axis=1)
    return out


def nodes_of(found: Sets, names: Names) -> list[int | None]:
    return [k and names.get(k, k[0]) for k in found.keys()]


def indexed(n: np.ndarray, percent: int) -> np.ndarray:
    """How many members of a set of n are indexed."""
    return n - (percent * n + 99) // 100 + 1


def indexed_of(n: str, percent: int) -> Column:
    return F.col(n) - F.ceil(F.col(n) * percent / 100) + 1


def survey(docs: DataFrame, size: int) -> DataFrame:
    """Rows (doc_id, k1, k2, n) of all documents, and rows (shingle, times) of shingles found in three documents of some batch."""

    @common.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1):
            found = sets(batch.column(1), size)
            keys, empty = found.keys(), pa.nulls(len(batch), pa.int64())
            key = [pa.array([k and k[i] for k in keys], pa.int64()) for i in range(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *key, pa.array(found.sizes), empty, empty], names)
            values = np.sort(found.values)
            first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.empty(0, np.int64)
            times = np.diff(np.append(first, len(values)))
            often = times >= 3
            empty = pa.nulls(int(often.sum()), pa.int64())
            yield pa.RecordBatch.from_arrays([empty, empty, empty, empty, pa.array(values[first[often]]), pa.array(times[often])], names)

    names = ["doc_id", "k1", "k2", "n", "shingle", "times"]
    return docs.mapInArrow(run, ", ".join(f"{c} long" for c in names))


def frequent(seen: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """At most MOST_FREQUENT shingles and their counts, the most frequent last."""
    counts = seen.where("shingle IS NOT NULL").groupBy("shingle").agg(F.sum("times").alias("times"))
    top = counts.where(F.col("times") >= FREQUENT_FROM).orderBy(F.desc("times"), "shingle").limit(MOST_FREQUENT).toPandas()
    return top["shingle"].to_numpy(np.int64)[::-1].copy(), top["times"].to_numpy(np.int64)[::-1].copy()


def clashes(keys: DataFrame) -> Names:
    """Other numbers for sets whose first 64 bits another set has, too; keys: distinct (k1, k2)."""
    twice = keys.groupBy("k1").agg(F.count("*").alias("c"), F.min("k2").alias("least")).where("c > 1")
    rows = keys.join(twice, "k1").where("k2 <> least").select("k1", "k2").orderBy("k1", "k2").limit(MOST_CLASHES + 1).collect()
    if len(rows) > MOST_CLASHES:
        raise RuntimeError("more clashing hashes than chance can give")
    out: Names = {}
    for step in range(1, 100):
        open_ = [(r.k1, r.k2) for r in rows if (r.k1, r.k2) not in out]
        if not open_:
            break
        wanted = {k: (k[0] + step * k[1] + 2**63) % 2**64 - 2**63 for k in open_}
        taken = {r.k1 for r in keys.where(F.col("k1").isin(list(wanted.values()))).select("k1").collect()} | set(out.values())
        for k, v in wanted.items():
            if v not in taken:
                out[k] = v
                taken.add(v)
    return out


def named(rows: DataFrame, names: Names) -> DataFrame:
    """k1 and k2 become node."""
    node = F.col("k1")
    for (a, b), v in names.items():
        node = F.when((F.col("k1") == a) & (F.col("k2") == b), F.lit(v)).otherwise(node)
    return rows.withColumn("node", node).drop("k1", "k2")


def entries(docs: DataFrame, size: int, percent: int, often: tuple[np.ndarray, np.ndarray], names: Names) -> DataFrame:
    """(token, part, whole, n, pos, node): index entries; lists of frequent shingles come in parts."""
    order = np.argsort(often[0])
    by_value, parts_of = often[0][order], -(-often[1] // PORTION)

    @common.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[int] = set()
        for batch in pieces(batches, 1):
            found = sets(batch.column(1), size)
            nodes = nodes_of(found, names)
            new = np.zeros(len(nodes), bool)
            for i, node in enumerate(nodes):
                if node is not None and node not in known:
                    new[i] = True
                    known.add(node)
            if len(known) > MOST_SEEN:
                known.clear()
            n = found.sizes[new]
            node = np.array([x for x, k in zip(nodes, new.tolist(), strict=True) if k], np.int64)
            values = found.values[np.repeat(new, found.sizes)]
            doc = np.repeat(np.arange(len(n)), n)
            rank = np.zeros(len(values), np.int64)
            if len(by_value):
                at = np.minimum(np.searchsorted(by_value, values), len(by_value) - 1)
                hit = np.flatnonzero(by_value[at] == values)
                rank[hit] = order[at[hit]] + 1
                turn = np.argsort(doc * (len(by_value) + 1) + rank, kind="stable")
                values, rank = values[turn], rank[turn]
            pos = np.arange(len(values)) - np.repeat(np.cumsum(n) - n, n)
            keep = pos < indexed(n, percent)[doc]
            values, rank, pos, doc = values[keep], rank[keep], pos[keep], doc[keep]
            parts = np.concatenate([[1], parts_of])[rank]
            with np.errstate(over="ignore"):
                part = (mixed(node.view(np.uint64))[doc] >> np.uint64(1)).astype(np.int64) % parts
            columns = [values, part.astype(np.int32), parts == 1, n[doc].astype(np.int32), pos.astype(np.int32), node[doc]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["token", "part", "whole", "n", "pos", "node"])

    return docs.mapInArrow(run, "token long, part int, whole boolean, n int, pos int, node long")


def complete(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[dict[str, np.ndarray]]:
    """Columns of runs of whole groups; rows arrive sorted by keys (longs)."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = [batch.column(c).to_numpy(zero_copy_only=False) for c in keys]
        last = np.logical_and.reduce([k == k[-1] for k in key])
        at = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
        if at or rest and any(rest[0].column(c)[0].as_py() != k[0] for c, k in zip(keys, key, strict=True)):
            t = pa.Table.from_batches([*rest, batch.slice(0, at)])
            yield {c: t.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in t.column_names}
            rest = []
        rest.append(batch.slice(at))
    if rest:
        t = pa.Table.from_batches(rest)
        yield {c: t.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in t.column_names}


def changes(*keys: np.ndarray) -> np.ndarray:
    """Where a row's keys differ from those before it."""
    out = np.ones(len(keys[0]), bool)
    out[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return out


def per_group(starts: np.ndarray, values: np.ndarray, reduce: np.ufunc) -> np.ndarray:
    """Each row's group's reduced value."""
    at = np.flatnonzero(starts)
    return np.repeat(reduce.reduceat(values, at), np.diff(np.append(at, len(values)))) if len(values) else values


def thinned(dealt: DataFrame, percent: int) -> DataFrame:
    """(token, n, pos, node, leader): entries that can have a partner in their list; parts of lists stay as they are, without a leader.

    In order of size the neighbours fit best: if neither does, no set of the list does. The smaller set of a
    pair stands early: at one of the places that an equal set could still be reached from.
    """

    @common.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in complete(batches, ["token", "part"]):
            repeated = ~changes(g["token"], g["part"], g["node"])
            g = {c: v[~repeated] for c, v in g.items()}
            for _ in range(2):
                starts = changes(g["token"], g["part"])
                n = g["n"].astype(np.int64)
                near = np.zeros(len(n), bool)
                near[1:] = ~starts[1:] & (100 * n[:-1] >= percent * n[1:])
                fits = near.copy()
                fits[:-1] |= near[1:]
                early = (n - g["pos"]) * (100 + percent) >= 2 * percent * n
                keep = ~g["whole"] | fits & per_group(starts, early, np.logical_or)
                g = {c: v[keep] for c, v in g.items()}
            leader = per_group(changes(g["token"], g["part"]), g["node"], np.minimum)
            columns = [g["token"], g["n"], g["pos"], g["node"]]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(leader, mask=~g["whole"])], ["token", "n", "pos", "node", "leader"])

    keys = ["token", "part"]
    return dealt.repartition(*keys).sortWithinPartitions(*keys, "n", "pos", "node").mapInArrow(run, "token long, n int, pos int, node long, leader long")


def probes(ids: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """Places of ids in a Bloom filter of so many bits, a power of two."""
    h = ids.view(np.uint64)
    with np.errstate(over="ignore"):
        at, step = mixed(h), mixed(h ^ np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
        for _ in range(PROBES):
            yield (at & np.uint64(bits - 1)).astype(np.int64)
            at = at + step


def bloom(ids: np.ndarray) -> np.ndarray:
    """A Bloom filter of ids, in bytes; 32 to 64 bits an id as long as they fit in MOST_BITS."""
    bits = min(MOST_BITS, max(1024, 1 << (32 * len(ids) - 1).bit_length()))
    out = np.zeros(bits // 8, np.uint8)
    for at in probes(ids, bits):
        np.bitwise_or.at(out, at >> 3, np.left_shift(np.uint8(1), (at & 7).astype(np.uint8)))
    return out


def may_hold(filter_: np.ndarray, ids: np.ndarray) -> np.ndarray:
    found = np.ones(len(ids), bool)
    for at in probes(ids, 8 * len(filter_)):
        found &= (filter_[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
    return found


def texts_of(need: DataFrame, docs: DataFrame, size: int, names: Names) -> DataFrame:
    """(node, text, bits) of the needed nodes, each once, and now and then of another; need: (node, rep).

    The documents are picked where they lie, by a Bloom filter of the reps, so that no text is dealt. It may let through a further
    document of a node, as repeated rows of one doc_id do; those are found by their nodes.
    """
    reps = need.select("rep").toArrow().column(0)
    filter_, nulls = bloom(reps.drop_null().to_numpy()), reps.null_count > 0

    @common.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1):
            ids = batch.column(0)
            hit = np.where(ids.is_null().to_numpy(zero_copy_only=False), nulls, may_hold(filter_, ids.fill_null(0).to_numpy()))
            picked = batch.column(1).take(pa.array(np.flatnonzero(hit)))
            if len(picked):
                found = sets(picked, size)
                nodes = nodes_of(found, names)
                at = [i for i, node in enumerate(nodes) if node is not None]
                yield pa.RecordBatch.from_arrays([pa.array([nodes[i] for i in at], pa.int64()), picked.take(pa.array(at, pa.int64())), pa.array([bitmap(found[i]) for i in at], pa.binary())], ["node", "text", "bits"])

    out = written(docs.select("doc_id", "text").mapInArrow(run, "node long, text string, bits binary"))
    twice, n = small(cut(out.groupBy("node").agg(F.count("*").alias("c")).where("c > 1").select("node")))
    if n:
        one = out.join(twice, "node", "left_semi").dropDuplicates(["node"])
        out, again = written(out.join(twice, "node", "left_anti").unionByName(one)), out
        drop(again)
    return out


def shared_with(base: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Which members of ``own`` are in ``base``; both in order."""
    return base[np.minimum(np.searchsorted(base, own), len(base) - 1)] == own


def verified(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The (x, y) of the pairs that are linked, as edges (u, v). Sets meet y in portions, each with one copy of y's text."""
    portions, _ = small(pairs.groupBy("y").agg(F.ceil(F.count("*") / GROUP).alias("portions")).where("portions > 1"))
    dealt = pairs.join(portions, "y", "left").select("x", "y", F.pmod(F.xxhash64("x"), F.coalesce("portions", F.lit(1).cast("long"))).alias("part"))
    wanted, _ = small(dealt.unionByName(dealt.select("y", "part").distinct().withColumn("x", F.col("y"))))
    both = wanted.join(texts.select(F.col("node").alias("x"), "text"), "x")

    @common.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = np.empty(0, np.int64)
        for batch in pieces(batches, 2):
            found = sets(batch.column(2), size)
            x, y = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            linked = np.zeros(len(x), bool)
            for i, first in enumerate((x == y).tolist()):
                own = found[i]
                if first:
                    base = own.copy()
                else:
                    common_size = int(shared_with(base, own).sum())
                    linked[i] = 100 * common_size >= percent * (len(base) + len(own) - common_size)
            yield pa.RecordBatch.from_arrays([pa.array(x[linked]), pa.array(y[linked])], ["u", "v"])

    keys = ["y", "part"]
    rows = both.select("x", "y", "text", "part").repartition(*keys).sortWithinPartitions(*keys, F.col("x") != F.col("y"), "x")
    return rows.mapInArrow(run, "u long, v long")


def with_leaders(lists: DataFrame, percent: int) -> DataFrame:
    """(x, y): each node with the leaders that it shares most index entries with."""
    count = lists.where("node <> leader").groupBy("node", "leader").agg(F.count("*").alias("c"), F.first("n").alias("n")).where(SHARED * F.col("c") >= indexed_of("n", percent))
    best = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("c"), "leader"))
    return count.withColumn("k", best).where(F.col("k") <= LEADERS).select(F.col("node").alias("x"), F.col("leader").alias("y"))


def remaining(lists: DataFrame, links: DataFrame, texts: DataFrame) -> DataFrame | None:
    """Entries of the lists that still hold several components, with m, the entries of their list; the wide column comes last."""
    roots = components(links).withColumnRenamed("root", "comp")
    own = cut(lists.drop("leader").join(roots, "node", "left").withColumn("comp", F.coalesce("comp", "node")))
    several = own.groupBy("token").agg(F.count("*").alias("m"), F.min("comp").alias("a"), F.max("comp").alias("b")).where("a <> b").select("token", "m")
    several, n = small(cut(several))
    return own.join(several, "token").join(texts.select("node", "bits"), "node") if n else None


ENTRY = ["token", "lo", "hi", "own", "node", "n", "pos", "comp", "bits"]


def block_pairs(left: DataFrame, percent: int) -> DataFrame:
    """Entries dealt to the pairs of blocks (lo, hi) of their list that sizes and places leave; ``own``: their own block."""
    n, pos = F.col("n").cast("double"), F.col("pos").cast("double")
    place = F.least(F.floor(pos * PLACES / indexed_of("n", percent)), F.lit(PLACES - 1))
    cell = F.floor(F.log(n) / F.log(F.lit(100 / percent))) * PLACES + place
    short, long = left.where(F.col("m") <= BLOCK), left.where(F.col("m") > BLOCK).withColumn("cell", cell)
    cells = long.groupBy("token", "cell").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.max(F.col("n") - F.col("pos")).alias("rest"), F.ceil(F.count("*") / BLOCK).alias("parts"))
    cells = cut(cells)
    blocks = cells.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).withColumn("block", F.col("cell") * 2**32 + F.col("part"))
    a, b = (blocks.select("token", *(F.col(c).alias(f"{c}_{k}") for c in ("block", "least", "most", "rest"))) for k in "ab")
    # sizes fit, and from the places reached so far enough members can still be shared
    may = (F.col("block_a") <= F.col("block_b")) & (100 * F.col("most_a") >= percent * F.col("least_b")) & (F.least("rest_a", "rest_b") * (100 + percent) >= percent * (F.col("least_a") + F.col("least_b")))
    pairs = a.join(b, "token").where(may).select("token", F.col("block_a").alias("lo"), F.col("block_b").alias("hi"))
    to = pairs.select("token", F.explode(F.array_distinct(F.array("lo", "hi"))).alias("own"), "lo", "hi")
    parts, _ = small(cells.select("token", "cell", "parts"))
    mine = long.join(parts, ["token", "cell"]).withColumn("own", F.col("cell") * 2**32 + F.pmod(F.xxhash64("node"), F.col("parts")))
    nought = F.lit(0).cast("long")
    return short.select("token", nought.alias("lo"), nought.alias("hi"), nought.alias("own"), *ENTRY[4:]).unionByName(mine.join(to, ["token", "own"]).select(*ENTRY))


def pairs_in_block(g: dict, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index pairs of one block pair, in order of size, that no bound rules out, and how close to the bound they are."""
    n, comp, rest = g["n"].astype(np.int64), g["comp"], g["n"].astype(np.int64) - g["pos"]
    m = len(n)
    tiles = np.arange(0, m, TILE)
    longest, one, other = np.maximum.reduceat(rest, tiles), np.minimum.reduceat(comp, tiles), np.maximum.reduceat(comp, tiles)
    apart = g["lo"][0] != g["hi"][0]
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for s, a in enumerate(tiles.tolist()):
        b = min(a + TILE, m)
        for t in range(s, len(tiles)):
            c, d = int(tiles[t]), min(int(tiles[t]) + TILE, m)
            if percent * n[c] > 100 * n[b - 1]:
                break  # all further sets are too large
            if min(longest[s], longest[t]) * (100 + percent) < percent * (n[a] + n[c]) or one[s] == other[s] == one[t] == other[t]:
                continue
            ok = (percent * n[None, c:d] <= 100 * n[a:b, None]) & (comp[a:b, None] != comp[None, c:d])
            ok &= np.minimum(rest[a:b, None], rest[None, c:d]) * (100 + percent) >= percent * (n[a:b, None] + n[None, c:d])
            if s == t:
                ok &= np.arange(a, b)[:, None] < np.arange(c, d)
            if apart:
                ok &= g["own"][a:b, None] != g["own"][None, c:d]
            i, j = np.nonzero(ok)
            found.append((i + a, j + c))
    i, j = (np.concatenate([f[k] for f in found]) if found else np.empty(0, np.int64) for k in range(2))
    share = np.zeros(len(i))
    for most, width in zip((0, *(k for k, _ in WIDTHS[:-1])), (w for _, w in WIDTHS), strict=True):
        if not len(i) or n[-1] <= most:
            break
        maps = folded(g["bits"], width)
        ok = np.ones(len(i), bool)
        for at in range(0, len(i), 1 << 16):  # bounds the memory of the bitmaps side by side
            k = np.arange(at, min(at + (1 << 16), len(i)))
            k = k[n[i[k]] > most]  # i is the smaller one
            hamming = np.bitwise_count(maps[i[k]] ^ maps[j[k]]).sum(1, dtype=np.int64)
            share[k] = hamming / (n[i[k]] + n[j[k]])
            ok[k] = hamming * (100 + percent) <= (100 - percent) * (n[i[k]] + n[j[k]])
        i, j, share = i[ok], j[ok], share[ok]
    return i, j, share


def forest(i: np.ndarray, j: np.ndarray, share: np.ndarray, comp: np.ndarray) -> np.ndarray:
    """Which pairs to look at first: closest first, each joining components that none before it has joined."""
    above: dict[int, int] = {}

    def top(c: int) -> int:
        while (up := above.get(c, c)) != c:
            above[c] = above.get(up, up)
            c = up
        return c

    kept = []
    for k in np.argsort(share, kind="stable").tolist():
        a, b = top(int(comp[i[k]])), top(int(comp[j[k]]))
        if a != b:
            above[max(a, b)] = min(a, b)
            kept.append(k)
    return np.array(kept, np.int64)


def candidates(dealt: DataFrame, percent: int, first: bool) -> DataFrame:
    """(x, y, token) over all block pairs; y is the one that more of a block's pairs hold, token is null.

    ``first``: only a forest of each, and a row with the token alone for each list that has further pairs.
    """

    @common.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in complete(batches, ["token", "lo", "hi"]):
            cuts = [*np.flatnonzero(changes(g["token"], g["lo"], g["hi"])).tolist(), len(g["token"])]
            found, further = set(), set()
            for a, b in zip(cuts, cuts[1:], strict=False):
                if b - a > 1:
                    own = {c: v[a:b] for c, v in g.items()}
                    i, j, share = pairs_in_block(own, percent)
                    if first and len(i):
                        trees = forest(i, j, share, own["comp"])
                        if len(trees) < len(i):
                            further.add(int(own["token"][0]))
                        i, j = i[trees], j[trees]
                    held = np.bincount(np.concatenate([i, j]).astype(np.int64), minlength=b - a)
                    turn = held[i] > held[j]
                    x, y = own["node"][np.where(turn, j, i)], own["node"][np.where(turn, i, j)]
                    found.update(zip(x.tolist(), y.tolist(), strict=True))
            rows = [*((x, y, None) for x, y in found), *((None, None, t) for t in further)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(3)], ["x", "y", "token"])

    keys = ["token", "lo", "hi"]
    return dealt.repartition(*keys).sortWithinPartitions(*keys, "n", "pos", "node").mapInArrow(run, "x long, y long, token long").distinct()


@dataclass
class Settled:
    """docs (doc_id, text), seen (read by rows and nodes), rows (doc_id, node, n), nodes (node, rep, n, copies), comps (node, root) of nodes with a link, texts."""

    docs: DataFrame
    seen: DataFrame
    rows: DataFrame
    nodes: DataFrame
    comps: DataFrame
    texts: DataFrame
    names: Names

    def about(self) -> DataFrame:
        """Per node: node, root, component_id, rep, copies."""
        linked = self.comps.join(self.nodes.select("node", "rep"), "node")
        least, _ = small(linked.groupBy("root").agg(F.min("rep").alias("least")))
        placed = self.comps.join(least, "root")
        return self.nodes.join(placed, "node", "left").select("node", F.coalesce("root", "node").alias("root"), F.when(F.col("root").isNull(), F.col("rep")).otherwise(F.col("least")).alias("component_id"), "rep", "copies")


def settled(docs: DataFrame, size: int, percent: int, doc_id: str, text: str) -> Settled:
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), common.utf8(text).alias("text"))
    seen = cut(survey(docs, size))
    of = seen.where("n > 0").groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.count("*").alias("copies"))
    of = cut(of)
    names = clashes(of.select("k1", "k2"))
    nodes, rows = named(of, names), named(seen.where("n IS NOT NULL").select("doc_id", "k1", "k2", "n"), names)

    lists = cut(thinned(entries(docs, size, percent, frequent(seen), names), percent))
    common.release(docs)
    # parts of lists hold frequent shingles only, so there are few of them
    firsts = lists.where("leader IS NULL").groupBy("token").agg(F.min("node").alias("least"))
    led = lists.join(F.broadcast(firsts), "token", "left").withColumn("leader", F.coalesce("leader", "least")).drop("least")
    need = cut(lists.select("node").distinct().join(nodes.select("node", "rep"), "node"))
    texts = texts_of(need, docs, size, names)
    drop(need)
    common.release(docs)

    pairs = cut(with_leaders(led, percent))
    links = cut(verified(pairs, texts, size, percent))
    drop(pairs)
    for first in (True, False):  # what the forests' links leave apart is looked at pair by pair, where a list had more than its forest
        left = remaining(lists, links, texts)
        if left is None:
            break
        found = cut(candidates(block_pairs(left, percent), percent, first))
        links, before = cut(links.unionByName(verified(found.where("token IS NULL").select("x", "y"), texts, size, percent))), links
        if first:
            further, _ = small(found.where("token IS NOT NULL").select("token"))
            lists, whole = cut(lists.join(further, "token", "left_semi")), lists
            drop(whole)
        drop(found, before)
        common.release(docs)
    comps = components(links)
    drop(lists, links)
    return Settled(docs, seen, rows, nodes, comps, texts, names)


def in_common(lists: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """[left, right]: how many values every two of the lists share."""
    out = np.zeros((len(left), len(right)), np.int64)
    values, column, times = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    row, shared = np.repeat(np.arange(len(lists)), [len(x) for x in lists]), times > 1  # others meet no second list
    keep = shared[column]
    row, column = row[keep], (np.cumsum(shared) - 1)[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    width = int(shared.sum())
    for c in range(0, width, COLUMNS):
        a, b = np.searchsorted(column, [c, c + COLUMNS])
        has = np.zeros((len(lists), min(COLUMNS, width - c)), np.float32)  # its counts are exact far beyond COLUMNS
        has[row[a:b], column[a:b] - c] = 1
        out += (has[left] @ has[right].T).astype(np.int64)
    return out


def answers(members: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """[left, right]: members that every two sets share, derived from what the first set shares with each.

    With ``gained`` and ``lost`` against the first set r: x and y share |x & r| + |y & r| - |r| members of r, and those of r that
    both have lost, counted twice by that, and what both have gained.
    """
    base = members[0]
    gained, lost, near = [], [], np.empty(len(members), np.int64)
    for k, own in enumerate(members):
        hit = shared_with(base, own)
        near[k] = hit.sum()
        gained.append(own[~hit])
        missing = np.ones(len(base), bool)
        missing[np.searchsorted(base, own[hit])] = False
        lost.append(np.flatnonzero(missing))
    return near[left][:, None] + near[right] - len(base) + in_common(lost, left, right) + in_common(gained, left, right)


def link_counts(found: Settled, size: int, percent: int) -> DataFrame:
    """(node, links): documents of other nodes within the threshold, for nodes of components."""
    sizes = found.comps.groupBy("root").agg(F.count("*").alias("m")).where(F.col("m") > LINK_BLOCK).select("root", F.ceil(F.col("m") / LINK_BLOCK).alias("blocks"))
    one = F.lit(1).cast("long")
    placed = found.comps.join(small(sizes)[0], "root", "left").withColumn("blocks", F.coalesce("blocks", one))
    wanted, _ = small(cut(placed.join(found.nodes.select("node", "copies"), "node")))
    full = wanted.join(found.texts.select("node", "text"), "node")
    dealt = (
        full.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select("root", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "node", "copies", "text")
    )

    def counted(own: np.ndarray, node: np.ndarray, copies: np.ndarray, members: list[np.ndarray], lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        left, right = np.flatnonzero(own == lo), np.flatnonzero(own == hi)
        n = np.array([len(x) for x in members])
        share = answers(members, left, right)
        linked = (share * 100 >= percent * (n[left][:, None] + n[right] - share)) & (left[:, None] != right)
        if lo == hi:
            return node[left], linked @ copies[right]
        return np.concatenate([node[left], node[right]]), np.concatenate([linked @ copies[right], copies[left] @ linked])

    @common.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # (group, own, node, copies, members) of the group that is not yet at its end

        def closed(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
            return counted(*(np.array([r[k] for r in rows]) for k in (1, 2, 3)), [r[4] for r in rows], *rows[0][0][1:])

        for batch in pieces(batches, 6):
            members = sets(batch.column(6), size)
            key, own, node, copies = zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True), *(batch.column(c).to_pylist() for c in (3, 4, 5))
            out = []
            for i, group in enumerate(key):
                if held and held[0][0] != group:
                    out.append(closed(held))
                    held = []
                held.append((group, own[i], node[i], copies[i], members[i].copy()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([o[k] for o in out])) for k in range(2)], ["node", "links"])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in closed(held)], ["node", "links"])

    keys = ["root", "lo", "hi"]
    return dealt.repartition(*keys).sortWithinPartitions(*keys, "node").mapInArrow(run, "node long, links long").groupBy("node").agg(F.sum("links").alias("links"))


def links(docs: DataFrame, size: int = 4, percent: int = 85, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, n_links (the other rows within the threshold, each copy counted)."""
    with common.scratch(docs.sparkSession) as keep:
        found = settled(docs, size, percent, doc_id, text)
        counts = cut(link_counts(found, size, percent))
        about = keep(cut(found.about().join(counts, "node", "left").select("node", "component_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))))
        keep(found.seen)
    common.release(docs)
    some = found.rows.where("n > 0").join(about, "node").select("doc_id", F.col("n").alias("n_shingles"), "component_id", "n_links")
    none = found.rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links"))
    return some.unionByName(none)


def one_of_each(docs: DataFrame, size: int = 4, percent: int = 85, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, all columns kept, but of each component only the row of the smallest doc_id.

    Of repeated rows of that doc_id one stays; documents without words all stay; an empty table stays empty; columns may have any names.
    """
    node, id_, rows_ = (common.free(docs.columns, c) for c in ("node", "id", "rows"))
    with common.scratch(docs.sparkSession) as keep:
        found = settled(docs, size, percent, doc_id, text)
        reps = found.about().where("rep <=> component_id").groupBy("root").agg(F.min("node").alias("node"), F.min("component_id").alias("rep"))
        # how many rows have that set and that doc_id
        same = found.rows.join(reps.select("node", "rep"), (found.rows["node"] == reps["node"]) & found.rows["doc_id"].eqNullSafe(reps["rep"])).groupBy(reps["node"]).agg(F.first("rep").alias(id_), F.count("*").alias(rows_))
        stay = keep(cut(same.withColumnRenamed("node", common.free(docs.columns, "kept"))))
    common.release(docs)
    kept = stay.columns[0]
    marked = with_nodes(docs, size, text, node, found.names)
    joined = marked.join(stay, (F.col(node) == F.col(kept)) & F.col(doc_id).cast("long").eqNullSafe(F.col(id_)), "left")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    out = joined.where(F.col(node).isNull() | (F.col(rows_) == 1)).select(*columns)
    if stay.where(F.col(rows_) > 1).isEmpty():
        return out
    return out.unionByName(joined.where(F.col(rows_) > 1).dropDuplicates([node]).select(*columns))


def with_nodes(docs: DataFrame, size: int, text: str, name: str, names: Names) -> DataFrame:
    """The documents with their sets' nodes in a further column."""
    at = docs.columns.index(text)

    @common.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, at):
            yield batch.append_column(name, pa.array(nodes_of(sets(pc.fill_null(batch.column(at), ""), size), names), pa.int64()))

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, LongType())]))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links(common.table(spark, sf_dir, "documents"))


#: The same by brute force: all pairs that share a shingle, then reachability.
ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS a FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(a) = 0 THEN [] WHEN len(a) < 4 THEN [array_to_string(a, ' ')]
    ELSE list_distinct(list_transform(range(1, len(a) - 2), lambda i: array_to_string(a[i:i+3], ' '))) END AS g FROM w
), z AS (SELECT doc_id, len(g)::BIGINT AS n FROM s), e AS (SELECT doc_id, unnest(g) AS h FROM s),
l AS MATERIALIZED (
  SELECT p.x, p.y FROM (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM e a JOIN e b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY 1, 2) p
  JOIN z zx ON zx.doc_id = p.x JOIN z zy ON zy.doc_id = p.y WHERE 100 * p.c >= 85 * (zx.n + zy.n - p.c)
), r AS (SELECT doc_id AS x, doc_id AS y FROM z UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
k AS (SELECT x, count(*)::BIGINT AS n FROM l GROUP BY x)
SELECT z.doc_id, z.n AS n_shingles, (SELECT min(r.y) FROM r WHERE r.x = z.doc_id) AS component_id, coalesce(k.n, 0)::BIGINT AS n_links FROM z LEFT JOIN k ON k.x = z.doc_id
"""
