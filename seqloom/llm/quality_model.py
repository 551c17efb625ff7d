"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics come from the whole text alone (byte counts, words, lines, repetition).
Trees are grown level by level on binned statistics: gradient histograms, best split, logistic
loss. A fitted model is one set of flat arrays (feature, threshold, children, value) over all
trees, walked for a whole batch of documents at once in numpy.

Training uses a bounded sample: the ``SAMPLE`` labelled rows with the lowest hash of their doc_id
among those outside the held-out fold (crc32 of the doc_id as text, modulo ``FOLDS``, not 0).
Every document is scored.

Defined cases: null or empty text: statistics 0, scored like any other; doc_ids without a label, or
labels without a document or a quality, don't train; with no training row, or one class only, the score
is the smoothed share of positives; null doc_ids are not held out; repeated rows repeat (one trains); of equally good splits the first goes; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import common

SAMPLE, FOLDS, THRESHOLD = 20_000, 5, 0.3
TREES, DEPTH, RATE, BINS, LEAST_ROWS, RIDGE = 80, 5, 0.12, 64, 8, 2.0
#: Texts are bytes here: classes of bytes that get a share of the text.
CLASSES = {"upper": range(65, 91), "digit": range(48, 58), "symbol": b"#*$%&|<>", "stop": b".!?", "comma": b",;:", "quote": b"\"'()[]{}", "blank": b" \t\x0b\x0c\r", "line": b"\n", "pipe": b"|", "beyond": range(128, 256), "control": [*range(9), *range(14, 32), 127]}
STATISTICS = ["log_bytes", "log_words", "mean_word", "spread_word", "longest_word", "distinct_words", "distinct_pairs", "short_words", "capital_words", "mean_line", "dup_lines", "dup_windows", "entropy", *CLASSES]
_CLASS = np.stack([np.isin(np.arange(256), [*v]) for v in CLASSES.values()]).astype(np.float64)

SCHEMA = "doc_id long, held_out boolean, score double, predicted int"
ARROW = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])


def statistics(text: str) -> np.ndarray:
    """The document's statistics, in order of STATISTICS."""
    data = text.encode("utf-8", "surrogatepass")
    out = np.zeros(len(STATISTICS))
    if not data:
        return out
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256).astype(np.float64)
    share = counts / len(data)
    words = data.split()
    n = len(words)
    out[0], out[1] = np.log1p(len(data)), np.log1p(n)
    out[12] = -(share[share > 0] * np.log2(share[share > 0])).sum()
    out[13:] = _CLASS @ share
    if n:
        sizes = np.fromiter(map(len, words), np.int64, n)
        lines = [x for x in data.split(b"\n") if x.strip()]
        windows = list(zip(words, words[1:], words[2:], words[3:], words[4:], strict=False))
        out[2:12] = (
            sizes.mean(), sizes.std(), np.log1p(sizes.max()), len(set(words)) / n, len(set(zip(words, words[1:], strict=False))) / n, (sizes <= 3).mean(),
            sum(w[:1].isupper() for w in words) / n, np.log1p(n / max(1, len(lines))), 1 - len(set(lines)) / max(1, len(lines)), 1 - len(set(windows)) / len(windows) if windows else 0.0,
        )
    return out


@dataclass
class Forest:
    """All trees in flat arrays; a leaf points at itself. ``roots``: where each tree begins."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    bias: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(DEPTH if len(self.roots) else 0):
            at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return 1 / (1 + np.exp(-(self.bias + self.value[at].sum(1))))


def grow(binned: np.ndarray, edges: list[np.ndarray], g: np.ndarray, h: np.ndarray) -> tuple[list[list[float]], np.ndarray]:
    """One tree: nodes [feature, threshold, left, right, value], and the leaf of each row."""
    nodes = [[0, np.inf, 0, 0, 0.0]]
    where = np.zeros(len(g), np.int64)
    level = [0]
    d = binned.shape[1]
    for _ in range(DEPTH):
        place = np.full(len(nodes), -1)
        place[level] = np.arange(len(level))
        rows = np.flatnonzero(place[where] >= 0)
        slot = place[where[rows]]
        sums = np.empty((3, len(level), d, BINS))
        for f in range(d):
            key = slot * BINS + binned[rows, f]
            for k, weights in enumerate((g[rows], h[rows], None)):
                sums[k, :, f] = np.bincount(key, weights, len(level) * BINS).reshape(len(level), BINS)
        total = sums[:, :, :1].sum(3, keepdims=True)
        low = sums.cumsum(3)
        high = total - low
        gain = low[0] ** 2 / (low[1] + RIDGE) + high[0] ** 2 / (high[1] + RIDGE) - total[0] ** 2 / (total[1] + RIDGE)
        gain[(low[2] < LEAST_ROWS) | (high[2] < LEAST_ROWS)] = 0
        flat = gain.reshape(len(level), -1)
        best = flat.argmax(1)
        grown = []
        for s, node in enumerate(level):
            if flat[s, best[s]] <= 1e-6:
                continue
            f, b = divmod(int(best[s]), BINS)
            if b >= len(edges[f]):
                continue
            nodes[node][:4] = [f, float(edges[f][b]), len(nodes), len(nodes) + 1]
            own = rows[slot == s]
            where[own] = len(nodes) + (binned[own, f] > b)
            grown += [len(nodes), len(nodes) + 1]
            nodes += [[0, np.inf, k, k, 0.0] for k in grown[-2:]]
        level = grown
        if not level:
            break
    top = np.bincount(where, g, len(nodes)), np.bincount(where, h, len(nodes))
    for k, node in enumerate(nodes):
        if node[2] == k:
            node[4] = float(RATE * top[0][k] / (top[1][k] + RIDGE))
    return nodes, where


def fit(x: np.ndarray, y: np.ndarray) -> Forest:
    """Boosted trees for the probability of label 1."""
    share = (y.sum() + 1) / (len(y) + 2)
    bias = float(np.log(share / (1 - share)))
    parts: list[list[list[float]]] = []
    if len(y) and 0 < y.sum() < len(y):
        edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS)[1:-1], method="lower")) for f in range(x.shape[1])]
        binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], axis=1)
        z = np.full(len(y), bias)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-z))
            nodes, where = grow(binned, edges, y - p, p * (1 - p))
            z += np.array([n[4] for n in nodes])[where]
            parts.append(nodes)
    roots = np.cumsum([0, *map(len, parts)])[:-1].astype(np.int64) if parts else np.empty(0, np.int64)
    flat = np.array([[n[0], n[1], n[2] + r, n[3] + r, n[4]] for r, nodes in zip(roots, parts, strict=True) for n in nodes]).reshape(-1, 5)
    return Forest(flat[:, 0].astype(np.int64), flat[:, 1], flat[:, 2].astype(np.int64), flat[:, 3].astype(np.int64), flat[:, 4], roots, bias)


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and labels of the bounded training sample, in a fixed order."""
    chosen = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y")).where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1)).where(~held_out()).distinct()
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.rows(batches):
            x = [statistics(t).tolist() for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "y", "x"])

    # at most ``sample`` rows on the broadcast side, and one text (the least) of repeated rows: a proven bound
    rows = docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text")).mapInArrow(run, "doc_id long, y int, x array<double>").toPandas()
    rows["k"] = [tuple(v) for v in rows["x"]]
    rows = rows.sort_values(["doc_id", "y", "k"])
    return np.array([*map(np.asarray, rows["x"])]).reshape(len(rows), len(STATISTICS)), rows["y"].to_numpy(np.float64)


def score(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> DataFrame:
    """Scores of all documents by a model fitted on the labels."""
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), common.utf8(text).alias("text"))
    forest = fit(*training_rows(docs, labels, sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.rows(batches, 512):
            x = np.array([statistics(t) for t in batch.column(2).to_pylist()]).reshape(-1, len(STATISTICS))
            s = forest.scores(x)
            yield common.batch_of(ARROW, doc_id=batch.column(0), held_out=batch.column(1), score=s, predicted=(s >= THRESHOLD).astype(np.int32))

    return docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(run, SCHEMA)


def op8_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))
