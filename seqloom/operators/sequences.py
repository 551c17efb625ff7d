"""Operators over ordered rows of a key, by column name.

``by`` is the key (list of columns), ``order`` the columns that order its rows uniquely. All
windows of an operator share the key's partitioning, so a chain of them is one exchange.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType


def _w(by: list[str], order: list[str]):
    return Window.partitionBy(*by).orderBy(*order)


def _sofar(by: list[str], order: list[str]):
    return _w(by, order).rowsBetween(Window.unboundedPreceding, 0)


def _balanced(rows: DataFrame, by: list[str], order: list[str], opens: Column, closes: Column) -> DataFrame:
    """Rows that open (+1) or close (-1), with ``_stray``: a close that finds nothing open."""
    d = F.when(opens, 1).when(closes, -1)
    out = rows.withColumn("_d", d).where("_d IS NOT NULL")
    out = out.withColumn("_s", F.sum("_d").over(_sofar(by, order)))
    lowest = F.min("_s").over(_w(by, order).rowsBetween(Window.unboundedPreceding, -1))
    return out.withColumn("_stray", (F.col("_d") == -1) & (F.col("_s") < F.least(F.lit(0), F.coalesce(lowest, F.lit(0)))))


def fifo_pairs(rows: DataFrame, by: list[str], order: list[str], opens: Column, closes: Column, carry: list[str]) -> DataFrame:
    """First-in-first-out pairs: by, k, and ``on_*``/``off_*`` of the carried columns.

    Stray closes are dropped first (a running sum under its running minimum); then the k-th open goes
    with the k-th close. The pair is put together by an aggregation on (by, k), which needs no
    further exchange. Unmatched opens are dropped.
    """
    kept = _balanced(rows, by, order, opens, closes).where("NOT _stray")
    kept = kept.withColumn("k", F.row_number().over(_w([*by, "_d"], order)))
    sides = [F.max(F.when(F.col("_d") == d, F.col(c))).alias(f"{name}_{c}") for d, name in ((1, "on"), (-1, "off")) for c in carry]
    both = [(F.count(F.when(F.col("_d") == 1, 1)) > 0) & (F.count(F.when(F.col("_d") == -1, 1)) > 0)]
    return kept.groupBy(*by, "k").agg(*sides, both[0].alias("_both")).where("_both").drop("_both")


def stray_closes(rows: DataFrame, by: list[str], order: list[str], opens: Column, closes: Column) -> DataFrame:
    """The closes that find nothing open."""
    return _balanced(rows, by, order, opens, closes).where("_stray").select(*rows.columns)


def forward_state(rows: DataFrame, by: list[str], order: list[str], declares: Column, value: Column, name: str) -> DataFrame:
    """Adds the latest declared value up to and with each row; null before the first."""
    return rows.withColumn(name, F.last(F.when(declares, value), ignorenulls=True).over(_sofar(by, order)))


def asof_before(rows: DataFrame, by: list[str], at: Column, tie: str, marks: Column, asks: Column, value: str, name: str) -> DataFrame:
    """Rows that ask, with the value of the latest mark strictly before them in ``at`` (long); ties by the greatest ``tie``."""
    w = Window.partitionBy(*by).orderBy("_at").rangeBetween(Window.unboundedPreceding, -1)
    out = rows.withColumn("_at", at).withColumn("_asks", asks)
    latest = F.max(F.when(marks, F.struct("_at", F.col(tie).alias("t"), F.col(value).alias("v")))).over(w)
    return out.withColumn(name, latest["v"]).where("_asks").drop("_at", "_asks")


def running_total(rows: DataFrame, by: list[str], order: list[str], value: str, name: str) -> DataFrame:
    return rows.withColumn(name, F.sum(value).over(_sofar(by, order)))


def deltas(rows: DataFrame, by: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """Difference to the row before; the first row's to 0."""
    return rows.withColumn(name, F.col(value) - F.coalesce(F.lag(value).over(_w(by, order)), F.lit(0)))


def dedupe_consecutive(rows: DataFrame, by: list[str], order: list[str], value: str) -> DataFrame:
    """Drops rows whose value equals the row before (nulls equal each other)."""
    w = _w(by, order)
    return rows.withColumn("_first", F.row_number().over(w) == 1).withColumn("_same", F.col(value).eqNullSafe(F.lag(value).over(w))).where("_first OR NOT _same").drop("_first", "_same")


def step_integral(rows: DataFrame, by: list[str], order: list[str], at: str, rate: str, name: str) -> DataFrame:
    """Integral of a step function up to each row: the rate of the row before holds since then."""
    w = _w(by, order)
    part = (F.col(at) - F.lag(at).over(w)) * F.lag(rate).over(w)
    return rows.withColumn("_part", F.coalesce(part, F.lit(0))).withColumn(name, F.sum("_part").over(_sofar(by, order))).drop("_part")


def islands(rows: DataFrame, by: list[str], order: list[str], breaks: Column, name: str) -> DataFrame:
    """Numbers the islands that begin where ``breaks`` holds (a null counts as a break)."""
    return rows.withColumn("_break", F.coalesce(breaks, F.lit(True)).cast("int")).withColumn(name, F.sum("_break").over(_sofar(by, order))).drop("_break")


def folded(rows: DataFrame, by: list[str], order: list[str], start: Callable[[], object], step: Callable, name: str) -> DataFrame:
    """A left fold over each key's rows in order, row by row as they stream: state, row -> (state, long).

    For recurrences that look back to a row chosen by the recurrence itself, which no window frame
    expresses. Keys are dealt by hash and sorted; memory is one state, whatever the key's size.
    ``step`` gets a dict of the row.
    """
    schema = StructType([*rows.schema.fields, StructField(name, LongType())])
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            out = []
            keys = [batch.column(c).to_pylist() for c in by]
            columns = [c.to_pylist() for c in batch.columns]
            for k, values in zip(zip(*keys, strict=True), zip(*columns, strict=True), strict=True):
                if state is None or k != key:
                    key, state = k, start()
                state, value = step(state, dict(zip(names, values, strict=True)))
                out.append(value)
            yield batch.append_column(name, pa.array(out, pa.int64()))

    return rows.repartition(*by).sortWithinPartitions(*by, *order).mapInArrow(run, schema)


def greedy_clusters(rows: DataFrame, by: list[str], order: list[str], at: str, end: str | None, width: int, name: str) -> DataFrame:
    """Numbers clusters (from 0) anchored to their first row.

    A row joins while it starts less than ``width`` after the cluster's first row and, if ``end`` is
    given, before the latest end so far. The window is anchored to the head, not to the row before, so it is a fold.
    """

    def step(state, row):
        number, head, last = state
        if head is not None and row[at] - head < width and (end is None or row[at] < last):
            last = max(last, row[end]) if end else None
        else:
            number, head, last = number + 1, row[at], row[end] if end else None
        return (number, head, last), number

    return folded(rows, by, order, lambda: (-1, None, None), step, name)


def monotone_chains(rows: DataFrame, by: list[str], order: list[str], label: Column, least_rows: int = 4) -> DataFrame:
    """Maximal greedy chains of one direction: by, start (row number from 0), n, direction.

    ``label`` of a row: direction (+1, -1) of the edge to the *next* row, 0 if they don't chain. Scanning left to
    right, a chain of at least ``least_rows`` rows uses up its rows, also the one where the direction turns, so a chain
    right after another begins an edge late. Without the scan: islands of equal labels longer
    than the least always chain; runs of islands of exactly the least alternate, from what stands before them.
    """
    least = least_rows - 1
    w = _w(by, order)
    e = rows.select(*by, (F.row_number().over(w) - 1).alias("_i"), F.when(F.lead(F.lit(1)).over(w).isNotNull(), label).alias("_label")).where("_label IS NOT NULL")
    e = islands(e, by, ["_i"], F.col("_label") != F.lag("_label").over(_w(by, ["_i"])), "_island")
    g = e.groupBy(*by, "_island").agg(F.min("_i").alias("start"), F.count("*").alias("edges"), F.first("_label").alias("direction"))
    wi = _w(by, ["_island"])
    exact = (F.col("direction") != 0) & (F.col("edges") == least)
    g = g.withColumn("_exact", exact).withColumn("_string", F.sum((~exact).cast("int")).over(_sofar(by, ["_island"])))
    ws = _w([*by, "_string"], ["_island"])
    # a string holds at most one island that is not exact: its first, the base
    g = g.withColumn("_base", F.first(F.when(~F.col("_exact"), (F.col("direction") != 0) & (F.col("edges") > least)).otherwise(F.lit(None))).over(ws.rowsBetween(Window.unboundedPreceding, 0)))
    g = g.withColumn("_has", F.first(~F.col("_exact")).over(ws.rowsBetween(Window.unboundedPreceding, 0)))
    c = F.row_number().over(ws) - 1 - F.col("_has").cast("int")
    g = g.withColumn("_c", c)
    chains = F.when(F.col("_exact"), F.when(F.coalesce("_base", F.lit(False)), F.col("_c") % 2 == 1).otherwise(F.col("_c") % 2 == 0)).otherwise((F.col("direction") != 0) & (F.col("edges") > least))
    g = g.withColumn("_chains", chains)
    g = g.withColumn("_late", F.coalesce(F.lag("_chains").over(wi), F.lit(False)).cast("int")).where("_chains")
    return g.select(*by, (F.col("start") + F.col("_late")).alias("start"), (F.col("edges") - F.col("_late") + 1).alias("n"), F.col("direction"))


def residual_runs(rows: DataFrame, by: list[str], order: list[str], reported: Column, contiguous: Callable[[Callable[[str], Column]], Column], least: int, name: str) -> DataFrame:
    """Runs of rows, each contiguous with the one before, that no reported row interrupts; rows of runs of at least ``least``."""
    w = _w(by, order)
    before = lambda c: F.lag(c).over(w)
    out = rows.withColumn("_reported", reported)
    out = out.withColumn("_breaks", F.col("_reported") | F.coalesce(before("_reported"), F.lit(True)) | ~F.coalesce(contiguous(before), F.lit(False)))
    out = islands(out, by, order, F.col("_breaks"), name).where("NOT _reported")
    return out.withColumn("_n", F.count("*").over(Window.partitionBy(*by, name))).where(F.col("_n") >= least).drop("_reported", "_breaks", "_n")


def gaps(rows: DataFrame, by: list[str], order: list[str], start: str, end: str) -> DataFrame:
    """Adds gap_before and gap_after: distances to the neighbours' end and start; null at the edges."""
    w = _w(by, order)
    return rows.withColumn("gap_before", F.col(start) - F.lag(end).over(w)).withColumn("gap_after", F.lead(start).over(w) - F.col(end))


def merged_order(frames: list[tuple[DataFrame, int]], by: list[str], at: str, seq: str, name: str) -> DataFrame:
    """Union of event sources in one order: time, the source's rank at equal times, then sequence."""
    out = None
    for frame, rank in frames:
        part = frame.withColumn("_rank", F.lit(rank))
        out = part if out is None else out.unionByName(part)
    return out.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(at, "_rank", seq))).drop("_rank")


def interpolated(rows: DataFrame, start: Column, end: Column, lo: Column, hi: Column, step: Column) -> DataFrame:
    """A row generator: points of a line from (start, lo) to (end, hi), ``step`` apart, at least one step; adds i, at, level (long)."""
    steps = F.greatest(F.lit(1).cast("long"), F.floor((end - start) / step))
    out = rows.withColumn("_steps", steps).withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_steps"))))
    at = start + F.floor((end - start) * F.col("i") / F.col("_steps"))
    level = lo + F.floor((hi - lo) * F.col("i") / F.col("_steps"))
    return out.withColumn("at", at).withColumn("level", level).drop("_steps")
