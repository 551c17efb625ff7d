"""Shared plumbing of the training-data operators."""

from __future__ import annotations

import atexit
import ctypes
import gc
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: The white space that separates words in every contract: space and U+0009 to U+000D.
BLANK = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder, read by Spark (any file system)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def folder(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir`` of the session.

    Where that is unset, a folder of our own on a local master only; on a cluster other machines wouldn't see it.
    """
    context = spark.sparkContext
    found = context.getCheckpointDir()
    if found is None:
        found = spark.conf.get("spark.checkpoint.dir", None)
        if not found:
            if not re.fullmatch(r"local(\[.*\])?", context.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
            found = tempfile.mkdtemp(prefix="seqloom-checkpoint-")
            atexit.register(shutil.rmtree, found, ignore_errors=True)
        context.setCheckpointDir(found)
        found = context.getCheckpointDir()
    return found


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from the files, which outlive lost executors.

    ``drop`` deletes them; those that a returned table still reads stay until the session's folder goes.
    """
    folder(df.sparkSession)
    out = df.checkpoint(eager=True)
    out._files = out._jdf.queryExecution().analyzed().rdd().getCheckpointFile().get()
    _made.append(out._files)
    return out


def written(df: DataFrame) -> DataFrame:
    """``cut`` for wide tables: Parquet, which is compressed, in the same folder."""
    path = f"{folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._files = path
    _made.append(path)
    return out


def drop(*frames: DataFrame) -> None:
    """Delete the files of tables made by ``cut`` or ``written`` that nothing reads any more."""
    for df in frames:
        _delete(df.sparkSession, df._files)


def _delete(spark: SparkSession, file: str) -> None:
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(file)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


#: Files of the tables made so far, in order.
_made: list[str] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """At its end all tables made within it are deleted but those handed to the function it gives."""
    begin, kept = len(_made), set()

    def keep(df: DataFrame) -> DataFrame:
        kept.add(df._files)
        return df

    yield keep
    for file in _made[begin:]:
        if file not in kept:
            _delete(spark, file)
    _made[begin:] = [f for f in _made[begin:] if f in kept]


def release(df: DataFrame) -> None:
    """Let Spark's cleaner drop the shuffle files of what nobody refers to any more.

    The cleaner acts when the driver collects its garbage, by itself only every half hour.
    """
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()


def utf8(column: str | Column) -> Column:
    """A text column; null counts as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def free(columns: list[str], name: str) -> str:
    """A column name like ``name`` that none of the columns has, whatever the case."""
    taken = {c.lower() for c in columns}
    while name in taken:
        name += "_"
    return name


def rows(batches: Iterator[pa.RecordBatch], most: int = 2048) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``most`` rows, so that memory per batch stays bounded."""
    for batch in batches:
        for at in range(0, batch.num_rows, most):
            yield batch.slice(at, most)


def batch_of(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)


#: What workers keep from task to task: functions with a ``cache_clear``.
caches: list = []


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, after whose end the worker gives back what other operators' tasks left it with, too; for operators without caches."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        given_back(True)

    return whole


def trimmed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, after whose end the worker gives back freed memory, caches stay."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        given_back(False)

    return whole


def given_back(clear: bool) -> None:
    """Hand freed memory back to the system. Workers live on after a task, and the allocators would keep what it took at most."""
    for f in caches if clear else ():
        f.cache_clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
    if trim:
        trim(0)


@lru_cache(maxsize=4)
def tokenizer(path: str):
    """A ``tokenizers`` tokenizer, loaded once per worker."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


caches.append(tokenizer)


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file; the same on the driver and the executors."""
    import public_tokenizers

    return public_tokenizers.path(name)
