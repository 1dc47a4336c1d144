"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import cache
from pathlib import Path
from zipfile import ZipFile

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.session import work_path


@cache
def _shipped(app_id: str) -> str:
    """Zip of the package, for executors that do not have it installed; one for each application."""
    package = Path(__file__).resolve().parents[1]
    folder = Path(SparkFiles.getRootDirectory()) / "packed"
    folder.mkdir(exist_ok=True)
    target = folder / f"{package.name}.zip"
    with ZipFile(target, "w") as packed:
        for path in sorted(package.rglob("*.py")):
            packed.write(path, path.relative_to(package.parent))
    return str(target)


def map_batches(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema
) -> DataFrame:
    """``mapInArrow`` with this package at hand on every executor."""
    context = df.sparkSession.sparkContext
    if not getattr(context, "_pricelake_packed", False):
        context.addPyFile(_shipped(context.applicationId))
        context._pricelake_packed = True

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            give_back()

    return df.mapInArrow(of_batches, schema)


def give_back() -> None:
    """Hand freed memory back to the system: Python workers live on between tasks and stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Parts of a few rows of each batch, so that Python objects are made for a part at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def stage(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write rows to the shared folder and go on from the files, so a lost executor costs a read.

    Returns the frame and the folder, for ``discard``.
    """
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def whole_text(text: str | Column) -> Column:
    """The text, with NULL as the empty one."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def id_remainder(key: str, divisor: int) -> Column:
    """crc32 of a key as text, modulo ``divisor``. A NULL key counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % divisor


def row_digest(key: str, text: str) -> Column:
    """One binary key for a document by its id and its text, never NULL: equal rows share it and share what is derived from it."""
    marked = F.concat(F.coalesce(F.col(key).cast("string"), F.lit("\x00")), F.lit("\x01"), whole_text(text))
    return F.unhex(F.md5(marked.cast("binary")))


def runs(copies: Column, name: str, run: int = 100_000) -> tuple[Column, Callable[[Column], Column]]:
    """Two generators that number ``copies`` rows from 1 without one array of that many entries."""
    starts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((copies - 1) / run)))
    return starts, lambda start: F.explode(F.sequence(start * run + 1, F.least((start + 1) * run, copies))).alias(name)


def words(text: str) -> list[bytes]:
    """Lower-case A-Z, then the runs of bytes other than space and 0x09-0x0D, in order.

    ``bytes.lower`` changes ASCII letters only and ``bytes.split`` splits at those six bytes only.
    """
    return text.encode("utf-8", "surrogatepass").lower().split()


