"""What the operators share: the word pattern, id remainders, written tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.session import checkpoint_dir, materialize, materialize_counted

__all__ = ["WORD", "batches", "broadcast_bytes", "checkpoint_dir", "crc_rem", "docs_of",
           "materialize", "materialize_counted", "per_row", "table"]

#: A word: a run of anything but the space and the controls from tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_rem(col: str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % mod


def docs_of(df: DataFrame, *cols: str, text: str = "text") -> DataFrame:
    """The named columns and the text as bytes (null: empty).  Taking columns by name
    leaves any extra columns of the caller, whatever they are called, behind."""
    return df.select(*cols, F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"))


def batches(schema: pa.Schema, rows: Iterable[tuple], size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Row tuples as record batches of at most ``size`` rows."""
    part: list[tuple] = []
    for r in rows:
        part.append(r)
        if len(part) >= size:
            yield _batch(schema, part)
            part = []
    if part:
        yield _batch(schema, part)


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    cols = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, schema.types)], schema=schema)


def broadcast_bytes(spark: SparkSession, what: str, value: object, size: int, bound: int):
    """Broadcast ``value`` after checking its size in bytes against ``bound``."""
    if size > bound:
        raise ValueError(f"{what}: {size} bytes exceed the broadcast bound of {bound}")
    return spark.sparkContext.broadcast(value)


def per_row(fn: Callable[[Iterator[tuple]], Iterator[tuple]], schema: pa.Schema, size: int = 4096):
    """A ``mapInArrow`` function from a function over the row tuples of a partition."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for b in it:
                yield from zip(*(c.to_pylist() for c in b.columns))
        yield from batches(schema, fn(rows()), size)
    return run
