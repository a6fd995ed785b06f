"""FASTQ and chunk sources."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import broadcast_checked, materialize


def read_indexed_lines(spark: SparkSession, path: str, glob: str | None = None,
                       with_file: bool = False) -> DataFrame:
    """Text lines as ``idx, value`` (plus ``file_path`` with ``with_file``) with the
    0-based line ordinal over the file(s), files taken in path order.

    A text scan packs file splits into partitions by size, so partition order is not
    file order.  Each row therefore records its split (``file_path``,
    ``file_block_start``) and a per-partition row id; rows of one split are contiguous
    in one partition, so ``id - min(id of split)`` is the line number inside the split.
    Per-split line counts (one row per split) give the offsets through a running sum,
    and are joined back by broadcast after a size check.  All JVM-side.  The scan is
    written once with its ids, and both the counts and the lines come from that table:
    how a later job cuts the files into splits (that depends on the cores it finds)
    cannot part them."""
    r = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    lines = materialize(r.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_f"),
        F.col("_metadata.file_block_start").alias("_b"),
        F.monotonically_increasing_id().alias("_mid")), "lines")
    splits = lines.groupBy("_f", "_b").agg(F.count(F.lit(1)).alias("_c"),
                                           F.min("_mid").alias("_m0"))
    w = Window.orderBy("_f", "_b").rowsBetween(Window.unboundedPreceding, -1)
    offs = splits.select("_f", "_b", "_m0",
                         F.coalesce(F.sum("_c").over(w), F.lit(0)).alias("_off"))
    offs = broadcast_checked(offs, "line_splits")
    return (lines.join(offs, ["_f", "_b"], "inner")
            .select((F.col("_off") + F.col("_mid") - F.col("_m0")).alias("idx"), "value",
                    *([F.col("_f").alias("file_path")] if with_file else [])))


def read_fastq(spark: SparkSession, path: str) -> DataFrame:
    """FASTQ text as ``idx, line`` (see :func:`read_indexed_lines`)."""
    return read_indexed_lines(spark, path).withColumnRenamed("value", "line")


def read_chunk_pairs(spark: SparkSession, folder: str, glob: str = "*.gz") -> DataFrame:
    """Chunk files written by :func:`strandline.sinks.write_chunks` back as one row per
    mate pair: ``chunk_file, pair_id, name1, seq1, plus1, qual1, name2, seq2, plus2,
    qual2`` - the input of an aligner plugged in with
    :func:`strandline.operators.hooks.map_chunks`.  Every chunk holds whole pairs of 8
    lines, so with ordinals over the files (in path order) ``idx div 8`` is the pair.  A
    gzip file is read by one task from its first line on, which folds 8 lines at a time
    (:func:`_gzip_pairs`: no line is written or shuffled); other files can be split, and
    their lines are folded order-independently (one partially aggregated shuffle)."""
    if glob.endswith(".gz"):
        return _gzip_pairs(spark, folder, glob)
    lines = read_indexed_lines(spark, folder, glob, with_file=True)
    x = lines.select((F.col("idx") / 8).cast("long").alias("pair_id"),
                     (F.col("idx") % 8).cast("int").alias("_k"), "value",
                     F.col("file_path").alias("_f"))
    names = _PAIR_FIELDS
    return x.groupBy("pair_id").agg(
        F.substring_index(F.max("_f"), "/", -1).alias("chunk_file"),
        *[F.max(F.when(F.col("_k") == i, F.col("value"))).alias(n) for i, n in enumerate(names)])


_PAIR_FIELDS = ["name1", "seq1", "plus1", "qual1", "name2", "seq2", "plus2", "qual2"]


def _gzip_pairs(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    lines = (spark.read.option("pathGlobFilter", glob).text(folder)
             .select(F.col("_metadata.file_path").alias("_f"), "value"))
    # one row per file: its first line's ordinal over all files
    w = Window.orderBy("_f").rowsBetween(Window.unboundedPreceding, -1)
    counts = lines.groupBy("_f").agg(F.count(F.lit(1)).alias("_c"))
    offs = broadcast_checked(counts.select("_f", F.coalesce(F.sum("_c").over(w), F.lit(0)).alias("_off")), "chunk_files")
    folded = lines.mapInArrow(_fold_pairs, "_f string, _k long, " + ", ".join(f"{c} string" for c in _PAIR_FIELDS))
    return folded.join(offs, "_f").select(F.substring_index("_f", "/", -1).alias("chunk_file"),
                                          ((F.col("_off") / 8).cast("long") + F.col("_k")).alias("pair_id"), *_PAIR_FIELDS)


def _fold_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, number of the pair in it, 8 lines) from (file, line) in order; the lines of a
    batch that end within a pair wait for the next batch of the same file."""
    names = ["_f", "_k", *_PAIR_FIELDS]
    file, k, wait = None, 0, pa.array([], pa.string())

    def pairs(lines: pa.Array, n: int) -> pa.RecordBatch:
        at = np.arange(n) * 8
        # a file's last pair may lack lines: null
        cols = [lines.take(pa.array(at + i, pa.int64(), mask=at + i >= len(lines))) for i in range(8)]
        return pa.RecordBatch.from_arrays([pa.array([file] * n, pa.string()), pa.array(np.arange(k, k + n), pa.int64()), *cols], names)

    for b in batches:
        if not b.num_rows:
            continue
        runs = b.column(0).dictionary_encode()
        code = runs.indices.to_numpy()
        edge = [0, *(np.flatnonzero(np.diff(code)) + 1).tolist(), len(code)]
        for lo, hi in zip(edge, edge[1:]):
            here = runs.dictionary[int(code[lo])].as_py()
            if here != file:
                if len(wait):
                    yield pairs(wait, 1)
                file, k, wait = here, 0, pa.array([], pa.string())
            lines = pa.concat_arrays([wait, b.column(1).slice(lo, hi - lo).cast(pa.string())])
            n = len(lines) // 8
            if n:
                yield pairs(lines, n)
            k, wait = k + n, lines.slice(8 * n)
    if len(wait):
        yield pairs(wait, 1)


def read_chunks(spark: SparkSession, folder: str, glob: str = "*.fq.gz") -> DataFrame:
    """All chunk files of a folder (any Hadoop URI) matching ``glob``, as
    ``chunk_file, value``.  Gzip files are decompressed; each is one task."""
    df = spark.read.option("pathGlobFilter", glob).text(folder)
    return df.select(F.col("_metadata.file_name").alias("chunk_file"), "value")
