"""User-function seams (F1, F2): where a user plugs an aligner (per chunk of reads)
or a caller (per region of reads).  The library ships no aligner or caller.

* :func:`map_chunks`, :func:`map_regions` - the function sees Arrow batches, one at a
  time; combining partial per-batch results is the caller's ``groupBy``.
* :func:`map_chunk_streams` - the function sees a whole chunk, in order, as an iterator
  of batches: it can hold state, or be one external process, for a chunk.
* :func:`map_regions_halo` - the function sees a bounded region together with the reads
  around it, and keeps the results of the region itself.

No form collects a chunk or a region of unbounded size into one pandas frame.
"""

from __future__ import annotations

import subprocess
import threading
from collections.abc import Callable, Iterator, Sequence
from itertools import groupby
from operator import itemgetter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_checked, materialize
from .regions import coordinate_sort

BatchFn = Callable[[pd.DataFrame], pd.DataFrame]


def _per_batch(fn: BatchFn):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = fn(pdf)
            if out is not None and len(out):
                yield out
    return run


def map_chunks(df: DataFrame, fn: BatchFn, schema) -> DataFrame:
    """apply ``fn`` to every batch of reads (each row keeps its ``chunk``) and
    flatten the results.  Reads of a chunk are independent (an aligner maps each read
    or pair on its own), so batches are the natural unit and chunk files are read in
    parallel splits."""
    return df.mapInPandas(_per_batch(fn), schema)


def map_regions(df: DataFrame, fn: BatchFn, schema, num_partitions: int | None = None,
                order=("region", "ref_idx", "pos", "qname")) -> DataFrame:
    """apply ``fn`` to reads in coordinate order.  Reads are laid out by
    :func:`coordinate_sort` (range partitioned on region and coordinate, sorted inside
    each partition), so every batch ``fn`` sees is sorted and a region's reads arrive
    as consecutive batches over consecutive partitions; every region is processed,
    and an empty input gives an empty output."""
    laid = coordinate_sort(df, num_partitions, order)
    return laid.mapInPandas(_per_batch(fn), schema)


# ---- F1 on whole chunks -------------------------------------------------------------

ChunkFn = Callable[[object, Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]


def _runs(batches: Iterator[pd.DataFrame], col: str) -> Iterator[tuple[object, pd.DataFrame]]:
    """The batches cut where ``col`` changes, each part with its value (null: None)."""
    for pdf in batches:
        codes, _ = pd.factorize(pdf[col], use_na_sentinel=False)
        cuts = np.flatnonzero(codes[1:] != codes[:-1]) + 1
        for a, b in zip([0, *cuts], [*cuts, len(pdf)]):
            if b > a:
                v = pdf[col].iloc[a]
                yield (None if pd.isna(v) else v.item() if hasattr(v, "item") else v), pdf.iloc[a:b].reset_index(drop=True)


def map_chunk_streams(df: DataFrame, fn: ChunkFn, schema, order: Sequence[str], chunk: str = "chunk",
                      num_partitions: int | None = None) -> DataFrame:
    """F1 for functions that need a chunk as a whole: ``fn(chunk, batches)`` is called
    once per chunk with an iterator over the chunk's rows in ``order``, and yields frames
    of ``schema``.

    Rows are hash partitioned by chunk and sorted by chunk and ``order``; a task hands its
    sorted Arrow batches on, cut at the chunk borders, so memory is one batch whatever the
    chunk holds.  A chunk is one call in one task: how large chunks are is the caller's
    choice when they are assigned (``assign_chunks``), and their number grows with the
    data.  Rows without a chunk are one chunk, ``None``; an empty input makes no call."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for value, parts in groupby(_runs(batches, chunk), key=itemgetter(0)):
            for out in fn(value, (p for _, p in parts)):
                if out is not None and len(out):
                    yield out

    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, chunk).sortWithinPartitions(chunk, *order).mapInPandas(run, schema)


def chunk_process(command: Callable[[object], list[str]], column: str = "value", batch: int = 8192) -> ChunkFn:
    """A ``fn`` for :func:`map_chunk_streams` that runs one external process per chunk:
    ``command(chunk)`` gives its arguments, the chunk's lines (``column``) go to its
    standard input in order, and its output lines come back as ``chunk, value``.  Input is
    written while output is read; a process that fails fails the task, with its error
    output, so a retried task starts the chunk anew."""
    def fn(chunk, batches):
        p = subprocess.Popen(command(chunk), stdin=subprocess.PIPE, stdout=subprocess.PIPE, stderr=subprocess.PIPE)
        said: list[bytes] = []
        failed: list[BaseException] = []

        def feed():
            try:
                for pdf in batches:
                    p.stdin.write("".join(f"{x}\n" for x in pdf[column]).encode())
                p.stdin.close()
            except BrokenPipeError:
                pass                        # the exit code tells why it stopped reading
            except BaseException as e:      # told to the task below
                failed.append(e)
                p.kill()
        threads = [threading.Thread(target=feed), threading.Thread(target=lambda: said.append(p.stderr.read()))]
        for t in threads:
            t.start()
        lines: list[str] = []
        for line in p.stdout:
            lines.append(line.decode("utf-8", "replace").rstrip("\n"))
            if len(lines) >= batch:
                yield pd.DataFrame({"chunk": [chunk] * len(lines), "value": lines})
                lines = []
        for t in threads:
            t.join()
        if failed:
            raise failed[0]
        if p.wait():
            raise RuntimeError(f"chunk {chunk}: process ended with {p.returncode}: {said[0][-2000:].decode('utf-8', 'replace')}")
        if lines:
            yield pd.DataFrame({"chunk": [chunk] * len(lines), "value": lines})
    return fn


# ---- F2 with context ------------------------------------------------------------------

RegionFn = Callable[[pd.DataFrame, tuple], pd.DataFrame]

HALO_BIN = 1 << 16
HALO = 200
HALO_LEVELS = 10
HALO_ROWS = 200_000


def _met(level: Column, start: Column, end: Column, bin_size: int, halo: int) -> Column:
    """Bins of a level whose region and halo an interval (1-based, inclusive) reaches."""
    width = F.call_function("shiftright", F.lit(bin_size).cast("long"), level)
    return F.sequence(F.floor((start - 1 - halo) / width).cast("long"), F.floor((end - 1 + halo) / width).cast("long"))


def halo_bins(reads: DataFrame, bin_size: int = HALO_BIN, halo: int = HALO, max_rows: int = HALO_ROWS, levels: int = HALO_LEVELS,
              key: str = "ref_idx", start: str = "pos", end: str = "end_pos") -> DataFrame:
    """``key, _level, _bin``: regions that tile every contig, each with at most
    ``max_rows`` reads in it and its halo.  A bin with more is halved, up to ``levels``
    times (level ``k`` bins are ``bin_size >> k`` wide).  Reads are counted once for all
    levels, pre-aggregated by start and end; a region whose narrowest bin still holds more
    than ``max_rows`` is an error, never cut."""
    if bin_size >> levels < 1:
        raise ValueError("bin_size cannot be halved that often")
    spots = reads.groupBy(key, F.col(start).alias("_s"), F.col(end).alias("_e")).agg(F.count(F.lit(1)).alias("_n"))
    ks = F.explode(F.sequence(F.lit(0), F.lit(levels))).alias("_level")
    at = spots.select(key, "_s", "_e", "_n", ks).select(
        key, "_level", "_n", F.explode(_met(F.col("_level"), F.col("_s"), F.col("_e"), bin_size, halo)).alias("_bin"))
    counts = materialize(at.groupBy(key, "_level", "_bin").agg(F.sum("_n").alias("_n")), "halo_counts")
    deep = counts.where(F.col("_n") > max_rows)
    worst = deep.where(F.col("_level") == levels).orderBy(F.desc("_n")).limit(1).collect()
    if worst:
        w = worst[0]
        raise ValueError(f"{w['_n']} reads around bases {w['_bin'] * (bin_size >> levels) + 1} and on of {key} {w[key]} exceed max_rows = {max_rows}")
    above = deep.select(key, (F.col("_level") + 1).alias("_level"), F.col("_bin").alias("_above"))
    fit = counts.where(F.col("_n") <= max_rows).withColumn("_above", F.floor(F.col("_bin") / 2).cast("long"))
    # a fitting bin whose parent does not fit; counts only fall from parent to child
    return (fit.where("_level = 0").select(key, "_level", "_bin")
            .unionByName(fit.join(above, [key, "_level", "_above"]).select(key, "_level", "_bin")))


def map_regions_halo(reads: DataFrame, fn: RegionFn, schema: str, at: str, bin_size: int = HALO_BIN, halo: int = HALO,
                     max_rows: int = HALO_ROWS, levels: int = HALO_LEVELS, key: str = "ref_idx", start: str = "pos",
                     end: str = "end_pos", order: Sequence[str] = ()) -> DataFrame:
    """F2 with context: ``fn(frame, (contig, first, last))`` gets the reads that reach into
    bases ``first .. last`` (1-based, inclusive) or within ``halo`` bases of them, sorted by
    start, end and ``order``, and returns rows of ``schema``; those whose column ``at`` lies
    in ``first .. last`` are kept.  Every base belongs to one region, so a function whose
    result at a position depends on reads within ``halo`` bases gives the same rows for any
    ``bin_size``, ``max_rows``, partitioning or batch size.

    Reads are replicated to the few regions they reach (:func:`halo_bins`) and grouped by
    region: a group has at most ``max_rows`` reads, and deep regions are narrower ones, so
    a hot locus spreads over many groups.  Ties beyond ``order`` are in no defined order."""
    bins = broadcast_checked(halo_bins(reads, bin_size, halo, max_rows, levels, key, start, end), "halo_bins")
    used = sorted(r["_level"] for r in bins.select("_level").distinct().collect())      # levels + 1 at most
    if not used:
        used = [0]
    ks = F.explode(F.array(*(F.lit(k) for k in used))).alias("_level")
    spread = reads.select("*", ks).select("*", F.explode(_met(F.col("_level"), F.col(start), F.col(end), bin_size, halo)).alias("_bin"))
    met = spread.join(bins, [key, "_level", "_bin"])
    sort = [start, end, *order]

    def run(group: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        contig, level, number = group
        width = bin_size >> int(level)
        first, last = int(number) * width + 1, (int(number) + 1) * width
        frame = frame.drop(columns=["_level", "_bin"]).sort_values(sort, kind="stable", ignore_index=True)
        out = fn(frame, (contig, first, last))
        return out[(out[at] >= first) & (out[at] <= last)]

    return met.groupBy(key, "_level", "_bin").applyInPandas(run, schema)
