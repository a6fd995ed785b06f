"""Sinks (K1-K6).  All are distributed writes; nothing is collected to the driver.
The default save mode is ``errorifexists``; ``mode="overwrite"`` replaces a folder (K6),
and :func:`publish` replaces a result at one moment, for readers that must never see an
empty or a half-written one."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import UnsupportedOperationException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.pairing import assign_chunks
from .session import filesystem, materialize


def write_chunks(pairs: DataFrame, out: str, n: int, mode: str = "errorifexists",
                 total: Column | None = None) -> DataFrame:
    """K1: ``n`` gzip text files of interleaved pairs (mate 1 then mate 2, 8 lines per
    pair), chunk ``i`` holding the ``i``-th contiguous run of ordinals, ordered.

    ``repartitionById`` sends chunk ``i`` to partition ``i`` (one task, one file per
    non-empty chunk) and the sort inside it restores ordinal order: no global sort,
    no sampling job.  The pair count comes from ``total`` when the caller knows it
    from the inputs (:func:`strandline.operators.pairing.pair_count`: a line count, no
    join); otherwise the pairs are written once to the checkpoint folder so that the
    count and the write read the same materialised pairs.  Returns the assignment."""
    if total is None:
        pairs = materialize(pairs, "pairs")
    a = assign_chunks(pairs, n, total)
    (a.repartitionById(n, F.col("chunk")).sortWithinPartitions("record_id")
     .select("value").write.mode(mode).option("compression", "gzip").text(out))
    return a


def to_bed(ranges: DataFrame, name: str = "ref_name", end_shift: int = -1) -> DataFrame:
    """K2: ranges (1-based inclusive) as BED columns ``chrom, bed_start, bed_end``:
    ``start - 1`` and ``end + end_shift``.  The default ``-1`` is the literal output of
    the original; ``0`` gives correct half-open BED."""
    return ranges.select(F.col(name).alias("chrom"),
                         (F.col("start_pos") - 1).alias("bed_start"),
                         (F.col("end_pos") + F.lit(end_shift)).alias("bed_end"))


def to_region_strings(ranges: DataFrame, name: str = "ref_name") -> DataFrame:
    """K3: ranges as ``chrom:start-end`` strings (column ``region_string``)."""
    return ranges.select("*", F.concat(F.col(name), F.lit(":"), F.col("start_pos").cast("string"),
                                       F.lit("-"), F.col("end_pos").cast("string"))
                         .alias("region_string"))


def write_tsv(df: DataFrame, out: str, mode: str = "errorifexists") -> None:
    """Tab-separated text without header (BED, region lists)."""
    df.write.mode(mode).option("sep", "\t").option("header", "false").csv(out)


def write_vcf(variants: DataFrame, out: str, single_file: bool = False,
              mode: str = "errorifexists", header: Sequence[str] = ()) -> None:
    """K4: variant lines ordered by ``(chrom, pos, line)``.  A global sort (range
    partitioned) and a parallel write; on request one file (:func:`write_one_file`)."""
    v = variants.orderBy("chrom", "pos", "line").select(F.col("line").alias("value"))
    if single_file:
        write_one_file(v, out, header, mode)
    elif header:
        raise ValueError("a header needs single_file")
    else:
        v.write.mode(mode).text(out)


def write_one_file(lines: DataFrame, out: str, header: Sequence[str] = (), mode: str = "errorifexists") -> None:
    """Ordered lines as one file ``part-00000.txt`` in the folder ``out``, header first,
    without sending them through one task: the sorted partitions are written in parallel,
    and their files joined in order at file level - by the store itself where it can
    concatenate files, else as a copy of bytes through a fixed buffer.  The joined file is
    renamed into place last, so ``out`` never holds half of it."""
    spark = lines.sparkSession
    fs, folder = filesystem(spark, out)
    if fs.exists(folder) and mode != "overwrite":
        raise ValueError(f"{out} exists already")
    path = spark._jvm.org.apache.hadoop.fs.Path
    stage = f"{out.rstrip('/')}-{uuid.uuid4().hex}"
    lines.write.text(f"{stage}/parts")
    # a part's number is its partition's; Spark sorts the partitions by range
    parts = sorted((f.getPath() for f in fs.listStatus(path(f"{stage}/parts")) if f.getPath().getName().startswith("part-")),
                   key=lambda p: p.getName())
    whole = path(f"{stage}/whole/part-00000.txt")
    head = fs.create(whole, True)
    head.write(bytearray("".join(f"{h}\n" for h in header).encode()))
    head.close()
    _append_files(spark, fs, whole, parts)
    fs.delete(path(f"{stage}/parts"), True)
    if fs.exists(folder):
        fs.delete(folder, True)
    fs.mkdirs(folder)
    fs.rename(whole, path(folder, "part-00000.txt"))
    fs.delete(path(stage), True)


def _append_files(spark: SparkSession, fs, target, parts: list) -> None:
    if not parts:
        return
    jvm = spark._jvm
    array = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(parts))
    for i, p in enumerate(parts):
        array[i] = p
    try:
        fs.concat(target, array)
        return
    except UnsupportedOperationException:
        pass        # no such operation in this store: the header is copied, then the parts
    joined = target.suffix("-joined")
    to = fs.create(joined, True)
    for p in [target, *parts]:
        come = fs.open(p)
        jvm.org.apache.hadoop.io.IOUtils.copyBytes(come, to, 1 << 20, False)
        come.close()
    to.close()
    fs.delete(target, False)
    fs.rename(joined, target)


def write_by_region(df: DataFrame, out: str, col: str = "region",
                    mode: str = "errorifexists") -> None:
    """K5: one folder per region."""
    df.write.mode(mode).partitionBy(col).parquet(out)


def write_text_by_region(lines: DataFrame, out: str, col: str = "region", order: Sequence[str] = (),
                         mode: str = "errorifexists") -> None:
    """K5 as text: one folder of lines (column ``value``) per region.  With ``order`` the
    lines are range partitioned by region and order, so that a region's files, in name
    order, hold its lines in order - and no region meets in one task."""
    if order:
        n = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        lines = lines.repartitionByRange(n, col, *order).sortWithinPartitions(col, *order)
    lines.select(col, "value").write.mode(mode).partitionBy(col).text(out)


# ---- K6 at one moment ----------------------------------------------------------------

_POINTER = "_current"


def stage_version(df: DataFrame, out: str, partition_by: Sequence[str] = ()) -> str:
    """Write ``df`` as a new version of ``out`` that no reader sees yet; its name."""
    name = f"v-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").partitionBy(*partition_by).parquet(f"{out}/_versions/{name}")
    return name


def point_to(spark: SparkSession, out: str, version: str) -> None:
    """Make ``version`` the current one: a small pointer file is written beside the old
    one and renamed over it, the only step that readers can notice."""
    jvm = spark._jvm
    fs, folder = filesystem(spark, out)
    path = jvm.org.apache.hadoop.fs.Path
    new = path(folder, f"{_POINTER}-{uuid.uuid4().hex}")
    to = fs.create(new, True)
    to.write(bytearray(version.encode()))
    to.close()
    how = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(how, 1)
    options[0] = how.OVERWRITE
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    files.rename(fs.makeQualified(new), fs.makeQualified(path(folder, _POINTER)), options)


def publish(df: DataFrame, out: str, partition_by: Sequence[str] = (), keep: int = 2) -> None:
    """K6: replace the result at ``out`` at one moment.  The new version is written whole
    into a folder of its own, then the pointer is moved.  A job that dies before leaves
    the old result current, a retried one writes a new version; readers get one version
    or the other, never a mixture.  The ``keep`` latest versions stay for readers that
    have begun; older ones, and what dead jobs left, are deleted."""
    if keep < 1:
        raise ValueError("the current version is kept")
    spark = df.sparkSession
    before = current_version(spark, out)
    version = stage_version(df, out, partition_by)
    point_to(spark, out, version)
    fs, folder = filesystem(spark, f"{out}/_versions")
    held = {version, before} if keep > 1 else {version}
    others = sorted((f for f in fs.listStatus(folder) if f.getPath().getName() not in held),
                    key=lambda f: f.getModificationTime(), reverse=True)
    for f in others[max(0, keep - len(held)):]:
        fs.delete(f.getPath(), True)


def current_version(spark: SparkSession, out: str) -> str | None:
    fs, pointer = filesystem(spark, f"{out}/{_POINTER}")
    if not fs.exists(pointer):
        return None
    come = fs.open(pointer)
    text = spark._jvm.org.apache.commons.io.IOUtils.toString(come, "UTF-8")
    come.close()
    return text


def read_published(spark: SparkSession, out: str) -> DataFrame:
    """The current version of a result written by :func:`publish`."""
    version = current_version(spark, out)
    if version is None:
        raise ValueError(f"nothing has been published at {out}")
    return spark.read.parquet(f"{out}/_versions/{version}")
