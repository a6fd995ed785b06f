"""FASTQ records, mate pairing and chunk assignment (P1, A1, J1, K1's assignment, O1).

Lines carry a stable 0-based ordinal ``idx`` (see :func:`strandline.sources.fastq.read_fastq`).
Record ``idx div 4`` is folded from its four lines by an order-independent aggregation
(``max(when(role == i, line))``), which needs no ordering of lines inside a group and is
combined map-side.  Both mates are grouped by the same key, so the mate join reuses
their hash partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The four lines of a FASTQ record, in order.
FASTQ_FIELDS = ["name", "seq", "plus", "qual"]


def with_record_id(lines: DataFrame, idx: str = "idx") -> DataFrame:
    """``record_id = idx div 4`` and ``role = idx % 4``."""
    return lines.select(F.col(idx).cast("long").alias("idx"), "line",
                        (F.col(idx) / 4).cast("long").alias("record_id"),
                        (F.col(idx) % 4).cast("int").alias("role"))


def group_records(lines: DataFrame) -> DataFrame:
    """A1: fold the four lines of each record into ``record_id, name, seq, plus, qual``."""
    x = lines if "record_id" in lines.columns else with_record_id(lines)
    return x.groupBy("record_id").agg(*[
        F.max(F.when(F.col("role") == i, F.col("line"))).alias(f)
        for i, f in enumerate(FASTQ_FIELDS)])


def pair_mates(first: DataFrame, second: DataFrame) -> DataFrame:
    """Inner equi-join of mate-1 and mate-2 records on the ordinal; records without
    a mate (the longer file's tail) are dropped.  Columns get suffixes 1 and 2."""
    a = first.select("record_id", *[F.col(f).alias(f"{f}1") for f in FASTQ_FIELDS])
    b = second.select("record_id", *[F.col(f).alias(f"{f}2") for f in FASTQ_FIELDS])
    return a.join(b, "record_id", "inner")


def interleaved_text(pairs: DataFrame) -> Column:
    """The 8 text lines of a pair: mate-1 record, then mate-2 record."""
    return F.concat_ws("\n", *[F.col(f"{f}{m}") for m in (1, 2) for f in FASTQ_FIELDS])


def pair_count(lines1: DataFrame, lines2: DataFrame) -> Column:
    """The number of mate pairs, from the two line sources alone (no join): record ids
    are contiguous per file, so the inner join keeps ``min`` of the record counts,
    each ``ceil(lines / 4)``.  A scalar subquery column."""
    def records(lines: DataFrame) -> Column:
        return lines.agg(((F.count(F.lit(1)) + 3) / 4).cast("long")).scalar()
    return F.least(records(lines1), records(lines2))


def assign_chunks(pairs: DataFrame, n: int, total: Column | None = None) -> DataFrame:
    """K1/O1 assignment: ``chunk = record_id * n div total`` over the pair count, so
    ``n`` contiguous, equal (+-1) runs of the ordinal.  ``total`` is a scalar subquery
    (by default the count of ``pairs``; :func:`pair_count` gets it from the inputs),
    planned with the query instead of collected by hand."""
    if total is None:
        total = pairs.agg(F.count(F.lit(1))).scalar()
    scaled = F.col("record_id") * F.lit(n)
    # integer division: (a - a mod total) / total is an exact multiple, so no rounding
    chunk = ((scaled - F.pmod(scaled, total)) / total).cast("long").cast("int")
    return pairs.select(chunk.alias("chunk"), "record_id", interleaved_text(pairs).alias("value"))
