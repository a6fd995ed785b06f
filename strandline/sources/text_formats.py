"""Parsers for the text formats the pipeline reads: SAM (S3), sequence dictionary
(S4), VCF (S5, S7) and BED (S6).

Every parser takes a ``lines`` DataFrame (column ``value``, plus ``idx`` where line
order matters) so the same code serves files (``spark.read.text``) and derived data.
Parsing is column expressions only (``split``, ``try_cast``): bad lines never stop a
scan; they are kept with their fields null and the text in ``_corrupt``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.chrom import chrom_number
from ..session import broadcast_checked


# The 11 mandatory SAM columns, in order.
SAM_FIELDS = ["qname", "flag", "rname", "pos", "mapq", "cigar", "rnext", "pnext",
              "tlen", "seq", "qual"]


def read_lines(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Text lines of a file or folder as ``value``."""
    r = spark.read
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.text(path)


def parse_sam(lines: DataFrame, seq_dict: DataFrame | None = None) -> DataFrame:
    """S3: SAM text to alignments, leniently.

    Header lines (``@``) are dropped.  A line with fewer than 11 tab-separated fields or
    a non-integer FLAG / POS / MAPQ is kept as a corrupt row: all fields null, the text
    in ``_corrupt``.  With a dictionary, ``ref_idx`` is the contig's index (``-1`` for
    ``*``, null for a name not in the dictionary); the dictionary is broadcast after a
    size check.

    SAM has no unique read key (a name is shared by mates, secondary and supplementary
    records), so one is assigned at ingestion: when ``lines`` carries the line ordinal
    ``idx`` (:func:`strandline.sources.fastq.read_indexed_lines`), it becomes
    ``read_id``."""
    ids = ["read_id"] if "idx" in lines.columns else []
    rid = [F.col("idx").alias("read_id")] if ids else []
    body = lines.filter(~F.col("value").startswith("@"))
    f = F.split(F.col("value"), "\t")
    parsed = body.select(
        *rid, F.col("value"),
        F.size(f).alias("_nf"),
        *[F.try_element_at(f, F.lit(i + 1)).alias(f"_{n}") for i, n in enumerate(SAM_FIELDS)])
    flag = F.col("_flag").try_cast("int")
    pos = F.col("_pos").try_cast("long")
    mapq = F.col("_mapq").try_cast("int")
    ok = (F.col("_nf") >= 11) & flag.isNotNull() & pos.isNotNull() & mapq.isNotNull()

    def keep(c):
        return F.when(ok, c)

    out = parsed.select(
        *ids,
        keep(F.col("_qname")).alias("qname"), keep(flag).alias("flag"),
        keep(F.col("_rname")).alias("ref_name"), keep(pos).alias("pos"),
        keep(mapq).alias("mapq"), keep(F.col("_cigar")).alias("cigar"),
        keep(F.col("_seq")).alias("seq"), keep(F.col("_qual")).alias("qual"),
        F.when(~ok, F.col("value")).alias("_corrupt"))
    if seq_dict is None:
        return out
    d = broadcast_checked(seq_dict.select(F.col("ref_name").alias("_rn"),
                                          F.col("ref_idx").alias("_ri")), "seq_dict")
    j = out.join(d, out["ref_name"] == d["_rn"], "left")
    ref_idx = (F.when(F.col("ref_name") == "*", F.lit(-1))
               .otherwise(F.col("_ri")).cast("int"))
    return j.select(*ids, "qname", "flag", "ref_name",
                    ref_idx.alias("ref_idx"), "pos", "mapq", "cigar", "seq", "qual", "_corrupt")


def parse_dict(lines: DataFrame) -> DataFrame:
    """Sequence dictionary.  ``lines`` has ``idx`` (0-based line ordinal) and
    ``value``; the first line is a header.  Fields are whitespace-separated; name and
    length follow the ``:`` of the 2nd and 3rd field; a length that is not an integer
    reads as 0.  ``ref_idx`` is the line's position after the header."""
    body = lines.filter(F.col("idx") >= 1)
    f = F.split(F.col("value"), r"\s+")

    def after_colon(c):
        # no ':' -> instr is 0 -> the whole field
        return c.substr(F.instr(c, ":") + 1, F.length(c))

    name = after_colon(F.try_element_at(f, F.lit(2)))
    length = F.coalesce(after_colon(F.try_element_at(f, F.lit(3))).try_cast("int"), F.lit(0))
    return body.select((F.col("idx") - 1).cast("int").alias("ref_idx"),
                       name.alias("ref_name"), length.alias("ref_length"))


def parse_vcf(lines: DataFrame) -> DataFrame:
    """VCF body lines (those starting ``chr``) as ``chrom, pos, line``; ``chrom`` is
    the chromosome number (X = 23, Y = 24; null when not numeric, e.g. ``chrM``)."""
    body = lines.filter(F.col("value").startswith("chr"))
    f = F.split(F.col("value"), "\t")
    return body.select(chrom_number(F.try_element_at(f, F.lit(1))).alias("chrom"),
                       F.try_element_at(f, F.lit(2)).try_cast("int").alias("pos"),
                       F.col("value").alias("line"))


def read_known_sites(lines: DataFrame, seq_dict: DataFrame) -> DataFrame:
    """Known variant sites from a VCF: every non-header line's contig and position,
    mapped to ``ref_idx`` through the dictionary, distinct: ``ref_idx, ref_pos``."""
    body = lines.filter(~F.col("value").startswith("#"))
    f = F.split(F.col("value"), "\t")
    sites = body.select(F.try_element_at(f, F.lit(1)).alias("_rn"),
                        F.try_element_at(f, F.lit(2)).try_cast("long").alias("ref_pos"))
    d = broadcast_checked(seq_dict.select(F.col("ref_name").alias("_rn"), "ref_idx"), "seq_dict")
    return (sites.join(d, "_rn", "inner").filter(F.col("ref_pos").isNotNull())
            .select("ref_idx", "ref_pos").distinct())


BED_SCHEMA = T.StructType([T.StructField("chrom", T.StringType()),
                           T.StructField("bstart", T.LongType()),
                           T.StructField("bend", T.LongType())])


def parse_bed(lines: DataFrame) -> DataFrame:
    """BED intervals (0-based half-open) ``chrom, bstart, bend``; ``track``,
    ``browser`` and ``#`` lines are skipped."""
    v = F.col("value")
    body = lines.filter(~(v.startswith("#") | v.startswith("track") | v.startswith("browser"))
                        & (F.length(F.trim(v)) > 0))
    f = F.split(v, "\t")
    return body.select(F.try_element_at(f, F.lit(1)).alias("chrom"),
                       F.try_element_at(f, F.lit(2)).try_cast("long").alias("bstart"),
                       F.try_element_at(f, F.lit(3)).try_cast("long").alias("bend"))


def read_bed(spark: SparkSession, path: str) -> DataFrame:
    """S6 from files."""
    return parse_bed(spark.read.text(path))


def bed_with_ref_idx(bed: DataFrame, seq_dict: DataFrame) -> DataFrame:
    """BED rows with the contig's ``ref_idx`` (names not in the dictionary dropped);
    the dictionary is broadcast after a size check."""
    d = broadcast_checked(seq_dict.select(F.col("ref_name").alias("chrom"), "ref_idx"), "seq_dict")
    return bed.join(d, "chrom", "inner")
