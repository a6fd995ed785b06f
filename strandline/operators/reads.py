"""Per-read operators: filters, derived columns, quality encodings, clean-up and the
reference / read-group attachments (P2, P5-P8, P10, J7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cigar as C
from ..functions import quality as Q
from ..session import broadcast_checked

# The read-group fields stamped on every alignment.
READ_GROUP = {"id": "GROUP1", "library": "LIB1", "platform": "ILLUMINA",
              "unit": "UNIT1", "sample": "SAMPLE1"}

# SAM flag bits used here.
FLAG_UNMAPPED = 4
FLAG_REVERSE = 16
FLAG_DUPLICATE = 1024

# Fixed value: reference indices 1..24 are chr1..22, X, Y (0 is chrM).
PRIMARY_MAX_REF_IDX = 24

def primary_mapped_condition(max_ref_idx: int = PRIMARY_MAX_REF_IDX) -> Column:
    """The P2 predicate as a column."""
    return (((F.col("flag").bitwiseAND(FLAG_UNMAPPED)) == 0)
            & (F.col("ref_idx") > 0) & (F.col("ref_idx") <= max_ref_idx))


def primary_mapped(aln: DataFrame, max_ref_idx: int = PRIMARY_MAX_REF_IDX) -> DataFrame:
    """Mapped reads (flag bit 4 clear) on the primary chromosomes
    ``0 < ref_idx <= max_ref_idx``.  A plain filter, pushed to the scan."""
    return aln.filter(primary_mapped_condition(max_ref_idx))


def with_alignment_end(aln: DataFrame) -> DataFrame:
    """P10: ``aligned_len`` (reference bases of the CIGAR) and the inclusive
    ``end_pos = pos + aligned_len - 1``."""
    return (aln.withColumn("aligned_len", C.aligned_length("cigar"))
            .withColumn("end_pos", F.col("pos") + F.col("aligned_len") - 1))


def with_reference(aln: DataFrame, seq_dict: DataFrame) -> DataFrame:
    """Attach ``ref_name, ref_length`` from the sequence dictionary.  The
    dictionary has one row per contig; it is broadcast after a size check."""
    d = broadcast_checked(seq_dict.select("ref_idx", "ref_name", "ref_length"), "seq_dict")
    return aln.join(d, "ref_idx", "left")


def with_read_group(aln: DataFrame, **rg: str) -> DataFrame:
    """Stamp read-group fields (``rg_id, rg_library, rg_platform, rg_unit,
    rg_sample``); any field can be overridden by keyword."""
    vals = {**READ_GROUP, **rg}
    return aln.select("*", *[F.lit(vals[k]).alias(f"rg_{k}") for k in
                             ("id", "library", "platform", "unit", "sample")])


def guess_encoding(aln: DataFrame, by: str | list[str] = "ref_idx") -> DataFrame:
    """P5: per group, the quality encoding guessed from the group's *first* read that has
    qualities, in coordinate order ``(ref_idx, pos, read_id)``: its maximum quality score <= 60 means
    Sanger, else Illumina-1.3.  Output ``by.., first_read_id, max_q, encoding``.

    ``min_by`` is a plain aggregate, so it is combined map-side before the shuffle; it
    carries the first read's quality string, and only that one string per group is
    scored (not every read's)."""
    by = [by] if isinstance(by, str) else list(by)
    first = (aln.where(Q.has_qualities("qual")).groupBy(*by).agg(F.min_by(
        F.struct(F.col("read_id").alias("first_read_id"), F.col("qual").alias("q")),
        F.struct("ref_idx", "pos", "read_id")).alias("_f")))
    max_q = Q.max_quality(F.col("_f.q"))
    return first.select(*by, "_f.first_read_id", max_q.alias("max_q"),
                        F.when(max_q <= Q.SANGER_MAX, F.lit(Q.SANGER))
                        .otherwise(F.lit(Q.ILLUMINA)).alias("encoding"))


def fix_qualities(aln: DataFrame, encodings: DataFrame | None = None,
                  by: str | list[str] = "ref_idx", raise_error: bool = False) -> DataFrame:
    """In every group whose encoding (P5) is Illumina, subtract 31 from every base
    quality.  A read where a score would fall below 0 gets ``qual = null`` and
    ``quality_error = true`` (the row is kept); with ``raise_error`` the job fails
    instead.  The encoding table has one row per group and is broadcast after a size
    check."""
    by = [by] if isinstance(by, str) else list(by)
    enc = encodings if encodings is not None else guess_encoding(aln, by)
    enc = broadcast_checked(enc.select(*by, "encoding"), "encodings")
    x = aln.join(enc, by, "left")
    fixed = F.transform(Q.phred("qual"), lambda v: v - F.lit(Q.ILLUMINA_SHIFT))
    bad = F.exists(fixed, lambda v: v < 0)
    # without a guess (no read of the group has qualities) or own qualities: unchanged
    do_fix = F.coalesce(F.col("encoding") == Q.ILLUMINA, F.lit(False)) & Q.has_qualities("qual")
    err = F.when(do_fix, F.coalesce(bad, F.lit(False))).otherwise(F.lit(False))
    if raise_error:
        err = F.when(err, F.raise_error(F.lit("quality score below 0 after fixing"))) \
            .otherwise(err)
    new_q = (F.when(~do_fix, F.col("qual"))
             .when(F.coalesce(bad, F.lit(False)), F.lit(None).cast("string"))
             .otherwise(Q.phred_text(fixed)))
    return x.withColumn("quality_error", err).withColumn("qual", new_q)


def _clip_ops(cigar: Column, pos: Column, ref_length: Column) -> Column:
    """Operations of a CIGAR with everything past ``ref_length`` turned into one soft
    clip (see :func:`clean_alignments`)."""
    ops = C.cigar_with_offsets(cigar)
    limit = ref_length - pos + 1          # reference bases that fit
    zero = F.lit(0).cast("long")

    def keep_n(o):
        fits = F.greatest(zero, F.least(o["n"], limit - o["ref_off"]))
        return (F.when(o["op"].isin(C.REF_CONSUMING), fits)
                .when(o["op"] == "H", o["n"])
                .when(o["ref_off"] < limit, o["n"]).otherwise(zero))

    kept = F.transform(ops, lambda o: C.named(k=o["k"], op=o["op"], n=keep_n(o), full=o["n"]))
    clipped_q = F.aggregate(kept, zero, lambda a, o: a + F.when(
        o["op"].isin(C.QUERY_CONSUMING), o["full"] - o["n"]).otherwise(zero))
    nonzero = F.filter(kept, lambda o: o["n"] > 0)
    # the last operation that still places read bases on the reference
    last_q = F.aggregate(nonzero, F.lit(-1), lambda a, o: F.when(
        o["op"].isin(C.ALIGNED + ["I"]), o["k"]).otherwise(a))
    body = F.filter(nonzero, lambda o: ~(o["op"].isin("D", "N") & (o["k"] > last_q)))
    trailing_s = F.filter(body, lambda o: (o["op"] == "S") & (o["k"] > last_q))
    body = F.filter(body, lambda o: ~((o["op"] == "S") & (o["k"] > last_q)))
    tail = F.aggregate(trailing_s, clipped_q, lambda a, o: a + o["n"])
    out = F.transform(body, lambda o: C.named(n=o["n"], op=o["op"]))
    return F.when(clipped_q > 0, F.concat(out, F.array(C.named(n=tail, op=F.lit("S"))))) \
        .otherwise(F.transform(ops, lambda o: C.named(n=o["n"], op=o["op"])))


def clean_alignments(aln: DataFrame, ref_length: str = "ref_length") -> DataFrame:
    """P7 (re-aimed; the definition is ours): clean alignments against the sequence
    dictionary.

    * Bases aligned past the end of the chromosome are soft-clipped: every operation
      is cut at the last reference base; read bases past it (M, I, S, =, X) become one
      trailing ``S`` (merged with an existing trailing clip); deletions / skips that
      would be left next to that clip are dropped.
    * Unmapped reads get mapping quality 0.

    ``aln`` must carry ``ref_length`` (see :func:`with_reference`).  Reads that start
    past the end are out of scope and left unchanged.  Pure per-row expressions."""
    ops = _clip_ops(F.col("cigar"), F.col("pos"), F.col(ref_length))
    overhang = (F.col("pos") + C.aligned_length("cigar") - 1) > F.col(ref_length)
    new_cigar = F.when(overhang & (F.col("pos") <= F.col(ref_length)),
                       C.cigar_string(ops)).otherwise(F.col("cigar"))
    out = aln.withColumn("cigar", new_cigar)
    out = out.withColumn("mapq", F.when(F.col("flag").bitwiseAND(FLAG_UNMAPPED) != 0,
                                        F.lit(0)).otherwise(F.col("mapq")))
    return out.withColumn("end_pos", F.col("pos") + C.aligned_length("cigar") - 1)
