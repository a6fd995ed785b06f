"""Duplicate marking and metrics (W2, A9) - re-aimed: the reference only calls an
external tool here, so the definition below is ours.

Two reads are duplicates when they share chromosome, strand and *unclipped* 5'
position (forward: ``pos - leading clip``; reverse: ``end + trailing clip``).  In each
group the read with the highest score (sum of its base qualities >= 15) is kept, ties
broken by read name; all others get flag bit 0x400 and ``dup = 1``.

Scale: instead of a window over every duplicate group (one task for a hot group), the
best read per group is an aggregate (``min`` of a struct), combined map-side, so a
group holding a third of all reads leaves each map task as one row.  The flags come
from joining that table back.  It is written first: with a plain shuffle on both sides,
AQE's skew-join handling splits a hot key (it does not above an aggregate).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cigar as C
from ..functions import quality as Q
from ..session import materialize
from .reads import FLAG_DUPLICATE, FLAG_REVERSE

# Fixed value: only base qualities at or above this count towards a read's score.
MIN_SCORE_QUALITY = 15


def duplicate_score(qual="qual") -> Column:
    """Sum of base qualities >= 15; 0 for a read without qualities."""
    total = F.aggregate(Q.phred(qual), F.lit(0).cast("long"),
                        lambda a, x: a + F.when(x >= MIN_SCORE_QUALITY, x.cast("long"))
                        .otherwise(F.lit(0).cast("long")))
    return F.when(Q.has_qualities(qual), F.coalesce(total, F.lit(0))).otherwise(F.lit(0)).cast("long")


def unclipped_five_prime(pos="pos", end="end_pos", cigar="cigar", flag="flag") -> Column:
    rev = F.col(flag).bitwiseAND(FLAG_REVERSE) != 0
    return F.when(rev, F.col(end) + C.trailing_clip(cigar)).otherwise(
        F.col(pos) - C.leading_clip(cigar))


def mark_duplicates(aln: DataFrame) -> DataFrame:
    """Adds ``score``, ``dup`` (0/1) and sets flag bit 0x400 on duplicates.
    Needs ``read_id, qname, flag, ref_idx, pos, end_pos, cigar, qual``."""
    x = aln.select("*",
                   F.col("flag").bitwiseAND(FLAG_REVERSE).alias("_strand"),
                   unclipped_five_prime().alias("_p5"),
                   duplicate_score().alias("score"))
    key = ["ref_idx", "_strand", "_p5"]
    best = x.groupBy(*key).agg(
        F.min(F.struct((-F.col("score")).alias("s"), F.col("qname").alias("q"),
                       F.col("read_id").alias("r")))["r"].alias("_best"))
    j = x.join(materialize(best, "best_reads"), key, "inner")
    dup = (F.col("read_id") != F.col("_best")).cast("int")
    return (j.withColumn("dup", dup)
            .withColumn("flag", F.when(F.col("dup") == 1,
                                       F.col("flag").bitwiseOR(FLAG_DUPLICATE))
                        .otherwise(F.col("flag")))
            .drop("_strand", "_p5", "_best"))


# SAM flag bits of paired reads.
FLAG_PAIRED = 1
FLAG_MATE_UNMAPPED = 8
FLAG_SECONDARY_OR_SUPPLEMENTARY = 0x900


def mark_duplicates_paired(aln: DataFrame) -> DataFrame:
    """W2, paired form: a template (both primary ends of a read name) is a duplicate
    of another when both ends match - chromosome, strand and unclipped 5' position of
    each end; in each group the template with the highest summed score is kept (ties
    by name) and both ends of every other one are flagged.  A fragment (unpaired, or
    its mate unmapped) is a duplicate when a paired end has the same end, else by the
    unpaired rule among fragments.  Secondary / supplementary records are left as
    they are (``dup = 0``).

    Pairing is one ``groupBy(qname)``: ``min`` / ``max`` of the end struct give the two
    ends in a fixed order, so no self-join is needed; the best template per two-end
    key is an aggregate combined map-side; flags return through joins on the name
    and read id.  Needs ``read_id, qname, flag, ref_idx, pos, end_pos, cigar, qual``."""
    flag = F.col("flag")
    x = aln.select("*", unclipped_five_prime().alias("_p5"), duplicate_score().alias("score"))
    end = F.struct(F.col("ref_idx").alias("r"), F.col("_p5").alias("p"),
                   flag.bitwiseAND(FLAG_REVERSE).alias("s"))
    primary = x.filter(flag.bitwiseAND(FLAG_SECONDARY_OR_SUPPLEMENTARY) == 0)
    is_pair_end = ((flag.bitwiseAND(FLAG_PAIRED) != 0) & (flag.bitwiseAND(4) == 0)
                   & (flag.bitwiseAND(FLAG_MATE_UNMAPPED) == 0))
    ends = primary.filter(is_pair_end).select("qname", "read_id", "score", end.alias("_end"))

    tmpl = ends.groupBy("qname").agg(
        F.min(F.struct("_end", "read_id")).alias("_lo"),
        F.max(F.struct("_end", "read_id")).alias("_hi"),
        F.sum("score").alias("_score"), F.count(F.lit(1)).alias("_n"))
    tmpl = materialize(tmpl.filter(F.col("_n") == 2).select(
        "qname", "_score", F.col("_lo._end").alias("_e1"), F.col("_hi._end").alias("_e2"),
        F.col("_lo.read_id").alias("_r1"), F.col("_hi.read_id").alias("_r2")), "templates")
    best = tmpl.groupBy("_e1", "_e2").agg(
        F.min(F.struct((-F.col("_score")).alias("s"), F.col("qname").alias("q")))["q"]
        .alias("_best"))
    flagged_t = tmpl.join(materialize(best, "best_templates"), ["_e1", "_e2"], "inner").select(
        F.explode(F.array("_r1", "_r2")).alias("read_id"),
        (F.col("qname") != F.col("_best")).cast("int").alias("_dup_t"))

    # fragments: primary, mapped, not part of a complete template.  One aggregation per
    # end sees both the paired ends (markers) and the fragments: "a pair has this end"
    # and the best fragment come out of the same combinable aggregate
    frag = primary.filter(flag.bitwiseAND(4) == 0).join(
        flagged_t.select("read_id"), "read_id", "left_anti").select(
        "read_id", "qname", "score", end.alias("_end"))
    marks = tmpl.select(F.explode(F.array("_e1", "_e2")).alias("_end"),
                        F.lit(1).alias("_pair"), F.lit(None).cast("long").alias("score"),
                        F.lit(None).cast("string").alias("qname"),
                        F.lit(None).cast("long").alias("read_id"))
    at_end = frag.select("_end", F.lit(0).alias("_pair"), "score", "qname", "read_id") \
        .unionByName(marks).groupBy("_end").agg(
            F.max("_pair").alias("_hit"),
            F.min(F.when(F.col("_pair") == 0, F.struct(
                (-F.col("score")).alias("s"), F.col("qname").alias("q"),
                F.col("read_id").alias("r"))))["r"].alias("_bestf"))
    frag_f = frag.join(materialize(at_end, "best_ends"), "_end", "inner").select(
        "read_id", F.when((F.col("_hit") == 1) | (F.col("read_id") != F.col("_bestf")), 1)
        .otherwise(0).alias("_dup"))

    flags = flagged_t.select("read_id", F.col("_dup_t").alias("_dup")).unionByName(frag_f)
    out = (x.join(flags, "read_id", "left")
           .withColumn("dup", F.coalesce("_dup", F.lit(0)).cast("int")))
    return (out.withColumn("flag", F.when(F.col("dup") == 1, flag.bitwiseOR(FLAG_DUPLICATE))
                           .otherwise(flag))
            .drop("_p5", "_dup"))


def duplicate_metrics(flagged: DataFrame, by=("library",)) -> DataFrame:
    """Per group (library, or region and library): reads examined, duplicates,
    and the duplicate share in per mille, rounded half up in integer arithmetic."""
    g = flagged.groupBy(*by).agg(F.count(F.lit(1)).alias("reads"),
                                 F.sum("dup").cast("long").alias("duplicates"))
    permille = ((F.col("duplicates") * 2000 + F.col("reads")) / (F.col("reads") * 2)) \
        .cast("long")
    return g.withColumn("dup_permille", permille)
