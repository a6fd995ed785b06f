"""Per-operation and per-base views of alignments (P11, W4) and what is computed on
them: pileup (A12), indel targets (A13), recalibration (A11, J5, J6) and variant
calls (W5).  Re-aimed: the reference runs external tools for these steps; the
definitions here are ours.

The running offsets of a read's CIGAR operations are computed inside the row with
higher-order functions (no window, no shuffle); ``explode`` then fans out operations or
aligned bases map-side, and every consumer aggregates straight after the explode, so
the 30x larger base table is never shuffled unaggregated nor cached.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cigar as C
from ..functions import quality as Q
from ..session import BROADCAST_BYTES, materialize, materialize_measured
from .intervals import merge_intervals


def explode_cigar(reads: DataFrame, keep=("read_id", "ref_idx", "pos")) -> DataFrame:
    """One row per CIGAR operation: ``k`` (0-based), ``op``, ``n``, its first
    reference position ``ref_start`` and its first read offset ``read_off``."""
    ops = C.cigar_with_offsets("cigar")
    return reads.select(*keep, F.posexplode(ops).alias("_k", "_o")).select(
        *keep, F.col("_o.k").cast("int").alias("k"), F.col("_o.op").alias("op"),
        F.col("_o.n").alias("n"),
        (F.col("pos") + F.col("_o.ref_off")).cast("long").alias("ref_start"),
        F.col("_o.read_off").cast("long").alias("read_off"))


def aligned_bases(reads: DataFrame, keep=("read_id", "ref_idx")) -> DataFrame:
    """One row per read base aligned to the reference (inside M, = or X):
    ``ref_pos, cyc`` (0-based read offset), ``base`` and its quality ``q``.  A read
    without qualities, or with more or fewer than bases, gives no base.

    Two generator steps: the aligned operations of a read (with their offsets), then
    the bases of each operation; both are map-side and keep the base columns simple
    expressions inside generated code.  The lengths are compared in the second step: a
    filter on them would be pushed below whatever computes ``seq`` and plan it twice."""
    ops = F.filter(C.cigar_with_offsets("cigar"), lambda o: o["op"].isin(C.ALIGNED))
    x = reads.where(Q.has_qualities("qual")).select(*keep, "pos", "seq", "qual", F.explode(ops).alias("_o"))
    whole = F.length("qual") == F.length("seq")
    x = x.select(*keep, "seq", "qual",
                 (F.col("pos") + F.col("_o.ref_off")).alias("_r0"),
                 F.col("_o.read_off").cast("int").alias("_q0"),
                 F.explode(F.when(whole, F.sequence(F.lit(0), F.col("_o.n").cast("int") - 1))).alias("_j"))
    cyc = F.col("_q0") + F.col("_j")
    return x.select(*keep, (F.col("_r0") + F.col("_j")).alias("ref_pos"), cyc.alias("cyc"),
                    F.col("seq").substr(cyc + 1, F.lit(1)).alias("base"),
                    (F.ascii(F.col("qual").substr(cyc + 1, F.lit(1)))
                     - F.lit(Q.PHRED_OFFSET)).cast("int").alias("q"))


DEFAULT_BASE_BIN = 1 << 10


def aligned_bases_binned(reads: DataFrame, sites: DataFrame | None = None,
                         reference: DataFrame | None = None, keep=("read_id", "ref_idx"),
                         bin_size: int = DEFAULT_BASE_BIN) -> DataFrame:
    """Aligned bases with per-bin context, without shuffling a single base.

    Every read is paired with the bins it covers (one or two for reads shorter than a
    bin) and joined on ``(ref_idx, bin)`` with

    * ``sites`` (``ref_idx, ref_pos``), a bitmap of ``bin_size`` bits per bin
      (:func:`site_bitmaps`): a base is dropped (J5) by one bit test;
    * ``reference`` chunks (``ref_idx, bin, chunk_start, chunk``, e.g. from
      :func:`strandline.sources.fasta.read_fasta_chunks` with the same ``bin_size``):
      each base gets ``ref_base`` from its bin's chunk.

    Both joins share one partitioning of the (read, bin) rows - the shuffled rows are
    reads, ~20x fewer bytes than bases - and bases are fanned out per (read, bin) row,
    keeping those inside the bin, so each base is produced exactly once."""
    B = F.lit(bin_size)
    end = F.col("pos") + C.aligned_length("cigar") - 1
    rb = reads.withColumn("_bin", F.explode(F.sequence(
        F.floor(F.col("pos") / B).cast("long"), F.floor(F.greatest(end, F.col("pos")) / B)
        .cast("long"))))
    extra = ["_bin"]
    if sites is not None:
        # written, so that the join shuffles two plain tables and AQE can split a hot bin
        site_bins = materialize(site_bitmaps(sites, bin_size), "site_bins")
        rb = rb.join(site_bins, ["ref_idx", "_bin"], "left")
        extra.append("_sites")
    if reference is not None:
        chunks = reference.select("ref_idx", F.col("bin").cast("long").alias("_bin"),
                                  F.col("chunk_start").alias("_cs"), F.col("chunk").alias("_chunk"))
        rb = rb.join(chunks, ["ref_idx", "_bin"], "left")
        extra += ["_cs", "_chunk"]
    bases = aligned_bases(rb, keep=tuple(keep) + tuple(extra))
    cond = F.floor(F.col("ref_pos") / B).cast("long") == F.col("_bin")
    if sites is not None:
        at = F.pmod(F.col("ref_pos"), B)
        word = F.get(F.col("_sites"), F.shiftright(at, 6).cast("int"))
        cond = cond & (F.coalesce(F.getbit(word, at.bitwiseAND(63).cast("int")), F.lit(0)) == 0)
    bases = bases.filter(cond)
    if reference is not None:
        bases = bases.withColumn("ref_base", F.upper(F.col("_chunk").substr(
            (F.col("ref_pos") - F.col("_cs") + 1).cast("int"), F.lit(1))))
    return bases.drop(*extra)


def site_bitmaps(sites: DataFrame, bin_size: int = DEFAULT_BASE_BIN) -> DataFrame:
    """Positions (``ref_idx, ref_pos``) as one bitmap per ``(ref_idx, _bin)``: ``_sites``,
    an array of 64-bit words.  A word is the OR of its positions' bits, combined
    map-side, so repeated sites cost nothing and no list of positions is ever held; a
    bin is ``bin_size / 8`` bytes however many sites it has."""
    at = F.pmod(F.col("ref_pos"), F.lit(bin_size))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(63).cast("int"))
    words = (sites.groupBy("ref_idx", F.floor(F.col("ref_pos") / bin_size).cast("long").alias("_bin"),
                           F.shiftright(at, 6).cast("int").alias("_w"))
             .agg(F.bit_or(bit).alias("_bits")))
    held = F.map_from_entries(F.collect_list(F.struct("_w", "_bits")))      # bin_size / 64 entries at most
    return words.groupBy("ref_idx", "_bin").agg(F.transform(
        F.sequence(F.lit(0), F.lit((bin_size - 1) // 64)),
        lambda w: F.coalesce(F.try_element_at(held, w), F.lit(0).cast("long"))).alias("_sites"))


def aligned_bases_off_sites(reads: DataFrame, sites: DataFrame, keep=("read_id", "ref_idx"),
                            bin_size: int = DEFAULT_BASE_BIN) -> DataFrame:
    """J5 without shuffling bases: aligned bases not at a known site (see
    :func:`aligned_bases_binned`)."""
    return aligned_bases_binned(reads, sites=sites, keep=keep, bin_size=bin_size)


def pileup(bases: DataFrame) -> DataFrame:
    """Depth and quality sum per ``(ref_idx, ref_pos, ref_base, base)``.
    Partial aggregation runs before the shuffle, so a deep locus costs a few rows per
    map task."""
    return bases.groupBy("ref_idx", "ref_pos", "ref_base", "base").agg(
        F.count(F.lit(1)).alias("depth"), F.sum("q").cast("long").alias("qsum"))


def indel_candidates(reads: DataFrame) -> DataFrame:
    """A13 (first half): every insertion / deletion of every CIGAR as a 0-based
    half-open interval (an insertion covers the base before which it sits; a deletion
    its deleted bases), with the number of reads supporting it."""
    ops = explode_cigar(reads).filter(F.col("op").isin("I", "D"))
    g = ops.groupBy("ref_idx", "ref_start", "op", "n").agg(F.count(F.lit(1)).alias("support"))
    return g.select("ref_idx", (F.col("ref_start") - 1).alias("start0"),
                    (F.col("ref_start") - 1 + F.when(F.col("op") == "D", F.col("n"))
                     .otherwise(F.lit(1))).cast("long").alias("end0"),
                    "op", "support")


def indel_targets(reads: DataFrame, bin_size: int = 1 << 16) -> DataFrame:
    """Indel candidates merged into realignment target intervals: candidates that
    overlap or touch are joined.  ``ref_idx, start0, end0, n_indels`` (0-based
    half-open).  The merge is the distributed one of :mod:`.intervals`."""
    c = indel_candidates(reads).select("ref_idx", (F.col("start0") + 1).alias("s"),
                                       F.col("end0").alias("e"))
    m = merge_intervals(c, ("ref_idx",), "s", "e", gap=1, bin_size=bin_size)
    return m.select("ref_idx", (F.col("start_pos") - 1).alias("start0"),
                    F.col("end_pos").alias("end0"), F.col("n_reads").alias("n_indels"))


def recal_table(bases: DataFrame, known_sites: DataFrame | None = None,
                by=("q", "cyc")) -> DataFrame:
    """A11 + J5: per covariate (reported quality, cycle) the observed bases, the
    mismatches against the reference, and the empirical quality
    ``round(-10 * log10((mism + 1) / (obs + 2)))``.  The aggregation is combined
    map-side, so only (quality, cycle) partials are shuffled.

    Known sites are best removed before, while bases are fanned out
    (:func:`aligned_bases_off_sites`: reads, not bases, are shuffled).  ``known_sites``
    here is the plain form - a base-level anti-join - for inputs that are already
    base tables."""
    b = bases
    if known_sites is not None:
        b = b.join(known_sites.select("ref_idx", "ref_pos"), ["ref_idx", "ref_pos"], "left_anti")
    # an N says nothing about a mismatch
    b = b.where((F.col("base") != "N") & (F.col("ref_base") != "N"))
    mism = F.sum(F.when(F.col("base") != F.col("ref_base"), 1).otherwise(0)).cast("long")
    g = b.groupBy(*by).agg(F.count(F.lit(1)).alias("obs"), mism.alias("mism"))
    emp = F.round(-10 * F.log10((F.col("mism") + 1) / (F.col("obs") + F.lit(2.0)))).cast("int")
    out = g.withColumn("emp_q", emp)
    if "q" in by:
        out = out.withColumnRenamed("q", "reported_q")
    return out


def recal_lookup(table: DataFrame, *by: str) -> DataFrame:
    """The recalibration table as dense lookup arrays: one row per ``by`` with
    ``_lut[cycle][quality] = emp_q`` (null where the table has no entry), so a base is
    recalibrated by two O(1) array reads.  Built distributedly: one 128-wide array per
    (group, cycle), then one array of those per group."""
    per_cyc = table.groupBy(*by, "cyc").agg(
        F.map_from_entries(F.collect_list(F.struct("reported_q", "emp_q"))).alias("_m"))
    per_cyc = per_cyc.select(*by, "cyc", F.transform(
        F.sequence(F.lit(0), F.lit(127)), lambda q: F.try_element_at(F.col("_m"), q))
        .alias("_qa"))
    lut = per_cyc.groupBy(*by).agg(
        F.max("cyc").alias("_maxc"),
        F.map_from_entries(F.collect_list(F.struct("cyc", "_qa"))).alias("_cm"))
    return lut.select(*by, F.transform(F.sequence(F.lit(0), F.col("_maxc")),
                                       lambda c: F.try_element_at(F.col("_cm"), c))
                      .alias("_lut"))


#: Cycles of a read segment in the shuffle form of :func:`recal_apply`.
RECAL_SEGMENT = 32


def recal_apply(reads: DataFrame, table: DataFrame, group: str | None = None,
                key: str = "read_id", max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Recalibrate base qualities.  Every aligned base (M, =, X) whose
    ``(quality, cycle)`` - or ``(group, quality, cycle)`` when the table was built per
    ``group``, e.g. per region as the original does - is in the table gets the table's
    empirical quality; bases in insertions and soft clips, and covariates missing from
    the table, keep theirs.

    The table is written and measured.  Within ``max_bytes`` it is broadcast and whole
    Arrow batches of quality texts are rewritten at once, without a shuffle.  Beyond it
    nothing is broadcast: reads are cut into segments of ``RECAL_SEGMENT`` cycles, which
    meet the table's rows of their (group, segment) by an equi-join, and are put together
    again by ``key`` (unique per read).  Neither form moves single bases."""
    table, size = materialize_measured(table, "recal_table")
    if size > max_bytes:
        return _recal_by_segments(reads, table, group, key)
    luts: dict[str, list] = {}
    name = F.col(group).cast("string") if group else F.lit("all")
    for k, *entry in table.select(name, "cyc", "reported_q", "emp_q").where(name.isNotNull()).collect():
        luts.setdefault(k, []).append(entry)
    held = reads.sparkSession.sparkContext.broadcast({k: quality_lookup(v) for k, v in luts.items()})

    @F.pandas_udf("string")
    def rewrite(qual: pd.Series, cigar: pd.Series, by: pd.Series) -> pd.Series:
        out = qual.copy()
        for k in by.unique():
            lut = held.value.get(k)
            if lut is not None:
                rows = (by == k).to_numpy()
                out[rows] = rewrite_qualities(qual[rows].tolist(), cigar[rows].tolist(), lut)
        return out

    # groups are told apart by their text; a read without one keeps its qualities
    by = F.coalesce(F.col(group).cast("string"), F.lit("")) if group else F.lit("all")
    return reads.withColumn("qual", rewrite("qual", "cigar", by))


def quality_lookup(entries: list[tuple[int, int, int]]) -> np.ndarray:
    """(cycle, quality, new quality) as ``lut[cycle, quality]``, -1 where there is none."""
    lut = np.full((1 + max(c for c, _, _ in entries), 128), -1, np.int16)
    for c, q, new in entries:
        if 0 <= q < 128:
            lut[c, q] = new
    return lut


@lru_cache(1 << 14)
def _aligned_mask(cigar: str) -> np.ndarray:
    ops = [(int(n), op) for n, op in re.findall(r"([0-9]+)([MIDNSHP=X])", cigar) if op in C.QUERY_CONSUMING]
    return np.repeat([op in C.ALIGNED for _, op in ops], [n for n, _ in ops]).astype(bool)


def rewrite_qualities(quals: list, cigars: list, lut: np.ndarray) -> list:
    """Quality texts with the aligned bases' scores replaced from ``lut``; absent ones stay."""
    at = [i for i, q in enumerate(quals) if q and q != "*" and q.isascii()]
    if not at:
        return quals
    lens = np.array([len(quals[i]) for i in at])
    ends = lens.cumsum()
    q = np.frombuffer("".join(quals[i] for i in at).encode("ascii"), np.uint8).astype(np.int16) - Q.PHRED_OFFSET
    cyc = np.arange(len(q)) - np.repeat(ends - lens, lens)
    aligned = np.zeros(len(q), bool)
    for i, n, end in zip(at, lens.tolist(), ends.tolist()):
        mask = _aligned_mask(cigars[i] or "")[:n]
        aligned[end - n:end - n + len(mask)] = mask
    new = lut[np.minimum(cyc, len(lut) - 1), np.maximum(q, 0)]
    q = np.where(aligned & (new >= 0) & (q >= 0) & (cyc < len(lut)), new, q) + Q.PHRED_OFFSET
    text = q.astype(np.uint8).tobytes().decode("latin-1")
    out = list(quals)
    for i, n, end in zip(at, lens.tolist(), ends.tolist()):
        out[i] = text[end - n:end]
    return out


def _recal_by_segments(reads: DataFrame, table: DataFrame, group: str | None, key: str) -> DataFrame:
    n = F.lit(RECAL_SEGMENT)
    by = ([group] if group else []) + ["_seg"]
    lut = recal_lookup(table.withColumn("_seg", F.floor(F.col("cyc") / n).cast("int")).withColumn("cyc", (F.col("cyc") % n).cast("int")), *by)
    flags = F.coalesce(C.aligned_offsets("cigar"), F.array().cast("array<boolean>"))
    paired = F.filter(F.zip_with(Q.phred("qual"), flags, lambda v, a: C.named(v=v, a=F.coalesce(a, F.lit(False)))),
                      lambda t: t["v"].isNotNull())
    cuts = F.transform(F.sequence(F.lit(0), F.floor((F.size("_p") - 1) / n).cast("int")), lambda s: F.slice("_p", s * n + 1, n))
    segments = (reads.where(Q.has_qualities("qual")).select(key, *by[:-1], paired.alias("_p"))
                .select(key, *by[:-1], F.posexplode(cuts).alias("_seg", "_part")))
    # both sides written or scanned, so that AQE can split a hot group's segments
    met = segments.join(materialize(lut, "recal_lut"), by, "left")
    new = F.transform("_part", lambda t, i: F.when(t["a"], F.coalesce(F.get(F.get(F.col("_lut"), i), t["v"]), t["v"])).otherwise(t["v"]))
    texts = (met.select(key, F.struct("_seg", Q.phred_text(new).alias("t")).alias("_s")).groupBy(key)
             .agg(F.array_join(F.transform(F.sort_array(F.collect_list("_s")), lambda s: s["t"]), "").alias("_new")))
    return reads.join(texts, key, "left").withColumn("qual", F.coalesce("_new", "qual")).select(*reads.columns)


def call_variants(pile: DataFrame, min_qual: int = 30, min_share=(1, 5),
                  hom_share=(4, 5)) -> DataFrame:
    """Per site, the best non-reference base (highest quality sum, then smallest
    base) becomes the call when its quality sum >= ``min_qual`` and its share of the
    site's depth >= ``min_share``; genotype ``1/1`` when the share >= ``hom_share``,
    else ``0/1``.  Shares are exact fractions ``(num, den)``.  One aggregation over the pileup (no window): ``dp`` is the summed
    depth and the best base is the ``max`` of a struct ordered by (qsum, -base)."""
    # an N is neither a variant nor a reference base to differ from
    nonref = (F.col("base") != F.col("ref_base")) & (F.col("base") != "N") & (F.col("ref_base") != "N")
    cand = F.when(nonref, F.struct(F.col("qsum").alias("qsum"),
                                   (-F.ascii(F.col("base"))).alias("nb"),
                                   F.col("base").alias("base"),
                                   F.col("depth").alias("depth")))
    g = pile.groupBy("ref_idx", "ref_pos", "ref_base").agg(
        F.sum("depth").cast("long").alias("dp"), F.max(cand).alias("_b"))
    ok = (F.col("_b").isNotNull() & (F.col("_b.qsum") >= min_qual)
          & (F.col("_b.depth") * min_share[1] >= F.col("dp") * min_share[0]))
    return g.filter(ok).select(
        "ref_idx", "ref_pos", "ref_base", F.col("_b.base").alias("alt"),
        F.col("_b.qsum").alias("qual"), F.col("_b.depth").alias("ad"), "dp",
        F.when(F.col("_b.depth") * hom_share[1] >= F.col("dp") * hom_share[0], F.lit("1/1"))
        .otherwise(F.lit("0/1")).alias("gt"))


def vcf_line(chrom_name: Column) -> Column:
    """A VCF body line for a call: CHROM POS ID REF ALT QUAL FILTER INFO FORMAT SAMPLE."""
    return F.concat_ws("\t", chrom_name, F.col("ref_pos").cast("string"), F.lit("."),
                       F.col("ref_base"), F.col("alt"), F.col("qual").cast("string"),
                       F.lit("PASS"), F.concat(F.lit("DP="), F.col("dp").cast("string")),
                       F.lit("GT:AD"),
                       F.concat(F.col("gt"), F.lit(":"), F.col("ad").cast("string")))


def merge_variants(*parts: DataFrame) -> DataFrame:
    """U1 + A4/U2 + O4: concatenate per-region variant outputs (``chrom, pos, line``),
    drop repeated lines, order by ``(chrom, pos, line)``.  ``distinct`` is a hash
    aggregation (combined map-side); the order is a range-partitioned global sort, so
    the ordered output is written in parallel (see :func:`strandline.sinks.write_vcf`)."""
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.distinct().orderBy("chrom", "pos", "line")
