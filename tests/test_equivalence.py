"""Distributed forms against the plain forms they replace, on the
sf0.01 fixtures with small bins so that many bins, carries and cross-bin ranges occur."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF01
from strandline.operators import bases as B
from strandline.operators import intervals as I
from strandline.operators import regions as G
from strandline.plans import fixtures as X


def rows(df, cols=None):
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())


def plain_merge(df, gap):
    w = Window.partitionBy("ref_idx").orderBy("pos", "read_id")
    prev = F.max("end_pos").over(w.rowsBetween(Window.unboundedPreceding, -1))
    x = df.withColumn("brk", F.when(F.col("pos") <= prev + gap, 0).otherwise(1))
    x = x.withColumn("isl", F.sum("brk").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return x.groupBy("ref_idx", "isl").agg(F.min("pos").alias("start_pos"),
                                           F.max("end_pos").alias("end_pos"),
                                           F.count(F.lit(1)).alias("n_reads")).drop("isl")


@pytest.mark.parametrize("bin_size,presorted", [(1 << 16, False), (512, False), (512, True),
                                                (37, False), (37, True)])
def test_two_phase_merge_equals_plain_window(spark, bin_size, presorted):
    kept = X.kept(spark, SF01).repartition(5)          # several map-side partitions
    want = rows(plain_merge(kept, 51))
    got = rows(I.merge_intervals(kept, bin_size=bin_size, presorted=presorted),
               ["ref_idx", "start_pos", "end_pos", "n_reads"])
    assert got == want
    assert len(want) == 9742


@pytest.mark.parametrize("bin_size", [1024, 64, 100_000])
def test_binned_intersect_equals_plain_join(spark, bin_size):
    bed = X.bed(spark, SF01)
    isl = I.covered_ranges(X.kept(spark, SF01)).select(
        "ref_idx", (F.col("start_pos") - 1).alias("start0"), F.col("end_pos").alias("end0"))
    plain = bed.alias("b").join(isl.alias("i"), (F.col("b.ref_idx") == F.col("i.ref_idx"))
                                & (F.col("b.bstart") < F.col("i.end0"))
                                & (F.col("i.start0") < F.col("b.bend")))
    want = rows(plain.select("b.bed_id", "b.ref_idx",
                             F.greatest("b.bstart", "i.start0"), F.least("b.bend", "i.end0")))
    got = rows(I.interval_intersect(bed, isl, bin_size=bin_size),
               ["bed_id", "ref_idx", "istart", "iend"])
    assert got == want and len(want) == 2377


@pytest.mark.parametrize("bin_size", [1024, 16])
def test_binned_restrict_equals_exists(spark, bin_size):
    k = X.kept(spark, SF01).select("read_id", "ref_idx", (F.col("pos") - 1).alias("start0"),
                                   F.col("end_pos").alias("end0"))
    bed = X.bed(spark, SF01)
    plain = k.alias("k").join(bed.alias("b"), (F.col("k.ref_idx") == F.col("b.ref_idx"))
                              & (F.col("b.bstart") < F.col("k.end0"))
                              & (F.col("k.start0") < F.col("b.bend")), "left_semi")
    got = I.interval_restrict(k, bed, bin_size=bin_size)
    assert rows(got, ["read_id"]) == rows(plain, ["read_id"])
    assert got.count() == 3103            # each read once


def test_rank_within_equals_row_number(spark):
    kept = X.kept(spark, SF01)
    rr = G.assign_regions(kept, G.balance_regions(G.reads_per_chrom(kept), 4))
    w = Window.partitionBy("region").orderBy("ref_idx", "pos", "qname")
    want = rows(rr.select("read_id", F.row_number().over(w).cast("long")))
    got = rows(G.rank_within(rr, "region", ["ref_idx", "pos", "qname"], num_partitions=7),
               ["read_id", "rank"])
    assert got == want


@pytest.mark.parametrize("bin_size", [16, 1024])
def test_binned_site_exclusion_equals_anti_join(spark, bin_size):
    from strandline.operators import bases as B
    dn = X.dense(spark, SF01)
    sites = X.known_sites_from_reads(dn)
    plain = B.aligned_bases(dn).join(sites, ["ref_idx", "ref_pos"], "left_anti")
    got = B.aligned_bases_off_sites(dn, sites, bin_size=bin_size)
    cols = ["read_id", "ref_idx", "ref_pos", "cyc", "base", "q"]
    assert rows(got, cols) == rows(plain, cols)


def test_per_region_recal_apply_equals_explode_join(spark):
    from strandline.functions import cigar as C
    from strandline.operators import bases as B
    dn = X.dense(spark, SF01)
    reg = G.balance_regions(G.reads_per_chrom(dn), 4)
    reads = G.assign_regions(dn, reg)
    bases = X.bases_with_ref(B.aligned_bases(reads, keep=("read_id", "ref_idx", "region")))
    table = B.recal_table(bases, by=("region", "q", "cyc"))
    got = rows(B.recal_apply(reads, table, group="region"), ["read_id", "qual"])
    # plain form: one row per read offset, join the table, rebuild the string in order
    pos = reads.select("read_id", "region", "qual", C.aligned_offsets("cigar").alias("al"),
                       F.posexplode(F.split("qual", "")).alias("i", "c"))
    j = pos.join(table, (pos["region"] == table["region"]) & (pos["i"] == table["cyc"])
                 & ((F.ascii("c") - 33) == table["reported_q"]), "left")
    newq = F.when(F.get(F.col("al"), F.col("i")) & F.col("emp_q").isNotNull(),
                  F.col("emp_q")).otherwise(F.ascii("c") - 33)
    plain = j.groupBy("read_id").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("i", F.chr(newq + 33).alias("ch")))),
        lambda s: s["ch"]), "").alias("qual"))
    assert got == rows(plain, ["read_id", "qual"])


def test_adaptive_join_bin(spark):
    bed = X.bed(spark, SF01)
    isl = I.covered_ranges(X.kept(spark, SF01)).select(
        "ref_idx", (F.col("start_pos") - 1).alias("start0"), F.col("end_pos").alias("end0"))
    b = I.choose_bin_size((bed, "bstart", "bend"), (isl, "start0", "end0"))
    assert b & (b - 1) == 0 and 64 <= b <= 4096       # a power of two near the lengths
    got = I.interval_intersect(bed, isl, bin_size=None)
    assert got.count() == 2377


@pytest.mark.parametrize("group", [None, "region"])
def test_recal_apply_beyond_the_broadcast(spark, group):
    """A table too large to broadcast reaches the reads by segments: same rows."""
    dn = X.dense(spark, SF01).withColumn("region", (F.col("ref_idx") % 3).cast("int"))
    dn = dn.withColumn("qual", F.when(F.col("read_id") % 10 == 0, "*").otherwise(F.col("qual")))
    bases = X.bases_with_ref(B.aligned_bases(dn, keep=("read_id", "ref_idx", "region")))
    by = (("region",) if group else ()) + ("q", "cyc")
    table = B.recal_table(bases, by=by).where("cyc < 30 and obs > 3")
    small = rows(B.recal_apply(dn, table, group=group), ["read_id", "qual"])
    large = rows(B.recal_apply(dn, table, group=group, max_bytes=1), ["read_id", "qual"])
    assert small == large and small != rows(dn, ["read_id", "qual"])


def test_site_bitmaps_hold_exactly_the_sites(spark):
    at = [0, 1, 63, 64, 1023, 1024, 1025, 5000, 2047, 2048, 1023]
    sites = spark.createDataFrame([(1, p) for p in at] + [(2, 7)], "ref_idx int, ref_pos long")
    for size in (64, 100, 1024):
        got = {(r.ref_idx, r._bin * size + 64 * w + b) for r in B.site_bitmaps(sites, size).collect()
               for w, bits in enumerate(r._sites) for b in range(64) if bits >> b & 1}
        assert got == {(1, p) for p in at} | {(2, 7)}
