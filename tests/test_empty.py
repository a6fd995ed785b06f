"""Operators on empty inputs return empty results (no failure on empty tables, empty
bin tables, empty recalibration maps or empty size checks)."""

from strandline.operators import bases as B
from strandline.operators import duplicates as D
from strandline.operators import intervals as I
from strandline.operators import pairing as P
from strandline.operators import reads as R
from strandline.operators import regions as G

READS = ("read_id long, qname string, flag int, ref_idx int, pos long, mapq int, cigar string, "
         "seq string, qual string, end_pos long, region int")


def test_operators_on_empty_input(spark):
    r = spark.createDataFrame([], READS)
    assert I.covered_ranges(r).count() == 0
    assert I.padded_ranges(I.covered_ranges(r), 100).count() == 0
    assert I.range_span(I.covered_ranges(r)).count() == 0
    iv = spark.createDataFrame([], "bed_id long, ref_idx int, bstart long, bend long")
    rr = spark.createDataFrame([], "ref_idx int, start0 long, end0 long")
    assert I.interval_intersect(iv, rr).count() == 0
    assert I.interval_intersect(iv, rr, bin_size=None).count() == 0
    rd = spark.createDataFrame([], "read_id long, ref_idx int, start0 long, end0 long")
    assert I.interval_restrict(rd, iv).count() == 0
    regions = G.balance_regions(G.reads_per_chrom(r), 4)
    assert regions.count() == 0 and G.assign_regions(r, regions).count() == 0
    assert G.rank_within(r, "region", ["ref_idx", "pos", "qname"]).count() == 0
    assert D.mark_duplicates(r).count() == 0 and D.mark_duplicates_paired(r).count() == 0
    assert R.guess_encoding(r).count() == 0 and R.fix_qualities(r).count() == 0
    b0 = B.aligned_bases(r)
    bases = b0.withColumn("ref_base", b0["base"])
    table = B.recal_table(bases)
    assert table.count() == 0 and B.recal_apply(r, table).count() == 0
    assert B.call_variants(B.pileup(bases)).count() == 0
    sites = spark.createDataFrame([], "ref_idx int, ref_pos long")
    assert B.aligned_bases_off_sites(r, sites).count() == 0
    assert B.indel_targets(r).count() == 0
    lines = spark.createDataFrame([], "idx long, line string")
    assert P.pair_mates(P.group_records(lines), P.group_records(lines)).count() == 0
