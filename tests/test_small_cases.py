"""Hand-written cases: rows written here, expected values worked
out by hand, not derived from the code."""

from pyspark.sql import functions as F

from strandline.functions.chrom import chrom_number
from strandline.functions.quality import phred
from strandline.operators import bases as B
from strandline.operators import duplicates as D
from strandline.operators import intervals as I
from strandline.operators import pairing as P
from strandline.operators import reads as R
from strandline.operators import regions as G
from strandline.sources import text_formats as TF

READ_COLS = "read_id long, qname string, flag int, ref_idx int, pos long, mapq int, cigar string, seq string, qual string"


def reads(spark, rows):
    df = spark.createDataFrame(rows, READ_COLS)
    return R.with_alignment_end(df)


def test_gap_of_51_merges_and_52_breaks(spark):
    df = spark.createDataFrame([(1, 1, 1, 10), (2, 1, 61, 70),      # 61 <= 10 + 51: merged
                                (3, 2, 1, 10), (4, 2, 62, 70)],     # 62 >  10 + 51: new range
                               "read_id long, ref_idx int, pos long, end_pos long")
    got = sorted(tuple(r) for r in I.covered_ranges(df).collect())
    assert got == [(1, 1, 70, 2), (2, 1, 10, 1), (2, 62, 70, 1)]


def test_nested_read_uses_running_max_end(spark):
    # a short read inside a long one must not shorten the current range
    df = spark.createDataFrame([(1, 1, 1, 100), (2, 1, 10, 20), (3, 1, 140, 150),
                                (4, 1, 300, 310)],
                               "read_id long, ref_idx int, pos long, end_pos long")
    got = sorted(tuple(r) for r in I.covered_ranges(df).collect())
    assert got == [(1, 1, 150, 3), (1, 300, 310, 1)]


def test_range_crossing_bins(spark):
    df = spark.createDataFrame([(1, 1, 10, 40), (2, 1, 60, 90), (3, 1, 140, 155),
                                (4, 1, 500, 520)],
                               "read_id long, ref_idx int, pos long, end_pos long")
    got = sorted(tuple(r) for r in I.covered_ranges(df, bin_size=16).collect())
    assert got == [(1, 10, 155, 3), (1, 500, 520, 1)]


def test_padded_merge_is_strict(spark):
    # start - 100 < end merges; start - 100 == end does not; start padded, floored at 1
    df = spark.createDataFrame([(1, 5, 50), (1, 149, 160), (1, 260, 270)],
                               "ref_idx int, start_pos long, end_pos long")
    got = sorted(tuple(r) for r in I.padded_ranges(df, 100).collect())
    assert got == [(1, 1, 160), (1, 160, 270)]


def test_range_span_label(spark):
    df = spark.createDataFrame([(1, "chr1", 5, 50), (1, "chr1", 100, 120), (1, "chr1", 90, 200)],
                               "ref_idx int, ref_name string, start_pos long, end_pos long")
    r = I.range_span(df, "ref_idx", "ref_name").collect()[0]
    # last range = largest start (100..120), not the largest end
    assert (r.first_start, r.last_end, r.n_ranges, r.label) == (5, 120, 3, "3regions_chr1-5")


def test_touching_half_open_intervals_do_not_overlap(spark):
    left = spark.createDataFrame([(1, 1, 0, 10), (2, 1, 5, 15)],
                                 "bed_id long, ref_idx int, bstart long, bend long")
    right = spark.createDataFrame([(1, 10, 20)], "ref_idx int, start0 long, end0 long")
    got = sorted(tuple(r) for r in I.interval_intersect(left, right, bin_size=4)
                 .select("bed_id", "istart", "iend").collect())
    assert got == [(2, 10, 15)]


def test_restrict_keeps_each_read_once(spark):
    rd = spark.createDataFrame([(1, 1, 0, 40), (2, 1, 50, 60), (3, 2, 0, 40)],
                               "read_id long, ref_idx int, start0 long, end0 long")
    tg = spark.createDataFrame([(1, 5, 10), (1, 30, 35), (1, 39, 41), (2, 40, 45)],
                               "ref_idx int, bstart long, bend long")
    got = sorted(r.read_id for r in I.interval_restrict(rd, tg, bin_size=8).collect())
    assert got == [1]


def test_restrict_long_reads_exactly_once(spark):
    # bin 8: reads 1, 2 are longer than a bin and overlap several targets in other bins
    rd = spark.createDataFrame([(1, 1, 0, 100), (2, 1, 3, 30), (3, 1, 50, 55), (4, 1, 200, 300)],
                               "read_id long, ref_idx int, start0 long, end0 long")
    tg = spark.createDataFrame([(1, 20, 22), (1, 60, 70), (1, 95, 99), (1, 52, 53)],
                               "ref_idx int, bstart long, bend long")
    got = sorted(r.read_id for r in I.interval_restrict(rd, tg, bin_size=8).collect())
    assert got == [1, 2, 3]


def test_fewer_chromosomes_than_regions_and_ties(spark):
    counts = spark.createDataFrame([(7, 10), (3, 10), (5, 20)], "ref_idx int, n_reads long")
    got = sorted(tuple(r) for r in G.balance_regions(counts, 4).collect())
    # rank: 5 (20), then the tie 3, 7 by ref_idx
    assert got == [(3, 10, 1), (5, 20, 0), (7, 10, 2)]


def test_map_regions_runs_every_region_in_order(spark):
    rows = [(r, 1 + r % 2, p, f"q{r}_{p}") for r in range(3) for p in (30, 10, 20)]
    df = spark.createDataFrame(rows, "region int, ref_idx int, pos long, qname string")
    from strandline.operators.hooks import map_regions

    def fn(pdf):
        ok = bool((pdf[["region", "ref_idx", "pos"]].apply(tuple, axis=1).is_monotonic_increasing))
        return pdf.groupby("region", as_index=False).agg(n=("pos", "size")).assign(ok=ok)

    out = map_regions(df, fn, "region int, n long, ok boolean", num_partitions=2)
    got = out.groupBy("region").agg(F.sum("n").alias("n"), F.min(F.col("ok").cast("int")).alias("ok"))
    assert sorted(tuple(r) for r in got.collect()) == [(0, 3, 1), (1, 3, 1), (2, 3, 1)]


def test_map_regions_empty_input(spark):
    from strandline.operators.hooks import map_regions
    df = spark.createDataFrame([], "region int, ref_idx int, pos long, qname string")
    out = map_regions(df, lambda pdf: pdf, "region int, ref_idx int, pos long, qname string")
    assert out.count() == 0


def test_duplicate_on_reverse_strand_with_trailing_clip(spark):
    hi, lo = "I" * 32, "5" * 32           # scores 40*32 vs 20*32
    df = reads(spark, [
        (1, "a", 16, 1, 100, 60, "32M", "A" * 32, lo),     # 5' end = 131
        (2, "b", 16, 1, 100, 60, "28M4S", "A" * 32, hi),   # 5' end = 127 + 4 = 131 -> same group
        (3, "c", 16, 1, 104, 60, "28M4S", "A" * 32, hi),   # 5' end = 131 + 4 = 135
        (4, "d", 0, 1, 104, 60, "4S28M", "A" * 32, hi),    # forward: 5' = 100, other strand
        (5, "e", 0, 1, 100, 60, "32M", "A" * 32, hi),      # forward, 5' = 100, tie on score
    ])
    got = {r.read_id: r.dup for r in D.mark_duplicates(df).collect()}
    assert got == {1: 1, 2: 0, 3: 0, 4: 0, 5: 1}          # tie broken by name: d < e


def test_paired_duplicates_use_both_ends(spark):
    hi, lo = "I" * 32, "5" * 32
    df = reads(spark, [
        # template a: ends at 100 (+) and 400 (-);  template b: same two ends, higher score
        (1, "a", 1 + 64 + 32, 1, 100, 60, "32M", "A" * 32, lo),
        (2, "a", 1 + 128 + 16, 1, 369, 60, "32M", "A" * 32, lo),     # 5' end = 400
        (3, "b", 1 + 64 + 32, 1, 100, 60, "32M", "A" * 32, hi),
        (4, "b", 1 + 128 + 16, 1, 369, 60, "32M", "A" * 32, hi),
        # template c: same first end, other second end -> not a duplicate
        (5, "c", 1 + 64 + 32, 1, 100, 60, "32M", "A" * 32, lo),
        (6, "c", 1 + 128 + 16, 1, 379, 60, "32M", "A" * 32, lo),
        # fragment (mate unmapped) on a paired end -> duplicate
        (7, "d", 1 + 64 + 8, 1, 100, 60, "32M", "A" * 32, hi),
        (8, "d", 1 + 128 + 4, 1, 100, 0, "*", "A" * 32, hi),
        # two fragments elsewhere: the better one is kept
        (9, "e", 0, 1, 900, 60, "32M", "A" * 32, lo),
        (10, "f", 0, 1, 900, 60, "32M", "A" * 32, hi),
        # secondary record of b: left alone
        (11, "b", 1 + 64 + 256, 1, 100, 60, "32M", "A" * 32, lo),
    ])
    got = {r.read_id: r.dup for r in D.mark_duplicates_paired(df).collect()}
    assert got == {1: 1, 2: 1, 3: 0, 4: 0, 5: 0, 6: 0, 7: 1, 8: 0, 9: 1, 10: 0, 11: 0}


def test_score_counts_only_qualities_from_15(spark):
    df = spark.createDataFrame([("#0I",)], "qual string")  # 2, 15, 40
    assert df.select(D.duplicate_score("qual")).collect()[0][0] == 55


def test_chrom_numbers(spark):
    df = spark.createDataFrame([("chr1",), ("chr22",), ("chrX",), ("chrX_random",), ("chrY",),
                                ("chrM",), ("chr1_random",), ("1",)], "n string")
    got = [r[0] for r in df.select(chrom_number("n")).collect()]
    assert got == [1, 22, 23, 23, 24, None, None, None]


def test_vcf_skips_header_and_keeps_chrM_row(spark):
    lines = spark.createDataFrame([("##fileformat=VCFv4.2",), ("#CHROM\tPOS",),
                                   ("chrM\t5\t.\tA\tG",), ("chr2\t7\t.\tA\tG",)], "value string")
    got = sorted((r.chrom or 0, r.pos) for r in TF.parse_vcf(lines).collect())
    assert got == [(0, 5), (2, 7)]


def test_empty_and_absent_qualities(spark):
    df = spark.createDataFrame([("",), ("*",), (None,), ("!+",)], "q string")
    got = [r[0] for r in df.select(phred("q")).collect()]
    assert got == [None, None, None, [0, 10]]


def test_malformed_sam_lines_are_kept(spark):
    lines = spark.createDataFrame([
        ("@HD\tVN:1.6",), ("@SQ\tSN:chr1\tLN:100",),
        ("r1\t0\tchr1\t5\t60\t4M\t*\t0\t0\tACGT\tIIII",),
        ("r2\t0\tchr1\t5",),
        ("r3\tX\tchr1\t5\t60\t4M\t*\t0\t0\tACGT\tIIII",),
        ("r4\t4\t*\t0\t0\t*\t*\t0\t0\tACGT\tIIII",)], "value string")
    sd = spark.createDataFrame([(0, "chr1", 100)], "ref_idx int, ref_name string, ref_length int")
    rows = {r.qname or r._corrupt[:2]: r for r in TF.parse_sam(lines, sd).collect()}
    assert rows["r1"].ref_idx == 0 and rows["r1"].pos == 5 and rows["r1"]._corrupt is None
    assert rows["r2"].flag is None and rows["r2"]._corrupt.startswith("r2")
    assert rows["r3"].flag is None and rows["r3"]._corrupt.startswith("r3")
    assert rows["r4"].ref_idx == -1
    assert len(rows) == 4


def test_dictionary_non_numeric_length_is_zero(spark):
    lines = spark.createDataFrame([(0, "@HD\tVN:1.6"), (1, "@SQ\tSN:chrM\tLN:16571"),
                                   (2, "@SQ\tSN:chr1\tLN:abc")], "idx long, value string")
    got = sorted(tuple(r) for r in TF.parse_dict(lines).collect())
    assert got == [(0, "chrM", 16571), (1, "chr1", 0)]


def test_encoding_from_first_read_and_fix(spark):
    ill = "".join(chr(ord(c) + 31) for c in "I5")   # Illumina-1.3 text of 40, 20
    df = spark.createDataFrame([
        (1, 1, 10, ill), (2, 1, 20, "#I"),          # group 1: first read is Illumina
        (3, 2, 5, "II"), (4, 2, 9, ill)],           # group 2: first read is Sanger
        "read_id long, ref_idx int, pos long, qual string")
    enc = {r.ref_idx: r.encoding for r in R.guess_encoding(df).collect()}
    assert enc == {1: "ILLUMINA", 2: "SANGER"}
    fixed = {r.read_id: (r.qual, r.quality_error) for r in R.fix_qualities(df).collect()}
    assert fixed[1] == ("I5", False)
    assert fixed[2] == (None, True)                 # '#' (2) - 31 < 0
    assert fixed[3] == ("II", False) and fixed[4] == (ill, False)


def test_clean_alignment_clips_past_chromosome_end(spark):
    df = spark.createDataFrame([
        (1, 0, 95, 60, "10M"),          # ends at 104 > 100: 6M4S
        (2, 0, 90, 60, "10M2D22M"),     # 10M reaches 99, D covers 100..101: 10M22S
        (3, 0, 80, 60, "4S28M"),        # M covers 80..107: 4S21M7S
        (4, 4, 50, 60, "10M"),          # unmapped: mapq 0, no clip needed
        (5, 0, 96, 60, "2M2I4M3S")],    # M 96..97, I, M 98..101: 2M2I3M4S
        "read_id long, flag int, pos long, mapq int, cigar string")
    out = R.clean_alignments(df.withColumn("ref_length", F.lit(100).cast("long")))
    got = {r.read_id: (r.cigar, r.mapq, r.end_pos) for r in out.collect()}
    assert got[1] == ("6M4S", 60, 100)
    assert got[2] == ("10M22S", 60, 99)
    assert got[3] == ("4S21M7S", 60, 100)
    assert got[4] == ("10M", 0, 59)
    assert got[5] == ("2M2I3M4S", 60, 100)


def test_record_fold_is_order_independent(spark):
    lines = spark.createDataFrame([(7, "IIII"), (4, "@a"), (6, "+"), (5, "ACGT")],
                                  "idx long, line string")
    r = P.group_records(lines).collect()[0]
    assert (r.record_id, r.name, r.seq, r.plus, r.qual) == (1, "@a", "ACGT", "+", "IIII")


def test_unequal_mate_files_drop_unpaired(spark):
    def recs(n, m):
        rows = [(4 * i + k, v) for i in range(n)
                for k, v in enumerate([f"@r{i}/{m}", "ACGT", "+", "IIII"])]
        return P.group_records(spark.createDataFrame(rows, "idx long, line string"))
    pairs = P.pair_mates(recs(5, 1), recs(3, 2))
    assert sorted(r.record_id for r in pairs.collect()) == [0, 1, 2]
    chunks = P.assign_chunks(pairs, 2).collect()
    assert sorted((r.record_id, r.chunk) for r in chunks) == [(0, 0), (1, 0), (2, 1)]


def test_variant_call_rules(spark):
    pile = spark.createDataFrame([
        (1, 10, "A", "A", 5, 150), (1, 10, "A", "G", 2, 60), (1, 10, "A", "T", 2, 60),  # tie -> G
        (1, 20, "C", "T", 9, 300), (1, 20, "C", "C", 1, 30),                          # 90% -> 1/1
        (1, 30, "G", "A", 1, 29), (1, 30, "G", "G", 1, 40),                           # qual < 30
        (1, 40, "T", "C", 1, 35), (1, 40, "T", "T", 9, 300)],                          # share 10%
        "ref_idx int, ref_pos long, ref_base string, base string, depth long, qsum long")
    got = sorted(tuple(r) for r in B.call_variants(pile).collect())
    assert got == [(1, 10, "A", "G", 60, 2, 9, "0/1"), (1, 20, "C", "T", 300, 9, 10, "1/1")]


def test_contig_long_intervals_cost_a_bounded_number_of_rows(spark):
    """One interval over a whole 250 Mb contig among many short ones."""
    from pyspark.sql import functions as F
    n = 20_000
    short = spark.range(n).select(F.col("id"), F.lit(1).alias("ref_idx"), (F.col("id") * 12_345 % 249_999_000).alias("bstart")).withColumn(
        "bend", F.col("bstart") + 1 + F.col("id") % 900)
    whole = spark.createDataFrame([(1, 0, 250_000_000), (1, 5_000, 5_100), (2, 0, 10)], "ref_idx int, start0 long, end0 long")
    rows = I._probes(short.unionByName(whole.selectExpr("0 id", "ref_idx", "start0 bstart", "end0 bend"))
                     .withColumn("_level", I._level(F.col("bend") - F.col("bstart"), 1024)), "bstart", "bend", list(range(9)), 1024, False)
    assert rows.groupBy("ref_idx", "bstart", "bend").count().agg(F.max("count")).first()[0] <= 3 * 9
    data = [(r.id, r.bstart, r.bend) for r in short.collect()]
    for left, right, iv in ((short, whole, False), (whole, short, True)):
        j = I.interval_intersect(left, right, "ref_idx", *((("bstart", "bend"), ("start0", "end0")) if not iv else (("start0", "end0"), ("bstart", "bend"))))
        got = sorted((r.istart, r.iend) for r in j.collect())
        assert got == sorted((max(s, a), min(e, b)) for _, s, e in data for a, b in ((0, 250_000_000), (5_000, 5_100)) if s < b and a < e)
    assert I.interval_restrict(short.withColumnsRenamed({"bstart": "start0", "bend": "end0"}),
                               whole.withColumnsRenamed({"start0": "bstart", "end0": "bend"})).count() == n
    back = I.interval_restrict(whole, short)
    assert sorted((r.start0, r.end0) for r in back.collect()) == sorted({(a, b) for a, b in ((0, 250_000_000), (5_000, 5_100)) if any(s < b and a < e for _, s, e in data)})
