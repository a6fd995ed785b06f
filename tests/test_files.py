"""File sources and sinks: ordinals across splits and files, exact chunk files,
ordered VCF, BED and region strings, per-region folders."""

import glob
import gzip
import os

from pyspark.sql import functions as F

from strandline import sinks
from strandline.operators import pairing as P
from strandline.sources import fastq as FQ
from strandline.sources import text_formats as TF


def write_fastq(path, ids, mate):
    with open(path, "w") as f:
        for i in ids:
            f.write(f"@r{i}/{mate}\nACGTACGTAC{i % 10}\n+\nIIIIIIIIII{i % 10}\n")


def test_fastq_ordinals_across_splits_and_files(spark, tmp_out):
    d = os.path.join(tmp_out, "fq")
    os.makedirs(d)
    write_fastq(os.path.join(d, "a.fq"), range(0, 700), 1)
    write_fastq(os.path.join(d, "b.fq"), range(700, 1000), 1)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")   # splits cut records
    try:
        lines = FQ.read_fastq(spark, d)
        assert lines.rdd.getNumPartitions() > 1
        recs = P.group_records(lines).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    got = sorted((r.record_id, r.name, r.seq) for r in recs)
    assert got == [(i, f"@r{i}/1", f"ACGTACGTAC{i % 10}") for i in range(1000)]


def test_sam_file_gets_read_ids_at_ingestion(spark, tmp_out):
    path = os.path.join(tmp_out, "x.sam")
    with open(path, "w") as f:
        f.write("@HD\tVN:1.6\n@SQ\tSN:chr1\tLN:1000\n")
        for i in range(50):                     # both mates share the name
            f.write(f"t{i // 2}\t{65 + 64 * (i % 2)}\tchr1\t{10 + i}\t60\t4M\t*\t0\t0\tACGT\tIIII\n")
    sd = spark.createDataFrame([(0, "chr1", 1000)], "ref_idx int, ref_name string, ref_length int")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "400")
    try:
        got = TF.parse_sam(FQ.read_indexed_lines(spark, path), sd).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted((r.read_id, r.pos) for r in got) == [(i + 2, 10 + i) for i in range(50)]


def test_chunk_files_are_exact_and_ordered(spark, tmp_out):
    d = os.path.join(tmp_out, "in")
    os.makedirs(d)
    write_fastq(os.path.join(d, "fastq1.fq"), range(103), 1)
    write_fastq(os.path.join(d, "fastq2.fq"), range(100), 2)       # shorter mate file
    r1 = P.group_records(FQ.read_fastq(spark, os.path.join(d, "fastq1.fq")))
    r2 = P.group_records(FQ.read_fastq(spark, os.path.join(d, "fastq2.fq")))
    out = os.path.join(tmp_out, "chunks")
    sinks.write_chunks(P.pair_mates(r1, r2), out, 4)
    files = sorted(glob.glob(os.path.join(out, "*.gz")))
    assert len(files) == 4
    texts = [gzip.open(f, "rt").read().splitlines() for f in files]
    assert [len(t) for t in texts] == [200, 200, 200, 200]          # 25 pairs x 8 lines
    # chunk files re-read, in file order, give the input pairs in ordinal order
    names = [ln for t in texts for ln in t if ln.startswith("@r")]
    assert names == [f"@r{i}/{m}" for i in range(100) for m in (1, 2)]
    # and the chunk source lists them back
    assert TF.read_lines(spark, out, "*.gz").count() == 800
    assert FQ.read_chunks(spark, out, "*.gz").select("chunk_file").distinct().count() == 4


def test_ordered_vcf_and_overwrite(spark, tmp_out):
    v = spark.createDataFrame([(2, 5, "chr2\t5"), (1, 9, "chr1\t9"), (1, 3, "chr1\t3"),
                               (10, 1, "chr10\t1")], "chrom int, pos int, line string")
    out = os.path.join(tmp_out, "vcf")
    sinks.write_vcf(v, out, single_file=True)
    sinks.write_vcf(v, out, single_file=True, mode="overwrite")    # K6: replace
    (f,) = glob.glob(os.path.join(out, "part-*"))
    assert open(f).read().splitlines() == ["chr1\t3", "chr1\t9", "chr2\t5", "chr10\t1"]


def test_bed_and_region_strings(spark, tmp_out):
    r = spark.createDataFrame([("chr1", 10, 20)], "ref_name string, start_pos long, end_pos long")
    assert tuple(sinks.to_bed(r).collect()[0]) == ("chr1", 9, 19)            # literal
    assert tuple(sinks.to_bed(r, end_shift=0).collect()[0]) == ("chr1", 9, 20)
    assert sinks.to_region_strings(r).collect()[0].region_string == "chr1:10-20"
    out = os.path.join(tmp_out, "bed")
    sinks.write_tsv(sinks.to_bed(r), out)
    back = TF.read_bed(spark, out).collect()
    assert [tuple(x) for x in back] == [("chr1", 9, 19)]


def test_write_by_region(spark, tmp_out):
    df = spark.createDataFrame([(0, "a"), (1, "b"), (1, "c")], "region int, line string")
    out = os.path.join(tmp_out, "regions")
    sinks.write_by_region(df, out)
    assert sorted(os.path.basename(p) for p in glob.glob(os.path.join(out, "region=*"))) == \
        ["region=0", "region=1"]
    assert spark.read.parquet(out).filter(F.col("region") == 1).count() == 2


def test_fasta_chunks_exact_across_uneven_lines_and_splits(spark, tmp_out):
    import random
    from strandline.sources.fasta import read_fasta_chunks
    rnd = random.Random(7)
    path = os.path.join(tmp_out, "ref.fa")
    contigs = {}
    with open(path, "w") as f:
        for name, n in [("chr1", 3000), ("chr2", 1), ("chrM", 777), ("chrX", 2048)]:
            s = "".join(rnd.choice("ACGTN") for _ in range(n))
            contigs[name] = s
            f.write(f">{name} description\n")
            i = 0
            while i < n:
                w = rnd.choice([60, 61, 17])
                f.write(s[i:i + w] + "\n")
                i += w
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        chunks = read_fasta_chunks(spark, path, bin_size=100).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    for r in chunks:
        assert r.chunk == contigs[r.ref_name][r.chunk_start - 1:r.chunk_start - 1 + len(r.chunk)]
        assert r.bin == r.chunk_start // 100
    for name, s in contigs.items():
        assert sum(len(r.chunk) for r in chunks if r.ref_name == name) == len(s)


def test_pair_count_from_lines_matches_join(spark, tmp_out):
    d = os.path.join(tmp_out, "pc")
    os.makedirs(d)
    write_fastq(os.path.join(d, "a.fq"), range(37), 1)
    write_fastq(os.path.join(d, "b.fq"), range(41), 2)
    l1 = FQ.read_fastq(spark, os.path.join(d, "a.fq"))
    l2 = FQ.read_fastq(spark, os.path.join(d, "b.fq"))
    pairs = P.pair_mates(P.group_records(l1), P.group_records(l2))
    assert pairs.select(P.pair_count(l1, l2)).first()[0] == pairs.count() == 37
    a = P.assign_chunks(pairs, 4, P.pair_count(l1, l2))
    b = P.assign_chunks(pairs, 4)
    assert sorted(tuple(r) for r in a.collect()) == sorted(tuple(r) for r in b.collect())


def test_chunk_files_read_back_as_pairs(spark, tmp_out):
    d = os.path.join(tmp_out, "rt")
    os.makedirs(d)
    write_fastq(os.path.join(d, "fastq1.fq"), range(50), 1)
    write_fastq(os.path.join(d, "fastq2.fq"), range(50), 2)
    r1 = P.group_records(FQ.read_fastq(spark, os.path.join(d, "fastq1.fq")))
    r2 = P.group_records(FQ.read_fastq(spark, os.path.join(d, "fastq2.fq")))
    pairs = P.pair_mates(r1, r2)
    out = os.path.join(tmp_out, "chunks")
    sinks.write_chunks(pairs, out, 3)
    back = FQ.read_chunk_pairs(spark, out).collect()
    assert len(back) == 50 and len({r.chunk_file for r in back}) == 3
    got = sorted((r.pair_id, r.name1, r.seq1, r.qual1, r.name2, r.seq2, r.qual2) for r in back)
    want = sorted((r.record_id, r.name1, r.seq1, r.qual1, r.name2, r.seq2, r.qual2)
                  for r in pairs.collect())
    assert got == want


def test_gzip_chunks_are_folded_without_writing_or_shuffling_lines(spark, tmp_out):
    out = os.path.join(tmp_out, "chunks")
    rows = [(c, i, "\n".join(f"{c}.{i}.{j}" for j in range(8))) for c in range(3) for i in range(7)]
    (spark.createDataFrame(rows, "chunk int, i int, value string").repartition(3, "chunk").sortWithinPartitions("chunk", "i")
     .select("value").write.option("compression", "gzip").text(out))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")     # pairs of 8 lines go across batches
    try:
        pairs = FQ.read_chunk_pairs(spark, out)
        got = [tuple(r) for r in pairs.select("pair_id", *FQ._PAIR_FIELDS).orderBy("pair_id").collect()]
        plan = pairs._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert [r[0] for r in got] == list(range(21))
    assert all(r[1:] == tuple(f"{r[1][:-2]}.{j}" for j in range(8)) for r in got) and len({r[1] for r in got}) == 21
    assert "hashpartitioning" not in plan
