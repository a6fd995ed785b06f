"""The two composed jobs on files, end to end."""

import glob
import gzip
import os

from pyspark.sql import functions as F

from conftest import SF01
from strandline import jobs
from strandline.operators import bases as B
from strandline.plans import fixtures as X
from strandline.sources import text_formats as TF


def test_chunk_fastq_job(spark, tmp_out):
    d = os.path.join(tmp_out, "in")
    os.makedirs(d)
    for m in (1, 2):
        with open(os.path.join(d, f"fastq{m}.fq"), "w") as f:
            for i in range(61):
                f.write(f"@r{i}/{m}\nACGT\n+\nIIII\n")
    out = os.path.join(tmp_out, "chunks")
    a = jobs.chunk_fastq(spark, os.path.join(d, "fastq1.fq"), os.path.join(d, "fastq2.fq"), out, 3)
    assert a.count() == 61
    files = sorted(glob.glob(os.path.join(out, "*.gz")))
    sizes = [len(gzip.open(f, "rt").read().splitlines()) // 8 for f in files]
    assert sizes == [21, 20, 20]


def test_variant_job_finds_planted_snps(spark, tmp_out):
    dense = X.dense(spark, SF01)
    out = os.path.join(tmp_out, "vcf")
    calls = jobs.call_variants_from_alignments(
        dense, X.seq_dict(spark, SF01), 4, out, ref_base=X.genome_base,
        known_sites=X.known_sites_from_reads(dense), single_file=True)
    got = calls.select("ref_pos", "chrom", "region", "line").collect()
    assert len(got) > 100
    planted = sum(1 for r in got if r.ref_pos % 100 == 17)
    assert planted / len(got) > 0.5                  # SNPs planted at ref_pos % 100 == 17
    (f,) = glob.glob(os.path.join(out, "part-*"))
    lines = open(f).read().splitlines()
    assert len(lines) == len(got)
    parsed = TF.parse_vcf(spark.createDataFrame([(ln,) for ln in lines], "value string")).collect()
    keys = [(r.chrom, r.pos) for r in parsed]
    assert keys == sorted(keys)                      # ordered by chromosome, then position
    assert calls.filter(F.col("region").isNull()).count() == 0


def test_variant_job_with_fasta_reference(spark, tmp_out):
    from strandline.sources.fasta import read_fasta_chunks
    path = os.path.join(tmp_out, "genome.fa")
    names = {i: f"chr{i}" for i in range(1, 23)} | {23: "chrX", 24: "chrY"}
    with open(path, "w") as f:
        for i, name in names.items():
            f.write(f">{name}\n")
            seq = "".join("ACGT"[((p * p + 3 * p + i) % 7 + p) % 4] for p in range(1, 3101))
            for k in range(0, len(seq), 70):
                f.write(seq[k:k + 70] + "\n")
    dense = X.dense(spark, SF01)
    sd, sites = X.seq_dict(spark, SF01), X.known_sites_from_reads(dense)
    by_chunks = jobs.call_variants_from_alignments(
        dense, sd, 4, ref_base=read_fasta_chunks(spark, path), known_sites=sites)
    by_formula = jobs.call_variants_from_alignments(
        dense, sd, 4, ref_base=X.genome_base, known_sites=sites)
    cols = ["ref_idx", "ref_pos", "ref_base", "alt", "qual", "ad", "dp", "gt"]
    a = sorted(tuple(r) for r in by_chunks.select(*cols).collect())
    assert a and a == sorted(tuple(r) for r in by_formula.select(*cols).collect())


def test_command_line_runs_both_jobs(spark, tmp_out):
    from strandline.__main__ import main
    from strandline.sources.alignments import write_alignments
    d = os.path.join(tmp_out, "in")
    os.makedirs(d)
    for m in (1, 2):
        with open(os.path.join(d, f"fastq{m}.fq"), "w") as f:
            for i in range(10):
                f.write(f"@r{i}/{m}\nACGT\n+\nIIII\n")
    main(["chunk", "2", d, os.path.join(tmp_out, "chunks")])
    assert len(glob.glob(os.path.join(tmp_out, "chunks", "*.gz"))) == 2

    dense = X.dense(spark, SF01)
    write_alignments(dense.drop("end_pos"), os.path.join(tmp_out, "aln"), num_partitions=4)
    sd = sorted(tuple(r) for r in X.seq_dict(spark, SF01).collect())
    with open(os.path.join(tmp_out, "ref.dict"), "w") as f:
        f.write("@HD\tVN:1.6\n")
        f.writelines(f"@SQ\tSN:{name}\tLN:{length}\n" for _, name, length in sd)
    with open(os.path.join(tmp_out, "ref.fa"), "w") as f:
        for i, name, _ in sd:
            f.write(f">{name}\n")
            seq = "".join("ACGT"[((p * p + 3 * p + i) % 7 + p) % 4] for p in range(1, 3101))
            f.writelines(seq[k:k + 60] + "\n" for k in range(0, len(seq), 60))
    names = {i: n for i, n, _ in sd}
    sites = X.known_sites_from_reads(dense).collect()
    with open(os.path.join(tmp_out, "sites.vcf"), "w") as f:
        f.write("##fileformat=VCFv4.2\n")
        f.writelines(f"{names[r.ref_idx]}\t{r.ref_pos}\t.\tN\t.\n" for r in sites)
    with open(os.path.join(tmp_out, "targets.bed"), "w") as f:
        f.write("track name=t\n")
        f.writelines(f"{names[c]}\t0\t1500\n" for c in range(1, 25))
    out = os.path.join(tmp_out, "vcf")
    main(["call", "4", os.path.join(tmp_out, "aln"), os.path.join(tmp_out, "ref.dict"),
          os.path.join(tmp_out, "ref.fa"), out, "--known-sites", os.path.join(tmp_out, "sites.vcf"),
          "--targets", os.path.join(tmp_out, "targets.bed"), "--per-region", "--single-file"])
    (f,) = glob.glob(os.path.join(out, "part-*"))
    lines = open(f).read().splitlines()
    assert lines and all(int(ln.split("\t")[1]) <= 1500 for ln in lines)
    direct = jobs.call_variants_from_alignments(
        dense, X.seq_dict(spark, SF01), 4, ref_base=X.genome_base,
        known_sites=X.known_sites_from_reads(dense), recal_per_region=True,
        targets=spark.createDataFrame([(c, 0, 1500) for c in range(1, 25)],
                                      "ref_idx int, bstart long, bend long"))
    assert sorted(lines) == sorted(r.line for r in direct.collect())


def test_aligner_seam_from_chunk_files(spark, tmp_out):
    import pandas as pd
    from strandline.operators.hooks import map_chunks
    from strandline.sources.fastq import read_chunk_pairs
    d = os.path.join(tmp_out, "in")
    os.makedirs(d)
    for m in (1, 2):
        with open(os.path.join(d, f"fastq{m}.fq"), "w") as f:
            for i in range(30):
                f.write(f"@r{i}/{m}\nACGTACGT\n+\nIIIIIIII\n")
    jobs.chunk_fastq(spark, os.path.join(d, "fastq1.fq"), os.path.join(d, "fastq2.fq"),
                     os.path.join(tmp_out, "chunks"), 3)

    def toy_aligner(pdf: pd.DataFrame) -> pd.DataFrame:
        # places mate 1 at 100 * i + 1 and mate 2 two hundred bases on, on chr1
        out = []
        for _, r in pdf.iterrows():
            i = int(r["name1"][2:].split("/")[0])
            q = r["name1"][1:].split("/")[0]
            out.append(f"{q}\t99\tchr1\t{100 * i + 1}\t60\t8M\t=\t0\t0\t{r['seq1']}\t{r['qual1']}")
            out.append(f"{q}\t147\tchr1\t{100 * i + 201}\t60\t8M\t=\t0\t0\t{r['seq2']}\t{r['qual2']}")
        return pd.DataFrame({"value": out})

    pairs = read_chunk_pairs(spark, os.path.join(tmp_out, "chunks"))
    sam = map_chunks(pairs, toy_aligner, "value string")
    sd = spark.createDataFrame([(1, "chr1", 10000)], "ref_idx int, ref_name string, ref_length int")
    aln = TF.parse_sam(sam, sd).collect()
    assert len(aln) == 60 and all(r._corrupt is None and r.ref_idx == 1 for r in aln)
    assert sorted(r.pos for r in aln if r.flag == 99) == [100 * i + 1 for i in range(30)]
