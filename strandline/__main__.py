"""Command line for the two jobs (``python -m strandline ...`` or ``spark-submit``).

    chunk N INPUT_FOLDER OUTPUT_FOLDER
        INPUT_FOLDER/fastq1.fq + fastq2.fq -> N interleaved gzip chunks
    call N ALIGNMENTS DICT FASTA OUTPUT [--known-sites VCF] [--targets BED]
         [--per-region] [--single-file]
        aligned reads (Parquet written by sources.alignments.write_alignments)
        -> merged, ordered VCF body in OUTPUT
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="strandline")
    sub = p.add_subparsers(dest="cmd", required=True)
    c = sub.add_parser("chunk")
    c.add_argument("n", type=int)
    c.add_argument("input")
    c.add_argument("output")
    v = sub.add_parser("call")
    v.add_argument("n", type=int)
    v.add_argument("alignments")
    v.add_argument("dict")
    v.add_argument("fasta")
    v.add_argument("output")
    v.add_argument("--known-sites")
    v.add_argument("--targets")
    v.add_argument("--per-region", action="store_true")
    v.add_argument("--single-file", action="store_true")
    a = p.parse_args(argv)

    from . import jobs
    spark = SparkSession.builder.appName("strandline").getOrCreate()
    if a.cmd == "chunk":
        jobs.chunk_fastq(spark, os.path.join(a.input, "fastq1.fq"),
                         os.path.join(a.input, "fastq2.fq"), a.output, a.n)
        return
    from .sources.alignments import read_alignments
    from .sources.fasta import read_fasta_chunks
    from .sources.fastq import read_indexed_lines
    from .sources.text_formats import (bed_with_ref_idx, parse_dict, read_bed,
                                       read_known_sites, read_lines)
    seq_dict = parse_dict(read_indexed_lines(spark, a.dict))
    sites = read_known_sites(read_lines(spark, a.known_sites), seq_dict) if a.known_sites else None
    targets = bed_with_ref_idx(read_bed(spark, a.targets), seq_dict) if a.targets else None
    jobs.call_variants_from_alignments(
        read_alignments(spark, a.alignments), seq_dict, a.n, a.output,
        ref_base=read_fasta_chunks(spark, a.fasta), known_sites=sites, targets=targets,
        recal_per_region=a.per_region, single_file=a.single_file)


if __name__ == "__main__":
    main()
