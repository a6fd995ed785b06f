"""Filters and projections reach the Parquet scan of stored alignments."""

import os

from pyspark.sql import functions as F

from conftest import SF001
from strandline.operators import reads as R
from strandline.operators import regions as G
from strandline.plans import fixtures as X
from strandline.sources.alignments import read_alignments, write_alignments


def scan_lines(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [ln for ln in plan.splitlines() if "FileScan" in ln]


def test_contig_filter_prunes_folders_and_projection_prunes_columns(spark, tmp_out):
    path = os.path.join(tmp_out, "aln")
    write_alignments(X.aln(spark, SF001), path, num_partitions=4)
    aln = read_alignments(spark, path)
    q = G.reads_per_chrom(R.primary_mapped(aln))
    (scan,) = scan_lines(q)
    assert "PartitionFilters: [isnotnull(ref_idx" in scan and "(ref_idx#" in scan
    assert "ReadSchema: struct<flag:int>" in scan          # only what the query needs
    assert q.count() == 24
    # a position window is pushed to the Parquet reader (row-group statistics)
    w = aln.filter((F.col("ref_idx") == 3) & F.col("pos").between(1000, 2000)).select("read_id")
    (scan,) = scan_lines(w)
    assert "PushedFilters: [IsNotNull(pos), GreaterThanOrEqual(pos,1000), LessThanOrEqual(pos,2000)]" in scan
    want = X.aln(spark, SF001).filter((F.col("ref_idx") == 3) & F.col("pos").between(1000, 2000))
    assert w.count() == want.count()


def test_wide_columns_of_stored_reads_follow_the_shuffle(spark):
    from strandline.plans import fixtures

    seen = []

    def late(df):
        seen.append(df.columns)
        return df.withColumn("wide", F.repeat(F.lit("x"), 50))

    keys = spark.range(1000).select(F.col("id").alias("k"))
    out = fixtures.stored(spark, ("late_columns",), lambda: keys, "k", finish=late)
    assert seen == [["k"]] and out.columns == ["k", "wide"] and out.count() == 1000
    assert {"seq", "qual"} & {*fixtures.aln.__wrapped__(spark, SF001).columns} == set()
