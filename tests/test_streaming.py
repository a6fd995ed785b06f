"""The streaming region table equals the batch one once every chunk has arrived."""

import os

from pyspark.sql import functions as F

from conftest import SF001
from strandline.operators import regions as G
from strandline.plans import fixtures as X
from strandline.sinks import read_published
from strandline.streaming import read_alignment_stream, start_region_table


def test_stream_of_chunks_gives_batch_regions(spark, tmp_out):
    aln = X.aln(spark, SF001)
    inbox = os.path.join(tmp_out, "aligned")
    for c in range(3):      # three aligned chunks land in the folder
        aln.filter(F.col("read_id") % 3 == c).write.parquet(os.path.join(inbox, f"chunk{c}"))
    out = os.path.join(tmp_out, "regions")
    stream = read_alignment_stream(spark, os.path.join(inbox, "*"), aln.schema,
                                   max_files_per_trigger=1)
    q = start_region_table(stream, 4, out, name=f"regions-{os.path.basename(tmp_out)}")
    q.awaitTermination(300)
    got = sorted(tuple(r) for r in read_published(spark, out).collect())
    want = sorted(tuple(r) for r in G.balance_regions(
        G.reads_per_chrom(X.kept(spark, SF001)), 4).collect())
    assert got == want


def test_stream_chunk_counts(spark, tmp_out):
    from strandline.streaming import start_chunk_counts
    aln = X.aln(spark, SF001)
    inbox = os.path.join(tmp_out, "aligned")
    for c in range(3):
        aln.filter(F.col("read_id") % 3 == c).coalesce(1).write.parquet(os.path.join(inbox, f"c{c}"))
    out = os.path.join(tmp_out, "counts")
    stream = read_alignment_stream(spark, os.path.join(inbox, "*"), aln.schema, max_files_per_trigger=1)
    q = start_chunk_counts(stream, out, name=f"counts-{os.path.basename(tmp_out)}")
    q.awaitTermination(300)
    got = read_published(spark, out)
    assert got.count() == 3
    tot = got.agg(F.sum("n_reads"), F.sum("n_kept")).first()
    assert tot[0] == aln.count() and tot[1] == X.kept(spark, SF001).count()
