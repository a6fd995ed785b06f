"""F1 on whole chunks and F2 with context: results do not depend on batches or layout."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from strandline.operators import hooks as H

READS = "read_id long, ref_idx int, pos long, end_pos long"


def _reads(spark, n=3000, hot=0):
    rng = np.random.default_rng(4)
    pos = np.concatenate([rng.integers(1, 40_000, n), rng.integers(8_000, 8_600, hot)])
    end = pos + rng.integers(0, 150, n + hot)
    pdf = pd.DataFrame({"read_id": np.arange(n + hot), "ref_idx": rng.integers(1, 3, n + hot).astype("int32"), "pos": pos, "end_pos": end})
    return pdf, spark.createDataFrame(pdf, READS)


def _cover():
    """Reads over each read's first base: needs reads that start before the region."""
    def fn(pdf, region):
        s, e = pdf["pos"].to_numpy(), pdf["end_pos"].to_numpy()
        over = [int(((s <= p) & (e >= p)).sum()) for p in s]
        return pdf[["read_id", "pos"]].assign(over=over)
    return fn


@pytest.mark.parametrize("bin_size, max_rows, batch, partitions", [(1 << 12, 10_000, 10_000, 4), (1 << 12, 700, 64, 7), (1 << 16, 800, 10_000, 2)])
def test_halo_regions_equal_brute_force(spark, bin_size, max_rows, batch, partitions):
    pdf, df = _reads(spark, hot=1500)
    want = {}
    for _, g in pdf.groupby("ref_idx"):
        want |= {r.read_id: r.over for r in _cover()(g, None).itertuples()}
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        out = H.map_regions_halo(df.repartition(partitions), _cover(), "read_id long, pos long, over long", "pos",
                                 bin_size=bin_size, halo=150, max_rows=max_rows, levels=10).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert len(out) == len(pdf) and {r.read_id: r.over for r in out} == want


def test_halo_regions_are_bounded_and_deep_ones_refused(spark):
    _, df = _reads(spark, hot=1500)
    bins = H.halo_bins(df, 1 << 12, 10, 300, 8)
    assert {r["_level"] for r in bins.select("_level").distinct().collect()} > {0}
    with pytest.raises(ValueError, match="exceed max_rows"):
        H.halo_bins(df, 1 << 12, 10, 20, 8)
    none = spark.createDataFrame([], READS)
    assert H.map_regions_halo(none, _cover(), "read_id long, pos long, over long", "pos").count() == 0


@pytest.mark.parametrize("batch, partitions", [(10_000, 4), (7, 3)])
def test_chunk_streams_see_whole_chunks_in_order(spark, batch, partitions):
    def fn(chunk, batches):
        seen = [x for pdf in batches for x in pdf["v"]]
        yield pd.DataFrame({"chunk": [chunk], "first": [seen[0]], "n": [len(seen)], "sorted": [seen == sorted(seen)]})
    df = spark.range(500).select(F.when(F.col("id") % 5 < 4, F.col("id") % 5).cast("int").alias("chunk"), (-F.col("id")).alias("v"))
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        out = H.map_chunk_streams(df, fn, "chunk int, first long, n long, sorted boolean", ["v"], num_partitions=partitions).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert sorted((r.chunk if r.chunk is not None else 9, r.n, r.sorted) for r in out) == [(k, 100, True) for k in (0, 1, 2, 3, 9)]
    none = spark.createDataFrame([], "chunk int, v long")
    assert H.map_chunk_streams(none, fn, "chunk int, first long, n long, sorted boolean", ["v"]).count() == 0


def test_chunk_process(spark):
    df = spark.range(1000).select((F.col("id") % 3).cast("int").alias("chunk"), F.col("id").cast("string").alias("value"), "id")
    out = H.map_chunk_streams(df, H.chunk_process(lambda c: ["awk", "{ n++; print $1 } END { print \"lines \" n }"]),
                              "chunk int, value string", ["id"]).collect()
    assert sorted((r.chunk, r.value) for r in out if r.value.startswith("lines")) == [(0, "lines 334"), (1, "lines 333"), (2, "lines 333")]
    assert len(out) == 1003
    with pytest.raises(Exception, match="process ended with 3"):
        H.map_chunk_streams(df, H.chunk_process(lambda c: ["sh", "-c", "exit 3"]), "chunk int, value string", ["id"]).collect()
