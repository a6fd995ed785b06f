"""Publication at one moment, single files without one task, and deleted intermediates."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from strandline import jobs, sinks
from strandline.plans import fixtures as X
from strandline.session import checkpoint_dir, materialize, scratch


def _ids(df):
    return sorted(r.id for r in df.collect())


def test_a_death_between_the_steps_leaves_the_old_result(spark, tmp_out, monkeypatch):
    out = os.path.join(tmp_out, "result")
    with pytest.raises(ValueError, match="nothing has been published"):
        sinks.read_published(spark, out)
    sinks.publish(spark.range(5), out)
    assert _ids(sinks.read_published(spark, out)) == [0, 1, 2, 3, 4]
    # killed after the new version is written, before the pointer moves
    with monkeypatch.context() as m:
        m.setattr(sinks, "point_to", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            sinks.publish(spark.range(9), out)
    assert _ids(sinks.read_published(spark, out)) == [0, 1, 2, 3, 4]
    # a job that fails while writing
    broken = spark.range(3).select(F.raise_error(F.lit("lost")).cast("long").alias("id"))
    with pytest.raises(Exception, match="lost"):
        sinks.publish(broken, out)
    assert _ids(sinks.read_published(spark, out)) == [0, 1, 2, 3, 4]
    begun = sinks.read_published(spark, out)
    sinks.publish(spark.range(2), out)
    # a reader that had begun goes on with its version; what the dead jobs left is gone
    assert _ids(begun) == [0, 1, 2, 3, 4] and _ids(sinks.read_published(spark, out)) == [0, 1]
    assert len(os.listdir(os.path.join(out, "_versions"))) == 2
    sinks.publish(spark.range(1).withColumn("region", F.lit(7)), out, ["region"], keep=1)
    assert sinks.read_published(spark, out).select("region").first().region == 7
    assert len(os.listdir(os.path.join(out, "_versions"))) == 1


def test_one_file_in_order(spark, tmp_out):
    out = os.path.join(tmp_out, "vcf")
    v = spark.range(5000).select((F.col("id") % 7).cast("int").alias("chrom"), F.col("id").cast("int").alias("pos"),
                                 F.concat(F.lit("line "), "id").alias("line")).repartition(9)
    sinks.write_vcf(v, out, single_file=True, header=["##a", "#b"])
    (f,) = glob.glob(os.path.join(out, "part-*"))
    want = [f"line {i}" for _, i in sorted((i % 7, i) for i in range(5000))]
    assert open(f).read().splitlines() == ["##a", "#b", *want]
    with pytest.raises(ValueError, match="exists"):
        sinks.write_vcf(v, out, single_file=True)
    sinks.write_vcf(v.limit(0), out, single_file=True, mode="overwrite", header=["##c"])
    assert [x.value for x in spark.read.text(out).collect()] == ["##c"]
    assert os.listdir(tmp_out) == ["vcf"]       # nothing staged is left


def test_text_by_region_is_in_order(spark, tmp_out):
    out = os.path.join(tmp_out, "regions")
    df = spark.range(3000).select((F.col("id") % 3).alias("region"), "id", F.col("id").cast("string").alias("value")).repartition(7)
    sinks.write_text_by_region(df, out, order=["id"])
    for k in range(3):
        files = sorted(glob.glob(os.path.join(out, f"region={k}", "part-*")))
        assert [x for f in files for x in open(f).read().split()] == [str(i) for i in range(k, 3000, 3)]


def _left(spark):
    d = os.path.join(checkpoint_dir(spark).removeprefix("file:"), "strandline")
    return {x for x in os.listdir(d) if not x.startswith("fixture-")} if os.path.isdir(d) else set()


def test_scopes_delete_what_was_written(spark):
    before = _left(spark)
    with scratch(spark):
        with scratch(spark) as inner:
            a, b = materialize(spark.range(3), "a"), materialize(spark.range(4), "b")
            inner.keep(b)
        assert len(_left(spark) - before) == 1 and b.count() == 4
        with pytest.raises(ValueError, match="written in this scope"):
            inner.keep(a)
    assert _left(spark) == before
    with pytest.raises(Exception, match="lost"), scratch(spark):
        materialize(spark.range(3), "c")
        materialize(spark.range(3).select(F.raise_error(F.lit("lost"))), "d")
    assert _left(spark) == before


def test_job_leaves_its_outputs_only(spark, tmp_out):
    dense, sd = X.dense(spark, SF001), X.seq_dict(spark, SF001)
    before, out, region = _left(spark), os.path.join(tmp_out, "vcf"), os.path.join(tmp_out, "regions")
    with scratch(spark):
        calls = jobs.call_variants_from_alignments(dense, sd, 3, out, ref_base=X.genome_base, single_file=True,
                                                   region_out=region, min_qual=20, header=["##fileformat=VCFv4.2"])
        assert len(_left(spark) - before) == 1
        rows = calls.select("region", "chrom", "pos", "line").collect()
    assert _left(spark) == before
    lines = open(glob.glob(os.path.join(out, "part-*"))[0]).read().splitlines()
    assert lines[1:] == [r.line for r in sorted(rows, key=lambda r: (r.chrom, r.pos, r.line))] and rows
    for k in {r.region for r in rows}:
        files = sorted(glob.glob(os.path.join(region, "vcf", f"region={k}", "part-*")))
        got = [x for f in files for x in open(f).read().splitlines()]
        assert got == [r.line for r in sorted((r for r in rows if r.region == k), key=lambda r: (r.chrom, r.pos, r.line))]
    metrics = spark.read.parquet(os.path.join(region, "metrics"))
    assert {r.region for r in metrics.collect()} == {0, 1, 2}
    bed = spark.read.text(os.path.join(region, "ranges")).collect()
    assert bed and all(int(r.value.split("\t")[1]) < int(r.value.split("\t")[2]) for r in bed)
    assert spark.read.text(os.path.join(region, "targets")).count() > 0
