"""A third of all reads on one locus (a hot key): the distributed operators still give
the plain results, and none of them puts the hot group into one window partition."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF01
from strandline.operators import bases as B
from strandline.operators import duplicates as D
from strandline.operators import intervals as I
from strandline.plans import fixtures as X


def hot(spark):
    k = X.kept(spark, SF01)
    # every third read moved onto chr1:5000 (same start, same strand bits kept)
    moved = F.col("read_id") % 3 == 0
    return (k.withColumn("ref_idx", F.when(moved, F.lit(1)).otherwise(F.col("ref_idx")))
            .withColumn("pos", F.when(moved, F.lit(5000).cast("long")).otherwise(F.col("pos")))
            .withColumn("end_pos", F.col("pos") + F.col("ref_len") - 1)
            .repartition(6))


def rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_hot_locus_merge(spark):
    k = hot(spark)
    w = Window.partitionBy("ref_idx").orderBy("pos", "read_id")
    prev = F.max("end_pos").over(w.rowsBetween(Window.unboundedPreceding, -1))
    x = k.withColumn("brk", F.when(F.col("pos") <= prev + 51, 0).otherwise(1)) \
         .withColumn("g", F.sum("brk").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    want = rows(x.groupBy("ref_idx", "g").agg(F.min("pos"), F.max("end_pos"), F.count(F.lit(1))),
                ["ref_idx", "min(pos)", "max(end_pos)", "count(1)"])
    got = rows(I.covered_ranges(k), ["ref_idx", "start_pos", "end_pos", "n_reads"])
    assert got == want
    assert max(r[3] for r in got) >= k.count() // 3


def test_hot_locus_duplicates(spark):
    k = hot(spark)
    s = k.withColumn("score", D.duplicate_score()).withColumn("p5", D.unclipped_five_prime())
    w = Window.partitionBy("ref_idx", F.col("flag").bitwiseAND(16), "p5") \
        .orderBy(F.col("score").desc(), "qname")
    want = rows(s.select("read_id", (F.row_number().over(w) > 1).cast("int")), ["*"])
    got = rows(D.mark_duplicates(k), ["read_id", "dup"])
    assert got == want


def test_hot_locus_pileup_aggregates_map_side(spark):
    k = hot(spark).withColumn("seq", F.lit("A" * 32))
    bases = X.bases_with_ref(B.aligned_bases(k))
    p = B.pileup(bases)
    plan = p._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan          # combined before the shuffle
    top = p.orderBy(F.col("depth").desc()).first()
    assert top.depth >= k.count() // 3 - 2
    assert p.agg(F.sum("depth")).first()[0] == bases.count()


def test_hot_locus_restrict(spark):
    k = hot(spark).select("read_id", "ref_idx", (F.col("pos") - 1).alias("start0"),
                          F.col("end_pos").alias("end0"))
    bed = X.bed(spark, SF01).unionByName(
        spark.range(1).select(F.lit(0).cast("long").alias("bed_id"), F.lit(1).alias("ref_idx"),
                              F.lit(4990).cast("long").alias("bstart"),
                              F.lit(5010).cast("long").alias("bend")))
    plain = k.alias("k").join(bed.alias("b"), (F.col("k.ref_idx") == F.col("b.ref_idx"))
                              & (F.col("b.bstart") < F.col("k.end0"))
                              & (F.col("k.start0") < F.col("b.bend")), "left_semi")
    got = I.interval_restrict(k, bed)
    assert rows(got, ["read_id"]) == rows(plain, ["read_id"])
    assert got.count() >= k.count() // 3


def test_regions_below_the_contig_are_balanced(spark):
    """A third of all reads on one locus of one contig: no region is far from the mean."""
    from strandline.operators import regions as G
    pos = (F.when(F.col("id") % 3 == 0, 70_000 + F.col("id") * 7919 % 300).otherwise(1 + F.col("id") * 104_729 % 240_000)).cast("long")
    reads = spark.range(60_000).select(F.col("id").alias("read_id"), (F.when(F.col("id") % 3 == 0, 5).otherwise(1 + F.col("id") % 24)).cast("int").alias("ref_idx"), pos.alias("pos"))
    loci = G.balance_loci(reads, 20)
    out = G.assign_loci(reads, loci)
    got = {r.region: (r.n, r.a, r.b) for r in out.groupBy("region").agg(F.count("*").alias("n"), F.min(F.struct("ref_idx", "pos")).alias("a"), F.max(F.struct("ref_idx", "pos")).alias("b")).collect()}
    assert set(got) == set(range(20)) and sum(n for n, _, _ in got.values()) == 60_000
    assert max(n for n, _, _ in got.values()) <= 1.2 * 3000
    assert all(got[k][2] < got[k + 1][1] for k in range(19))       # contiguous, in genome order
    none = reads.limit(0)
    assert G.assign_loci(none, G.balance_loci(none, 3)).count() == 0
