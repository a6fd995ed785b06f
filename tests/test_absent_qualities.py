"""Reads without qualities, and N bases."""

from strandline.operators import bases as B
from strandline.operators import duplicates as D
from strandline.operators import reads as R

READ = "read_id long, qname string, flag int, ref_idx int, pos long, end_pos long, cigar string, seq string, qual string"


def _reads(spark, *quals, seq="ACGT"):
    return spark.createDataFrame([(i, f"q{i}", 0, 1, 10, 13, "4M", seq, q) for i, q in enumerate(quals)], READ)


def test_encoding_from_the_first_read_with_qualities(spark):
    x = _reads(spark, "*", "", None, "IIII")
    assert [r.encoding for r in R.guess_encoding(x).collect()] == [R.Q.SANGER]
    assert {r.qual for r in R.fix_qualities(x).collect()} == {"*", "", None, "IIII"}
    none = R.fix_qualities(_reads(spark, "*", None)).collect()
    assert {r.qual for r in none} == {"*", None} and not any(r.quality_error for r in none)


def test_read_without_qualities_loses_as_duplicate(spark):
    got = {r.read_id: r.dup for r in D.mark_duplicates(_reads(spark, "*", "IIII", None)).collect()}
    assert got == {0: 1, 1: 0, 2: 1}


def test_no_base_without_quality(spark):
    out = B.aligned_bases(_reads(spark, "*", "IIII", "")).collect()
    assert {r.read_id for r in out} == {1} and {r.q for r in out} == {40}


def test_n_is_neither_called_nor_a_mismatch(spark):
    cols = "ref_idx int, ref_pos long, ref_base string, base string, depth long, qsum long"
    pile = spark.createDataFrame([(1, 5, "A", "N", 4, 160), (1, 6, "N", "C", 4, 160), (1, 7, "A", "C", 4, 160)], cols)
    assert [(r.ref_pos, r.alt) for r in B.call_variants(pile).collect()] == [(7, "C")]
    bases = spark.createDataFrame([(40, 0, "N", "A"), (40, 0, "C", "N"), (40, 0, "C", "A"), (40, 0, "A", "A")],
                                  "q int, cyc int, base string, ref_base string")
    assert [(r.obs, r.mism) for r in B.recal_table(bases).collect()] == [(2, 1)]
