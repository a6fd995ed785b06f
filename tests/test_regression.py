"""Row counts of the expected-output drafts (FIXTURES part C / SURVEY section 5) at
sf0.001 and sf0.01, reproduced by the library's operators."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001, SF01
from strandline.operators import bases as B
from strandline.plans import fixtures as X
from strandline.plans.queries import QUERIES

EXPECTED = {  # sf0.001, sf0.01
    "kept": (1307, 12947),
    "covered_ranges": (1211, 9742),
    "balance_regions": (24, 24),
    "padded_ranges": (1174, 8374),
    "range_span": (24, 24),
    "interval_intersect": (27, 2377),
    "interval_restrict": (29, 3103),
    "indel_candidates": (321, 2996),
    "pileup": (32007, 80203),
    "recal_table": (512, 512),
    "call_variants": (419, 1942),
}
FLAGGED = (13, 186)


def count(spark, name, d):
    if name == "kept":
        return X.kept(spark, d).count()
    if name == "indel_candidates":
        return B.indel_candidates(X.dense(spark, d)).count()
    return QUERIES[name](spark, d).count()


@pytest.mark.parametrize("name", sorted(EXPECTED))
@pytest.mark.parametrize("k,d", [(0, SF001), (1, SF01)])
def test_part_c_counts(spark, name, k, d):
    assert count(spark, name, d) == EXPECTED[name][k]


@pytest.mark.parametrize("k,d", [(0, SF001), (1, SF01)])
def test_flagged_duplicates(spark, k, d):
    assert QUERIES["mark_duplicates"](spark, d).agg(F.sum("dup")).first()[0] == FLAGGED[k]
