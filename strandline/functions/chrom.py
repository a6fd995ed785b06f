"""Chromosome-name functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sex chromosomes are numbered after the 22 autosomes.
CHR_X_NUMBER = 23
CHR_Y_NUMBER = 24


def chrom_number(name) -> Column:
    """``chrX*`` -> 23, ``chrY*`` -> 24, else the integer between ``chr`` and any later
    ``chr``; null (not an error) when that is not an integer, e.g. ``chrM``,
    ``chr1_random``, or a name without the ``chr`` prefix."""
    n = F.col(name) if isinstance(name, str) else name
    after = F.substring_index(n.substr(F.lit(4), F.length(n)), "chr", 1)
    return (F.when(n.startswith("chrX"), F.lit(CHR_X_NUMBER))
            .when(n.startswith("chrY"), F.lit(CHR_Y_NUMBER))
            .when(n.startswith("chr"), after.try_cast("int")))


def name_key(name) -> Column:
    """What two chromosome names must share to be the same one: spelling but for case."""
    return F.lower(F.col(name) if isinstance(name, str) else name)
