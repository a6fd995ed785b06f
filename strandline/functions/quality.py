"""Base-quality column functions (Phred scores stored as ASCII text)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Phred+33 storage offset, the Illumina-1.3 to Phred shift, and the
# highest maximum quality still read as Sanger encoding.
PHRED_OFFSET = 33
ILLUMINA_SHIFT = 31
SANGER_MAX = 60
SANGER = "SANGER"
ILLUMINA = "ILLUMINA"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def phred(qual, offset: int = PHRED_OFFSET) -> Column:
    """``array<int>`` of scores; null when qualities are absent (``''`` or ``'*'``)."""
    q = _c(qual)
    arr = F.transform(F.split(q, ""), lambda c: F.ascii(c) - F.lit(offset))
    return F.when(q.isNull() | (q == "") | (q == "*"), F.lit(None)).otherwise(arr)


def phred_text(scores, offset: int = PHRED_OFFSET) -> Column:
    """Inverse of :func:`phred`: ``array<int>`` back to ASCII text."""
    return F.array_join(F.transform(_c(scores), lambda x: F.chr(x + F.lit(offset))), "")


def max_quality(qual) -> Column:
    return F.array_max(phred(qual))


def shift_quality_text(qual, delta: int) -> Column:
    """Add ``delta`` to every score of a quality string (used to build
    Illumina-1.3-encoded input)."""
    return F.array_join(F.transform(F.split(_c(qual), ""),
                                    lambda c: F.chr(F.ascii(c) + F.lit(delta))), "")


def has_qualities(qual="qual") -> Column:
    """Whether a read carries base qualities: neither null, empty nor the absent mark."""
    c = F.col(qual) if isinstance(qual, str) else qual
    return F.coalesce(~c.isin("", "*"), F.lit(False))
