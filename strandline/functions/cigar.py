"""CIGAR column functions.  All are JVM-side expressions (regex + higher-order array
functions), so they stay inside whole-stage codegen and need no shuffle: the running
offsets of the operations of one read are computed inside the row, not with a window."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The SAM specification's operation classes.
REF_CONSUMING = ["M", "D", "N", "=", "X"]
QUERY_CONSUMING = ["M", "I", "S", "=", "X"]
ALIGNED = ["M", "=", "X"]
CLIP = ["S", "H"]

_TOKEN = r"([0-9]+[MIDNSHP=X])"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def named(**fields: Column) -> Column:
    """A struct with explicit field names (``named_struct``); inside lambdas this keeps
    the names where aliases on ``struct`` children can be lost during analysis."""
    return F.named_struct(*[x for k, v in fields.items() for x in (F.lit(k), v)])


def cigar_array(cigar) -> Column:
    """``array<struct<n: bigint, op: string>>`` in CIGAR order."""
    toks = F.regexp_extract_all(_c(cigar), F.lit(_TOKEN), 1)
    return F.transform(toks, lambda t: named(
        n=t.substr(F.lit(1), F.length(t) - 1).cast("long"),
        op=t.substr(F.length(t), F.lit(1))))


def _ref_len(o: Column) -> Column:
    return F.when(o["op"].isin(REF_CONSUMING), o["n"]).otherwise(F.lit(0).cast("long"))


def _query_len(o: Column) -> Column:
    return F.when(o["op"].isin(QUERY_CONSUMING), o["n"]).otherwise(F.lit(0).cast("long"))


def cigar_with_offsets(cigar) -> Column:
    """``array<struct<k, op, n, ref_off, read_off>>``: for operation ``k`` (0-based) the
    reference bases and read bases consumed by operations ``0..k-1``."""
    # one pass that carries both sums and the operations seen so far
    start = named(k=F.lit(0), r=F.lit(0).cast("long"), q=F.lit(0).cast("long"),
                  out=F.array().cast("array<struct<k:int,op:string,n:bigint,ref_off:bigint,read_off:bigint>>"))
    return F.aggregate(cigar_array(cigar), start, lambda a, o: named(
        k=a["k"] + 1, r=a["r"] + _ref_len(o), q=a["q"] + _query_len(o),
        out=F.concat(a["out"], F.array(named(k=a["k"], op=o["op"], n=o["n"], ref_off=a["r"], read_off=a["q"])))),
        lambda a: a["out"])


def aligned_length(cigar) -> Column:
    """Reference bases covered by the alignment (M, D, N, =, X)."""
    lens = F.regexp_extract_all(_c(cigar), F.lit(r"([0-9]+)[MDN=X]"), 1)
    return F.aggregate(lens, F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))


def query_length(cigar) -> Column:
    """Read bases described by the CIGAR (M, I, S, =, X)."""
    lens = F.regexp_extract_all(_c(cigar), F.lit(r"([0-9]+)[MIS=X]"), 1)
    return F.aggregate(lens, F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))


def leading_clip(cigar) -> Column:
    """Length of a leading soft or hard clip, 0 when there is none."""
    v = F.regexp_extract(_c(cigar), r"^([0-9]+)[SH]", 1)
    return F.coalesce(F.nullif(v, F.lit("")), F.lit("0")).cast("long")


def trailing_clip(cigar) -> Column:
    """Length of a trailing soft or hard clip, 0 when there is none."""
    v = F.regexp_extract(_c(cigar), r"([0-9]+)[SH]$", 1)
    return F.coalesce(F.nullif(v, F.lit("")), F.lit("0")).cast("long")


def cigar_string(ops: Column) -> Column:
    """Render ``array<struct<n, op>>`` back to CIGAR text."""
    return F.array_join(F.transform(ops, lambda o: F.concat(o["n"].cast("string"), o["op"])), "")


def aligned_offsets(cigar) -> Column:
    """``array<boolean>`` over read offsets: true where the read base is aligned
    to a reference base (inside an M, = or X operation)."""
    ops = cigar_array(cigar)
    return F.flatten(F.transform(
        F.filter(ops, lambda o: o["op"].isin(QUERY_CONSUMING)),
        lambda o: F.array_repeat(o["op"].isin(ALIGNED), o["n"].cast("int"))))
