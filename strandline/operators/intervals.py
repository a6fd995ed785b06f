"""Interval operators: merging reads into covered ranges (A6, A7, A13's merge), range
summaries (A5), coordinate conversion (P9) and interval joins (J3, J4).

Scale design
------------
*Merging* (``merge_intervals``) is a running computation (a row starts a new island
when its start is past the largest end seen so far plus ``gap``).  The textbook form is
a window per chromosome: one task per chromosome, and one task for any hot locus.  Here
it runs in two phases:

1. **exact pre-aggregation by start** - intervals with the same start are always in
   the same island, so ``groupBy(key, start).agg(max(end), count)`` is exact; it is
   combined map-side, so a locus holding a third of all reads costs a few rows per map
   task, and afterwards a bin of width ``B`` holds at most ``B`` rows.  (For inputs
   stored sorted by position, ``presorted=True`` instead merges every input partition
   with a streaming pandas function, which also folds overlapping starts.)
2. **binned global merge** of those rows: the largest end per ``(key, bin)``
   goes into a small bin table; a window over that table gives each bin the running
   maximum of all earlier bins (its *carry*); islands are then windowed only inside
   their bin, break counts per bin give island offsets, and a final ``groupBy`` folds
   islands.  Reads are never windowed over a whole chromosome.

Merging is a set operation (islands are the connected parts of the union of the closed
intervals ``[start, end + gap]``), so merging pieces first and the pieces' islands
afterwards gives the same result as one pass in order.

*Joins* bin intervals by length and start and join on ``(key, level, bin)`` with the
overlap as the residual predicate, instead of an equi-join on the chromosome alone (24
keys and a quadratic scan in each).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.chrom import name_key
from ..session import materialize

DEFAULT_MERGE_BIN = 1 << 16
DEFAULT_JOIN_BIN = 1 << 10

# Fixed value: reads closer than this many bases are merged into one covered range.
INTERVAL_OVERLAP = 51


def _local_merge_fn(nkeys: int, gap: int):
    """Streaming merge over one sorted partition.  State carried between Arrow
    batches is the single open island, so memory is O(batch)."""

    def run(batches):
        carry = None
        for pdf in batches:
            if pdf.empty:
                continue
            if carry is not None:
                pdf = pd.concat([carry, pdf], ignore_index=True)
            keys = [pdf.iloc[:, i].to_numpy() for i in range(nkeys)]
            s = pdf["_s"].to_numpy(dtype=np.int64)
            e = pdf["_e"].to_numpy(dtype=np.int64)
            new_key = np.zeros(len(pdf), dtype=bool)
            new_key[0] = True
            for k in keys:
                new_key[1:] |= k[1:] != k[:-1]
            seg = np.cumsum(new_key)
            run_max = pd.Series(e).groupby(seg).cummax().to_numpy()
            prev = np.empty_like(run_max)
            prev[1:] = run_max[:-1]
            brk = new_key.copy()
            brk[1:] |= s[1:] > prev[1:] + gap
            isl = np.cumsum(brk)
            g = pdf.assign(_i=isl).groupby("_i", sort=True)
            out = g.agg({**{c: "first" for c in pdf.columns[:nkeys]},
                         "_s": "min", "_e": "max", "_n": "sum"}).reset_index(drop=True)
            out = out[list(pdf.columns[:nkeys]) + ["_s", "_e", "_n"]]
            carry = out.iloc[-1:].copy()
            if len(out) > 1:
                yield out.iloc[:-1]
        if carry is not None:
            yield carry

    return run


def local_merge(df: DataFrame, keys: Sequence[str], start: str, end: str, gap: int,
                count: str | None = None) -> DataFrame:
    """Phase 1: merge inside each partition (no shuffle).  Columns: ``keys, _s, _e, _n``."""
    n = F.col(count).cast("long") if count else F.lit(1).cast("long")
    base = df.select(*[F.col(k) for k in keys], F.col(start).cast("long").alias("_s"),
                     F.col(end).cast("long").alias("_e"), n.alias("_n"))
    schema = T.StructType([base.schema[k] for k in keys] + [
        T.StructField("_s", T.LongType()), T.StructField("_e", T.LongType()),
        T.StructField("_n", T.LongType())])
    return (base.sortWithinPartitions(*keys, "_s", "_e")
            .mapInPandas(_local_merge_fn(len(keys), gap), schema))


def merge_intervals(df: DataFrame, keys: Sequence[str] = ("ref_idx",), start: str = "pos",
                    end: str = "end_pos", gap: int = INTERVAL_OVERLAP,
                    count: str | None = None, bin_size: int = DEFAULT_MERGE_BIN,
                    presorted: bool = False) -> DataFrame:
    """Islands of intervals (1-based inclusive ``start``..``end``) per ``keys``: sorted by
    start, a row joins the current island when ``start <= max(end so far) + gap``.

    Phase 1 reduces the rows before any window:

    * default - an exact aggregation by start: intervals sharing a start always share
      an island, so ``groupBy(keys, start).agg(max(end), count)`` loses nothing; it is
      combined map-side (a hot locus leaves each map task as a few rows), and it bounds
      every window partition of phase 2 by ``bin_size`` rows (distinct starts per bin);
    * ``presorted=True`` - for input partitions already sorted by position (stored
      alignments), the streaming pandas merge of each partition, which also folds
      overlapping reads with different starts.

    The phase-1 table is written once (the bin table, the carries and the offsets all
    read it).  Returns ``keys, start_pos, end_pos, n_reads`` (``n_reads`` sums
    ``count`` when given, else counts rows)."""
    keys = list(keys)
    if presorted:
        li = local_merge(df, keys, start, end, gap, count)
    else:
        n = F.sum(F.col(count)) if count else F.count(F.lit(1))
        li = (df.groupBy(*keys, F.col(start).cast("long").alias("_s"))
              .agg(F.max(F.col(end).cast("long")).alias("_e"), n.cast("long").alias("_n")))
    li = materialize(li, "islands_phase1")
    li = li.withColumn("_b", F.floor(F.col("_s") / F.lit(bin_size)).cast("long"))

    # bin table: largest end per bin, and the carry of all earlier bins
    bins = li.groupBy(*keys, "_b").agg(F.max("_e").alias("_bmax"))
    wb = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = bins.select(*keys, "_b", F.max("_bmax").over(wb).alias("_carry"))

    x = li.join(carry, keys + ["_b"], "inner")
    w_prev = (Window.partitionBy(*keys, "_b").orderBy("_s", "_e", "_n")
              .rowsBetween(Window.unboundedPreceding, -1))
    w_cum = (Window.partitionBy(*keys, "_b").orderBy("_s", "_e", "_n")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    prev = F.greatest(F.col("_carry"), F.max("_e").over(w_prev))
    x = x.withColumn("_brk", F.when(prev.isNull() | (F.col("_s") > prev + F.lit(gap)), 1)
                     .otherwise(0))
    x = x.withColumn("_lc", F.sum("_brk").over(w_cum))

    # island offsets: breaks in all earlier bins
    nb = x.groupBy(*keys, "_b").agg(F.sum("_brk").alias("_nb"))
    off = nb.select(*keys, "_b", F.coalesce(F.sum("_nb").over(wb), F.lit(0)).alias("_off"))
    x = x.join(off, keys + ["_b"], "inner")
    return (x.groupBy(*keys, (F.col("_off") + F.col("_lc")).alias("_island"))
            .agg(F.min("_s").alias("start_pos"), F.max("_e").alias("end_pos"),
                 F.sum("_n").alias("n_reads"))
            .drop("_island"))


def covered_ranges(reads: DataFrame, gap: int = INTERVAL_OVERLAP,
                   bin_size: int = DEFAULT_MERGE_BIN) -> DataFrame:
    """Reads (``ref_idx, pos, end_pos``) merged into covered ranges."""
    return merge_intervals(reads, ("ref_idx",), "pos", "end_pos", gap, bin_size=bin_size)


def padded_ranges(ranges: DataFrame, overlap: int, bin_size: int = DEFAULT_MERGE_BIN) -> DataFrame:
    """Ranges merged with left padding: start becomes ``max(start - overlap, 1)``
    and a range joins the current one while ``start - overlap < current end``
    (strict; the end is not padded).  That is the A6 rule with ``gap = overlap - 1``."""
    m = merge_intervals(ranges, ("ref_idx",), "start_pos", "end_pos", overlap - 1,
                        bin_size=bin_size)
    return m.select("ref_idx", F.greatest(F.col("start_pos") - F.lit(overlap), F.lit(1))
                    .cast("long").alias("start_pos"), "end_pos")


def padded_ranges_by_name(ranges: DataFrame, overlap: int, name: str = "ref_name", bin_size: int = DEFAULT_MERGE_BIN) -> DataFrame:
    """A7 over ranges that carry chromosome names (``name, start_pos, end_pos``), as BED text
    does: names that differ in case only are one chromosome.  A merged range has the
    spelling of its first range (of ranges that begin together, the smallest spelling).
    Ranges without a name are left out."""
    keyed = ranges.where(F.col(name).isNotNull()).select(name_key(name).alias("_key"), F.col(name).alias("_name"), "start_pos", "end_pos")
    m = merge_intervals(keyed, ("_key",), "start_pos", "end_pos", overlap - 1, bin_size=bin_size)
    first = keyed.groupBy("_key", F.col("start_pos").cast("long").alias("start_pos")).agg(F.min("_name").alias("_name"))
    return m.join(first, ["_key", "start_pos"]).select(
        F.col("_name").alias(name), F.greatest(F.col("start_pos") - F.lit(overlap), F.lit(1)).cast("long").alias("start_pos"), "end_pos")


def range_span(ranges: DataFrame, by: str = "ref_idx", name: str | None = None) -> DataFrame:
    """A5: per group, the first start, the end of the *last* range (the range with the
    largest start), the number of ranges, and the label ``<n>regions_<name>-<start>``."""
    label_name = F.col(name) if name else F.col(by).cast("string")
    g = [by] + ([name] if name and name != by else [])
    agg = ranges.groupBy(*g).agg(
        F.min("start_pos").alias("first_start"),
        F.max_by("end_pos", F.struct("start_pos", "end_pos")).cast("long").alias("last_end"),
        F.count(F.lit(1)).alias("n_ranges"))
    return agg.withColumn("label", F.concat(
        F.col("n_ranges").cast("string"), F.lit("regions_"), label_name, F.lit("-"),
        F.col("first_start").cast("string")))


def to_half_open(start, end):
    """1-based inclusive -> 0-based half-open (start - 1, end)."""
    return (F.col(start) - 1), F.col(end)


def to_inclusive(start, end):
    """0-based half-open -> 1-based inclusive (start + 1, end)."""
    return (F.col(start) + 1), F.col(end)


# ---- binned joins ------------------------------------------------------------------

#: Width of the finest bins; each level's bins are 2**LEVEL_SHIFT times as wide.
LEVEL_SHIFT, MAX_LEVEL = 3, 16
#: Positions lie below this power of two (a genome laid end to end has 2**32).
POSITION_BITS = 34


def _level(length: Column, bin_size: int) -> Column:
    """The finest level whose bins are at least as wide as an interval."""
    bits = F.ceil(F.log2(F.greatest(length, F.lit(1)) / F.lit(bin_size)) / LEVEL_SHIFT)
    return F.greatest(F.lit(0), F.least(bits, F.lit(MAX_LEVEL))).cast("int")


def _width(level: Column, bin_size: int) -> Column:
    return F.call_function("shiftleft", F.lit(bin_size).cast("long"), level * LEVEL_SHIFT)


def _bin(at: Column, level: Column, bin_size: int) -> Column:
    return F.floor(at / _width(level, bin_size)).cast("long")


def _levels_of(df: DataFrame) -> list[int]:
    """The levels in use, ``MAX_LEVEL + 1`` at most."""
    return sorted(r["_level"] for r in df.select("_level").distinct().collect())


def _probes(df: DataFrame, start: str, end: str, levels: list[int], bin_size: int, above: bool) -> DataFrame:
    """``df`` with a row for every bin (``_at, _bin``) in which an interval that overlaps
    may begin, at each level in ``levels`` no finer than (``above``: coarser than) its own:
    three bins a level at most, as neither interval is longer than a bin there."""
    at = F.filter(F.array(*(F.lit(k) for k in levels)), lambda k: (k > F.col("_level")) if above else (k >= F.col("_level")))
    x = df.withColumn("_at", F.explode(at))
    return x.withColumn("_bin", F.explode(F.sequence(
        _bin(F.col(start) - _width(F.col("_at"), bin_size) + 1, F.col("_at"), bin_size), _bin(F.col(end) - 1, F.col("_at"), bin_size))))


MIN_JOIN_BIN, MAX_JOIN_BIN = 1 << 6, 1 << 20


def choose_bin_size(*sides: tuple[DataFrame, str, str]) -> int:
    """A join bin near the typical interval length: the next power
    of two above the larger of the sides' approximate median lengths, within
    ``[64, 2^20]``.  One small aggregation per side (two columns read); the result
    only changes how far intervals fan out, never which pairs are found."""
    med = 0
    for df, s, e in sides:
        m = df.agg(F.percentile_approx(F.col(e) - F.col(s), 0.5, 1000)).first()[0]
        med = max(med, int(m or 0))
    b = MIN_JOIN_BIN
    while b < med and b < MAX_JOIN_BIN:
        b <<= 1
    return b


def interval_intersect(left: DataFrame, right: DataFrame, key: str = "ref_idx",
                       left_iv=("bstart", "bend"), right_iv=("start0", "end0"),
                       bin_size: int | None = DEFAULT_JOIN_BIN) -> DataFrame:
    """One row per overlapping (left, right) pair, clipped to the overlap
    (``istart, iend``, 0-based half-open), with the left columns kept.

    Bins come in levels, each eight times as wide as the one below.  An interval lies in
    one bin: that of its start, at the finest level whose bins it fits into.  The shorter
    interval of a pair looks the longer one up, at the longer one's level, where it needs
    three bins at most: left intervals probe right ones of their own level and above, right
    intervals probe left ones of the levels above.  So each pair is found once, and an
    interval costs a bounded number of rows however long it is - a whole contig as a few
    hundred bases.  Empty intervals never overlap anything and are dropped.
    ``bin_size`` is the width of the finest bins; ``None`` takes it from the data
    (:func:`choose_bin_size`).  The right intervals, three columns of them, are written
    once; the left ones are read once more for the levels in use."""
    ls, le = left_iv
    rs, re_ = right_iv
    if bin_size is None:
        bin_size = choose_bin_size((left, ls, le), (right, rs, re_))
    lx = left.filter(F.col(le) > F.col(ls)).withColumn("_level", _level(F.col(le) - F.col(ls), bin_size))
    rx = (right.filter(F.col(re_) > F.col(rs))
          .select(F.col(key).alias("_rk"), F.col(rs).alias("_rs"), F.col(re_).alias("_re"),
                  _level(F.col(re_) - F.col(rs), bin_size).alias("_level")))
    rx = materialize(rx, "intersect_right")
    l_levels, r_levels = _levels_of(lx), _levels_of(rx)
    found = [_met(_probes(lx, ls, le, r_levels, bin_size, False), rx.withColumn("_b", _bin(F.col("_rs"), F.col("_level"), bin_size))
                  .withColumnRenamed("_level", "_l"), key, ls, le)] if r_levels else []
    if l_levels and r_levels and max(l_levels) > min(r_levels):
        own = lx.withColumn("_b", _bin(F.col(ls), F.col("_level"), bin_size)).withColumnRenamed("_level", "_l")
        found.append(_met(_probes(rx, "_rs", "_re", l_levels, bin_size, True), own, key, ls, le))
    first = F.greatest(F.col(ls), F.col("_rs"))
    out = [j.select(*left.columns, first.alias("istart"), F.least(F.col(le), F.col("_re")).alias("iend")) for j in found]
    if not out:
        return left.limit(0).withColumn("istart", F.col(ls)).withColumn("iend", F.col(le))
    return out[0] if len(out) == 1 else out[0].unionByName(out[1])


def _met(probe: DataFrame, own: DataFrame, key: str, ls: str, le: str) -> DataFrame:
    return probe.join(own, (F.col(key) == F.col("_rk")) & (F.col("_at") == F.col("_l")) & (F.col("_bin") == F.col("_b"))
                      & (F.col(ls) < F.col("_re")) & (F.col("_rs") < F.col(le)), "inner")


def interval_restrict(reads: DataFrame, targets: DataFrame, key: str = "ref_idx",
                      read_iv=("start0", "end0"), target_iv=("bstart", "bend"),
                      bin_size: int = DEFAULT_JOIN_BIN) -> DataFrame:
    """J4 (``-L targets``): reads overlapping any target, each read once.

    The levels of :func:`interval_intersect`, as a semi-join on the bin of the read's
    start: at the coarser level of the two, a target is told to the bins in which an
    overlapping read may begin: three a level at most, up to the level of a whole genome.
    A read is looked up once per level that targets have at or above its own, and at its
    own if some are finer.  If all targets are of one level, that is one row per read and
    the semi-join is the whole plan; else reads are numbered, and of those found at several
    levels one row stays.  A target over a whole contig is a few rows, as any
    other.  An empty interval covers no base and overlaps nothing."""
    rs, re_ = read_iv
    ts, te = target_iv
    rx = reads.filter(F.col(re_) > F.col(rs)).withColumn("_level", _level(F.col(re_) - F.col(rs), bin_size))
    tx = targets.filter(F.col(te) > F.col(ts)).select(F.col(key).alias("_tk"), F.col(ts).alias("_ts"), F.col(te).alias("_te"),
                                                      _level(F.col(te) - F.col(ts), bin_size).alias("_level"))
    tx = materialize(tx, "restrict_targets")
    used = _levels_of(tx)
    if not used:
        return reads.limit(0)
    top = max(0, -(-(POSITION_BITS - bin_size.bit_length() + 1) // LEVEL_SHIFT))
    told = _probes(tx, "_ts", "_te", list(range(top + 1)), bin_size, False).select("_tk", "_ts", "_te", "_at", "_bin")
    own = F.when(F.col("_level") > min(used), F.array("_level")).otherwise(F.array().cast("array<int>"))
    at = F.array_union(F.filter(F.array(*(F.lit(k) for k in used)), lambda k: k >= F.col("_level")), own)
    numbered = (rx.withColumn("_rid", F.monotonically_increasing_id()) if len(used) > 1 else rx).withColumn("_l", F.explode(at))
    looked = numbered.withColumn("_b", _bin(F.col(rs), F.col("_l"), bin_size))
    hit = ((F.col(key) == F.col("_tk")) & (F.col("_l") == F.col("_at")) & (F.col("_b") == F.col("_bin"))
           & (F.col(rs) < F.col("_te")) & (F.col("_ts") < F.col(re_)))
    found = looked.join(told, hit, "left_semi")
    return (found.dropDuplicates(["_rid"]) if len(used) > 1 else found).select(*reads.columns)
