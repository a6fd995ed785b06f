"""Sequencing-shaped inputs derived from the driver's tables (FIXTURES.md part B),
written with the DataFrame API.  Every fixture reads the given tables, so its size
grows with them; nothing here is synthesised from fixed small input.

``aln`` one read per order; ``kept`` after the P2 filter; ``seq_dict`` one contig per
``o_custkey % 26``; ``bed`` one target per part; ``dense`` reads re-placed on 3,000
positions with sequences drawn from a synthetic genome, planted errors and SNPs.
The text renderings (FASTQ, SAM, dictionary, VCF lines) feed the parsers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cigar import named
from ..functions.quality import shift_quality_text
from ..operators import reads as R
from ..session import materialize

# Fixed values of the fixture definitions (FIXTURES.md part B).
NUM_CONTIGS = 26
DENSE_SPAN = 3000
CLEAN_REF_LENGTH = 2990
GENOME_ALPHABET = "ACGT"
SEQ_DIGITS = "0123456789abcdef"
SEQ_LETTERS = "ACGTACGTACGTACGT"
QUAL_LETTERS = "#+05:;<=>?@ACEGI"


_SCHEMAS: dict[str, object] = {}
_BUILT: dict[tuple, DataFrame] = {}


def _memo(spark: SparkSession, key: tuple, build) -> DataFrame:
    """One DataFrame per (session, fixture, folder): DataFrames are immutable, and
    building the wide ``dense`` projection and analysing it costs more than running
    it at small scale."""
    k = (id(spark), *key)
    df = _BUILT.get(k)
    if df is None or df.sparkSession is not spark:
        df = _BUILT[k] = build()
    return df


def _memoized(fn):
    def wrapper(spark: SparkSession, d: str, **kw) -> DataFrame:
        return _memo(spark, (fn.__name__, d, *sorted(kw.items())), lambda: fn(spark, d, **kw))
    wrapper.__name__, wrapper.__doc__ = fn.__name__, fn.__doc__
    return wrapper


def stored(spark: SparkSession, key: tuple, build, *order: str, finish=None) -> DataFrame:
    """A derived input that several queries read: built once per session and folder, range
    partitioned and sorted by ``order``, written, and read back from its files - as
    alignments are stored in a pipeline (``sources.alignments.write_alignments``).  The
    driver's tables have one row group, which a scan can't split; the stored form has a
    file per range at any size.  ``finish`` adds wide columns after the rows have been
    ordered: they are worked out once, in all tasks, and are not shuffled."""
    def write() -> DataFrame:
        df = build()
        if order:
            n = int(spark.conf.get("spark.sql.shuffle.partitions"))
            df = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
        if finish:
            df = finish(df)
        return materialize(df, f"fixture-{key[0]}")
    return _memo(spark, ("stored", *key), write)


def _stored_by(*order: str, finish=None):
    def wrap(fn):
        def wrapper(spark: SparkSession, d: str, **kw) -> DataFrame:
            late = finish and (lambda df: finish(df, **kw))
            return stored(spark, (fn.__name__, d, *sorted(kw.items())), lambda: fn(spark, d, **kw), *order, finish=late)
        wrapper.__name__, wrapper.__doc__, wrapper.__wrapped__ = fn.__name__, fn.__doc__, fn
        return wrapper
    return wrap


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    """A driver table.  Its schema is inferred once per path and then given to the
    reader, so repeated reads of the same table run no footer-inference job."""
    path = f"{d}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def read_table(spark: SparkSession, d: str, name: str, *cols: str) -> DataFrame:
    """Scan ``name``, pruned to ``cols``."""
    return table(spark, d, name).select(*cols)


def _md5_text(salt: str, key: Column, letters: str) -> Column:
    return F.translate(F.md5(F.concat(F.lit(salt), key.cast("string"))), SEQ_DIGITS, letters)


def _aln_columns(placed: DataFrame, seq_salt: str = "s", qual_salt: str = "q") -> DataFrame:
    """What follows from a read's key, once the reads are in order."""
    k = F.col("read_id")
    m8 = k % 8
    return placed.select(
        "read_id", F.concat(F.lit("r"), k.cast("string")).alias("qname"), "flag", "ref_idx", "pos",
        (k % 61).cast("int").alias("mapq"),
        F.when(m8 == 5, "10M2I20M").when(m8 == 6, "10M2D22M").when(m8 == 7, "4S28M")
        .otherwise("32M").alias("cigar"),
        F.when(m8 == 5, 30).when(m8 == 6, 34).when(m8 == 7, 28).otherwise(32)
        .cast("long").alias("ref_len"),
        _md5_text(seq_salt, k, SEQ_LETTERS).alias("seq"),
        _md5_text(qual_salt, k, QUAL_LETTERS).alias("qual"))


@_stored_by("ref_idx", "pos", finish=_aln_columns)
def aln(spark: SparkSession, d: str, seq_salt: str = "s", qual_salt: str = "q") -> DataFrame:
    """All reads: ``read_id, qname, flag, ref_idx, pos, mapq, cigar, ref_len, seq, qual``."""
    o = read_table(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderstatus")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return o.select(
        k.cast("long").alias("read_id"),
        F.when((F.col("o_orderstatus") == "P") & (k % 5 == 0), 4)
        .when(k % 2 == 0, 16).otherwise(0).cast("int").alias("flag"),
        (c % NUM_CONTIGS).cast("int").alias("ref_idx"),
        (1 + (c * 7919 + (k % 97) * 613) % (200000 + (c % NUM_CONTIGS) * 1000 - 40))
        .cast("long").alias("pos"))


@_stored_by("read_id")
def read_keys(spark: SparkSession, d: str) -> DataFrame:
    """``read_id`` of all reads."""
    return read_table(spark, d, "orders", "o_orderkey").select(F.col("o_orderkey").cast("long").alias("read_id"))


@_memoized
def kept(spark: SparkSession, d: str) -> DataFrame:
    """P2 applied to ``aln``, with the inclusive end."""
    return R.primary_mapped(aln(spark, d)).withColumn(
        "end_pos", F.col("pos") + F.col("ref_len") - 1)


@_stored_by()
def seq_dict(spark: SparkSession, d: str) -> DataFrame:
    """``ref_idx, ref_name, ref_length``: one row per contig seen in ``orders``."""
    i = (F.col("o_custkey") % NUM_CONTIGS).cast("int")
    ids = table(spark, d, "orders").select(i.alias("ref_idx")).distinct()
    r = F.col("ref_idx")
    name = (F.when(r == 0, "chrM").when(r == 23, "chrX").when(r == 24, "chrY")
            .when(r == 25, "chrUn").otherwise(F.concat(F.lit("chr"), r.cast("string"))))
    return ids.select("ref_idx", name.alias("ref_name"),
                      (200000 + r * 1000).cast("int").alias("ref_length"))


@_memoized
def bed(spark: SparkSession, d: str) -> DataFrame:
    """Target intervals, 0-based half-open: ``bed_id, ref_idx, bstart, bend``."""
    p = table(spark, d, "part").select("p_partkey", "p_size")
    k = F.col("p_partkey")
    return p.select(k.cast("long").alias("bed_id"), (1 + k % 24).cast("int").alias("ref_idx"),
                    ((k * 4793) % 190000).cast("long").alias("bstart"),
                    ((k * 4793) % 190000 + 50 + F.col("p_size") * 20).cast("long").alias("bend"))


MATE_ID_OFFSET = 1_000_000_000


@_stored_by("ref_idx", "pos")
def paired(spark: SparkSession, d: str) -> DataFrame:
    """Paired-end alignments: every kept read is end 1 of a template (same name);
    end 2 is ``32M`` on the other strand, ``150 + (read_id % 7) * 10`` bases further,
    with reversed sequence and qualities.  Templates with ``read_id % 11 = 0`` have
    their mate unmapped; reads with ``read_id % 13 = 0`` also have a secondary
    alignment 5,000 bases on."""
    k = kept(spark, d)
    rid = F.col("read_id")
    s1 = F.col("flag").bitwiseAND(16)
    s2 = F.lit(16) - s1
    lost = rid % 11 == 0
    mate_rev_1 = F.when(s2 == 16, 32).otherwise(0)
    mate_rev_2 = F.when(s1 == 16, 32).otherwise(0)
    pos, cig, rl, seq, qual, end = (F.col(c) for c in
                                    ("pos", "cigar", "ref_len", "seq", "qual", "end_pos"))
    pos2 = pos + 150 + (rid % 7) * 10
    # the records of one kept read: end 1, end 2 and (some reads) a secondary alignment
    records = F.array(
        named(read_id=rid, flag=(F.lit(1 + 64) + s1 + mate_rev_1
                                 + F.when(lost, 8).otherwise(0)).cast("int"),
              pos=pos, cigar=cig, ref_len=rl, seq=seq, qual=qual, end_pos=end),
        named(read_id=rid + MATE_ID_OFFSET,
              flag=(F.lit(1 + 128) + s2 + mate_rev_2 + F.when(lost, 4).otherwise(0)).cast("int"),
              pos=pos2, cigar=F.lit("32M"), ref_len=F.lit(32).cast("long"), seq=F.reverse(seq),
              qual=F.reverse(qual), end_pos=pos2 + 31),
        named(read_id=rid + 2 * MATE_ID_OFFSET,
              flag=(F.lit(1 + 64 + 256) + s1 + mate_rev_1).cast("int"),
              pos=pos + 5000, cigar=cig, ref_len=rl, seq=seq, qual=qual, end_pos=end + 5000))
    records = F.filter(records, lambda r: (r["flag"].bitwiseAND(256) == 0) | (rid % 13 == 0))
    x = k.select("qname", "ref_idx", "mapq", F.explode(records).alias("_r"))
    return x.select("_r.read_id", "qname", "_r.flag", "ref_idx", "_r.pos", "mapq", "_r.cigar",
                    "_r.ref_len", "_r.seq", "_r.qual", "_r.end_pos")


def genome_base(p: Column, ref_idx: Column) -> Column:
    """The synthetic genome's base at position ``p`` of contig ``ref_idx``."""
    return F.substr(F.lit(GENOME_ALPHABET),
                    (1 + ((p * p + 3 * p + ref_idx) % 7 + p) % 4).cast("int"), F.lit(1))


def _dense_seq(placed: DataFrame) -> DataFrame:
    """The bases of the placed reads."""
    # the CIGAR class once, then the 32 aligned positions, then the bases: each step a
    # separate projection, so no position expression is re-evaluated per use
    cls = (F.when(F.col("cigar") == "10M2I20M", 1).when(F.col("cigar") == "10M2D22M", 2)
           .when(F.col("cigar") == "4S28M", 3).otherwise(0))
    d1 = placed.withColumn("_c", cls)
    d2 = d1.select("*", *[_dense_pos(i).alias(f"_p{i}") for i in range(32)])
    seq = F.concat(*[_dense_base(i, F.col(f"_p{i}")) for i in range(32)])
    return d2.select(*placed.columns, seq.alias("seq"))


@_stored_by("ref_idx", "pos", finish=_dense_seq)
def dense(spark: SparkSession, d: str) -> DataFrame:
    """Kept reads moved onto 3,000 positions; ``seq`` follows the synthetic genome
    along the CIGAR, with planted errors and SNPs (``ref_pos % 100 = 17``, carried by
    even read ids)."""
    a = R.primary_mapped(aln(spark, d))
    p = (1 + (F.col("read_id") * 37) % DENSE_SPAN).cast("long")
    return a.select("read_id", "qname", "flag", "ref_idx", p.alias("pos"), "mapq", "cigar",
                    "ref_len", "qual", (p + F.col("ref_len") - 1).alias("end_pos"))


def _dense_pos(i: int) -> Column:
    """``P(i)``: the reference position aligned to read offset ``i``."""
    pos, c = F.col("pos"), F.col("_c")
    return (F.when(c == 1, pos + (i if i < 12 else i - 2))
            .when(c == 2, pos + (i if i < 10 else i + 2))
            .when(c == 3, pos + (i - 4))
            .otherwise(pos + i))


def _dense_base(i: int, p: Column) -> Column:
    """Read base ``i`` of a ``dense`` read: the genome base at ``p = P(i)``, plus a
    planted error or SNP."""
    rid, ref_idx = F.col("read_id"), F.col("ref_idx")
    bump = (F.when((rid * 31 + i * 17) % 53 == 0, 2)
            .when((p % 100 == 17) & (rid % 2 == 0), 1).otherwise(0))
    idx = (1 + (((p * p + 3 * p + ref_idx) % 7 + p) % 4 + bump) % 4).cast("int")
    return F.substr(F.lit(GENOME_ALPHABET), idx, F.lit(1))


def bases_with_ref(bases: DataFrame) -> DataFrame:
    """Attach the synthetic genome's base (a real pipeline joins the reference)."""
    return bases.withColumn("ref_base", genome_base(F.col("ref_pos"), F.col("ref_idx")))


def known_sites(bases: DataFrame) -> DataFrame:
    """Known variant sites: covered positions with ``ref_pos % 200 = 17``."""
    return bases.filter(F.col("ref_pos") % 200 == 17).select("ref_idx", "ref_pos").distinct()


def known_sites_from_reads(reads: DataFrame) -> DataFrame:
    """The same sites as :func:`known_sites`, from the reads' aligned operations
    without fanning out to bases: the sites of an operation covering
    ``[r0, r0 + n)`` are ``first, first + 200, ...`` with
    ``first = r0 + (17 - r0) mod 200``."""
    from ..functions import cigar as C
    ops = F.filter(C.cigar_with_offsets("cigar"), lambda o: o["op"].isin(C.ALIGNED))
    x = reads.select("ref_idx", "pos", F.explode(ops).alias("_o"))
    r0 = F.col("pos") + F.col("_o.ref_off")
    first = r0 + F.pmod(F.lit(17) - r0, F.lit(200))
    last = r0 + F.col("_o.n") - 1
    sites = x.select("ref_idx", F.explode(F.sequence(first, F.greatest(first, last), F.lit(200)
                                                     .cast("long"))).alias("ref_pos"),
                     last.alias("_last"))
    return sites.filter(F.col("ref_pos") <= F.col("_last")).select("ref_idx", "ref_pos").distinct()


# ---- text renderings -------------------------------------------------------------

def fastq_lines(reads: DataFrame, mate: int) -> DataFrame:
    """FASTQ text of ``reads``: record ``r`` is lines ``4r .. 4r+3``: ``idx, line``."""
    lines = F.array(F.concat(F.lit("@r"), F.col("read_id").cast("string"), F.lit(f"/{mate}")),
                    F.col("seq"), F.lit("+"), F.col("qual"))
    return reads.select("read_id", F.posexplode(lines).alias("k", "line")).select(
        (F.col("read_id") * 4 + F.col("k")).cast("long").alias("idx"), "line")


def mate_reads(spark: SparkSession, d: str, mate: int) -> DataFrame:
    """``read_id, seq, qual`` of one mate, worked out from the stored keys wherever they are
    read: the texts are neither shuffled nor stored before they are lines."""
    seq_salt, qual_salt = ("s", "q") if mate == 1 else ("t", "u")
    k = F.col("read_id")
    return read_keys(spark, d).select("read_id", _md5_text(seq_salt, k, SEQ_LETTERS).alias("seq"),
                                      _md5_text(qual_salt, k, QUAL_LETTERS).alias("qual"))


def sam_lines(spark: SparkSession, d: str) -> DataFrame:
    """SAM text: header (``@HD``, one ``@SQ`` per contig), then one line per read;
    every read with ``read_id % 50 = 7`` is cut to 6 fields and every one with
    ``read_id % 50 = 13`` has a non-numeric FLAG (malformed lines)."""
    sd = seq_dict(spark, d)
    a = aln(spark, d).join(F.broadcast(sd.select("ref_idx", "ref_name")), "ref_idx", "left")
    full = F.concat_ws("\t", "qname", F.col("flag").cast("string"), "ref_name",
                       F.col("pos").cast("string"), F.col("mapq").cast("string"), "cigar",
                       F.lit("*"), F.lit("0"), F.lit("0"), "seq", "qual")
    short = F.concat_ws("\t", "qname", F.col("flag").cast("string"), "ref_name",
                        F.col("pos").cast("string"), F.col("mapq").cast("string"), "cigar")
    badflag = F.concat_ws("\t", "qname", F.lit("X"), "ref_name",
                          F.col("pos").cast("string"), F.col("mapq").cast("string"), "cigar",
                          F.lit("*"), F.lit("0"), F.lit("0"), "seq", "qual")
    m = F.col("read_id") % 50
    body = a.select(F.when(m == 7, short).when(m == 13, badflag).otherwise(full).alias("value"))
    hd = sd.agg(F.first(F.lit("@HD\tVN:1.6\tSO:unsorted")).alias("value"))
    sq = sd.select(F.concat(F.lit("@SQ\tSN:"), "ref_name", F.lit("\tLN:"),
                            F.col("ref_length").cast("string")).alias("value"))
    return hd.unionByName(sq).unionByName(body)


def dict_lines(spark: SparkSession, d: str) -> DataFrame:
    """Sequence-dictionary text: a header line, then ``@SQ SN:<name> LN:<length>`` in
    contig order (line ``ref_idx + 1``); ``chrUn`` has a non-numeric length."""
    sd = seq_dict(spark, d)
    ln = F.when(F.col("ref_name") == "chrUn", F.lit("NA")).otherwise(
        F.col("ref_length").cast("string"))
    hd = sd.agg(F.first(F.lit(0).cast("long")).alias("idx"),
                F.first(F.lit("@HD\tVN:1.6")).alias("value"))
    body = sd.select((F.col("ref_idx") + 1).cast("long").alias("idx"),
                     F.concat(F.lit("@SQ\tSN:"), "ref_name", F.lit("\tLN:"), ln).alias("value"))
    return hd.unionByName(body)


def bed_lines(spark: SparkSession, d: str) -> DataFrame:
    """BED text of the targets: a ``track`` line, then ``chrom  start  end  name``."""
    names = F.broadcast(seq_dict(spark, d).select("ref_idx", "ref_name"))  # <= 26 rows
    b = bed(spark, d).join(names, "ref_idx", "inner")
    body = b.select(F.concat_ws("\t", "ref_name", F.col("bstart").cast("string"),
                                F.col("bend").cast("string"),
                                F.concat(F.lit("t"), F.col("bed_id").cast("string")))
                    .alias("value"))
    hdr = b.agg(F.first(F.lit("track name=targets")).alias("value"))
    return hdr.unionByName(body)


def known_sites_lines(spark: SparkSession, d: str, sites: DataFrame) -> DataFrame:
    """VCF text of known sites: a header line, then ``chrom  pos  .  N  .``."""
    names = F.broadcast(seq_dict(spark, d).select("ref_idx", "ref_name"))  # <= 26 rows
    s = sites.join(names, "ref_idx", "inner")
    body = s.select(F.concat_ws("\t", "ref_name", F.col("ref_pos").cast("string"), F.lit("."),
                                F.lit("N"), F.lit(".")).alias("value"))
    hdr = s.agg(F.first(F.lit("##fileformat=VCFv4.2")).alias("value"))
    return hdr.unionByName(body)


def shifted_qualities(reads: DataFrame) -> DataFrame:
    """Illumina-1.3 input: every read's qualities +31, except reads with
    ``read_id % 7 = 3`` (left in Phred+33, so fixing them fails)."""
    return reads.withColumn("qual", F.when(F.col("read_id") % 7 == 3, F.col("qual"))
                            .otherwise(shift_quality_text("qual", 31)))
