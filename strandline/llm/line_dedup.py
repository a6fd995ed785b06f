"""Line dedup by log templates, in DataFrame and SQL functions only.

A line's fields that hold digits become ``<*>``, if enough constant words are left: at
least ``WORDS`` fields with a letter, and a third of all fields.  Other lines (number tables,
data rows) keep their digits and recur only where their whole text is equal; so do lines of
fewer than ``MIN_TOKENS`` tokens (a line in a script without spaces is one token), if they
have ``MIN_CHARS`` characters, and shorter ones stay.  The lines go down a tree of fixed
depth: first by token count, then by their leading tokens.

A leaf's templates are its lines with further fields variable.  The places after the leading
tokens are cut into ``GROUPS`` runs of near-equal length; a line has a template for each one
or two runs that hold no more than a fifth (``percent``) of its constant places: the line
without them, as the XOR of the other runs' hashes.  Two lines of a leaf share a template
if, and only if, they are equal outside one or two such runs - up to thirteen tokens, wherever
they differ in no more than a fifth.  So alike lines meet by grouping on equal templates,
and no two lines are ever compared: the number of jobs is the same for a leaf of two lines
and of a million, and a leaf's rows spread over all partitions.

A line is dropped from a document if its text or one of its templates occurs in a document
with a smaller id; the first document that has a template keeps its line.

A line's text is looked at once, when it is masked and hashed; only ids and hashes of fixed
width are shuffled, pre-aggregated, until the kept lines are put together.

Defined results: null and empty texts have no lines to drop and stay as they are; a
document all of whose worded lines were dropped is not kept (it repeats others); rows with
the same id are one document, so lines they share stay; a null id counts as larger than
any other, and such rows do not repeat each other; extra columns pass through."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import materialize, materialize_counted

MIN_TOKENS = 3
#: Characters from which a line of fewer tokens can recur.
MIN_CHARS = 20
WORDS = 3
DEPTH = 3
GROUPS = 10
PERCENT = 80
#: Bits per leaf of the bitmap that tells lines of open leaves, and its largest size (16 MB,
#: 35 MB as it is broadcast).
BITS = 16
MAX_BITS = 1 << 27
_SPACES = " \t\n\x0b\x0c\r"
_GAP = r"[\x20\x09-\x0D]+"
# A word with a digit; each word is looked at once from its start.
_VARIABLE = r"(?<![^\x20\x09-\x0D])(?=[^\x20\x09-\x0D0-9]*+[0-9])[^\x20\x09-\x0D]++"


# At least WORDS tokens with a letter; anchored, so that it is tried once.
_WORDED = r"^[^\p{L}]*+\p{L}" + (WORDS - 1) * r"[^ ]*+ [^\p{L}]*+\p{L}"


def spaced(line: Column) -> Column:
    """The line's tokens with one space between them."""
    wide = line.contains("  ") | line.startswith(" ") | line.endswith(" ") | line.rlike(r"[\x09-\x0D]")
    return F.when(wide, F.regexp_replace(F.btrim(line, F.lit(_SPACES)), _GAP, " ")).otherwise(line)


def masked(line: Column) -> Column:
    """A spaced line with its fields that hold digits as ``<*>``."""
    return F.when(line.rlike("[0-9]"), F.regexp_replace(line, _VARIABLE, "<*>")).otherwise(line)


def _count(x: Column, of: str) -> Column:
    return ((F.octet_length(x) - F.octet_length(F.replace(x, F.lit(of), F.lit("")))) / len(of)).cast("int")


def _constant(body: Column, n: Column) -> Column:
    """Whether enough of a masked line is constant for a template."""
    return body.rlike(_WORDED) & F.when(body.contains("<*>"), 3 * (n - _count(body, "<*>")) >= n).otherwise(True)


def _hash(x: Column) -> Column:
    return F.unhex(F.md5(x))


def _cut(n: Column, i: Column, depth: int) -> Column:
    """The first place, after the leading tokens, of run ``i``."""
    return F.call_function("div", F.greatest(n - depth, F.lit(0)) * i, F.lit(GROUPS)).cast("int")


def _size(n: Column, i: Column, depth: int) -> Column:
    return _cut(n, i + 1, depth) - _cut(n, i, depth)


def _lines(docs: DataFrame, *cols: str, depth: int = DEPTH) -> DataFrame:
    """(cols, pos, h, leaf, n, stars, g0, g1, ...): lines with the hash of their masked text
    (of their text, where too little is constant), their leaf, token and variable counts, and
    a hash of each run of places; n is 0 for lines without further templates."""
    # masked and counted inside the array, so that each line is worked on once
    lines = F.transform(F.transform(F.split("text", "\n"), spaced), lambda x: F.struct(
        x.alias("plain"), masked(x).alias("body"), (_count(x, " ") + 1).alias("n")))
    judged = F.transform(lines, lambda x: F.struct(
        x["plain"].alias("plain"), x["body"].alias("body"), x["n"].alias("n"),
        ((x["n"] < MIN_TOKENS) | ~_constant(x["body"], x["n"])).alias("exact")))
    at = (docs.select(*cols, F.posexplode(judged).alias("pos", "line"))
          .where((F.col("line.n") >= MIN_TOKENS) | (F.char_length("line.plain") >= MIN_CHARS))
          .select(*cols, "pos", "line.exact", F.when(F.col("line.exact"), F.col("line.plain")).otherwise(F.col("line.body")).alias("body"),
                  F.when(F.col("line.exact"), 0).otherwise(F.col("line.n")).alias("n")))
    leaf = F.when(F.col("n") > 0, F.xxhash64("n", F.substring_index("body", " ", depth))).otherwise(F.xxhash64("body"))
    # the tokens are bound once, as an argument, and not split again for every run
    n = F.col("n")
    runs = F.get(F.transform(F.array(F.split("body", " ")), lambda t: F.transform(F.sequence(F.lit(0), F.lit(GROUPS - 1)), lambda i: F.xxhash64(
        i, F.slice(t, _cut(n, i, depth) + depth + 1, _size(n, i, depth))))), 0)
    at = at.select(*cols, "pos", _hash(F.col("body")).alias("h"), leaf.alias("leaf"), "n", _count(F.col("body"), "<*>").alias("stars"),
                   F.when(n > 0, runs).alias("runs"))
    return at.select(*cols, "pos", "h", "leaf", "n", "stars",
                     *(F.coalesce(F.get("runs", i), F.lit(0).cast("long")).alias(f"g{i}") for i in range(GROUPS)))


def _earlier(lo: Column, hi: Column, nulls: Column) -> Column:
    """Whether a template recurs: two different ids, or an id and rows without one."""
    return (lo < hi) | (lo.isNotNull() & nulls)


def _templates(lines: DataFrame, depth: int, percent: int) -> DataFrame:
    """The lines' templates: which runs are variable, and the XOR of the others' hashes."""
    whole = F.col("g0")
    for i in range(1, GROUPS):
        whole = whole.bitwiseXOR(F.col(f"g{i}"))
    cols = [F.col(c) for c in ("leaf", "h", "lo", "hi", "nulls", "n", "stars")]
    hashes = F.array(*(f"g{i}" for i in range(GROUPS)))
    one = (lines.select(*cols, whole.alias("whole"), hashes.alias("gs"), F.posexplode(hashes).alias("i", "gi"))
           .withColumn("si", _size(F.col("n"), F.col("i"), depth)).where("si > 0"))
    two = (one.select(*cols, "whole", "i", "gi", "si", F.posexplode("gs").alias("j", "gj")).where("j >= i")
           .withColumn("sj", _size(F.col("n"), F.col("j"), depth)).where("sj > 0"))
    single = F.col("i") == F.col("j")
    m = F.col("si") + F.when(single, 0).otherwise(F.col("sj"))
    rest = F.col("whole").bitwiseXOR(F.col("gi")).bitwiseXOR(F.when(single, F.lit(0).cast("long")).otherwise(F.col("gj")))
    return (two.where(100 * m <= (100 - percent) * (F.col("n") - F.col("stars")))
            .select("leaf", (F.col("i") * GROUPS + F.col("j")).alias("runs"), rest.alias("rest"), "h", "lo", "hi", "nulls"))


def _maybe_in(lines: DataFrame, leaves: DataFrame, count: int) -> DataFrame:
    """``lines`` without most of those whose leaf is not among the ``count`` ``leaves``: one bit
    test each, in a broadcast bitmap of at most ``MAX_BITS`` bits.  No line of the leaves is
    lost; how many others stay (one in ``BITS``, more beyond the bound) changes no result, as
    a join with the leaves follows."""
    bits = 1024
    while bits < min(BITS * count, MAX_BITS):
        bits *= 2
    at = F.pmod("leaf", F.lit(bits))
    word = F.shiftright(at, 6).bitwiseAND(15).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(63).cast("int"))
    maps = leaves.groupBy(F.shiftright(at, 10).alias("_bin")).agg(
        F.array(*(F.coalesce(F.bit_or(F.when(word == i, bit)), F.lit(0).cast("long")) for i in range(16))).alias("_words"))
    near = lines.withColumn("_bin", F.shiftright(at, 10)).join(F.broadcast(maps), "_bin")
    return near.where(F.getbit(F.get("_words", word), at.bitwiseAND(63).cast("int")) == 1).drop("_bin", "_words")


def recurring(found: DataFrame, depth: int = DEPTH, percent: int = PERCENT) -> DataFrame:
    """(h, lo): hashes of the lines whose text or a template of which recurs, with the
    smallest id that has it.  ``found``: :func:`_lines` with ``id``, written before."""
    ids = (F.min("id").alias("lo"), F.max("id").alias("hi"), F.max(F.col("id").isNull()).alias("nulls"))
    seen = materialize(found.groupBy("leaf", "h").agg(*ids, F.min("n").alias("n")), "lines-seen")
    spans = (F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.max("nulls").alias("nulls"))
    recurs = _earlier(F.col("lo"), F.col("hi"), F.col("nulls"))
    # leaves with two different lines, in different documents
    open_ = seen.where("n > 0").groupBy("leaf").agg(*spans, F.count("*").alias("k")).where((F.col("k") > 1) & recurs).select("leaf")
    # written, so that the joins below are plain shuffles, which Spark splits at a hot leaf
    open_, leaves = materialize_counted(open_, "lines-leaves")
    # the hashes of runs are shuffled for few lines beside those of open leaves
    wide = (_maybe_in(found.where("n > 0"), open_, leaves).groupBy("leaf", "h")
            .agg(*ids, *(F.min(c).alias(c) for c in ("n", "stars", *(f"g{i}" for i in range(GROUPS))))))
    keys = materialize(_templates(wide.join(open_, "leaf"), depth, percent), "lines-templates")
    shared = (keys.groupBy("leaf", "runs", "rest").agg(*spans, F.count("*").alias("k")).where((F.col("k") > 1) & recurs)
              .select("leaf", "runs", "rest", F.col("lo").alias("first")))
    shared = materialize(shared, "lines-shared")
    told = keys.join(shared, ["leaf", "runs", "rest"]).select("h", F.col("first").alias("lo"))
    own = seen.where(recurs).select("h", "lo")
    return told.unionByName(own).groupBy("h").agg(F.min("lo").alias("lo"))


def decide(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with ``_dropped`` (positions of dropped lines, ascending) and ``_text`` (what
    is left); free names are taken if the caller has such columns."""
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    # rows are told apart by id and text; equal rows have equal decisions
    lines = _lines(src.withColumn("key", _hash(F.coalesce("text", F.lit("")))), "id", "key", depth=how.get("depth", DEPTH))
    found = materialize(lines, "lines-found")
    gone = materialize(recurring(found, **how), "lines-recurring")
    drops = (found.select("id", "key", "pos", "h").join(gone, "h").where(F.col("id").isNull() | (F.col("id") > F.col("lo")))
             .groupBy("id", "key").agg(F.sort_array(F.collect_set("pos")).alias("pos")))
    drops = materialize(drops, "lines-drops")
    mark, rest, at, pos = (_free(docs, c) for c in ("_dropped", "_text", "_at", "_pos"))
    here = docs.withColumn(mark, F.struct(F.col(id_col).cast("long").alias("id"), _hash(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("key")))
    there = drops.select(F.struct("id", "key").alias(at), F.col("pos").alias(pos))
    j = here.join(there, F.col(mark).eqNullSafe(F.col(at)), "left")
    parts = F.split(F.col(text_col).cast("string"), "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col(pos))
    text = F.when(F.col(pos).isNull(), F.col(text_col)).otherwise(F.array_join(F.transform(kept, lambda i: F.get(parts, i)), "\n"))
    return j.withColumn(rest, text).withColumn(mark, F.coalesce(pos, F.array().cast("array<int>"))).drop(at, pos)


def _free(docs: DataFrame, name: str) -> str:
    while name.lower() in {c.lower() for c in docs.columns}:
        name = "_" + name
    return name


def keeps(dropped: str, text: str) -> Column:
    """Whether a decided row stays: nothing was dropped, or words are left."""
    return (F.size(dropped) == 0) | F.coalesce(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))


def drop_recurring(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` without its recurring lines, columns as given; rows that only repeated
    others are gone."""
    out = decide(docs, id_col, text_col, **how)
    mark, rest = _free(docs, "_dropped"), _free(docs, "_text")
    kind = docs.schema[text_col].dataType.simpleString()
    return out.where(keeps(mark, rest)).withColumn(text_col, F.col(rest).cast(kind)).select(*docs.columns)
