"""Audit of how far the sources of a language differ in their words, by count-level bitmaps.

Every group, a (lang, source), gives each of the V terms that its language keeps a smoothed
share p, which depends on the term's count in the group alone.  So two groups need not be
compared term by term: for each (group, count) a bitset holds the ids of the terms that have
this count there, AND plus popcount of two groups' bitsets gives the number of terms in
each joint cell (a, b), and a cell adds its number times f(p(a), q(b)).  Cells with a zero
come by complement: a level's terms that met no level of the other group, and the terms
that are in neither.

Term ids are positions in blocks of about ``Layout.block`` terms, dealt by hash, so a bitset never
grows with the vocabulary.  A level with few terms of a block is held as a list of positions
in place of a bitset, and an AND with it tests single bits.  Groups of a language go into
tiles of ``Layout.tile``; a task holds two tiles of one block, so neither many sources nor many
terms meet in one task, and a third of all documents in one source adds no more than that
source's bitsets.  Texts are counted inside the tasks before anything is shuffled.

All arithmetic is exact: integers throughout, of any size where counts are scaled.

Defined results: null text, lang and source count as ''; repeated rows are documents of
their own; a text without terms gives its group and no counts; a language that keeps no
term has pairs of value 0 and no term rows; a language's only source has no pairs; an empty
table gives no rows; other columns of the caller stay out; texts are read whole."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm.common import materialize, per_row
from strandline.session import broadcast_checked

#: A term of ASCII-lowered text: letters and what is not ASCII.
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
MIN_DOCS = 10
SCALE = 1_000_000_000
TOP = 10


@dataclass(frozen=True)
class Layout:
    """How the work is cut: terms of a block on average and what its positions may reach,
    groups of a tile, terms of a block from which a level is held as a bitset, and distinct
    (lang, source, term) that a task counts before it passes them on."""

    block: int = 6_000
    bits: int = 1 << 13
    tile: int = 32
    dense: int = 512
    flush: int = 300_000


def count_terms(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", layout: Layout = Layout()) -> DataFrame:
    """(lang, source, term, n, df): occurrences, and rows that hold the term; every
    occurring group also has a row with the term ''."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("df", pa.int64())])

    one = 1 << 40       # a row that holds a term; its occurrences are counted below this

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        groups: dict[tuple, dict[str, int]] = {}

        def flush():
            while groups:
                (la, so), seen = groups.popitem()
                yield la, so, "", 0, 0
                while seen:
                    t, k = seen.popitem()
                    yield la, so, t, k % one, k // one

        held = 0
        for la, so, body in rows:
            seen = groups.setdefault((la, so), {})
            get, held = seen.get, held - len(seen)
            for t, k in Counter(TERM.findall(body.lower().decode("utf-8", "replace"))).items():
                seen[t] = get(t, 0) + k + one
            held += len(seen)
            if held > layout.flush:
                yield from flush()
                held = 0
        yield from flush()

    plain = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source"), (text, "text"))]
    src = docs.select(*plain).withColumn("text", F.col("text").cast("binary"))
    return (src.mapInArrow(per_row(run, schema, 8192), "lang string, source string, term string, n long, df long")
            .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df")))


def share(n: Column, total: Column, v: Column) -> Column:
    """p = 1 + floor(SCALE (n + 2) / (total + 2 v)); in decimals, which hold any count."""
    top = F.lit(SCALE).cast("decimal(10,0)") * (n + 2).cast("decimal(20,0)")
    return F.lit(1) + F.call_function("div", top, (total + 2 * v).cast("decimal(20,0)"))


def divergence(p: Column, q: Column) -> Column:
    """f = floor((p - q)^2 / (p + q)), in longs: p and q are at most SCALE + 1."""
    return F.call_function("div", (p - q) * (p - q), p + q)


class Levels:
    """One group's terms of a block by count: bitsets of the dense levels, positions of the
    others, ordered by level."""

    def __init__(self, rows: list[tuple[int, int, bytes]], total: int, v: int, layout: Layout) -> None:
        def p(n: int) -> int:
            return 1 + SCALE * (n + 2) // (total + 2 * v)

        dense = [r for r in rows if r[1] >= layout.dense]
        sparse = [r for r in rows if 0 < r[1] < layout.dense]
        self.n = np.array([r[1] for r in dense + sparse], np.int64)
        self.p = np.array([p(r[0]) for r in dense + sparse], np.int64)
        self.zero = p(0)
        self.dense = len(dense)
        self.bits = np.zeros((len(dense), layout.bits // 64), np.uint64)
        for row, (_, _, packed) in zip(self.bits, dense):
            row.view(np.uint8)[:len(packed)] = np.frombuffer(packed, np.uint8)
        self.positions = np.concatenate([np.frombuffer(r[2], "<u2") for r in sparse]) if sparse else np.zeros(0, "<u2")
        self.level = np.repeat(np.arange(self.dense, len(self.n)), self.n[self.dense:])
        # the sparse level at a position, -1: none
        self.at = np.full(layout.bits, -1, np.int32)
        self.at[self.positions] = self.level


def cells(g: Levels, h: Levels) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(level of g, level of h, terms in both) of the joint cells that hold any."""
    both = np.bitwise_count(g.bits[:, None, :] & h.bits[None, :, :]).sum(2, np.int64)
    a, b = np.nonzero(both)
    out = [(a, b, both[a, b])]
    for x, y, flip in ((g, h, False), (h, g, True)):
        for i in range(x.dense):            # bits of a dense level at the other's positions
            bit = x.bits[i].view(np.uint8)[y.positions >> 3] >> (y.positions & 7).astype(np.uint8) & 1
            n = np.bincount(y.level[bit.astype(bool)], minlength=len(y.n))
            j = np.flatnonzero(n)
            there = np.full(len(j), i)
            out.append((j, there, n[j]) if flip else (there, j, n[j]))
    met = h.at[g.positions]                 # sparse with sparse
    key, n = np.unique(g.level[met >= 0] * np.int64(len(h.n)) + met[met >= 0], return_counts=True)
    if len(key):
        out.append((key // len(h.n), key % len(h.n), n))
    return tuple(np.concatenate(c) for c in zip(*out))


def pair_value(g: Levels, h: Levels, size: int) -> int:
    """The sum of f over a block's ``size`` terms."""
    def f(p, q):
        return (p - q) * (p - q) // (p + q)

    a, b, n = cells(g, h)
    only_g = g.n - np.bincount(a, n, len(g.n)).astype(np.int64)
    only_h = h.n - np.bincount(b, n, len(h.n)).astype(np.int64)
    neither = size - int(g.n.sum()) - int(h.n.sum()) + int(n.sum())
    return int((n * f(g.p[a], h.p[b])).sum() + (only_g * f(g.p, h.zero)).sum()
               + (only_h * f(g.zero, h.p)).sum()) + neither * f(g.zero, h.zero)


def level_bitsets(placed: DataFrame, layout: Layout = Layout()) -> DataFrame:
    """(lang, block, idx, level, terms, bits) from (lang, block, idx, n, pos): the ids of the
    terms with one count in one group and block, as bitset or, if few, positions."""
    def build(frame: pa.Table) -> pa.Table:
        lang, block, idx = (frame[c][0].as_py() for c in ("lang", "block", "idx"))
        n, pos = frame["n"].to_numpy(), frame["pos"].to_numpy()
        order = np.lexsort((pos, n))
        n, pos = n[order], pos[order]
        cuts = np.flatnonzero(np.diff(n)) + 1
        levels, packed, sizes = [], [], []
        for at in np.split(pos, cuts):
            if len(at) >= layout.dense:
                bits = np.zeros(layout.bits, np.uint8)
                bits[at] = 1
                packed.append(np.packbits(bits, bitorder="little").tobytes())
            else:
                packed.append(at.astype("<u2").tobytes())
            sizes.append(len(at))
        levels = n[np.concatenate([[0], cuts])].astype(np.int64)
        k = len(sizes)
        return pa.table({"lang": pa.array([lang] * k, pa.string()), "block": pa.array([block] * k, pa.int64()), "idx": pa.array([idx] * k, pa.int64()),
                         "level": pa.array(levels, pa.int64()), "terms": pa.array(sizes, pa.int64()), "bits": pa.array(packed, pa.binary())})

    return placed.groupBy("lang", "block", "idx").applyInArrow(build, "lang string, block long, idx long, level long, terms long, bits binary")


def pair_sums(levels: DataFrame, langs: DataFrame, groups: DataFrame, blocks: DataFrame, layout: Layout = Layout()) -> DataFrame:
    """(lang, g, h, value) for the pairs g < h of a language's groups."""
    tiles = F.ceil(F.col("n_groups") / layout.tile).cast("long")
    # a row for each group of a block, with or without levels there
    frame = (blocks.join(groups, "lang").select("lang", "block", "idx", F.lit(0).cast("long").alias("level"), "size",
                                                "total", F.lit(0).cast("long").alias("terms"), F.lit(None).cast("binary").alias("bits")))
    filled = levels.select("lang", "block", "idx", "level", F.lit(None).cast("long").alias("size"), F.lit(None).cast("long").alias("total"), "terms", "bits")
    rows = (frame.unionByName(filled).join(langs.select("lang", "v", "n_groups"), "lang")
            .withColumn("mine", F.floor(F.col("idx") / layout.tile).cast("long")).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), tiles - 1)))
            .select("lang", "block", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"),
                    "idx", "level", "size", "total", "terms", "bits", "v"))

    def run(key: tuple, frame: pa.Table) -> pa.Table:
        lang, _, lo, hi = (k.as_py() for k in key)
        held: dict[int, list] = {}
        head: dict[int, int] = {}
        size = 0
        v = frame["v"][0].as_py()
        for idx, level, of, total, terms, bits in zip(*(frame[c].to_pylist() for c in ("idx", "level", "size", "total", "terms", "bits"))):
            if bits is None:
                head[idx], size = total, of
            else:
                held.setdefault(idx, []).append((level, terms, bits))
        # a block without terms (a language that keeps none) adds nothing to its pairs
        made = {i: Levels(sorted(held.get(i, [])), n, v, layout) if size else None for i, n in sorted(head.items())}
        out = [(lang, g, h, pair_value(made[g], made[h], size) if size else 0) for g in made for h in made
               if g < h and g // layout.tile == lo and h // layout.tile == hi]
        schema = pa.schema([("lang", pa.string()), ("g", pa.int64()), ("h", pa.int64()), ("value", pa.int64())])
        return pa.Table.from_pylist([dict(zip(schema.names, r)) for r in out], schema)

    parts = rows.groupBy("lang", "block", "lo", "hi").applyInArrow(run, "lang string, g long, h long, value long")
    return parts.groupBy("lang", "g", "h").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = MIN_DOCS, top: int = TOP,
          layout: Layout = Layout()) -> DataFrame:
    """lang, source, part, item, value, rank.  Part ``pair``: every other source of the
    language with its divergence; part ``term``: the ``top`` terms that a group uses more
    than its language."""
    counts = materialize(count_terms(docs, lang, source, text, layout), "divergence-counts")
    words = counts.where("term != ''")
    of_lang = words.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("df").alias("df")).where(F.col("df") >= min_docs).drop("df")
    of_lang = materialize(of_lang, "divergence-kept")
    # a language: its terms and their count, its groups, and blocks enough for its terms
    langs = (counts.where("term = ''").groupBy("lang").agg(F.count("*").alias("n_groups"))
             .join(of_lang.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total")), "lang", "left")
             .na.fill(0, ["v", "lang_total"]).withColumn("n_blocks", F.greatest(F.lit(1), F.ceil(F.col("v") / layout.block)).cast("long")))
    langs = broadcast_checked(langs, "divergence-langs")
    block = F.pmod(F.xxhash64("term"), F.col("n_blocks"))
    at = F.row_number().over(Window.partitionBy("lang", "block").orderBy("term")) - 1
    ids = of_lang.join(langs.select("lang", "n_blocks"), "lang").withColumn("block", block).withColumn("pos", at.cast("long")).drop("n_blocks")
    kept = materialize(counts.where("term != ''").select("lang", "source", "term", "n").join(ids, ["lang", "term"]), "divergence-placed")
    groups = (counts.where("term = ''").select("lang", "source").withColumn("idx", (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).cast("long"))
              .join(kept.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left").na.fill(0, ["total"]))
    groups = broadcast_checked(groups, "divergence-groups")
    blocks = (langs.select("lang", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)).alias("block"))
              .join(kept.select("lang", "block", "pos").groupBy("lang", "block").agg((F.max("pos") + 1).alias("size")), ["lang", "block"], "left").na.fill(0, ["size"]))
    placed = kept.join(groups, ["lang", "source"])
    sums = pair_sums(level_bitsets(placed.select("lang", "block", "idx", "n", "pos"), layout), langs, groups, blocks, layout)
    both = sums.select("lang", "value", F.explode(F.array(F.struct(F.col("g").alias("idx"), F.col("h").alias("there")),
                                                          F.struct(F.col("h").alias("idx"), F.col("g").alias("there")))).alias("d"))
    names = groups.select("lang", "idx", "source")
    pairs = (both.select("lang", "d.idx", "d.there", "value").join(names, ["lang", "idx"])
             .join(names.select("lang", F.col("idx").alias("there"), F.col("source").alias("item")), ["lang", "there"])
             .select("lang", "source", "item", "value"))
    scored = (placed.where("n > 0").join(langs.select("lang", "v", "lang_total"), "lang")
              .withColumn("p", share(F.col("n"), F.col("total"), F.col("v"))).withColumn("q", share(F.col("lang_n"), F.col("lang_total"), F.col("v")))
              .where("p > q").select("lang", "source", F.col("term").alias("item"), divergence(F.col("p"), F.col("q")).alias("value")))
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    terms = scored.withColumn("rank", place).where(F.col("rank") <= top).withColumn("part", F.lit("term"))
    cols = ("lang", "source", "part", "item", F.col("value").cast("long").alias("value"), F.col("rank").cast("int").alias("rank"))
    return pairs.withColumn("rank", place).withColumn("part", F.lit("pair")).select(*cols).unionByName(terms.select(*cols))
