"""Benchmark decontamination: every training passage queries a BM25 index of test items.

Items are cut into units of at most ``UNIT`` words; the index holds for each term its
units with BM25 weights, as a share of the unit's score for itself, in blocks with their
largest weight.  A passage (a window of 2 * UNIT words every UNIT words, so that any unit
lies whole inside one) retrieves all units that reach the share ``threshold``.  Retrieval
is block-max WAND: a unit can only reach the threshold if a passage has one of the unit's
few heaviest terms, so only those lists drive the search; a candidate is then bounded by
the block maxima of the passage's lists and scored only if the bound reaches the
threshold.  A retrieved item is verified against the whole document: five-word shingles
of its question (all but the last sentence) and of its answer (the last sentence) must be
found to ``overlap`` or more each.

Statistics of terms cover all items.  The index goes out in shards of at most
``SHARD_BYTES``, one pass over the documents for each, so a large benchmark stays exact.

Defined results: null and empty texts match nothing; items without words are left out;
items with fewer than five words match as a whole; repeated documents or items give a row
for each; without items or documents the result is empty."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import broadcast_bytes, docs_of, materialize, per_row

UNIT = 64
BLOCK = 32
K1, B = 1.2, 0.75
SHARD_BYTES = 32 << 20
THRESHOLD = 0.7
OVERLAP = 0.8
_WORD = re.compile(r"\w+")
_SENTENCE = re.compile(r"[.!?]+[\s]+|\n+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def shingles(words: list[str], k: int = 5) -> set[tuple[str, ...]]:
    if not words:
        return set()
    return {tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))}


def question_answer(text: str) -> tuple[list[str], list[str]]:
    """Words of all but the last sentence, and of the last; a single sentence is both."""
    parts = [w for w in (words_of(x) for x in _SENTENCE.split(text)) if w]
    if len(parts) < 2:
        return (parts[0], parts[0]) if parts else ([], [])
    return [w for p in parts[:-1] for w in p], parts[-1]


def _units(items: DataFrame) -> DataFrame:
    """(row, item, unit, n, term, tf) of all items' units; ``row`` keeps repeated ids apart."""
    schema = pa.schema([("row", pa.int64()), ("item", pa.string()), ("unit", pa.int32()), ("n", pa.int32()),
                        ("term", pa.string()), ("tf", pa.int32())])

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for row, item, text in rows:
            words = words_of(text.decode("utf-8", "replace"))
            for u, a in enumerate(range(0, len(words), UNIT)):
                # the last unit reaches back, so that no unit of a long item is tiny
                part = words[max(0, min(a, len(words) - UNIT)):a + UNIT]
                for t, tf in Counter(part).items():
                    yield row, item, u, len(part), t, tf

    return items.select("row", "item", "text").mapInArrow(per_row(run, schema), "row long, item string, unit int, n int, term string, tf int")


class Index:
    """Block-max index over units given as (item row, {term: share of own score})."""

    def __init__(self, units: list[tuple[int, dict[str, float]]], threshold: float) -> None:
        self.threshold, self.units = threshold, units
        lists: dict[str, list[int]] = {}
        self.driving: dict[str, list[int]] = {}
        for u, (_, terms) in enumerate(units):
            for t in terms:
                lists.setdefault(t, []).append(u)
            # without any of these heaviest terms the rest stays below the threshold
            rest = 1.0
            for t, w in sorted(terms.items(), key=lambda x: (-x[1], x[0])):
                self.driving.setdefault(t, []).append(u)
                rest -= w
                if rest < threshold - 1e-9:
                    break
        self.blocks: dict[str, dict[int, float]] = {}
        for t, us in lists.items():
            top: dict[int, float] = {}
            for u in us:
                top[u // BLOCK] = max(top.get(u // BLOCK, 0.0), units[u][1][t])
            self.blocks[t] = top

    def search(self, terms: set[str], driving: set[str]) -> Iterator[tuple[int, float]]:
        """(unit, share) of all units whose share in ``terms`` reaches the threshold;
        ``driving``: those of the terms that have a driving list."""
        cand = sorted({u for t in driving for u in self.driving[t]})
        if not cand:
            return
        tops = [b for b in map(self.blocks.get, terms) if b is not None]
        bound: dict[int, float] = {}
        for u in cand:
            b = u // BLOCK
            if b not in bound:
                bound[b] = sum(x.get(b, 0.0) for x in tops)
            if bound[b] < self.threshold - 1e-9:
                continue
            own = self.units[u][1]
            s = sum(w for t, w in own.items() if t in terms)
            if s >= self.threshold - 1e-9:
                yield u, s


def _search_docs(docs: DataFrame, shard, texts, overlap: float) -> DataFrame:
    schema = pa.schema([("doc", pa.string()), ("item", pa.string()), ("score", pa.float64()), ("question", pa.float64()), ("answer", pa.float64())])

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        index: Index = shard.value
        drives = index.driving.keys()
        parts: dict[int, tuple[str, set, set]] = {}
        for key, raw in rows:
            words = words_of(raw.decode("utf-8", "replace"))
            at = [i for i, w in enumerate(words) if w in drives]
            best: dict[int, float] = {}
            done = -1
            for i in at:
                # the windows that start at a multiple of UNIT and hold position i
                for a in (max(0, i // UNIT - 1) * UNIT, i // UNIT * UNIT):
                    if a > done:
                        done = a
                        window = set(words[a:a + 2 * UNIT])
                        for u, s in index.search(window, window & drives):
                            row = index.units[u][0]
                            best[row] = max(best.get(row, 0.0), s)
            if not best:
                continue
            have = shingles(words)
            for row, s in sorted(best.items()):
                if row not in parts:
                    item, text = texts.value[row]
                    q, a = question_answer(text)
                    parts[row] = item, shingles(q), shingles(a)
                item, q, a = parts[row]
                short = {k: shingles(words, k) for k in {len(x) for x in q | a} if k < 5}
                found = lambda side: sum(x in (have if len(x) == 5 else short[len(x)]) for x in side) / len(side)
                qs, ans = found(q), found(a)
                if qs >= overlap and ans >= overlap:
                    yield key, item, s, qs, ans

    return docs.mapInArrow(per_row(run, schema), "doc string, item string, score double, question double, answer double")


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 item_text: str = "text", threshold: float = THRESHOLD, overlap: float = OVERLAP,
                 shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(id, item, score, question, answer): documents that hold a test item."""
    spark = docs.sparkSession
    rows = materialize(docs_of(items.select(F.col(item_col).cast("string").alias("item"), F.col(item_text).alias("body")),
                               "item", text="body").withColumn("row", F.monotonically_increasing_id()), "bench-items")
    units = materialize(_units(rows), "bench-units")
    per = units.select("row", "unit", "n").distinct()
    total = per.agg(F.count("*").alias("n"), F.avg("n").alias("mean")).first()
    src = docs_of(docs, id_col, text=text_col).select(F.col(id_col).cast("string").alias("doc"), "text")
    n, mean = total["n"], total["mean"] or 1.0
    df = units.groupBy("term").agg(F.count("*").alias("df"))
    idf = F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5))
    tf = F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("n") / mean))
    weighted = materialize(units.join(df, "term").groupBy("row", "unit")
                           .agg(F.map_from_entries(F.collect_list(F.struct("term", (idf * tf).alias("w")))).alias("terms")), "bench-weights")
    size = (units.agg(F.sum(F.octet_length("term") + 120)).first()[0] or 0) + (rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    shards = max(1, math.ceil(2 * size / shard_bytes))
    out = None
    for k in range(shards):
        mine = F.pmod(F.xxhash64("row"), F.lit(shards)) == k
        got = weighted.where(mine).orderBy("row", "unit").collect()      # bounded by shard_bytes
        known = [(r["row"], {t: w / total_w for t, w in sorted(r["terms"].items())})
                 for r in got if (total_w := sum(w for _, w in sorted(r["terms"].items()))) > 0]
        bound = 4 * shard_bytes
        shard = broadcast_bytes(spark, "benchmark index", Index(known, threshold), sum(len(t) + 60 for _, x in known for t in x), bound)
        text = {r["row"]: (r["item"], bytes(r["text"]).decode("utf-8", "replace")) for r in rows.where(mine).collect()}
        texts = broadcast_bytes(spark, "benchmark texts", text, sum(len(t) for _, t in text.values()), bound)
        part = _search_docs(src, shard, texts, overlap)
        out = part if out is None else out.unionByName(part)
    kinds = {id_col: docs.schema[id_col].dataType.simpleString(), item_col: items.schema[item_col].dataType.simpleString()}
    return out.select(F.col("doc").cast(kinds[id_col]).alias(id_col), F.col("item").cast(kinds[item_col]).alias(item_col),
                      "score", "question", "answer")
