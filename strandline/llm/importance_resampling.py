"""Importance resampling towards a target distribution, on hashed word runs.

An untrained ``tokenizers`` Split by a fixed pattern returns the words of the ASCII-lowered
text with their offsets.  A window is a pair of offsets, the start of a word and the end of
the same or a later one; its words, joined by one space, are a feature, hashed by CRC-32
into ``buckets``.  Histograms over all documents (s, in all S) and over all target texts
(t, in all T) give each bucket the gain floor(1000 ln((t+1)(S+B) / ((s+1)(T+B)))); a
document's weight is the sum of its features' gains, and adding Gumbel noise from a hash of
its id makes the highest scores a draw without replacement.

Texts are read once: the documents' buckets are written, two bytes a feature, and counted
and summed from there.  Histograms are added up in the tasks before they are shuffled, and
a gain for each bucket is all that is collected and broadcast.  Ranks come from a range
partitioning by score and id, numbered within partitions, with the counts of the earlier
partitions (a row for each partition) added; ties spread over partitions by id.

Defined results: null and empty texts have no words, weight 0 and are never drawn; without
target texts T and all t are 0; a null id counts as the empty text in the noise and comes
after all others of its score; rows with equal id and score are ranked in any order;
repeated rows are documents of their own; an empty table gives no rows; other columns of
the caller stay out; texts of any length are read whole."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex
from tokenizers.pre_tokenizers import Split

from strandline.llm.common import broadcast_bytes, docs_of, materialize, materialize_counted, per_row

#: A word of ASCII-lowered text: digits, letters and what is not ASCII.
PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
RUN = 1
MIN_WORDS = 20
#: Cached words of a task.
CACHE_ENTRIES = 300_000
_ROW_BITS = 33      # monotonically_increasing_id: partition number above, row number below


class Features:
    """Windows of up to ``run`` words of a text and their buckets."""

    def __init__(self, run: int = RUN, buckets: int = BUCKETS, pattern: str = PATTERN) -> None:
        if run < 1 or not 1 <= buckets <= 1 << 32:
            raise ValueError("run is at least 1, buckets at most 2**32")
        self.run, self.buckets = run, buckets
        self.split = Split(Regex(pattern), "removed", invert=True)
        self.crc: dict[str, int] = {}

    def words(self, text: bytes) -> list[tuple[str, tuple[int, int]]]:
        """Words with their offsets in characters; bytes.lower touches ASCII letters only."""
        return self.split.pre_tokenize_str(text.lower().decode("utf-8", "replace"))

    def windows(self, text: bytes) -> Iterator[tuple[int, int, int]]:
        """(start, end, bucket) of every window, shorter ones first."""
        words = self.words(text)
        hashes = [self._crc(w) for w, _ in words]
        for k in range(1, self.run + 1):
            if k > 1:       # the window before, one more space and word
                hashes = [zlib.crc32(b" " + w.encode(), h) for h, (w, _) in zip(hashes, words[k - 1:])]
            for h, (_, first), (_, last) in zip(hashes, words, words[k - 1:]):
                yield first[0], last[1], h % self.buckets

    def of(self, text: bytes) -> tuple[int, np.ndarray]:
        """The number of words and the buckets of all windows."""
        words = self.words(text)
        runs = hashes = [self._crc(w) for w, _ in words]
        for k in range(1, self.run):
            hashes = [zlib.crc32(b" " + w.encode(), h) for h, (w, _) in zip(hashes, words[k:])]
            runs = runs + hashes
        return len(words), np.array(runs, np.uint32) % np.uint32(self.buckets) if self.buckets < 1 << 32 else np.array(runs, np.uint32)

    def _crc(self, word: str) -> int:
        got = self.crc.get(word)
        if got is None:
            if len(self.crc) >= CACHE_ENTRIES:
                self.crc.clear()
            got = self.crc[word] = zlib.crc32(word.encode())
        return got


def _kind(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def features(docs: DataFrame, run: int = RUN, buckets: int = BUCKETS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_features, buckets): the buckets of a text's windows, packed."""
    schema = pa.schema([("id", pa.string()), ("n_words", pa.int64()), ("n_features", pa.int64()), ("buckets", pa.binary())])

    def mapped(rows: Iterator[tuple]) -> Iterator[tuple]:
        found = Features(run, buckets)
        for key, text in rows:
            n, at = found.of(text)
            yield key, n, len(at), np.sort(at).astype(_kind(buckets)).tobytes()

    src = docs_of(docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("body")), "id", text="body")
    return src.mapInArrow(per_row(mapped, schema, 512), "id string, n_words long, n_features long, buckets binary")


def histogram(feats: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket, over all rows; added up in the tasks, then by bucket."""
    schema = pa.schema([("bucket", pa.int64()), ("n", pa.int64())])

    def counted(rows: Iterator[tuple]) -> Iterator[tuple]:
        seen = np.zeros(buckets, np.int64)
        for (packed,) in rows:
            at, n = np.unique(np.frombuffer(packed, _kind(buckets)), return_counts=True)
            seen[at] += n
        used = np.flatnonzero(seen)
        yield from zip(used.tolist(), seen[used].tolist())

    out = np.zeros(buckets, np.int64)
    rows = feats.select("buckets").mapInArrow(per_row(counted, schema), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for r in rows.collect():        # a row for each bucket at most
        out[r["bucket"]] = r["n"]
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A bucket's gain, in doubles: floor(1000 ln((t+1)(S+B) / ((s+1)(T+B))))."""
    b = len(raw)
    top, low = float(int(raw.sum()) + b), float(int(target.sum()) + b)
    return np.array([math.floor(1000 * math.log((float(t + 1) * top) / (float(s + 1) * low)))
                     for s, t in zip(raw.tolist(), target.tolist())], np.int64)


def noise(id_col: Column, seed: str) -> Column:
    """floor(-1000 ln(-ln(u))): Gumbel noise from the first 32 bits of a SHA-256."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def weigh(docs: DataFrame, target: DataFrame, run: int = RUN, buckets: int = BUCKETS, seed: str = "2024",
          id_col: str = "doc_id", text_col: str = "text", target_id: str = "item_id", target_text: str = "text") -> DataFrame:
    """(id, n_words, n_features, weight, score) of every row of ``docs``."""
    spark = docs.sparkSession
    feats = materialize(features(docs, run, buckets, id_col, text_col), "resample-features")
    aim = histogram(features(target, run, buckets, target_id, target_text), buckets)
    gain = gains(histogram(feats, buckets), aim)
    held = broadcast_bytes(spark, "gains", gain, gain.nbytes, 8 * buckets)
    schema = pa.schema([("id", pa.string()), ("n_words", pa.int64()), ("n_features", pa.int64()), ("weight", pa.int64())])

    def summed(rows: Iterator[tuple]) -> Iterator[tuple]:
        table = held.value
        for key, words, n, packed in rows:
            yield key, words, n, int(table[np.frombuffer(packed, _kind(buckets))].sum())

    kind = docs.schema[id_col].dataType.simpleString()
    out = feats.mapInArrow(per_row(summed, schema), "id string, n_words long, n_features long, weight long")
    return out.select(F.col("id").cast(kind).alias(id_col), "n_words", "n_features", "weight",
                      (F.col("weight") + noise(F.col("id"), seed)).alias("score"))


def draw(weighed: DataFrame, percent: int = 10, min_words: int = MIN_WORDS, id_col: str = "doc_id") -> DataFrame:
    """``weighed`` with ``rank``: of the N rows with at least ``min_words`` words, the
    floor(percent N / 100) highest scores are numbered from 1, ties to the smaller id; null
    for the others."""
    order = [F.desc("score"), F.asc_nulls_last(id_col)]
    parts = int(weighed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # ranges are cut from a sample, so the rows are written before and not weighed twice
    weighed = materialize(weighed, "resample-weighed")
    fit = F.col("n_words") >= min_words
    sorted_ = weighed.where(fit).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed, n = materialize_counted(sorted_.withColumn("_at", F.monotonically_increasing_id()), "resample-sorted")
    part = F.shiftright("_at", _ROW_BITS)
    sizes = sorted((r["p"], r["n"]) for r in placed.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect())
    before = dict(zip((p for p, _ in sizes), accumulate((k for _, k in sizes), initial=0)))
    # a row for each partition
    starts = weighed.sparkSession.createDataFrame(list(before.items()), "_part long, _start long")
    placed = placed.withColumn("_part", part).join(F.broadcast(starts), "_part")
    place = F.col("_start") + (F.col("_at") - F.shiftleft("_part", _ROW_BITS)) + 1
    rank = F.when(place <= percent * n // 100, place).cast("long")
    return placed.withColumn("rank", rank).drop("_at", "_part", "_start").unionByName(weighed.where(~fit).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, min_words: int = MIN_WORDS, **how) -> DataFrame:
    """:func:`weigh`, then :func:`draw`."""
    return draw(weigh(docs, target, **how), percent, min_words, how.get("id_col", "doc_id"))
