"""Language-model scores from a subword lattice.

The pieces of an existing tokenizer are the edges of a lattice over each word's bytes.  A
word is one initial piece (those that begin a word), any number of inner pieces and a
stop; its probability is the sum over all segmentations, taken by the forward recursion in
log space.  Every piece starts from the tokenizer's own score (its rank gives the prior
mass) and is weighted by how often the tokenizer's segmentation of all training words uses
it.  A word seen in training also has a path of its own, as a whole: its count less an
absolute discount.  What the discounts leave is shared out by the lattice, so any word has
a probability and all of them sum to one.  A token is a word or the end of a text, so a
text's probability is the product over its words and one end.

Corpus counts cover all training texts and are kept as a table with a row for each
distinct word; words are scored once each in that table.  Texts meet it by a join: only
the ``head_words`` most frequent words (a bounded table) are broadcast, all others are
joined by a shuffle, so no case is left out at any size.

Defined results: a null or empty text is one end token; without training texts N and V
are 0; words of any length are scored whole; repeated rows are scored once each."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import exp, log1p

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.common import broadcast_bytes, docs_of, materialize, per_row

FLUSH_WORDS = 300_000
HEAD_WORDS = 100_000
MAX_MODEL_BYTES = 16 << 20
LN10 = math.log(10)


def tokens(text: bytes) -> list[bytes]:
    """Words of a text in UTF-8 with A-Z lower-cased; bytes.split cuts at the space and
    the controls from tab to carriage return, bytes.lower touches ASCII letters only."""
    return text.lower().split()


def count_words(docs: DataFrame) -> DataFrame:
    """(word, c): each distinct word of all texts with its count in training texts.
    ``docs``: train boolean, text binary.  Counted in the task before the shuffle."""
    schema = pa.schema([("word", pa.binary()), ("c", pa.int64())])

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        inside: Counter = Counter()
        outside: set = set()

        def flush():
            yield from inside.items()
            yield from ((w, 0) for w in outside if w not in inside)
            inside.clear(), outside.clear()

        for train, text in rows:
            if train:
                inside.update(tokens(text))
            else:
                outside.update(tokens(text))
            if len(inside) + len(outside) > FLUSH_WORDS:
                yield from flush()
        yield from flush()

    return (docs.select("train", "text").mapInArrow(per_row(run, schema, 16384), "word binary, c long")
            .groupBy("word").agg(F.sum("c").alias("c")))


def _segments(model: sentencepiece.SentencePieceProcessor, words: list[bytes]) -> list[list[int]]:
    return model.encode([w.decode("utf-8", "replace") for w in words], num_threads=1)


def count_pieces(words: DataFrame, model_bytes) -> DataFrame:
    """(piece, n): uses of each piece id in the tokenizer's segmentation of all training
    words, weighted by their counts."""
    schema = pa.schema([("piece", pa.int32()), ("n", pa.int64())])

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        sp = sentencepiece.SentencePieceProcessor(model_proto=model_bytes.value)
        out: Counter = Counter()
        part: list[tuple] = []

        def add():
            for (_, c), ids in zip(part, _segments(sp, [w for w, _ in part])):
                for i in ids:
                    out[i] += c
            part.clear()

        for row in rows:
            part.append(row)
            if len(part) == 4096:
                add()
        add()
        yield from out.items()

    return (words.where("c > 0").select("word", "c").mapInArrow(per_row(run, schema), "piece int, n long")
            .groupBy("piece").agg(F.sum("n").alias("n")))


@dataclass
class Lattice:
    """Log weights by piece (None: only a beginning of pieces); initial pieces open a word,
    inner ones go on, so the recursion takes all initial edges first."""

    initial: dict[bytes, float | None]
    inner: dict[bytes, float | None]
    stop: float

    def word(self, w: bytes) -> float:
        """Natural log of the word's probability: forward recursion over its bytes."""
        n = len(w)
        alpha: list[float | None] = [None] * (n + 1)
        for table, starts in ((self.initial, (0,)), (self.inner, range(n))):
            for i in starts:
                a = 0.0 if table is self.initial else alpha[i]
                if a is None:
                    continue
                for j in range(i if table is self.initial else i + 1, n + 1):
                    p = table.get(w[i:j], 1.0)
                    if p == 1.0:        # no piece begins like this
                        break
                    if p is not None:
                        t, was = a + p, alpha[j]
                        if was is None:
                            alpha[j] = t
                        else:
                            alpha[j] = t + log1p(exp(was - t)) if t > was else was + log1p(exp(t - was))
        return alpha[n] + self.stop


def _with_beginnings(weights: dict[bytes, float]) -> dict[bytes, float | None]:
    """Log weights, with None for what only begins a piece."""
    out: dict[bytes, float | None] = {k[:n]: None for k in weights for n in range(len(k))}
    return out | weights


def build_lattice(model: sentencepiece.SentencePieceProcessor, uses: dict[int, int], words: int,
                  prior_mass: float = 1000.0) -> Lattice:
    """Weights from prior mass by the vocabulary's own scores plus the corpus counts.  The
    vocabulary's score is minus its merge rank, so the mass falls off as 1 / rank; bytes
    share one part of it, so that any byte string has a segmentation."""
    size = model.get_piece_size()
    space = "▁"
    start: dict[bytes, float] = {}
    inner: dict[bytes, float] = {}
    ranked = 1 + sum(1 / (10 - model.get_score(i)) for i in range(size)
                     if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
    for i in range(size):
        if model.is_control(i) or model.is_unknown(i):
            continue
        piece = model.id_to_piece(i)
        n = uses.get(i, 0)
        if model.is_byte(i):
            key, side, prior = bytes([int(piece[3:5], 16)]), inner, prior_mass / ranked / 256
        else:
            prior = prior_mass / ranked / (10 - model.get_score(i))
            opens = piece.startswith(space)
            key, side = piece[opens:].encode(), start if opens else inner
            if space.encode() in key:
                continue
        side[key] = side.get(key, 0.0) + n + prior
    start.setdefault(b"", prior_mass / ranked)
    for b in range(256):
        inner.setdefault(bytes([b]), prior_mass / ranked / 256)
    stop = words + prior_mass
    a, b = sum(start.values()), sum(inner.values()) + stop
    return Lattice(_with_beginnings({k: math.log(v / a) for k, v in start.items()}),
                   _with_beginnings({k: math.log(v / b) for k, v in inner.items()}), math.log(stop / b))


def score_words(words: DataFrame, lattice, n_words: int, kinds: int, discount: float) -> DataFrame:
    """(word, c, lp): log10 probability of each distinct word among words: its own discounted
    count, plus the mass that the discounts leave times its probability in the lattice."""
    schema = pa.schema([("word", pa.binary()), ("c", pa.int64()), ("lp", pa.float64())])
    left = discount * kinds / n_words if n_words else 1.0

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        word = lattice.value.word
        for w, c in rows:
            yield w, c, mixed(c, word(w), n_words, left, discount) / LN10

    return words.select("word", "c").mapInArrow(per_row(run, schema, 16384), "word binary, c long, lp double")


def mixed(c: int, lattice: float, n_words: int, left: float, discount: float) -> float:
    """Natural log of a word's probability, from its count and its log probability in the
    lattice; both ways together are a distribution over all words."""
    if not c:
        return lattice + math.log(left)
    return math.log((c - discount) / n_words + left * exp(lattice))


def discount_of(once: int, twice: int) -> float:
    """Absolute discount from the numbers of words seen once and twice."""
    return once / (once + 2 * twice) if once and twice else 0.5


def score(docs: DataFrame, model_path: str, train: str = "train", id_col: str = "doc_id", text_col: str = "text",
          head_words: int = HEAD_WORDS) -> DataFrame:
    """Per row of ``docs`` (with a boolean column ``train``): id, train, n_tokens, n_known,
    train_tokens, base_score, score.  ``model_path`` is a path of the driver."""
    spark: SparkSession = docs.sparkSession
    with open(model_path, "rb") as f:
        raw = f.read()
    model = broadcast_bytes(spark, model_path, raw, len(raw), MAX_MODEL_BYTES)
    src = docs_of(docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(train), F.lit(False)).alias("train"),
                              F.col(text_col).alias("body")), "id", "train", text="body")
    words = materialize(count_words(src), "lm-words")
    seen = words.agg(F.sum("c").alias("n"), F.count_if(F.col("c") > 0).alias("v"), F.count_if(F.col("c") == 1).alias("once"),
                     F.count_if(F.col("c") == 2).alias("twice")).first()
    ends = src.where("train").count()
    n_words = seen["n"] or 0
    n, v = n_words + ends, seen["v"] + (1 if ends else 0)
    uses = {r["piece"]: r["n"] for r in count_pieces(words, model).collect()}   # a row for each piece at most
    grid = build_lattice(sentencepiece.SentencePieceProcessor(model_proto=raw), uses, n_words)
    lattice = broadcast_bytes(spark, "lattice", grid, 100 * (len(grid.initial) + len(grid.inner)), MAX_MODEL_BYTES)
    known = materialize(score_words(words, lattice, n_words, seen["v"], discount_of(seen["once"], seen["twice"])), "lm-scored")
    # the head: the most frequent words no longer than 64 bytes, at most head_words of them;
    # how frequent is read from a histogram (eight steps for each doubling of the count)
    short = known.where("c > 0 and octet_length(word) <= 64").withColumn("step", F.floor(8 * F.log2("c")))
    least, room = math.inf, head_words
    for r in short.groupBy("step").agg(F.count("*").alias("n"), F.min("c").alias("c")).orderBy(F.desc("step")).collect():
        room -= r["n"]
        if room < 0:
            break
        least = r["c"]
    top = short.where(F.col("c") >= least).select("word", "c", "lp").collect() if least < math.inf else []
    head = broadcast_bytes(spark, "head words", {bytes(r["word"]): (math.log10(r["c"] + 1), r["lp"]) for r in top},
                           200 * len(top), 200 * head_words)
    end_share = (ends + 1) / (n + 2)
    lp_end, lp_word = math.log10(end_share), math.log10(1 - end_share)
    end_c = math.log10(ends + 1)

    schema = pa.schema([("id", pa.string()), ("train", pa.bool_()), ("n_tokens", pa.int64()), ("known", pa.int64()),
                        ("logc", pa.float64()), ("lp", pa.float64()), ("tail", pa.list_(pa.struct([("word", pa.binary()), ("tf", pa.int32())])))])

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        get = head.value.get
        for key, tr, text in rows:
            total, hits, logc, lp, tail = 1, 0, 0.0, 0.0, []
            for w, tf in Counter(tokens(text)).items():
                total += tf
                got = get(w)
                if got is None:
                    tail.append((w, tf))
                else:
                    hits += tf
                    logc += tf * got[0]
                    lp += tf * got[1]
            yield key, tr, total, hits, logc, lp, [{"word": w, "tf": tf} for w, tf in tail]

    kind = docs.schema[id_col].dataType.simpleString()
    part = (src.selectExpr("cast(id as string) id", "train", "text")
            .mapInArrow(per_row(run, schema, 512), "id string, train boolean, n_tokens long, known long, logc double, lp double, "
                        "tail array<struct<word:binary,tf:int>>"))
    # written once: a row's key stays the same however often a task is run again
    part = materialize(part.withColumn("key", F.monotonically_increasing_id()), "lm-docs")
    rest = (part.select("key", F.explode("tail").alias("t")).select("key", "t.word", "t.tf").join(known, "word")
            .groupBy("key").agg(F.sum(F.when(F.col("c") > 0, F.col("tf")).otherwise(0)).alias("known2"),
                                F.sum(F.col("tf") * F.log10(F.col("c") + 1)).alias("logc2"),
                                F.sum(F.col("tf") * F.col("lp")).alias("lp2")))
    zero = F.lit(0.0)
    return (part.drop("tail").join(rest, "key", "left")
            .select(F.col("id").cast(kind).alias(id_col), "train", "n_tokens",
                    (F.col("known") + F.coalesce("known2", F.lit(0)) + F.lit(1 if ends else 0)).cast("long").alias("n_known"),
                    F.lit(n).cast("long").alias("train_tokens"),
                    (F.col("logc") + F.coalesce("logc2", zero) + end_c
                     - F.col("n_tokens") * math.log10(n + 1 * (v + 1))).alias("base_score"),
                    (F.col("lp") + F.coalesce("lp2", zero) + lp_end + (F.col("n_tokens") - 1) * lp_word).alias("score")))
