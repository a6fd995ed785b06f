"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text.

Folding lower-cases and maps homoglyphs and digit substitutions to the letters they stand
for.  The lexicon holds whole words and word beginnings whose share of toxic documents is
high among labelled rows; its weights are smoothed log odds.  All entries and the
exception phrases (a matched word with one neighbour that clean documents use) are found
in one pass of an automaton; a match inside an exception phrase does not count.  The
summed weight and the weight per word (length normalisation) give the score through a
fitted logistic curve.

Only the fit works on a bounded sample (``sample_rows`` labelled rows by a hash of the
id); every whole text is scored.

Defined results: null and empty texts have no matches and get the score of a text without
matches; without labelled rows of both classes the lexicon is empty and every score is 0;
repeated rows score alike; the score sees nothing but the text."""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import docs_of, materialize, materialize_counted, per_row

SAMPLE_ROWS = 20_000
#: What the fit keeps, at most: lexicon entries and exception phrases, the strongest ones.
MAX_ENTRIES = 4_000
MAX_EXCEPTIONS = 2_000
#: Words and phrases of more characters are no entries and no exceptions.
LONGEST_WORD, LONGEST_PHRASE = 40, 80

# Letters of other scripts that look like Latin ones, and digits and signs
# used in place of letters.
_HOMOGLYPHS = str.maketrans("авсԁеһіјкӏмпорԛѕтѵхуαοερτικνυ", "abcdehijklmnopqstvxyaoeptiknu")
_FOLD = str.maketrans({**{a: unicodedata.normalize("NFKC", chr(a)).lower() for a in range(0xFF01, 0xFF5F)}, **_HOMOGLYPHS,
                       **dict.fromkeys((0x200B, 0x200C, 0x200D, 0xFEFF, 0xAD))})
_ODD = re.compile("[" + "".join(map(chr, _FOLD)) + "]")
_SUBSTITUTES = bytes.maketrans(b"01345789@$", b"oieastbgas")
_WORDS = re.compile(r"[^\W_]+")


def fold(text: str) -> str:
    text = text.lower()
    if not text.isascii() and _ODD.search(text):
        text = text.translate(_FOLD)
    # no byte of a longer UTF-8 sequence is an ASCII byte
    return text.encode().translate(_SUBSTITUTES).decode()


@dataclass
class Lexicon:
    words: dict[str, float] = field(default_factory=dict)      # whole words
    beginnings: dict[str, float] = field(default_factory=dict)  # word beginnings
    exceptions: set[str] = field(default_factory=set)           # two folded words
    curve: tuple[float, float, float] = (-50.0, 0.0, 0.0)


class Matcher:
    """One automaton over words, beginnings and exception phrases."""

    def __init__(self, lex: Lexicon) -> None:
        self.lex, self.auto = lex, ahocorasick.Automaton()
        for k in {*lex.words, *lex.beginnings, *lex.exceptions}:
            self.auto.add_word(k, (len(k), lex.words.get(k), lex.beginnings.get(k), k in lex.exceptions))
        self.empty = not len(self.auto)
        if not self.empty:
            self.auto.make_automaton()

    def hits(self, text: str) -> dict[int, tuple[int, float]]:
        """start of a word -> (length, weight) of its strongest match outside exceptions."""
        found: dict[int, tuple[int, float]] = {}
        if self.empty:
            return found
        spans, n = [], len(text)
        for last, (size, word, begin, free) in self.auto.iter(text):
            i, j = last + 1 - size, last + 1
            if i and text[i - 1].isalnum():
                continue
            whole = j == n or not text[j].isalnum()
            w = max(x for x in (word if whole else None, begin, -math.inf) if x is not None)
            if w > found.get(i, (0, 0.0))[1]:
                found[i] = size, w
            if free and whole:
                spans.append((i, j))
        for i, j in spans:
            for k in [k for k in found if i <= k < j]:
                del found[k]
        return found

    def measure(self, text: str) -> tuple[float, int, int]:
        """summed weight, matches, words."""
        hits = self.hits(text)
        return sum(w for _, w in hits.values()), len(hits), text.count(" ") + text.count("\n") + 1

    def score(self, text: str) -> float:
        if self.empty:
            return 0.0
        weight, _, words = self.measure(text)
        a, b, c = self.lex.curve
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, a + b * math.log1p(weight) + c * math.log1p(100 * weight / words)))))


def _entry_counts(sample: DataFrame, shortest: int, longest: int) -> DataFrame:
    """Documents with each entry, toxic and clean; entry '=w': word, '^w': beginning."""
    schema = pa.schema([("entry", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())])

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        by: tuple[Counter, Counter] = Counter(), Counter()

        def flush():
            for k in by[0].keys() | by[1].keys():
                yield k, by[1][k], by[0][k]
            by[0].clear(), by[1].clear()

        for label, text in rows:
            words = set(_WORDS.findall(fold(text.decode("utf-8", "replace"))))
            got = {"=" + w for w in words if len(w) <= LONGEST_WORD}
            for n in range(shortest, longest + 1):
                got |= {"^" + w[:n] for w in words if len(w) > n}
            by[1 if label else 0].update(got)
            if len(by[0]) + len(by[1]) > 500_000:
                yield from flush()
        yield from flush()

    return (sample.select("label", "text").mapInArrow(per_row(run, schema), "entry string, toxic long, clean long")
            .groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))


def _hits(sample: DataFrame, lex: Lexicon):
    """Per document: label, weight, words, and the folded phrases around its matches."""
    schema = pa.schema([("label", pa.int32()), ("weight", pa.float64()), ("words", pa.int64()),
                        ("phrases", pa.list_(pa.string()))])

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        m = Matcher(lex)
        for label, raw in rows:
            text = fold(raw.decode("utf-8", "replace"))
            weight, n, words = m.measure(text)
            phrases: set[str] = set()
            for i in m.hits(text) if n else ():
                around = [x for x in _WORDS.finditer(text, max(0, i - 60), i + 120)]
                at = next((k for k, x in enumerate(around) if x.start() == i), None)
                if at is not None:
                    for a, b in ((at - 1, at), (at, at + 1)):
                        if a >= 0 and b < len(around):
                            phrases.add(text[around[a].start():around[b].end()])
            yield label, weight, words, sorted(x for x in phrases if len(x) <= LONGEST_PHRASE)

    return sample.select("label", "text").mapInArrow(per_row(run, schema, 512), "label int, weight double, words long, phrases array<string>")


def _curve(weight: np.ndarray, words: np.ndarray, label: np.ndarray) -> tuple[float, float, float]:
    """Ridge logistic regression by Newton steps."""
    x = np.stack([np.ones(len(weight)), np.log1p(weight), np.log1p(100 * weight / words)], 1)
    b, ridge = np.zeros(3), np.array([1e-6, 0.05, 0.05])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -40, 40)))
        grad = x.T @ (label - p) - ridge * b
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge + 1e-9), grad)
        b = b + np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-6:
            break
    return tuple(float(v) for v in b)


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          sample_rows: int = SAMPLE_ROWS, shortest: int = 4, longest: int = 8, min_docs: int = 5, min_share: float = 0.8,
          exceptions: frozenset[str] = frozenset()) -> Lexicon:
    """Fit lexicon, exceptions and curve on at most ``sample_rows`` labelled rows; rows with
    equal id and text count once.  The lexicon has the ``MAX_ENTRIES`` strongest words and
    word beginnings of that sample, words up to ``LONGEST_WORD`` characters, and the
    ``MAX_EXCEPTIONS`` most frequent harmless phrases up to ``LONGEST_PHRASE``."""
    some = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
            .select(F.col(id_col).alias("_id"), (F.col(label_col) > 0).cast("int").alias("label"))
            .orderBy(F.xxhash64("_id"), "_id", "label").limit(sample_rows))
    texts = docs_of(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_body")), "_id", text="_body")
    # at most sample_rows ids and labels: bounded by the parameter
    sample, n = materialize_counted(texts.join(F.broadcast(some), "_id").select("_id", "label", "text").distinct(), "toxic")
    if n > sample_rows:     # a sampled id may have many texts
        keyed = sample.withColumn("_key", F.xxhash64("_id", "text"))
        few = keyed.select("_key", "_id", "label").orderBy("_key", "_id", "label").limit(sample_rows)
        sample = materialize(keyed.join(F.broadcast(few), ["_key", "_id", "label"], "left_semi"), "toxic-few")
    sample = sample.select("label", "text")
    total = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    lex = Lexicon(exceptions=set(map(fold, exceptions)))
    if len(total) < 2:
        return lex
    odds = F.log((F.col("toxic") + 0.5) / (total[1] + 1)) - F.log((F.col("clean") + 0.5) / (total[0] + 1))
    prior = total[1] / (total[0] + total[1])
    good = (_entry_counts(sample, shortest, longest)
            .where((F.col("toxic") >= min_docs) & (F.col("toxic") / (F.col("toxic") + F.col("clean")) >= max(min_share, 2 * prior)))
            .withColumn("odds", odds).orderBy(F.desc(F.col("odds") * F.sqrt("toxic")), "entry").limit(MAX_ENTRIES))
    chosen = {r["entry"]: r["odds"] for r in good.collect()}
    for k, w in chosen.items():
        # a beginning already covered by a shorter one that is as strong adds nothing
        if not any("^" + k[1:n] in chosen and chosen["^" + k[1:n]] >= w for n in range(shortest + 1, len(k))):
            (lex.words if k[0] == "=" else lex.beginnings)[k[1:]] = w
    seen = (_hits(sample, lex).select("label", F.explode("phrases").alias("p")).groupBy("p")
            .agg(F.sum("label").alias("toxic"), F.count("*").alias("n"))
            .where((F.col("n") >= min_docs) & (F.col("toxic") * 10 <= F.col("n")))
            .orderBy(F.desc("n"), "p").limit(MAX_EXCEPTIONS).collect())
    lex.exceptions |= {r["p"] for r in seen}
    rows = _hits(sample, lex).select("label", "weight", "words").toPandas()
    lex.curve = _curve(rows["weight"].to_numpy(float), rows["words"].to_numpy(float), rows["label"].to_numpy(float))
    return lex


def score(docs: DataFrame, lex: Lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, matches) for every whole text."""
    schema = pa.schema([("id", pa.string()), ("score", pa.float64()), ("matches", pa.int64())])

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        m = Matcher(lex)
        for key, raw in rows:
            text = fold(raw.decode("utf-8", "replace"))
            yield key, m.score(text), m.measure(text)[1]

    kind = docs.schema[id_col].dataType.simpleString()
    src = docs_of(docs, id_col, text=text_col).selectExpr(f"cast(`{id_col}` as string) id", "text")
    return (src.mapInArrow(per_row(run, schema), "id string, score double, matches long")
            .selectExpr(f"cast(id as {kind}) as `{id_col}`", "score", "matches"))
