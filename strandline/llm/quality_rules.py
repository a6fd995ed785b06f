"""Quality rules: a decision list learned by sequential covering.

Statistics of every whole text are computed in one pass.  From labelled rows, rules for
the low-quality class are grown one after another: a rule is a conjunction of threshold
tests, each chosen by information gain on the growing part, then cut back from its end on
the pruning part; rows that a rule covers leave before the next is grown.  The list is
emitted as ordered Spark conditional expressions, so applying it is a plain projection.

Only the fit works on a bounded sample (``sample_rows`` labelled rows, chosen by a hash of
the id); statistics and verdicts cover every row.

Defined results: a null or empty text has zero in every statistic; without labelled rows
of both classes the list is empty and every row gets the default verdict (keep);
repeated rows are judged alike; the caller's columns are passed through whatever their
names."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

SAMPLE_ROWS = 20_000
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_upper_words", "n_exclaim", "n_distinct_words")
#: Shares over the counts: what the rules may test.
SHARES = {"symbol_share": ("n_symbols", "n_words"), "dup_line_share": ("n_dup_lines", "n_lines"),
          "repeat_share": ("n_repeat_words", "n_words"), "upper_share": ("n_upper_words", "n_words"),
          "exclaim_share": ("n_exclaim", "n_words"), "distinct_share": ("n_distinct_words", "n_words"),
          "mean_word": ("word_chars", "n_words")}
_SPACE, _SYMBOLS = b" \t\n\x0b\x0c\r", b"#*$%&|<>"


def text_counts(text: bytes) -> tuple[int, ...]:
    """The ``COUNTS`` of one text in UTF-8."""
    words = text.split()
    n = len(words)
    chars = len(text.decode("utf-8", "replace")) - sum(map(text.count, (bytes((b,)) for b in _SPACE)))
    symbols = sum(map(text.count, (bytes((b,)) for b in _SYMBOLS)))
    lines = [x for x in text.split(b"\n") if x.strip()]
    repeat = 0
    if n > 3:
        windows = list(zip(words, words[1:], words[2:]))
        if len(set(windows)) < len(windows):
            seen, upto = Counter(windows), 0
            for i, w in enumerate(windows):
                if seen[w] > 1:
                    repeat += i + 3 - max(i, upto)
                    upto = i + 3
    upper = sum(map(bytes.isupper, words))
    return (n, chars, symbols, len(lines) - len(set(lines)), repeat, len(lines), upper,
            text.count(b"!"), len(set(words)))


def with_counts(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with one struct column of counts, and that column's name (free in docs)."""
    name = "_stats"
    while name.lower() in {c.lower() for c in docs.columns}:
        name = "_" + name
    at = docs.columns.index(text_col)
    kind = pa.struct([(c, pa.int64()) for c in COUNTS])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            texts = b.column(at).cast(pa.binary()).to_pylist()
            rows = [text_counts(t or b"") for t in texts]
            stats = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * len(COUNTS))],
                                               fields=list(kind))
            yield pa.RecordBatch.from_arrays([*b.columns, stats], names=[*b.schema.names, name])

    counts = StructType([StructField(c, LongType()) for c in COUNTS])
    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, counts)])), name


def measures(stats: str) -> dict[str, Column]:
    """What rules test, as columns over the struct column ``stats``."""
    out = {"n_words": F.col(f"{stats}.n_words").cast("double")}
    for k, (a, b) in SHARES.items():
        out[k] = F.col(f"{stats}.{a}") / F.greatest(F.col(f"{stats}.{b}"), F.lit(1))
    return out


@dataclass(frozen=True)
class Test:
    measure: str
    at_least: bool
    bound: float

    def column(self, by: dict[str, Column]) -> Column:
        return by[self.measure] >= self.bound if self.at_least else by[self.measure] <= self.bound


@dataclass
class DecisionList:
    """Ordered rules; a row that none covers is kept."""

    rules: list[list[Test]] = field(default_factory=list)

    def matched(self, by: dict[str, Column]) -> Column:
        """The number of the first rule that covers a row, from 1; 0: none."""
        out = None
        for i, tests in enumerate(self.rules, 1):
            hit = F.lit(True)
            for t in tests:
                hit = hit & t.column(by)
            out = F.when(hit, i) if out is None else out.when(hit, i)
        return F.lit(0) if out is None else out.otherwise(0)

    def __str__(self) -> str:
        return "; ".join(" and ".join(f"{t.measure} {'>=' if t.at_least else '<='} {t.bound:.4g}" for t in r) for r in self.rules)


def _covered(x: np.ndarray, names: list[str], tests: list[Test]) -> np.ndarray:
    hit = np.ones(len(x), bool)
    for t in tests:
        v = x[:, names.index(t.measure)]
        hit &= v >= t.bound if t.at_least else v <= t.bound
    return hit


def _grow(x: np.ndarray, low: np.ndarray, names: list[str], bins: int, max_tests: int) -> list[Test]:
    tests, here = [], np.ones(len(x), bool)
    while (here & ~low).any() and len(tests) < max_tests:
        p, n = (here & low).sum(), (here & ~low).sum()
        start, best = np.log2(p / (p + n)), (1e-9, None)
        for k, name in enumerate(names):
            v = x[here, k]
            y = low[here]
            for bound in np.unique(np.quantile(x[here & low, k], np.linspace(0, 1, bins))):
                for up in (True, False):
                    hit = v >= bound if up else v <= bound
                    p1 = (hit & y).sum()
                    if p1:
                        gain = p1 * (np.log2(p1 / hit.sum()) - start)
                        if gain > best[0]:
                            best = gain, Test(name, up, float(bound))
        if best[1] is None:
            break
        tests.append(best[1])
        here &= _covered(x, names, [best[1]])
    return tests


def _prune(tests: list[Test], x: np.ndarray, low: np.ndarray, names: list[str]) -> list[Test]:
    def worth(part: list[Test]) -> float:
        hit = _covered(x, names, part)
        p, n = (hit & low).sum(), (hit & ~low).sum()
        return (p - 2 * n) / (p + n + 1)
    return max((tests[:k] for k in range(len(tests), 0, -1)), key=worth)


def cover(x: np.ndarray, low: np.ndarray, names: list[str], max_rules: int = 12, max_tests: int = 4, bins: int = 24,
          min_precision: float = 0.95, min_support: float = 0.005, seed: int = 7) -> DecisionList:
    """Sequential covering of the rows marked ``low``; a rule needs ``min_precision`` and
    the share ``min_support`` of the low rows, both over growing and pruning part."""
    out = DecisionList()
    if not low.any() or low.all():
        return out
    least = max(3, min_support * low.sum())
    rng = np.random.default_rng(seed)
    while low.any() and len(out.rules) < max_rules:
        part = rng.random(len(x)) < 2 / 3
        if not (part & low).any():
            break
        tests = _grow(x[part], low[part], names, bins, max_tests)
        if not tests:
            break
        tests = _prune(tests, x[~part], low[~part], names)
        hit = _covered(x, names, tests)
        if (hit & low).sum() < least or (hit & low).sum() < min_precision * hit.sum():
            break
        out.rules.append(tests)
        x, low = x[~hit], low[~hit]
    return out


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          sample_rows: int = SAMPLE_ROWS, **how) -> DecisionList:
    """Fit on at most ``sample_rows`` labelled rows (label 0: low, 1: good)."""
    some = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
            .select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label"))
            .orderBy(F.xxhash64("_id"), "_id", "_label").limit(sample_rows))
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    # at most sample_rows ids and labels: bounded by the parameter
    joined, stats = with_counts(texts.join(F.broadcast(some), "_id"), "_text")
    by = measures(stats)
    # ids may repeat in either table, so the bound is taken again on the joined rows
    rows = (joined.select("_id", "_label", *(c.alias(k) for k, c in by.items()))
            .orderBy(F.xxhash64("_id"), "_id", *by).limit(2 * sample_rows).toPandas())
    names = list(by)
    return cover(rows[names].to_numpy(float).reshape(-1, len(names)), rows["_label"].to_numpy() == 0, names, **how)


def base_failed(stats: str) -> Column:
    s = F.col(stats)
    return (s["n_words"] < 50) | (100 * s["n_repeat_words"] > 50 * s["n_words"])


def judge(docs: DataFrame, rules: DecisionList, text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with the struct of counts, extended by base_failed, rule and kept."""
    out, stats = with_counts(docs, text_col)
    rule, failed = rules.matched(measures(stats)), base_failed(stats)
    return out.withColumn(stats, F.col(stats).withField("base_failed", failed).withField("rule", rule)
                          .withField("kept", ~failed & (rule == 0))), stats


def keep_good(docs: DataFrame, labels: DataFrame, text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` that the base rule and the learned list keep, columns as given."""
    out, stats = judge(docs, learn(docs, labels, text_col=text_col, **how), text_col)
    return out.where(F.col(stats)["kept"]).drop(stats)
