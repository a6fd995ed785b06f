"""URL filters: fixed host and path rules, then association rules mined from labels.

URLs become sets of tokens (host labels, path segments, file ending, query keys).  Spark's
FP-growth mines token combinations over the labelled URLs; rules that lead to the bad
label are kept if they reach support and confidence, no smaller rule is as sure, and labels
dealt at random would not give them.  The kept rules form an inverted index from token to
rules; a URL meets only the rules of its own tokens, and a rule fires when all its tokens
were met.  The index is broadcast within ``RULE_BYTES`` and a joined table beyond.

Defined results: a null URL or one without ``://`` has an empty host and path, no tokens
and the default verdict (allow); without labelled URLs of both kinds no rule is mined;
repeated rows are judged alike; among fixed rules that fit, the longest wins."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import materialize, per_row
from strandline.session import materialize_measured

RULE_BYTES = 32 << 20
MIN_PAGES = 20
#: The probability that labels dealt at random give any rule.
CHANCE = 0.01
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BAD = "label=bad"


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host(url: Column) -> Column:
    raw = F.regexp_extract(F.coalesce(_rest(url), F.lit("")), "^[^/?#]*", 0)
    return F.translate(raw, _UPPER, _LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(_rest(url), F.lit("")), "^[^/?#]*([^?#]*)", 1)


def tokens(url: Column) -> Column:
    """The URL's distinct tokens; numbers are one token per place."""
    h, p = host(url), path(url)
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1)
    labels = F.transform(F.filter(F.split(h, r"\."), lambda x: x != ""), lambda x: F.concat(F.lit("h:"), x))
    parts = F.transform(F.filter(F.split(p, "/"), lambda x: x != ""),
                        lambda x: F.concat(F.lit("p:"), F.regexp_replace(x, "[0-9]+", "0")))
    keys = F.transform(F.filter(F.split(query, "&"), lambda x: x != ""),
                       lambda x: F.concat(F.lit("q:"), F.substring_index(x, "=", 1)))
    return F.array_distinct(F.concat(labels, parts, keys))


@dataclass(frozen=True)
class FixedRule:
    """``verdict`` for a host with its subdomains, where the path starts with ``path``."""

    verdict: str
    rule: str           # host and path as written, such as "example.com/en/"

    def fits(self, h: Column, p: Column) -> Column:
        name, slash, rest = self.rule.partition("/")
        return ((h == name) | h.endswith("." + name)) & p.startswith(slash + rest)


def fixed(rules: list[FixedRule], h: Column, p: Column) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fixed rule that fits, else nulls."""
    rule = verdict = None
    for r in sorted(rules, key=lambda r: (-len(r.rule), r.rule)):
        fit = r.fits(h, p)
        rule = F.when(fit, r.rule) if rule is None else rule.when(fit, r.rule)
        verdict = F.when(fit, r.verdict) if verdict is None else verdict.when(fit, r.verdict)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


@dataclass
class MinedRules:
    """Token sets that block, as an inverted index."""

    rules: list[tuple[frozenset[str], float]] = field(default_factory=list)
    #: The rules (items, confidence) as a written table, if they are too large to broadcast.
    table: DataFrame | None = None

    def index(self) -> tuple[dict[str, list[int]], list[int]]:
        by: dict[str, list[int]] = defaultdict(list)
        for k, (items, _) in enumerate(self.rules):
            for t in items:
                by[t].append(k)
        return dict(by), [len(items) for items, _ in self.rules]


def mine(labelled: DataFrame, url_col: str = "url", bad_col: str = "bad", min_confidence: float = 0.6, min_lift: float = 1.5,
         min_pages: int = MIN_PAGES, chance: float = CHANCE, rule_bytes: int = RULE_BYTES) -> MinedRules:
    """Mine rules from rows with a URL and a boolean label.  A rule rests on at least
    ``min_pages`` bad pages, however many pages there are, and is kept only if labels dealt
    at random would give any of the mined combinations such a share of bad pages with a
    probability under ``chance`` (Chernoff's bound on the binomial tail, times the number
    of combinations)."""
    rows = (labelled.where(F.col(url_col).isNotNull() & F.col(bad_col).isNotNull())
            .select(tokens(F.col(url_col)).alias("t"), F.col(bad_col).alias("bad")))
    # written with a row number, which joins a page's tokens again
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "url-rows")
    n = rows.agg(F.count("*").alias("n"), F.count_if("bad").alias("bad")).first()
    if not n["bad"] or n["bad"] == n["n"]:
        return MinedRules()
    base = n["bad"] / n["n"]
    # a token on fewer bad pages is in no rule
    often = rows.where("bad").select(F.explode("t").alias("token")).groupBy("token").agg(F.count("*").alias("k")).where(F.col("k") >= min_pages).select("token")
    left = (rows.select("row", "bad", F.explode("t").alias("token")).join(materialize(often, "url-tokens"), "token")
            .groupBy("row", "bad").agg(F.collect_list("token").alias("t")))
    items = left.select(F.when(F.col("bad"), F.concat("t", F.array(F.lit(BAD)))).otherwise(F.col("t")).alias("items"))
    seen = left.count()
    if not seen:
        return MinedRules()
    model = FPGrowth(itemsCol="items", minSupport=(min_pages - 0.5) / seen).fit(items)
    sets = materialize(model.freqItemsets.select(F.array_sort(F.array_remove("items", BAD)).alias("items"),
                                                 F.array_contains("items", BAD).alias("bad"), "freq"), "url-sets")
    both = sets.where("bad and size(items) > 0").select("items", F.col("freq").alias("hits"))
    every = materialize(both.join(sets.where("not bad"), "items").select("items", (F.col("hits") / F.col("freq")).alias("confidence"), F.col("freq").alias("pages")), "url-rules")
    sure = every.where(F.col("confidence") >= max(min_confidence, min_lift * base)).where(_beyond_chance(base, every.count(), chance))
    kept = _smallest(every.select("items", "confidence")).join(sure.select("items"), "items", "left_semi")
    kept, size = materialize_measured(kept, "url-kept")
    if size > rule_bytes:
        return MinedRules(table=kept)
    return MinedRules([(frozenset(r["items"]), r["confidence"]) for r in
                       sorted(kept.collect(), key=lambda r: (len(r["items"]), -r["confidence"], r["items"]))])


def _beyond_chance(base: float, tried: int, chance: float) -> Column:
    """pages * KL(confidence || base) >= ln(tried / chance)."""
    c = F.col("confidence")
    rest = F.when(c < 1, (1 - c) * F.log((1 - c) / (1 - base))).otherwise(0.0)
    return F.col("pages") * (c * F.log(c / base) + rest) >= math.log(max(1, tried) / chance)


def _smallest(rules: DataFrame) -> DataFrame:
    """The rules (items, confidence) without those of which a smaller rule is as sure, by
    size: a rule meets the best of all its subsets in those with one token less, which are
    all there, as they are at least as frequent."""
    sizes = rules.agg(F.max(F.size("items")).alias("n")).first()["n"] or 0
    level = rules.where(F.size("items") == 1).withColumn("best", F.col("confidence"))
    out = level
    for k in range(2, sizes + 1):
        here = rules.where(F.size("items") == k)
        less = here.select("items", F.explode("items").alias("x")).select("items", F.array_remove("items", F.col("x")).alias("sub"))
        under = (less.join(level.select(F.col("items").alias("sub"), "best"), "sub").groupBy("items").agg(F.max("best").alias("under")))
        level = materialize(here.join(under, "items").select("items", "confidence", F.greatest("confidence", "under").alias("best"),
                                                             (F.col("under") >= F.col("confidence")).alias("covered")), "url-level")
        out = out.unionByName(level.where("not covered").drop("covered"))
    return out.select("items", "confidence")


def judge(pages: DataFrame, mined: MinedRules, rules: list[FixedRule], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Per row: id, host, path, rule, verdict, and the sureness of the mined rule that fired."""
    schema = pa.schema([("id", pa.string()), ("host", pa.string()), ("path", pa.string()), ("rule", pa.string()),
                        ("verdict", pa.string()), ("sure", pa.float64())])
    by, sizes = mined.index()
    sure = [c for _, c in mined.rules]

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for key, h, p, rule, verdict, toks in rows:
            best = None
            if by:
                met: dict[int, int] = defaultdict(int)
                for t in toks or ():
                    for k in by.get(t, ()):
                        met[k] += 1
                best = max((sure[k] for k, n in met.items() if n == sizes[k]), default=None)
            yield key, h, p, rule, verdict or ("allow" if best is None else "block"), best

    u = F.col(url_col)
    h, p = host(u), path(u)
    rule, verdict = fixed(rules, h, p)
    if mined.table is not None:
        return _judge_by_join(pages, mined.table, h, p, rule, verdict, id_col, url_col)
    kind = pages.schema[id_col].dataType.simpleString()
    src = pages.select(F.col(id_col).cast("string").alias("id"), h.alias("host"), p.alias("path"), rule.alias("rule"),
                       verdict.alias("verdict"), tokens(u).alias("t"))
    return (src.mapInArrow(per_row(run, schema), "id string, host string, path string, rule string, verdict string, sure double")
            .select(F.col("id").cast(kind).alias(id_col), "host", "path", "rule", "verdict", "sure"))


def _judge_by_join(pages: DataFrame, rules: DataFrame, h: Column, p: Column, rule: Column, verdict: Column, id_col: str, url_col: str) -> DataFrame:
    """:func:`judge` with the inverted index as a table: a page's tokens meet the rules'
    tokens by an equi-join, and a rule fires where it was met as often as it has tokens."""
    index = rules.select(F.xxhash64("items").alias("k"), F.concat_ws(" ", "items").alias("name"), F.size("items").alias("size"),
                         "confidence", F.explode("items").alias("token"))
    src = materialize(pages.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), h.alias("host"), p.alias("path"),
                                   rule.alias("rule"), verdict.alias("verdict"), tokens(F.col(url_col)).alias("t")), "url-pages")
    met = (src.select("row", F.explode("t").alias("token")).join(materialize(index, "url-index"), "token")
           .groupBy("row", "k", "name", "size", "confidence").agg(F.count("*").alias("n")).where("n = size"))
    best = met.groupBy("row").agg(F.max("confidence").alias("sure"))
    return (src.join(best, "row", "left")
            .select(F.col("id").alias(id_col), "host", "path", "rule",
                    F.coalesce("verdict", F.when(F.col("sure").isNull(), "allow").otherwise("block")).alias("verdict"), "sure"))
