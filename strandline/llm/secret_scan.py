"""Secret scan: candidate strings judged by a random forest, in DataFrame and SQL functions
and Spark's own estimators only.

Candidates are the values behind a credential's name (``password = x``, ``"api_key": "x"``,
``Bearer x``), whatever their length and alphabet, keys of public formats, and other runs of
at least ``SHORTEST`` letters, digits and + / _ - with a digit in them.  Values in quotes
end at the quote, if there is one on their line; others end at a space, a
quote or & and without closing punctuation.  Each finding is described by its length, its character classes and the transitions
between them, the share of it that corpus words cover (dictionary), its path (the source)
and its neighbouring words; a random forest trained on labelled findings removes the false
positives.

The dictionary holds the most frequent words of the whole corpus; only its size is
bounded (``DICTIONARY`` words), as is the sample of labelled findings the forest sees.
Every whole text is scanned.

Defined results: null and empty texts have no findings; without labelled findings of both
kinds every finding gets probability 1 (nothing is removed); repeated rows give repeated
findings; a null path is the empty one; extra columns stay out."""

from __future__ import annotations

import re

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import materialize

SHORTEST = 12
DICTIONARY = 400
SAMPLE_ROWS = 20_000
WORD_BUCKETS = 32
_BODY = "A-Za-z0-9+/_\\-"
# Control characters that mark a candidate's two ends while a text is cut.
_OPEN, _CLOSE = "\x01", "\x02"
_NAMES = ("(?:pass(?:word|wd|phrase)|pwd|secret|token|credentials?|api[ _-]?key|"
          "(?:access|secret|private|auth|account|signing|encryption)[_-]?key)")
_GIVEN = "[\"']?[ \\t]{0,8}(?:=>|:=|={1,3}|:(?!//))"
# What stands before a value: a name and its sign, or an authorization scheme.
_NAMED = (f"(?i:{_NAMES}{_GIVEN}[ \\t]{{0,8}}(?:bearer[ \\t]{{1,8}})?|authorization{_GIVEN}[ \\t]{{0,8}}[\"']?(?:bearer|basic|token)[ \\t]{{1,8}}|"
          "\\bbearer[ \\t]{1,8}(?=\\S{8})(?=[^\\s0-9]{0,200}[0-9]))")
_VALUES = ("(?:(\")([^\"\\s]++|[^\"\n]++)(?=\")|(')([^'\\s]++|[^'\n]++)(?=')|([\"']?)"
           "([^\\s\"'&][^\\s\"'&]*(?<![.,;:?)\\]}>])))")
# Public formats of providers' keys.
_FORMATS = ("(?:AKIA|ASIA)[A-Z0-9]{16}", "gh[pousr]_[A-Za-z0-9]{36}", "github_pat_[A-Za-z0-9_]{22,}+", "xox[abeprs]-[0-9A-Za-z-]{10,}+",
            "(?:sk|rk)_(?:live|test)_[0-9A-Za-z]{16,}+", "whsec_[0-9A-Za-z+/]{24,}+={0,2}", "AIza[0-9A-Za-z_-]{35}",
            "GOCSPX-[0-9A-Za-z_-]{28}", "ya29\\.[0-9A-Za-z_-]{20,}+", "gl(?:pat|ptt|dt|rt)-[0-9A-Za-z_-]{20,}+", "npm_[A-Za-z0-9]{36}",
            "hf_[A-Za-z0-9]{34}", "sk-[A-Za-z0-9_-]{20,}+", "dop_v1_[0-9a-f]{64}", "SG\\.[0-9A-Za-z_-]{22}\\.[0-9A-Za-z_-]{43}",
            "eyJ[0-9A-Za-z_-]{10,}+\\.eyJ[0-9A-Za-z_-]{10,}+\\.[0-9A-Za-z_-]{10,}+")
_FORMAT = f"(?:{'|'.join(_FORMATS)})"
# A run that ends in a credential's name is left to the value behind it.
_RUN = f"(?=[A-Za-z+/_\\-]*+[0-9])[{_BODY}]{{{SHORTEST},}}+(?!(?<=(?i:{_NAMES})){_GIVEN})={{0,2}}"
_CANDIDATE = f"({_NAMED}){_VALUES}|(?<![{_BODY}])({_FORMAT}(?![{_BODY}])|{_RUN})"
_MARKED = f"$1$2$4$6{_OPEN}$3$5$7$8{_CLOSE}"
_MAYBE = f"[0-9]|(?i:{_NAMES}|authorization)|AKIA|ASIA|gh[pousr]_|hf_|npm_|eyJ|AIza|sk-|[sr]k_|whsec_|xox|gl[a-z]{{2,3}}-|GOCSPX|SG\\."
# Words and numbers joined by + / _ -, or numbers only: no key.
_PLAIN_PART = "(?:[A-Z]?[a-z]{0,20}|[A-Z]{1,20})[0-9]{0,4}|[0-9]++"
_PLAIN = f"^(?:{_PLAIN_PART})(?:[+/_\\-](?:{_PLAIN_PART}))*+=?$"
_CLASSES = ("".join(map(chr, range(65, 91))) + "".join(map(chr, range(97, 123))) + "0123456789+/_-=",
            "U" * 26 + "l" * 26 + "d" * 10 + "p" * 5)
NUMERIC = ("length", "digit_share", "upper_share", "lower_share", "punct_share", "transition_share", "hex_only", "digit_only",
           "dictionary_share", "assigned", "quoted", "path_bucket")


def findings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """(doc_id, path, start, candidate, before, after); ``start`` counts characters from 0,
    ``before`` and ``after`` are up to 60 characters beside the candidate."""
    text = F.translate(F.coalesce(F.col(text_col).cast("string"), F.lit("")), _OPEN + _CLOSE, "  ")
    src = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(path_col).cast("string"), F.lit("")).alias("path"), text.alias("t"))
    cut = (src.where(F.col("t").rlike(_MAYBE))
           .withColumn("parts", F.split(F.regexp_replace("t", _CANDIDATE, _MARKED), _OPEN))
           .where(F.size("parts") > 1)
           .select("doc_id", "path", "parts", F.aggregate(
               F.slice("parts", F.lit(1), F.size("parts") - 1), F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("ends")),
               lambda a, x: F.struct((a["at"] + F.length(F.translate(x, _CLOSE, ""))).alias("at"),
                                     F.concat(a["ends"], F.array(a["at"] + F.length(F.translate(x, _CLOSE, "")))).alias("ends"))
           )["ends"].alias("ends")))
    one = cut.select("doc_id", "path", "parts", "ends", F.explode(F.sequence(F.lit(1), F.size("parts") - 1)).alias("i"))
    part, prior = F.get("parts", F.col("i")), F.get("parts", F.col("i") - 1)
    return one.select("doc_id", "path", F.get("ends", F.col("i") - 1).alias("start"),
                      F.substring_index(part, _CLOSE, 1).alias("candidate"),
                      F.right(F.translate(prior, _CLOSE, ""), F.lit(60)).alias("before"),
                      F.left(F.substring_index(part, _CLOSE, -1), F.lit(60)).alias("after"))


def dictionary(docs: DataFrame, text_col: str = "text", size: int = DICTIONARY, shortest: int = 3) -> list[str]:
    """The most frequent lower-case words of a-z over all texts."""
    words = (docs.select(F.explode(F.split(F.lower(F.col(text_col).cast("string")), r"[^a-z]+")).alias("w"))
             .where(F.length("w") >= shortest).groupBy("w").count()
             .orderBy(F.desc("count"), "w").limit(size).collect())
    return sorted((r["w"] for r in words if len(r["w"]) <= 24), key=lambda w: (-len(w), w))


def _share(x: Column, n: Column) -> Column:
    return x / F.greatest(n, F.lit(1))


def _words(x: Column) -> Column:
    return F.filter(F.split(F.lower(x), "[^a-z]+"), lambda w: w != "")


def described(found: DataFrame, words: list[str]) -> DataFrame:
    """``found`` with the numeric measures and the neighbouring words."""
    c = F.col("candidate")
    kinds, n = F.translate(c, *_CLASSES), F.length("candidate")
    count = lambda k: n - F.length(F.translate(kinds, k, ""))
    runs = F.length(F.regexp_replace(kinds, r"(.)\1++", "$1"))
    known = n - F.length(F.regexp_replace(F.lower(c), "|".join(map(re.escape, words)), "")) if words else F.lit(0)
    flag = lambda x: x.cast("double")
    return found.select(
        "*", n.cast("double").alias("length"), _share(count("d"), n).alias("digit_share"), _share(count("U"), n).alias("upper_share"),
        _share(count("l"), n).alias("lower_share"), _share(count("p"), n).alias("punct_share"),
        _share(runs - 1, n).alias("transition_share"), flag(c.rlike("^[0-9a-f]+$")).alias("hex_only"),
        flag(c.rlike("^[0-9]+$")).alias("digit_only"), _share(known, n).alias("dictionary_share"),
        flag(F.col("before").rlike("[=:]\\s*[\"']?$")).alias("assigned"), flag(F.col("before").rlike("[\"']$")).alias("quoted"),
        F.pmod(F.xxhash64("path"), F.lit(64)).cast("double").alias("path_bucket"),
        # the two words before and the one after
        F.concat(F.slice(F.reverse(_words(F.col("before"))), 1, 2), F.slice(_words(F.col("after")), 1, 1)).alias("neighbours"))


def distant_label(before: Column, candidate: Column) -> Column:
    """1 where the text itself names a credential or the key has a provider's fixed format,
    0 for bare numbers and words joined with numbers; null for what is neither (other runs,
    and a plain word behind a name and a colon, which may be prose); fixed formats
    are public ones."""
    named = before.rlike(f"(?:{_NAMED}|(?i:{_NAMES})[\"']?\\s*[=:]\\s*)[\"']?$") | before.rlike("(?i)\\bbearer[ \\t]{1,8}$")
    word = candidate.rlike("^[A-Z]?[a-z]{1,20}$") & before.rlike(":[ \\t]*$")
    keyed = candidate.rlike(f"^{_FORMAT}$")
    return F.when(keyed | (named & ~word), 1.0).when(~named & candidate.rlike(_PLAIN), 0.0)


def measures() -> list[Column]:
    """What the forest sees, in its order: the numeric measures and a flag for each bucket
    of neighbouring words."""
    buckets = F.transform("neighbours", lambda w: F.pmod(F.xxhash64(w), F.lit(WORD_BUCKETS)))
    return [F.col(c) for c in NUMERIC] + [F.array_contains(buckets, F.lit(b).cast("long")).cast("double") for b in range(WORD_BUCKETS)]


def train(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS, trees: int = 24, depth: int = 6, seed: int = 11) -> list[Column] | None:
    """Fit the forest on at most ``sample_rows`` described findings with a column label and
    return its trees as column expressions; None without findings of both kinds."""
    cols = [m.alias(f"_{i}") for i, m in enumerate(measures())]
    names = [f"_{i}" for i in range(len(cols))]
    some = materialize(labelled.where(F.col("label").isNotNull()).select("label", *cols)
                       .orderBy(F.xxhash64(*names), *names, "label").limit(sample_rows), "secrets-sample")
    if some.select("label").distinct().count() < 2:
        return None
    some = VectorAssembler(inputCols=names, outputCol="features").transform(some)
    forest = RandomForestClassifier(labelCol="label", numTrees=trees, maxDepth=depth, seed=seed).fit(some)
    return [_tree([x.strip() for x in t.splitlines() if x.strip()], measures()) for t in re.split(r"\n\s*Tree \d+ .*:", forest.toDebugString)[1:]]


def _tree(lines: list[str], of: list[Column]) -> Column:
    """The vote of a tree, from the lines of its printed form."""
    at = iter(lines)

    def node() -> Column:
        line = next(at)
        if line.startswith("Predict:"):
            return F.lit(float(line.split(":")[1]))
        i, bound = re.fullmatch(r"If \(feature (\d+) <= (\S+)\)", line).groups()
        low = node()
        next(at)        # the line of the other branch
        return F.when(of[int(i)] <= float(bound), low).otherwise(node())

    return node()


def judged(described_: DataFrame, trees: list[Column] | None) -> DataFrame:
    """``described_`` with ``probability``: the share of trees that vote for a secret."""
    if not trees:
        return described_.withColumn("probability", F.lit(1.0))
    votes = described_.withColumn("_votes", F.array(*trees))
    return votes.withColumn("probability", F.aggregate("_votes", F.lit(0.0), lambda a, x: a + x) / len(trees)).drop("_votes")


def scan(docs: DataFrame, labelled=None, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """Findings with probability and ``is_secret`` (0.5 or more).  ``labelled``: a function
    from described findings to a label column; by default the distant labels."""
    found = materialize(described(findings(docs, id_col, text_col, path_col), dictionary(docs, text_col)), "secrets-found")
    label = labelled(found) if labelled else distant_label(F.col("before"), F.col("candidate"))
    trees = train(found.withColumn("label", label))
    return judged(found, trees).withColumn("is_secret", F.col("probability") >= 0.5)
