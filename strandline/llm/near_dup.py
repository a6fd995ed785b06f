"""MinHash near-duplicates by an inverted join of signature coordinates.

A document's set holds its distinct word shingles.  Documents with equal sets form one
class at once; a class is posted, under its smallest id, by its bands: ``BAND`` neighbouring
coordinates of its MinHash signature with their values.  Bands that only one class has are
skipped.  A pair of sets at the similarity asked for agrees in ``LEAST`` of ``COORDINATES``
values and in ``LEAST_BANDS`` of ``BANDS`` bands but for a chance of about 3e-9 and 1.3e-9 at
exactly 0.8 (less above), so the pair must also meet in the rarest BANDS - LEAST_BANDS + 1
bands of each (prefix); only those postings are joined, and a pair counts its collisions
over all coordinates before it is verified on full sets.  A single value is shared by all
documents with some text in common, so its list grows with the table; a band's list holds
few that are not alike.
Shingles that only one posted class has cannot be common: classes and pairs whose other
shingles are too few for the similarity are skipped (an exact bound).

Pairs inside a group are never all emitted.  Pivot rounds come first: in each posting list
every member meets one pivot, verified pairs are merged into components, and lists whose
members are all in one component are done.  The last round then takes what is left: pairs
of members of different components.  Lists of up to ``DIRECT`` members are joined with
themselves, each pair emitted only at its first common value.  In longer lists members are
compared by how their full sets differ from the list's pivot: two sets that are similar
enough, and not both linked to the pivot, have at least a known number of differences in
common, so only pairs that meet in the rarest of their differences (prefix) are emitted.
This is exact, and a large group of sets just below the similarity does not become all of
its pairs.  So every link between components is tested, while links inside a component,
which cannot change the result, are not.

Defined results: a null or empty text, or one without words, has no shingles and is linked
with nothing; fewer words than a shingle make one shingle of all; rows with a null id are
returned as their own component; repeated rows belong to one document, so ``keep_one``
keeps all rows of an id that it keeps, equal ones too."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import docs_of, materialize, materialize_counted, per_row

COORDINATES, LEAST = 128, 74
BAND = 3
BANDS, LEAST_BANDS = COORDINATES // BAND, 4
#: Pivot rounds go on while a round merges this share of the open members.
GOES_ON = 0.02
#: Lists of more open members are compared by differences from their pivot.
DIRECT = 8
_RNG = np.random.default_rng(20240229)
_MULTIPLY = _RNG.integers(0, 1 << 31, COORDINATES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_FLIP = _RNG.integers(0, 1 << 32, COORDINATES, dtype=np.uint32)
_MIX = _RNG.integers(0, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LETTERS = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)      # a random value for each byte
_LETTERS[65:91] = _LETTERS[97:123]                              # A-Z count as a-z
_GAP = np.zeros(256, bool)
_GAP[[32, *range(9, 14)]] = True
_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 1 << 64)


class Shingler:
    """Sets of shingle hashes (64 bits, sorted) of texts in UTF-8, by whole arrays: a word's
    hash is a polynomial of its bytes, taken as a difference of running sums."""

    def __init__(self, k: int) -> None:
        self.k, self.up, self.down = k, np.ones(1, np.uint64), np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) <= n:
            size = max(2 * len(self.up), n + 1)
            self.up = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, _STEP, np.uint64)])
            self.down = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, _BACK, np.uint64)])

    def __call__(self, text: bytes) -> np.ndarray:
        raw = np.frombuffer(text, np.uint8)
        edge = np.flatnonzero(np.diff(np.concatenate(([True], _GAP[raw], [True])).view(np.int8)))
        if not len(edge):
            return np.empty(0, np.uint64)
        self._powers(len(raw))
        start, end = edge[::2], edge[1::2]
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_LETTERS[raw] * self.up[:len(raw)])))
        w = (sums[end] - sums[start]) * self.down[start]
        w ^= w >> np.uint64(31)
        k = min(self.k, len(w))
        n = len(w) - k + 1
        s = np.full(n, _MIX[15], np.uint64)
        for i in range(k):
            s = (s ^ (w[i:i + n] * _MIX[i % 15])) * _MIX[(i + 7) % 15]
            s ^= s >> np.uint64(29)
        return np.unique(s)


def signature(s: np.ndarray) -> np.ndarray:
    """COORDINATES minima (32 bits) of a non-empty set."""
    x = (s >> np.uint64(32)).astype(np.uint32)
    out = np.full(COORDINATES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 1024):
        part = (x[None, at:at + 1024] ^ _FLIP[:, None]) * _MULTIPLY[:, None]
        np.minimum(out, part.min(1), out=out)
    return out.view(np.int32)


def _sets(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, n, set_hash, sig) per row."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("set_hash", pa.binary()), ("sig", pa.list_(pa.int32()))])

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        sh = Shingler(k)
        for key, text in rows:
            s = sh(text)
            if len(s):
                yield key, len(s), hashlib.blake2b(s.tobytes(), digest_size=16).digest(), signature(s)
            else:
                yield key, 0, None, None

    return docs.mapInArrow(per_row(run, schema, 1024), "doc_id long, n long, set_hash binary, sig array<int>")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for a, b, x, y in rows:
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            if 100 * both >= percent * (len(x) + len(y) - both):
                yield a, b

    left = _as(sets, node="a", set="x")
    right = _as(sets, node="b", set="y")
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(per_row(run, schema, 4096), "a long, b long")


def _as(df: DataFrame, **names: str) -> DataFrame:
    """The columns under new names, all renamed at once."""
    return df.select(*(F.col(old).alias(new) for old, new in names.items()))


def connected(edges: DataFrame, tag: str = "cc") -> DataFrame:
    """(node, comp): smallest node reachable, for the nodes of ``edges`` (a, b).

    Each step hooks every root to the smallest root beside it and halves the paths; the
    edges between roots shrink to none after a logarithmic number of steps."""
    e, left = materialize_counted(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), tag)
    labels = e.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("comp", F.col("node"))
    while left:
        # hook: a root takes the smallest root beside it if that is smaller
        hook = materialize(e.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("up")), tag)
        # jump: follow the hooks until none ends at a hooked root (each pass halves the way)
        moves = 1
        while moves:
            far = _as(hook, node="up", up="far")
            hook = materialize(hook.join(far, "up", "left").select("node", F.coalesce("far", "up").alias("up")), tag)
            moves = hook.join(hook.select(F.col("node").alias("up")), "up", "left_semi").limit(1).count()
        labels = materialize(labels.join(_as(hook, node="comp", up="up"), "comp", "left").select("node", F.coalesce("up", "comp").alias("comp")), tag)
        ua, ub = _as(hook, node="a", up="ua"), _as(hook, node="b", up="ub")
        a, b = F.coalesce("ua", "a"), F.coalesce("ub", "b")
        e, left = materialize_counted(e.join(ua, "a", "left").join(ub, "b", "left").select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
                                      .where("a < b").distinct(), tag)
    return labels


def _posted(reps: DataFrame) -> DataFrame:
    """(node, prefix): each class's rarest bands that another class has too; classes that
    cannot reach LEAST_BANDS of them are left out."""
    bands = F.array(*(F.xxhash64(F.lit(i), *(F.get("sig", BAND * i + j) for j in range(BAND))) for i in range(BANDS)))
    post = reps.select("node", F.explode(bands).alias("token"))
    shared = materialize(post.groupBy("token").agg(F.min("node").alias("lo"), F.max("node").alias("hi"), F.count("*").alias("n"))
                         .where("lo < hi").select("token", F.col("n").alias("df")), "nd-tokens")
    per = (post.join(shared, "token").groupBy("node").agg(F.sort_array(F.collect_set(F.struct("df", "token"))).alias("s"))
           .where(F.size("s") >= LEAST_BANDS))
    return per.select("node", F.slice(F.transform("s", lambda x: x["token"]), F.lit(1), F.size("s") - LEAST_BANDS + 1).alias("prefix"))


def _coordinates(reps: DataFrame) -> DataFrame:
    """(node, n, coords): a node's largest set size and all (coordinate, value) that it has."""
    coords = F.transform("sig", lambda v, i: F.shiftleft(i.cast("long"), 32).bitwiseOR(v.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))))
    return reps.groupBy("node").agg(F.max("n").alias("n"), F.array_distinct(F.flatten(F.collect_list(coords))).alias("coords"))


def _private(sets: DataFrame) -> DataFrame:
    """(node, private): how many of a class's shingles no other posted class has."""
    schema = pa.schema([("node", pa.int64()), ("shingle", pa.int64())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                each = [np.frombuffer(x, np.int64) for x in part.column(1).to_pylist()]
                node = np.repeat(part.column(0).to_numpy(), [len(x) for x in each])
                yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(np.concatenate(each), pa.int64())], schema=schema)

    return (sets.select("node", "set").mapInArrow(run, "node long, shingle long")
            .groupBy("shingle").agg(F.min("node").alias("node"), F.max("node").alias("hi")).where("node = hi")
            .groupBy("node").agg(F.count("*").alias("private")))


def _fits(na: Column, ua: Column, nb: Column, ub: Column, percent: int) -> Column:
    """Whether sizes and private shingles allow the similarity: the common part is at most
    what is not private, and the similarity asks for percent / (100 + percent) of both."""
    return (100 + percent) * F.least(na - ua, nb - ub) >= percent * (na + nb)


def _candidates(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that collide in LEAST coordinates and whose sizes and private
    shingles allow the similarity."""
    side = nodes.select("node", "n", "private", "coords")
    j = (pairs.join(_as(side, node="a", n="na", private="ua", coords="sa"), "a")
         .join(_as(side, node="b", n="nb", private="ub", coords="sb"), "b"))
    fits = _fits(F.col("na"), F.col("ua"), F.col("nb"), F.col("ub"), percent)
    return j.where(fits & (F.size(F.array_intersect("sa", "sb")) >= LEAST)).select("a", "b")


def _differences(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(pivot, node, size, need, linked, elem) for the pairs (pivot, node): a row for each
    shingle that only one of the two sets has; their number; what the node adds to the
    differences that it must share with a similar node; whether the two sets are linked.

    With M shingles of the pivot missing from a node and X others added, two nodes reach
    the similarity if 2 * (100 + percent) * (differences in common) >= their needs
    together.  Without a common difference, only nodes that are both linked to the pivot do."""
    schema = pa.schema([("pivot", pa.int64()), ("node", pa.int64()), ("size", pa.int64()), ("need", pa.int64()),
                        ("linked", pa.bool_()), ("elem", pa.int64())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for pivot, node, x, y in zip(*(c.to_pylist() for c in b.columns)):
                x, y = np.frombuffer(x, np.int64), np.frombuffer(y, np.int64)
                elem = np.setxor1d(x, y, assume_unique=True)
                missing = (len(x) - len(y) + len(elem)) // 2
                added = len(elem) - missing
                need = 200 * missing + 2 * percent * added - (100 - percent) * len(x)
                linked = (100 + percent) * (len(x) - missing) >= percent * (len(x) + len(y))
                n = len(elem)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, v), t) for v, t in zip((pivot, node, n, need, linked), schema.types)]
                                                 + [pa.array(elem, pa.int64())], schema=schema)

    both = pairs.join(_as(sets, node="pivot", set="x"), "pivot").join(_as(sets, node="node", set="y"), "node")
    return both.select("pivot", "node", "x", "y").mapInArrow(run, "pivot long, node long, size long, need long, linked boolean, elem long")


def _share(needs: Column, percent: int) -> Column:
    """Differences that two nodes must share, from their needs together."""
    return F.greatest(F.lit(1).cast("long"), F.ceil(needs / (2 * (100 + percent))))


def _meetings(delta: DataFrame, comp: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes in different components that meet in the rarest of their
    differences from the smallest pivot that they have in common."""
    common = materialize(delta.groupBy("pivot", "elem").agg(F.min("node").alias("lo"), F.max("node").alias("hi"), F.count("*").alias("df"))
                         .where("lo < hi").select("pivot", "elem", "df"), "nd-common")
    low = delta.groupBy("pivot").agg(F.min("need").alias("low"))
    per = (delta.join(common, ["pivot", "elem"]).groupBy("pivot", "node", "size", "need", "linked")
           .agg(F.transform(F.sort_array(F.collect_list(F.struct("df", "elem"))), lambda e: e["elem"]).alias("front")))
    # differences that no other node has come first of all and are not kept
    alone = F.col("size") - F.size("front")
    length = F.col("size") - _share(F.col("need") + F.col("low"), percent) + 1 - alone
    per = per.join(low, "pivot").select("pivot", "node", "size", "need", "linked", alone.alias("alone"),
                                        F.slice("front", F.lit(1), F.greatest(length, F.lit(0)).cast("int")).alias("front"))
    # a node's pivots, one for each value of its prefix at most: any of those that a pair has
    # in common tells all about it, so it meets at the smallest only
    stars = delta.groupBy("node").agg(F.collect_set("pivot").alias("pivots"))
    rows = materialize(per.join(comp, "node").join(nodes.select("node", "n", "private"), "node").join(stars, "node")
                       .select("*", F.posexplode("front").alias("at", "elem")), "nd-front")
    x, y = rows.alias("x"), rows.alias("y")
    share = _share(F.col("x.need") + F.col("y.need"), percent)
    within = lambda s: F.col(f"{s}.alone") + F.col(f"{s}.at") + share <= F.col(f"{s}.size")
    return (x.join(y, (F.col("x.pivot") == F.col("y.pivot")) & (F.col("x.elem") == F.col("y.elem")) & (F.col("x.node") < F.col("y.node"))
                   & (F.col("x.comp") != F.col("y.comp")) & ~(F.col("x.linked") & F.col("y.linked")) & within("x") & within("y")
                   & _fits(F.col("x.n"), F.col("x.private"), F.col("y.n"), F.col("y.private"), percent)
                   & (F.array_min(F.array_intersect("x.pivots", "y.pivots")) == F.col("x.pivot"))
                   & (F.element_at(F.array_intersect("x.front", "y.front"), 1) == F.col("x.elem")))
            .select(F.col("x.node").alias("a"), F.col("y.node").alias("b")))


def _relabel(comp: DataFrame, edges: DataFrame, tag: str) -> DataFrame:
    """Components after merging those that the edges (a, b) between components join."""
    new = _as(connected(edges, tag), node="comp", comp="up")
    return materialize(comp.join(new, "comp", "left").select("node", F.coalesce("up", "comp").alias("comp")), tag)


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """Per row: id, n_shingles, component_id, kept."""
    src = docs_of(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("body")), "doc_id", text="body")
    rows = materialize(_sets(src, shingle), "nd-rows")
    classes = materialize(rows.where("doc_id is not null and set_hash is not null").groupBy("set_hash")
                          .agg(F.min("doc_id").alias("node")), "nd-classes")
    # a document may have several rows with different sets: its classes then share its id
    first = rows.join(classes, "set_hash").where("doc_id = node").select("node", "n", "sig")
    posted = materialize(_posted(first), "nd-posted")
    able = materialize(posted.join(_coordinates(first.join(posted.select("node"), "node")), "node"), "nd-able")
    sets = materialize(_full_sets(src, able, shingle), "nd-sets")
    private = F.coalesce(F.col("private"), F.lit(0))
    nodes = able.join(_private(sets), "node", "left").withColumn("private", private)
    # with more private shingles than this no partner of any size is similar enough
    nodes = materialize(nodes.where(100 * (F.col("n") - F.col("private")) >= percent * F.col("n")), "nd-nodes")
    post = nodes.select("node", F.explode("prefix").alias("token"))
    comp = materialize(nodes.select("node", F.col("node").alias("comp")), "nd-comp")
    pivots, r = True, 0
    while True:
        here = post.join(comp, "node")
        span = here.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), _pivot(r).alias("pivot"), F.count("*").alias("members"))
        mixed = materialize(span.where("lo < hi").select("token", "pivot", "members"), "nd-mixed")
        open_ = materialize(here.join(mixed, "token"), "nd-open")
        if pivots:
            pv = open_.join(_as(comp, node="pivot", comp="pcomp"), "pivot").where("comp != pcomp")
            pairs = pv.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()
        else:
            star = open_.where((F.col("members") > DIRECT) & (F.col("node") != F.col("pivot"))).select("pivot", "node").distinct()
            delta = materialize(_differences(star, sets, percent), "nd-delta")
            rest = open_.where(F.col("members") <= DIRECT).select("token", "node", "comp").join(nodes.select("node", "n", "private", "prefix"), "node")
            x, y = rest.alias("x"), rest.alias("y")
            pairs = (x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.node") < F.col("y.node")) & (F.col("x.comp") != F.col("y.comp"))
                            & _fits(F.col("x.n"), F.col("x.private"), F.col("y.n"), F.col("y.private"), percent)
                            & (F.array_min(F.array_intersect("x.prefix", "y.prefix")) == F.col("x.token")))
                     .select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
                     .unionByName(_meetings(delta, comp, nodes, percent)).distinct())
        ca, cb = _as(comp, node="a", comp="ca"), _as(comp, node="b", comp="cb")
        links = _verified(_candidates(pairs, nodes, percent), sets, percent)
        if not pivots:
            # differences were counted on full sets, so these links are verified
            links = links.unionByName(delta.where("linked").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct())
        links, found = materialize_counted(links.join(ca, "a").join(cb, "b").select(F.col("ca").alias("a"), F.col("cb").alias("b")), "nd-links")
        if found:
            comp = _relabel(comp, links, "nd-comp")
        if not pivots:
            break
        pivots = found > GOES_ON * open_.select("node").distinct().count()
        r += 1
    return _result(rows, classes, comp, id_col, docs.schema[id_col].dataType.simpleString())


def _pivot(r: int) -> Column:
    """A member of the list, another one in each round: the smallest id after flipping
    bits that the round picks."""
    flip = F.lit(int(_MIX[r % 15] >> np.uint64(2)) if r else 0)
    return F.min(F.col("node").bitwiseXOR(flip)).bitwiseXOR(flip)


def _full_sets(src: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """(node, set) of the classes that have postings, from their documents' whole texts."""
    schema = pa.schema([("node", pa.int64()), ("set", pa.binary())])

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        sh = Shingler(k)
        for key, text in rows:
            yield key, sh(text).tobytes()

    some = src.join(nodes.select(F.col("node").alias("doc_id")), "doc_id").select("doc_id", "text")
    return some.mapInArrow(per_row(run, schema, 512), "node long, set binary").dropDuplicates(["node", "set"])


def _result(rows: DataFrame, classes: DataFrame, comp: DataFrame, id_col: str, kind: str) -> DataFrame:
    top = classes.join(comp, "node", "left").select("set_hash", F.coalesce("comp", "node").alias("comp"))
    out = rows.drop("sig").join(top, "set_hash", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "doc_id"))
    return (out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
            .select(F.col("doc_id").cast(kind).alias(id_col), "n_shingles", "component_id", "kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` whose document represents its component, columns as given."""
    out = components(docs, id_col, text_col, **how)
    kept = out.where(out["kept"]).select(out[id_col].alias("id")).distinct()
    return docs.join(kept, docs[id_col].eqNullSafe(kept["id"]), "left_semi")
