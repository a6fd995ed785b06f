"""Source divergence, importance resampling and packing against brute force and their SQL."""

import hashlib
import math
import random
import re
import sys
import zlib
from collections import Counter, defaultdict
from itertools import groupby
from os.path import dirname

import numpy as np
import public_tokenizers as pt
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strandline.llm import importance_resampling as ir
from strandline.llm import oracle, packing, queries
from strandline.llm import source_divergence as sd

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("name", ["op11_source_divergence", "op12_importance_resampling"])
def test_equals_sql(spark, name):
    sys.path.insert(0, dirname(dirname(__file__)))
    from oracle_compare import duck
    df = queries.QUERIES[name](spark, SF)
    want = duck(SF).execute(oracle.ORACLE_SQL[name]).fetchall()
    cols = duck(SF).execute(oracle.ORACLE_SQL[name]).fetchdf().columns
    assert rows_of(df.select(*cols)) == sorted(want, key=repr)


# ---- source divergence -----------------------------------------------------------

def odd_docs(spark, n=240):
    rnd = random.Random(5)
    words = [f"{a}{b}" for a in ("ka", "lo", "Ñu", "éa", "zi") for b in ("m", "n", "Ö", "t", "漢")]
    rows = [(i, " ".join(rnd.choice(words) + rnd.choice(["", ",", "7", "'"]) for _ in range(rnd.randint(0, 40))),
             rnd.choice(["en", "de", None, ""]), rnd.choice(["a", "b", "c", None, ""]), 0) for i in range(n)]
    rows += [(None, None, None, None, None), (7, None, "en", "quiet", 0), (8, "", "fr", "only", 0), (8, "", "fr", "only", 0),
             (9, "rare words", "it", "x", 1), (9, "rare", "it", "y", 1), (10, "kam " * 20000, "en", "long", 1)]
    rows += [rows[3]] * 15
    return spark.createDataFrame(rows, DOCS).withColumn("term", F.lit("t")).withColumn("idx", F.lit(1)).withColumn("n", F.lit(2))


def brute_audit(rows, min_docs=10, top=10):
    count, df, groups = defaultdict(Counter), defaultdict(Counter), set()
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for r in rows:
        la, so = r.lang or "", r.source or ""
        groups.add((la, so))
        here = Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (r.text or "").translate(lower)))
        count[la, so].update(here)
        df[la].update(here.keys())
    out = []
    for la, so in groups:
        kept = [t for t, k in df[la].items() if k >= min_docs]
        v = len(kept)

        def p(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (n + 2 * v) for t in kept}
        mine, lang = p(count[la, so]), p(sum((count[g] for g in groups if g[0] == la), Counter()))
        f = lambda a, b: (a - b) ** 2 // (a + b)
        pairs = [(sum(f(mine[t], q[t]) for t in kept), o) for la2, o in groups if la2 == la and o != so for q in [p(count[la, o])]]
        terms = [(f(mine[t], lang[t]), t) for t in kept if count[la, so][t] and mine[t] > lang[t]]
        for part, found, most in (("pair", pairs, None), ("term", terms, top)):
            ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
            out += [(la, so, part, item, value, k) for k, (value, item) in enumerate(ranked, 1)]
    return sorted(out, key=repr)


def test_divergence_odd_rows(spark):
    docs = odd_docs(spark)
    assert rows_of(sd.audit(docs)) == brute_audit(docs.collect())


def test_divergence_dense_levels_tiles_and_blocks(spark):
    docs = odd_docs(spark)
    layout = sd.Layout(block=5, bits=64, tile=2, dense=2, flush=10)
    assert rows_of(sd.audit(docs, layout=layout)) == brute_audit(docs.collect())


def test_divergence_empty(spark):
    assert sd.audit(spark.createDataFrame([], DOCS)).collect() == []


def test_joint_cells_and_large_counts():
    rnd = np.random.default_rng(3)
    size, layout = 4000, sd.Layout()

    def group(seed):
        n = np.where(rnd.random(size) < 0.4, 0, rnd.zipf(1.4, size) % (1 << 50))
        rows = []
        for level in sorted(set(n[n > 0].tolist())):
            at = np.flatnonzero(n == level)
            if len(at) >= layout.dense:
                bits = np.zeros(layout.bits, np.uint8)
                bits[at] = 1
                rows.append((level, len(at), np.packbits(bits, bitorder="little").tobytes()))
            else:
                rows.append((level, len(at), at.astype("<u2").tobytes()))
        return n.tolist(), sd.Levels(rows, sum(n.tolist()), size, layout)
    (a, g), (b, h) = group(1), group(2)
    assert g.dense and len(g.positions)
    f = lambda p, q: (p - q) ** 2 // (p + q)
    p = [1 + 10**9 * (x + 2) // (sum(a) + 2 * size) for x in a]
    q = [1 + 10**9 * (x + 2) // (sum(b) + 2 * size) for x in b]
    assert sd.pair_value(g, h, size) == sd.pair_value(h, g, size) == sum(map(f, p, q))
    joint = Counter((x, y) for x, y in zip(a, b) if x and y)
    i, j, n = sd.cells(g, h)
    assert sorted(n.tolist()) == sorted(joint.values())


def test_share_of_huge_counts(spark):
    n, total, v = 10**15, 10**17, 12345
    df = spark.createDataFrame([(n, total, v)], "n long, total long, v long")
    assert df.select(sd.share(F.col("n"), F.col("total"), F.col("v"))).first()[0] == 1 + 10**9 * (n + 2) // (total + 2 * v)


# ---- importance resampling ---------------------------------------------------------

def brute_resample(docs, target, run, buckets, percent=10, least=20):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})

    def feats(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(lower))
        return len(w), Counter(zlib.crc32(" ".join(w[i:i + k]).encode()) % buckets for k in range(1, run + 1) for i in range(len(w) - k + 1))
    got = [(i, *feats(t)) for i, t in docs]
    raw, aim = Counter(), Counter()
    for _, _, c in got:
        raw.update(c)
    for t in target:
        aim.update(feats(t)[1])
    s, t = sum(raw.values()), sum(aim.values())
    gain = {b: math.floor(1000 * math.log(((aim[b] + 1) * (s + buckets)) / ((raw[b] + 1) * (t + buckets)))) for b in raw}
    out = []
    for i, n, c in got:
        weight = sum(gain[b] * k for b, k in c.items())
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, n, sum(c.values()), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    fit = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    k = percent * len(fit) // 100
    # rows with equal id and score may take each other's rank
    return sorted([(*r, j if j <= k else None) for j, r in enumerate(fit, 1)] + [(*r, None) for r in out if r[1] < least], key=repr)


@pytest.mark.parametrize("run, buckets", [(1, 10_000), (3, 500)])
def test_resampling_odd_rows(spark, run, buckets):
    docs = odd_docs(spark)
    target = spark.createDataFrame([(1, "kam lon LOT x9"), (2, None), (3, ""), (3, "Ñum zit, zit")], "item_id long, text string")
    got = rows_of(ir.resample(docs, target, run=run, buckets=buckets))
    assert got == brute_resample([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()], run, buckets)
    assert any(r[-1] for r in got)


def test_resampling_empty(spark):
    none, target = spark.createDataFrame([], DOCS), spark.createDataFrame([], "item_id long, text string")
    assert ir.resample(none, target).collect() == []
    assert len(ir.resample(odd_docs(spark), target).collect()) == odd_docs(spark).count()


def test_windows_are_offsets():
    text = "Ab, ñandú — 3x ab".encode()
    found = list(ir.Features(2, 100).windows(text))
    words = ["ab", "ñandú", "3x", "ab"]      # the dash is not ASCII and a word of its own
    words.insert(2, "—")
    assert [text.decode()[a:b].lower() for a, b, _ in found[:5]] == words
    assert [h for _, _, h in found] == [zlib.crc32(w.encode()) % 100 for w in words] + [
        zlib.crc32(f"{a} {b}".encode()) % 100 for a, b in zip(words, words[1:])]
    assert found[5][:2] == (0, found[1][1])


# ---- packing -------------------------------------------------------------------------

def library_ids(texts):
    t = Tokenizer.from_file(pt.path("word_bpe_49k.json"))
    t.encode_special_tokens = True
    return [t.encode(x, add_special_tokens=False).ids for x in texts]


def check_pieces(pieces, docs, window):
    """Every id in one piece; offsets gapless; padding only where the length is a power of two."""
    seqs, parts = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert p.length == len(p.ids) // 4 > 0
        seqs[p.sequence_id].append((p.offset, p.length))
        parts[p.doc_id, p.doc_tokens].append((p.start, bytes(p.ids)))
    for s in seqs.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at == window or at & (at - 1) == 0
        assert at <= window
    want = Counter((i, np.array(ids + [1], "<u4").tobytes()) for i, ids in docs)
    got = Counter()
    for (i, total), found in parts.items():
        copies = sum(start == 0 for start, _ in found)
        cuts = defaultdict(list)
        for start, ids in found:
            cuts[start].append(ids)
        # copies of a row have the same ids, so any of its pieces may be joined
        for _ in range(copies):
            at, whole = 0, b""
            while at < total:
                piece = next(x for x in cuts[at])
                cuts[at].remove(piece)
                whole += piece
                at += len(piece) // 4
            got[i, whole] += 1
    assert got == want


def test_packing_equals_the_library(spark):
    spec = packing.tokenizer(spark, pt.path("word_bpe_49k.json"))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.collect()
    pieces = packing.pack(docs, spec).collect()
    check_pieces(pieces, list(zip([r.doc_id for r in rows], library_ids([r.text for r in rows]))), 2048)
    digest = queries.op13_packing(spark, SF).collect()
    assert sorted((r.doc_id, r.start, r.ids_crc32) for r in digest) == sorted((p.doc_id, p.start, zlib.crc32(p.ids)) for p in pieces)


ODD = [None, "", " \t\n", "Don't stop, it's 42 ² ½—ok<|endoftext|> <|startoftext|>", "été Ünïcode　wide\x1cmark x\x85y z　q​w",
       "Á ẹ́ İstanbul ΑΣ Σ ß ﬁ  ñ k", "x1" * 9000, "word, word. WORD! " * 3000, "\x1f\x1e a\x1db", "a\x00b", "漢字かな 한국어"]


def test_packing_odd_rows(spark):
    rows = [(k, t, "s", 3) for k, t in enumerate(ODD)] + [(3, ODD[3], "s", 3)] * 3 + [(None, "null id", "s", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string, offset int").coalesce(1)
    spec = packing.tokenizer(spark, pt.path("word_bpe_49k.json"))
    for window, most in ((2048, 4096), (64, 2), (1, 1)):
        pieces = packing.pack(docs, spec, window=window, max_open=most).collect()
        check_pieces(pieces, [(r[0], ids) for r, ids in zip(rows, library_ids([r[1] or "" for r in rows]))], window)
    none = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(none, spec).collect() == []


def test_padded_sequences(spark):
    spec = packing.tokenizer(spark, pt.path("word_bpe_49k.json"))
    pieces = packing.pack(spark.read.parquet(f"{SF}/documents.parquet"), spec)
    held = {s: b"".join(bytes(p.ids) for p in sorted(ps, key=lambda p: p.offset))
            for s, ps in groupby(sorted(pieces.collect(), key=lambda p: p.sequence_id), key=lambda p: p.sequence_id)}
    got = packing.sequences(pieces).collect()
    assert {r.sequence_id: bytes(r.ids)[:4 * r.n_tokens] for r in got} == held
    assert all(len(r.ids) == 4 * (r.n_tokens + r.padding) for r in got)
    assert sum(r.padding for r in got) == 0
    part = spark.createDataFrame([(9, 0, 2, bytearray(b"\1\0\0\0\2\0\0\0")), (9, 2, 1, bytearray(b"\3\0\0\0"))], "sequence_id long, offset long, length long, ids binary")
    assert bytes(packing.sequences(part, window=4, pad_id=5).first().ids) == b"\1\0\0\0\2\0\0\0\3\0\0\0\5\0\0\0"


def test_level_is_the_least_sum_of_squares():
    rnd = random.Random(11)
    for window in (7, 16, 50):
        p = packing.Packer(window)
        for k in range(400):
            size = min(window - 1, 1 + int(rnd.expovariate(4 / window)))
            n = p.counts.copy()

            def after(h):
                m = n.copy()
                if h:
                    m[h] -= 1
                if h + size < window:
                    m[h + size] += 1
                return int((m ** 2).sum())
            free = [0] + [h for h in range(1, window - size + 1) if n[h]]
            best = min(free, key=lambda h: (after(h), -h))
            assert p.level(size) == best
            for _ in p.add(packing.Piece(k, 0, bytes(4 * size), size)):
                pass
            assert p.counts.sum() == p.n_open == sum(map(len, p.waiting.values()))
            assert all(sum(map(len, w)) == h for h, ws in p.waiting.items() for w in ws)
