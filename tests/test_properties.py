"""Random small inputs: the distributed interval operators against brute force."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strandline.operators import bases as B
from strandline.operators import duplicates as D
from strandline.operators import intervals as I
from strandline.operators import reads as R
from strandline.operators import regions as G

SETTINGS = settings(max_examples=20, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

ivs = st.lists(st.tuples(st.integers(1, 3), st.integers(1, 400), st.integers(0, 120)),  # 0: empty
               min_size=1, max_size=40)


def brute_merge(rows, gap):
    out = []
    for chrom in sorted({c for c, _, _ in rows}):
        cur = None
        for s, e in sorted((s, e) for c, s, e in rows if c == chrom):
            if cur and s <= cur[1] + gap:
                cur = [cur[0], max(cur[1], e), cur[2] + 1]
            else:
                if cur:
                    out.append((chrom, *cur))
                cur = [s, e, 1]
        out.append((chrom, *cur))
    return sorted(out)


@SETTINGS
@given(ivs, st.integers(0, 60), st.sampled_from([8, 64, 1 << 16]))
def test_merge_matches_brute_force(spark, data, gap, bin_size):
    rows = [(c, s, s + ln) for c, s, ln in data]
    df = spark.createDataFrame(rows, "ref_idx int, pos long, end_pos long").repartition(3)
    got = sorted(tuple(r) for r in I.merge_intervals(df, gap=gap, bin_size=bin_size)
                 .select("ref_idx", "start_pos", "end_pos", "n_reads").collect())
    assert got == brute_merge(rows, gap)


@SETTINGS
@given(ivs, ivs, st.sampled_from([4, 32, 1024]))
def test_intersect_and_restrict_match_brute_force(spark, left, right, bin_size):
    lrows = [(i, c, s, s + ln) for i, (c, s, ln) in enumerate(left)]
    rrows = [(c, s, s + ln) for c, s, ln in right]
    ldf = spark.createDataFrame(lrows, "bed_id long, ref_idx int, bstart long, bend long")
    rdf = spark.createDataFrame(rrows, "ref_idx int, start0 long, end0 long")
    # empty intervals cover no base and overlap nothing
    want = sorted((i, c, max(s, rs), min(e, re)) for i, c, s, e in lrows for rc, rs, re in rrows
                  if c == rc and s < re and rs < e and s < e and rs < re)
    got = sorted(tuple(r) for r in I.interval_intersect(ldf, rdf, bin_size=bin_size)
                 .select("bed_id", "ref_idx", "istart", "iend").collect())
    assert got == want
    # restriction: left rows as reads, right rows as targets
    reads = ldf.withColumnRenamed("bed_id", "read_id").withColumnRenamed("bstart", "start0") \
        .withColumnRenamed("bend", "end0")
    targets = rdf.withColumnRenamed("start0", "bstart").withColumnRenamed("end0", "bend")
    want_r = sorted({i for i, c, s, e in lrows for rc, rs, re in rrows
                     if c == rc and s < re and rs < e and s < e and rs < re})
    got_r = sorted(r.read_id for r in I.interval_restrict(reads, targets, bin_size=bin_size)
                   .collect())
    assert got_r == want_r


reads_st = st.lists(st.tuples(st.integers(1, 2), st.sampled_from([0, 16]), st.integers(50, 70),
                              st.sampled_from(["8M", "2S6M", "6M2S", "3M1D5M"]),
                              st.text("#5I", min_size=8, max_size=8)),
                    min_size=1, max_size=30)


def _clip(cig, lead):
    import re
    m = re.match(r"^(\d+)S", cig) if lead else re.search(r"(\d+)S$", cig)
    return int(m.group(1)) if m else 0


@SETTINGS
@given(reads_st)
def test_duplicates_match_brute_force(spark, data):
    rows = [(i, f"q{i:03d}", strand, c, pos, 60, cig, "A" * 8, qual)
            for i, (c, strand, pos, cig, qual) in enumerate(data)]
    df = R.with_alignment_end(spark.createDataFrame(
        rows, "read_id long, qname string, flag int, ref_idx int, pos long, mapq int, "
              "cigar string, seq string, qual string"))
    ref_len = {"8M": 6 + 2, "2S6M": 6, "6M2S": 6, "3M1D5M": 9}
    groups = {}
    for i, q, strand, c, pos, _, cig, _, qual in rows:
        end = pos + ref_len[cig] - 1
        p5 = end + _clip(cig, False) if strand else pos - _clip(cig, True)
        score = sum(ord(ch) - 33 for ch in qual if ord(ch) - 33 >= 15)
        groups.setdefault((c, strand, p5), []).append((-score, q, i))
    want = {}
    for members in groups.values():
        best = min(members)
        for m in members:
            want[m[2]] = 0 if m == best else 1
    got = {r.read_id: r.dup for r in D.mark_duplicates(df).collect()}
    assert got == want


pile_st = st.lists(st.tuples(st.integers(1, 4), st.sampled_from("ACGT"), st.sampled_from("ACGTN"),
                             st.integers(1, 9), st.integers(0, 90)), min_size=1, max_size=40)


@SETTINGS
@given(pile_st)
def test_calls_match_brute_force(spark, data):
    # one reference base per site; (site, base) unique
    ref = {}
    cells = {}
    for pos, rb, b, depth, qsum in data:
        rb = ref.setdefault(pos, rb)
        cells[(pos, b)] = (rb, depth, qsum)
    rows = [(1, pos, rb, b, d, q) for (pos, b), (rb, d, q) in cells.items()]
    pile = spark.createDataFrame(rows, "ref_idx int, ref_pos long, ref_base string, base string, "
                                       "depth long, qsum long")
    want = []
    for pos in sorted(ref):
        site = [(b, d, q) for (p, b), (rb, d, q) in cells.items() if p == pos]
        dp = sum(d for _, d, _ in site)
        # an N is no variant
        alts = sorted((-q, b, d) for b, d, q in site if b not in (ref[pos], "N"))
        if not alts:
            continue
        nq, b, d = alts[0]
        if -nq >= 30 and d * 5 >= dp:
            want.append((1, pos, ref[pos], b, -nq, d, dp, "1/1" if d * 5 >= dp * 4 else "0/1"))
    got = sorted(tuple(r) for r in B.call_variants(pile).collect())
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(1, 5), st.integers(1, 50)),
                min_size=1, max_size=60), st.integers(1, 6))
def test_rank_within_matches_sort(spark, data, parts):
    rows = [(i, g, c, p, f"q{i:03d}") for i, (g, c, p) in enumerate(data)]
    df = spark.createDataFrame(rows, "read_id long, region int, ref_idx int, pos long, qname string")
    want = {}
    for g in {r[1] for r in rows}:
        for k, r in enumerate(sorted((r for r in rows if r[1] == g), key=lambda r: (r[2], r[3], r[4]))):
            want[r[0]] = k + 1
    got = {r.read_id: r.rank for r in G.rank_within(df, "region", ["ref_idx", "pos", "qname"],
                                                     num_partitions=parts).collect()}
    assert got == want


paired_st = st.lists(st.tuples(
    st.sampled_from(["a", "b", "c", "d", "e", "f"]),
    st.sampled_from([1 + 64 + 32, 1 + 128 + 16, 1 + 64 + 8, 1 + 128 + 4, 0, 16, 1 + 64 + 256]),
    st.integers(1, 2), st.integers(50, 56), st.sampled_from(["8M", "2S6M", "6M2S"]),
    st.text("#5I", min_size=8, max_size=8)), min_size=1, max_size=24)


@SETTINGS
@given(paired_st)
def test_paired_duplicates_match_brute_force(spark, data):
    ref_len = {"8M": 8, "2S6M": 6, "6M2S": 6}
    rows, info = [], {}
    for i, (q, flag, c, pos, cig, qual) in enumerate(data):
        rows.append((i, q, flag, c, pos, 60, cig, "A" * 8, qual))
        end = pos + ref_len[cig] - 1
        p5 = end + _clip(cig, False) if flag & 16 else pos - _clip(cig, True)
        score = sum(ord(ch) - 33 for ch in qual if ord(ch) - 33 >= 15)
        info[i] = dict(q=q, flag=flag, end=(c, p5, flag & 16), score=score)
    prim = {i for i, v in info.items() if v["flag"] & 0x900 == 0}
    eligible = [i for i in prim if info[i]["flag"] & 1 and not info[i]["flag"] & 12]
    by_name = {}
    for i in eligible:
        by_name.setdefault(info[i]["q"], []).append(i)
    templates = {q: sorted(ids, key=lambda i: (info[i]["end"], i))
                 for q, ids in by_name.items() if len(ids) == 2}
    want = {i: 0 for i in info}
    groups = {}
    for q, (a, b) in templates.items():
        key = (info[a]["end"], info[b]["end"])
        groups.setdefault(key, []).append((-(info[a]["score"] + info[b]["score"]), q, a, b))
    for members in groups.values():
        best = min(members)
        for m in members:
            if m != best:
                want[m[2]] = want[m[3]] = 1
    in_tmpl = {i for ids in templates.values() for i in ids}
    pair_ends = {info[i]["end"] for i in in_tmpl}
    frags = [i for i in prim if not info[i]["flag"] & 4 and i not in in_tmpl]
    fgroups = {}
    for i in frags:
        fgroups.setdefault(info[i]["end"], []).append((-info[i]["score"], info[i]["q"], i))
    for end, members in fgroups.items():
        best = min(members)
        for m in members:
            want[m[2]] = 1 if end in pair_ends or m != best else 0
    df = R.with_alignment_end(spark.createDataFrame(
        rows, "read_id long, qname string, flag int, ref_idx int, pos long, mapq int, "
              "cigar string, seq string, qual string"))
    got = {r.read_id: r.dup for r in D.mark_duplicates_paired(df).collect()}
    assert got == want


def brute_clip(cigar, pos, length):
    import re
    ops = [(int(n), op) for n, op in re.findall(r"(\d+)([MIDNSHP=X])", cigar)]
    aligned = sum(n for n, op in ops if op in "MDN=X")
    if not (pos + aligned - 1 > length and pos <= length):
        return cigar, pos + aligned - 1
    limit, ref_off, clipped, kept = length - pos + 1, 0, 0, []
    for k, (n, op) in enumerate(ops):
        if op in "MDN=X":
            keep = max(0, min(n, limit - ref_off))
        elif op == "H":
            keep = n
        else:
            keep = n if ref_off < limit else 0
        if op in "MIS=X":
            clipped += n - keep
        kept.append((k, op, keep))
        if op in "MDN=X":
            ref_off += n
    if clipped == 0:
        return cigar, pos + aligned - 1
    nonzero = [x for x in kept if x[2] > 0]
    last_q = max([k for k, op, n in nonzero if op in "M=XI"], default=-1)
    tail = clipped + sum(n for k, op, n in nonzero if op == "S" and k > last_q)
    body = [(k, op, n) for k, op, n in nonzero if not (op in "DNS" and k > last_q)]
    new = "".join(f"{n}{op}" for _, op, n in body) + f"{tail}S"
    return new, pos + sum(n for _, op, n in body if op in "MDN=X") - 1


cigars = st.lists(st.tuples(st.integers(1, 6), st.sampled_from("MIDS")), min_size=1, max_size=5) \
    .map(lambda ops: "".join(f"{n}{op}" for n, op in ops) + "3M")


@SETTINGS
@given(st.lists(st.tuples(cigars, st.integers(1, 60), st.integers(20, 60)), min_size=1, max_size=30))
def test_clean_alignments_match_brute_force(spark, data):
    from pyspark.sql import functions as F
    rows = [(i, 0, pos, 60, cig, length) for i, (cig, pos, length) in enumerate(data)]
    df = spark.createDataFrame(rows, "read_id long, flag int, pos long, mapq int, cigar string, "
                                     "ref_length long")
    got = {r.read_id: (r.cigar, r.end_pos) for r in R.clean_alignments(df).collect()}
    want = {i: brute_clip(cig, pos, length) for i, (cig, pos, length) in enumerate(data)}
    assert got == want


@SETTINGS
@given(st.lists(st.lists(st.text("ACGT+@I", min_size=0, max_size=40), min_size=1, max_size=60),
                min_size=1, max_size=3),
       st.integers(64, 2048))
def test_line_ordinals_across_files_and_splits(spark, files, split_bytes):
    import os
    import tempfile
    from strandline.sources.fastq import read_indexed_lines
    d = tempfile.mkdtemp(prefix="ord-")
    expected = []
    for k, lines in enumerate(files):
        with open(os.path.join(d, f"f{k:02d}.txt"), "w") as f:
            f.write("".join(ln + "\n" for ln in lines))
        expected += lines
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    try:
        got = sorted((r.idx, r.value) for r in read_indexed_lines(spark, d).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == list(enumerate(expected))


@SETTINGS
@given(st.lists(st.tuples(st.text("ACGTN", min_size=1, max_size=400), st.integers(5, 80)),
                min_size=1, max_size=4),
       st.integers(128, 4096), st.sampled_from([16, 100, 1024]))
def test_fasta_chunks_match_slicing(spark, contigs, split_bytes, bin_size):
    import os
    import tempfile
    from strandline.sources.fasta import read_fasta_chunks
    d = tempfile.mkdtemp(prefix="fa-")
    path = os.path.join(d, "ref.fa")
    seqs = {}
    with open(path, "w") as f:
        for k, (s, width) in enumerate(contigs):
            seqs[f"c{k}"] = s
            f.write(f">c{k} test\n" + "".join(s[i:i + width] + "\n" for i in range(0, len(s), width)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    try:
        chunks = read_fasta_chunks(spark, path, bin_size=bin_size).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    rebuilt = {}
    for r in sorted(chunks, key=lambda r: (r.ref_name, r.chunk_start)):
        assert r.bin == r.chunk_start // bin_size
        rebuilt[r.ref_name] = rebuilt.get(r.ref_name, "") + r.chunk
    assert rebuilt == seqs
