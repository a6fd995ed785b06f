"""Oracle SQL (DuckDB dialect) for every registered query.

The fixture views of FIXTURES.md part B/C are inlined as CTEs (only those a query
needs, in dependency order), over the driver's pre-registered base tables.  The SQL
is written from the definitions, independently of the Spark plans: plain windows over
whole partitions, ``EXISTS`` for restriction, per-base ``unnest`` and ``string_agg``
for string rebuilding.
"""

from __future__ import annotations

import re

# name -> (dependencies, body)
VIEWS: dict[str, tuple[list[str], str]] = {}


def _v(name: str, deps: list[str], sql: str) -> None:
    VIEWS[name] = (deps, sql)


_ALN = """SELECT CAST(o_orderkey AS BIGINT) AS read_id,
 concat('r', CAST(o_orderkey AS VARCHAR)) AS qname,
 CAST(CASE WHEN o_orderstatus='P' AND o_orderkey % 5 = 0 THEN 4 WHEN o_orderkey % 2 = 0 THEN 16 ELSE 0 END AS INT) AS flag,
 CAST(o_custkey % 26 AS INT) AS ref_idx,
 CAST(1 + (o_custkey * 7919 + (o_orderkey % 97) * 613) % (200000 + (o_custkey % 26) * 1000 - 40) AS BIGINT) AS pos,
 CAST(o_orderkey % 61 AS INT) AS mapq,
 CASE o_orderkey % 8 WHEN 5 THEN '10M2I20M' WHEN 6 THEN '10M2D22M' WHEN 7 THEN '4S28M' ELSE '32M' END AS cigar,
 CAST(CASE o_orderkey % 8 WHEN 5 THEN 30 WHEN 6 THEN 34 WHEN 7 THEN 28 ELSE 32 END AS BIGINT) AS ref_len,
 translate(md5(concat('{s}', CAST(o_orderkey AS VARCHAR))), '0123456789abcdef', 'ACGTACGTACGTACGT') AS seq,
 translate(md5(concat('{q}', CAST(o_orderkey AS VARCHAR))), '0123456789abcdef', '#+05:;<=>?@ACEGI') AS qual
FROM orders"""

_v("aln", [], _ALN.format(s="s", q="q"))
_v("aln2", [], _ALN.format(s="t", q="u"))
_v("kept", ["aln"], """SELECT *, pos + ref_len - 1 AS end_pos FROM aln
WHERE (flag & 4) = 0 AND ref_idx > 0 AND ref_idx <= 24""")
_v("seq_dict", [], """SELECT DISTINCT CAST(o_custkey % 26 AS INT) AS ref_idx,
 CASE o_custkey % 26 WHEN 0 THEN 'chrM' WHEN 23 THEN 'chrX' WHEN 24 THEN 'chrY' WHEN 25 THEN 'chrUn'
  ELSE concat('chr', CAST(o_custkey % 26 AS VARCHAR)) END AS ref_name,
 CAST(200000 + (o_custkey % 26) * 1000 AS INT) AS ref_length
FROM orders""")
_v("bed", [], """SELECT CAST(p_partkey AS BIGINT) AS bed_id, CAST(1 + p_partkey % 24 AS INT) AS ref_idx,
 CAST((p_partkey * 4793) % 190000 AS BIGINT) AS bstart,
 CAST((p_partkey * 4793) % 190000 + 50 + p_size * 20 AS BIGINT) AS bend
FROM part""")
_v("isl", ["kept"], """SELECT ref_idx, min(pos) AS start_pos, max(end_pos) AS end_pos, count(*) AS n_reads FROM (
 SELECT *, sum(brk) OVER (PARTITION BY ref_idx ORDER BY pos, read_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM (
  SELECT *, CASE WHEN pos <= max(end_pos) OVER (PARTITION BY ref_idx ORDER BY pos, read_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 51 THEN 0 ELSE 1 END AS brk
  FROM kept) x) y
GROUP BY ref_idx, island""")
_v("dense0", ["aln"], """SELECT read_id, qname, flag, ref_idx, CAST(1 + (read_id * 37) % 3000 AS BIGINT) AS pos, mapq, cigar, ref_len, qual,
 CAST(1 + (read_id * 37) % 3000 AS BIGINT) + ref_len - 1 AS end_pos
FROM aln WHERE (flag & 4) = 0 AND ref_idx > 0 AND ref_idx <= 24""")
_v("dense", ["dense0"], """SELECT d.*, array_to_string(list_transform(list_transform(range(0,32), lambda i: {'i': i, 'p':
  CASE cigar WHEN '10M2I20M' THEN CASE WHEN i<12 THEN pos+i ELSE pos+i-2 END
             WHEN '10M2D22M' THEN CASE WHEN i<10 THEN pos+i ELSE pos+i+2 END
             WHEN '4S28M' THEN pos+i-4 ELSE pos+i END}),
 lambda s: substr('ACGT', CAST(1 + (((s.p*s.p + 3*s.p + ref_idx) % 7 + s.p) % 4
   + CASE WHEN (read_id*31+s.i*17) % 53 = 0 THEN 2 WHEN s.p % 100 = 17 AND read_id % 2 = 0 THEN 1 ELSE 0 END) % 4 AS INT), 1)), '') AS seq
FROM dense0 d""")
_v("cigtok", ["dense"], """SELECT read_id, ref_idx, pos, CAST(generate_subscripts(l,1)-1 AS INT) AS k, unnest(l) AS tok
FROM (SELECT *, regexp_extract_all(cigar,'[0-9]+[MIDNSHP=X]') AS l FROM dense) z""")
_v("ops", ["cigtok"], """SELECT read_id, ref_idx, pos, k, op, n,
 CAST(pos + coalesce(sum(CASE WHEN op IN ('M','D','N','=','X') THEN n ELSE 0 END) OVER w,0) AS BIGINT) AS ref_start,
 CAST(coalesce(sum(CASE WHEN op IN ('M','I','S','=','X') THEN n ELSE 0 END) OVER w,0) AS BIGINT) AS read_off
FROM (SELECT read_id, ref_idx, pos, k, regexp_extract(tok,'([A-Z=])$',1) AS op,
      CAST(regexp_extract(tok,'^([0-9]+)',1) AS BIGINT) AS n FROM cigtok) t
WINDOW w AS (PARTITION BY read_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
_v("opx", ["ops"], "SELECT *, unnest(range(0,n)) AS j FROM ops WHERE op IN ('M','=','X')")
_v("bases", ["opx", "dense"], """SELECT o.read_id, o.ref_idx, o.ref_start + o.j AS ref_pos, CAST(o.read_off + o.j AS INT) AS cyc,
 substr(d.seq, CAST(o.read_off+o.j+1 AS INT), 1) AS base,
 CAST(ascii(substr(d.qual, CAST(o.read_off+o.j+1 AS INT),1))-33 AS INT) AS q,
 substr('ACGT', CAST(1 + (((o.ref_start+o.j)*(o.ref_start+o.j) + 3*(o.ref_start+o.j) + o.ref_idx) % 7 + (o.ref_start+o.j)) % 4 AS INT), 1) AS ref_base
FROM opx o JOIN dense d ON o.read_id=d.read_id""")
_v("known_sites", ["bases"], "SELECT DISTINCT ref_idx, ref_pos FROM bases WHERE ref_pos % 200 = 17")
_v("x_regions", ["kept"], """SELECT ref_idx, n_reads, CAST((rk-1) % 4 AS INT) AS region FROM (
 SELECT ref_idx, n_reads, row_number() OVER (ORDER BY n_reads DESC, ref_idx) AS rk
 FROM (SELECT ref_idx, count(*) AS n_reads FROM kept GROUP BY ref_idx) a) b""")
_v("x_padded", ["isl"], """SELECT ref_idx, min(pstart) AS start_pos, max(end_pos) AS end_pos FROM (
 SELECT *, sum(brk) OVER (PARTITION BY ref_idx ORDER BY start_pos, end_pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS g FROM (
  SELECT *, greatest(start_pos - 100, 1) AS pstart, CASE WHEN start_pos - 100 < max(end_pos) OVER (PARTITION BY ref_idx ORDER BY start_pos, end_pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS brk
  FROM isl) x) y
GROUP BY ref_idx, g""")
_v("x_intersect", ["bed", "isl"], """SELECT b.bed_id, i.ref_idx, greatest(b.bstart, i.start_pos-1) AS istart, least(b.bend, i.end_pos) AS iend
FROM bed b JOIN isl i ON b.ref_idx=i.ref_idx AND b.bstart < i.end_pos AND i.start_pos-1 < b.bend""")
_v("x_restrict", ["kept", "bed"], """SELECT k.read_id, k.ref_idx, k.pos, k.end_pos FROM kept k
WHERE EXISTS (SELECT 1 FROM bed b WHERE b.ref_idx=k.ref_idx AND b.bstart < k.end_pos AND k.pos-1 < b.bend)""")
_v("scored", ["kept"], """SELECT *, CAST(list_sum(list_transform(list_transform(string_split(qual,''), lambda c: ascii(c)-33), lambda x: CASE WHEN x>=15 THEN x ELSE 0 END)) AS BIGINT) AS score FROM kept""")
_v("x_dup", ["scored"], """SELECT read_id, CAST(CASE WHEN row_number() OVER (PARTITION BY ref_idx, flag & 16,
  CASE WHEN (flag & 16)=0 THEN pos - lead_clip ELSE end_pos + trail_clip END ORDER BY score DESC, qname) > 1 THEN 1 ELSE 0 END AS INT) AS dup
FROM (SELECT *, CAST(coalesce(nullif(regexp_extract(cigar,'^([0-9]+)[SH]',1),''),'0') AS BIGINT) AS lead_clip,
 CAST(coalesce(nullif(regexp_extract(cigar,'([0-9]+)[SH]$',1),''),'0') AS BIGINT) AS trail_clip FROM scored) z""")
_v("paired", ["kept"], """SELECT read_id, qname,
  CAST(1 + 64 + (flag & 16) + CASE WHEN (flag & 16) = 0 THEN 32 ELSE 0 END + CASE WHEN read_id % 11 = 0 THEN 8 ELSE 0 END AS INT) AS flag,
  ref_idx, pos, mapq, cigar, ref_len, seq, qual, end_pos FROM kept
UNION ALL
SELECT read_id + 1000000000, qname,
  CAST(1 + 128 + (16 - (flag & 16)) + CASE WHEN (flag & 16) = 16 THEN 32 ELSE 0 END + CASE WHEN read_id % 11 = 0 THEN 4 ELSE 0 END AS INT),
  ref_idx, pos + 150 + (read_id % 7) * 10, mapq, '32M', CAST(32 AS BIGINT), reverse(seq), reverse(qual),
  pos + 150 + (read_id % 7) * 10 + 31 FROM kept
UNION ALL
SELECT read_id + 2000000000, qname,
  CAST(1 + 64 + 256 + (flag & 16) + CASE WHEN (flag & 16) = 0 THEN 32 ELSE 0 END AS INT),
  ref_idx, pos + 5000, mapq, cigar, ref_len, seq, qual, end_pos + 5000 FROM kept WHERE read_id % 13 = 0""")
_v("x_dup_paired", ["paired"], """WITH x AS (
 SELECT *, CASE WHEN (flag & 16) = 0 THEN pos - CAST(coalesce(nullif(regexp_extract(cigar,'^([0-9]+)[SH]',1),''),'0') AS BIGINT)
   ELSE end_pos + CAST(coalesce(nullif(regexp_extract(cigar,'([0-9]+)[SH]$',1),''),'0') AS BIGINT) END AS p5,
  CAST(list_sum(list_transform(list_transform(string_split(qual,''), lambda c: ascii(c)-33), lambda v: CASE WHEN v>=15 THEN v ELSE 0 END)) AS BIGINT) AS score
 FROM paired),
prim AS (SELECT * FROM x WHERE (flag & 2304) = 0),
e AS (SELECT qname, read_id, score, ref_idx AS r, p5 AS p, flag & 16 AS s,
  row_number() OVER (PARTITION BY qname ORDER BY ref_idx, p5, flag & 16, read_id) AS rn,
  count(*) OVER (PARTITION BY qname) AS n
 FROM prim WHERE (flag & 1) <> 0 AND (flag & 4) = 0 AND (flag & 8) = 0),
t AS (SELECT qname, sum(score) AS sc,
  max(CASE WHEN rn = 1 THEN r END) AS r1, max(CASE WHEN rn = 1 THEN p END) AS p1, max(CASE WHEN rn = 1 THEN s END) AS s1,
  max(CASE WHEN rn = 2 THEN r END) AS r2, max(CASE WHEN rn = 2 THEN p END) AS p2, max(CASE WHEN rn = 2 THEN s END) AS s2,
  max(CASE WHEN rn = 1 THEN read_id END) AS id1, max(CASE WHEN rn = 2 THEN read_id END) AS id2
 FROM e WHERE n = 2 GROUP BY qname),
tr AS (SELECT *, row_number() OVER (PARTITION BY r1, p1, s1, r2, p2, s2 ORDER BY sc DESC, qname) AS k FROM t),
td AS (SELECT id1 AS read_id, CASE WHEN k > 1 THEN 1 ELSE 0 END AS dup FROM tr
       UNION ALL SELECT id2, CASE WHEN k > 1 THEN 1 ELSE 0 END FROM tr),
pe AS (SELECT r1 AS r, p1 AS p, s1 AS s FROM t UNION SELECT r2, p2, s2 FROM t),
fr AS (SELECT * FROM prim WHERE (flag & 4) = 0 AND read_id NOT IN (SELECT read_id FROM td)),
fd AS (SELECT read_id, CASE WHEN EXISTS (SELECT 1 FROM pe WHERE pe.r = fr.ref_idx AND pe.p = fr.p5 AND pe.s = (fr.flag & 16)) THEN 1
   WHEN row_number() OVER (PARTITION BY ref_idx, p5, flag & 16 ORDER BY score DESC, qname, read_id) > 1 THEN 1 ELSE 0 END AS dup FROM fr)
SELECT x.read_id, CAST(coalesce(td.dup, fd.dup, 0) AS INT) AS dup
FROM x LEFT JOIN td USING (read_id) LEFT JOIN fd USING (read_id)""")
_v("x_indel", ["ops"], """SELECT ref_idx, ref_start-1 AS start0, CAST(ref_start-1+CASE WHEN op='D' THEN n ELSE 1 END AS BIGINT) AS end0, op, count(*) AS support
FROM ops WHERE op IN ('I','D') GROUP BY ref_idx, ref_start, op, n""")
_v("x_pileup", ["bases"], """SELECT ref_idx, ref_pos, ref_base, base, count(*) AS depth, CAST(sum(q) AS BIGINT) AS qsum
FROM bases GROUP BY ref_idx, ref_pos, ref_base, base""")
_v("x_recal", ["bases", "known_sites"], """SELECT q AS reported_q, cyc, count(*) AS obs, CAST(sum(CASE WHEN base<>ref_base THEN 1 ELSE 0 END) AS BIGINT) AS mism,
 CAST(round(-10*log10((sum(CASE WHEN base<>ref_base THEN 1 ELSE 0 END)+1)/(count(*)+2e0))) AS INT) AS emp_q
FROM bases b WHERE NOT EXISTS (SELECT 1 FROM known_sites k WHERE k.ref_idx=b.ref_idx AND k.ref_pos=b.ref_pos)
GROUP BY q, cyc""")
_v("x_recal_region", ["bases", "known_sites", "x_regions"], """SELECT r.region, b.q AS reported_q, b.cyc, count(*) AS obs,
 CAST(sum(CASE WHEN b.base <> b.ref_base THEN 1 ELSE 0 END) AS BIGINT) AS mism,
 CAST(round(-10*log10((sum(CASE WHEN b.base <> b.ref_base THEN 1 ELSE 0 END)+1)/(count(*)+2e0))) AS INT) AS emp_q
FROM bases b JOIN x_regions r USING (ref_idx)
WHERE NOT EXISTS (SELECT 1 FROM known_sites k WHERE k.ref_idx = b.ref_idx AND k.ref_pos = b.ref_pos)
GROUP BY r.region, b.q, b.cyc""")
_v("x_calls", ["x_pileup"], """SELECT ref_idx, ref_pos, ref_base, base AS alt, qsum AS qual, depth AS ad, dp, CASE WHEN depth*5 >= dp*4 THEN '1/1' ELSE '0/1' END AS gt
FROM (SELECT *, CAST(sum(depth) OVER (PARTITION BY ref_idx, ref_pos) AS BIGINT) AS dp,
  row_number() OVER (PARTITION BY ref_idx, ref_pos ORDER BY CASE WHEN base=ref_base THEN 1 ELSE 0 END, qsum DESC, base) AS rk FROM x_pileup) t
WHERE rk=1 AND base<>ref_base AND qsum>=30 AND depth*5>=dp""")
_v("calls_vcf", ["x_calls", "seq_dict"], """SELECT c.ref_idx, c.ref_pos, concat_ws(chr(9), s.ref_name, CAST(c.ref_pos AS VARCHAR), '.', c.ref_base, c.alt,
  CAST(c.qual AS VARCHAR), 'PASS', 'DP=' || CAST(c.dp AS VARCHAR), 'GT:AD', c.gt || ':' || CAST(c.ad AS VARCHAR)) AS line
FROM x_calls c JOIN seq_dict s USING (ref_idx)""")
_v("squal", ["kept"], """SELECT *, CASE WHEN read_id % 7 = 3 THEN qual
  ELSE array_to_string(list_transform(string_split(qual, ''), lambda c: chr(ascii(c) + 31)), '') END AS squal FROM kept""")
_v("x_encoding", ["squal"], """SELECT ref_idx, read_id AS first_read_id, max_q,
  CASE WHEN max_q <= 60 THEN 'SANGER' ELSE 'ILLUMINA' END AS encoding FROM (
 SELECT ref_idx, read_id, list_max(list_transform(string_split(squal, ''), lambda c: ascii(c) - 33)) AS max_q,
  row_number() OVER (PARTITION BY ref_idx ORDER BY pos, read_id) AS rk FROM squal) t WHERE rk = 1""")


def _on(view: str, **names: str) -> tuple[list[str], str]:
    """A view's definition over other inputs: each name replaced as a whole word."""
    deps, sql = VIEWS[view]
    for old, new in names.items():
        sql = re.sub(rf"\b{old}\b", new, sql)
    return [names.get(d, d) for d in deps], sql


# the whole variant job over ``dense``: duplicates leave before bases are counted, and the
# pileup sees recalibrated qualities
_v("j_scored", *_on("scored", kept="dense"))
_v("j_dup", *_on("x_dup", scored="j_scored"))
_v("j_dense", ["dense", "j_dup"], "SELECT d.* FROM dense d JOIN j_dup USING (read_id) WHERE dup = 0")
_v("j_cigtok", *_on("cigtok", dense="j_dense"))
_v("j_ops", *_on("ops", cigtok="j_cigtok"))
_v("j_opx", *_on("opx", ops="j_ops"))
_v("j_bases", *_on("bases", opx="j_opx", dense="j_dense"))
_v("j_recal", *_on("x_recal", bases="j_bases"))
_v("j_pileup", ["j_bases", "j_recal"], """SELECT ref_idx, ref_pos, ref_base, base, count(*) AS depth, CAST(sum(coalesce(r.emp_q, b.q)) AS BIGINT) AS qsum
FROM j_bases b LEFT JOIN j_recal r ON r.reported_q = b.q AND r.cyc = b.cyc GROUP BY ref_idx, ref_pos, ref_base, base""")
_v("j_calls", *_on("x_calls", x_pileup="j_pileup"))
_v("j_vcf", *_on("calls_vcf", x_calls="j_calls"))


def with_views(names: list[str], body: str) -> str:
    """``WITH`` the named views and their dependencies (dependency order), then ``body``."""
    order: list[str] = []

    def add(n: str) -> None:
        if n in order:
            return
        for dep in VIEWS[n][0]:
            add(dep)
        order.append(n)

    for n in names:
        add(n)
    ctes = ",\n".join(f"{n} AS (\n{VIEWS[n][1]}\n)" for n in order)
    return f"WITH {ctes}\n{body}"


def _q() -> dict[str, str]:
    W = with_views
    q: dict[str, str] = {}
    q["primary_mapped"] = W(["aln"], """SELECT read_id, qname, flag, ref_idx, pos, mapq, cigar, ref_len, seq, qual
FROM aln WHERE (flag & 4) = 0 AND ref_idx > 0 AND ref_idx <= 24""")
    q["reads_per_chrom"] = W(["kept"], "SELECT ref_idx, count(*) AS n_reads FROM kept GROUP BY ref_idx")
    q["balance_regions"] = W(["x_regions"], "SELECT ref_idx, n_reads, region FROM x_regions")
    q["region_reads"] = W(["kept", "x_regions"], """SELECT k.read_id, k.ref_idx, k.pos, r.region
FROM kept k JOIN x_regions r USING (ref_idx)""")
    q["fastq_records"] = W(["aln"], """SELECT read_id AS record_id, concat('@r', CAST(read_id AS VARCHAR), '/1') AS name,
 seq, '+' AS plus, qual FROM aln""")
    q["mate_pairs"] = W(["aln", "aln2"], """SELECT a.read_id AS record_id,
 concat('@r', CAST(a.read_id AS VARCHAR), '/1') AS name1, a.seq AS seq1, '+' AS plus1, a.qual AS qual1,
 concat('@r', CAST(b.read_id AS VARCHAR), '/2') AS name2, b.seq AS seq2, '+' AS plus2, b.qual AS qual2
FROM aln a JOIN aln2 b ON a.read_id = b.read_id""")
    q["fastq_chunks"] = W(["aln", "aln2"], """SELECT CAST(a.read_id * 4 // (SELECT count(*) FROM aln) AS INT) AS chunk,
 a.read_id AS record_id,
 concat_ws(chr(10), concat('@r', CAST(a.read_id AS VARCHAR), '/1'), a.seq, '+', a.qual,
   concat('@r', CAST(b.read_id AS VARCHAR), '/2'), b.seq, '+', b.qual) AS value
FROM aln a JOIN aln2 b ON a.read_id = b.read_id""")
    q["alignment_end"] = W(["kept"], """SELECT read_id, ref_idx, pos, cigar, ref_len AS aligned_len, end_pos FROM kept""")
    q["covered_ranges"] = W(["isl"], "SELECT ref_idx, start_pos, end_pos, n_reads FROM isl")
    q["padded_ranges"] = W(["x_padded"], "SELECT ref_idx, CAST(start_pos AS BIGINT) AS start_pos, end_pos FROM x_padded")
    q["range_span"] = W(["isl", "seq_dict"], """SELECT i.ref_idx, s.ref_name, min(i.start_pos) AS first_start,
 CAST(max(CASE WHEN i.rk = 1 THEN i.end_pos END) AS BIGINT) AS last_end, count(*) AS n_ranges,
 concat(CAST(count(*) AS VARCHAR), 'regions_', s.ref_name, '-', CAST(min(i.start_pos) AS VARCHAR)) AS label
FROM (SELECT *, row_number() OVER (PARTITION BY ref_idx ORDER BY start_pos DESC, end_pos DESC) AS rk FROM isl) i
JOIN seq_dict s USING (ref_idx) GROUP BY i.ref_idx, s.ref_name""")
    q["ranges_bed"] = W(["isl", "seq_dict"], """SELECT s.ref_name AS chrom, i.start_pos - 1 AS bed_start, i.end_pos - 1 AS bed_end
FROM isl i JOIN seq_dict s USING (ref_idx)""")
    q["ranges_region_strings"] = W(["isl", "seq_dict"], """SELECT i.ref_idx,
 concat(s.ref_name, ':', CAST(i.start_pos AS VARCHAR), '-', CAST(i.end_pos AS VARCHAR)) AS region_string
FROM isl i JOIN seq_dict s USING (ref_idx)""")
    q["interval_intersect"] = W(["x_intersect"], "SELECT bed_id, ref_idx, istart, iend FROM x_intersect")
    q["interval_restrict"] = W(["x_restrict"], "SELECT read_id, ref_idx, pos, end_pos FROM x_restrict")
    q["parse_sam"] = W(["aln", "seq_dict"], """SELECT a.qname, a.flag, s.ref_name, a.ref_idx, a.pos, a.mapq, a.cigar, a.seq, a.qual
FROM aln a LEFT JOIN seq_dict s USING (ref_idx) WHERE a.read_id % 50 NOT IN (7, 13)""")
    q["sam_rejects"] = W(["aln", "seq_dict"], """SELECT
 CASE WHEN read_id % 50 = 7 THEN concat_ws(chr(9), qname, CAST(flag AS VARCHAR), ref_name, CAST(pos AS VARCHAR), CAST(mapq AS VARCHAR), cigar)
      ELSE concat_ws(chr(9), qname, 'X', ref_name, CAST(pos AS VARCHAR), CAST(mapq AS VARCHAR), cigar, '*', '0', '0', seq, qual)
 END AS corrupt_line
FROM aln a LEFT JOIN seq_dict s USING (ref_idx) WHERE read_id % 50 IN (7, 13)""")
    q["parse_dict"] = W(["seq_dict"], """SELECT ref_idx, ref_name, CASE WHEN ref_name = 'chrUn' THEN 0 ELSE ref_length END AS ref_length
FROM seq_dict""")
    vcf_contigs = """SELECT CASE WHEN ref_name = 'chrX' THEN 23 WHEN ref_name = 'chrY' THEN 24
  ELSE TRY_CAST(substr(ref_name, 4) AS INT) END AS chrom, 1 AS pos,
 concat_ws(chr(9), ref_name, '1', '.', 'N', '.', '0', 'PASS', '.') AS line FROM seq_dict"""
    q["parse_vcf"] = W(["calls_vcf", "seq_dict"], f"""SELECT CAST(ref_idx AS INT) AS chrom, CAST(ref_pos AS INT) AS pos, line FROM calls_vcf
UNION ALL
SELECT * FROM ({vcf_contigs}) c WHERE chrom IS NOT NULL""")
    q["vcf_rejects"] = W(["seq_dict"], f"SELECT line FROM ({vcf_contigs}) c WHERE chrom IS NULL")
    q["quality_encoding"] = W(["x_encoding"], "SELECT ref_idx, first_read_id, max_q, encoding FROM x_encoding")
    q["fix_qualities"] = W(["squal", "x_encoding"], """SELECT read_id, ref_idx,
 CASE WHEN e.encoding <> 'ILLUMINA' THEN squal WHEN bad THEN NULL ELSE
   array_to_string(list_transform(string_split(squal, ''), lambda c: chr(ascii(c) - 31)), '') END AS qual,
 CASE WHEN e.encoding = 'ILLUMINA' AND bad THEN true ELSE false END AS quality_error
FROM (SELECT *, list_min(list_transform(string_split(squal, ''), lambda c: ascii(c) - 33 - 31)) < 0 AS bad FROM squal) s
JOIN x_encoding e USING (ref_idx)""")
    q["with_reference"] = W(["kept", "seq_dict"], """SELECT k.read_id, k.ref_idx, s.ref_name, s.ref_length, k.pos
FROM kept k LEFT JOIN seq_dict s USING (ref_idx)""")
    q["read_groups"] = W(["kept"], """SELECT read_id, 'GROUP1' AS rg_id, 'LIB1' AS rg_library, 'ILLUMINA' AS rg_platform,
 'UNIT1' AS rg_unit, 'SAMPLE1' AS rg_sample FROM kept""")
    q["kept_per_chunk"] = W(["aln"], """SELECT CAST(read_id % 4 AS INT) AS chunk, count(*) AS n_reads,
 count(*) FILTER (WHERE (flag & 4) = 0 AND ref_idx > 0 AND ref_idx <= 24) AS n_kept
FROM aln GROUP BY 1""")
    q["coordinate_sort"] = W(["kept", "x_regions"], """SELECT k.read_id, r.region, k.ref_idx, k.pos,
 CAST(row_number() OVER (PARTITION BY r.region ORDER BY k.ref_idx, k.pos, k.qname) AS BIGINT) AS rank
FROM kept k JOIN x_regions r USING (ref_idx)""")
    q["mark_duplicates"] = W(["x_dup"], "SELECT read_id, dup FROM x_dup")
    q["mark_duplicates_paired"] = W(["x_dup_paired"], "SELECT read_id, dup FROM x_dup_paired")
    q["duplicate_metrics"] = W(["x_dup", "kept", "x_regions"], """SELECT r.region, 'LIB1' AS library, count(*) AS reads,
 CAST(sum(d.dup) AS BIGINT) AS duplicates,
 CAST((sum(d.dup) * 2000 + count(*)) // (count(*) * 2) AS BIGINT) AS dup_permille
FROM x_dup d JOIN kept k USING (read_id) JOIN x_regions r USING (ref_idx) GROUP BY r.region""")
    q["cigar_ops"] = W(["ops"], "SELECT read_id, ref_idx, pos, k, op, n, ref_start, read_off FROM ops")
    q["clean_alignments"] = W(["ops", "dense"], """SELECT read_id, pos, mapq,
 CASE WHEN clipped > 0 AND pos <= 2990 THEN body || CAST(clipped AS VARCHAR) || 'S' ELSE cigar END AS cigar,
 CAST(CASE WHEN clipped > 0 AND pos <= 2990 THEN pos + body_ref - 1 ELSE end_pos END AS BIGINT) AS end_pos
FROM (
 SELECT c.read_id, d.pos, d.mapq, d.cigar, d.end_pos,
  sum(CASE WHEN op IN ('M','I','S','=','X') THEN n - kn ELSE 0 END) AS clipped,
  string_agg(CASE WHEN kn > 0 AND NOT (op IN ('D','N','S') AND k > last_q) THEN CAST(kn AS VARCHAR) || op END, '' ORDER BY k) AS body,
  sum(CASE WHEN kn > 0 AND op IN ('M','=','X','D','N') AND NOT (op IN ('D','N') AND k > last_q) THEN kn ELSE 0 END) AS body_ref
 FROM (
  SELECT *, max(CASE WHEN kn > 0 AND op IN ('M','=','X','I') THEN k END) OVER (PARTITION BY read_id) AS last_q FROM (
   SELECT o.*, CASE WHEN op IN ('M','D','N','=','X') THEN greatest(0, least(n, lim - (ref_start - pos)))
     WHEN op = 'H' THEN n WHEN ref_start - pos < lim THEN n ELSE 0 END AS kn
   FROM (SELECT *, 2990 - pos + 1 AS lim FROM ops) o) a) c
 JOIN dense d USING (read_id)
 GROUP BY c.read_id, d.pos, d.mapq, d.cigar, d.end_pos) t""")
    q["indel_targets"] = W(["x_indel"], """SELECT ref_idx, min(start0) AS start0, max(end0) AS end0, CAST(sum(support) AS BIGINT) AS support FROM (
 SELECT *, sum(brk) OVER (PARTITION BY ref_idx ORDER BY start0, end0, op ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS g FROM (
  SELECT *, CASE WHEN start0 <= max(end0) OVER (PARTITION BY ref_idx ORDER BY start0, end0, op ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS brk
  FROM x_indel) a) b
GROUP BY ref_idx, g""")
    q["pileup"] = W(["x_pileup"], "SELECT ref_idx, ref_pos, ref_base, base, depth, qsum FROM x_pileup")
    q["recal_table"] = W(["x_recal"], "SELECT reported_q, cyc, obs, mism, emp_q FROM x_recal")
    q["recal_table_by_region"] = W(["x_recal_region"],
                                   "SELECT region, reported_q, cyc, obs, mism, emp_q FROM x_recal_region")
    q["recal_apply_by_region"] = W(["dense", "bases", "x_recal_region", "x_regions"], """SELECT p.read_id,
 string_agg(chr(CAST(CASE WHEN b.read_id IS NOT NULL AND r.emp_q IS NOT NULL THEN r.emp_q
   ELSE ascii(substr(p.qual, p.i + 1, 1)) - 33 END + 33 AS INT)), '' ORDER BY p.i) AS qual
FROM (SELECT d.read_id, d.qual, g.region, unnest(range(0, length(d.qual))) AS i
      FROM dense d JOIN x_regions g USING (ref_idx)) p
LEFT JOIN bases b ON b.read_id = p.read_id AND b.cyc = p.i
LEFT JOIN x_recal_region r ON r.region = p.region AND r.reported_q = b.q AND r.cyc = b.cyc
GROUP BY p.read_id""")
    q["recal_apply"] = W(["dense", "bases", "x_recal"], """SELECT p.read_id,
 string_agg(chr(CAST(CASE WHEN b.read_id IS NOT NULL AND r.emp_q IS NOT NULL THEN r.emp_q
   ELSE ascii(substr(p.qual, p.i + 1, 1)) - 33 END + 33 AS INT)), '' ORDER BY p.i) AS qual
FROM (SELECT read_id, qual, unnest(range(0, length(qual))) AS i FROM dense) p
LEFT JOIN bases b ON b.read_id = p.read_id AND b.cyc = p.i
LEFT JOIN x_recal r ON r.reported_q = b.q AND r.cyc = b.cyc
GROUP BY p.read_id""")
    q["call_variants"] = W(["x_calls"], "SELECT ref_idx, ref_pos, ref_base, alt, qual, ad, dp, gt FROM x_calls")
    q["merge_variants"] = W(["calls_vcf"], "SELECT CAST(ref_idx AS INT) AS chrom, CAST(ref_pos AS INT) AS pos, line FROM calls_vcf")
    q["map_chunks"] = W(["kept"], """SELECT CAST(read_id % 4 AS INT) AS chunk, ref_idx, count(*) AS n_reads
FROM kept GROUP BY 1, 2""")
    q["map_chunk_streams"] = W(["kept"], """SELECT chunk, count(*) AS n_reads, count(*) FILTER (was <> ref_idx) AS n_changes FROM (
 SELECT CAST(read_id % 4 AS INT) AS chunk, ref_idx, lag(ref_idx) OVER (PARTITION BY read_id % 4 ORDER BY read_id) AS was FROM kept) x
GROUP BY chunk""")
    q["map_regions_halo"] = W(["kept"], """SELECT read_id, ref_idx, pos, count(*) OVER (PARTITION BY ref_idx ORDER BY pos
 RANGE BETWEEN 100 PRECEDING AND 100 FOLLOWING) - 1 AS n_near FROM kept""")
    q["balance_loci"] = W(["kept"], """SELECT region, count(*) AS n_reads, min(ref_idx) AS first_ref, min_by(pos, ref_idx * 10000000000 + pos) AS first_pos,
 max(ref_idx) AS last_ref, max_by(pos, ref_idx * 10000000000 + pos) AS last_pos FROM (
 SELECT ref_idx, pos, CAST(least(floor((upto - load / 2.0) * 40 / t), 39) AS INT) AS region FROM (
  SELECT *, count(*) OVER (ORDER BY ref_idx, cell, spot) AS upto, count(*) OVER (PARTITION BY ref_idx, cell, spot) AS load FROM (
   SELECT *, CASE WHEN count(*) OVER (PARTITION BY ref_idx, cell) > 0.2 * t / 40 THEN pos END AS spot FROM (
    SELECT ref_idx, pos, (pos - 1) // 4096 AS cell, count(*) OVER () AS t FROM kept) a) b) c) d
GROUP BY region""")
    q["padded_ranges_by_name"] = W(["isl", "seq_dict"], """SELECT CASE WHEN first_pos % 2 = 1 THEN upper(ref_name) ELSE ref_name END AS ref_name,
 CAST(greatest(first_pos - 100, 1) AS BIGINT) AS start_pos, end_pos FROM (
 SELECT ref_idx, min(start_pos) AS first_pos, max(end_pos) AS end_pos FROM (
  SELECT *, sum(brk) OVER (PARTITION BY ref_idx ORDER BY start_pos, end_pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS g FROM (
   SELECT *, CASE WHEN start_pos - 100 < max(end_pos) OVER (PARTITION BY ref_idx ORDER BY start_pos, end_pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS brk
   FROM isl) x) y
 GROUP BY ref_idx, g) z JOIN seq_dict USING (ref_idx)""")
    q["variant_job"] = W(["j_vcf", "x_regions"], """SELECT r.region, CAST(v.ref_idx AS INT) AS chrom, CAST(v.ref_pos AS INT) AS pos, v.line
FROM j_vcf v JOIN x_regions r USING (ref_idx)""")
    q["fastq_file_records"] = W(["aln"], """SELECT concat('@r', CAST(read_id AS VARCHAR), '/1') AS name,
 seq, '+' AS plus, qual FROM aln""")
    q["chunk_files"] = W(["aln", "aln2"], """SELECT CAST(a.read_id * 4 // (SELECT count(*) FROM aln) AS INT) AS chunk,
 concat('@r', CAST(a.read_id AS VARCHAR), '/1') AS name1, a.seq AS seq1, a.qual AS qual1,
 concat('@r', CAST(b.read_id AS VARCHAR), '/2') AS name2, b.seq AS seq2, b.qual AS qual2
FROM aln a JOIN aln2 b ON a.read_id = b.read_id""")
    q["vcf_ordered"] = W(["calls_vcf"], """SELECT CAST(0 AS BIGINT) AS idx, '##fileformat=VCFv4.2' AS line
UNION ALL
SELECT row_number() OVER (ORDER BY CAST(ref_idx AS INT), CAST(ref_pos AS INT), line) AS idx, line FROM calls_vcf""")
    q["by_region"] = q["region_reads"]
    q["overwrite_published"] = q["covered_ranges"]
    q["map_regions"] = W(["kept", "x_regions"], """SELECT r.region, k.ref_idx, count(*) AS n_reads, min(k.pos) AS first_pos,
 max(k.pos) AS last_pos FROM kept k JOIN x_regions r USING (ref_idx) GROUP BY r.region, k.ref_idx""")
    return q


ORACLE_SQL = _q()
