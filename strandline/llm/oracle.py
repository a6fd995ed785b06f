"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

#: Payload digests in base32: 40 hex digits are 8 groups of 20 bits, each 4 letters.
_BASE32 = "list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', " \
          "((('0x' || substr(sha, 5 * (i // 4)::BIGINT + 1, 5))::BIGINT >> (15 - 5 * (i % 4))::INTEGER) & 31)::BIGINT + 1, 1)), 'string_agg', '')"

#: A-Z in lower case and nothing else.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: CRC-32 of a word by its table: 256 entries by eight steps of the polynomial, then a fold over the bytes.
_CRC_TABLE = """
    crc_bytes as (select i, list_reduce(list_prepend(i, range(0, 8)), lambda a, step: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end) as c
                  from (select unnest(range(0, 256)) as i)),
    crc_table as (select list(c order by i) as t from crc_bytes)"""
_CRC = """xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(1, 2 * strlen(word), 2),
            lambda i: ('0x' || substr(hex(encode(word)), i, 2))::bigint)),
            lambda a, b: xor(a >> 8, t[xor(a & 255, b) + 1])), 4294967295)"""

ORACLE_SQL = {
    "op5_warc": f"""
        with p as (select page_id, coalesce(html, '') as body from pages),
        d as (select page_id, strlen(body) as payload_bytes, sha1(body) as sha from p),
        f as (select sha, min(page_id) as first from d group by sha)
        select page_id, payload_bytes, {_BASE32} as payload_digest,
               case when page_id is not distinct from first or first is null then 'response' else 'revisit' end as record_type,
               case when page_id is distinct from first and first is not null then first end as refers_to
        from d join f using (sha)""",
    "op11_source_divergence": f"""
        with d as (select coalesce(lang, '') as lang, coalesce(source, '') as source, {_LOWER} as body, row_number() over () as doc from documents),
        w as (select lang, source, doc, unnest(regexp_extract_all(body, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term from d),
        kept as (select lang, term, count(*) as n from w group by all having count(distinct doc) >= 10),
        vocab as (select lang, count(*) as v, sum(n)::bigint as total from kept group by all),
        own as (select lang, source, term, count(*) as n from w semi join kept using (lang, term) group by all),
        grp as (select distinct lang, source from d),
        tot as (select lang, source, coalesce(sum(n), 0)::bigint as total from grp left join own using (lang, source) group by all),
        p as (select lang, g.source, k.term, coalesce(o.n, 0) as n, 1 + 1000000000::bigint * (coalesce(o.n, 0) + 2) // (t.total + 2 * v.v) as p
              from grp g join kept k using (lang) join vocab v using (lang) join tot t using (lang, source)
              left join own o on o.lang = g.lang and o.source = g.source and o.term = k.term),
        pairs as (select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p))::bigint as value
                  from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
        allpairs as (select a.lang, a.source, b.source as item, coalesce(value, 0) as value
                     from grp a join grp b on a.lang = b.lang and a.source <> b.source
                     left join pairs x on x.lang = a.lang and x.source = a.source and x.item = b.source),
        q as (select lang, term, 1 + 1000000000::bigint * (n + 2) // (total + 2 * v) as q from kept join vocab using (lang)),
        terms as (select lang, source, term as item, (p - q) * (p - q) // (p + q) as value from p join q using (lang, term) where n > 0 and p > q)
        select lang, source, 'pair' as part, item, value::bigint as value, (row_number() over (partition by lang, source order by value desc, item))::int as rank from allpairs
        union all
        select lang, source, 'term', item, value::bigint, rank::int from
            (select *, row_number() over (partition by lang, source order by value desc, item) as rank from terms) where rank <= 10""",
    "op12_importance_resampling": f"""
        with d as (select doc_id, row_number() over () as doc, {_LOWER} as body from documents),
        texts as (select doc, body from d union all select -row_number() over (), {_LOWER} from benchmark),
        w as (select doc, unnest(regexp_extract_all(body, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) as word from texts), {_CRC_TABLE},
        words as (select word, {_CRC} % 10000 as bucket from (select distinct word from w), crc_table),
        f as (select doc, bucket, count(*) as n from w join words using (word) group by all),
        s as (select bucket, coalesce(sum(n) filter (doc > 0), 0) as s, coalesce(sum(n) filter (doc < 0), 0) as t from f group by all),
        total as (select coalesce(sum(s), 0) as s_all, coalesce(sum(t), 0) as t_all from s),
        gain as (select bucket, floor(1000 * ln(((t + 1)::double * (s_all + 10000)::double) / ((s + 1)::double * (t_all + 10000)::double)))::bigint as gain from s, total),
        weights as (select doc_id, doc, coalesce(sum(n), 0)::bigint as n_features, coalesce(sum(n * gain), 0)::bigint as weight
                    from d left join f using (doc) left join gain using (bucket) group by all),
        scored as (select *, weight + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::bigint + 0.5::double) / 4294967296)))::bigint as score from weights),
        fit as (select doc, row_number() over (order by score desc, doc_id) as rank, count(*) over () as n from scored where n_features >= 20)
        select doc_id, n_features, weight, score, case when rank <= 10 * n // 100 then rank end as rank from scored left join fit using (doc)""",
}
