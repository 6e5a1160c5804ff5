"""Queries and SQL of this subpackage, for the driver module."""

from __future__ import annotations

from commerce_marts.llm import queries as q
from commerce_marts.llm.common import ship


def _shipped(query):
    def run(spark, sf_dir):
        ship(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {f.__name__: _shipped(f) for f in (
    q.op2_substring_dedup,
    q.op3_budget_mixing,
    q.op1_pii_surrogates,
    q.op4_ngram_jaccard_join,
    q.op5_string_kernel_toxicity,
    q.op6_block_max_topk,
    q.op7_best_fit_packing,
    q.op8_winnowing_fingerprints,
    q.op9_warc_boundary_chain,
    q.op10_katz_backoff,
    q.op11_collocation_mining,
    q.op12_secret_scan,
    q.op13_conversation_prefix_trie,
)}

#: Base32 of a SHA-1 in hex: five hex digits are twenty bits are four digits.
_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', "
    f"1 + ((('0x' || substr(h, {5 * g + 1}, 5))::BIGINT >> {s}) & 31)::INT, 1)"
    for g in range(8) for s in (15, 10, 5, 0))

#: Unsigned CRC-32 of the decimal digits of ``c``: a list of bytes, each with seven zeros behind
#: it, is folded a bit at a time.
_CRC32 = """xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
    string_split(c::VARCHAR, ''), lambda s: [ascii(s)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
    lambda a, b: xor(xor(a, b) // 2, 3988292384 * (xor(a, b) % 2))), 4294967295)"""

ORACLE_SQL: dict[str, str] = {
    "op6_block_max_topk": """
        with v as (select vec_id, list_transform(embedding,
                       lambda x: floor(1024 * x::DOUBLE)::BIGINT) as e from embeddings
                   where vec_id is not null and embedding is not null
                     and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        s as (select q.vec_id as query_id, c.vec_id,
                     list_sum(list_transform(list_zip(q.e, c.e),
                              lambda z: coalesce(z[1] * z[2], 0)))::BIGINT as score
              from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 100 = 0),
        r as (select *, row_number() over (partition by query_id
                     order by score desc, vec_id)::INT as rank from s)
        select query_id, rank, vec_id, score from r where rank <= 10""",
    "op9_warc_boundary_chain": f"""
        with p as (select page_id, coalesce(html, '') as html from pages),
        d as (select page_id, strlen(html)::BIGINT as payload_bytes, sha1(html) as h from p),
        b as (select page_id, payload_bytes, {_BASE32} as payload_digest,
                     max(page_id) over (partition by h) as last from d)
        select page_id, payload_bytes, payload_digest,
               case when page_id = last then 'response' else 'revisit' end as record_type,
               case when page_id = last then null else last end as refers_to from b""",
    "op13_conversation_prefix_trie": f"""
        with t as (select conv_id as c, turn, coalesce(role, '') as role, coalesce(text, '') as text
                   from conversations where conv_id is not null),
        d as (select c, turn, length(text) as chars,
                     md5(length(role) || ':' || role || text) as digest from t),
        o as (select *, row_number() over (partition by c order by turn nulls first, digest) as pos
              from d),
        h as (select distinct c, {_CRC32} % 6 as h from o),
        r as (select h.c, o.pos, o.digest, o.chars from h join o on o.c = h.c - h.c % 100
              where o.pos <= h.h
              union all select h.c, o.pos, o.digest, o.chars from h join o using (c) where o.pos > h.h),
        p as (select c, list(digest order by pos) as path, list(chars order by pos) as sizes
              from r group by c),
        m as (select h.c, coalesce(path, []) as path, coalesce(sizes, []) as sizes
              from h left join p using (c)),
        x as (select c, depth, path[:depth] as node, len(path) = depth as ends,
                     case when depth > 0 then sizes[depth] else 0 end as chars
              from (select *, unnest(range(len(path) + 1)) as depth from m)),
        n as (select node, depth, min(c) as c, count(*) as n_convs,
                     (count(*) - 1) * min(chars) as saved,
                     sha256(coalesce(string_agg(c::VARCHAR, ',' order by c) filter (ends), ''))
                         as ends_sha256
              from x group by node, depth),
        k as (select node[:depth - 1] as node, count(*) as n_children from n where depth > 0
              group by 1),
        a as (select node[:up] as node, sum(saved) as saved, sum(leaf) as leaves
              from (select n.node, saved, case when n_children is null then 1 else 0 end as leaf,
                           unnest(range(depth + 1)) as up from n left join k using (node))
              group by 1)
        select n.c::BIGINT as conv_id, n.depth::BIGINT as depth, u.c::BIGINT as parent_conv_id,
               n.n_convs::BIGINT as n_convs, coalesce(n_children, 0)::BIGINT as n_children,
               a.leaves::BIGINT as n_leaves, a.saved::BIGINT as saved_tokens, n.ends_sha256
        from n join a using (node) left join k using (node)
        left join n u on n.depth > 0 and u.depth = n.depth - 1 and u.node = n.node[:n.depth - 1]""",
    "op11_collocation_mining": """
        with d as (select coalesce(lang, 'und') as lang,
                          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz') as text from documents),
        p as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w
              from (select lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) as piece
                    from d)),
        q as (select lang, w, unnest(range(1, len(w) + 1)) as i from p),
        g as (select lang, w[i:i] as g from q
              union all select lang, w[i:i + 1] from q where i < len(w)
              union all select lang, w[i:i + 2] from q where i + 1 < len(w)),
        f as (select lang, array_to_string(g, ' ') as phrase, g, count(*) as c from g
              group by lang, g having c >= 10),
        n as (select lang, sum(len(w))::BIGINT as n from p group by lang),
        k as (select lang, phrase, c as a, cut, array_to_string(g[:cut], ' ') as head,
                     array_to_string(g[cut + 1:], ' ') as tail
              from (select *, unnest(range(1, len(g))) as cut from f)),
        s as (select k.lang, k.phrase, a, cut, x.c as l, y.c as r,
                     (1000000::HUGEINT * a * a) // (x.c::HUGEINT * y.c) as score
              from k join f x on x.lang = k.lang and x.phrase = k.head
                     join f y on y.lang = k.lang and y.phrase = k.tail),
        b as (select * from s
              qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
        o as (select lang, phrase, max(c) as longer
              from (select lang, unnest([array_to_string(g[1:2], ' '), array_to_string(g[2:3], ' ')])
                           as phrase, c from f where len(g) = 3) group by lang, phrase),
        t as (select b.* from b left join o using (lang, phrase)
              where longer is null or 100 * longer < 50 * a)
        select lang, rank, phrase, a::BIGINT as a, l::BIGINT as l, r::BIGINT as r, n, score::BIGINT as score
        from (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank
              from t) join n using (lang) where rank <= 2000""",
}
