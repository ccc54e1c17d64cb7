"""DuckDB statements for the queries that SQL can express, each formulated on its own."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPACED = r"'[^\x20\x09-\x0D]+'"
_CODED = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"


def _lowered(column: str) -> str:
    return f"translate(coalesce({column}, ''), '{_UPPER}', '{_LOWER}')"


#: From links (a, b) in both directions: the smallest node that each one reaches.
_REACHED = """
reach as (select a, b from links union select r.a, l.b from reach r join links l on l.a = r.b),
component as (select a, min(least(a, b)) c from reach group by a)"""

NGRAM_JOIN = f"""
with recursive w as (select doc_id, regexp_extract_all({_lowered("text")}, {_SPACED}) ws from documents),
g as (select distinct doc_id, array_to_string(ws[i:i + 2], ' ') g
      from (select doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 2))) i from w where len(ws) > 0)),
n as (select doc_id, count(*) n from g group by doc_id),
overlap as (select x.doc_id a, y.doc_id b, count(*) k from g x join g y on x.g = y.g and x.doc_id <> y.doc_id group by all),
links as (select a, b from overlap join n na on na.doc_id = a join n nb on nb.doc_id = b where 100 * k >= 90 * (na.n + nb.n - k)),
{_REACHED}
select w.doc_id, coalesce(n.n, 0) n_shingles, coalesce(c, w.doc_id) component_id
from w left join n on n.doc_id = w.doc_id left join component on a = w.doc_id"""

NEAR_DEDUP = f"""
with recursive v as (select vec_id, label, embedding::double[] e from embeddings),
links as (select x.vec_id a, y.vec_id b from v x join v y on x.label = y.label and x.vec_id <> y.vec_id
          where list_cosine_similarity(x.e, y.e) >= 0.93),
{_REACHED},
n as (select a, count(*) n from links group by a)
select vec_id, coalesce(n, 0) n_links, coalesce(c, vec_id) component_id, vec_id = coalesce(c, vec_id) kept
from v left join n on n.a = vec_id left join component on component.a = vec_id"""

DECONTAMINATION = f"""
with d as (select doc_id, regexp_extract_all({_lowered("text")}, {_CODED}) ws from documents),
t as (select item_id, regexp_extract_all({_lowered("text")}, {_CODED}) ws from benchmark),
phrase as (select distinct item_id, least(13, len(ws)) n, array_to_string(ws[i:i + least(13, len(ws)) - 1], ' ') p
           from (select item_id, ws, unnest(range(1, greatest(len(ws) - 11, 2))) i from t where len(ws) > 0)),
size as (select distinct n from phrase),
win as (select doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') p
        from (select doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) i from d, size where len(ws) >= n)),
hit as (select doc_id, i, win.n, item_id from win join phrase on phrase.n = win.n and phrase.p = win.p),
words as (select doc_id, count(distinct p) n from (select doc_id, unnest(range(i, i + n)) p from hit) group by doc_id),
found as (select doc_id, count(*) n, string_agg(id, ',' order by id) ids
          from (select distinct doc_id, item_id::varchar id from hit) group by doc_id)
select d.doc_id, len(ws) n_words, coalesce(words.n, 0) n_hit, coalesce(found.n, 0) n_items,
  sha256(coalesce(ids, '')) items_sha256, coalesce(words.n, 0) > 0 and 20 * coalesce(words.n, 0) >= len(ws) contaminated
from d left join words on words.doc_id = d.doc_id left join found on found.doc_id = d.doc_id"""

SUBSTRING_DEDUP = f"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), {_SPACED}) ws from documents),
win as (select doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) h
        from (select doc_id, ws, unnest(range(1, len(ws) - 48)) i from d where len(ws) >= 50)),
hit as (select doc_id, i from (select doc_id, i, min(doc_id) over (partition by h) least_id from win) where least_id < doc_id),
gone as (select distinct doc_id, unnest(range(i, i + 50)) p from hit),
word as (select doc_id, unnest(ws) w, unnest(range(1, len(ws) + 1)) p from d),
kept as (select doc_id, count(*) n, string_agg(w, ' ' order by p) t from word anti join gone using (doc_id, p) group by doc_id)
select d.doc_id, len(ws) n_words, len(ws) - coalesce(n, 0) n_removed, sha256(coalesce(t, '')) kept_sha256
from d left join kept on kept.doc_id = d.doc_id"""

SUFFIX_DEDUP = """
with d as (select doc_id, hex(encode(coalesce(text, ''))) x from documents),
win as (select doc_id, i, md5(substr(x, 2 * i + 1, 200)) h
        from (select doc_id, x, unnest(range(0, len(x) // 2 - 99)) i from d where len(x) >= 200)),
hit as (select doc_id, i from (select doc_id, i, row_number() over (partition by h order by doc_id, i) k from win) where k > 1),
run as (select doc_id, i, sum(new) over (partition by doc_id order by i) r
        from (select doc_id, i, case when i <= lag(i) over (partition by doc_id order by i) + 100 then 0 else 1 end new from hit)),
span as (select doc_id, r, min(i) s, max(i) + 100 e from run group by doc_id, r),
edge as (select doc_id, s, e, coalesce(lag(e) over (partition by doc_id order by s), 0) before from span),
part as (select doc_id, count(*) n, sum(e - s) removed, max(e) last,
           string_agg(substr(x, 2 * before + 1, 2 * (s - before)), '' order by s) head from edge join d using (doc_id) group by doc_id)
select d.doc_id, len(x) // 2 n_bytes, coalesce(removed, 0)::bigint n_removed, coalesce(n, 0) n_spans,
  sha256(unhex(case when n is null then x else concat(head, substr(x, 2 * last + 1)) end)) kept_sha256
from d left join part on part.doc_id = d.doc_id"""

#: The lags are those at which six words on end agree, which any run of 12 words or more has.
PERIODIC_RUNS = f"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), {_SPACED}) ws, encode(doc_id::varchar) id from documents),
crc as (select doc_id, ws, len(ws) n, xor(4294967295, list_reduce(list_prepend(4294967295::bigint, [('0x' || substr(hex(id), 2 * i - 1, 2))::bigint for i in range(1, octet_length(id) + 1)]),
          lambda c, b: list_reduce(list_prepend(xor(c, b), [0::bigint for i in range(8)]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1))))) h from d),
fold as (select *, h // 10 g, case when n > 0 then (h // 10) % n else 0 end a from crc),
t as (select doc_id, n, case when h % 10 = 0 and n > 0
          then [ws[1 + case when i < a then i else a + (i - a) % (1 + (n - a) // (3 + g % 8)) end] for i in range(n)] else ws end ws from fold),
six as (select doc_id, i, array_to_string(ws[i + 1:i + 6], ' ') s from (select doc_id, ws, unnest(range(n - 5)) i from t where n >= 12)),
pair as (select x.doc_id, x.i, y.i - x.i q from six x join six y on x.doc_id = y.doc_id and x.s = y.s and x.i < y.i),
island as (select doc_id, q, i, i - row_number() over (partition by doc_id, q order by i) k from pair),
stretch as (select doc_id, q, min(i) s, count(*) + 5 + q l from island group by doc_id, q, k),
run as (select doc_id, s, l, min(q) q from stretch where l >= greatest(12, 2 * q) group by doc_id, s, l),
gone as (select distinct doc_id, unnest(range(s + q, s + l)) p from run),
word as (select doc_id, unnest(ws) w, unnest(range(n)) p from t),
kept as (select doc_id, string_agg(w, ' ' order by p) t from word anti join gone using (doc_id, p) group by doc_id),
told as (select doc_id, count(*) n, string_agg(concat(s, ',', l, ',', q, chr(10)), '' order by s, q) t, max(l) l from run group by doc_id),
best as (select run.* from run join told on run.doc_id = told.doc_id and run.l = told.l
         qualify row_number() over (partition by run.doc_id order by s, q) = 1)
select t.doc_id, coalesce(told.n, 0) n_runs, s start, best.l length, best.q period, 1000 * best.l // best.q exponent_milli,
  sha256(coalesce(told.t, '')) runs_sha256, sha256(coalesce(kept.t, '')) collapsed_sha256
from t left join told on told.doc_id = t.doc_id left join best on best.doc_id = t.doc_id left join kept on kept.doc_id = t.doc_id"""

PHRASES = f"""
with p as (select coalesce(lang, 'und') lang, unnest(regexp_split_to_array({_lowered("text")}, '[.,;:!?\\x0A-\\x0D]')) p from documents),
w as (select lang, regexp_extract_all(p, '[^\\x20\\x09]+') ws from p),
g as (select lang, k, ws[i:i + k - 1] g from (select lang, ws, k, unnest(range(1, len(ws) - k + 2)) i from w, range(1, 5) t(k) where len(ws) >= k)),
f as (select lang, k, g, count(*) f from g group by all),
c as (select * from f where k >= 2 and f >= 30),
inside as (select lang, f, g[s:s + n - 1] g from (select lang, k, f, g, n, unnest(range(1, k - n + 2)) s from c, range(2, 4) t(n) where n < k)),
longest as (select lang, g, max(f) f from inside group by all),
free as (select c.* from c left join longest x on x.lang = c.lang and x.g = c.g where x.f is null or 100 * x.f < 80 * c.f),
cut as (select free.lang, free.g, free.f a, x.k, x.f l, y.f r, 2000000 * free.f::hugeint // (x.f + y.f) score
        from free join f x on x.lang = free.lang and x.k < free.k and x.g = free.g[1:x.k]
        join f y on y.lang = free.lang and y.k = free.k - x.k and y.g = free.g[x.k + 1:free.k]),
best as (select * from cut qualify row_number() over (partition by lang, g order by score, k) = 1),
ranked as (select lang, array_to_string(g, ' ') phrase, a, l, r, score,
             row_number() over (partition by lang order by score desc, a desc, array_to_string(g, ' ')) rank from best),
n as (select lang, sum(len(ws))::bigint n from w group by lang)
select lang, rank, phrase, a, l, r, n, score::bigint score from ranked join n using (lang) where rank <= 2000"""

EXACT_TOP_K = """
with v as (select vec_id, [floor(1024 * x::double) for x in embedding] e from embeddings
           where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id query_id, c.vec_id, list_inner_product(q.e, c.e)::bigint score from v q join v c on q.vec_id % 100 = 0 and q.vec_id <> c.vec_id),
r as (select query_id, row_number() over (partition by query_id order by score desc, vec_id) rank, vec_id, score from s)
select query_id, rank::int rank, vec_id, score from r where rank <= 10"""

ORACLE_SQL: dict[str, str] = {
    "op1_ngram_jaccard_join": NGRAM_JOIN,
    "op5_embedding_near_dedup": NEAR_DEDUP,
    "op7_benchmark_decontamination": DECONTAMINATION,
    "op9_substring_dedup": SUBSTRING_DEDUP,
    "op10_suffix_array_dedup": SUFFIX_DEDUP,
    "op11_periodic_runs": PERIODIC_RUNS,
    "op12_phrase_collocations": PHRASES,
    "op13_exact_top_k": EXACT_TOP_K,
}
