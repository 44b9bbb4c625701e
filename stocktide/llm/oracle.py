"""SQL for the registered queries that SQL can express, over the same tables."""

from __future__ import annotations

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
TERMS = f"regexp_extract_all({LOWER.format('text')}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

HARD_NEGATIVES = """
with rows as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select a.vec_id as anchor_id, x.vec_id as other_id, a.label = x.label as same,
         list_sum(list_transform(list_zip(a.v, x.v), lambda p: p[1] * p[2]))::bigint as score
  from rows a join rows x on a.vec_id <> x.vec_id where a.vec_id % 100 = 0),
positives as (
  select anchor_id, other_id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5)
select anchor_id, positive_id,
       (row_number() over (partition by anchor_id, positive_id order by score desc, other_id))::integer as rank,
       other_id as negative_id, positive_score, score as negative_score
from positives join scored using (anchor_id)
where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
qualify row_number() over (partition by anchor_id, positive_id order by score desc, other_id) <= 10
"""

RANKED_SEARCH = f"""
with words as (
  select doc_id, unnest({TERMS}) as term from documents),
postings as (select doc_id, term, count(*) as tf from words group by all),
lengths as (select doc_id, sum(tf)::bigint as n from postings group by doc_id),
totals as (select count(*)::bigint as big_n, sum(n)::bigint as big_l from lengths),
weights as (select term, floor(1000 * ln((2 * big_n + 2) / (2 * count(*) + 1)))::bigint as w
            from postings, totals group by term, big_n),
asked as (select distinct item_id, unnest({TERMS}) as term from benchmark),
scored as (
  select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * big_n) // big_l))))::bigint as score
  from asked join weights using (term) join postings using (term) join lengths using (doc_id), totals
  group by item_id, doc_id)
select item_id, rank::integer as rank, doc_id, score from (
  select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from scored where score > 0)
where rank <= 50
"""

_ESCAPED = "replace({}, chr(92), chr(92) || chr(92))"
for _text in ("<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]"):
    _ESCAPED = f"replace({_ESCAPED}, '{_text}', '{_text[0]}' || chr(92) || '{_text[1:]}')"

CHAT_FORMAT = f"""
with log as (
  select conv_id, turn, role, text from conversations
  union all values (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
turns as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text, row_number() over (
    partition by conv_id order by turn nulls first, role nulls first, text nulls first) as place from log)
select conv_id, count(*)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by place)) as turns_sha256,
  coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by place) filter (where role = 'assistant'), '')) as loss_sha256,
  sum(length('<s>[INST]</s>') + length({_ESCAPED.format('role')}) + length({_ESCAPED.format('text')}))::bigint
    as formatted_chars
from turns group by conv_id"""

# Five hexadecimal digits are four of base 32.
ARCHIVES = """
with held as (
  select page_id, url, encode(coalesce(html, '')) as payload,
    min(page_id) over (partition by coalesce(html, '')) as first from pages)
select page_id, octet_length(payload)::bigint as payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
    ('0x' || substr(sha1(payload), 1 + 5 * (i // 4), 5))::integer >> (15 - 5 * (i % 4)))::integer % 32, 1)), '') as payload_digest,
  if(page_id = first, 'response', 'revisit') as record_type, nullif(first, page_id) as refers_to,
  array_to_string(list_transform(string_split(url, ''), lambda c: if(
    ascii(c) between 1 and 31 or ascii(c) = 127, '%' || printf('%02X', ascii(c)), c)), '') as target_uri
from held"""

SQL: dict[str, str] = {
    "op1_chat_format": CHAT_FORMAT,
    "op10_warc": ARCHIVES,
    "op11_hard_negatives": HARD_NEGATIVES,
    "op13_ranked_search": RANKED_SEARCH,
}
