"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"


def _shingles(table: str, key: str, k: int) -> str:
    words = WORDS.format(text=f"translate(text, '{UPPER}', '{LOWER}')")
    return f"""
        select distinct {key}, array_to_string(w[i:i + {k - 1}], ' ') as shingle
        from (select {key}, w, unnest(range(1, len(w) - {k - 2})) as i from (select {key}, {words} as w from {table}))"""


DECONTAMINATION = f"""
with docs as ({_shingles("documents", "doc_id", 5)}),
     items as ({_shingles("benchmark", "item_id", 5)}),
     sizes as (select item_id, count(*) as n from items group by item_id)
select doc_id, item_id, count(*) as n_shared, any_value(n) as n_shingles
from docs join items using (shingle) join sizes using (item_id)
group by doc_id, item_id
having 100 * count(*) >= 80 * any_value(n)
"""

FILL_IN_MIDDLE = r"""
with units as (
    select doc_id, coalesce(text, '') as t, sha256('42:' || doc_id) as h,
           regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as u
    from documents),
numbers as (
    select *, len(u) as n, ('0x' || h[1:8])::bigint as h1, ('0x' || h[9:16])::bigint as h2,
           ('0x' || h[17:24])::bigint as h3, ('0x' || h[25:32])::bigint as h4
    from units),
forms as (
    select *, case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 50 then 'plain'
                   when h4 % 100 < 80 then 'spm' else 'psm' end as form,
           least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b
    from numbers),
parts as (
    select doc_id, t, n, form, coalesce(array_to_string(u[1:a], ''), '') as p, coalesce(array_to_string(u[a + 1:b], ''), '') as m,
           coalesce(array_to_string(u[b + 1:], ''), '') as s
    from forms)
select doc_id, n, form, case when form <> 'plain' then length(p) end as prefix_chars,
       case when form <> 'plain' then length(m) end as middle_chars,
       sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
                        else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
       sha256(t) as restored_sha256
from parts
"""

EXACT_DEDUP = """
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
       doc_id = max(doc_id) over same as kept, sha256(t) as text_sha256
from (select doc_id, coalesce(text, '') as t from documents)
window same as (partition by t)
"""


def _word_counts(table: str, key: str) -> str:
    words = rf"regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"select {key}, w, count(*) as n from (select {key}, unnest({words}) as w from {table}) group by all"


# CRC-32 by its table, made from the polynomial, over the bytes of each distinct word
TARGET_SAMPLING = f"""
with crc_table as (
    select list(c order by i) as crc from (
        select i, list_reduce([i::bigint, 0, 0, 0, 0, 0, 0, 0, 0],
            lambda c, x: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as c
        from range(256) r(i))),
docs as ({_word_counts("documents", "doc_id")}),
items as ({_word_counts("benchmark", "item_id")}),
spelled as (select w, hex(encode(w)) as x from (select w from docs union select w from items)),
buckets as (
    select w, xor(list_reduce(
        list_prepend(4294967295, list_transform(range(len(x) // 2), lambda i: ('0x' || x[2 * i + 1:2 * i + 2])::bigint)),
        lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) % 10000 as bucket
    from spelled, crc_table),
source as (select bucket, sum(n) as s from docs join buckets using (w) group by 1),
target as (select bucket, sum(n) as t from items join buckets using (w) group by 1),
totals as (select coalesce((select sum(n) from docs), 0) as s_all, coalesce((select sum(n) from items), 0) as t_all),
gains as (
    select bucket, floor(1000 * ln((coalesce(t, 0) + 1)::double * (s_all + 10000)::double
        / ((coalesce(s, 0) + 1)::double * (t_all + 10000)::double)))::bigint as gain
    from source full join target using (bucket), totals),
weights as (
    select doc_id, sum(n)::bigint as n_features, sum(n * gain)::bigint as weight
    from docs join buckets using (w) join gains using (bucket) group by 1),
scored as (
    select doc_id, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
           coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || doc_id)[1:8])::bigint + 0.5::double) / 4294967296)))::bigint as score
    from documents left join weights using (doc_id)),
placed as (
    select doc_id, row_number() over (order by score desc, doc_id) as place, count(*) over () as n
    from scored where n_features >= 20)
select doc_id, n_features, weight, score, case when place <= 10 * n // 100 then place end as rank
from scored left join placed using (doc_id)
"""

SQL: dict[str, str] = {
    "op6_decontamination": DECONTAMINATION,
    "op11_fill_in_middle": FILL_IN_MIDDLE,
    "op12_exact_dedup": EXACT_DEDUP,
    "op13_target_sampling": TARGET_SAMPLING,
}
