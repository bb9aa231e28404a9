"""ANSI SQL for the pN_ queries that SQL can express."""

from __future__ import annotations


#: Keys of each table counted once, with the field without white space around it.
AVAILABLE = """
    select 'merged_person_categories' as table_name, 'category' as field, regexp_replace(category, '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g') as stratum, count(distinct row_id) as n
    from merged_person_categories group by 3
    union all
    select 'augmented_data', 'prompt_style', regexp_replace(prompt_style, '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g'), count(distinct aug_id)
    from augmented_data group by 3
"""

P1_FOUND = f"""
    with available as ({AVAILABLE})
    select t.request_id, t.stratum
    from sample_targets t join sample_requests r on r.request_id = t.request_id
    left join available a on a.table_name = r.table_name and a.field = r.field and a.stratum = t.stratum
    where coalesce(a.n, 0) < greatest(t.min_rows, t.target_share * r.sample_size)
"""

#: Distinct 5-grams of all bodies of enough characters, white space left out.
GRAMS = """
    select distinct t, id, category, load_no, unnest(list_transform(range(1, length(b) - 3), lambda i: substr(b, i, 5))) as g
    from (select *, regexp_replace(body, '[\\s\\p{Z}\\x{1C}-\\x{1F}\\x{85}]', '', 'g') as b from (
        select distinct 'augmented_data' as t, aug_id as id, category, load_no, body from augmented_data
        union all select distinct 'merged_person_categories', row_id, category, null, body from merged_person_categories
    ) where length(body) >= 120)
"""
SIMILAR = "n >= 0.7 * (a.size + b.size - n)"

P2_FOUND = f"""
    with g as (select id, category, load_no, g from ({GRAMS}) where t = 'augmented_data' and category is not null),
    s as (select id, count(*) as size from g group by id),
    p as (select x.id as a, y.id as b, count(*) as n from g x join g y on x.category = y.category and x.g = y.g and y.load_no < x.load_no group by 1, 2)
    select distinct p.a as aug_id from p join s a on a.id = p.a join s b on b.id = p.b where {SIMILAR}
"""

P6_FOUND = f"""
    with g as (select t, id, g from ({GRAMS})),
    s as (select t, id, count(*) as size from g group by t, id),
    p as (select x.t as ta, x.id as ia, y.t as tb, y.id as ib, count(*) as n from g x join g y on x.g = y.g and (x.t, x.id) < (y.t, y.id) group by 1, 2, 3, 4)
    select ta as table_a, ia as id_a, tb as table_b, ib as id_b from p join s a on a.t = p.ta and a.id = p.ia join s b on b.t = p.tb and b.id = p.ib where {SIMILAR}
"""

P9_FOUND = """
    with w as (select doc_id, unnest(list_transform(range(1, length(text) - 198), lambda i: substr(text, i, 200))) as s from documents where length(text) >= 200)
    select distinct doc_id from w where s in (select s from w group by s having min(doc_id) < max(doc_id))
"""


def oracle_sql() -> dict[str, str]:
    return {"p1_found": P1_FOUND, "p2_found": P2_FOUND, "p6_found": P6_FOUND, "p9_found": P9_FOUND}
