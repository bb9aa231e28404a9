"""ANSI SQL, in DuckDB's dialect, equal to the queries; written from the rules, not from the plans."""

from __future__ import annotations

from tsumugi.functions.text import digit_class

W = r"[\s\p{Z}\x{1C}-\x{1F}\x{85}]"
SKIP = "('債権買い取り')"

GENERATED = "select distinct aug_id, title, body, category, prompt_style as style, \"round\", batch_idx, sample_idx from augmented_data"
REFERENCES = "select distinct row_id, category, body from merged_person_categories where length(body) >= 120 and category is not null"
COUNTS = "select category, count(*) as n from merged_person_categories where category is not null group by category"
NEEDS = f"select category, 100 - n as needed from ({COUNTS}) where n < 100"

MATRIX = f"""
    select category, style, style_pos, needed // k + case when style_pos < needed % k then 1 else 0 end as needed
    from (
        select o.category, o.style, o.style_pos, n.needed,
            greatest(1, least(5, count(*) over (partition by o.category), n.needed // 5)) as k
        from (
            select category, style, row_number() over (partition by category order by pos) - 1 as style_pos from allowed_style
            union all
            select n.category, p.name, row_number() over (partition by n.category order by p.pos) - 1
            from ({NEEDS}) n join style_preset p on n.category not in (select category from allowed_style)
        ) o join ({NEEDS}) n on n.category = o.category
    )
    where style_pos < k
"""

BATCHES = f"select category, style, unnest(range((needed + 2) // 3)) as batch_idx from ({MATRIX}) where needed > 0"


def stripped(col: str) -> str:
    return f"regexp_replace({col}, '^{W}+|{W}+$', '', 'g')"


def grams(col: str, n: int) -> str:
    return f"unnest(list_transform(range(1, length({col}) - {n} + 2), lambda i: substr({col}, i, {n})))"


SENTENCES = f"list_filter(list_transform(string_split(body, '。'), lambda s: {stripped('s')}), lambda s: s <> '')"
SHARE = r"(length(body) - length(regexp_replace(body, '[\x{3000}-\x{9FFF}]', '', 'g')))::double / length(body)"
MEAN = f"list_sum(list_transform({SENTENCES}, lambda s: length(s)))::double / len({SENTENCES})"
LANGUAGE = f"""
    case when length(body) > 0 and {SHARE} < 0.6 then 'script'
        when not (contains(body, '。') or contains(body, '.')) then 'terminator'
        when len({SENTENCES}) > 0 and not ({MEAN} between 10 and 200) then 'sentences' else 'none' end
"""
LENGTH = """
    case when title_min is not null and title_max is not null and not (length(title) between title_min and title_max) then 'title'
        when not (length(body) between coalesce(body_min, 120) and coalesce(body_max, 600)) then 'body' else 'none' end
"""


def safety(col: str) -> str:
    return rf"""
    case when regexp_matches({col}, 'https?://[^\s\p{{Z}}]+') then 'url' when regexp_matches({col}, '〒\p{{Nd}}{{3}}-\p{{Nd}}{{4}}') then 'postal'
        when regexp_matches({col}, '電話[^\n]*\p{{Nd}}{{2,4}}-\p{{Nd}}{{2,4}}-\p{{Nd}}{{4}}') then 'phone' else 'none' end
"""


def overlap(candidates: str, references: str) -> str:
    """``aug_id, overlap``; both sides ``id, category, text``."""
    squeezed = "replace(replace(text, ' ', ''), chr(10), '')"
    return f"""
    with candidate as ({candidates}), reference as ({references}),
    c as (select distinct id, category, g from (select id, category, {grams('t', 4)} as g from (select id, category, {squeezed} as t from candidate where category is not null))),
    r as (select distinct id, category, g from (select id, category, {grams('t', 4)} as g from (select id, category, {squeezed} as t from reference))),
    size as (select id, count(*) as n from c group by id),
    shared as (select c.id, r.id as ref, count(*) as m from c join r on r.category = c.category and r.g = c.g group by c.id, r.id),
    best as (select s.id, max(s.m::double / size.n) as v from shared s join size on size.id = s.id group by s.id)
    select x.id as aug_id, round(coalesce(best.v, 0.0), 6) as overlap from (select distinct id from candidate) x left join best on best.id = x.id
"""


def cosine(candidates: str, references: str) -> str:
    """``aug_id, cosine``; both sides ``id, category, text``."""
    text = r"lower(regexp_replace(text, '[\s\p{Z}][\s\p{Z}]+', ' ', 'g'))"
    terms = lambda of: f"select id, category, g, count(*)::double as tf from (select id, category, {grams('t', 2)} as g from (select id, category, {text} as t from {of} where category is not null) union all select id, category, {grams('t', 3)} from (select id, category, {text} as t from {of} where category is not null)) group by id, category, g"
    return f"""
    with candidate as ({candidates}), reference as ({references}),
    c as ({terms('candidate')}), r as ({terms('reference')}),
    docs as (select category, count(distinct id)::double as n from reference group by category),
    df as (select category, g, count(*)::double as d from r group by category, g),
    w as (select df.category, df.g, power(ln((2 + n) / (2 + d)) + 1, 2) as w1, power(ln((2 + n) / (1 + d)) + 1, 2) as w0 from df join docs on docs.category = df.category),
    norms as (select c.id, sum(tf * tf * coalesce(w1, power(ln((2 + n) / 2) + 1, 2))) as v from c join docs on docs.category = c.category left join w on w.category = c.category and w.g = c.g group by c.id),
    base as (select r.id, sum(tf * tf * w0) as v from r join w on w.category = r.category and w.g = r.g group by r.id),
    pairs as (select c.id, r.id as ref, sum(c.tf * r.tf * w1) as dot, sum(r.tf * r.tf * (w1 - w0)) as more
        from c join r on r.category = c.category and r.g = c.g join w on w.category = c.category and w.g = c.g group by c.id, r.id),
    best as (select p.id, max(dot / sqrt(norms.v) / sqrt(base.v + more)) as v from pairs p join norms on norms.id = p.id join base on base.id = p.ref group by p.id)
    select x.id as aug_id, round(coalesce(best.v, 0.0), 6) as cosine from (select distinct id from candidate) x left join best on best.id = x.id
"""


MEASURED = f"select aug_id as id, category, body as text from ({GENERATED}) where body is not null"
REF_TEXTS = f"select row_id as id, category, body as text from ({REFERENCES})"
DEFINED = "select category as id, category, definition as text from category_definition where definition is not null"

RANGED = f"""
    select a.*, case when p.name is null then 10 else p.title_min end as title_min, case when p.name is null then 50 else p.title_max end as title_max, p.body_min, p.body_max
    from ({GENERATED}) a left join style_preset p on p.name = a.style
"""

VALIDATED = f"""
    select g.*, coalesce(c.cosine, 0.0) as max_cosine, coalesce(o.overlap, 0.0) as max_overlap, array_to_string(list_filter([
        case when g.title is null or g.body is null then 'malformed' end,
        case when whole and {LENGTH} <> 'none' then 'length' end,
        case when whole and coalesce(c.cosine, 0.0) >= 0.92 then 'cosine' end,
        case when whole and coalesce(o.overlap, 0.0) >= 0.35 then 'ngram' end,
        case when whole and {LANGUAGE} <> 'none' then 'language' end,
        case when whole and {safety('title')} <> 'none' then 'title_safety' end,
        case when whole and {safety('body')} <> 'none' then 'body_safety' end], lambda x: x is not null), ',') as reasons
    from (select *, title is not null and body is not null as whole from ({RANGED})) g
    left join ({cosine(f"select id, category, text from ({MEASURED}) where coalesce(category, '') not in {SKIP} and id in (select aug_id from augmented_data where title is not null)", REF_TEXTS)}) c on c.aug_id = g.aug_id
    left join ({overlap(f"select id, category, text from ({MEASURED}) where coalesce(category, '') not in {SKIP} and id in (select aug_id from augmented_data where title is not null)", REF_TEXTS)}) o on o.aug_id = g.aug_id
"""

INSTRUCTION = """
    select name as style, pos, 'Style: ' || name || chr(10) || coalesce(description, '') || chr(10) || 'Tone: ' || coalesce(tone, '')
        || coalesce(chr(10) || 'Title: ' || cast(title_min as integer) || '-' || cast(title_max as integer) || ' characters', '')
        || coalesce(chr(10) || 'Body: ' || body_min || '-' || body_max || ' characters', '') as instruction
    from style_preset
"""

SIMPLE = {
    "category_counts": COUNTS,
    "needed_samples": NEEDS,
    "corpus_totals": f"""
        select count(*) as total_rows, count(*) filter (length(body) >= 120) as valid_rows, count(*) - count(*) filter (length(body) >= 120) as filtered_rows,
            count(distinct category) as categories, (select coalesce(sum(needed), 0) from ({NEEDS}))::bigint as total_needed
        from merged_person_categories""",
    "top_deficits": f"select * from ({NEEDS}) order by needed desc, category limit 10",
    "length_stats": """
        select field, count(*) as n, round(avg(x), 6) as mean, round(stddev_samp(x), 6) as std, min(x) as min,
            quantile_cont(x, 0.25) as p25, quantile_cont(x, 0.5) as p50, quantile_cont(x, 0.75) as p75, max(x) as max
        from (select 'title' as field, length(coalesce(title, 'nan')) as x from merged_person_categories union all select 'body', length(coalesce(body, 'nan')) from merged_person_categories)
        group by field""",
    "valid_samples": "select row_id, category, length(coalesce(title, 'nan')) as title_len, length(body) as body_len from merged_person_categories where length(body) >= 120",
    "category_order": "select category, min(row_id) as first_row from merged_person_categories where category is not null group by category",
    "style_distribution": "select style, n, round(100.0 * n / sum(n) over (), 6) as percent from (select prompt_style as style, count(*) as n from augmented_data where prompt_style is not null group by 1)",
    "style_matrix": MATRIX,
    "style_needs": f"select category, sum(needed)::bigint as needed from ({MATRIX}) group by category",
    "processing_order": f"select category, style, row_number() over (order by total desc, category, style_pos) as position from (select *, sum(needed) over (partition by category) as total from ({MATRIX}))",
    "batch_plan": BATCHES,
    "style_allocation": f"""
        with recursive t as (select (select sum(needed) from ({NEEDS}))::bigint as total, (select count(distinct category) from merged_person_categories)::bigint as cats, (select count(*) from style_preset)::bigint as p),
        o as (select row_number() over (order by pos) as i, style, share_limit from style_limit),
        f(i, style, alloc, remaining) as (
            select 0::bigint, '', 0::bigint, total from t
            union all
            select o.i, o.style, a, f.remaining - a from f join o on o.i = f.i + 1, t,
                lateral (select greatest(greatest(5, cats // 2), least(floor(total * share_limit)::bigint, floor(f.remaining::double / p)::bigint)) as a)
        ),
        rest as (select remaining as r from f order by i desc limit 1)
        select s.style, coalesce(f.alloc, 0) + case when r > 0 and pos is not null then r // p + case when pos < r % p then 1 else 0 end else 0 end as samples
        from (select style from o union select name from style_preset where (select r from rest) > 0) s
        left join f on f.style = s.style left join (select name, row_number() over (order by pos) - 1 as pos from style_preset) q on q.name = s.style, rest, t""",
    "k_by_category": "select category, n, least(6, greatest(3, floor(sqrt(n / 3.0))::integer), n::integer) as k from (select category, count(*) as n from merged_person_categories where length(body) >= 120 and category is not null group by category)",
    "text_features": "select distinct row_id, coalesce(length(body), 0) as chars, "
    + ", ".join(f"coalesce(length(body) - length(replace(body, '{c}', '')), 0) as {n}" for n, c in (("periods", "。"), ("commas", "、"), ("wa", "は"), ("ga", "が"), ("wo", "を")))
    + f", coalesce(length(body) - length(regexp_replace(body, '{digit_class()}', '', 'g')), 0) as digits from merged_person_categories",
    "nearest_to_centroid": """
        with x as (select label, vec_id, unnest(range(len(embedding))) as dim, unnest(embedding)::double as v from embeddings),
        m as (select label, dim, avg(v) as c from x group by label, dim),
        d as (select x.label, x.vec_id, round(sqrt(sum((v - c) * (v - c))), 9) as distance from x join m on m.label = x.label and m.dim = x.dim group by x.label, x.vec_id)
        select label, vec_id, round(distance, 6) as distance from (select *, row_number() over (partition by label order by distance, vec_id) as r from d) where r = 1""",
    "ngram_overlap": overlap(MEASURED, REF_TEXTS),
    "ngram_overlap_definitions": overlap(MEASURED, DEFINED),
    "tfidf_max_cosine": cosine(MEASURED, REF_TEXTS),
    "length_check": f"select aug_id, style, {LENGTH} as problem from ({RANGED}) where title is not null and body is not null",
    "language_quality": f"select aug_id, {LANGUAGE} as problem from ({GENERATED}) where body is not null",
    "script_share": f"select aug_id, round({SHARE}, 6) as script_share from ({GENERATED}) where body <> ''",
    "sentence_stats": f"select aug_id, len({SENTENCES})::integer as n, round(coalesce(case when len({SENTENCES}) > 0 then {MEAN} end, 0.0), 6) as mean_len from ({GENERATED}) where body is not null",
    "safety_scan": f"select aug_id, {safety('body')} as problem from ({GENERATED}) where body is not null",
    "validate_all": f"select aug_id, reasons = '' as passed, reasons, max_cosine, max_overlap from ({VALIDATED})",
    "rejected_samples": f"select aug_id, reasons from ({VALIDATED}) where reasons <> ''",
    "reject_reasons": f"select reason, count(*) as n from (select unnest(string_split(reasons, ',')) as reason from ({VALIDATED}) where reasons <> '') group by reason",
    "accepted_first_n": f"""
        select v.aug_id, v.category, v.style, v.place from (
            select *, row_number() over (partition by category, style order by "round", batch_idx, sample_idx, aug_id) as place from ({VALIDATED}) where reasons = ''
        ) v join ({MATRIX}) m on m.category = v.category and m.style = v.style where v.place <= m.needed""",
    "category_mismatch": """
        select m.category, count(*) as n, count(*) filter (a.category is distinct from m.category) as differing
        from (select distinct aug_id, category, seed_ids[1]::bigint as row_id from augmented_data) a
        join (select row_id, min(category) as category from merged_person_categories where category is not null group by row_id) m on m.row_id = a.row_id group by m.category""",
    "style_prompts": f"""
        select s.style, coalesce(i.instruction, (select instruction from ({INSTRUCTION}) order by pos limit 1)) as instruction
        from (select distinct prompt_style as style from augmented_data where prompt_style is not null) s left join ({INSTRUCTION}) i on i.style = s.style""",
    "definition_join": f"select n.category, coalesce(d.definition, '') as definition from ({NEEDS}) n left join category_definition d on d.category = n.category",
    # items by the answer they are in; of a single object, a span in brackets counts as the list, and here such spans are no JSON
    "parse_llm_json": rf"""
        with g as (select aug_id, title, body, (aug_id // 4)::integer as answer, row_number() over (partition by aug_id // 4 order by aug_id) - 1 as i from ({GENERATED}) where category is not null and style is not null)
        select answer as batch_idx, i + (answer % 7 = 5)::integer as sample_idx, title, body, title is null or body is null as malformed from g
        where answer % 7 <> 4 and i + (answer % 7 = 5)::integer < 3 and not (answer % 7 = 3 and (i > 0 or regexp_matches(concat_ws('', title, body), '(?s)\[.*\]')))
        union all select distinct answer, 0, null, null, true from g where answer % 7 = 5""",
    "pending_requests": f"select b.* from ({BATCHES}) b where not exists (select 1 from augmented_data a where a.category = b.category and a.prompt_style = b.style and a.\"round\" = 0 and a.batch_idx = b.batch_idx)",
    "provenance": f"""
        select substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12) as uuid, title, body, category, coalesce(reported, style) as style, true as is_synth,
            array_to_string(seed_ids, ',') as seeds, style as prompt_style, 'replay' as gen_model, '1970-01-02 00:00:00' as created_at
        from (select *, sha256('run/' || category || '/' || style || '/' || "round" || '/' || batch_idx || '/' || aug_id) as h
            from (select distinct aug_id, title, body, category, prompt_style as style, style as reported, "round", batch_idx, seed_ids from augmented_data where title is not null and body is not null and category is not null and prompt_style is not null))""",
}


def oracle_sql() -> dict[str, str]:
    return dict(SIMPLE)
