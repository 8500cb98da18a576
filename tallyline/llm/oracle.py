"""The same results in DuckDB SQL, for the queries that SQL can express."""

from __future__ import annotations

from tallyline.llm.rules import CURRENT, POLICIES, RULES


def _mask(names: tuple[str, ...]) -> int:
    return sum(1 << i for i, rule in enumerate(RULES) if rule.name in names)


# Words as a list; DuckDB's \\s lacks the vertical tab, so the blanks are spelled out.
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_FAILURES = " | ".join(
    f"(case when {rule.fails} then {1 << i} else 0 end)" for i, rule in enumerate(RULES)
)

_QUALITY_RULES = rf"""
with split as (
    select
        doc_id,
        {_WORDS} as w,
        len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]')) as n_symbols,
        list_filter(
            string_split(coalesce(text, ''), chr(10)),
            lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')
        ) as lines
    from documents
), grams as (
    select
        doc_id,
        unnest(range(1, len(w) - 1)) as place,
        unnest(list_transform(
            range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]
        )) as g
    from split
), repeated as (
    select doc_id, place
    from (select doc_id, place, count(*) over (partition by doc_id, g) as n from grams)
    where n > 1
), covered as (
    select doc_id, count(distinct p) as n_repeat_words
    from (select doc_id, unnest([place, place + 1, place + 2]) as p from repeated)
    group by doc_id
), measured as (
    select
        doc_id,
        len(w)::bigint as n_words,
        coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
        n_symbols::bigint as n_symbols,
        (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
        coalesce(n_repeat_words, 0)::bigint as n_repeat_words,
        len(lines)::bigint as n_lines
    from split left join covered using (doc_id)
), ledger as (
    select *, {_FAILURES} as failures
    from measured
)
select
    doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    failures & {_mask(("few_words", "repeated_words"))} <> 0 as base_failed,
    failures & {_mask(POLICIES[CURRENT])} = 0 as kept,
    failures::bigint as failures
from ledger
"""


_SUBSTRING_DEDUP = rf"""
with split as (
    select doc_id, {_WORDS} as w from documents
), windows as (
    select
        doc_id,
        unnest(range(1, len(w) - 11)) as place,
        unnest(list_transform(
            range(1, len(w) - 11), lambda i: array_to_string(w[i:i + 12], ' ')
        )) as g
    from split
), later as (
    select doc_id, place
    from (select doc_id, place, min(doc_id) over (partition by g) as first from windows)
    where doc_id > first
), cut as (
    select distinct doc_id, unnest(range(place, place + 13)) as place from later
), words as (
    select doc_id, unnest(range(1, len(w) + 1)) as place, unnest(w) as word from split
), marked as (
    select words.*, cut.place is null as kept from words left join cut using (doc_id, place)
), told as (
    select
        doc_id,
        count(*) as n_words,
        count(*) filter (not kept) as n_removed,
        string_agg(word, ' ' order by place) filter (kept) as text
    from marked
    group by doc_id
)
select
    doc_id,
    coalesce(n_words, 0) as n_words,
    coalesce(n_removed, 0) as n_removed,
    sha256(coalesce(told.text, '')) as kept_sha256
from documents left join told using (doc_id)
"""

_URL_FILTERS = r"""
with named as (
    select
        regexp_extract(lower(url), '^[a-z]+://([^/?#:]+)', 1) as host,
        regexp_extract(url, '^[a-z]+://[^/?#]+/([^/?#]+)', 1) as top
    from pages
), valued as (
    select distinct 'domain' as kind, regexp_replace(host, '^(www|m|blog)[.]', '') as value from named
    union all
    select distinct 'host', host from named
    union all
    select distinct 'prefix', host || '/' || top from named where top <> ''
), numbered as (
    select kind, value, ('0x' || substr(md5(value), 1, 7))::bigint as n
    from valued where value <> ''
), listed as (
    select
        case when kind = 'host' then 'allow' when n % 3 = 0 then 'malware' else 'spam' end as list,
        kind, value, n, date '2024-01-01' + (n % 300)::int as day
    from numbered
    where n % case kind when 'domain' then 5 when 'host' then 11 else 7 end = 0
), valid as (
    -- Listed for sixty days if removed at all, and again from the ninetieth if added again.
    select list, kind, value, day as since, case when n % 2 = 0 then day + 60 end as until from listed
    union all
    select list, kind, value, day + 90, null from listed where n % 4 = 0
), captures as (
    select
        page_id, url,
        (timestamp '2024-01-01' + to_hours((page_id % 8784)::int))::date as day,
        regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1) as host,
        list_filter(
            string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/'),
            lambda s: s <> ''
        ) as segments
    from pages
), asked as (
    select page_id, day, 'domain' as kind, unnest(list_transform(
        range(1, len(string_split(host, '.')) + 1),
        lambda i: array_to_string(string_split(host, '.')[i:], '.'))) as value
    from captures
    union all
    select page_id, day, 'host', host from captures
    union all
    select page_id, day, 'prefix', unnest(list_transform(
        range(0, len(segments) + 1),
        lambda i: array_to_string(list_concat([host], segments[1:i]), '/')))
    from captures
), covered as (
    select page_id, string_agg(distinct list, ',' order by list) as lists, count(*) as n_entries
    from asked join valid
        on valid.kind = asked.kind and valid.value = asked.value
        and day >= since and (until is null or day < until)
    group by page_id
)
select
    page_id,
    day::varchar as fetched_on,
    coalesce(lists, '') as lists,
    coalesce(n_entries, 0) as n_entries,
    lists is null or list_contains(string_split(lists, ','), 'allow') as kept
from captures left join covered using (page_id)
"""

_CHAT_FORMATTING = """
with chosen as (
    select conv_id as pair_id, turn, role, text from conversations
), rejected as (
    select * from chosen where turn < 1 + pair_id % 4
    union all
    select pair_id - 1, turn, role, text from chosen
    where turn >= 1 + (pair_id - 1) % 4 and pair_id - 1 in (select pair_id from chosen)
), compared as (
    select
        coalesce(c.pair_id, r.pair_id) as pair_id,
        coalesce(c.turn, r.turn) as turn,
        coalesce(c.role = r.role and c.text = r.text, false) as same
    from chosen c full join rejected r on c.pair_id = r.pair_id and c.turn = r.turn
), split as (
    select pair_id, min(turn) filter (not same) as split from compared group by pair_id
), parts as (
    select pair_id, turn, role, text,
        case when split is null or turn < split then 'prompt' else 'chosen' end as part
    from chosen join split using (pair_id)
    union all
    select pair_id, turn, role, text, 'rejected'
    from rejected join split using (pair_id)
    where turn >= split
), rendered as (
    select *, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) as rendered
    from parts
), placed as (
    select *, sum(length(rendered)) over (partition by pair_id, part order by turn)
        - length(rendered) as start
    from rendered
)
select
    pair_id, part, turn, role, rendered,
    start::bigint as start,
    length(rendered) as length,
    case when part <> 'prompt' and role = 'assistant'
        then (start + 13 + length(role))::bigint end as mask_start,
    case when part <> 'prompt' and role = 'assistant'
        then length(text) + 11 else 0 end::bigint as mask_length
from placed
"""


def _vector_codes(parts: int = 8, width: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Lloyd's rounds one after the other, each part against each entry."""
    xs = [f"x{i}" for i in range(width)]
    distance = " + ".join(f"(a.{x} - b.{x})::hugeint * (a.{x} - b.{x})" for x in xs)
    cut = ", ".join(f"v[p * {width} + {i + 1}] as {x}" for i, x in enumerate(xs))
    # Rounded down, also below zero.
    mean = ", ".join(f"(sum({x}) - (((sum({x}) % count(*)) + count(*)) % count(*))) // count(*) as {x}" for x in xs)

    def assigned(i: int) -> str:
        return f"""nearest{i} as materialized (
    select r, p, min({distance}) as d, arg_min(e, ({distance}) * {entries} + e) as e
    from parts a join book{i} b using (p) group by r, p
)"""

    steps = [f"book0 as materialized (select r - 1 as e, p, {', '.join(xs)} from parts where r <= {entries})"]
    for i in range(rounds):
        steps.append(assigned(i))
        steps.append(f"""book{i + 1} as materialized (
    select e, p, {", ".join(f"coalesce(n.{x}, b.{x})::bigint as {x}" for x in xs)}
    from book{i} b left join (
        select e, p, {mean} from nearest{i} join parts using (r, p) group by e, p
    ) n using (e, p)
)""")
    steps.append(assigned(rounds))
    return f"""
with kept as (
    select row_number() over (order by vec_id nulls last, embedding) as r, vec_id, label,
        list_transform(embedding, lambda x: floor(x::double * 4096)::bigint) as v
    from embeddings
    where embedding is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x) or abs(x) >= 32768)) = 0
), parts as materialized (
    select r, p, {cut} from kept, range({parts}) as t(p)
), {", ".join(steps)}, coded as (
    select r, string_agg(printf('%02x', e), '' order by p) as code, sum(d)::bigint as error
    from nearest{rounds} group by r
), digest as (
    select sha256(string_agg(concat_ws(',', {", ".join(xs)}), ',' order by p, e)) as codebooks_sha256
    from book{rounds}
)
select vec_id, code, error,
    (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256
from kept join coded using (r), digest
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_url_filters": _URL_FILTERS,
        "op8_substring_dedup": _SUBSTRING_DEDUP,
        "op9_chat_formatting": _CHAT_FORMATTING,
        "op10_quality_rules": _QUALITY_RULES,
        "op12_vector_codes": _vector_codes(),
    }
