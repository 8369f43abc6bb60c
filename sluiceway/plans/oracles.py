"""SQL for the core's queries, written apart from the operators, for DuckDB.

Word lists and patterns in it are the fixed values of ``functions``, written again for the other engine.
"""

from __future__ import annotations

import re

from sluiceway.functions import institutions as I
from sluiceway.functions.text import EXPANSIONS, SINGLE

WS = r"[\s\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def doi(c: str) -> str:
    bare = rf"regexp_replace(regexp_replace({c}, '^{WS}+|{WS}+$', '', 'g'), '^[\"'']|[\"'']$', '', 'g')"
    return rf"nullif(upper(regexp_extract({bare}, '\b10\.\d{{4,9}}/[^\s\"\)\],;]+')), '')"


def trim(c: str) -> str:
    return f"trim({c}, e' \\t\\r\\n')"


def distinct_text(values: str) -> str:
    """Trimmed, non-blank values in order of first appearance."""
    kept = f"list_filter(list_transform({values}, lambda v: {trim('v')}), lambda v: v <> '')"
    return f"list_filter({kept}, lambda v, i: list_position({kept}, v) = i)"


def has(c: str, pattern: str) -> str:
    return f"coalesce(regexp_matches({c}, '(?i){pattern}'), false)"


def glued(label: str, c: str) -> str:
    cut = f"case when starts_with({c}, '{label} ') then {c} else regexp_replace({c}, '^{label}[:;,-]*', '') end"
    return f"regexp_replace({cut}, '^{label}\\s+', '')"


def prefixes(value: str, rows: str, key: str) -> str:
    """``strip_prefixes`` in steps."""
    x = "w"
    for token in ("20192", "12180-8349", "95819", "33559"):
        x = f"regexp_replace({x}, '(?s)^.*?{token}', '')"
    y = "case when regexp_matches(x, '(?i)SFEWS\\s+Editors') then null else x end"
    for p in (r"(?i)^Background\s+", r"(?i)^A\s*bstract\s+", r"(?i)^Objective\s+", r"(?i)^Introduction\s+", r"^ABSTRACT\s*", r"(?i)^Abstract\.?\s+"):
        y = f"regexp_replace({y}, '{p}', '')"
    steps, last = [], "g0"
    for i, label in enumerate(("Background", "Key Takeaways", "Context", "Objective", "Motivation", "Motivations")):
        steps.append(f"g{i + 1} as (select *, {glued(label, f'y{i}')} as y{i + 1} from g{i})")
        last = f"g{i + 1}"
    n = len(steps)
    drop = " or ".join(f"regexp_matches(w, '{p}')" for p in (r"(?i)^Author(?:\(s\)|s)?\s*:", r"(?i)corresponding\s+author", r"^(?:©|\(c\)|&copy;|(?i:copyright))", r"^\[.*\]$", r"(?i)American\s+Meteorological\s+Society", r"(?i)Jim\s+Goodridge"))
    return f"""with s as (select {key}, {value} as v from {rows}), t as (select *, regexp_replace({trim('v')}, '^[''"]+', '') as w from s),
    u as (select *, {x} as x, {drop} as dropped from t), g0 as (select *, {y} as y0 from u), {', '.join(steps)}
    select {key}, case when v is null or v = '' then v when not dropped then {trim(f'y{n}')} end as abstract from {last}"""


def author(n: str) -> str:
    w = f"string_split_regex({trim(n)}, '\\s+')"
    first = f"list_filter(list_transform({w}[:-2], lambda q: left(regexp_replace(q, '[^A-Za-z]', '', 'g'), 1)), lambda q: q <> '')"
    return f"case when len({w}) < 2 then {w}[1] when len({first}) = 0 then {w}[-1] else {w}[-1] || ', ' || array_to_string(list_transform({first}, lambda q: q || '.'), '') end"


CR_NAME = f"coalesce(nullif({trim('a.name')}, ''), nullif({trim('a.literal')}, ''), nullif(concat_ws(' ', nullif({trim('a.given')}, ''), nullif({trim('a.family')}, '')), ''))"
CR_AFF = f"list_filter(list_transform(a.affiliation, lambda v: {trim('v')}), lambda v: v <> '')[1]"
OA_ALL = distinct_text("list_concat([a.affiliation_raw], coalesce(list_transform(a.affiliations, lambda f: f.display_name), []))")
SQUISH = lambda c: trim(f"regexp_replace({c}, '{WS}+', ' ', 'g')")
PATTERN, FUND = "water stewardship", "science fund"
LOOKUP = "(select canonical as original, upper(canonical) as canonical from institutions where institution_id % 5 <> 0)"  # second entries never count
BLANK = r"[\s\p{Z}\p{Cf}\p{Cc}]*"
FULL = lambda c: f"coalesce(not regexp_full_match({c}, '{BLANK}'), false)"
ANY_FULL = lambda c: f"coalesce(len(list_filter({c}, lambda v: {FULL('v')})) > 0, false)"

CR_LEAVES = "list_concat([a.name, a.literal, a.given, a.family, concat_ws(' ', a.given, a.family)], coalesce(a.affiliation, []))"
CR_PEOPLE = f"""select cr_id, generate_subscripts(author, 1) as i, unnest(author) as a from crossref_metadata"""
CR_ROLES = f"""with e as ({CR_PEOPLE}), f as (select cr_id, i, {CR_AFF} as aff, len(list_filter({CR_LEAVES}, lambda v: {has('v', PATTERN)})) > 0 as somewhere from e),
g as (select cr_id, coalesce(bool_or(somewhere), false) as s, coalesce(bool_or(i = 1 and {has('aff', PATTERN)}), false) as l, count(aff) > 0 and bool_and({has('aff', PATTERN)}) filter (where aff is not null) as o from f group by cr_id)
select c.cr_id, coalesce(s or l or o, false) as dwr_author, coalesce(l, false) as dwr_lead_author, coalesce(o, false) as dwr_sole_author from crossref_metadata c left join g using (cr_id)"""
OA_PEOPLE = "select oa_id, generate_subscripts(authorships, 1) as i, unnest(authorships) as a from openalex_metadata"
OA_ROLES = f"""with e as ({OA_PEOPLE}), f as (select oa_id, i, case when a is null then null else {OA_ALL} end as affs, {has('a.affiliation_raw', PATTERN)} or coalesce(len(list_filter(a.affiliations, lambda v: {has('v.display_name', PATTERN)})) > 0, false) as somewhere from e),
h as (select oa_id, i, somewhere, coalesce(len(list_filter(affs, lambda v: {has('v', PATTERN)})), 0) as hits, coalesce(len(affs), 0) as n from f),
g as (select oa_id, bool_or(somewhere) as s, bool_or(i = 1 and hits > 0) as l, sum(n) > 0 and sum(n) = sum(hits) as o from h group by oa_id)
select w.oa_id, coalesce(s or l or o, false) as flag, coalesce(l, false) as flag_lead, coalesce(o, false) as flag_sole from openalex_metadata w left join g using (oa_id)"""

SIMPLE = lambda c: f"nullif(trim(regexp_replace(lower(strip_accents({c})), '[^a-z]+', ' ', 'g')), '')"
FIRST = f"""select record_id, publication_year, list_filter(list_transform(authors, lambda a, i: {{'author': a, 'position': i}}), lambda x: len(list_filter(author_affiliations, lambda p: coalesce(p.author = x.author, false) and {has('p.canonical_affiliation', PATTERN)})) > 0)[1] as x, dwr_author from all_metadata"""

ORACLES = {
    "doi_clean": f"select line_id, {doi('doi')} as doi from dois_manual",
    "doi_extract": f"select distinct {doi('doi')} as doi from all_metadata where {doi('doi')} is not null",
    "doi_registry": f"""with s as (select {doi('doi')} as doi, 0 as r, 'manual' as doi_source from dois_manual union all select {doi('doi')}, 1, 'crossref' from crossref_metadata union all select {doi('doi')}, 2, 'openalex' from openalex_metadata)
    select doi, doi_source from (select *, row_number() over (partition by doi order by r) as k from s where doi is not null) where k = 1""",
    "doi_blocklist": f"""select line_id, doi from (select line_id, {doi('doi')} as doi from dois_manual) where doi is not null and doi not in (select {doi('doi')} from crossref_metadata where {doi('doi')} is not null)""",
    "doi_chunks": "select line_id, cast((row_number() over (order by line_id) - 1) // 50 as bigint) as chunk from dois_manual",
    "strategies": f"""select cr_id, 'affiliation' as found_by from ({CR_ROLES.replace('s or l or o', 's')}) where dwr_author union all
    select cr_id, 'funder' from crossref_metadata where len(list_filter(funder, lambda f: {has('f.name', FUND)} or {has('f.award', FUND)})) > 0""",
    "crossref_roles": CR_ROLES,
    "openalex_roles": OA_ROLES,
    "openalex_filter": f"select oa_id from ({OA_ROLES.replace('s or l or o', 's')}) where flag",
    "crossref_funding": f"select cr_id, coalesce(len(list_filter(funder, lambda f: {has('f.name', FUND)} or {has('f.award', FUND)})) > 0, false) as funded from crossref_metadata",
    "openalex_funding": f"select oa_id, coalesce(len(list_filter(grants, lambda f: {has('f', FUND)})) > 0, false) as funded from openalex_metadata",
    "crossref_authors": f"select cr_id, cast(i - 1 as int) as pos, {CR_NAME} as author_name, {CR_AFF} as author_affiliation from ({CR_PEOPLE})",
    "crossref_names": f"""with e as (select cr_id, i, {CR_NAME} as n, {CR_AFF} as f from ({CR_PEOPLE})), g as (select cr_id, list(n order by i) filter (where n is not null) as ns, list(f order by i) filter (where f is not null) as fs, list(coalesce(n, '') || ' @ ' || coalesce(f, '') order by i) filter (where n is not null or f is not null) as k from e group by cr_id)
    select c.cr_id, coalesce(array_to_string({distinct_text('ns')}, '; '), '') as names, case when c.author is null then null else coalesce(array_to_string(k, '; '), '') end as pairs, case when c.author is null then '' else coalesce(array_to_string({distinct_text('fs')}, '|'), '') end as affiliations from crossref_metadata c left join g using (cr_id)""",
    "openalex_names": f"""with e as (select oa_id, i, a.display_name as n, {OA_ALL} as f from ({OA_PEOPLE}) where a is not null), g as (select oa_id, list(n order by i) as ns, flatten(list(f order by i)) as fs from e group by oa_id)
    select w.oa_id, coalesce(array_to_string({distinct_text('ns')}, '; '), '') as names, coalesce(array_to_string({distinct_text('fs')}, '|'), '') as affiliations from openalex_metadata w left join g using (oa_id)""",
    "affiliation_values": f"select distinct original from (select {SQUISH('u')} as original from (select unnest(unique_affiliations) as u from all_metadata)) where original <> ''",
    "canonical_affiliations": f"""with e as (select record_id, generate_subscripts(unique_affiliations, 1) as i, unnest(unique_affiliations) as u from all_metadata), f as (select record_id, canonical, min(i) as i from e join {LOOKUP} l on {SQUISH('u')} = l.original group by record_id, canonical)
    select record_id, string_agg(canonical, '; ' order by i, canonical) as canonical_affiliations from f group by record_id""",
    "crossref_canonical_pairs": f"""with e as (select cr_id, i, {CR_NAME} as author, {CR_AFF} as f from ({CR_PEOPLE})), k as (select cr_id, author, canonical as canonical_affiliation, i from e left join {LOOKUP} l on {SQUISH('f')} = l.original where (author is not null or f is not null) and (author is not null or canonical is not null))
    select cr_id, cast(row_number() over (partition by cr_id order by i) - 1 as int) as pos, author, canonical_affiliation from k""",
    "openalex_canonical_pairs": f"""with e as (select oa_id, i, nullif({trim('a.display_name')}, '') as author, {OA_ALL} as fs from ({OA_PEOPLE}) where a is not null), x as (select oa_id, i, author, unnest(case when len(fs) = 0 then [null] else fs end) as f from e),
    k as (select distinct oa_id, i, author, canonical from x left join {LOOKUP} l on {SQUISH('f')} = l.original where author is not null or canonical is not null)
    select oa_id, cast(row_number() over (partition by oa_id order by i, author nulls first, canonical nulls first) - 1 as int) as pos, author, canonical as canonical_affiliation from k""",
    "recent_works": "select record_id, publication_year from all_metadata where publication_year >= 2022",
    "default_funding": "select record_id, case when doi_source = 'manual' and not coalesce(dwr_author, false) and not coalesce(dwr_lead_author, false) and not coalesce(dwr_sole_author, false) and not coalesce(dwr_funding_other, false) then true else dwr_funding_other end as dwr_funding_other from all_metadata",
    "flag_override": """select record_id, case when doi in ('10.90024/GEQF.2022.73454892', '10.90029/SJRB_33630511') then true else dwr_author end as dwr_author, case when doi = '10.90029/SJRB_33630511' then false else dwr_lead_author end as dwr_lead_author from all_metadata""",
    "name_replacements": """with n as (select record_id, list_transform(authors, lambda a: case when a in ('Deborah Bonipakris Jr.', 'Deborah Bonipakris') then 'Deborah A. Bonipakris' when a = 'Kate Zatélastel' then 'Katherine Zatélastel' else a end) as x,
    list_transform(author_affiliations, lambda p: case when p.author in ('Deborah Bonipakris Jr.', 'Deborah Bonipakris') then 'Deborah A. Bonipakris' when p.author = 'Kate Zatélastel' then 'Katherine Zatélastel' else p.author end) as y from all_metadata)
    select record_id, array_to_string(x, '; ') as authors, array_to_string(y, '; ') as pair_authors from n""",
    "blocked_affiliations": """select record_id, array_to_string(list_transform(list_filter(author_affiliations, lambda p: p.canonical_affiliation is null or p.canonical_affiliation not in ('Mermot Engineering Consultants', 'Stimast Water District')), lambda p: coalesce(p.author, '') || ' @ ' || coalesce(p.canonical_affiliation, '')), '; ') as pairs,
    array_to_string(list_filter(canonical_affiliations, lambda v: v is null or v not in ('Mermot Engineering Consultants', 'Stimast Water District')), '; ') as kept from all_metadata""",
    "abstract_prefixes": prefixes("text", "documents", "doc_id"),
    "collapsed": f"""select record_id, nullif(array_to_string({distinct_text('authors')}, '; '), '') as authors, nullif(array_to_string({distinct_text('list_transform(author_affiliations, lambda p: p.canonical_affiliation)')}, '; '), '') as affiliations from all_metadata""",
    "contributions": """select record_id, concat_ws('; ', case when dwr_sole_author then 'sole authored' when dwr_lead_author then 'lead authored' when dwr_author then 'co-authored' end, case when dwr_funding_other then 'funded' end) as contribution from all_metadata""",
    "citations": f"""with k as (select *, {distinct_text('authors')} as names from all_metadata), f as (select *, list_transform(names[:8], lambda n: {author('n')}) as x from k),
    j as (select *, case when coalesce(len(x), 0) = 0 then '' when len(x) = 1 then x[1] when len(x) = 2 then x[1] || ' and ' || x[2] else array_to_string(x[:-2], ', ') || ', and ' || x[-1] end || case when len(names) > 8 then ' et al' else '' end as a from f),
    p as (select record_id, [case when a = '' or ends_with(a, '.') then a else a || '.' end, coalesce('(' || publication_year || ').', ''), case when coalesce(title, '') = '' then '' else title || '.' end, case when coalesce(journal, '') = '' then '' else journal || '.' end,
    case when coalesce(volume, '') = '' then '' when coalesce(issue, '') = '' then volume || '.' else volume || '(' || issue || ').' end, case when coalesce(first_page, '') = '' then '' when coalesce(last_page, '') = '' or last_page = first_page then first_page || '.' else first_page || '-' || last_page || '.' end,
    case when coalesce(doi, '') = '' then '' else 'doi:' || doi || '.' end] as parts from j)
    select record_id, array_to_string(list_filter(parts, lambda q: q <> ''), ' ') as citation from p""",
    "first_affiliated": f"select record_id, x.author as author, cast(x.position as int) as position from ({FIRST})",
    "fuzzy_division": f"""with w as (select record_id, publication_year as y, case when dwr_author then x.author end as author from ({FIRST})), people as (select distinct author, y, {SIMPLE('author')} as clean from w where author is not null),
    r as (select roster_id, division_adjusted as division, try_cast(trim(year) as int) as y, list_distinct(list_filter(list_concat([{SIMPLE('employee_name')}], list_transform(list_filter(string_split_regex(coalesce(employee_alternate_name, ''), '\\s*[;|]\\s*'), lambda v: trim(v) <> ''), lambda v: {SIMPLE('v')})), lambda v: v is not null)) as names from employees),
    c as (select p.author, p.y, p.clean, r.roster_id, r.division, abs(r.y - p.y) as gap, len(list_filter(names, lambda n: string_split(n, ' ')[-1] = string_split(clean, ' ')[-1])) > 0 as same, list_min(list_transform(names, lambda n: levenshtein(clean, n) / greatest(length(clean), length(n), 1))) as d, coalesce(abs(r.y - p.y) <= 1, false) as near from people p cross join r where len(names) > 0),
    c1 as (select *, bool_or(near) over (partition by author, y) as any_near from c), c2 as (select *, bool_or(same) over (partition by author, y) as any_same from c1 where y is null or not any_near or near),
    best as (select author, y, division, d, row_number() over (partition by author, y order by d, case when y is null then 0 else coalesce(gap, 1000000000) end, roster_id) as k from c2 where not any_same or same)
    select w.record_id, w.author as first_affiliated_author, case when b.d <= 0.3 then b.division end as first_affiliated_author_division from w left join (select * from best where k = 1) b on w.author = b.author and w.y is not distinct from b.y""",
    "taxonomy": "select trim(coalesce(first_level, '')) as first_level, trim(coalesce(second_level, '')) as second_level, trim(coalesce(description, '')) as description from disciplines_taxonomy order by 2",
    "label_rollup": "select l.record_id, l.second_level, trim(t.first_level) as first_level from discipline_labels l left join disciplines_taxonomy t using (second_level)",
    "answers_parsed": """select l.record_id, case when record_id % 5 <> 0 then l.second_level end as second_level, case when record_id % 5 <> 0 then trim(t.first_level) end as first_level, case when record_id % 5 <> 0 then greatest(0.0, least(1.0, cast((record_id % 7 - 2) as double) / 4)) end as confidence, case when record_id % 5 <> 0 then 'seen twice' end as note from discipline_labels l left join disciplines_taxonomy t using (second_level)""",
    "most_cited": "select record_id, cited_by_count from all_metadata order by cited_by_count desc nulls last, record_id limit 25",
    "p7_found": f"""with oa as (select oa_id as parent_id, generate_subscripts(authorships, 1) - 1 as pos, unnest(authorships) as a from openalex_metadata), oaf as (select parent_id, pos, generate_subscripts(a.affiliations, 1) - 1 as subpos, unnest(a.affiliations) as f from oa),
    cr as (select cr_id as parent_id, generate_subscripts(author, 1) - 1 as pos, unnest(author) as a from crossref_metadata), crf as (select parent_id, pos, generate_subscripts(a.affiliation, 1) - 1 as subpos, unnest(a.affiliation) as f from cr), fu as (select cr_id as parent_id, generate_subscripts(funder, 1) - 1 as pos, unnest(funder) as f from crossref_metadata)
    select child, parent_id, cast(pos as int) as pos, cast(subpos as int) as subpos from (
    select 'authorship' as child, parent_id, pos, -1 as subpos from oa where {FULL('a.display_name')} or {FULL('a.affiliation_raw')} or {ANY_FULL('list_transform(a.affiliations, lambda z: z.display_name)')}
    union all select 'authorship_affiliation', parent_id, pos, subpos from oaf where {FULL('f.display_name')}
    union all select 'author', parent_id, pos, -1 from cr where {FULL('a.name')} or {FULL('a.literal')} or {FULL('a.given')} or {FULL('a.family')} or {ANY_FULL('a.affiliation')}
    union all select 'author_affiliation', parent_id, pos, subpos from crf where {FULL('f')}
    union all select 'funder', parent_id, pos, -1 from fu where {FULL('f.name')} or {FULL('f.award')})""",
}

ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", chr(34)), ("&apos;", "''"), ("&#39;", "''"), ("&nbsp;", " "), ("&amp;", "&"))


def _markup(c: str) -> str:
    out = f"regexp_replace({c}, '(?s)<!--.*?-->|<[/!?A-Za-z][^<>]*>', '', 'g')"
    for k, v in ENTITIES:
        out = f"replace({out}, '{k}', '{v}')"
    return out


def jats(c: str) -> str:
    text = f"case when {trim(_markup(c))} = '' then {c} else {trim(_markup(c))} end"
    text = f"regexp_replace({text}, '^Abstract\\.\\s*', '')"
    return f"case when {c} <> '' then regexp_replace(regexp_replace({text}, '^AbstractS(\\w)', 'S\\1'), '^Abstract([A-Z])', '\\1') end"


def title(c: str) -> str:
    t = f"regexp_replace({c}, '(?i)</?(?:i|scp|sub)>', '', 'g')"
    return f"case when {t} = upper({t}) and regexp_matches({t}, '[A-Z]') then upper(left({t}, 1)) || lower(substr({t}, 2)) else {t} end"


def capitals(c: str) -> str:
    word = "upper(left(w, 1)) || lower(substr(w, 2))"
    part = f"array_to_string(list_transform(string_split(q, ' '), lambda w: {word}), ' ')"
    return f"array_to_string(list_transform(string_split({c}, '-'), lambda q: {part}), '-')"


ORACLES |= {
    "jats_text": prefixes(jats("abstract"), "crossref_metadata", "cr_id"),
    "clean_titles": f"select record_id, {title('title')} as title from all_metadata",
    "plain_text": "select record_id, cast(generate_subscripts(authors, 1) - 1 as int) as pos, replace(strip_accents(unnest(authors)), chr(160), ' ') as author from all_metadata",
    "roster_names": f"select distinct {capitals('employee_name')} as employee_name, year from employees",
    "openalex_strategies": f"""select oa_id, 'affiliation' as found_by from ({OA_ROLES.replace('s or l or o', 's')}) where flag union all select oa_id, 'grant' from openalex_metadata where len(list_filter(grants, lambda f: {has('f', FUND)})) > 0""",
}


def ascii_text(c: str) -> str:
    for k, v in (EXPANSIONS | SINGLE).items():
        c = f"replace({c}, '{k}', '{v.replace(chr(39), chr(39) * 2)}')"
    return f"strip_accents({c})"


def first_filled(a: str, b: str) -> str:
    return f"case when {a} <> '' then {a} else {b} end"


BOTH = ("title", "abstract", "journal", "publication_year", "landing_page_url", "cited_by_count", "volume", "publisher", "doi_source")
OA_ONLY = ("is_oa", "is_oa_anywhere", "oa_status", "pdf_url", "license", "first_page", "last_page", "issue")
ORACLES |= {
    "harmonized": f"""with reg as ({ORACLES['doi_registry']}), o as (select {doi('w.doi')} as doi, {title('w.title')} as title, p.abstract, source_display_name as journal, publication_year, landing_page_url, cited_by_count, volume, publisher, {', '.join(OA_ONLY)}, n.names, n.affiliations, r.flag, r.flag_lead, r.flag_sole, f.funded
    from openalex_metadata w join ({ORACLES['openalex_names']}) n using (oa_id) join ({OA_ROLES}) r using (oa_id) join ({ORACLES['openalex_funding'].replace(FUND, PATTERN)}) f using (oa_id) join ({prefixes("abstract", "openalex_metadata", "oa_id")}) p using (oa_id)),
    c as (select {doi('w.doi')} as doi, {title('w.title')} as title, p.abstract, container_title as journal, try_cast(left(coalesce(published_online, created), 4) as int) as publication_year, url as landing_page_url, try_cast(is_referenced_by_count as int) as cited_by_count, volume, publisher, n.names, n.affiliations, r.dwr_author, r.dwr_lead_author, r.dwr_sole_author, f.funded
    from crossref_metadata w join ({ORACLES['crossref_names']}) n using (cr_id) join ({CR_ROLES}) r using (cr_id) join ({ORACLES['crossref_funding'].replace(FUND, PATTERN)}) f using (cr_id) join ({ORACLES['jats_text']}) p using (cr_id)),
    o2 as (select o.*, reg.doi_source from o left join reg using (doi) where o.doi is not null), c2 as (select c.*, reg.doi_source from c left join reg using (doi) where c.doi is not null)
    select coalesce(o2.doi, c2.doi) as doi, {', '.join(f'coalesce(o2.{x}, c2.{x}) as {x}' for x in BOTH)}, {', '.join(f'o2.{x}' for x in OA_ONLY)}, {first_filled('o2.names', 'c2.names')} as authors, {first_filled('o2.affiliations', 'c2.affiliations')} as unique_affiliations,
    coalesce(flag, false) or coalesce(dwr_author, false) as dwr_author, coalesce(flag_lead, false) or coalesce(dwr_lead_author, false) as dwr_lead_author, coalesce(flag_sole, false) or coalesce(dwr_sole_author, false) as dwr_sole_author, coalesce(o2.funded, false) or coalesce(c2.funded, false) as dwr_funding_other
    from o2 full join c2 on o2.doi = c2.doi""",
    "final_inventory": f"""with a as (select record_id, min({{'s': l.second_level, 'f': trim(t.first_level)}}) as x from discipline_labels l left join disciplines_taxonomy t using (second_level) group by record_id)
    select m.record_id, m.doi, {ascii_text('m.title')} as title, {ascii_text('c.authors')} as authors, {ascii_text('c.affiliations')} as affiliations, {ascii_text('m.journal')} as journal, m.publication_year, k.contribution, {ascii_text('h.citation')} as citation, a.x.s as second_level, a.x.f as first_level,
    d.first_affiliated_author, case when m.dwr_author then g.position end as first_affiliated_author_position, d.first_affiliated_author_division, m.abstract, m.is_oa, m.is_oa_anywhere, m.oa_status, m.landing_page_url, m.pdf_url, m.license, m.cited_by_count, m.first_page, m.last_page, m.volume, m.issue, {ascii_text('m.publisher')} as publisher, m.doi_source,
    m.dwr_author, m.dwr_lead_author, m.dwr_sole_author, m.dwr_funding_other from (select *, row_number() over () as n from all_metadata) m join ({ORACLES['collapsed']}) c using (record_id) join ({ORACLES['citations']}) h using (record_id) join ({ORACLES['contributions']}) k using (record_id)
    join ({ORACLES['fuzzy_division']}) d using (record_id) join ({ORACLES['first_affiliated']}) g using (record_id) left join a using (record_id)""",
    "first_author_override": f"""with f as (select d.*, case when m.dwr_author then g.position end as position, m.doi, m.publication_year from ({ORACLES['fuzzy_division']}) d join ({ORACLES['first_affiliated']}) g using (record_id) join all_metadata m using (record_id)),
    o(doi, author, place, year) as (values ('10.90024/GEQF.2022.73454892', 'Deborah Bonipakris', 3, null), ('10.90029/SJRB_33630511', 'Katherine Zatélastel', 1, 2021)), t as (select min(record_id) as record_id, doi from f group by doi), u as (select t.record_id, o.author, o.place, coalesce(o.year, f.publication_year) as y from t join o using (doi) join f using (record_id)),
    r as (select roster_id, division_adjusted as division, try_cast(trim(year) as int) as ry, list_filter(list_concat([{SIMPLE('employee_name')}], list_transform(list_filter(string_split_regex(coalesce(employee_alternate_name, ''), '\\s*[;|]\\s*'), lambda v: trim(v) <> ''), lambda v: {SIMPLE('v')})), lambda v: v is not null) as names from employees),
    c as (select u.record_id, u.y, {SIMPLE('u.author')} as clean, r.*, abs(r.ry - u.y) as gap, coalesce(abs(r.ry - u.y) <= 1, false) as near from u cross join r where len(names) > 0),
    c1 as (select *, len(list_filter(names, lambda n: string_split(n, ' ')[-1] = string_split(clean, ' ')[-1])) > 0 as same, list_min(list_transform(names, lambda n: levenshtein(clean, n) / greatest(length(clean), length(n), 1))) as d, bool_or(near) over (partition by record_id) as any_near from c),
    c2 as (select *, bool_or(same) over (partition by record_id) as any_same from c1 where y is null or not any_near or near), b as (select record_id, case when d <= 0.3 then division end as division, row_number() over (partition by record_id order by d, case when y is null then 0 else coalesce(gap, 1000000000) end, roster_id) as k from c2 where not any_same or same)
    select f.record_id, coalesce(u.author, f.first_affiliated_author) as first_affiliated_author, cast(coalesce(u.place, f.position) as int) as first_affiliated_author_position, case when u.author is null then f.first_affiliated_author_division else b.division end as first_affiliated_author_division
    from f left join u using (record_id) left join (select * from b where k = 1) b using (record_id)""",
    "article_prompts": f"""with t as (select string_agg('- ' || trim(coalesce(second_level, '')) || ': ' || trim(coalesce(description, '')), chr(10) order by trim(coalesce(second_level, ''))) as areas from disciplines_taxonomy)
    select record_id, concat_ws(chr(10), 'Choose the one area below that fits the article best. Answer as JSON: {{second_level, confidence, note}}.', areas, 'Title: ' || coalesce(nullif({trim('title')}, ''), '[Missing]'), 'Abstract: ' || coalesce(nullif({trim('abstract')}, ''), '[Missing]')) as prompt from all_metadata, t""",
    "affiliation_prompts": f"""with v as ({ORACLES['affiliation_values']}), n as (select cast(ceil(count(*) / 10) as bigint) as n from v), e as (select cast(cast('0x' || substr(md5(original), 25, 8) as bigint) % n as bigint) as key, 'a' || substr(md5(original), 1, 16) as id, original from v, n)
    select key, 'For each line give the institution it names, in its official English form, or [NA]. Answer as a JSON array of {{id, canonical_institution}}.' || chr(10) || string_agg(id || ': ' || original, chr(10) order by id) as prompt, cast(count(*) as int) as entries from e group by key""",
    "p7_tables": f"""with oa as (select oa_id as parent_id, generate_subscripts(authorships, 1) - 1 as pos, unnest(authorships) as a from openalex_metadata), oaf as (select parent_id, pos, generate_subscripts(a.affiliations, 1) - 1 as subpos, unnest(a.affiliations) as f from oa),
    cr as (select cr_id as parent_id, generate_subscripts(author, 1) - 1 as pos, unnest(author) as a from crossref_metadata), crf as (select parent_id, pos, generate_subscripts(a.affiliation, 1) - 1 as subpos, unnest(a.affiliation) as f from cr), fu as (select cr_id as parent_id, generate_subscripts(funder, 1) - 1 as pos, unnest(funder) as f from crossref_metadata)
    select child, parent_id, cast(pos as int) as pos, cast(subpos as int) as subpos, fields from (
    select 'authorship' as child, parent_id, pos, -1 as subpos, concat_ws('; ', 'affiliation_raw=' || a.affiliation_raw, 'display_name=' || a.display_name) as fields from oa where {FULL('a.display_name')} or {FULL('a.affiliation_raw')} or {ANY_FULL('list_transform(a.affiliations, lambda z: z.display_name)')}
    union all select 'authorship_affiliation', parent_id, pos, subpos, 'display_name=' || f.display_name from oaf where {FULL('f.display_name')}
    union all select 'author', parent_id, pos, -1, concat_ws('; ', 'family=' || a.family, 'given=' || a.given, 'literal=' || a.literal, 'name=' || a.name) from cr where {FULL('a.name')} or {FULL('a.literal')} or {FULL('a.given')} or {FULL('a.family')} or {ANY_FULL('a.affiliation')}
    union all select 'author_affiliation', parent_id, pos, subpos, 'value=' || f from crf where {FULL('f')}
    union all select 'funder', parent_id, pos, -1, concat_ws('; ', 'award=' || f.award, 'name=' || f.name) from fu where {FULL('f.name')} or {FULL('f.award')})""",
}

# The rewriting of names of institutions, rule by rule, each a step of its own.
AGENCY = "Halvern Department of Water Stewardship"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sub(c: str, pattern: str, target: str, every: bool = True) -> str:
    return f"regexp_replace({c}, {quoted(pattern)}, {quoted(target)}{', ' + quoted('g') if every else ''})"


def whole(c: str, pattern: str, target: str) -> str:
    return sub(c, f"(?is)^.*(?:{pattern}).*$", target)


def one_pass(source: str) -> str:
    """A query over ``original, v`` that applies all rules to ``v`` once. Look-around, which the other engine lacks, is written with groups."""
    v = sub(ascii_text(trim("v")), r"\s+", " ")
    for pattern, target in I.ABBREVIATIONS:
        v = sub(v, pattern.replace(r"(?=\s|$)", r"(\s|$)"), target + (r"\1" if "(?=" in pattern else ""))
    v = sub(v, rf"(?i)^(?:(?:{I.SUBUNITS})[^,]*,\s*)+", "")
    v = sub(v, rf"(?i)^(.*?university[^,]*)(?:,?\s*(?:{I.INNER_UNITS}).*)$", r"\1")
    v = trim(sub(v, rf"(?i)^({I.SUNY}).*$", r"\1"))
    v = sub(v, r"(?i)(University of [^,\r\n]+?)[-–]\s*([A-Za-z0-9&.'() ]+)", r"\1, \2")
    v = sub(v, r"(?i)\bUniversity of California at\s+", "University of California ")
    company = I.COMPANY.replace(r"(?=$|\s|\.)", r"($|\s|\.)")
    v = trim(sub(sub(v, company, r"\1"), company, r"\1"))
    v = whole(v, re.escape(AGENCY).replace(r"\ ", " "), AGENCY)
    v = sub(v, f"(?i)^{AGENCY.split(' ', 1)[1]}$", AGENCY)
    v = whole(whole(v, r"\bCUNY\b", I.CUNY), r"\bNASA\b", I.NASA)
    v = sub(sub(v, r"(?i)\bNOAA\b", I.NOAA), r"(?i)National Oceanic and Atmospheric Admin\.?", I.NOAA)
    v = sub(sub(v, rf"(?i)({I.NOAA}).*", r"\1"), "(?i)Administrationistration", "Administration")
    v = sub(sub(v, "(?i)^cornell$", "Cornell University"), "(?i)^rutgers$", "Rutgers University")
    for name in (r"U\.S\.", "US"):
        for _ in range(2):  # neighbours share the sign between them
            v = sub(v, rf"(^|[^A-Za-z]){name}($|[^A-Za-z])", r"\1United States\2")
    for pattern, target in I.DEPARTMENT:
        v = whole(v, pattern, target)
    v = f"replace({sub(v, r',\s*(?:USA|United States of America)$', '')}, ' & ', ' and ')"
    calm = f"case when regexp_matches(v, '(?i)university') then {trim(sub(sub('v', '[,–-]+', ' '), r'\s+', ' '))} else v end"
    last = "v"
    for pattern, target in I.KNOWN:
        last = sub(last, f"(?i)^(?:{pattern})$" if "|" in pattern and not pattern.startswith("(?:") else f"(?i)^{pattern}$", target)
    last = trim(sub(last, r",\s*,", ", "))
    return f"select original, {last} as v from (select original, {calm} as v from (select original, {v} as v from ({source})))"


def rewritten(source: str) -> str:
    """Both passes with the synonyms between them, then the last corrections."""
    v = "v"
    for pattern, target, any_case in I.SYNONYMS:
        v = sub(v, ("(?i)" if any_case else "") + pattern, target)
    last = "v"
    for pattern, target in I.OUTPUT:
        last = whole(last, pattern, target)
    return f"select original, nullif({sub(last, r'(?i)^The\s+', '')}, 'NA') as canonical from ({one_pass(f'select original, {v} as v from ({one_pass(source)})')})"


def guessed(c: str) -> str:
    v = sub(SQUISH(c), rf",?\s*(?:{I.COUNTRY})\s*$", "")
    v = trim(f"split_part({sub(v, rf',?\s*(?:{I.STATES})\s*\d{{3,5}}.*$', '')}, ',', 1)")
    return f"coalesce(nullif({v}, ''), {c})"


def overridden(source: str) -> str:
    """A query over ``original, v`` that applies the overrides one after the other."""
    for r in I.OVERRIDES:
        plain = re.escape(r.pattern).replace(r"\ ", " ")
        if r.exact:
            v = f"nullif(v, {quoted(r.pattern)})" if r.target is None else f"case when v = {quoted(r.pattern)} then {quoted(r.target)} else v end"
        elif r.of_original:
            v = f"case when regexp_matches(original, {quoted(('(?i)' if r.any_case else '') + plain)}) then {quoted(r.target)} else v end"
        else:
            v = whole("v", plain, r.target)
        source = f"select original, {v} as v from ({source})"
    return f"select original, {sub('v', r'(?i)^The\s+', '')} as v from ({source})"


ORACLES |= {
    "institution_rules": rewritten(f"select original, original as v from ({ORACLES['affiliation_values']})"),
    "affiliation_lookup": rewritten(overridden(f"select original, {guessed('original')} as v from ({ORACLES['affiliation_values']})")),
}
