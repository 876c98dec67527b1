"""SQL for the rows of those corpus queries that SQL can express."""

from __future__ import annotations

from tidemark.llm.url_filter import RULES, STRONGEST, SUFFIXES, WEAKEST

_LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

HARD_NEGATIVES = """
with valid as (
    select vec_id, case when vec_id % 7 = 0 then (label::bigint + 1) % 10 else label end as label,
        list_transform(embedding, lambda x: floor(256 * x::double)) as v
    from embeddings
    where vec_id is not null and label is not null and embedding is not null
        and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
), scored as (
    select a.vec_id as anchor_id, a.label = o.label as alike, o.vec_id as other_id,
        list_inner_product(a.v, o.v)::bigint as score
    from valid a, valid o where a.vec_id % 100 = 0 and a.vec_id <> o.vec_id
), positives as (
    select * from scored where alike
    qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5
), ranked as (
    select p.anchor_id, p.other_id as positive_id, n.other_id as negative_id, p.score as positive_score,
        n.score as negative_score,
        row_number() over (partition by p.anchor_id, p.other_id order by n.score desc, n.other_id) as rank
    from positives p join scored n on p.anchor_id = n.anchor_id
    where not n.alike and 30 * p.score <= 100 * n.score and 100 * n.score <= 90 * p.score
)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score from ranked where rank <= 10
"""


def _least(*options: str) -> str:
    return f"list_sort(list_filter([{', '.join(options)}], lambda x: x is not null))[1]"


def _edit(state: str, cost: str, edit: str, turn: str | None = None, when: str = "true") -> str:
    """An option: the state's cost, audit and repaired text after one edit."""
    text = f"{state}.r" if turn is None else f"{state}.r || case when {state}.r = '' then '' else chr(10) end || {turn}"
    return f"case when {state} is not null and {when} then {{'c': {state}.c + {cost}, 't': {state}.t || '{edit}', 'r': {text}}} end"


def _conversations() -> str:
    crc = ("list_reduce(list_prepend(4294967295, list_transform(range(1, length(k) + 1), lambda i: ascii(k[i])::bigint)), "
           "lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], "
           "lambda x, y: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end))")
    keep, reroled = "role || ':' || body", "{0} || ':' || body"
    stays, extra = "not gone", "case when cut then 5 else 0 end"
    deleted = {q: _edit(q, "2", "D") for q in "esua"}
    system = _least(deleted["s"], _edit("e", extra, "K", keep, f"{stays} and initial = 's'"))
    user = _least(deleted["u"], *[_edit(q, extra, "K", keep, f"{stays} and initial = 'u'") for q in "esa"],
                  *[_edit(q, f"1 + {extra}", "R", reroled.format("'user'"), stays) for q in "esa"])
    assistant = _least(deleted["a"], _edit("u", extra, "K", keep, f"{stays} and initial = 'a'"),
                       _edit("u", f"1 + {extra}", "R", reroled.format("'assistant'"), stays))
    opened = _least("u1", *[_edit(q, "5", "I", "'user:'") for q in ("e1", "s1", "a1")])
    closed = _least("a1", _edit("u2", "5", "I", "'assistant:'"))
    kind = "struct(c bigint, t varchar, r varchar)"
    return f"""
with recursive marked as (
    select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as body,
        coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as k
    from conversations
), hashed as (
    select *, xor({crc}, 4294967295) % 20 as kind from marked
), hurt as (
    select conv_id, turn, case when kind = 4 then 'user' else role end as role,
        case when kind = 1 then '' when kind = 2 then translate(body, '.!?', '') else body end as body
    from hashed, unnest(case when kind = 0 then []::int[] when kind = 3 then [0, 1] else [0] end) as copies(copy)
), placed as (
    select *, row_number() over (partition by conv_id order by turn nulls first, role, md5(body)) as i from hurt
), faulted as (
    select *, role[1] as initial, body !~ '(?s).*[^\\x20\\x09-\\x0D].*' as blank,
        row_number() over (partition by conv_id, role, body order by i) > 1 as again,
        regexp_extract(body, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) not in ('.', '!', '?') as unended,
        lag(role[1]) over (partition by conv_id order by i) as before
    from placed
), steps as (
    select *, blank or again as gone, not blank and not again and unended as cut from faulted
), walk as (
    select conv_id, 0::bigint as i, {{'c': 0, 't': '', 'r': ''}}::{kind} as e, null::{kind} as s,
        {{'c': 5, 't': 'I', 'r': 'user:'}}::{kind} as u, {{'c': 10, 't': 'II', 'r': 'user:' || chr(10) || 'assistant:'}}::{kind} as a
    from (select distinct conv_id from conversations)
    union all
    select conv_id, i, e1, s1, u2, {closed} from (
        select *, {opened} as u2 from (
            select w.conv_id, p.i, {deleted['e']} as e1, {system} as s1, {user} as u1, {assistant} as a1
            from walk w join steps p on p.conv_id is not distinct from w.conv_id and p.i = w.i + 1))
), ended as (
    select conv_id, {_least('e', 'a')} as best from walk qualify row_number() over (partition by conv_id order by i desc) = 1
), counted as (
    select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count_if(blank) as blank,
        count_if(again and not blank) as duplicate, count_if(cut) as truncated,
        count_if(before is not null and before || initial not in ('su', 'ua', 'au')) as illegal
    from steps group by conv_id
)
select e.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank,
    coalesce(duplicate, 0)::bigint as duplicate, coalesce(truncated, 0)::bigint as truncated,
    coalesce(illegal, 0)::bigint as illegal, best.c as cost, best.t as audit, sha256(best.r) as repaired_sha256
from ended e left join counted c on e.conv_id is not distinct from c.conv_id
"""


JACCARD_JOIN = f"""
with recursive split as (
    select doc_id, regexp_extract_all({_LOWER.format('text')}, '[^\\x20\\x09-\\x0D]+') as w from documents
), sets as (
    select doc_id, list_sort(list_distinct(case when len(w) = 0 then []::varchar[] when len(w) < 5 then [array_to_string(w, ' ')]
        else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end)) as s from split
), classes as (
    select s, len(s) as n, count(*) as copies, min(doc_id) as least, row_number() over () as c
    from sets where len(s) > 0 group by s
), parts as (
    select c, unnest(s) as x from classes
), shared as (
    select a.c as a, b.c as b, count(*) as common from parts a join parts b on a.x = b.x and a.c <> b.c group by a.c, b.c
), links as (
    select a, b, y.copies from shared join classes x on x.c = a join classes y on y.c = b
    where 100 * common >= 80 * (x.n + y.n - common)
), reach as (
    select c as a, c as b from classes
    union
    select r.a, l.b from reach r join links l on l.a = r.b
), named as (
    select r.a as c, min(k.least) as component_id from reach r join classes k on k.c = r.b group by r.a
), linked as (
    select a as c, sum(copies) as links from links group by a
)
select d.doc_id, len(d.s)::bigint as n_shingles, coalesce(component_id, d.doc_id) as component_id,
    coalesce(copies - 1 + coalesce(links, 0), 0)::bigint as n_links
from sets d left join classes k on k.s = d.s left join named using (c) left join linked using (c)
"""

def _url_filter() -> str:
    rules = ", ".join(f"('{text}', '{text.split('/', 1)[0]}', '/{text.split('/', 1)[1]}', '{what}')" for text, what in RULES)
    two = ", ".join(f"'{s}'" for s in SUFFIXES)

    def strength(level: str, above: str, rows: str) -> str:
        centre = f"((good_{above} - good_{level} + rate) / (n_{above} - n_{level} + 1))"
        return f"""
{level}_strength as (
    select case when between_ > 0 then least({STRONGEST}, greatest({WEAKEST}, 1 / between_ - 1)) else {STRONGEST} end as s_{level}
    from (select case when top > chance then (spread - chance) / (top - chance) else 0 end as between_ from (
        select coalesce(sum(n_{level} * (good_{level} / n_{level} - {centre}) * (good_{level} / n_{level} - {centre})), 0) as spread,
            coalesce(sum({centre} * (1 - {centre})), 0) as chance, coalesce(sum(n_{level} * {centre} * (1 - {centre})), 0) as top
        from {rows} where n_{level} > 0)))"""

    def step(name: str, before: str, level: str, good: str, n: str) -> str:
        return f"""
{name} as (
    select * exclude (mean, variance, prior), after as mean, after * (1 - after) / (weight + n_ + 1) as variance
    from (select * exclude (weight, after, n_), weight, n_, (weight * mean + good_) / (weight + n_) as after
        from (select *, mean * (1 - mean) / prior - 1 as weight, {good} as good_, {n} as n_, null as after
            from (select * exclude (good_, weight, after, n_),
                (mean * (1 - mean) - variance) / (s_{level} + 1) + variance as prior from {before}))))"""

    return f"""
with cut as (
    select page_id, case when position('://' in coalesce(url, '')) > 0 then substr(url, position('://' in url) + 3) else '' end as rest
    from pages
), parts as (
    select page_id, {_LOWER.format("regexp_extract(rest, '^[^/?#]*')")} as host,
        regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') as path
    from cut
), labelled as (
    select doc_id, min(case when quality = 1 and coalesce(toxic, 0) = 0 then 1 else 0 end) as good from labels group by doc_id
), hosts as (
    select host, coalesce(sum(good), 0)::double as good_host, count(good)::double as n_host, string_split(host, '.') as l,
        case when array_to_string(l[greatest(len(l) - 1, 1):], '.') in ({two}) then 2 else 1 end as depth,
        array_to_string(l[greatest(len(l) - depth, 1):], '.') as domain,
        array_to_string(l[greatest(len(l) - depth + 1, 1):], '.') as suffix
    from parts left join labelled on doc_id = try_cast(nullif(regexp_extract(path, '^/[^/]*/([0-9]+)', 1), '') as bigint)
    group by host
), totals as (
    select sum(good_host) as good_all, sum(n_host) as n_all, (sum(good_host) + 1) / (sum(n_host) + 2) as rate from hosts
), by_domain as (
    select suffix, domain, sum(good_host) as good_domain, sum(n_host) as n_domain from hosts group by suffix, domain
), tops as (
    select suffix, sum(good_domain) as good_suffix, sum(n_domain) as n_suffix, any_value(good_all) as good_all,
        any_value(n_all) as n_all, any_value(rate) as rate from by_domain, totals group by suffix
), domains as (
    select * from by_domain join tops using (suffix)
), full_rows as (
    select h.host, good_host, n_host, d.* from hosts h join domains d on h.domain = d.domain
),{strength("suffix", "all", "tops")},{strength("domain", "suffix", "domains")},{strength("host", "domain", "full_rows")},
started as (
    select *, (good_all - good_suffix + 1) / (n_all - n_suffix + 2) as mean, mean * (1 - mean) / (n_all - n_suffix + 3) as variance,
        null as good_, null as weight, null as after, null as n_
    from full_rows, suffix_strength, domain_strength, host_strength
),{step("of_suffix", "started", "suffix", "good_suffix - good_domain", "n_suffix - n_domain")},{step(
        "of_domain", "of_suffix", "domain", "good_domain - good_host", "n_domain - n_host")},{step(
        "of_host", "of_domain", "host", "good_host", "n_host")},
fitting as (
    select page_id, arg_max(rule, (length(rule), length(name))) as rule, arg_max(what, (length(rule), length(name))) as what
    from parts join (values {rules}) r(rule, name, tail, what)
        on (host = name or ends_with(host, '.' || name)) and starts_with(path, tail)
    group by page_id
)
select p.page_id, p.host, p.path, rule,
    coalesce(what, case when mean + 1.96 * sqrt(variance) < 0.5 then 'block' else 'allow' end) as verdict,
    round(mean, 9) as reputation
from parts p left join fitting f on f.page_id = p.page_id left join of_host h on h.host = p.host
"""


ORACLES = {"op10_url_filter": _url_filter(), "op11_hard_negatives": HARD_NEGATIVES, "op12_conversation_repair": _conversations(),
           "op13_jaccard_join": JACCARD_JOIN}
