"""DuckDB SQL of the queries that SQL can express, built from the operators' parameters."""

from __future__ import annotations

from collections.abc import Sequence

from statledger.llm import secret_scan, url_filter

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def secret_scan_sql(kinds: Sequence[secret_scan.Kind] = secret_scan.KINDS, base: int = len(secret_scan.BASE_KINDS)) -> str:
    each = " union all ".join(
        f"""select doc_id, source, {n} as kind_no, {_quoted(k.name)} as kind, {k.least} as least,
        regexp_split_to_array(text, {_quoted(k.pattern)}) as gaps, regexp_extract_all(text, {_quoted(k.pattern)}, 0) as found,
        regexp_extract_all(text, {_quoted(k.pattern)}, {k.value}) as vals from documents
        where regexp_matches(text, {_quoted(k.pattern)})"""
        for n, k in enumerate(kinds)
    )
    counted = ", ".join(
        f"count(*) filter (kind_no = {n})::bigint as n_{k.name}" for n, k in enumerate(secret_scan.BASE_KINDS)
    )
    return f"""
with c as ({each}),
m as (
  select doc_id, source, kind_no, kind, least, i, length(gaps[i]) as gap, length(found[i]) as size, vals[i] as val
  from c, lateral (select unnest(range(1, len(found) + 1)) as i)
),
s as (
  select *, (sum(gap + size) over (partition by doc_id, kind_no order by i))::bigint as stop from m
),
k as (select *, stop - size as start, kind || ':' || (stop - size) || ':' || stop as span from s where length(val) >= least),
o as (
  select val, count(distinct coalesce(source, '')) <= {secret_scan.MAX_OWNERS}
    or count(distinct (coalesce(source, ''), coalesce(doc_id::varchar, ''))) <= {secret_scan.MAX_REPOSITORIES} as live
  from k group by val
),
r as (
  select doc_id, {counted},
    count(*) filter (live)::bigint as n_live,
    sha256(coalesce(string_agg(span, ',' order by start, kind_no) filter (kind_no < {base}), '')) as base_sha256,
    string_agg(span, ',' order by start, kind_no) filter (kind_no < {base} or live) as spans
  from k join o using (val) group by doc_id
)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
  coalesce(n_live, 0) as n_live, coalesce(base_sha256, sha256('')) as base_sha256, coalesce(spans, '') as spans
from documents left join r using (doc_id)
"""


def url_filter_sql(rules: Sequence[url_filter.Rule]) -> str:
    context = url_filter.CONTEXT

    def case(value) -> str:
        whens = " ".join(
            f"when (host = {_quoted(r.host)} or ends_with(host, {_quoted('.' + r.host)})) and starts_with(path, {_quoted(r.path)}) "
            f"then {_quoted(value(r))}"
            for r in sorted(rules, key=lambda r: (-len(r.text), r.text))
        )
        return f"case {whens} end"

    chance = {"a": f"{1.0 / url_filter.ALPHABET!r}::double", "r": f"{1.0 / url_filter.ALPHABET!r}::double"}
    parts, joins = [], []
    for k in range(context + 1):
        seen, head = f"substr(gram, {context + 1 - k}, {k + 1})", f"substr(gram, {context + 1 - k}, {k})"
        parts.append(f"t{k} as (select {seen} as seen{k}, sum(a) as a{k}, sum(r) as r{k} from n group by 1)")
        parts.append(
            f"h{k} as (select substr(seen{k}, 1, {k}) as head{k}, sum(a{k}) as na{k}, sum(r{k}) as nr{k}, "
            f"count(*) filter (a{k} > 0) as ta{k}, count(*) filter (r{k} > 0) as tr{k} from t{k} group by 1)"
        )
        joins.append(f"join t{k} on {seen} = seen{k} join h{k} on {head} = head{k}")
        for c in "ar":
            t = f"greatest(t{c}{k}, 1)"
            chance[c] = f"({c}{k} + {t} * ({chance[c]})) / (n{c}{k} + {t})::double"
    pattern = "(?s)^.*?://([^/?#]*)([^?#]*)"
    return f"""
with p as (
  select page_id, url, coalesce(translate(regexp_extract(url, {_quoted(pattern)}, 1), '{UPPER}', '{LOWER}'), '') as host,
    coalesce(regexp_extract(url, {_quoted(pattern)}, 2), '') as path from pages
),
j as (select *, {case(lambda r: r.text)} as rule, {case(lambda r: r.action)} as action from p),
u as (
  select distinct url, action, host || path as subject, substr(md5(url), 1, 1) in ({", ".join(map(_quoted, url_filter.HELD_OUT))}) as held
  from j where url is not null and host || path <> ''
),
g as (
  select url, action, held, substr(repeat(chr(2), {context}) || subject, i, {context + 1}) as gram
  from u, lateral (select unnest(range(1, length(subject) + 1)) as i)
),
n as (select gram, count(*) filter (action = 'allow' and not held) as a, count(*) filter (action = 'block' and not held) as r from g group by gram),
{", ".join(parts)},
l as (select gram, ln({chance["a"]}) - ln({chance["r"]}) as log_ratio from n {" ".join(joins)}),
s as (select url, any_value(action) as action, any_value(held) as held, avg(log_ratio) as score from g join l using (gram) group by url),
q as (
  select avg(score) filter (action = 'allow') as ma, avg(score) filter (action = 'block') as mb,
    stddev_pop(score) filter (action = 'allow') as sa, stddev_pop(score) filter (action = 'block') as sb from s where held
)
select page_id, host, path, rule,
  coalesce(j.action, case when score < (select (ma * sb + mb * sa) / (sa + sb) from q) then 'block' else 'allow' end) as verdict
from j left join s using (url)
"""


def licenses_sql(templates: Sequence[tuple[str, str]], least: float) -> str:
    def tokens(text: str) -> str:
        return (
            f"list_filter(regexp_split_to_array(translate({text}, '{UPPER}', '{LOWER}'), "
            f"'[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')"
        )

    values = ", ".join(f"({i}, {_quoted(name)}, {_quoted(text)})" for i, (name, text) in enumerate(templates))
    return f"""
with t as (select i as t, license, {tokens("body")} as w from (values {values}) v(i, license, body)),
tb as (select t, license, array_to_string(w[i : i + 1], ' ') as k, count(*) as n from t, lateral (select unnest(range(1, len(w))) as i) group by all),
ts as (select t, sum(n) as size from tb group by t),
d as (select doc_id, replace(coalesce(text, ''), chr(13), ' ') as text from documents),
g as (
  select doc_id, 1 as level, unnest(string_split(text, chr(10))) as s, generate_subscripts(string_split(text, chr(10)), 1) as n from d
  union all
  select doc_id, 2, unnest(regexp_split_to_array(text, '\\n\\n+')), generate_subscripts(regexp_split_to_array(text, '\\n\\n+'), 1) from d
  union all select doc_id, 3, text, 1 from d
),
w as (select doc_id, level, n, {tokens("s")} as w from g),
b as (
  select doc_id, level, n, array_to_string(w[i : i + 1], ' ') as k, count(*) as c
  from w, lateral (select unnest(range(1, len(w))) as i) group by all
),
bs as (select doc_id, level, n, sum(c) as size from b group by all),
i as (select doc_id, level, b.n, t, license, sum(least(c, tb.n)) as common from b join tb using (k) group by all),
h as (
  select doc_id, t, license, k, i as place, tb.n as times, row_number() over (partition by doc_id, t, k order by i) as nth
  from (select doc_id, i, array_to_string(w[i : i + 1], ' ') as k from w, lateral (select unnest(range(1, len(w))) as i) where level = 3)
  join tb using (k)
),
e as (
  select h.doc_id, h.t, h.license, bs.size as n, ts.size as size,
    greatest(coalesce(f.place + 1, 1), h.place - ts.size + 1) as low, least(h.place, greatest(bs.size - ts.size + 1, 1)) as high
  from h left join h f on h.doc_id = f.doc_id and h.t = f.t and h.k = f.k and f.nth = h.nth - h.times
  join ts on h.t = ts.t join bs on h.doc_id = bs.doc_id and bs.level = 3
),
v as (
  select doc_id, t, license, n, size, low as place, 1 as step from e where low <= high
  union all select doc_id, t, license, n, size, high + 1, -1 from e where low <= high
),
x as (
  select doc_id, license, n, size, sum(sum(step)) over (partition by doc_id, t order by place) as common
  from v group by doc_id, t, license, n, size, place
),
a as (
  select doc_id, license, 2 * common / (bs.size + ts.size)::double as dice from i join bs using (doc_id, level, n) join ts using (t)
  union all select doc_id, license, 2 * common / (least(n, size) + size)::double from x
),
m as (select doc_id, license, max(dice) as dice from a where dice >= {least} group by all)
select doc_id, count(license)::bigint as n_licenses, coalesce(string_agg(license, ',' order by license), '') as licenses,
  coalesce(max(dice), 0.0)::double as best_dice
from documents left join m using (doc_id) group by doc_id
"""


#: crc32 for SQL that lacks it: ``crc_table`` is one row with the 256 values that the polynomial gives.
_CRC_TABLE = """
crc_table as (
  select list_transform(range(256), lambda x: list_reduce(
    list_prepend(x::ubigint, [0, 0, 0, 0, 0, 0, 0, 0]::ubigint[]), lambda c, z: xor(c >> 1, (3988292384 * (c & 1))::ubigint))) as crc
)
"""


def _crc32(text: str) -> str:
    """Unsigned crc32 of an ASCII text, given a row of ``crc_table``."""
    values = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::ubigint)"
    return (
        f"case when {text} = '' then 0 else xor(list_reduce(list_prepend(4294967295::ubigint, {values}), "
        f"lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255)::int + 1])), 4294967295::ubigint)::bigint end"
    )


def periodic_runs_sql() -> str:
    """Runs by comparing words at four equal distances, then every word with the one a period later."""
    return f"""
with {_CRC_TABLE},
d as (
  select doc_id, {_crc32("coalesce(doc_id::varchar, '')")} as h,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as o
  from documents, crc_table
),
g as (
  select doc_id, o, len(o) as n, h % 10 = 0 and len(o) > 0 as planted,
    case when len(o) > 0 then (h // 10) % len(o) end as a, 3 + (h // 10) % 8 as parts
  from d
),
p as (select *, 1 + (n - a) // parts as p from g),
w as (
  select doc_id, n, case when planted
    then o[:a] || flatten(list_transform(range((n - a) // p + 1), lambda j: o[a + 1 : a + p]))[: n - a] else o end as w
  from p
),
q as (select doc_id, n, w, unnest(range(1, n // 4 + 1)) as q from w where n >= 6),
m as (select doc_id, n, w, q, unnest(range(0, (n - 1) // q - 2)) * q + 1 as i from q),
c as (
  select doc_id, q, any_value(n) as n, any_value(w) as w from m
  where w[i] = w[i + q] and w[i] = w[i + 2 * q] and w[i] = w[i + 3 * q] group by all
),
e as (select doc_id, q, w, unnest(range(1, n - q + 1)) as i from c),
same as (select doc_id, q, i, i - row_number() over (partition by doc_id, q order by i) as island from e where w[i] = w[i + q]),
stretch as (select doc_id, q, min(i) - 1 as s, count(*) + q as l from same group by doc_id, q, island),
r as (select doc_id, s, l, min(q) as q from stretch where l >= greatest(6, 4 * q) group by doc_id, s, l),
listed as (
  select doc_id, count(*) as n_runs, arg_min({{'s': s, 'l': l, 'q': q}}, {{'a': -l, 'b': s, 'c': q}}) as best,
    string_agg(s || ',' || l || ',' || q || chr(10), '' order by s, q) as shown
  from r group by doc_id
),
gone as (select distinct doc_id, unnest(range(s + q, s + l)) as i from r),
kept as (
  select doc_id, string_agg(x, ' ' order by i) as collapsed
  from (select doc_id, unnest(w) as x, unnest(range(n)) as i from w where doc_id in (select doc_id from r)) anti join gone using (doc_id, i)
  group by doc_id
)
select doc_id, coalesce(n_runs, 0)::bigint as n_runs, best.s::bigint as start, best.l::bigint as length, best.q::bigint as period,
  (1000 * best.l // best.q)::bigint as exponent_milli, sha256(coalesce(shown, '')) as runs_sha256,
  sha256(coalesce(collapsed, array_to_string(w, ' '))) as collapsed_sha256
from w left join listed using (doc_id) left join kept using (doc_id)
"""


def warc_sql(min_revisit_bytes: int) -> str:
    """Length and digest of every payload, and the first page of equal ones."""
    fours = " || ".join(f"to_base(('0x' || substr(d, {at}, 5))::bigint, 32, 4)" for at in range(1, 41, 5))
    return f"""
with p as (select page_id, strlen(coalesce(html, ''))::bigint as n, sha1(coalesce(html, '')) as d from pages),
f as (select *, min(page_id) over (partition by n, d) as first, translate({fours}, '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') as b from p),
r as (select *, n >= {min_revisit_bytes} and first is not null and page_id is distinct from first as again from f)
select page_id, n as payload_bytes, b as payload_digest, case when again then 'revisit' else 'response' end as record_type,
  case when again then first end as refers_to
from r
"""


def conversations_sql() -> str:
    """The cheapest edits turn by turn, with all states kept."""
    key = "(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '))"
    white = " || ".join(f"chr({c})" for c in (32, 9, 10, 11, 12, 13))
    return f"""
with recursive {_CRC_TABLE},
b as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, {_crc32(key)} % 20 as k
  from conversations, crc_table
),
d as (
  select conv_id, turn, case when k = 4 then 'user' else role end as role,
    case k when 1 then '' when 2 then translate(text, '.!?', '') else text end as text,
    unnest(case when k = 3 then [0, 1] else [0] end) as copy
  from b where k <> 0
),
o as (
  select *, rtrim(text, {white}) as shown, left(role, 1) as initial,
    row_number() over (partition by conv_id order by turn nulls first, role, md5(text), copy) as i,
    row_number() over (partition by conv_id, role, text order by turn nulls first, copy) > 1 as again
  from d
),
f as (
  select *, shown = '' as blank, again and shown <> '' as dup,
    not again and shown <> '' and right(shown, 1) not in ('.', '!', '?') as cut,
    initial || lead(initial) over (partition by conv_id order by i) not in ('su', 'ua', 'au') as illegal
  from o
),
counted as (
  select conv_id, max(turn) - min(turn) + 1 - count(distinct turn) as gaps, count(*) as n, count(*) filter (blank) as blank,
    count(*) filter (dup) as duplicate, count(*) filter (cut) as truncated, count(*) filter (illegal) as illegal
  from f group by conv_id
),
inserted(state, mid, price, letters, added) as (
  values (0, 0, 0, '', []::varchar[]), (1, 1, 0, '', []), (2, 2, 0, '', []), (3, 3, 0, '', []),
    (0, 2, 5, 'I', ['user:']), (1, 2, 5, 'I', ['user:']), (2, 3, 5, 'I', ['assistant:']), (3, 2, 5, 'I', ['user:']),
    (0, 3, 10, 'II', ['user:', 'assistant:']), (1, 3, 10, 'II', ['user:', 'assistant:']),
    (2, 2, 10, 'II', ['assistant:', 'user:']), (3, 3, 10, 'II', ['user:', 'assistant:'])
),
edited(mid, letter, initial, next, price, given) as (
  values (0, 'D', null, 0, 2, null), (1, 'D', null, 1, 2, null), (2, 'D', null, 2, 2, null), (3, 'D', null, 3, 2, null),
    (0, 'K', 's', 1, 0, null), (0, 'K', 'u', 2, 0, null), (1, 'K', 'u', 2, 0, null), (3, 'K', 'u', 2, 0, null), (2, 'K', 'a', 3, 0, null),
    (0, 'R', null, 2, 1, 'user'), (1, 'R', null, 2, 1, 'user'), (3, 'R', null, 2, 1, 'user'), (2, 'R', null, 3, 1, 'assistant')
),
s as (
  select conv_id, 0::bigint as i, 0 as state, {{'cost': 0::bigint, 'audit': ''}} as best, []::varchar[] as fixed from counted
  union all
  select conv_id, i, state, min(best), arg_min(fixed, best) from (
    select s.conv_id, f.i, e.next as state,
      {{'cost': s.best.cost + n.price + e.price + case when f.cut and e.letter <> 'D' then 5 else 0 end, 'audit': s.best.audit || n.letters || e.letter}} as best,
      s.fixed || n.added || case when e.letter = 'D' then [] else [coalesce(e.given, f.role) || ':' || f.text] end as fixed
    from s join f on f.conv_id is not distinct from s.conv_id and f.i = s.i + 1
    join inserted n on n.state = s.state join edited e on e.mid = n.mid
    where (e.letter = 'D' or not (f.blank or f.dup)) and (e.initial is null or e.initial = f.initial)
  ) group by conv_id, i, state
),
ended as (
  select s.conv_id, {{'cost': s.best.cost + n.price, 'audit': s.best.audit || n.letters}} as best, s.fixed || n.added as fixed
  from s join counted c on c.conv_id is not distinct from s.conv_id and c.n = s.i join inserted n on n.state = s.state
  where n.mid in (0, 3)
),
r as (select conv_id, min(best) as best, arg_min(fixed, best) as fixed from ended group by conv_id)
select a.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate,
  coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal, coalesce(best.cost, 0)::bigint as cost,
  coalesce(best.audit, '') as audit, sha256(coalesce(array_to_string(fixed, chr(10)), '')) as repaired_sha256
from (select distinct conv_id from conversations) a
left join counted c on c.conv_id is not distinct from a.conv_id left join r on r.conv_id is not distinct from a.conv_id
"""
