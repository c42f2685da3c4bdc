"""Check SQL of the queries that SQL can express."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _fold(column: str) -> str:
    return f"translate(coalesce({column}, ''), '{_UPPER}', '{_LOWER}')"


_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP9 = f"""
with d as (select doc_id, regexp_extract_all({_fold('text')}, '{_ALNUM}') as w from documents),
b as (select item_id, regexp_extract_all({_fold('text')}, '{_ALNUM}') as w from benchmark),
phrases as (
  select distinct item_id, least(len(w), 10) as n, array_to_string(w[k + 1:k + 10], ' ') as phrase
  from (select item_id, w, unnest(range(greatest(1, len(w) - 9))) as k from b where len(w) > 0)),
lengths as (select distinct n from phrases),
windows as (
  select doc_id, k, n, array_to_string(w[k + 1:k + n], ' ') as phrase
  from (select doc_id, w, n, unnest(range(len(w) - n + 1)) as k from d, lengths where len(w) >= n)),
hits as (select doc_id, k, n, item_id from windows join phrases using (n, phrase)),
covered as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(k, k + n)) as p from hits) group by doc_id),
found as (select doc_id, count(distinct item_id) as n_items,
            string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as ids
          from hits group by doc_id)
select d.doc_id, cast(len(d.w) as bigint) as n_words, cast(coalesce(c.n_hit, 0) as bigint) as n_hit,
  cast(coalesce(f.n_items, 0) as bigint) as n_items, sha256(coalesce(f.ids, '')) as items_sha256,
  coalesce(c.n_hit, 0) > 0 as contaminated
from d left join covered c using (doc_id) left join found f using (doc_id)
"""

_BLANKS = "' ' || chr(9) || chr(11) || chr(12) || chr(13)"

OP2 = f"""
with l as (
  select doc_id, unnest(range(len(x))) as i, unnest(x) as line
  from (select doc_id, string_split(text, chr(10)) as x from documents where text is not null)),
c as (select doc_id, i, trim(line, {_BLANKS}) as bare, row_number() over (partition by doc_id order by i) as k
      from l where trim(line, {_BLANKS}) <> ''),
w as (select doc_id, k, bare || chr(10) || lead(bare, 1) over d || chr(10) || lead(bare, 2) over d as win
      from c window d as (partition by doc_id order by k)),
later as (select doc_id, k from (select doc_id, k, row_number() over (partition by win order by doc_id, k) as nth
                                 from w where win is not null) where nth > 1),
gone as (select distinct c.doc_id, c.i from later join c on c.doc_id = later.doc_id and c.k between later.k and later.k + 2),
kept as (select l.doc_id, string_agg(l.line, chr(10) order by l.i) as text from l left join gone g using (doc_id, i)
         where g.i is null group by l.doc_id),
n as (select doc_id, count(*) as n_lines from c group by doc_id),
r as (select doc_id, count(*) as n_removed from gone group by doc_id)
select d.doc_id, case when d.text is null then null else coalesce(kept.text, '') end as text,
  cast(coalesce(n.n_lines, 0) as bigint) as n_lines, cast(coalesce(r.n_removed, 0) as bigint) as n_removed
from documents d left join kept using (doc_id) left join n using (doc_id) left join r using (doc_id)
"""

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_LETTERS = " || ".join(
    f"substr('{_BASE32}', cast(((('0x' || substr(h, {1 + 10 * run}, 10))::bigint >> {35 - 5 * k}) & 31) + 1 as int), 1)"
    for run in range(4) for k in range(8))

OP3 = f"""
with p as (select page_id, url, coalesce(html, '') as body from pages),
h as (select page_id, url, cast(strlen(body) as bigint) as payload_bytes, sha1(body) as h from p),
d as (select page_id, url, payload_bytes, {_LETTERS} as payload_digest, min(page_id) over (partition by h) as first from h)
select page_id, payload_bytes, payload_digest, case when page_id = first then 'response' else 'revisit' end as record_type,
  case when page_id = first then null else first end as refers_to,
  'GET ' || coalesce(nullif(regexp_extract(replace(replace(replace(coalesce(url, ''), chr(13), '%0D'), chr(10), '%0A'), 'WARC/1', 'WARC%2F1'), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)', 1), ''), '/') || ' HTTP/1.1' as request_line,
  cast(1 as bigint) as n_requests, cast(1 as bigint) as n_metadata
from d
"""

_ESCAPED = r"regexp_replace({0}, '<(\\*)\|', '<\1\\|', 'g')"

OP8 = f"""
with c as (
  select conv_id, turn, role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
a as (select *, case when role = 'assistant' then text else '' end as learned from c)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn)) as turns_sha256,
  cast(sum(length(learned)) as bigint) as loss_chars, sha256(string_agg(learned, '' order by turn)) as loss_sha256,
  cast(sum(24 + length({_ESCAPED.format('role')}) + length({_ESCAPED.format('text')})) as bigint) as formatted_chars
from a group by conv_id
"""

OP10 = f"""
with recursive d as (
  select doc_id, regexp_extract_all({_fold('text')}, '[^\x20\x09-\x0D]+') as w from documents),
s as (
  select distinct doc_id, array_to_string(w[k + 1:k + 5], ' ') as shingle
  from (select doc_id, w, unnest(range(greatest(1, len(w) - 4))) as k from d where len(w) > 0)),
n as (select doc_id, count(*) as n from s group by doc_id),
shared as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.shingle = b.shingle and a.doc_id < b.doc_id group by all),
links as (select a, b from shared join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 80 * (x.n + y.n - c)),
edges as (select a, b from links union select b, a from links),
reach as (select a as doc_id, b as other from edges union select r.doc_id, e.b from reach r join edges e on e.a = r.other),
low as (select doc_id, min(other) as m from reach group by doc_id)
select d.doc_id, cast(coalesce(n.n, 0) as bigint) as n_shingles, least(d.doc_id, coalesce(low.m, d.doc_id)) as component_id
from d left join n using (doc_id) left join low using (doc_id)
"""

# CRC-32 of an ASCII string, from a table made by the polynomial's rule.
_CRC_TABLE = ("list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], "
              "lambda c, z: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end))")


def _crc32(text: str, crc_table: str) -> str:
    return (f"xor(list_reduce(list_concat([4294967295::bigint], list_transform(string_split({text}, ''), lambda b: ascii(b)::bigint)), "
            f"lambda c, b: xor({crc_table}[(xor(c, b) & 255) + 1], c >> 8)), 4294967295::bigint)")


def _encoded(*values: str) -> str:
    return " || ".join(f"coalesce(strlen({v}::varchar)::varchar || ':' || {v}::varchar, '-')" for v in values)


_STEP = "list_transform(range((len({0}) + 1) // 2), lambda k: sha256({0}[2 * k + 1] || coalesce({0}[2 * k + 2], '')))"

OP11 = f"""
with recursive t as materialized (select {_CRC_TABLE} as crc_table),
d as (select doc_id, lang, sha256({_encoded('doc_id', 'source', 'lang', 'n_chars', 'text')}) as leaf,
        sha256({_encoded('doc_id', 'source', 'lang', '(n_chars::hugeint + 1)', 'text')}) as altered,
        coalesce({_crc32('doc_id::varchar', 't.crc_table')} % 7 = 0, false) as hit from documents, t),
numbered as (select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as pos from d),
trees as (select lang, list(leaf order by pos) as nodes from numbered group by lang),
levels as (
  select lang, 0 as level, nodes from trees
  union all select lang, level + 1, {_STEP.format('nodes')} from levels where len(nodes) > 1),
subroots as (select lang, level as height, nodes[1] as subroot, row_number() over (order by lang nulls first) - 1 as rank from levels where len(nodes) = 1),
tops as (
  select 0 as level, list(subroot order by rank) as nodes from subroots
  union all select level + 1, {_STEP.format('nodes')} from tops where len(nodes) > 1),
root as (select nodes[1] as root from tops where len(nodes) = 1),
steps as (
  select n.doc_id, n.leaf, n.pos, l.lang, l.level, l.nodes[xor(n.pos >> l.level, 1) + 1] as sibling, (n.pos >> l.level) & 1 = 1 as "right"
  from numbered n join levels l on n.lang is not distinct from l.lang and len(l.nodes) > 1
  union all
  select n.doc_id, n.leaf, n.pos, n.lang, s.height + o.level, o.nodes[xor(s.rank >> o.level, 1) + 1], (s.rank >> o.level) & 1 = 1
  from numbered n join subroots s on n.lang is not distinct from s.lang, tops o where len(o.nodes) > 1),
proofs as (select lang, pos, list(sibling order by level) as siblings, list("right" order by level) as turns from steps group by lang, pos),
fold as (
  select n.lang, n.pos, 0 as level, case when n.hit then n.altered else n.leaf end as now from numbered n
  union all
  select f.lang, f.pos, f.level + 1,
    sha256(case when turns[f.level + 1] then siblings[f.level + 1] || now else now || coalesce(siblings[f.level + 1], '') end)
  from fold f join proofs p on f.pos = p.pos and f.lang is not distinct from p.lang where f.level < len(turns)),
folded as (select lang, pos, arg_max(now, level) as folded_root from fold group by lang, pos)
select n.doc_id, n.leaf, s.subroot, r.root, sha256(coalesce(array_to_string(p.siblings, ''), '')) as proof_sha256, f.folded_root, f.folded_root = r.root as verified
from numbered n join subroots s on n.lang is not distinct from s.lang join folded f on n.pos = f.pos and n.lang is not distinct from f.lang
left join proofs p on n.pos = p.pos and n.lang is not distinct from p.lang, root r
"""

OP12 = f"""
with t as materialized (select {_CRC_TABLE} as crc_table),
d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w, {_crc32('doc_id::varchar', 't.crc_table')} as h from documents, t),
a as (select doc_id, w, len(w) as n, h % 10 = 0 as again, (h // 10) % len(w) as a, (h // 10) % 8 as e from d),
p as (select *, 1 + (n - a) // (3 + e) as p from a),
x as (select doc_id, n, i, w[1 + case when again and i >= a then a + (i - a) % p else i end] as word
      from (select *, unnest(range(n)) as i from p)),
same as (select a.doc_id, b.i - a.i as q, a.i from x a join x b on a.doc_id = b.doc_id and a.word = b.word and b.i > a.i and b.i - a.i <= a.n // 2),
stretches as (select doc_id, q, min(i) as start, count(*) + q as length
  from (select *, i - row_number() over (partition by doc_id, q order by i) as island from same) group by doc_id, q, island),
runs as (select doc_id, start, length, min(q) as period from stretches where length >= greatest(12, 2 * q) group by all),
lists as (select doc_id, count(*) as n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as lines from runs group by doc_id),
best as (select doc_id, start, length, period from runs qualify row_number() over (partition by doc_id order by length desc, start, period) = 1),
gone as (select distinct doc_id, unnest(range(start + period, start + length)) as i from runs),
kept as (select doc_id, string_agg(word, ' ' order by i) as text from x anti join gone using (doc_id, i) group by doc_id)
select d.doc_id, cast(coalesce(l.n_runs, 0) as bigint) as n_runs, cast(b.start as bigint) as start, cast(b.length as bigint) as length,
  cast(b.period as bigint) as period, cast(1000 * b.length // b.period as bigint) as exponent_milli,
  sha256(coalesce(l.lines, '')) as runs_sha256, sha256(coalesce(k.text, '')) as collapsed_sha256
from d left join lists l using (doc_id) left join best b using (doc_id) left join kept k using (doc_id)
"""
