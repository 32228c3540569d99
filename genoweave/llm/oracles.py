"""SQL that gives the rows of those queries that SQL can express."""

from __future__ import annotations

from genoweave.llm.rules import RULES, STOP_WORDS

_SPACE = r"[\x20\x09-\x0D]+"
_WORDS = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"
_DOCS = f"d as (select doc_id, text, {_WORDS} as words from (select doc_id, coalesce(text, '') as text from documents))"

BLOCK_ANCHORS = f"""
with {_DOCS},
win as (select doc_id, i, list_slice(words, i, i + 12) as key from
  (select doc_id, words, unnest(range(1, len(words) - 11)) as i from d where len(words) >= 13)),
f as (select key, min(doc_id) as least from win group by key),
cov as (select distinct doc_id, unnest(range(i, i + 13)) as p from
  (select win.doc_id, i from win join f on win.key = f.key where least < win.doc_id)),
gone as (select doc_id, list(p) as ps from cov group by doc_id)
select d.doc_id, cast(len(words) as bigint) as n_words, cast(coalesce(len(ps), 0) as bigint) as n_removed,
  sha256(coalesce(array_to_string(case when ps is null then words else
    list_transform(list_filter(range(1, len(words) + 1), lambda i: not list_contains(ps, i)), lambda i: words[i]) end, ' '), '')) as kept_sha256
from d left join gone on d.doc_id = gone.doc_id
"""

PIVOT_TOP_K = """
with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as e from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id as query_id, v.vec_id, cast(list_inner_product(q.e, v.e) as bigint) as score
  from v as q, v where q.vec_id % 50 = 0 and q.vec_id <> v.vec_id)
select * from (select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank,
  vec_id, score from s) where rank <= 5
"""


def _rule(measure: str, divisor: str | None, least: float | None, most: float | None, words: int) -> str:
    value = measure if divisor is None else f"(case when {divisor} > 0 then {measure} / {divisor} else 0 end)"
    inside = " and ".join([f"{value} >= {least}"] * (least is not None) + [f"{value} <= {most}"] * (most is not None))
    return f"({inside})" if not words else f"(({inside}) or n_words < {words})"


_STOP = ", ".join("'" + x + "'" for x in sorted({y for z in STOP_WORDS.values() for y in z}))

QUALITY_RULES = rf"""
with {_DOCS},
runs as (select doc_id, i, list_slice(words, i, i + 4) as run from
  (select doc_id, words, unnest(range(1, len(words) - 3)) as i from d where len(words) >= 5)),
often as (select doc_id, run from runs group by doc_id, run having count(*) > 1),
rep as (select doc_id, count(distinct p) as n from
  (select runs.doc_id, unnest(range(i, i + 5)) as p from runs join often on runs.doc_id = often.doc_id and runs.run = often.run)
  group by doc_id),
m as (select d.doc_id, cast(len(words) as bigint) as n_words,
  cast(length(regexp_replace(text, '{_SPACE}', '', 'g')) as bigint) as word_chars,
  cast(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) as bigint) as n_symbols,
  cast(len(lines) as bigint) as n_lines, cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
  len(list_filter(words, lambda x: list_contains([{_STOP}], lower(x)))) as n_stop_words,
  cast(coalesce(rep.n, 0) as bigint) as n_repeat_words
  from (select *, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines from d) d
  left join rep on d.doc_id = rep.doc_id)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 10 or 100 * n_repeat_words > 20 * n_words) as base_failed,
  (not (n_words < 10 or 100 * n_repeat_words > 20 * n_words) and {" and ".join(_rule(*x) for x in RULES)}) as kept
from m
"""


def _nearest(book: str) -> str:
    """Every part's nearest entry of `book` (least distance, then least index)."""
    return (f"select rid, part, x, pair[2] as e, pair[1] as dist from (select p.rid, p.part, any_value(p.x) as x, "
            f"min([cast(p.xx + list_inner_product({book}.x, {book}.x) - 2 * list_inner_product(p.x, {book}.x) as bigint), {book}.e]) as pair "
            f"from p join {book} on p.part = {book}.part group by p.rid, p.part)")


def _refined(book: str, assigned: str) -> str:
    """Componentwise floored means of the assigned parts; an entry without parts stays."""
    return (f"select o.part, o.e, coalesce(m.x, o.x) as x from {book} o left join (select part, e, list(v order by pos) as x from "
            f"(select part, e, pos, floor(sum(x[pos]) / count(*)) as v from {assigned}, range(1, len(x) + 1) r(pos) group by part, e, pos) "
            f"group by part, e) m on o.part = m.part and o.e = m.e")


VECTOR_CODES = f"""
with k as (select row_number() over (order by vec_id, embedding) as rid, vec_id, label,
  list_transform(embedding, lambda y: floor(256 * cast(y as double))) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda y: y is null or not isfinite(y))) = 0),
c as (select rid, part, list_slice(v, part * (len(v) // 16) + 1, (part + 1) * (len(v) // 16)) as x from k, range(0, 16) r(part)),
p as materialized (select *, list_inner_product(x, x) as xx from c),
b0 as (select part, cast(rid - 1 as bigint) as e, x from c where rid <= 64),
a0 as materialized ({_nearest("b0")}), b1 as materialized ({_refined("b0", "a0")}),
a1 as materialized ({_nearest("b1")}), b2 as materialized ({_refined("b1", "a1")}),
a2 as materialized ({_nearest("b2")}),
done as (select rid, string_agg(printf('%02x', e), '' order by part) as code, cast(sum(dist) as bigint) as error from a2 group by rid),
digest as (select sha256(string_agg(cast(cast(y as bigint) as varchar), ',' order by part, e, pos)) as codebooks_sha256
  from (select part, e, pos, x[pos] as y from b2, range(1, len(x) + 1) r(pos)))
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256
from done join k on done.rid = k.rid, digest
"""

PREFIX_TRIE = r"""
with o as (select conv_id, cast(row_number() over (partition by conv_id order by turn nulls first, md5(length(role)||':'||role||text)) - 1 as bigint) as pos, role, text
  from (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null)),
c as (select conv_id, conv_id - ((conv_id % 20) + 20) % 20 as base, xor(4294967295, list_reduce(
    list_transform(string_split(cast(conv_id as varchar), ''), lambda x: cast(ascii(x) as bigint)),
    lambda a, b: list_reduce(range(8), lambda y, z: xor(y >> 1, 3988292384 * (y & 1)), xor(a, b)), cast(4294967295 as bigint))) % 4 as h
  from (select distinct conv_id from o)),
s as (select c.conv_id, 0 as own, pos, role, text from c join o on o.conv_id = c.base and pos < h union all
  select c.conv_id, 1, pos, role, text from c join o on o.conv_id = c.conv_id and pos >= h),
w as (select c.conv_id, coalesce(path, []) as path from c left join
  (select conv_id, list(struct_pack(role := role, text := text) order by own, pos) as path from s group by conv_id) t on c.conv_id = t.conv_id),
n as materialized (select path[1:depth] as prefix, depth, min(conv_id) as conv_id, count(*) as n_convs,
    coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (len(path) = depth), '') as ends
  from w, range(0, len(path) + 1) r(depth) group by all),
kids as (select prefix[1:depth - 1] as prefix, count(*) as n from n where depth > 0 group by all),
v as materialized (select n.*, coalesce(kids.n, 0) as n_children,
    case when depth = 0 then 0 else (n_convs - 1) * len(regexp_extract_all(n.prefix[depth].text, '[^\x20\x09-\x0D]+')) end as saved
  from n left join kids on n.prefix = kids.prefix),
below as (select prefix[1:d] as prefix, sum(saved) as saved, count(*) filter (n_children = 0) as leaves from v, range(0, depth + 1) r(d) group by all)
select v.conv_id, v.depth, up.conv_id as parent_conv_id, v.n_convs, v.n_children, cast(leaves as bigint) as n_leaves,
  cast(below.saved as bigint) as saved_tokens, sha256(v.ends) as ends_sha256
from v join below on v.prefix = below.prefix left join n up on up.depth = v.depth - 1 and up.prefix = v.prefix[1:v.depth - 1]
"""

LINE_DEDUP = r"""
with l as (select rid, doc_id, pos, line, translate(trim(line, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from (select rid, doc_id, unnest(lines) as line, unnest(range(len(lines))) as pos from
    (select row_number() over () as rid, doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents))),
often as (select key from l where key <> '' group by key having count(distinct doc_id) >= 10)
select any_value(doc_id) as doc_id, count(*) as n_lines, count(often.key) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (often.key is null), '')) as kept_sha256
from l left join often on l.key = often.key group by rid
"""
