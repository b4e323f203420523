"""DuckDB statements of the operators that SQL can express.

The method's verdicts are written again here, from the same tables of rules and
templates, as plain list functions and groupings.
"""

from __future__ import annotations

import math

from occrisk.llm import op1_license, op3_quality


def _quoted(words) -> str:
    return ", ".join("'" + w + "'" for w in words)


def _licenses() -> str:
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    capitals, small = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    hits = " union all ".join(
        f"select doc_id, i - 1 as place, '{label}' as label from numbered where "
        + " and ".join((f"w = '{p}'" if k == 0 else f"words[i + {k}] = '{p}'") for k, p in enumerate(phrase.split()))
        for label, phrase in op1_license.PHRASES
    )
    templates = ", ".join(
        f"('{label}', [{_quoted(sorted(set(words.split())))}], {len(set(words.split()))}, {math.ceil(op1_license.THRESHOLD * len(set(words.split())) - 1e-9)}, {op1_license.stretch_of(words)})"
        for label, words in op1_license.TEMPLATES
    )
    return f"""
with low as (select doc_id, translate(coalesce(text, ''), '{capitals}', '{small}') as t from documents),
worded as (select doc_id, t, regexp_extract_all(t, '{word}') as words from low),
numbered as (select doc_id, words, unnest(words) as w, unnest(range(1, len(words) + 1)) as i from worded),
hits as ({hits}),
base as (select doc_id, count(*) as n_base, min(place) as first_word, max(place) as last_word, string_agg(distinct label, ',' order by label) as base_labels from hits group by doc_id),
templates(label, tokens, size, need, stretch) as (values {templates}),
places as (select n.doc_id, t.label, t.size, t.need, t.stretch, n.i, n.w from numbered n join (select *, unnest(tokens) as token from templates) t on n.w = t.token),
near as (select a.doc_id, a.label, a.size, a.need, a.stretch, a.i, count(distinct b.w) as n from places a join places b
  on a.doc_id = b.doc_id and a.label = b.label and b.i >= a.i and b.i < a.i + a.stretch
  where (a.doc_id, a.label) in (select (doc_id, label) from places group by doc_id, label having count(distinct w) >= any_value(need)) group by all),
matched as (select doc_id, label, max(n / size::double) as share, any_value(stretch) as stretch, list(i order by i) as starts from near where n >= need group by doc_id, label),
counted as (select *, list_reduce(list_prepend({{'n': 0, 'i': 0::bigint}}, list_transform(starts, lambda x: {{'n': 0, 'i': x::bigint}})),
  lambda a, x: case when x.i >= a.i then {{'n': a.n + 1, 'i': (x.i + stretch)::bigint}} else a end).n as apart from matched),
method as (select doc_id, max(share) as best, sum(apart) as n_blocks from counted group by doc_id),
labels as (select doc_id, string_agg(distinct label, ',' order by label) as labels from (select doc_id, label from hits union all select doc_id, label from matched) group by doc_id)
select w.doc_id, cast(len(w.words) as bigint) as n_words, cast(coalesce(b.n_base, 0) as bigint) as n_base,
  cast(b.first_word as bigint) as first_word, cast(b.last_word as bigint) as last_word,
  coalesce(b.base_labels, '') as base_labels, coalesce(l.labels, '') as labels,
  greatest(coalesce(m.best, 0.0::double), case when coalesce(b.n_base, 0) > 0 then 1.0::double else 0.0::double end) as score,
  cast(coalesce(m.n_blocks, 0) as bigint) as n_blocks
from worded w left join base b using (doc_id) left join method m using (doc_id) left join labels l using (doc_id)
"""


def _quality() -> str:
    word = r"[^\x20\x09-\x0D]+"
    metric = {
        "n_words": "n_words",
        "mean_word_chars": "word_chars / nullif(n_words, 0)",
        "symbols_per_word": "n_symbols / nullif(n_words, 0)",
        "marks_per_word": "n_marks / nullif(n_words, 0)",
        "capitals_share": "n_capitals / nullif(n_letters, 0)",
        "stop_word_share": "n_stop / nullif(n_words, 0)",
        "dup_line_share": "n_dup_lines / nullif(n_lines, 0)",
        "echo_word_share": "n_echo / nullif(n_words, 0)",
        "repeat_word_share": "n_repeat_words / nullif(n_words, 0)",
    }
    sides = [
        f"coalesce({metric[r.metric]}, 0) {sign} {bound}"
        for r in op3_quality.RULES
        for sign, bound in ((">=", r.low), ("<=", r.high))
        if bound is not None
    ]
    return f"""
with texts as (select doc_id, coalesce(text, '') as t from documents),
worded as (select doc_id, t, regexp_extract_all(t, '{word}') as words, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{word}')) as lines from texts),
numbered as (select doc_id, unnest(words) as w, unnest(range(1, len(words) + 1)) as i from worded),
windows as (
  select doc_id, i, w, lag(w) over o as before, case when lead(w, 7) over o is not null then
    w || ' ' || {" || ' ' || ".join(f"lead(w, {k}) over o" for k in range(1, 8))} end as eight
  from numbered window o as (partition by doc_id order by i)),
counted as (select doc_id, i, w, before, case when eight is not null and count(*) over (partition by doc_id, eight) > 1 then i end as start from windows),
marked as (select doc_id, i, w, before, max(start) over (partition by doc_id order by i) as latest from counted),
repeated as (select doc_id, count(*) filter (where latest > i - 8) as n_repeat_words, count(*) filter (where before = w) as n_echo,
  count(*) filter (where lower(rtrim(w, '.,;:!?')) in ({_quoted(op3_quality.STOP_WORDS)})) as n_stop from marked group by doc_id),
sizes as (
  select doc_id, cast(len(words) as bigint) as n_words, cast(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) as bigint) as word_chars,
    cast(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) as bigint) as n_symbols, length(regexp_replace(t, '[^!?]+', '', 'g')) as n_marks,
    length(regexp_replace(t, '[^A-Z]+', '', 'g')) as n_capitals, length(regexp_replace(t, '[^A-Za-z]+', '', 'g')) as n_letters,
    len(lines) as n_lines, cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines
  from worded),
joined as (select s.*, cast(coalesce(r.n_repeat_words, 0) as bigint) as n_repeat_words, coalesce(r.n_echo, 0) as n_echo, coalesce(r.n_stop, 0) as n_stop from sizes s left join repeated r using (doc_id))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
  not (n_words < 20 or 100 * n_repeat_words > 30 * n_words) and {" and ".join(sides)} as kept,
  round(coalesce({metric["mean_word_chars"]}, 0), 6) as mean_word_chars,
  round(coalesce({metric["symbols_per_word"]}, 0), 6) as symbols_per_word,
  round(coalesce({metric["stop_word_share"]}, 0), 6) as stop_word_share
from joined
"""


_NEGATIVES = """
with rows as (
  select row_number() over () as r, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scores as (
  select a.r as a, a.vec_id as anchor_id, a.label = b.label as same, b.vec_id as id, list_inner_product(a.v, b.v)::bigint as score
  from rows a join rows b on a.r <> b.r where a.vec_id % 50 = 0),
positives as (
  select *, row_number() over (partition by a order by score desc, id) as k from scores where same qualify k <= 5)
select p.anchor_id, p.id as positive_id, row_number() over (partition by p.a, p.k order by s.score desc, s.id)::integer as rank, s.id as negative_id,
       p.score as positive_score, s.score as negative_score, p.k as positive_rank
from positives p join scores s on p.a = s.a and not s.same and 50 * p.score <= 100 * s.score and 100 * s.score <= 95 * p.score
qualify rank <= 3
"""

# The fold of every leaf is written as a recursion over levels, apart from the proofs.
_MERKLE = """
with recursive steps as (
  select list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), lambda c, i: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as tab),
fields as (
  select doc_id, lang, coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') as ahead,
         n_chars, coalesce(strlen(text) || ':' || text, '-') as behind,
         xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::varchar, ''), lambda c: ord(c)::bigint)), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) as crc
  from documents, steps),
leaves as (
  select doc_id, lang, sha256(ahead || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') || behind) as leaf,
         case when crc % 7 = 0 and n_chars is not null then sha256(ahead || strlen((n_chars + 1)::varchar) || ':' || (n_chars + 1) || behind) end as tampered
  from fields),
placed as (select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as i, count(*) over (partition by lang) as size, dense_rank() over (order by lang nulls first) as t from leaves),
lower as (
  select 0 as level, t, i, leaf as d, size from placed
  union all
  select level + 1, t, i // 2, sha256(string_agg(d, '' order by i)), any_value((size + 1) // 2) from lower where size > 1 group by level, t, i // 2),
subroots as (select t, d as subroot, level as height from lower where size = 1),
upper as (
  select 0 as level, t - 1 as i, subroot as d, (select count(*) from subroots) as size from subroots
  union all
  select level + 1, i // 2, sha256(string_agg(d, '' order by i)), any_value((size + 1) // 2) from upper where size > 1 group by level, i // 2),
nodes as (
  select t, level, i, d from lower where size > 1
  union all
  select s.t, s.height + u.level, u.i, u.d from subroots s, upper u where u.size > 1),
walked as (
  select p.t, p.i, p.doc_id, p.leaf, s.height, coalesce(p.tampered, p.leaf) as folded, 0 as level, p.i as node, '' as siblings
  from placed p join subroots s on p.t = s.t
  union all
  select w.t, w.i, w.doc_id, w.leaf, w.height,
         case when b.d is null then sha256(w.folded) when here % 2 = 0 then sha256(w.folded || b.d) else sha256(b.d || w.folded) end,
         w.level + 1, here // 2, w.siblings || coalesce(b.d, '')
  from (select *, case when level = height then t - 1 else node end as here from walked) w
  join nodes own on own.t = w.t and own.level = w.level and own.i = here
  left join nodes b on b.t = w.t and b.level = w.level and b.i = xor(here, 1)),
ends as (select * from walked where level = height + (select max(level) from upper))
select e.doc_id, e.leaf, s.subroot, r.d as root, sha256(e.siblings) as proof_sha256, e.folded as folded_root, e.folded = r.d as verified
from ends e join subroots s on e.t = s.t, (select d from upper where size = 1) r
"""


SQL = {
    "op1_license_scan": _licenses(),
    "op3_quality_rules": _quality(),
    "op12_hard_negatives": _NEGATIVES,
    "op13_merkle_manifest": _MERKLE,
}
