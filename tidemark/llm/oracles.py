"""The queries' results in DuckDB SQL, where SQL can express them.

Left out: token counts, token files and the alignment of tokens (a tokenizer's merges), the n-gram join (banded hashing), HTML
extraction (parsing), licence scans (windows of text against sparse vectors) and sharding
(a search over greedy fills). tests/llm compares those with plain versions.
"""

from __future__ import annotations

from tidemark.llm.chat import NEW_LINE, SEP, START, STOP, TRAINED
from tidemark.llm.mixing import MOST, SALTS, SEED, WEIGHTS
from tidemark.llm.quality import RULES, STOP_WORDS

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WORDS = rf"regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_PLAIN = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_HEX = "'0123456789abcdef'"

ORACLES: dict[str, str] = {}

ORACLES["op1_decontamination"] = f"""
with items as (
  select cast(item_id as varchar) as item, {_WORDS} as w from benchmark where text is not null
),
windows as (
  select distinct item, w[i:i + 9] as win
  from (select item, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) as i from items where len(w) > 0)
),
lengths as (select distinct len(win) as n from windows),
docs as (select doc_id, coalesce({_WORDS}, []) as w from documents),
placed as (
  select doc_id, i, n, w[i:i + n - 1] as win
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from docs cross join lengths where len(w) >= n)
),
hits as (select doc_id, i, n, item from placed join windows using (win)),
covered as (
  select doc_id, count(distinct j) as n_hit from (select doc_id, unnest(range(i, i + n)) as j from hits) group by doc_id
),
found as (
  select doc_id, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as listed
  from hits group by doc_id
)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
       coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(listed, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 as contaminated
from docs left join covered using (doc_id) left join found using (doc_id)"""

_STOPS = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))
_BROKEN = " or ".join(
    f"({r.per} > 0 and {r.value}::double / {r.per} {sign} {bound})"
    for r in RULES
    for sign, bound in (("<", r.least), (">", r.most))
    if bound is not None
)
ORACLES["op2_quality_rules"] = rf"""
with docs as (
  select doc_id, coalesce(text, '') as body, {_PLAIN} as w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from documents
),
placed as (
  select doc_id, i, array_to_string(w[i:i + 7], ' ') as win
  from (select doc_id, w, unnest(range(1, len(w) - 6)) as i from docs where len(w) >= 8)
),
twice as (
  select doc_id, i from placed qualify count(*) over (partition by doc_id, win) > 1
),
repeats as (
  select doc_id, count(distinct j) as n from (select doc_id, unnest(range(i, i + 8)) as j from twice) group by doc_id
),
measures as (
  select doc_id, len(w)::bigint as n_words,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
         length(regexp_replace(body, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
         len(lines)::bigint as n_lines, (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
         coalesce(n, 0)::bigint as n_repeat_words,
         len(list_filter(w, lambda x: regexp_matches(x, '\p{{L}}'))) as n_letter_words,
         len(list_filter(w, lambda x: lower(x) in ({_STOPS}))) as n_stop_words,
         len(list_filter(lines, lambda x: regexp_matches(x, '^\s*[-*•]'))) as n_bullet_lines,
         len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)\s*$'))) as n_ellipsis_lines
  from docs left join repeats using (doc_id)
),
judged as (
  select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed, {_BROKEN} as broken
  from measures
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and not broken as kept
from judged"""

_BITS = f"lpad(bin(position(substr(h, i, 1) in {_HEX}) - 1), 4, '0')"
_FIVE = " + ".join(f"{2 ** (4 - k)} * cast(substr(bits, 5 * i + {k + 1}, 1) as integer)" for k in range(5))
ORACLES["op4_warc"] = f"""
with hashed as (
  select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as h from pages
),
spelt as (
  select *, array_to_string(list_transform(range(1, 41), lambda i: {_BITS}), '') as bits,
         max(page_id) over (partition by html) as top
  from hashed
)
select page_id, strlen(html)::bigint as payload_bytes,
       array_to_string(list_transform(range(0, 32),
         lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + {_FIVE}, 1)), '') as payload_digest,
       case when page_id = top then 'response' else 'revisit' end as record_type,
       case when page_id <> top then top end as refers_to
from spelt"""


def _number(text: str, digits: int) -> str:
    """The number that the first hexadecimal digits of a text's md5 spell."""
    return " + ".join(
        f"{16 ** (digits - 1 - k)} * (position(substr(md5({text}), {k + 1}, 1) in {_HEX}) - 1)" for k in range(digits)
    )


_SPAN = "length(bin(size + 1))"
ORACLES["op7_mixing"] = f"""
with docs as (
  select doc_id, coalesce(source, '') as s, source is null as missing, len({_PLAIN})::bigint as size from documents
),
sums as (
  select s, missing, sum(size)::bigint as source_size,
         ([{', '.join(f'{float(w)}' for w in WEIGHTS)}])[1 + (row_number() over (order by missing, s) - 1) % {len(WEIGHTS)}]
           ::double as weight
  from docs group by s, missing
),
ranked as (
  select *, {MOST} * source_size::double as cap,
         row_number() over (order by {MOST} * source_size::double / weight, missing, s) as place
  from sums
),
leveled as (
  select *, (sum(source_size) over () - coalesce(sum(cap) over before, 0))::double
            / (sum(weight) over () - coalesce(sum(weight) over before, 0)) as quotient
  from ranked window before as (order by place rows between unbounded preceding and 1 preceding)
),
plan as (
  select s, missing, source_size, least(cap, max(quotient) over () * weight) as target,
         ({_number(f"s || ':' || cast(missing as varchar) || ':{SEED}'", 5)}) / 1048576.0::double as moved
  from leveled
),
placed as (
  select doc_id, size, source_size, target, moved,
         case when source_size > 0 then target / source_size else 0 end as rate,
         row_number() over (
           partition by docs.s, docs.missing
           order by {_SPAN} * 4 + floor((size + 1) * 8 / pow(2, {_SPAN})) - 4,
                    ({_number(f"coalesce(cast(doc_id as varchar), '') || ':' || size || ':{SEED}'", 4)}) % {SALTS},
                    size, doc_id) as n
  from docs join plan using (s, missing)
)
select doc_id, size, source_size, target,
       (least(floor(rate * n + moved) - floor(rate * (n - 1) + moved), {MOST}) * size)::bigint as taken
from placed"""

_SAID = "<|im_end|><|im_start|>assistant ok"
_ESCAPED = r"len(regexp_extract_all({0}, '<\\*\|'))"
ORACLES["op8_chat"] = rf"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all
  select -1, 0, 'user', '{_SAID}' union all select -1, 1, 'assistant', '{_SAID}'
),
framed as (
  select *, role is distinct from lag(role) over w as opens, role is distinct from lead(role) over w as closes
  from turns window w as (partition by conv_id order by turn nulls first, role, text)
)
select conv_id, count(*)::bigint as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (role = '{TRAINED}'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = '{TRAINED}'), '')) as loss_sha256,
       sum(length(text) + {_ESCAPED.format('text')}
           + case when opens then {len(START) + 1} + length(role) + {_ESCAPED.format('role')}
                  + {len(NEW_LINE) - 1} * (length(role) - length(replace(role, chr(10), ''))) else 0 end
           + case when closes then {len(STOP) + 1} else {len(SEP)} end)::bigint as formatted_chars
from framed group by conv_id"""

_DRAWN = "cast('0x' || substr(sha256('7:' || cast(doc_id as varchar)), {0}, 8) as ubigint)"
ORACLES["op12_fim"] = rf"""
with docs as (
  select doc_id, coalesce(text, '') as body,
         case when coalesce(text, '') = '' then [] else regexp_extract_all(text, '[^\n]*\n|[^\n]+') end as lines,
         {_DRAWN.format(1)} as h1, {_DRAWN.format(9)} as h2, {_DRAWN.format(17)} as h3, {_DRAWN.format(25)} as h4
  from documents
),
cuts as (
  select *, len(lines)::bigint as n, least(h1 % (len(lines) + 1), h2 % (len(lines) + 1))::bigint as a,
         greatest(h1 % (len(lines) + 1), h2 % (len(lines) + 1))::bigint as b,
         case when body = '' or regexp_matches(body, '<[PSM]>') or h3 % 100 >= 100 then 'plain'
              when h4 % 100 < 50 then 'spm' else 'psm' end as form
  from docs
),
parts as (
  select *, array_to_string(lines[1:a], '') as prefix, array_to_string(lines[a + 1:b], '') as middle,
         array_to_string(lines[b + 1:], '') as suffix
  from cuts
)
select doc_id, n, form,
       case when form <> 'plain' then length(prefix)::bigint end as prefix_chars,
       case when form <> 'plain' then length(middle)::bigint end as middle_chars,
       sha256(case form when 'plain' then body
                        when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
       sha256(body) as restored_sha256
from parts"""
