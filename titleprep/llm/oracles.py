"""SQL that must give the same rows as the registered queries, where SQL can express them."""

from __future__ import annotations

from titleprep.llm.trie_oracle import CONVERSATION_TRIE
from titleprep.llm.url_filter import RULES
from titleprep.llm.vector_oracle import VECTOR_CODES

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

LINE_DEDUP = f"""
with split as (
  select doc_id, string_split(coalesce(text, ''), chr(10)) all_lines from documents),
lines as (
  select doc_id, unnest(all_lines) line, generate_subscripts(all_lines, 1) place from split),
keyed as (
  select *, translate(trim(line, {_SPACE}), '{_UPPER}', '{_LOWER}') k from lines),
repeated as (
  select k, max(doc_id) keeper
  from (select distinct doc_id, k from keyed where length(k) >= 20) x
  group by k having count(*) >= 3),
marked as (
  select l.*, r.k is not null and r.keeper <> l.doc_id gone
  from keyed l left join repeated r on r.k = l.k)
select doc_id, count(*) n_lines, count(*) filter (where gone) n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by place) filter (where not gone), '')) kept_sha256
from marked group by doc_id"""


def _rules(result) -> str:
    """The rules as a case expression, longest first."""
    cases = []
    for rule, verdict in sorted(RULES, key=lambda r: -len(r[0])):
        host, _, path = rule.partition("/")
        fits = f"(host = '{host}' or ends_with(host, '.{host}')) and starts_with(path, '/{path}')"
        cases.append(f"when {fits} then '{result(rule, verdict)}'")
    return f"case {' '.join(cases)} end"


def _chance(kind: str, order: int = 4) -> str:
    """Interpolated probability after contexts of 0 to ``order`` characters."""
    chance = "cast(1 as double) / 256"
    for k in range(order + 1):
        own, total, types = f"{kind}{k}", f"{kind}_n{k}", f"{kind}_t{k}"
        chance = (
            f"(case when {total} + {types} > 0 then ({own} + {types} * ({chance})) / ({total} + {types})"
            f" else {chance} end)"
        )
    return chance


_LEVELS = ", ".join(
    f"coalesce(max(s.{kind}) filter (where a.k = {k}), 0) {kind}{k},"
    f" coalesce(max(c.{kind}_n) filter (where a.k = {k}), 0) {kind}_n{k},"
    f" coalesce(max(c.{kind}_t) filter (where a.k = {k}), 0) {kind}_t{k}"
    for kind in ("yes", "no")
    for k in range(5)
)

URL_FILTER = f"""
with parts as (
  select page_id,
    case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end rest from pages),
places as (
  select page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), '{_UPPER}', '{_LOWER}') host,
    regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) path from parts),
ruled as (
  select *, {_rules(lambda r, v: r)} "rule", {_rules(lambda r, v: v)} given from places),
texts as (
  select distinct host || path t, given label,
    ('0x' || left(md5(host || path), 7))::bigint % 5 = 0 held from ruled),
grams as (
  select t, label, held,
    substr(repeat(chr(2), 4) || t || chr(3), unnest(generate_series(1, length(t) + 1)), 5) gram from texts),
counted as (
  select gram, count(*) filter (where label = 'allow') yes, count(*) filter (where label = 'block') no
  from grams where label is not null and not held group by gram),
seen as (
  select k, "right"(gram, k + 1) ending, sum(yes) yes, sum(no) no
  from (select *, unnest([0, 1, 2, 3, 4]) k from counted) x group by all),
contexts as (
  select k, "left"(ending, k) context, sum(yes) yes_n, sum(no) no_n,
    count(*) filter (where yes > 0) yes_t, count(*) filter (where no > 0) no_t
  from seen group by all),
asked as (
  select gram, unnest([0, 1, 2, 3, 4]) k
  from (select distinct gram from grams where label is null or held) x),
levels as (
  select a.gram, {_LEVELS}
  from asked a left join seen s on s.k = a.k and s.ending = "right"(a.gram, a.k + 1)
  left join contexts c on c.k = a.k and c.context = "left"("right"(a.gram, a.k + 1), a.k)
  group by a.gram),
ratios as (
  select gram, cast(round((ln({_chance('yes')}) - ln({_chance('no')})) * 1000000) as bigint) ratio from levels),
scored as (
  select t, label, held, cast(sum(r.ratio) as double) / count(*) score
  from grams g join ratios r on r.gram = g.gram where label is null or held group by t, label, held),
bins as (
  select cast(greatest(-500, least(500, floor(score / 10000))) as integer) bin,
    count(*) filter (where label = 'allow') yes, count(*) filter (where label = 'block') no
  from scored where held and label is not null group by 1),
tried as (
  select bin, (select coalesce(sum(yes), 0) from bins a where a.bin >= b.bin) * (select sum(no) from bins)
    + (select coalesce(sum(no), 0) from bins a where a.bin < b.bin) * (select sum(yes) from bins) good
  from bins b),
least_score as (
  select coalesce((select bin * 10000 from tried
    where (select sum(yes) from bins) > 0 and (select sum(no) from bins) > 0
    order by good desc, bin limit 1), 0) least)
select page_id, host, path, "rule",
  coalesce(given, case when s.score >= (select least from least_score) then 'allow' else 'block' end) verdict
from ruled r left join (select * from scored where label is null) s
  on r.given is null and s.t = r.host || r.path"""

ORACLES = {
    "op2_line_dedup": LINE_DEDUP,
    "op5_url_filter": URL_FILTER,
    "op12_conversation_trie": CONVERSATION_TRIE,
    "op13_vector_codes": VECTOR_CODES,
}
