"""SQL that gives the rows of those training-data queries that SQL can express."""

from __future__ import annotations

from offerweave.llm import linededup

_BITS = "list_aggregate([to_base(instr('0123456789abcdef', substr(sha1(body), i::int, 1)) - 1, 2, 4) for i in range(1, 41)], 'string_agg', '')"
_BIT = "substr(bits, (5 * i + {k})::int, 1)::int"
_FIVE = " + ".join(f"{16 >> k} * " + _BIT.format(k=k + 1) for k in range(5))

OP6 = rf"""with p as (
  select page_id, coalesce(html, '') as body, split_part(regexp_replace(lower(trim(coalesce(url, ''))), '^[a-z][a-z0-9+.-]*://', ''), '#', 1) as rest from pages
), q as (
  select *, max(page_id) over (partition by body) as original, {_BITS} as bits, split_part(rest, '/', 1) as host0 from p
), r as (
  select *, string_split(regexp_replace(list_extract(string_split(host0, '@'), -1), '^www\d*\.|:(80|443)$', '', 'g'), '.') as labels from q
)
select page_id, strlen(body)::bigint as payload_bytes,
  list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + {_FIVE}, 1) for i in range(0, 32)], 'string_agg', '') as payload_digest,
  case when page_id = original then 'response' else 'revisit' end as record_type, case when page_id <> original then original end as refers_to,
  array_to_string(list_reverse(labels), ',') || ')' || substr(rest, length(host0) + 1) as url_key,
  strftime(timestamp '2024-01-01' + to_seconds(page_id % 1000000000), '%Y-%m-%dT%H:%M:%SZ') as captured
from r"""

OP9 = r"""with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as words from documents
), s as (
  select distinct doc_id, hash(g) as h from (
    select doc_id, unnest(case when len(words) >= 5 then [array_to_string(words[i:i + 4], ' ') for i in range(1, len(words) - 3)] when len(words) > 0 then [array_to_string(words, ' ')] else [] end) as g from w)
), n as (
  select doc_id, count(*) as n from s group by doc_id
), b as (
  select x.doc_id as a, y.doc_id as b, count(*) as shared from s x join s y on x.h = y.h and x.doc_id < y.doc_id group by all
), l as (
  select b.a, b.b from b join n x on x.doc_id = b.a join n y on y.doc_id = b.b where 100 * shared >= 75 * (x.n + y.n - shared)
), e as (
  select a, b from l union all select b, a from l
), reach as (
  select doc_id as a, doc_id as b from documents union select reach.a, e.b from reach join e on e.a = reach.b
), c as (
  select a, min(b) as component_id from reach group by a
)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, c.component_id, d.doc_id = c.component_id as kept from documents d join c on c.a = d.doc_id left join n on n.doc_id = d.doc_id"""


def _shingles(table: str, key: str) -> str:
    words = r"string_split(trim(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g')), ' ')"
    cut = "case when len(w) >= 5 then [array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)] else [array_to_string(w, ' ')] end"
    return f"select {key}, {cut} as g from (select {key}, {words} as w from {table} where text is not null) where array_to_string(w, '') <> ''"


OP4 = f"""with d0 as ({_shingles("documents", "doc_id")}), i0 as ({_shingles("benchmark", "item_id")}),
d as (select doc_id, len(g) as size, unnest(g) as g, generate_subscripts(g, 1) - 1 as pos from d0),
i as (select item_id, m, g, count(*) as times from (select item_id, len(g) as m, unnest(g) as g from i0) group by all),
hit as (select doc_id, size, pos, item_id, m, times, g from d join i using (g)),
begins as (select distinct doc_id, size, item_id, m, unnest(range(greatest(0, pos - m + 1), least(pos, greatest(0, size - m)) + 1)) as start from hit),
inside as (select begins.doc_id, begins.item_id, begins.start, begins.m, least(begins.size, begins.m) as n, least(count(*), any_value(times)) as low from begins join hit on hit.doc_id = begins.doc_id and hit.item_id = begins.item_id and hit.pos between start and start + begins.m - 1 group by begins.doc_id, begins.item_id, begins.start, begins.m, begins.size, g),
rated as (select doc_id, item_id, start, n, sum(low)::double / (n + m - sum(low)) as similarity from inside group by doc_id, item_id, start, n, m)
select doc_id, item_id, max(similarity) as similarity, arg_max(start, (similarity, -start))::bigint as start_shingle, arg_max(n, (similarity, -start))::bigint as n_shingles
from rated where similarity >= 0.75 group by doc_id, item_id"""

ORACLES: dict[str, str] = {
    "op4_benchmark_decontamination": OP4, "op6_warc": OP6, "op7_line_dedup": linededup.ORACLE, "op7_line_dedup_all_lines": linededup.ORACLE_ALL, "op9_minhash_near_dedup": OP9,
}
