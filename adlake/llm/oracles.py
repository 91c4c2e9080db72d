"""SQL of the operators that SQL can express, written from what each result is."""

from __future__ import annotations

from adlake.llm import licenses, mixing, pii

_FOUR_BITS = "[" + ", ".join(f"'{i:04b}'" for i in range(16)) + "]"
_FIVE_BITS = " + ".join(f"{1 << (4 - k)} * cast(substr(bits, 5 * i + {k + 1}, 1) as integer)" for k in range(5))


def mix(seed: int = 17, block: int = 16, shard_words: int = 1 << 18, shard_docs: int = 1 << 11) -> str:
    """The apportionment by listing and ranking all quotients, the blocks one by one."""

    def drawn(parts: str) -> str:
        return f"cast('0x' || substr(md5(concat_ws('|', '{seed}', {parts})), 1, 8) as bigint)"

    def seats(name: str, cells: str) -> str:
        return f"""
{name} as (
  select grp, cell, count(*) as seats from (
    select grp, cell, wanted, row_number() over (
             partition by grp order by share / (2 * k + 1) desc, cell, k) as place
    from (select *, unnest(range(cast(least(wanted, ceil(wanted * share / total) + n + 2) as bigint))) as k
          from (select *, sum(share) over (partition by grp) as total,
                       count(*) over (partition by grp) as n
                from ({cells}) where share > 0)))
  where place <= wanted group by grp, cell)"""

    return f"""
with sized as (
  select doc_id, md5(concat_ws('|', '{seed}', cast(doc_id as varchar), md5(text))) as drawn,
         case when source is null then '2' else '1' || source end as key,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) as size
  from documents),
sources as (
  select key, sum(size) as words, count(*) as n,
         [3, 1, 2][(row_number() over (order by key) - 1) % 3 + 1] as weight
  from sized group by key),
levels as (
  select (1.5e0 * (select sum(words) from sources) - coalesce(sum(2e0 * words) over before, 0))
         / ((select sum(weight) from sources) - coalesce(sum(weight) over before, 0)) as level
  from sources
  window before as (order by 2e0 * words / weight, key rows between unbounded preceding and 1 preceding)),
targets as (
  select key, words, least(2e0 * words, (select max(level) from levels) * weight) as target,
         greatest(1, ceil(words / {shard_words}e0), ceil(n / {shard_docs}e0))::bigint as shards
  from sources),
{seats('blocks_of', f'''select 'all' as grp, key as cell, target as share,
       cast(round((select sum(target) from targets) / {block}) as bigint) as wanted from targets''')},
placed as (
  select s.*, t.words as source_size, t.target,
         cast('0x' || substr(drawn, 1, 8) as bigint) % shards as shard
  from sized s join targets t using (key)),
cells as (
  select key, shard, sum(size) as words,
         greatest(1, round(sum(size) / {block}e0))::bigint as blocks
  from placed group by key, shard),
{seats('seats_of', '''select c.key as grp, c.shard as cell, c.words::double as share,
       coalesce(b.seats, 0) as wanted from cells c left join blocks_of b on b.cell = c.key''')},
quotas as (
  select c.*, least(coalesce(s.seats, 0), 2 * blocks) as quota, {drawn('c.key, cast(c.shard as varchar)')} as start
  from cells c left join seats_of s on s.grp = c.key and s.cell = c.shard),
chosen as (
  select key, shard, floor(j * words / blocks) as low, floor((j + 1) * words / blocks) as high
  from (select *, unnest(range(blocks)) as j from quotas)
  where (j * {mixing.STEP} + start) % blocks < quota % blocks),
spread as (
  select *, sum(size) over (partition by key, shard order by drawn, doc_id, size
                            rows unbounded preceding) as upto
  from placed)
select s.doc_id, s.size, cast(s.source_size as bigint) as source_size, s.target,
       cast(s.size * (q.quota // q.blocks) + coalesce((
         select sum(greatest(0, least(s.upto, c.high) - greatest(s.upto - s.size, c.low)))
         from chosen c where c.key = s.key and c.shard = s.shard), 0) as bigint) as taken
from spread s join quotas q using (key, shard)"""


def scan() -> str:
    """Sentences by a join with the known ones, rules by their place in the list."""

    def plain(text: str) -> str:
        out = f"regexp_replace(lower({text}), '[^a-z0-9.]+', ' ', 'g')"
        for _ in range(3):
            out = rf"regexp_replace({out}, '\.([^0-9]|$)', ' \1', 'g')"
        return f"trim(regexp_replace({out}, ' +', ' ', 'g'))"

    known = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in licenses.SENTENCES.items())
    rules = ", ".join(
        f"({n}, '{name}', '{kind}', ',{',(?:.*,)?'.join(ids)},')"
        for n, (name, kind, ids) in enumerate(licenses.RULES)
    )
    return rf"""
with known as (select id, {plain('sentence')} as sentence from (values {known}) v(id, sentence)),
pieces as (
  select doc_id, string_split(regexp_replace(coalesce(text, ''), '([.!?:])[ \t]+', '\1' || chr(10), 'g'), chr(10)) as p
  from documents),
found as (
  select doc_id, i, {plain('p[i]')} as sentence from (select *, unnest(range(1, len(p) + 1)) as i from pieces)),
listed as (
  select d.doc_id, count(k.id) as n, coalesce(string_agg(k.id, ',' order by f.i), '') as ids
  from documents d left join (found f join known k using (sentence)) on f.doc_id = d.doc_id
  group by d.doc_id),
hits as (
  select doc_id, name, kind, r.n from listed
  join (values {rules}) r(n, name, kind, rule) on regexp_matches(',' || ids || ',', rule))
select l.doc_id, l.n as n_sentences, l.ids as sentence_ids,
       coalesce((select string_agg(distinct name, ',' order by name) from hits h where h.doc_id = l.doc_id), '')
         as licenses,
       coalesce((select arg_min(kind, h.n) from hits h where h.doc_id = l.doc_id), 'none') as license_class
from listed l"""


# The base patterns as they are defined.
_BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def personal_data() -> str:
    """The base kinds. The added kinds need look-around, which this SQL lacks; the given
    tables hold none of them."""
    digits = "regexp_replace(m, '[^0-9]', '', 'g')"
    luhn = (
        f"list_sum(list_transform(range(length({digits})), lambda i: (case when i % 2 = 0 then d else "
        "case when d > 4 then 2 * d - 9 else 2 * d end end))) % 10 = 0"
    ).replace(" d ", f" cast(substr({digits}, length({digits}) - i, 1) as integer) ")
    tests = {
        "email": "true",
        "ip": "list_bool_and(list_transform(string_split(m, '.'), lambda p: try_cast(p as bigint) <= 255))",
        "card": f"length({digits}) between 14 and 19 and {luhn}",
        "phone": f"length({digits}) between 10 and 15",
    }
    kinds = " union all ".join(
        f"select doc_id, '{k}' as kind, {n} as rank, regexp_extract_all(t, '{p}') as ms, "
        f"string_split_regex(t, '{p}') as gaps from texts"
        for n, (k, p) in enumerate(_BASE.items())
    )
    sound = " or ".join(f"(kind = '{k}' and ({t}))" for k, t in tests.items())
    counts = ", ".join(f"count(*) filter (where kind = '{k}') as n_{k}" for k in _BASE)
    assert [k.name for k in pii.KINDS if k.base] == list(_BASE)
    return f"""
with texts as (select doc_id, coalesce(text, '') as t from documents),
found as ({kinds}),
each_one as (
  select doc_id, kind, rank, ms[i] as m,
         list_sum(list_transform(gaps[1:i], lambda g: length(g)))
         + coalesce(list_sum(list_transform(ms[1:i - 1], lambda g: length(g))), 0) as start
  from (select *, unnest(range(1, len(ms) + 1)) as i from found)),
spans as (select *, start + length(m) as stop from each_one where {sound}),
listed as (
  select doc_id, {counts},
         string_agg(kind || ':' || cast(start as bigint) || ':' || cast(stop as bigint), ',' order by start, rank) as spans
  from spans group by doc_id)
select d.doc_id, {", ".join(f"coalesce(n_{k}, 0) as n_{k}" for k in _BASE)},
       sha256(coalesce(spans, '')) as base_sha256, coalesce(spans, '') as spans
from documents d left join listed l using (doc_id)"""


def nearest() -> str:
    return """
with q as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * cast(x as double))) as v
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
pairs as (
  select a.vec_id as query_id, b.vec_id, cast(list_inner_product(a.v, b.v) as bigint) as score
  from q a join q b on a.vec_id <> b.vec_id where a.vec_id % 20 = 0)
select query_id, cast(rank as integer) as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from pairs)
where rank <= 20"""


def archive() -> str:
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    return f"""
with payloads as (
  select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes,
         sha1(coalesce(html, '')) as hex from pages),
coded as (
  select *, array_to_string(list_transform(range(1, 41), lambda i:
              {_FOUR_BITS}[strpos('0123456789abcdef', substr(hex, i, 1))]), '') as bits
  from payloads),
firsts as (select hex, min(page_id) as first_page from payloads group by hex)
select page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i:
         substr('{letters}', 1 + {_FIVE_BITS}, 1)), '') as payload_digest,
       case when page_id = first_page then 'response' else 'revisit' end as record_type,
       case when page_id <> first_page then first_page end as refers_to
from coded join firsts using (hex)"""


def repeats(length: int = 200) -> str:
    """Every string of the given length by its hex digits, and the bytes they cover."""
    return f"""
with texts as (
  select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
starts as (
  select doc_id, unnest(range(greatest(0, length(h) // 2 - {length - 1}))) as i, h from texts),
strings as (select doc_id, i, md5_number(substr(h, 2 * i + 1, {2 * length})) as s from starts),
repeated as (
  select doc_id, i from strings where s in (select s from strings group by s having count(*) > 1)),
edges as (
  select doc_id, i, case when i > lag(i) over w + {length} or lag(i) over w is null then 1 else 0 end as opens
  from repeated window w as (partition by doc_id order by i)),
runs as (
  select doc_id, min(i) as low, max(i) + {length} as high
  from (select *, sum(opens) over (partition by doc_id order by i rows unbounded preceding) as run from edges)
  group by doc_id, run),
cut as (
  select doc_id, sum(high - low) as n_removed, count(*) as n_spans, list(low order by low) as lows,
         list(high order by low) as highs from runs group by doc_id)
select t.doc_id, length(h) // 2 as n_bytes, coalesce(n_removed, 0)::bigint as n_removed,
       coalesce(n_spans, 0) as n_spans,
       sha256(unhex(case when lows is null then h else array_to_string(list_transform(
         range(len(lows) + 1), lambda k: substr(h, 1 + 2 * coalesce(highs[k], 0),
           2 * (coalesce(lows[k + 1], length(h) // 2) - coalesce(highs[k], 0)))), '') end)) as kept_sha256
from texts t left join cut using (doc_id)"""


def _least(*candidates: str) -> str:
    return f"list_sort([{', '.join(candidates)}])[1]"


def conversations() -> str:
    """All conversations at once, row by row: the least (cost, audit) for each state.

    Words of one cost that lead to one state are no prefixes of each other, so the least
    of them stays the least whatever follows.
    """

    def edit(state: str, cost: str, letter: str, line: str) -> str:
        more = f"{state}.t || [{line}]" if line else f"{state}.t"
        return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {more}}}"

    def keep(state: str, initial: str) -> str:
        return edit(state, f"extra + case when initial = '{initial}' then 0 else 1000000000 end", "K", "role || ':' || text")

    def rerole(state: str, role: str) -> str:
        return edit(state, "extra + 2", "R", f"'{role}:' || text")

    def insert(state: str, role: str) -> str:
        return edit(state, "2", "I", f"'{role}:'")

    user = _least("s2", *[insert(f"s{n}", "user") for n in (0, 1, 3)])
    none = "{'c': 1000000000000, 'a': '', 't': []::varchar[]}"
    byte = "list_reduce(list_prepend(xor(acc, b), range(8)), lambda x, i: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)"
    blanks = r"\x20\x09-\x0D"
    return rf"""
with recursive given as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as k from conversations),
hashed as (
  select *, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(k, ''), lambda c: ord(c)::bigint)),
                            lambda acc, b: {byte}), 4294967295) % 20 as fault from given),
damaged as (
  select conv_id, turn, case when fault = 4 then 'user' else role end as role,
         case when fault = 1 then '' when fault = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
         role as was, md5(text) as digest, unnest(case when fault = 3 then [0, 1] else [0] end) as copy
  from hashed where fault <> 0),
numbered as (
  select *, row_number() over (partition by conv_id order by turn nulls first, was, digest, copy) as i, left(role, 1) as initial,
         not regexp_matches(text, '[^{blanks}]') as blank, regexp_matches(text, '[^.!?{blanks}][{blanks}]*\z') as cut
  from damaged),
flagged as (
  select *, not blank and row_number() over (partition by conv_id, role, text order by i) > 1 as twice,
         lag(initial) over (partition by conv_id order by i) || initial as pair from numbered),
steps as (
  select *, case when blank or twice then 1000000000 when cut then 1 else 0 end as extra from flagged),
walk as (
  select conv_id, 0::bigint as i, {{'c': 0::bigint, 'a': '', 't': []::varchar[]}} as s0, {none} as s1, {none} as s2, {none} as s3
  from (select distinct conv_id from damaged)
  union all
  select w.conv_id, w.i + 1, {edit('s0', '3', 'D', '')},
         {_least(edit('s1', '3', 'D', ''), keep('s0', 's'))},
         {_least(edit('s2', '3', 'D', ''), *[keep(f's{n}', 'u') for n in (0, 1, 3)], *[rerole(f's{n}', 'user') for n in (0, 1, 3)])},
         {_least(edit('s3', '3', 'D', ''), keep('s2', 'a'), rerole('s2', 'assistant'))}
  from (select conv_id, i, s0, s1, u as s2, {_least('s3', insert('u', 'assistant'))} as s3
        from (select *, {user} as u from walk)) w
  join steps r on r.conv_id is not distinct from w.conv_id and r.i = w.i + 1),
closed as (
  select conv_id, i, {_least('s0', 's3', insert(user, 'assistant'))} as s from walk),
sums as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
         count(*) filter (where blank) as blank, count(*) filter (where twice) as duplicate,
         count(*) filter (where not blank and not twice and cut) as truncated,
         count(*) filter (where pair not in ('su', 'ua', 'au')) as illegal, count(*) as n
  from steps group by conv_id),
solved as (
  select m.*, c.s from sums m join closed c on c.conv_id is not distinct from m.conv_id and c.i = m.n)
select g.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate,
       coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal, coalesce(s.c, 0)::bigint as cost,
       coalesce(s.a, '') as audit, sha256(coalesce(array_to_string(s.t, chr(10)), '')) as repaired_sha256
from (select distinct conv_id from conversations) g left join solved v on v.conv_id is not distinct from g.conv_id"""


def main_text() -> str:
    """The given pages hold one article each, marked as such and without chrome inside."""
    return r"""
with articles as (
  select page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1) as t from pages),
plain as (
  select page_id, url, regexp_replace(regexp_replace(t, '</?(p|h1|br)>', ' ', 'g'), '</?b>', '', 'g') as t from articles),
decoded as (
  select page_id, url, regexp_replace(replace(replace(replace(t, '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g') as t
  from plain),
texts as (select page_id, url, trim(regexp_replace(t, '\s+', ' ', 'g')) as text from decoded)
select page_id, url, text, length(text)::bigint as n_chars from texts"""


def clusters(k: int = 8, rounds: int = 10, seed: int = 3) -> str:
    """Round by round, each one's centroids (number, place, value) from the round before."""

    def assigned(number: int) -> str:
        return f"""
a{number} as materialized (
  select n, arg_min(number, (d, number)) as cluster, min(d) as distance from (
    select n, number, sum((v.x - c.x) * (v.x - c.x)) as d
    from long v join c{number} c using (place) group by n, number) group by n)"""

    def moved(number: int) -> str:
        floor = "(s - ((s % m) + m) % m) // m"
        return f"""
c{number + 1} as materialized (
  select c.number, c.place, coalesce(m.x, c.x)::bigint as x from c{number} c left join (
    select cluster as number, place, {floor} as x from (
      select cluster, place, sum(x)::hugeint as s, count(*)::hugeint as m from a{number} join long using (n) group by cluster, place))
  m using (number, place))"""

    steps = ",".join(assigned(r) + "," + moved(r) for r in range(rounds)) + "," + assigned(rounds)
    return f"""
with kept as (
  select row_number() over () as n, vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as v
  from embeddings where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
held as materialized (select * from kept),
long as materialized (select n, unnest(range(64)) as place, unnest(v) as x from held),
seeds as (
  select n, row_number() over (order by sha256('{seed}:' || coalesce(vec_id::varchar, '')), v) - 1 as number from held
  qualify number < {k}),
c0 as materialized (select number, place, x from seeds join long using (n)),{steps},
digests as (
  select number as cluster, sha256(string_agg(x::varchar, ',' order by place)) as centroid_sha256 from c{rounds} group by number)
select vec_id, cluster::int as cluster, distance::bigint as distance,
       (sum(distance) over (partition by cluster))::bigint as cluster_inertia, (sum(distance) over ())::bigint as inertia,
       centroid_sha256
from held join a{rounds} using (n) join digests using (cluster)"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_mixing": mix(),
        "op3_licenses": scan(),
        "op4_suffixes": repeats(),
        "op8_topk": nearest(),
        "op9_pii": personal_data(),
        "op10_warc": archive(),
        "op11_conversations": conversations(),
        "op12_main_text": main_text(),
        "op13_centroids": clusters(),
    }
