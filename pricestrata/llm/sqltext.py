"""Comparison SQL of the operators, written from their definitions for DuckDB."""

from __future__ import annotations

import re

from pricestrata.llm import licences as licence_rules
from pricestrata.llm import rollup, sharding


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _licence_keys() -> dict[str, str]:
    """Known sentences as text of words between marks: 2 for a piece's end, a space inside it."""
    found: dict[str, str] = {}
    for name, sentence in licence_rules.SENTENCES:
        cut = re.split(r"[.!?:;]+(?:\s+|$)", sentence.lower())
        words = (" ".join(re.findall("[a-z0-9]+", p)) for p in cut)
        found.setdefault("\2".join(w for w in words if w), name)
    return found


def licences() -> str:
    """One alternation over the marked text, longest sentence first; each rule takes its identifiers in turn.

    Mark 1 is a stop or a blank line, mark 2 a line end. Both stand twice, so that a sentence takes the mark before it
    and the next one still finds its own.
    """
    known = _licence_keys()
    longest = sorted(known, key=lambda k: -len(k))
    gap, end = r"( |\x02\x02)", r"(\x01\x01|\x02\x02)"
    each = "|".join(k.replace(" ", gap).replace("\2", end) for k in longest)
    pattern = rf"[\x01\x02]({each})[\x01\x02]".replace("(", "(?:")
    plain = ", ".join(_quoted(k.replace("\2", " ")) for k in known)
    names = ", ".join(_quoted(v) for v in known.values())
    cut = r"[.!?:;]+([ \t\r\f\x0B]+|\n|$)|\n[ \t\r]*\n"
    marked = (
        f"regexp_replace(regexp_replace(lower(coalesce(text, '')), '{cut}', chr(1), 'g'), '[ \\t\\r]*\\n[ \\t\\r]*', chr(2), 'g')"
    )
    flat = f"regexp_replace({marked}, '[^a-z0-9\\x01\\x02]+', ' ', 'g')"
    flat = f"regexp_replace({flat}, '[ \\x01\\x02]*\\x01[ \\x01\\x02]*', chr(1) || chr(1), 'g')"
    flat = f"regexp_replace({flat}, '[ \\x02]*\\x02[ \\x02]*', chr(2) || chr(2), 'g')"
    found = f"regexp_extract_all(chr(1) || trim(t, ' ') || chr(1), '{pattern}')"
    ids = (
        f"list_transform({found}, lambda s: ([{names}])[list_position([{plain}], "
        r"trim(regexp_replace(s, '[ \x01\x02]+', ' ', 'g'), ' '))])"
    )

    steps, last = [], "start"
    for k, (_, sequence) in enumerate(licence_rules.RULES):
        wanted = "".join(f"|{x}|" for x in sequence)
        steps.append(
            f"r{k} as (select * exclude (rest), replace(rest, '{wanted}', '/') as rest, "
            f"(length(rest) - length(replace(rest, '{wanted}', '/'))) // {len(wanted) - 1} as m{k} "
            f"from {last})"
        )
        last = f"r{k}"
    total = " + ".join(f"m{k}" for k in range(len(licence_rules.RULES)))
    found = ", ".join(
        f"case when m{k} > 0 then '{name}' end" for k, (name, _) in enumerate(licence_rules.RULES)
    )
    return f"""
with flat as (select doc_id, {flat} as t from documents),
chosen as (select doc_id, {ids} as ids from flat),
start as (select doc_id, len(ids) as n_sentences, coalesce(array_to_string(ids, ','), '') as sentence_ids,
  coalesce(array_to_string(list_transform(ids, lambda x: '|' || x || '|'), ''), '') as rest from chosen),
{", ".join(steps)}
select doc_id, n_sentences, cast({total} as bigint) as n_matches, sentence_ids,
  coalesce(array_to_string(list_sort(list_distinct(list_filter([{found}], lambda x: x is not null))), ','), '')
    as licences
from {last}"""


def shards() -> str:
    """Row numbers by a window, checksums bit by bit, the network unrolled round by round."""
    rounds = []
    for k, (a, b) in enumerate(sharding.round_keys(sharding.SEED)):
        t = f"((r * {a} + {b}) % {sharding._MOD})"
        rounds.append(
            f"s{k} as (select * replace (r as l, (l + (({t} * {t}) % {sharding._MOD}) % side) % side as r) "
            f"from {'split' if not k else f's{k - 1}'})"
        )

    def walk(source: str, name: str) -> str:
        body = ", ".join(rounds).replace("from split", f"from {name}_split")
        for k in range(len(rounds)):
            body = body.replace(f"s{k} as", f"{name}_s{k} as").replace(
                f"from s{k})", f"from {name}_s{k})"
            )
        return (
            f"{name}_split as (select *, p // side as l, p % side as r from {source}), {body}, "
            f"{name} as (select * exclude (l, r) replace "
            f"(case when done then p else l * side + r end as p, "
            f"done or (l * side + r < n) as done) from {name}_s{len(rounds) - 1})"
        )

    walks, last = [], "begun"
    for k in range(12):
        walks.append(walk(last, f"w{k}"))
        last = f"w{k}"
    return f"""
with recursive tab(i, step, v) as (
  select i, 0, cast(i as ubigint) from range(256) t(i)
  union all
  select i, step + 1, case when v & 1 = 1 then xor(v >> 1, 3988292384::ubigint) else v >> 1 end
  from tab where step < 8),
crc_table as (select list(v order by i) as t from tab where step = 8),
sized as (
  select doc_id, coalesce(strlen(text), 0) + 1 as size,
    hex(encode(coalesce(text, ''))) as h
  from documents),
summed as (
  select doc_id, cast(size as bigint) as size,
    cast(xor(list_reduce(list_concat([4294967295::ubigint],
      list_transform(range(length(h) // 2), lambda i:
        cast((instr('0123456789ABCDEF', h[2 * i + 1]) - 1) * 16 + instr('0123456789ABCDEF', h[2 * i + 2]) - 1
        as ubigint))),
      lambda c, b: xor(c >> 8, t[cast(xor(c, b) & 255 as int) + 1])), 4294967295::ubigint) as bigint)
      as text_crc32
  from sized, crc_table),
numbered as (
  select *, row_number() over (order by doc_id nulls first, size, text_crc32) - 1 as p,
    count(*) over () as n from summed),
begun as (
  select *, greatest(2, cast(floor(sqrt(n - 1)) as bigint) + 1) as side, false as done from numbered),
{", ".join(walks)}
select doc_id, size, text_crc32, 'rows' as law, cast(p % {sharding.SHARDS} as int) as shard,
  cast(p // {sharding.SHARDS} as bigint) as slot, cast(null as int) as grown_shard
from {last}"""


def token_counts() -> str:
    pattern = rollup.VERSIONS["words/2"]
    return f"""
with firsts as (
  select *, row_number() over (partition by text order by doc_id nulls first, source nulls first,
    lang nulls first) as k from documents)
select source, lang, 'words/2' as tokenizer_version, count(*) as n_docs,
  cast(sum(coalesce(len(regexp_extract_all(text, '{pattern}')), 0)) as bigint) as n_tokens
from firsts where k = 1 group by source, lang"""


def decontamination(window: int = 10) -> str:
    """Windows by list slices, joined with the runs of each document of the same length."""
    words = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
    return f"""
with item_words as (
  select coalesce(cast(item_id as varchar), '') as item, {words} as w from benchmark),
item_windows as (
  select distinct item, least(len(w), {window}) as n,
    array_to_string(list_slice(w, i, i + least(len(w), {window}) - 1), ' ') as k
  from (select item, w, unnest(range(1, greatest(len(w) - {window} + 2, 2))) as i
    from item_words where len(w) > 0)),
doc_words as (select row_number() over () as rid, doc_id, {words} as w from documents),
runs as (
  select rid, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') as k
  from (select rid, w, n, unnest(range(1, len(w) - n + 2)) as i
    from doc_words, (select distinct n from item_windows) where len(w) >= n)),
found as (select rid, i, n, item from runs join item_windows using (n, k)),
hit as (
  select rid, count(distinct p) as n_hit
  from (select rid, unnest(range(i, i + n)) as p from (select distinct rid, i, n from found))
  group by rid),
named as (
  select rid, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct rid, item from found) group by rid)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from doc_words left join hit using (rid) left join named using (rid)"""


def conversation_trie() -> str:
    """Nodes are the distinct lists of first turns; a subtree is found along the rebuilt conversation
    that gives a node its conv_id."""
    return r"""
with recursive tab(i, step, v) as (
  select i, 0, cast(i as ubigint) from range(256) t(i)
  union all
  select i, step + 1, case when v & 1 = 1 then xor(v >> 1, 3988292384::ubigint) else v >> 1 end
  from tab where step < 8),
crc_table as (select list(v order by i) as t from tab where step = 8),
own as (
  select conv_id as c, coalesce(role, '') as r, coalesce(text, '') as x,
    row_number() over (partition by conv_id order by turn nulls first, role, text) as k
  from conversations where conv_id is not null),
convs as (
  select c, c - c % 20 as base, cast(list_reduce(list_concat([4294967295::ubigint],
      list_transform(range(length(c::varchar)), lambda i: cast(ascii(substr(c::varchar, i + 1, 1)) as ubigint))),
      lambda a, b: xor(a >> 8, t[cast(xor(a, b) & 255 as int) + 1])) as bigint) as inverted
  from (select distinct c from own), crc_table),
plan as (select c, base, 3 - inverted % 4 as h from convs),
turns as (
  select p.c, o.k as d, o.r, o.x from plan p join own o on o.c = p.base and o.k <= p.h
  union all
  select p.c, o.k - p.h + coalesce((select count(*) from own b where b.c = p.base and b.k <= p.h), 0), o.r, o.x
  from plan p join own o on o.c = p.c and o.k > p.h),
steps as (
  select c, d, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) as w,
    string_agg(md5(r) || md5(x), '') over (partition by c order by d) as path from turns
  union all select c, 0, 0, '' from plan),
sizes as (select c, max(d) as size from steps group by c),
nodes as (
  select path, d as depth, min(c) as conv_id, count(*) as n_convs, max(w) as w,
    (count(*) - 1) * max(w) as own_saved,
    sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (where size = d), '')) as ends_sha256
  from steps join sizes using (c) group by path, d),
kids as (
  select left(path, (depth - 1)::int * 64) as path, count(*) as n_children from nodes where depth > 0 group by 1),
full_nodes as (select n.*, coalesce(n_children, 0) as n_children from nodes n left join kids using (path)),
sums as (
  select s.path, sum(n.own_saved) as saved_tokens, count(*) filter (where n.n_children = 0) as n_leaves
  from full_nodes n join steps s on s.c = n.conv_id and s.d <= n.depth group by s.path)
select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, n.n_children, n_leaves,
  cast(saved_tokens as bigint) as saved_tokens, n.ends_sha256
from full_nodes n join sums using (path)
left join nodes p on n.depth > 0 and p.path = left(n.path, (n.depth - 1)::int * 64)"""
