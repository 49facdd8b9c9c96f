"""DuckDB SQL for the queries that SQL can express."""

_SPACES = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = f"""
with lines as (
  select doc_id, unnest(parts) as line, generate_subscripts(parts, 1) as i
  from (select doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents)
), keyed as (
  select *, {_LOWER.format(f"trim(line, {_SPACES})")} as key from lines
), held as (
  select key, min(doc_id) as first_id from keyed where length(key) >= 10
  group by key having count(distinct doc_id) >= 2
), marked as (
  select k.doc_id, k.line, k.i, coalesce(h.first_id < k.doc_id, false) as gone
  from keyed k left join held h on k.key = h.key
)
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), '')) as kept_sha256
from marked group by doc_id
"""

# crc32 of a text of ASCII characters: eight shifts per character.
_CRC32 = """xor(4294967295, list_reduce(
  list_concat([4294967295::ubigint], flatten(list_transform(range(1, length({0}) + 1),
    lambda i: [ascii(substr({0}, i, 1))::ubigint, 0, 0, 0, 0, 0, 0, 0]))),
  lambda a, b: xor(xor(a, b) >> 1, 3988292384::ubigint * (xor(a, b) & 1))))"""


def _tree(name: str, bottom: str) -> str:
    """Levels of the trees of ``bottom`` (key, idx, digest, total), until each key has one node."""
    return f"""{name}(key, level, idx, digest, total) as (
  select key, 0, idx, digest, total from {bottom}
  union all
  select key, level + 1, idx // 8, sha256(string_agg(digest, '' order by idx)), (total + 7) // 8
  from {name} where total > 1 group by key, level, idx // 8, total
)"""


def _sides(name: str, tree: str) -> str:
    """What stands left and right of each node in its run of eight."""
    run = "partition by key, level, idx // 8 order by idx rows between"
    return f"""{name} as (
  select key, level, idx,
    coalesce(string_agg(digest, '') over ({run} unbounded preceding and 1 preceding), '') as lefts,
    coalesce(string_agg(digest, '') over ({run} 1 following and unbounded following), '') as rights
  from {tree} where total > 1
)"""


_FIELDS = " || ".join(
    f"coalesce(strlen({c}::varchar)::varchar || ':' || {c}::varchar, '-')" for c in ("doc_id", "source", "lang", "n_chars")
)
_LEAF = f"sha256({_FIELDS} || coalesce(strlen({{0}})::varchar || ':' || {{0}}, '-'))"

OP13 = f"""
with recursive leaves as (
  select doc_id, key, leaf as digest, leaf, changed,
    row_number() over (partition by key order by doc_id nulls first, leaf) - 1 as idx,
    count(*) over (partition by key) as total
  from (
    select doc_id, coalesce('=' || lang, '') as key, {_LEAF.format("text")} as leaf,
      case when {_CRC32.format("doc_id::varchar")} % 3 = 0 then {_LEAF.format(_LOWER.format("text"))} end as changed
    from documents
  )
), {_tree("nodes", "leaves")}, subroots as (
  select key as lang_key, digest as subroot, digest, '' as key, row_number() over (order by encode(key)) - 1 as idx,
    count(*) over () as total
  from nodes where total = 1
), {_tree("last", "subroots")}, {_sides("inner_sides", "nodes")}, {_sides("last_sides", "last")},
sides as (
  select key, level, idx, lefts, rights from inner_sides
  union all
  select s.lang_key, heights.height + l.level, l.idx, l.lefts, l.rights
  from subroots s join (select key, max(level) as height from nodes group by key) heights on heights.key = s.lang_key
  join last_sides l on l.idx = s.idx // (8 ** l.level)::bigint
), steps as (
  select row_number() over () as row_no, * from leaves
), path(row_no, key, level, idx, digest, proof) as (
  select row_no, steps.key, 0, case when steps.total = 1 then subroots.idx else steps.idx end, coalesce(changed, leaf), ''
  from steps join subroots on subroots.lang_key = steps.key
  union all
  select p.row_no, p.key, p.level + 1,
    case when t.level is null then s.idx // 8 else t.place end,
    sha256(s.lefts || p.digest || s.rights), p.proof || s.lefts || s.rights
  from path p
  join sides s on s.key = p.key and s.level = p.level and s.idx = p.idx
  left join (
    select n.key, n.level, r.idx as place from nodes n join subroots r on r.lang_key = n.key where n.total = 1
  ) t on t.key = p.key and t.level = p.level + 1
)
select steps.doc_id, steps.leaf, subroots.subroot, top.digest as root, sha256(coalesce(ends.proof, '')) as proof_sha256,
  ends.digest as folded_root, ends.digest = top.digest as verified
from steps join subroots on subroots.lang_key = steps.key
join (select digest from last where total = 1) top on true
join (select row_no, arg_max(digest, level) as digest, arg_max(proof, level) as proof from path group by row_no) ends
  on ends.row_no = steps.row_no
"""

ORACLE: dict[str, str] = {"op1_line_dedup": OP1, "op13_merkle": OP13}
