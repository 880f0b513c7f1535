"""SQL of the vector codes: every part against every entry, two rounds and a last assignment."""

_FINITE = "embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0"


def _assigned(books: str) -> str:
    distance = "list_sum(list_transform(list_zip(x.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    return f"""(
  select row_id, p, v, min_by(e, (d, e)) e, min(d) d
  from (select x.row_id, x.p, x.v, b.e, cast({distance} as bigint) d from parts x join {books} b on b.p = x.p) y
  group by row_id, p, v)"""


def _means(assigned: str, books: str) -> str:
    return f"""(
  select b.p, b.e, coalesce(m.v, b.v) v
  from {books} b left join (
    select p, e, list((s - (s % n + n) % n) // n order by i) v
    from (
      select p, e, i, cast(sum(c) as bigint) s, count(*) n
      from (select p, e, unnest(v) c, generate_subscripts(v, 1) i from {assigned}) u
      group by p, e, i) t
    group by p, e) m on m.p = b.p and m.e = b.e)"""


VECTOR_CODES = f"""
with kept as (
  select row_number() over () row_id, vec_id, label,
    list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) v
  from embeddings where {_FINITE}),
parts as materialized (
  select row_id, vec_id, cast(p as integer) p, v[cast(p * len(v) // 16 + 1 as bigint) : cast((p + 1) * len(v) // 16 as bigint)] v
  from kept, range(16) r(p)),
books_0 as materialized (
  select p, v, dense_rank() over (order by vec_id) - 1 e from parts
  where vec_id in (select distinct vec_id from kept order by vec_id limit 64)),
codes_0 as materialized {_assigned("books_0")},
books_1 as materialized {_means("codes_0", "books_0")},
codes_1 as materialized {_assigned("books_1")},
books_2 as materialized {_means("codes_1", "books_1")},
codes_2 as {_assigned("books_2")},
coded as (
  select k.row_id, any_value(k.vec_id) vec_id, any_value(k.label) label,
    string_agg(lower(lpad(to_hex(c.e), 2, '0')), '' order by c.p) code, cast(sum(c.d) as bigint) error
  from codes_2 c join kept k on k.row_id = c.row_id group by k.row_id)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) label_error,
  (select sha256(string_agg(array_to_string(v, ','), ',' order by p, e)) from books_2) codebooks_sha256
from coded"""
