"""Byte-level BPE encoding and decoding by recursive queries in each partition.

A text is split by the tokenizer's pattern.  The distinct pieces that a task has
not met before become rows (piece, place, token), at first one per byte.  A
recursive query joins neighbouring tokens with the merge table, finds each piece's
merge of minimum rank, leftmost first, and contracts it, until no piece has a merge
left.  Decoding joins ids with the vocabulary and strings the bytes together in an
ordered aggregation.  DuckDB runs inside the Python worker, on one thread and with
a memory limit, over the rows of that task alone.

A piece costs its length squared, so pieces over ``_LONG`` bytes (a long run of
letters without a gap) are contracted in the same order by a heap instead.
"""

from __future__ import annotations

import base64
import functools
import heapq
import re
from collections.abc import Iterable
from dataclasses import dataclass

import duckdb
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from titleprep.llm.common import add_columns

_LONG = 512
_PIECES = 60_000  # pieces in one query
_CONTRACTED = 2_500_000  # rows that the recursion of one query makes: half the square of a piece's bytes
_IDS = 300_000  # ids in one query
_REMEMBERED = 900_000
_REMEMBERED_BYTES = 200 << 20
_ROWS = 2_000  # texts at a time
_PLACE = (1 << 20) - 1

# rows are (k, t): piece and place in one number, and the token there; d marks pieces that are done
_CONTRACT = f"""
with recursive s(k, t, d) as (
    select k, t, false from start
    union all
    select x.k, (case when x.k & {_PLACE} = (b & {_PLACE}) then b >> 20 else x.t end)::bigint, b is null
    from (
        select k, t, case when lag(k) over o >> 20 = k >> 20 then lag(k) over o end as before
        from s where not d window o as (order by k)
    ) x
    left join (
        select y.k >> 20 as piece, min((m.token << 20) | (y.k & {_PLACE})) as b
        from (
            select k, t, case when lead(k) over o >> 20 = k >> 20 then lead(t) over o end as after
            from s where not d window o as (order by k)
        ) y
        join merges m on m.pair = ((y.t << 20) | y.after)
        group by 1
    ) z on z.piece = x.k >> 20
    where b is null or before is null or before & {_PLACE} <> (b & {_PLACE})
)
select (k >> 20)::integer as piece, t::integer as id from s where d order by k
"""

_DECODE = """
select d, unhex(string_agg(v.code, '' order by p)) as bytes
from ids join vocabulary v using (id) group by d
"""


def _batches(rows: list[tuple[str, bytes]]) -> Iterable[list[tuple[str, bytes]]]:
    """Pieces for one query each, bounded by their number and by the rows that their recursion makes."""
    part, made = [], 0
    for row in rows:
        cost = len(row[1]) ** 2 // 2
        if part and (len(part) == _PIECES or made + cost > _CONTRACTED):
            yield part
            part, made = [], 0
        part.append(row)
        made += cost
    if part:
        yield part


class _Coder:
    """Tables and known pieces of one Python worker."""

    def __init__(self, ranks_path: str, pattern: str):
        import regex

        lines = open(ranks_path, "rb").read().splitlines()
        self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line)}
        ranks = self.ranks
        pairs, made = [], []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    pairs.append(left << 20 | right)
                    made.append(rank)
        self.single = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
        # an empty folder setting keeps the engine from writing to a local disk
        self.db = duckdb.connect(
            ":memory:", config={"threads": 1, "memory_limit": "200MB", "temp_directory": ""}
        )
        self._load("merges", {"pair": np.array(pairs, np.int64), "token": np.array(made, np.int64)})
        codes = pa.table({"id": pa.array(ranks.values(), pa.int32()), "code": [t.hex() for t in ranks]})
        self._load("vocabulary", codes)
        self.known: dict[str, bytes] = {}
        self.held = 0
        # white space as the other library understands it
        space = pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
        self.split = regex.compile(space).findall
        self.split_latin = _latin(pattern)

    def _load(self, name: str, columns) -> None:
        table = columns if isinstance(columns, pa.Table) else pa.table(columns)
        self.db.register("_new", table)
        self.db.execute(f"create or replace table {name} as select * from _new")
        self.db.unregister("_new")

    def _query(self, sql: str, name: str, columns) -> pa.Table:
        self.db.register(name, pa.table(columns))
        found = self.db.sql(sql).to_arrow_table()
        self.db.unregister(name)
        return found

    def _learn(self, pieces: list[str]) -> None:
        rows = []
        for piece in pieces:
            data = piece.encode()
            rank = self.ranks.get(data)
            if rank is not None:
                self.known[piece] = rank.to_bytes(4, "little")
            elif len(data) > _LONG:
                self.known[piece] = np.array(self._long(data), "<u4").tobytes()
            else:
                rows.append((piece, data))
        for part in _batches(rows):
            sizes = np.array([len(data) for _, data in part])
            octets = np.frombuffer(b"".join(data for _, data in part), np.uint8)
            first = np.repeat(np.cumsum(sizes) - sizes, sizes)
            number = np.repeat(np.arange(len(part), dtype=np.int64), sizes)
            start = {"k": number << 20 | (np.arange(len(octets)) - first), "t": self.single[octets]}
            found = self._query(_CONTRACT, "start", start)
            ids = found["id"].to_numpy().astype("<u4").tobytes()
            ends = np.searchsorted(found["piece"].to_numpy(), np.arange(1, len(part) + 1)) * 4
            begin = 0
            for (piece, _), end in zip(part, ends.tolist()):
                self.known[piece] = ids[begin:end]
                begin = end
        # what the dictionary, a piece and its ids take, roughly
        self.held += sum(200 + 2 * len(piece) + len(self.known[piece]) for piece in pieces)

    def _long(self, data: bytes) -> list[int]:
        """The same contraction for one long piece, with the candidate merges in a heap."""
        ranks, spans = self.ranks, {i: data[i : i + 1] for i in range(len(data))}
        after = list(range(1, len(data))) + [-1]
        before = list(range(-1, len(data) - 1))
        heap: list[tuple[int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j >= 0 and (rank := ranks.get(spans[i] + spans[j])) is not None:
                heapq.heappush(heap, (rank, i, len(spans[i]) + len(spans[j])))

        for i in range(len(data)):
            offer(i)
        while heap:
            _, i, size = heapq.heappop(heap)
            j = after[i] if i in spans else -1
            if j < 0 or len(spans[i]) + len(spans[j]) != size:
                continue
            spans[i] += spans.pop(j)
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [ranks[spans[i]] for i in sorted(spans)]

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        if len(self.known) > _REMEMBERED or self.held > _REMEMBERED_BYTES:
            self.known.clear()
            self.held = 0
        known, split = self.known, []
        for text in texts:
            try:
                text.encode("latin-1")
                split.append(self.split_latin(text))
            except UnicodeEncodeError:
                split.append(self.split(text))
        new = {piece for pieces in split for piece in pieces if piece not in known}
        self._learn(list(new))
        return [b"".join(map(known.__getitem__, pieces)) for pieces in split]

    def decode(self, ids: list[np.ndarray]) -> list[bytes]:
        """The bytes of each list of ids."""
        out = [b""] * len(ids)
        at = 0
        while at < len(ids):
            end, held = at, 0
            while end < len(ids) and (held == 0 or held + len(ids[end]) <= _IDS):
                held += len(ids[end])
                end += 1
            sizes = np.array([len(i) for i in ids[at:end]])
            if held:
                table = {
                    "d": np.repeat(np.arange(at, end, dtype=np.int32), sizes),
                    "p": np.arange(held, dtype=np.int32),
                    "id": np.concatenate(ids[at:end]).astype(np.int32),
                }
                found = self._query(_DECODE, "ids", table)
                for d, data in zip(found["d"].to_pylist(), found["bytes"].to_pylist()):
                    out[d] = data
            at = end
        return out


def _latin(pattern: str):
    """The pattern for texts of the first 256 code points, in which its classes are short lists."""
    letters = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
    numbers = "0-9\xb2\xb3\xb9\xbc-\xbe"
    space = r"\t-\r \x85\xa0"
    for name, members in ((r"\p{L}", letters), (r"\p{N}", numbers), (r"\s", space)):
        inside = re.sub(rf"(\[[^\]]*){re.escape(name)}", lambda m: m[1] + members, pattern)
        while inside != pattern:
            pattern = inside
            inside = re.sub(rf"(\[[^\]]*){re.escape(name)}", lambda m: m[1] + members, pattern)
        pattern = pattern.replace(name, f"[{members}]")
    return re.compile(pattern.replace(r"\S", f"[^{space}]")).findall


@functools.lru_cache(maxsize=2)
def coder(ranks_path: str, pattern: str) -> _Coder:
    return _Coder(ranks_path, pattern)


@dataclass(frozen=True)
class ByteBpe:
    """``ranks`` is the path of a rank file; the methods add columns to documents.

    Null and empty texts have no ids and decode to no bytes; so do null lists of
    ids.  Ids outside the vocabulary are left out when decoding.  Special tokens are
    ordinary text.  Every row is coded by itself, so repeated rows and ties need no
    rule; columns named like the new ones are replaced; an empty table gives an
    empty table.
    """

    ranks: str
    pattern: str
    text_col: str = "text"

    def encode(self, docs: DataFrame) -> DataFrame:
        """Adds ``ids``."""
        return self._add(docs, decode=False)

    def decode(self, coded: DataFrame) -> DataFrame:
        """Adds ``decoded``, the bytes of ``ids``."""

        def run(batch):
            lists = batch.column(batch.schema.get_field_index("ids"))
            ids = [np.array(i.as_py() or (), np.int32) for i in lists]
            found = coder(self.ranks, self.pattern).decode(ids)
            return {"decoded": pa.array(found, pa.binary())}

        return add_columns(coded, run, StructType([StructField("decoded", BinaryType())]))

    def round_trip(self, docs: DataFrame) -> DataFrame:
        """Adds ``ids`` and ``decoded`` in one pass over the texts."""
        return self._add(docs, decode=True)

    def _add(self, docs: DataFrame, decode: bool) -> DataFrame:
        def run(batch):
            texts = batch.column(batch.schema.get_field_index(self.text_col))
            own = coder(self.ranks, self.pattern)
            coded = own.encode(t.as_py() or "" for t in texts)
            ids = [np.frombuffer(c, "<u4").astype(np.int32) for c in coded]
            ends = np.cumsum([0, *map(len, ids)])
            flat = pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32), pa.int32())
            found = {"ids": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)}
            if decode:
                found["decoded"] = pa.array(own.decode(ids), pa.binary())
            return found

        new = [StructField("ids", ArrayType(IntegerType()))]
        if decode:
            new.append(StructField("decoded", BinaryType()))
        return add_columns(docs, run, StructType(new), _ROWS)
