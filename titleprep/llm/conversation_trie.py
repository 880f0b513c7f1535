"""The prefix trie of conversations: one row per distinct beginning of a conversation.

1. A turn is its digest, and digests are numbered in a dictionary table; texts are
   read once and never shuffled.  Turns are sorted over all tasks and come back as
   one binary sequence of codes per conversation, in chunks, so that no task sorts a
   long conversation alone.
2. Sequences are dealt out by range together with their conversation ids: a shard is
   a run of the sorted order, and copies of a conversation may spread over many
   shards.  Each shard is a ternary search tree, balanced by inserting medians first;
   one pass over its nodes gives members, leaves and savings (``prefix_tree``).
3. Only prefixes of a shard's first and last sequence can occur in other shards.
   Their counts add up over shards, once what two neighbours both count is taken off:
   the prefixes that the first sequence shares with the last one of the shard before,
   and the leaf of a last sequence that goes on in the next shard.
"""

from __future__ import annotations

import hashlib
import itertools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from titleprep.llm.prefix_tree import ELEMENT, PrefixTree, elements
from titleprep.scale import lookup, reread, store

_WIDTH = ELEMENT.itemsize
_CHUNK = 65_536
_NONE = hashlib.sha256(b"").hexdigest()
_COUNTS = ("n_convs", "n_children", "n_leaves", "saved_tokens")
_NODE = (
    "shard int, key binary, parent_key binary, depth long, conv_id long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, ends_sha256 string, before long, on_first boolean, "
    "on_last boolean, first binary, last binary, chunk long, ids string"
)


def _batches(rows, schema: pa.Schema, size: int = 20_000):
    while part := list(itertools.islice(rows, size)):
        columns = zip(*part)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _arrow(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(ddl), prefers_large_types=False)


def _rows(batches, *columns):
    for batch in batches:
        yield from zip(*(batch[c].to_pylist() for c in columns))


def _joined(batches):
    """(conv_id, part, sequence) for runs of turns of one conversation, in order."""
    part = TaskContext.get().partitionId() << 32
    for conv, run in itertools.groupby(_rows(batches, "conv_id", "code", "bytes"), key=lambda r: r[0]):
        while some := list(itertools.islice(run, _CHUNK)):
            yield conv, part, np.array([r[1:] for r in some], ELEMENT).tobytes()
            part += 1


class _Shard:
    """Nodes of one shard, from its sorted (sequence, conv_id) rows."""

    def __init__(self, rows):
        self.sequences, self.members, self.smallest, self.ends = [], [], [], []
        ids = []
        for sequence, run in itertools.groupby(rows, key=lambda r: r[0]):
            ids = [r[1] for r in run]
            self.sequences.append(sequence)
            self.members.append(len(ids))
            self.smallest.append(ids[0])
            # the ids of a shard's first sequence may go on from, those of its last into a neighbour
            text = ",".join(map(str, ids))
            self.ends.append(text if len(self.ends) == 0 else hashlib.sha256(text.encode()).hexdigest())
        self.last_ids = ",".join(map(str, ids))

    def nodes(self, shard: int):
        if not self.sequences:
            return
        tree = PrefixTree(self.sequences)
        totals = tree.totals(self.members, self.smallest)
        counts, least = [totals[c] for c in _COUNTS], totals["conv_id"]
        ends = dict(zip(tree.end, range(len(self.ends))))
        first, last = tree.path(tree.end[0]), tree.path(tree.end[-1])
        keys, before = {0: b""}, {0: 0}
        for path, sequence in ((first, self.sequences[0]), (last, self.sequences[-1])):
            for depth, node in enumerate(path[1:]):
                element = sequence[depth * _WIDTH : (depth + 1) * _WIDTH]
                above = path[depth]
                keys[node] = hashlib.blake2b(keys[above] + element, digest_size=16).digest()
                before[node] = before[above] + tree.bytes[above]
        on_first, on_last = set(first), set(last)
        for node in range(len(tree)):
            above = tree.parent[node]
            key, parent_key = keys.get(node), keys.get(above)
            edge = (self.sequences[0], self.sequences[-1]) if node == 0 else (None, None)
            end = self.ends[ends[node]] if key is None and node in ends else None
            yield (
                shard, key, parent_key, tree.depth[node], least[node],
                None if node == 0 or parent_key is not None else least[above],
                *(c[node] for c in counts), end, before.get(node), node in on_first, node in on_last, *edge, None, None,
            )
        chunk = 0
        for node, key in keys.items():
            if node in ends:
                at = ends[node]
                # sequences between the first and the last are whole here: their ids need no text
                text = self.ends[0] if at == 0 else self.last_ids if at == len(self.ends) - 1 else None
                if text is None:
                    yield (shard, key, *[None] * 8, self.ends[at], *[None] * 5, chunk, None)
                else:
                    for start in range(0, len(text), 1 << 20):
                        yield (shard, key, *[None] * 14, chunk, text[start : start + (1 << 20)])
                        chunk += 1
                chunk += 1


def _neighbours(batches, schema):
    """What a shard's first sequence shares with the shard before, and whether its last goes on in the next."""

    def shared(a: bytes, b: bytes) -> int:
        n = min(len(a), len(b)) // _WIDTH
        differ = np.flatnonzero(np.frombuffer(a, ELEMENT)[:n] != np.frombuffer(b, ELEMENT)[:n])
        return int(differ[0]) if len(differ) else n

    def each():
        for shard, first, last, before, after in _rows(batches, "shard", "first", "last", "_before", "_after"):
            depth = -1 if before is None else shared(before, first)
            yield shard, depth, sum(elements(first)[1][: max(depth, 0)]), after is not None and after.startswith(last)

    return _batches(each(), schema)


def _hashed(batches, schema):
    """sha256 of the ids of each key; the rows of a key come one after the other, in order."""

    def each():
        for key, run in itertools.groupby(_rows(batches, "key", "shard", "ids"), key=lambda r: r[0]):
            digest, at = hashlib.sha256(), None
            for _, shard, text in run:
                if at is not None and shard != at:
                    digest.update(b",")
                digest.update(text.encode())
                at = shard
            yield key, digest.hexdigest()

    return _batches(each(), schema)


def with_common_heads(sequences: DataFrame, group: int = 5, most: int = 9) -> DataFrame:
    """Each conversation c with its first h turns replaced by those of conversation c - c % ``group``.

    ``h = crc32(decimal c) % most``; a conversation of its own beginning stays as it
    is.  For a negative c the group starts at the next lower multiple.
    """
    own = sequences.withColumn("_base", F.expr(f"conv_id - pmod(conv_id, {group})"))
    heads = own.where("conv_id = _base").select("_base", F.expr(f"substr(sequence, 1, {(most - 1) * _WIDTH})").alias("_head"))
    found = lookup(own, [store(heads)], ["_base"], even=True)
    taken = F.crc32(F.col("conv_id").cast("string")) % most * _WIDTH
    found = found.withColumn("_n", taken.cast("int"))
    rebuilt = F.expr("concat(substr(coalesce(_head, x''), 1, _n), substr(sequence, _n + 1))")
    return found.select("conv_id", rebuilt.alias("sequence"))


@dataclass(frozen=True)
class ConversationTrie:
    """Nodes of the prefix trie of conversations.

    Turns are ordered by their number, null first; turns with equal numbers by a
    digest of role and text, repeated rows standing next to each other.  A null role
    or text is empty.  Rows without a conversation id belong to no conversation and
    are left out.  An empty table has no node, not even the root.  Other columns are
    ignored.  A conversation's codes, 12 bytes a turn, must fit a task, as must the
    nodes of a shard, ``shard_turns`` or a single conversation; its texts need not.
    """

    conv_col: str = "conv_id"
    turn_col: str = "turn"
    role_col: str = "role"
    text_col: str = "text"
    shard_turns: int = 400_000

    def sequences(self, conversations: DataFrame) -> DataFrame:
        """``(conv_id, sequence)``, a written table: the codes of a conversation's turns, in order."""
        turn = F.col(self.turn_col)
        role = F.coalesce(F.col(self.role_col).cast("string"), F.lit(""))
        text = F.coalesce(F.col(self.text_col).cast("string"), F.lit(""))
        digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
        turns = conversations.where(F.col(self.conv_col).isNotNull()).select(
            F.col(self.conv_col).cast("long").alias("conv_id"),
            turn.isNotNull().alias("known"),
            turn.alias("turn"),
            F.unhex(F.substring(digest, 1, 32)).alias("digest"),
            F.octet_length(text).alias("bytes"),
        )
        turns = reread(turns)
        codes = turns.select("digest").distinct().withColumn("code", F.monotonically_increasing_id())
        coded = reread(lookup(turns, [store(codes)], ["digest"], copies=True))
        # repeated rows have different places, so that a range may end between them
        order = ["conv_id", "known", "turn", "digest", "_place"]
        tasks = self._tasks(coded.count(), coded)
        placed = coded.withColumn("_place", F.monotonically_increasing_id())
        spread = placed.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
        schema = "conv_id long, part long, sequence binary"
        arrow = _arrow(schema)
        parts = spread.select("conv_id", "code", "bytes").mapInArrow(lambda b: _batches(_joined(b), arrow, 64), schema)
        ordered = F.array_sort(F.collect_list(F.struct("part", F.hex("sequence").alias("codes"))))
        whole = F.unhex(F.array_join(F.transform(ordered, lambda p: p["codes"]), ""))
        return reread(parts.groupBy("conv_id").agg(whole.alias("sequence")))

    def _tasks(self, turns: int, df: DataFrame) -> int:
        return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), turns // self.shard_turns + 1)

    def nodes(self, sequences: DataFrame) -> DataFrame:
        """One row per distinct beginning of the sequences, see ``__call__``."""
        sequences = reread(sequences)
        size = sequences.agg((F.count(F.lit(1)) + F.sum(F.octet_length("sequence")) / _WIDTH).cast("long")).first()[0]
        spread = sequences.select("sequence", "conv_id").repartitionByRange(
            self._tasks(size or 0, sequences), "sequence", "conv_id"
        )
        arrow = _arrow(_NODE)

        def build(batches):
            shard = _Shard(_rows(batches, "sequence", "conv_id"))
            return _batches(shard.nodes(TaskContext.get().partitionId()), arrow)

        found = reread(spread.sortWithinPartitions("sequence", "conv_id").mapInArrow(build, _NODE))
        merged = reread(self._merged(found))
        parents = store(merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_above")))
        columns = ["conv_id", "depth", "parent_conv_id", *_COUNTS, "ends_sha256"]
        inner = found.where("key is null").select("parent_key", *columns)
        alike = inner.unionByName(merged.select("parent_key", F.lit(None).cast("long").alias("parent_conv_id"),
                                                *[c for c in columns if c != "parent_conv_id"]))
        joined = lookup(alike, [parents], ["parent_key"])
        return joined.select(
            "conv_id",
            "depth",
            F.coalesce("parent_conv_id", "_above").alias("parent_conv_id"),
            *_COUNTS,
            F.coalesce("ends_sha256", F.lit(_NONE)).alias("ends_sha256"),
        )

    def _merged(self, found: DataFrame) -> DataFrame:
        """Nodes that several shards may have: their counts added, without what is counted twice."""
        # as many rows as there are shards
        order = Window.orderBy("shard")
        edges = found.where("first is not null").select("shard", "first", "last")
        edges = edges.select("*", F.lag("last").over(order).alias("_before"), F.lead("first").over(order).alias("_after"))
        schema = "shard int, shared long, shared_bytes long, goes_on boolean"
        arrow = _arrow(schema)
        edges = store(edges.mapInArrow(lambda b: _neighbours(b, arrow), schema))
        edge = lookup(found.where("key is not null and depth is not null").drop("first", "last", "ids"), [edges], ["shard"])
        again = F.col("on_first") & (F.col("depth") <= F.col("shared"))
        child_again = F.col("on_first") & (F.col("depth") < F.col("shared"))
        no_leaf = F.col("on_last") & F.col("goes_on")
        sums = edge.groupBy("key").agg(
            F.min("parent_key").alias("parent_key"),
            F.min("depth").alias("depth"),
            F.min("conv_id").alias("conv_id"),
            F.sum("n_convs").alias("n_convs"),
            F.sum(F.col("n_children") - child_again.cast("long")).alias("n_children"),
            F.sum(F.col("n_leaves") - no_leaf.cast("long")).alias("n_leaves"),
            F.sum(F.col("saved_tokens") + F.when(again, F.col("shared_bytes") - F.col("before")).otherwise(0)).alias(
                "saved_tokens"
            ),
        )
        chunks = found.where("ids is not null").select("key", "shard", "chunk", "ids")
        schema = "key binary, ends_sha256 string"
        arrow_ends = _arrow(schema)
        texts = chunks.repartition("key").sortWithinPartitions("key", "shard", "chunk").select("key", "shard", "ids")
        ends = texts.mapInArrow(lambda b: _hashed(b, arrow_ends), schema)
        whole = found.where("key is not null and depth is null and ids is null").select("key", "ends_sha256")
        return lookup(sums, [store(ends.unionAll(whole))], ["key"], even=True)

    def __call__(self, conversations: DataFrame) -> DataFrame:
        """``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)``.

        ``conv_id`` is the smallest conversation that begins so, ``saved_tokens`` the
        bytes of text that storing each node once saves below it and itself, and
        ``ends_sha256`` the hash of the ids of conversations that end there.
        """
        return self.nodes(self.sequences(conversations))
