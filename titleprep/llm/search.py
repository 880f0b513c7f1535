"""Exact top-k search by BM25 over sharded inverted indexes with block-max pruning.

1. Texts become bags of words; equal texts of a batch are one row with the smallest
   ids of its copies.  Rows are dealt to shards by a digest of the text, so all copies
   of a text meet and are indexed once.
2. Number of documents, mean length and document frequencies are counted over all
   documents; every query gets its weights from them, so scores of different shards
   are comparable.
3. A task takes every query once, into a file of its worker, and then its shards one
   after the other.  For each it builds an inverted index over documents in blocks
   (similar ones next to each other).  Words that many documents of a group of blocks have
   stand in its matrix, with their greatest impact in each block; all others in posting lists.
   The queries are read past it in batches.  For each batch

   * the posting lists are added, which are the smaller part of what a block can gain;
   * the k-th best that earlier shards of the task have, or that blocks have here as far as
     they are known, is a threshold that the final k-th best cannot be below;
   * the block maxima of the dense words bound what a block can still gain;
   * only groups with a block whose bound reaches the threshold (the pivot test of
     block-max WAND, for a batch at once) are multiplied by the queries they are open for.

   What reaches the k-th best is scored again in full precision, word by word in a
   fixed order, so a document's score does not depend on its shard.
   The best of a query over the shards of a task leave it once, at its end.
4. The best of all tasks are merged by a window for each query.

No candidate is cut before it is proven to be below the k best.
"""

from __future__ import annotations

import contextlib
import math
import os
import pickle
import tempfile
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from titleprep.llm.common import slices
from titleprep.llm.common import texts as texts_of
from titleprep.llm.common import word_lists
from titleprep.scale import reread

_BLOCK = 256
_GROUP = 4 * _BLOCK  # documents that share the choice of dense words
_QUERIES = 256
_WORDS = 1 << 17  # words in a batch of queries, unless one query has more
_POSTINGS = 1 << 20  # postings stored, or looked through for final scores, at a time
_NUMBERED = 1 << 16  # words that are numbered at a time
_ADDED = 1 << 16  # postings added at a time
_POSTING = np.dtype([("doc", "<i4"), ("impact", "<f4")])
_DENSE = 16  # words in more than one in so many documents of a group are dense
_CELLS = 1 << 21  # impacts in the matrix of a group; beyond them its less frequent words are posting lists
_COUNTED = 1 << 19  # words of documents counted at a time
_FIRST = np.arange(_ADDED)
_CLUSTER_WORDS = 24
_ROWS = 500  # rows of a batch that a task is sent; each may hold the words of a whole text
_ROWS_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _bag(data: bytes) -> tuple[np.ndarray, np.ndarray, int]:
    """Hashes of the distinct words in order, how often each comes, and the number of words."""
    counts: Counter[bytes] = Counter()
    for words in word_lists(data.lower()):
        counts.update(words)
    hashes = np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, counts)), ">u8").astype(np.uint64)
    often = np.fromiter(counts.values(), np.int32, len(counts))
    order = np.argsort(hashes)
    return hashes[order], often[order], int(often.sum())


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    ends = np.cumsum(sizes)
    numbers = np.repeat(starts - ends + sizes, sizes)
    # few of them are not counted again each time
    numbers += _FIRST[: len(numbers)] if len(numbers) <= len(_FIRST) else np.arange(len(numbers))
    return numbers


def _parts(sizes: np.ndarray, most: int) -> Iterator[slice]:
    """Slices of ``sizes`` that sum to at most ``most``, or hold a single one."""
    ends, at = np.cumsum(sizes), 0
    while at < len(sizes):
        before = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        yield slice(at, end)
        at = end


class _Batch:
    """Queries that are searched at once: their different words in order, and each one's words among them."""

    def __init__(self, words: np.ndarray, place: np.ndarray, weight: np.ndarray, count: np.ndarray):
        self.words, self.place, self.weight, self.count = words, place, weight, count

    @classmethod
    def of(cls, queries: list[tuple[np.ndarray, np.ndarray]]) -> _Batch:
        """Of (terms, weights) for each query."""
        words, place = np.unique(np.concatenate([terms for terms, _ in queries]), return_inverse=True)
        weight = np.concatenate([weights for _, weights in queries])
        return cls(words, place, weight, np.array([len(terms) for terms, _ in queries]))


class Shard:
    """The index of one shard.  ``docs`` are (terms, often, length), one for each distinct text; they are used up."""

    def __init__(self, docs: list[tuple], mean: float, k1: float, b: float):
        sizes = np.array([len(d[0]) for d in docs])
        count = len(docs)
        self.k1 = k1
        lengths = np.array([d[2] for d in docs], np.float64)
        self.damping = k1 * (1 - b + b * lengths / mean)
        # by document, for the final scores
        self.of_doc = np.concatenate([[0], np.cumsum(sizes)])
        terms = np.concatenate([d[0] for d in docs])
        terms.sort()
        terms = terms[np.concatenate([[True], terms[1:] != terms[:-1]])[: len(terms)]]
        # some documents at a time, the last first, so that their words are let go as they are numbered
        self.often = np.empty(self.of_doc[-1], np.int32)
        self.place = place = np.empty(self.of_doc[-1], np.int32)
        for part in reversed(list(_parts(sizes, _NUMBERED))):
            span = slice(self.of_doc[part.start], self.of_doc[part.stop])
            words, at = np.unique(np.concatenate([d[0] for d in docs[part]]), return_inverse=True)
            place[span] = np.searchsorted(terms, words)[at]
            self.often[span] = np.concatenate([d[1] for d in docs[part]])
            del docs[part]
        spread = np.bincount(place, minlength=len(terms))
        # similar documents into the same blocks: by which of the most common words they have
        common = np.argsort(-spread, kind="stable")[:_CLUSTER_WORDS]
        owner = np.repeat(np.arange(count, dtype=np.int32), sizes)
        signature = np.zeros(count, np.int64)
        for bit, term in enumerate(common[::-1].tolist()):
            signature[owner[place == term]] |= 1 << bit
        del owner
        # from here on documents are known by their rank in this order
        self.order = np.lexsort((np.arange(count), lengths, signature))
        self.n = count
        self.blocks = -(-self.n // _BLOCK)
        self.terms = terms
        # words that many documents of a group of blocks have are its matrix, all others posting lists
        of_group, spread = [], np.zeros(len(terms), np.int64)
        for start in range(0, count, _GROUP):
            own = np.zeros(len(terms), np.int64)
            for _, _, posting in self._stored(start, sizes):
                own += np.bincount(place[posting], minlength=len(terms))
            dense = np.flatnonzero(own * _DENSE > min(_GROUP, count - start))
            if len(dense) > _CELLS // _GROUP:
                dense = np.sort(dense[np.argsort(-own[dense], kind="stable")[: _CELLS // _GROUP]])
            own[dense] = 0
            spread += own
            of_group.append(dense)
        every = np.unique(np.concatenate(of_group))
        self.dense_number = np.full(len(terms), -1, np.int32)
        self.dense_number[every] = np.arange(len(every))
        self.dense_count = len(every)
        self.first = np.concatenate([[0], np.cumsum(spread)])
        # a word's postings in order of documents; a posting is one number where it is moved
        postings = np.empty(self.first[-1], _POSTING)
        free = self.first[:-1].copy()
        column = np.full(len(terms), -1, np.int32)
        # for each group: which of the dense words, and their impacts
        self.groups: list[tuple[np.ndarray, np.ndarray]] = []
        # the greatest impact of each dense word in each block
        self.most = np.zeros((self.blocks, len(every)), np.float32)
        for start, dense in zip(range(0, count, _GROUP), of_group):
            by_block = np.zeros((-(-min(_GROUP, count - start) // _BLOCK), _BLOCK, len(dense)), np.float32)
            matrix = by_block.reshape(len(by_block) * _BLOCK, len(dense))
            column[dense] = np.arange(len(dense))
            for docs, rank, posting in self._stored(start, sizes):
                damping = self.damping[docs].astype(np.float32)
                impact = self._impact(self.often[posting].astype(np.float32), damping[rank - rank[0]])
                term = place[posting]
                of_column = column[term]
                hit = np.flatnonzero(of_column >= 0)
                matrix[rank[hit] - start, of_column[hit]] = impact[hit]
                rest = np.flatnonzero(of_column < 0)
                rest = rest[np.argsort(term[rest], kind="stable")]
                term = term[rest]
                new = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]])[: len(term)])
                runs = np.diff(np.append(new, len(term)))
                at = _ranges(free[term[new]], runs)
                free[term[new]] += runs
                postings["doc"][at], postings["impact"][at] = rank[rest], impact[rest]
            column[dense] = -1
            self.groups.append((self.dense_number[dense], matrix))
            block = start // _BLOCK
            self.most[block : block + len(by_block), self.dense_number[dense]] = by_block.max(axis=1)
        self.postings = postings.view(np.int64)
        # the scores of a batch, whose memory serves the next one
        self._scores = np.empty((0, self.blocks * _BLOCK), np.float32)
        # words of a query and their weights, while its documents are scored
        self._asked, self._weight = np.zeros(len(terms), bool), np.zeros(len(terms))

    def _stored(self, start: int, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The group from rank ``start`` in parts: documents, then the rank and the number of each of their postings."""
        group = self.order[start : start + _GROUP]
        for part in _parts(sizes[group], _POSTINGS):
            docs = group[part]
            ranks = np.arange(start + part.start, start + part.start + len(docs), dtype=np.int32)
            yield docs, np.repeat(ranks, sizes[docs]), _ranges(self.of_doc[docs], sizes[docs])

    def _impact(self, often: np.ndarray, damping) -> np.ndarray:
        return often * (self.k1 + 1) / (often + damping)

    def search(
        self, queries: list[tuple[np.ndarray, np.ndarray]], k: int, floor: np.ndarray | float = 0.0
    ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each (terms, weights): its number, the documents that may be among the k best, their scores.

        ``floor`` has a score for each query that its k best reach in any case.
        """
        yield from self.search_batch(_Batch.of(queries), k, floor)

    def search_batch(
        self, queries: _Batch, k: int, floor: np.ndarray | float
    ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """As ``search``; queries without such a document are left out."""
        count = len(queries.count)
        at = np.minimum(np.searchsorted(self.terms, queries.words), len(self.terms) - 1)
        at[self.terms[at] != queries.words] = -1
        term = at[queries.place]
        known = term >= 0
        term, weight = term[known], queries.weight[known]
        query = np.repeat(np.arange(count), queries.count)[known]
        ends = np.searchsorted(query, np.arange(count + 1)).tolist()
        scores = self._listed(count, query, term, weight.astype(np.float32))
        # from here on the greatest score of each block as far as it is known
        best = scores.reshape(count, self.blocks, _BLOCK).max(axis=2)

        column = self.dense_number[term]
        dense = column >= 0
        asked = np.zeros((count, self.dense_count), np.float32)
        asked[query[dense], column[dense]] = weight[dense]
        bound = best + asked @ self.most.T
        block = 0
        for columns, matrix in self.groups:
            blocks = slice(block, block + len(matrix) // _BLOCK)
            # the margin covers the lower precision
            least = np.maximum(_kth(best, k), floor) * (1 - 1e-4)
            rows = np.flatnonzero((bound[:, blocks] >= least[:, None]).any(axis=1))
            if len(rows):
                gain = asked[np.ix_(rows, columns)] @ matrix.T
                span = slice(blocks.start * _BLOCK, blocks.stop * _BLOCK)
                gain += scores[rows, span]
                scores[rows, span] = gain
                best[rows, blocks] = gain.reshape(len(rows), -1, _BLOCK).max(axis=2)
            block = blocks.stop
        least = np.maximum(np.maximum(_kth(best, k), floor) * (1 - 1e-4), 1e-9)
        reached = best >= least[:, None]
        for number in np.flatnonzero(reached.any(axis=1)).tolist():
            blocks = np.flatnonzero(reached[number])
            value = scores[number].reshape(self.blocks, _BLOCK)[blocks]
            block, at = np.nonzero(value >= least[number])
            near, value = blocks[block] * _BLOCK + at, value[block, at]
            if len(near) > k:
                near = near[value >= np.partition(value, len(near) - k)[len(near) - k] * (1 - 1e-4)]
            docs = self.order[near]
            own = slice(ends[number], ends[number + 1])
            yield number, docs, self._exact(docs, term[own], weight[own])

    def _listed(self, count: int, query: np.ndarray, term: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """What the posting lists add to the score of each document, for each of ``count`` queries."""
        if len(self._scores) < count:
            self._scores = np.empty((count, self.blocks * _BLOCK), np.float32)
        scores = self._scores[:count]
        starts = self.first[term]
        sizes = self.first[term + 1] - starts
        listed = np.flatnonzero(sizes)
        starts, sizes, weight = starts[listed], sizes[listed], weight[listed]
        # query by query, so that what is added at a time and where it goes stay in the processor's cache
        first = np.searchsorted(query[listed], np.arange(count + 1)).tolist()
        for own, begin, end in zip(scores, first, first[1:]):
            own.fill(0)
            for part in _parts(sizes[begin:end], _ADDED):
                part = slice(begin + part.start, begin + part.stop)
                posting = self.postings[_ranges(starts[part], sizes[part])].view(_POSTING)
                gains = np.repeat(weight[part], sizes[part])
                gains *= posting["impact"]
                # many times faster than with numbers that do not stand side by side
                np.add.at(own, posting["doc"].astype(np.intp), gains)
        return scores

    def _exact(self, docs: np.ndarray, at: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Scores in full precision; the words of a document are added in the order of their hashes."""
        out = []
        self._asked[at] = True
        self._weight[at] = weights
        starts, sizes = self.of_doc[docs], self.of_doc[docs + 1] - self.of_doc[docs]
        for part in _parts(sizes, _POSTINGS):
            begins, ends = starts[part], np.cumsum(sizes[part])
            spans = zip(begins.tolist(), (begins + sizes[part]).tolist())
            place = np.concatenate([self.place[begin:end] for begin, end in spans])
            hit = np.flatnonzero(self._asked.take(place))
            cuts = np.searchsorted(hit, ends)
            owner = np.repeat(np.arange(len(ends)), cuts - np.concatenate([[0], cuts[:-1]]))
            often = self.often.take(hit + (begins - ends + sizes[part])[owner])
            impact = self._impact(often, self.damping[docs[part]][owner])
            gains = (self._weight.take(place[hit]) * impact).tolist()
            cuts = cuts.tolist()
            out += [math.fsum(gains[begin:end]) for begin, end in zip([0, *cuts], cuts)]
        self._asked[at] = False
        return np.array(out)


def _kth(best: np.ndarray, k: int) -> np.ndarray:
    """The k-th greatest of each row, a bound of the k-th best score; zero for fewer."""
    if best.shape[1] < k:
        return np.zeros(len(best))
    return np.partition(best, best.shape[1] - k, axis=1)[:, best.shape[1] - k]


@contextlib.contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs inside send Arrow batches of at most ``_ROWS``."""
    before = spark.conf.get(_ROWS_CONF)
    # not above zero: without a limit
    spark.conf.set(_ROWS_CONF, str(min(int(before), _ROWS) if int(before) > 0 else _ROWS))
    try:
        yield
    finally:
        spark.conf.set(_ROWS_CONF, before)


def _written(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder, by a job whose Arrow batches stay small."""
    with _small_batches(df.sparkSession):
        return reread(df)


def _packed(places: np.ndarray, counts: np.ndarray, documents: int) -> bytes:
    """The words of a query: their hashes, then in how many of all documents each is."""
    return places.astype("<u8").tobytes() + counts.astype(_count_type(documents)).tobytes()


def _unpacked(data: bytes, documents: int) -> tuple[np.ndarray, np.ndarray]:
    size = len(data) // _width(documents)
    return np.frombuffer(data, "<u8", size), np.frombuffer(data, _count_type(documents), size, 8 * size)


def _count_type(documents: int) -> np.dtype:
    return np.dtype("<u4" if documents < 1 << 32 else "<u8")


def _width(documents: int) -> int:
    return 8 + _count_type(documents).itemsize


class _Asked:
    """The queries of a task in files of its worker: their words, and the best documents of each so far.

    A task gets each query once, however many shards it has.  In memory is one batch of them at a time.
    """

    _BEST = np.dtype([("score", "<f8"), ("id", "<i8"), ("doc", "<i8")])

    def __init__(self, k: int, documents: int):
        self._k, self._documents, self._count = k, documents, 0
        folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
        self._files = contextlib.ExitStack()
        self._words, self._best = (
            self._files.enter_context(tempfile.NamedTemporaryFile(dir=folder if os.path.isdir(folder) else None))
            for _ in range(2)
        )

    def __enter__(self) -> _Asked:
        return self

    def __exit__(self, *_) -> None:
        self._files.close()

    def add(self, batch: pa.RecordBatch) -> None:
        """Queries of one Arrow batch, in batches that are searched at once."""
        rows = [_unpacked(words.as_py(), self._documents) for words in batch.column(1)]
        texts = batch.column(0).to_pylist()
        for part in _parts(np.array([len(words) for words, _ in rows]), _WORDS):
            for at in range(part.start, part.stop, _QUERIES):
                end = min(part.stop, at + _QUERIES)
                words, place, weight, count = self._weighted(rows[at:end])
                pickle.dump((texts[at:end], words, place, weight, count), self._words, pickle.HIGHEST_PROTOCOL)
        self._count += batch.num_rows

    def _weighted(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, ...]:
        """Different words in order, each row's words among them, the weights of the different words, words of a row."""
        words, first, place = np.unique(
            np.concatenate([words for words, _ in rows]), return_index=True, return_inverse=True
        )
        # a word has the same count in all queries
        n = np.concatenate([counts for _, counts in rows])[first]
        weight = np.log(1 + (self._documents - n + 0.5) / (n + 0.5))
        return words, place.astype(np.int32), weight, np.array([len(words) for words, _ in rows])

    def batches(self) -> Iterator[tuple[list[bytes], _Batch, np.ndarray]]:
        """Texts and words of each batch with its rows of the best so far, which may be written to.

        Those of score zero are empty.
        """
        if not self._count:
            return
        self._words.flush()
        self._best.truncate(self._count * self._k * self._BEST.itemsize)
        best = np.memmap(self._best, self._BEST, "r+", shape=(self._count, self._k))
        self._words.seek(0)
        at = 0
        while at < self._count:
            texts, words, place, weight, count = pickle.load(self._words)
            yield texts, _Batch(words, place, weight[place], count), best[at : at + len(texts)]
            at += len(texts)


def _different(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict[bytes, list], list[tuple]]]:
    """Of each slice of (id, text): digests of its different texts with text, copies and ids, and their bags."""
    for batch in slices(batches):
        rows: dict[bytes, list] = {}
        for id_, data in zip(batch.column(0).to_pylist(), texts_of(batch, "text")):
            own = rows.setdefault(xxhash.xxh3_128_digest(data), [data, 0, []])
            own[1] += 1
            if id_ is not None:
                own[2].append(id_)
        yield rows, [_bag(data) for data, _, _ in rows.values()]


def _document_counts(different: Iterator[tuple[dict, list]]) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """Words and the number of documents with each, then of all documents and of all their words.

    The words of several slices are counted together, so that a common one is a row only once in many.
    """
    terms, copies, documents, words, held = [], [], 0, 0, 0

    def counted():
        found, place = np.unique(np.concatenate(terms), return_inverse=True)
        n = np.zeros(len(found), np.int64)
        np.add.at(n, place, np.repeat(np.array(copies, np.int64), [len(t) for t in terms]))
        return found, n, documents, words

    for rows, bags in different:
        for (_, often, _), (own, _, length) in zip(rows.values(), bags):
            terms.append(own)
            copies.append(often)
            documents += often
            words += often * length
            held += len(own)
            if held >= _COUNTED:
                yield counted()
                terms, copies, documents, words, held = [], [], 0, 0, 0
    if terms:
        yield counted()


_BAGS = "_text binary, _ids array<long>, _copies long, _terms binary, _often binary, _length long"


@dataclass(frozen=True)
class TopK:
    """The ``k`` best documents for each query by BM25, ``(query_id, rank, doc_id, score)``.

    A query is a whole text; each of its distinct words counts once.  Words are the
    same as a document's: without white space, A-Z lower-cased.  A query that is one of
    the documents finds itself too.  Equal scores are ranked by id.  Documents without
    a common word are no results, so null, empty and blank texts neither find nor are
    found.  Rows that share an id are documents of their own; ids must not be null
    (rows without an id are counted in the statistics but are no results).  Empty tables
    give an empty table.  Other columns are left out.
    """

    k: int = 10
    k1: float = 1.2
    b: float = 0.75
    shard_docs: int = 16_384
    id_col: str = "doc_id"
    text_col: str = "text"

    def _texts(self, docs: DataFrame) -> DataFrame:
        return docs.select(F.col(self.id_col).cast("long").alias("_id"), F.col(self.text_col).alias("text"))

    def _bags(self, docs: DataFrame, keep: int | None) -> DataFrame:
        """Different texts of each batch with at most ``keep`` smallest ids (all without it)."""

        def run(batches):
            for rows, bags in _different(batches):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(list(rows), pa.binary()),
                        pa.array([sorted(ids)[:keep] for _, _, ids in rows.values()], pa.list_(pa.int64())),
                        pa.array([n for _, n, _ in rows.values()], pa.int64()),
                        pa.array([t.astype("<u8").tobytes() for t, _, _ in bags], pa.binary()),
                        pa.array([o.astype("<i4").tobytes() for _, o, _ in bags], pa.binary()),
                        pa.array([n for _, _, n in bags], pa.int64()),
                    ],
                    names=["_text", "_ids", "_copies", "_terms", "_often", "_length"],
                )

        return self._texts(docs).mapInArrow(run, _BAGS)

    def _statistics(self, docs: DataFrame) -> DataFrame:
        """``(_term, _n)``: documents with each word; in the row without a word all documents and ``_words``."""

        def run(batches):
            for terms, n, documents, words in _document_counts(_different(batches)):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.concat_arrays([pa.array(terms.view(np.int64)), pa.nulls(1, pa.int64())]),
                        pa.array(np.append(n, documents)),
                        pa.concat_arrays([pa.nulls(len(terms), pa.int64()), pa.array([words])]),
                    ],
                    names=["_term", "_n", "_words"],
                )

        rows = self._texts(docs).mapInArrow(run, "_term long, _n long, _words long")
        return rows.groupBy("_term").agg(F.sum("_n").alias("_n"), F.sum("_words").alias("_words"))

    def _counted(self, found: DataFrame, queries: DataFrame, documents: int) -> DataFrame:
        """``(_text, _words)``: the words of distinct queries that some document has, with their counts.

        The words are one binary value: every query goes to every shard, and as an array of
        structs a word takes 32 bytes of each row that is sorted there, and 16 of each Arrow batch.
        """

        def run(batches):
            for batch in batches:
                words = [np.frombuffer(t.as_py(), "<i8") for t in batch.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(
                            pa.array(np.repeat(np.arange(len(words)), [len(w) for w in words]))
                        ),
                        pa.array(np.concatenate(words) if words else np.zeros(0, np.int64)),
                    ],
                    names=["_text", "_term"],
                )

        asked = queries.select("_text", "_terms").mapInArrow(run, "_text binary, _term long")
        # unsigned order, which is that of the hashes
        place = F.col("_term").bitwiseXOR(F.lit(-(1 << 63)))
        words = (
            asked.join(found.select("_term", "_n"), "_term")
            .groupBy("_text")
            .agg(F.sort_array(F.collect_set(F.struct(place.alias("p"), F.col("_n").alias("n")))).alias("_words"))
        )

        def pack(batches):
            for batch in slices(batches):
                packed = []
                for one in batch.column(1):
                    flat = one.values
                    place = flat.field("p").to_numpy().view(np.uint64) ^ np.uint64(1 << 63)
                    packed.append(_packed(place, flat.field("n").to_numpy(), documents))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(packed, pa.binary())], names=["_text", "_words"]
                )

        return words.mapInArrow(pack, "_text binary, _words binary")

    def __call__(self, docs: DataFrame, queries: DataFrame) -> DataFrame:
        spark = docs.sparkSession
        k, k1, b = self.k, self.k1, self.b
        asked = _written(self._bags(queries, None))
        found = _written(self._statistics(docs))
        total = found.where("_term is null").first()
        documents = total["_n"] if total else 0
        mean = max(total["_words"] / documents, 1.0) if documents else 1.0
        # a task for each slot of the cluster at most: each gets all queries, each has as many shards
        shards = max(1, -(-documents // self.shard_docs))
        tasks = min(shards, max(1, spark.sparkContext.defaultParallelism))
        shards = -(-shards // tasks) * tasks
        counted = _written(self._counted(found, asked, documents))

        shard = F.pmod(F.xxhash64("_text"), F.lit(shards)).cast("int")
        indexed = self._bags(docs, k).select(
            (shard % tasks).alias("_task"), shard.alias("_shard"), "_text", "_ids", "_terms", "_often", "_length",
            F.lit(None).cast("binary").alias("_words"),
        )
        none = F.lit(None)
        streamed = counted.select(
            F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))).alias("_task"),
            F.lit(-1).alias("_shard"),
            "_text",
            none.cast("array<long>").alias("_ids"),
            none.cast("binary").alias("_terms"),
            none.cast("binary").alias("_often"),
            none.cast("long").alias("_length"),
            "_words",
        )

        def search(index, ids, before, queries):
            """Merges what a shard has into the best so far; its documents are numbered from ``before``."""
            for _, words, best in queries.batches():
                for number, found, scores in index.search_batch(words, k, best["score"][:, -1]):
                    new = np.empty(len(found), best.dtype)
                    new["score"], new["id"], new["doc"] = scores, [ids[doc][0] for doc in found.tolist()], before + found
                    new = np.concatenate([best[number], new])
                    best[number] = new[np.lexsort((new["id"], -new["score"]))[:k]]

        def run(batches):
            current, held, ids = None, {}, []

            def finish():
                """Searches the shard that is held."""
                # texts without an id are no results
                owned = [(sorted(own)[:k], doc) for own, doc in held.values() if own]
                held.clear()
                if owned:
                    own, docs = (list(column) for column in zip(*owned))
                    del owned
                    index = Shard(docs, mean, k1, b)
                    pa.default_memory_pool().release_unused()
                    search(index, own, sum(map(len, ids)), queries)
                    ids.append(pa.array(own, pa.list_(pa.int64())))

            with _Asked(k, documents) as queries:
                for batch in batches:
                    _, shard, text, own, terms, often, length, words = batch.columns
                    numbers = shard.to_numpy()
                    asked = int(np.searchsorted(numbers, 0))
                    if asked:
                        of_query = [text.slice(0, asked), words.slice(0, asked)]
                        queries.add(pa.RecordBatch.from_arrays(of_query, names=["_text", "_words"]))
                    for i in range(asked, batch.num_rows):
                        if numbers[i] != current:
                            finish()
                            current = numbers[i]
                        key = text[i].as_py()
                        if key in held:
                            held[key][0].extend(own[i].as_py())
                        elif length[i].as_py():
                            held[key] = [
                                own[i].as_py(),
                                (
                                    # views of the batch, which goes with its last document
                                    np.frombuffer(terms[i].as_buffer(), "<u8"),
                                    np.frombuffer(often[i].as_buffer(), "<i4"),
                                    length[i].as_py(),
                                ),
                            ]
                finish()
                if not ids:
                    return
                every = pa.concat_arrays(ids)
                for texts, _, best in queries.batches():
                    there = best["score"] > 0
                    of_query = np.repeat(np.arange(len(texts)), there.sum(axis=1))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(texts, pa.binary()).take(pa.array(of_query)),
                            every.take(pa.array(best["doc"][there])),
                            pa.array(best["score"][there]),
                        ],
                        names=["_text", "_ids", "score"],
                    )

        # the queries of a task come before its documents
        dealt = indexed.union(streamed).repartitionById(tasks, F.col("_task"))
        dealt = dealt.sortWithinPartitions("_shard")
        # run here, with batches whose bytes stay small beside the index
        found = _written(dealt.mapInArrow(run, "_text binary, _ids array<long>, score double"))
        best = Window.partitionBy("_text").orderBy(F.col("score").desc(), "doc_id")
        ranked = (
            found.select("_text", F.explode("_ids").alias("doc_id"), "score")
            .withColumn("rank", F.row_number().over(best))
            .where(F.col("rank") <= k)
        )
        of_query = asked.select("_text", F.explode("_ids").alias("query_id"))
        return ranked.join(of_query, "_text").select("query_id", "rank", "doc_id", "score")
