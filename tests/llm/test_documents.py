"""Operators on documents against plain versions, on texts that are hard in some way."""

from llm import brute
import pytest

from titleprep.llm import simhash
from titleprep.llm.components import components
from titleprep.llm.line_dedup import LineDedup
from titleprep.llm.passages import RepeatedPassages
from titleprep.llm.quality import CompressionBands
from titleprep.llm.simhash import SimHashDedup, _forest, _near
from titleprep.llm.twice_seen import twice_seen


def in_order(rows):
    return sorted(rows, key=repr)


def test_lines(hard_docs, as_docs, pairs):
    expected = [(i, *found) for (i, _), found in zip(hard_docs, brute.line_dedup(hard_docs))]
    assert any(row[3] for row in expected)
    for filter_bytes in (1 << 16, 1 << 12):  # the second one is far too small
        got = LineDedup(filter_bytes=filter_bytes)(as_docs(hard_docs))
        assert pairs(got, "doc_id", "text", "n_lines", "n_dropped") == in_order(expected)


def test_lines_of_documents_without_ids(as_docs, pairs):
    line = "a line that stands in all of the documents"
    docs = [(None, line), (None, f"{line}\nmore"), (None, line), (5, f"other\n{line} ")]
    got = LineDedup(filter_bytes=1 << 16)(as_docs(docs))
    assert pairs(got, "doc_id", "text") == in_order([(None, ""), (None, "more"), (None, ""), (5, docs[3][1])])
    nobody = LineDedup(filter_bytes=1 << 16)(as_docs(docs[:3]))
    assert pairs(nobody, "text", "n_dropped") == in_order([(line, 0), (f"{line}\nmore", 0), (line, 0)])


def test_line_keys_count_code_points(as_docs, pairs):
    for line, gone in (("é" * 19, False), ("é" * 20, True)):
        got = LineDedup(filter_bytes=1 << 16)(as_docs([(1, line), (2, line), (3, line)]))
        assert pairs(got, "doc_id", "n_dropped") == [(1, int(gone)), (2, int(gone)), (3, 0)]


def test_twice_seen_never_misses(spark):
    import numpy as np

    rows = spark.range(4_000, numPartitions=7).selectExpr("id % 3000 as v")

    def hashes(batch):
        yield batch.column(0).to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)

    seen = twice_seen(rows, hashes, 1 << 16)
    every = np.arange(3_000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    hit = seen.suspects(every)
    assert hit[:1_000].all() and hit[1_000:].mean() < 0.2


@pytest.mark.parametrize("tile", [4, 16_384])
def test_simhash(hard_docs, as_docs, pairs, tile, monkeypatch):
    monkeypatch.setattr(simhash, "_PARTNERS", 2)
    expected = [(i, *found) for (i, _), found in zip(hard_docs, brute.simhash(hard_docs))]
    got = SimHashDedup(tile=tile)(as_docs(hard_docs))
    assert pairs(got, "doc_id", "fingerprint", "component_id") == in_order(expected)


def test_simhash_keeps_one_of_each_group(hard_docs, as_docs, pairs):
    found = brute.simhash(hard_docs, size=5)
    kept = {c for _, c in found if c is not None}
    got = SimHashDedup(shingle=5).keep_one(as_docs(hard_docs, clashing=True))
    assert {i for (i,) in pairs(got, "doc_id")} == kept
    assert got.columns[:2] == ["doc_id", "text"] and "_kept" in got.columns


def test_forest_connects_what_links_connect():
    import numpy as np

    rng = np.random.default_rng(3)
    centers = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    near = [c ^ np.uint64(1 << int(a)) ^ np.uint64(1 << int(b)) for c in centers for a, b in rng.integers(0, 64, (5, 2))]
    prints = np.unique(np.array(near, np.uint64))
    links = _forest(prints[:, None], prints[:, None], True, 3)
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[find(a)] = find(b)
    got, expected = [find(i) for i in range(len(prints))], brute.linked(prints.tolist(), 3)
    assert len(links) == len(prints) - len(set(expected))
    assert len({*zip(got, expected)}) == len(set(got)) == len(set(expected))


def test_lanes_are_compared_together():
    import numpy as np

    rng = np.random.default_rng(4)
    a, b = (rng.integers(0, 1 << 63, (40, 4), dtype=np.uint64) for _ in range(2))
    b[:10] = a[5:15] ^ rng.integers(0, 1 << 6, (10, 4), dtype=np.uint64)
    apart = np.bitwise_count(a[:, None] ^ b[None]).sum(axis=2, dtype=int)
    for radius in (0, 10, 100, 120):
        i, j = _near(a, b, radius)
        assert {*zip(i.tolist(), j.tolist())} == {*zip(*(x.tolist() for x in np.nonzero(apart <= radius)))}


def test_similarity(prose, as_docs):
    """Copies with a changed word in fifty are one group, with one in five they are not; clean texts stay."""
    base = prose(1, 600).split()

    def changed(every, seed):
        return " ".join(f"{seed}x{i}" if i % every == seed % every else w for i, w in enumerate(base))

    docs = [(1, " ".join(base)), (2, changed(50, 7)), (3, changed(60, 8)), (4, changed(5, 3))]
    docs += [(10 + i, prose(100 + i, 300)) for i in range(40)]
    kept = SimHashDedup.for_similarity(0.8).keep_one(as_docs(docs))
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 4, *range(10, 50)]
    found = SimHashDedup.for_similarity(0.8)
    assert (found.shingle, found.lanes, found.radius) == (5, 4, 48)


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(200, 200), (7, 3), (3, 7)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 130)}}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_quality_measures(hard_docs, as_docs, pairs):
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    docs = [*hard_docs, (60, "x y z x y z\nx y z\n\nx y z\n #$%"), (61, "<a> | b & c * #")]
    got = CompressionBands()(as_docs(docs))
    assert pairs(got, "doc_id", *columns) == in_order([(i, *brute.quality(t)) for i, t in docs])


def test_quality_verdicts(prose, as_docs):
    import base64
    import random

    noise = base64.b64encode(random.Random(1).randbytes(6_000)).decode()
    docs = [(1, prose(1, 900)), (2, "word " * 900), (3, " ".join(noise[i : i + 9] for i in range(0, 8_000, 9))), (4, prose(2, 49)), (5, None)]
    kept = {r["doc_id"]: r["kept"] for r in CompressionBands()(as_docs(docs)).collect()}
    assert kept == {1: True, 2: False, 3: False, 4: False, 5: False}


@pytest.mark.parametrize("group", [2, 20_000])  # the first one sends every group of three the other way
def test_passages(hard_docs, as_docs, pairs, group):
    docs = hard_docs
    expected = [(i, *found) for (i, _), found in zip(docs, brute.passages([t for _, t in docs], 200))]
    got = RepeatedPassages(group=group, filter_bytes=1 << 16)(as_docs(docs))
    rows = [(*r[:4], bytes(r[4])) for r in pairs(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept")]
    assert in_order(rows) == in_order(expected)


def test_passages_of_small_span(as_docs, pairs):
    import random

    rng = random.Random(5)
    docs = [(i, "".join(rng.choice("abé") for _ in range(rng.randint(0, 60)))) for i in range(40)]
    expected = [(i, *found[:3]) for (i, _), found in zip(docs, brute.passages([t for _, t in docs], 12))]
    got = RepeatedPassages(span=12, word=4, filter_bytes=1 << 16)(as_docs(docs))
    assert pairs(got, "doc_id", "n_bytes", "n_removed", "n_spans") == in_order(expected)


@pytest.mark.parametrize(
    "operator",
    [
        LineDedup(filter_bytes=1 << 16),
        CompressionBands(),
        SimHashDedup(),
        SimHashDedup().keep_one,
        RepeatedPassages(filter_bytes=1 << 16),
    ],
    ids=["lines", "quality", "simhash", "keep_one", "passages"],
)
def test_empty_table_and_clashing_columns(hard_docs, as_docs, operator):
    assert operator(as_docs([])).count() == 0
    rows = operator(as_docs(hard_docs, clashing=True))
    names = [c.lower() for c in rows.columns]
    assert len(names) == len(set(names))
    assert rows.count() == len(hard_docs) or getattr(operator, "__name__", "") == "keep_one"
