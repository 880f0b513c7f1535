import math

from llm import brute
import pytest

from titleprep.llm import search
from titleprep.llm.licenses import LicenseScan
from titleprep.llm.search import TopK
from titleprep.llm.url_filter import UrlFilter
from titleprep.scale import reread


@pytest.mark.parametrize("shard_docs", [4, 32_768])
def test_top_k(hard_docs, as_docs, shard_docs):
    docs = [(i, t) for i, t in hard_docs if i is not None]
    queries = [(i, t) for i, t in docs if i % 2 == 0]
    expected = brute.bm25(docs, dict(queries).items(), k=5)
    got = {}
    table = as_docs(docs, clashing=True)
    for r in TopK(k=5, shard_docs=shard_docs)(table, table.where("doc_id % 2 = 0")).collect():
        got.setdefault(r["query_id"], {}).setdefault(r["rank"], (r["doc_id"], r["score"]))
    for query, best in expected.items():
        own = [got.get(query, {})[n] for n in sorted(got.get(query, {}))]
        assert [i for i, _ in own] == [i for i, _ in best], query
        assert all(math.isclose(a, b, rel_tol=1e-9) for (_, a), (_, b) in zip(own, best))


def test_top_k_prunes_nothing_that_counts(as_docs, prose):
    docs = [(i, prose(i % 37, 30 + i % 50)) for i in range(900)]
    queries = docs[::90]
    expected = brute.bm25(docs, queries)
    rows = TopK(shard_docs=600)(as_docs(docs), as_docs(queries)).collect()
    got = {(r["query_id"], r["rank"]): r["doc_id"] for r in rows}
    assert got == {(q, n + 1): i for q, best in expected.items() for n, (i, _) in enumerate(best)}


def test_top_k_texts_without_an_id_take_no_place(as_docs, prose):
    docs = [(None if i % 3 else i, prose(i, 40)) for i in range(60)]
    queries = [(1, prose(7, 40)), (2, prose(8, 40))]
    rows = TopK(k=5)(as_docs(docs), as_docs(queries)).collect()
    every = brute.bm25([(i, t) for i, (_, t) in enumerate(docs)], queries, k=60)
    for query, best in every.items():
        got = sorted((r["rank"], r["doc_id"]) for r in rows if r["query_id"] == query)
        assert [i for _, i in got] == [i for i, _ in best if i % 3 == 0][:5]


def test_top_k_results_and_moved_queries_do_not_grow_with_the_shards(as_docs, prose, spark, monkeypatch):
    docs = [(i, prose(i % 97, 30 + i % 50)) for i in range(800)]
    queries = docs[::40]
    written = []

    def kept(df):
        written.append(reread(df))
        return written[-1]

    monkeypatch.setattr(search, "reread", kept)
    rows = TopK(shard_docs=10)(as_docs(docs), as_docs(queries)).collect()
    tasks = spark.sparkContext.defaultParallelism
    assert tasks < 80  # shards
    # what the tasks give is written last; a text may have copies
    assert len(queries) * 10 <= len(rows) and written[-1].count() <= tasks * len(queries) * 10
    expected = brute.bm25(docs, queries)
    got = {(r["query_id"], r["rank"]): r["doc_id"] for r in rows}
    assert got == {(q, n + 1): i for q, best in expected.items() for n, (i, _) in enumerate(best)}


def test_top_k_of_nothing(as_docs):
    assert TopK()(as_docs([]), as_docs([(1, "a")])).count() == 0
    assert TopK()(as_docs([(1, "a")]), as_docs([])).count() == 0
    assert TopK()(as_docs([(1, None), (2, "")]), as_docs([(1, None), (3, "b")])).count() == 0


APACHE = "Licensed under the Apache License, Version 2.0."
GPL = "This work is licensed under the GNU General Public License, version 3."
FILES = [
    ("src/LICENSE", f"  {APACHE.upper()}\n"),
    ("src/a/one.py", "nothing here"),
    ("src/a/two.py", f"code\n{GPL}\nmore code of some length, licensed or not"),
    ("src/a/b/c/three.py", None),
    ("src/a/b/notice", "Released under the MIT License."),
    ("other/x/y.py", "a license to code"),
    ("top.py", ""),
    (None, APACHE),
    (None, "text"),
    ("src/a/one.py", "the same path again"),
    ("deep/COPYING.txt", f"{GPL}\n\nsome further words about it that are not part of any license text at all"),
    ("deep/er/z", "words " * 40_000),
]


def test_licenses(spark):
    files = spark.createDataFrame(FILES, "path string, text string").selectExpr(
        "*", "1 as license", "2 as _own", "3 as _dir"
    )
    rows = LicenseScan()(files)
    assert rows.columns == ["path", "_own", "_dir", "license", "similarity", "license_from"]
    got = sorted(((r["path"], r["license"], r["license_from"]) for r in rows.collect()), key=repr)
    expected = [
        ("src/LICENSE", "Apache-2.0", "own"),
        ("src/a/one.py", "Apache-2.0", "inherited"),
        ("src/a/one.py", "Apache-2.0", "inherited"),
        ("src/a/two.py", "GPL-3.0", "own"),
        ("src/a/b/c/three.py", "MIT", "inherited"),
        ("src/a/b/notice", "MIT", "own"),
        ("other/x/y.py", None, None),
        ("top.py", None, None),
        (None, "Apache-2.0", "own"),
        (None, None, None),
        ("deep/COPYING.txt", "GPL-3.0", "own"),
        ("deep/er/z", "GPL-3.0", "inherited"),
    ]
    assert got == sorted(expected, key=repr)
    assert LicenseScan()(files.limit(0)).count() == 0


def test_opening_texts_as_license_files(spark):
    files = [("d/a", f"{APACHE}\nmuch more text than the license itself has"), ("d/e/b", "x"), ("d/c", f"x\n{GPL}")]
    df = spark.createDataFrame(files, "path string, text string")
    got = {r["path"]: r["license"] for r in LicenseScan(opening=True)(df).collect()}
    assert got == {"d/a": "Apache-2.0", "d/e/b": "Apache-2.0", "d/c": "GPL-3.0"}
    assert {r["path"]: r["license"] for r in LicenseScan()(df).collect()}["d/e/b"] is None


URLS = [
    (None, "", "", None),
    ("no scheme", "", "", None),
    ("", "", "", None),
    ("http://Example.COM/EN/x", "example.com", "/EN/x", "com/"),
    ("https://a.example.com/en/x?q#f", "a.example.com", "/en/x", "example.com/en/"),
    ("https://a.www.example.com/en/x#f?q", "a.www.example.com", "/en/x", "www.example.com/en/"),
    ("x://xexample.com/en/1", "xexample.com", "/en/1", "com/"),
    ("http://com", "com", "", None),
    ("http://com/", "com", "/", "com/"),
    ("http://b.net/es/1", "b.net", "/es/1", "net/es/"),
    ("http://b.net/ES/1", "b.net", "/ES/1", None),
    ("http://b.net/fr", "b.net", "/fr", None),
    ("http://h?x=/a", "h", "", None),
    ("http://h#x://y/z", "h", "", None),
    ("://u.v/w\nx://y", "u.v", "/w\nx://y", None),
    ("http://ÄB.net/fr/é" + "x" * 50_000, "Äb.net", "/fr/é" + "x" * 50_000, "net/fr/"),
]


def test_url_rules(spark):
    pages = spark.createDataFrame([(i, u[0]) for i, u in enumerate(URLS)] * 2, "page_id long, url string")
    pages = pages.selectExpr("*", "1 as host", "2 as _text", "3 as _page", "4 as VERDICT")
    rows = UrlFilter()(pages)
    assert rows.columns == ["page_id", "url", "_text", "_page", "host", "path", "rule", "verdict"]
    rows = rows.collect()
    assert len(rows) == 2 * len(URLS)
    verdicts = dict(UrlFilter().rules)
    for r in rows:
        assert (r["host"], r["path"], r["rule"]) == URLS[r["page_id"]][1:]
        assert r["verdict"] == verdicts.get(r["rule"], r["verdict"]) and r["verdict"] in ("allow", "block")
    assert UrlFilter()(pages.limit(0)).count() == 0


def test_url_model_finds_the_kind_of_held_out_addresses(spark):
    """Two kinds of addresses in labelled domains; the same kinds elsewhere get the same verdicts."""
    good = [f"http://s{i}.com/garden/rose-{i * 37 % 101}" for i in range(150)]
    bad = [f"http://s{i}.net/es/zzq{i * 53 % 97}xkqj" for i in range(150)]
    unknown = [f"http://t{i}.org/garden/rose-{i}" for i in range(40)] + [f"http://t{i}.org/es/zzq{i}xkqj" for i in range(40)]
    pages = spark.createDataFrame(list(enumerate(good + bad + unknown)), "page_id long, url string")
    rows = [r for r in UrlFilter()(pages).collect() if r["rule"] is None]
    right = [(r["verdict"] == "allow") == ("garden" in r["url"]) for r in rows]
    assert len(right) == 80 and sum(right) >= 76


def log_ratios(order, yes, no, text):
    """The score of one address, straight from the definition."""
    from collections import Counter

    def counts(texts):
        seen = Counter()
        for t in texts:
            padded = "\x02" * order + t + "\x03"
            for i in range(order, len(padded)):
                for k in range(order + 1):
                    seen[padded[i - k : i], padded[i]] += 1
        return seen

    def chance(seen, context, char):
        p = 1 / 256
        for k in range(len(context) + 1):
            own = {c: n for (x, c), n in seen.items() if x == context[len(context) - k :]}
            if own:
                p = (own.get(char, 0) + len(own) * p) / (sum(own.values()) + len(own))
        return p

    models = counts(yes), counts(no)
    padded = "\x02" * order + text + "\x03"
    return sum(
        round(1e6 * (math.log(chance(models[0], padded[i - order : i], padded[i])) - math.log(chance(models[1], padded[i - order : i], padded[i]))))
        for i in range(order, len(padded))
    ) / (len(text) + 1)


def test_url_scores_follow_the_definition(spark):
    yes, no, asked = ["abcab", "abd"], ["zzb", "a"], ["abz", "q", ""]
    own = UrlFilter(order=2)
    schema = "_text string, _label string"
    rows = [(t, "allow") for t in yes] + [(t, "block") for t in no]
    counted = (
        own._grams(spark.createDataFrame(rows, schema))
        .groupBy("_gram")
        .agg({"_label": "collect_list"})
        .selectExpr(
            "_gram",
            "size(filter(`collect_list(_label)`, x -> x = 'allow')) as _yes",
            "size(filter(`collect_list(_label)`, x -> x = 'block')) as _no",
        )
    )
    grams = own._grams(spark.createDataFrame([(t, "") for t in asked], schema))
    ratios = {r["_gram"]: r["_ratio"] for r in own._ratios(counted, grams.select("_gram").distinct()).collect()}
    for text in asked:
        padded = "\x02\x02" + text + "\x03"
        got = sum(ratios[padded[i : i + 3]] for i in range(len(text) + 1)) / (len(text) + 1)
        assert abs(got - log_ratios(2, yes, no, text)) < 1.5


def test_postings_are_added_in_parts():
    import numpy as np

    from titleprep.llm import search

    sizes = np.array([3, 4, 9, 1, 1, 20, 2])
    parts = list(search._parts(sizes, 8))
    assert [(p.start, p.stop) for p in parts] == [(0, 2), (2, 3), (3, 5), (5, 6), (6, 7)]
    assert list(search._parts(np.zeros(0, int), 8)) == []


def test_a_word_of_a_query_takes_twelve_bytes(as_docs):
    import numpy as np

    from titleprep.llm import search

    places, counts = np.array([1, 1 << 63, (1 << 64) - 1], np.uint64), np.array([1, 2, 70_000])
    for documents, width in ((100_000, 12), (1 << 32, 16)):
        data = search._packed(places, counts, documents)
        back = search._unpacked(data, documents)
        assert len(data) == 3 * width and [b.tolist() for b in back] == [places.tolist(), counts.tolist()]
    docs, top = as_docs([(1, "a b c"), (2, "a b d")]), TopK()
    asked = top._bags(as_docs([(3, "a c c"), (4, "d e f")]), None)
    rows = top._counted(top._statistics(docs), asked, 2).collect()
    found = sorted(search._unpacked(r["_words"], 2)[1].tolist() for r in rows)
    assert sorted(map(sorted, found)) == [[1], [1, 2]]


def test_batches_are_small_only_inside(spark):
    from titleprep.llm import search

    before = spark.conf.get(search._ROWS_CONF)
    with search._small_batches(spark):
        rows = spark.range(2_000, numPartitions=1).mapInArrow(
            lambda batches: (b.slice(0, 1) for b in batches if b.num_rows <= search._ROWS), "id long"
        )
        assert rows.count() == 2_000 // search._ROWS
    assert spark.conf.get(search._ROWS_CONF) == before


def test_results_do_not_depend_on_the_size_of_parts(monkeypatch):
    import numpy as np

    from titleprep.llm import search

    rng = np.random.default_rng(3)
    docs = []
    for _ in range(700):
        words = np.unique(rng.zipf(1.3, 40).astype(np.uint64) % 4_000)
        docs.append((words, rng.integers(1, 4, len(words)).astype(np.int32), len(words)))
    asked = [(docs[i][0], np.ones(len(docs[i][0]))) for i in range(0, 700, 50)]
    index = search.Shard(list(docs), 30.0, 1.2, 0.75)
    whole = [(n, d.tolist(), s.tolist()) for n, d, s in index.search(asked, 5)]
    monkeypatch.setattr(search, "_POSTINGS", 7)
    assert [(n, d.tolist(), s.tolist()) for n, d, s in index.search(asked, 5)] == whole


def _languages(rng, most, least):
    """Documents of a common language, then of a rare one that shares no word with it."""
    import numpy as np

    docs = []
    for first, count in ((0, most), (1_000_000, least)):
        for _ in range(count):
            words = np.unique(rng.zipf(1.3, 40).astype(np.uint64) % 4_000) + np.uint64(first)
            docs.append((words, rng.integers(1, 4, len(words)).astype(np.int32), len(words)))
    return docs


def test_blocks_that_cannot_reach_the_best_are_not_multiplied():
    import numpy as np

    from titleprep.llm import search

    docs = _languages(np.random.default_rng(5), 3_000, 100)
    asked = [(docs[i][0], np.ones(len(docs[i][0]))) for i in range(3_000, 3_100, 9)]
    index = search.Shard(list(docs), 30.0, 1.2, 0.75)
    # words of the rare language are in a matrix where its documents are, though few of the shard have them
    common = np.searchsorted(index.terms, np.uint64(1_000_001))
    assert index.terms[common] == 1_000_001 and index.dense_number[common] >= 0
    whole = {n: dict(zip(d.tolist(), s.tolist())) for n, d, s in index.search(asked, 5)}
    for number, (terms, weights) in enumerate(asked):
        scores = []
        for at, (words, often, length) in enumerate(docs):
            n = often[np.isin(words, terms)].astype(float)
            scores.append((math.fsum(n * 2.2 / (n + 1.2 * (0.25 + 0.75 * length / 30.0))), at))
        best = sorted(scores, reverse=True)[:5]
        assert [whole[number][at] for _, at in best] == pytest.approx([score for score, _ in best])
    # groups of the common language are closed: what stands in their matrices is not looked at
    floor = np.array([sorted(whole[number].values())[-5] for number in range(len(asked))])
    for start, (_, matrix) in zip(range(0, 3_100, search._GROUP), index.groups):
        if (index.order[start : start + search._GROUP] < 3_000).all():
            matrix[:] = np.nan
    assert np.isnan([matrix[0, 0] for _, matrix in index.groups]).any()
    assert {n: dict(zip(d.tolist(), s.tolist())) for n, d, s in index.search(asked, 5, floor)} == whole


def test_results_do_not_depend_on_what_is_dense(monkeypatch):
    import numpy as np

    from titleprep.llm import search

    docs = _languages(np.random.default_rng(6), 1_500, 300)
    asked = [(docs[i][0], np.arange(1, len(docs[i][0]) + 1) / 8) for i in range(0, 1_800, 90)]

    def found():
        index = search.Shard(list(docs), 30.0, 1.2, 0.75)
        rows = [(n, sorted(zip(s.tolist(), d.tolist()))[-5:]) for n, d, s in index.search(asked, 5)]
        return rows, max(matrix.size for _, matrix in index.groups)

    whole, cells = found()
    assert cells > 8 * search._GROUP
    monkeypatch.setattr(search, "_CELLS", 8 * search._GROUP)
    assert found() == (whole, 8 * search._GROUP)
    monkeypatch.setattr(search, "_CELLS", 0)
    assert found() == (whole, 0)
