"""The registered queries and the pipeline on the smallest tables."""

from llm import brute
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from titleprep.llm import queries

EXTRA_COLUMNS = {"lang": "en", "source": "s", "n_chars": 5}


def test_registered():
    known = entry.queries()
    assert set(queries.QUERIES) | {"pipeline"} <= set(known)
    assert [n for n in range(1, 14) if not any(name.startswith(f"op{n}_") for name in known)] == []


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]


def by_id(rows, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in rows}


def test_line_dedup(spark, sf_dir, docs):
    rows = queries.line_dedup(spark, sf_dir).collect()
    found = brute.line_dedup(docs)
    expected = {i: (n, gone, brute.sha(kept)) for (i, _), (kept, n, gone) in zip(docs, found)}
    assert by_id(rows, "n_lines", "n_dropped", "kept_sha256") == expected


def test_simhash(spark, sf_dir, docs):
    expected = {i: found for (i, _), found in zip(docs, brute.simhash(docs))}
    assert by_id(queries.simhash(spark, sf_dir).collect(), "fingerprint", "component_id") == expected


def test_pii(spark, sf_dir, docs):
    rows = by_id(queries.pii(spark, sf_dir).collect(), "n_email", "n_ip", "n_card", "n_phone", "base_sha256")
    for id_, text in docs:
        spans = brute.pii(text)
        counts = tuple(sum(k == kind for k, _, _ in spans) for kind in brute.BASE)
        assert rows[id_] == (*counts, brute.sha(",".join(f"{k}:{a}:{b}" for k, a, b in spans)))


def test_passages(spark, sf_dir, docs):
    rows = queries.repeated_passages(spark, sf_dir).collect()
    found = brute.passages([t for _, t in docs], 200)
    expected = {i: (n, gone, runs, brute.sha(kept)) for (i, _), (n, gone, runs, kept) in zip(docs, found)}
    assert by_id(rows, "n_bytes", "n_removed", "n_spans", "kept_sha256") == expected


@pytest.mark.parametrize("name", ["op1_top_k", "op3_license_scan", "op5_url_filter", "op6_compression_bands"])
def test_other_queries_run(spark, sf_dir, name):
    assert entry.queries()[name](spark, sf_dir).count() > 0


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, sf_dir)
        assert after.columns == docs.columns, name
        left = after.select("doc_id").collect()
        assert len(left) <= len(ids) and {r["doc_id"] for r in left} <= ids
        ids = {r["doc_id"] for r in left}
        docs = after
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r["doc_id"] for r in rows} == ids


def test_stages_on_hard_and_empty_documents(spark, hard_docs, sf_dir):
    extra = tuple(EXTRA_COLUMNS.values())
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for rows in ([], [(*d, *extra) for d in hard_docs]):
        docs = spark.createDataFrame(rows, schema)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf_dir)
            assert out.count() <= 2 * len(rows) + 20, name
            if name != "packing":
                assert out.columns == docs.columns
