"""The whole pipeline against the plain versions of its stages, chained."""

import zlib

from llm import brute
import numpy as np
import pytest

import corpus_pipeline
from titleprep.llm.quality import CHUNK_LIMITS, LIMITS
from titleprep.llm.queries import tokenizer_path

tokenizers = pytest.importorskip("tokenizers")


def pieces(docs, capacity=4_096):
    """(id, piece, start, length, checksum) as the contract of the packing puts it."""
    whole = tokenizers.Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    out = []
    for id_, text in docs:
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 1]
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[at : at + capacity], "<u4")
            out.append((id_, piece, at, len(part), zlib.crc32(part.tobytes())))
    return sorted(out, key=repr)


def plain(docs):
    """The documents after each stage but the last."""
    docs = [(i, t) for i, t in docs if brute.kept_by_bands(t, LIMITS, CHUNK_LIMITS)]
    yield docs
    docs = [(i, kept) for (i, _), (kept, _, gone) in zip(docs, brute.line_dedup(docs))]
    yield docs
    docs = [(i, t) for (i, t), (_, least) in zip(docs, brute.simhash(docs)) if i == least]
    yield docs
    yield [(i, brute.redacted(t)) for i, t in docs]


def held_against_plain(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    expected = [(r["doc_id"], r["text"]) for r in docs.collect()]
    for (name, stage), expected in zip(corpus_pipeline.STAGES, plain(expected)):
        docs = corpus_pipeline.reread(stage(spark, docs, folder))
        got = [(r["doc_id"], r["text"]) for r in docs.collect()]
        assert sorted(got, key=repr) == sorted(expected, key=repr), name
    rows = corpus_pipeline.run(spark, folder).collect()
    found = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows]
    assert sorted(found, key=repr) == pieces(expected)
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]
        assert sum(n for _, n in parts) <= 4_096
    return len(rows)


def test_pipeline_of_the_table(spark, sf_dir):
    assert held_against_plain(spark, sf_dir) > 100


def test_pipeline_of_hard_documents(spark, hard_docs, prose, tmp_path):
    private = f"{prose(80, 90)} call +49 30 1234567, ssn 123-45-6789 or a.b@c.de {prose(81, 90)}"
    docs = [*hard_docs, (60, private), (61, private), (62, private + " once more"), (63, None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    assert held_against_plain(spark, str(tmp_path)) > 5


def test_pipeline_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
