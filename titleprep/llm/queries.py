"""The operators over the given tables, as registered queries."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from titleprep.llm.byte_bpe import ByteBpe
from titleprep.llm.conversation_trie import ConversationTrie, with_common_heads
from titleprep.llm.licenses import LicenseScan
from titleprep.llm.line_dedup import LineDedup
from titleprep.llm.oracles import ORACLES
from titleprep.llm.packing import BestFitPacking
from titleprep.llm.passages import RepeatedPassages
from titleprep.llm.pii import BASE_KINDS, PersonalData
from titleprep.llm.quality import CompressionBands
from titleprep.llm.search import TopK
from titleprep.llm.simhash import SimHashDedup
from titleprep.llm.url_filter import UrlFilter
from titleprep.llm.vector_codes import VectorCodes
from titleprep.llm.window_packing import WindowPacking
from titleprep.scale import lookup, store


def tokenizer_path(name: str) -> str:
    """The place of a vocabulary file; TOKENIZER_DIR names another folder."""
    folder = os.environ.get("TOKENIZER_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return TopK()(docs, docs.where("doc_id % 20 = 0"))


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = F.sha2(F.col("text"), 256).alias("kept_sha256")
    return LineDedup()(docs).select("doc_id", "n_lines", "n_dropped", kept)


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table has no paths: documents are laid out by language and the digits of their id."""
    docs = _table(spark, sf_dir, "documents")
    digits = F.split(F.col("doc_id").cast("string"), "")
    path = F.array_join(F.concat(F.array(F.coalesce("lang", F.lit("none"))), digits), "/")
    files = docs.select("doc_id", path.alias("path"), "text")
    return LicenseScan(opening=True)(files)


def simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SimHashDedup()(_table(spark, sf_dir, "documents"))


def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return UrlFilter()(_table(spark, sf_dir, "pages").select("page_id", "url")).drop("url")


def compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return CompressionBands()(docs).drop("text")


def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    coder = ByteBpe(tokenizer_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coder.round_trip(docs).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = PersonalData()(docs).select("doc_id", "pii")

    def joined(spans):
        places = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
        return F.array_join(places, ",")

    def of(kind):
        return F.filter("pii", lambda s: s["kind"] == kind)

    base = F.filter("pii", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select(
        "doc_id",
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("pii")).alias("spans"),
    )


def repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = RepeatedPassages()(_table(spark, sf_dir, "documents"))
    kept = F.sha2("kept", 256).alias("kept_sha256")
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", kept)


def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return BestFitPacking(tokenizer_path("word_bpe_49k.json"))(_table(spark, sf_dir, "documents"))


def window_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return WindowPacking(tokenizer_path("byte_bpe_50k.json"))(_table(spark, sf_dir, "documents"))


def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    trie = ConversationTrie()
    return trie.nodes(with_common_heads(trie.sequences(_table(spark, sf_dir, "conversations"))))


def vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, books = VectorCodes().fit(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    digits = F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c.cast("int")), 2, "0")))
    error = F.aggregate("distances", F.lit(0).cast("long"), lambda a, d: a + d)
    # labels that are null count as one
    label = {"_none": F.col("label").isNull(), "_label": F.coalesce("label", F.lit(0))}
    rows = found.select("vec_id", F.array_join(digits, "").alias("code"), error.alias("error"), "label").withColumns(label)
    sums = rows.groupBy(*label).agg(F.sum("error").alias("label_error"))
    books = F.lit(books.sha256()).alias("codebooks_sha256")
    return lookup(rows, [store(sums)], list(label)).select("vec_id", "code", "error", "label_error", books)


# ORACLES holds the SQL of those that SQL can express
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_top_k": top_k,
    "op2_line_dedup": line_dedup,
    "op3_license_scan": license_scan,
    "op4_simhash": simhash,
    "op5_url_filter": url_filter,
    "op6_compression_bands": compression_bands,
    "op7_byte_bpe": byte_bpe,
    "op8_pii": pii,
    "op9_repeated_passages": repeated_passages,
    "op10_packing": packing,
    "op11_window_packing": window_packing,
    "op12_conversation_trie": conversation_trie,
    "op13_vector_codes": vector_codes,
}
