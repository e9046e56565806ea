"""One registered query for each operator of this folder, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bytepair, compression, curriculum, jaccard, language, merkle, minhash, preferences, sanitise,
    simhash, toxicity, variants, warc,
)
from tidemark.llm.common import remainder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function
    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _held_out(divisor: int, rest: int):
    return F.coalesce(remainder(divisor) == rest, F.lit(False)).alias("held_out")


@query("op1_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, learned from labels that are not held out."""
    docs = _table(spark, sf_dir, "documents")
    labels = toxicity.learnable(_table(spark, sf_dir, "labels"))
    model = toxicity.train(toxicity.sample(docs, labels))
    return toxicity.score(docs, model).select("doc_id", _held_out(5, 0), "score", "predicted")


@query("op2_minhash")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its text with an edited last third."""
    return minhash.neighbours(_table(spark, sf_dir, "documents"))


@query("op3_language")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    docs = _table(spark, sf_dir, "documents")
    model = language.train(language.held_out(docs))
    return language.identify(docs, model).select(
        "doc_id", _held_out(4, 2), "lang_pred", "score", "bits", "known")


@query("op4_preferences", preferences.ORACLE)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompt and completion segments of conversations and their changed last answers."""
    return preferences.format_preferences(
        *preferences.answers_exchanged(_table(spark, sf_dir, "conversations")))


@query("op5_sanitise")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document, with the terms that reveal it."""
    return sanitise.spans(_table(spark, sf_dir, "documents")).drop("mark")


@query("op6_bytepair")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document's ids and of what they decode to."""
    import public_tokenizers
    return bytepair.encode_documents(
        _table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op7_compression")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base quality counts and the verdict of the compression bands."""
    return compression.quality(_table(spark, sf_dir, "documents"))


@query("op8_warc", warc.ORACLE)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as read back from the bundles it was written to."""
    return warc.archive(_table(spark, sf_dir, "pages"))


@query("op9_curriculum")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents, in training order."""
    return curriculum.mixture(_table(spark, sf_dir, "documents")).select(
        "doc_id", "source", "size", "source_size", "target", "times", "taken", "position",
        "positions")


@query("op10_simhash")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


@query("op11_variants")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spelling forms of every word of the documents."""
    return variants.variants(_table(spark, sf_dir, "documents"))


@query("op12_merkle", merkle.ORACLE)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, proof and verdict of every document in the manifest's tree."""
    return merkle.manifest(_table(spark, sf_dir, "documents"))


@query("op13_jaccard", jaccard.ORACLE)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of every document by exact similarity of shingle sets."""
    return jaccard.linked_documents(_table(spark, sf_dir, "documents"))
